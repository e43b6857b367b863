"""Places of regular-expression matches, from built-in functions: the texts between the matches give the positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pieces(text: Column, pattern: Column, group: int = 0) -> Column:
    """Array of (gap, hit, value): characters before each match since the last one, its length, its group's length.

    Matches are the leftmost, non-overlapping ones of the text.
    """
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(group)) if group else hits
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value"))
    rows = F.slice(zipped, 1, F.size(hits))
    return F.transform(rows, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                                                F.length(x["value"]).alias("value")))
