"""Exact duplicates: groups by a 128-bit content hash, byte comparison inside the groups, smallest id stays.

Two passes read the texts. The first writes a small fingerprint row per document; only texts whose hash occurs
more than once are compared byte by byte in the second, after equal ones have been combined on the map side. The
final joins carry fingerprints alone, and both of their sides are plain exchanges, so a group that holds a third
of all rows is split by the adaptive skew join. The joins with texts are merge joins at any size: a plan that is a
broadcast on small tables says nothing about large ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from campaignry.session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"
SALTS = 16  # copies of each repeated hash in the join that fetches the texts to compare


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def _hash(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def _digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def fingerprints(docs: DataFrame) -> DataFrame:
    norm = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("norm"))
    return norm.select(
        "doc_id", _hash(F.col("norm")).alias("hash"), _digest(F.col("norm")).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )


def verified_groups(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """One row per group of two or more equal texts: hash, digest, group_size, head (doc_id, row, rows of that id).

    Texts under one hash are grouped by their bytes. Should two different texts share hash and digest, the
    counts of the two ways differ and the job stops, rather than drop a document that has no copy.
    """
    counted = prints.groupBy("hash", "digest", "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("row"))
    light = counted.groupBy("hash", "digest").agg(
        F.sum("rows").alias("group_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "rows")).alias("head"),
    ).filter("group_size > 1")
    light = cut_lineage(light)
    wanted = light.select("hash").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    texts = docs.select(normalised(F.col("text")).alias("norm"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    texts = texts.withColumn("hash", _hash(F.col("norm"))).join(wanted.hint("merge"), ["hash", "salt"])
    same_bytes = texts.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("n"))
    same_bytes = same_bytes.select("hash", _digest(F.col("norm")).alias("digest"), "n")
    checked = light.join(same_bytes, ["hash", "digest"])
    size = F.when(F.col("n") == F.col("group_size"), F.col("group_size")).otherwise(
        F.raise_error(F.lit("different texts share both digests")).cast("long"))
    return cut_lineage(checked.select("hash", "digest", size.alias("group_size"), "head"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Nulls: a null text equals the empty one; a row without id stays only if its group has no id at all.
    Repeated rows of one id: one of them stays. An empty table gives no rows. Other columns are not read.
    """
    prints = cut_lineage(fingerprints(docs))
    groups = verified_groups(docs, prints)
    out = prints.join(groups, ["hash", "digest"], "left")
    alone = F.col("head").isNull()
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("head.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, one of each group of equal texts."""
    groups = verified_groups(docs, cut_lineage(fingerprints(docs)))
    rows = docs.select(F.struct("*").alias("doc"), normalised(F.col("text")).alias("norm"))
    rows = rows.select("doc", _hash(F.col("norm")).alias("hash"), _digest(F.col("norm")).alias("digest"))
    joined = rows.join(groups.hint("merge"), ["hash", "digest"], "left")
    alone = F.col("head").isNull()
    first = F.col("doc.doc_id").eqNullSafe(F.col("head.doc_id"))
    if groups.filter("head.rows > 1").isEmpty():
        return joined.filter(alone | first).select("doc.*")
    # Some id occurs more than once among the rows that would stay: one row of each such group is taken.
    tie = F.struct(*[F.col("doc")[c] for c in docs.columns if c in ("text", "lang", "source", "n_chars")])
    heads = joined.filter(first & ~alone).groupBy("hash", "digest").agg(F.min_by("doc", tie).alias("doc"))
    return joined.filter(alone).select("doc.*").unionByName(heads.select("doc.*"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)
"""
