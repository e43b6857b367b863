"""KPI column expressions. All money and rate arithmetic stays in DECIMAL, rounded half up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the KPI definitions.
CPA_BENCHMARK = 45
ROI_TARGET = 200
SILENT = ["No Response", "Pending"]
WARM = ["Interested", "Callback Requested"]
ENGAGED_TYPES = ["Opened", "Clicked", "Called", "Visited Branch", "Web Visit"]
CLICK_TYPES = ["Opened", "Clicked", "Responded", "Visited Branch"]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def outcome_is(value: str) -> Column:
    return F.col("interaction_outcome") == value


def responded() -> Column:
    # A NULL outcome is neither a response nor a silence, as with SQL NOT IN.
    return ~F.col("interaction_outcome").isin(SILENT)


def n_if(condition: Column) -> Column:
    return F.count_if(condition)


def ratio(num, den, dp: int | None = None) -> Column:
    """num / den on decimals; NULL when den is 0."""
    n = col(num).cast("decimal(26,4)")
    d = F.nullif(col(den).cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)"))
    q = n / d
    return q if dp is None else F.round(q, dp)


def pct(part, whole, dp: int = 2) -> Column:
    p = col(part).cast("decimal(18,0)") * F.lit(100)
    w = F.nullif(col(whole).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)"))
    return F.round(p / w, dp)


def share(part, whole) -> Column:
    """Plain floating ratio in percent, unrounded; NULL when whole is 0."""
    w = F.nullif(col(whole).cast("double"), F.lit(0.0))
    return col(part).cast("double") / w * F.lit(100.0)


def over(num, den) -> Column:
    """Plain floating ratio, unrounded; NULL when den is 0."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def cpa(cost, conversions, dp: int = 2) -> Column:
    return ratio(cost, conversions, dp)


def roi(revenue, cost, dp: int = 1) -> Column:
    return ratio((col(revenue) - col(cost)) * F.lit(100), cost, dp)


def zero(c) -> Column:
    return F.coalesce(col(c), F.lit(0))


def cpa_flag(value, limit=None) -> Column:
    limit = F.lit(CPA_BENCHMARK) if limit is None else col(limit)
    return F.when(col(value) <= limit, "Within Benchmark").otherwise("Exceeds Benchmark")


def roi_flag(value) -> Column:
    return F.when(col(value) >= ROI_TARGET, "Above Target").otherwise("Below Target")


def month_of(d) -> Column:
    return F.trunc(col(d), "month")


def quarter_label(d) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col(d)).cast("string"))


def month_key(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def month_label(d) -> Column:
    return F.date_format(col(d), "MMM yyyy")


def month_index(d) -> Column:
    return F.year(col(d)) * 12 + F.month(col(d))


def years_between(as_of, born) -> Column:
    """Whole years as days / 365.25, cut to an integer."""
    return F.floor(F.datediff(as_of, col(born)) / F.lit(365.25)).cast("int")


def band(value, edges: list, labels: list[str]) -> Column:
    """Right-closed bands: (edges[0], edges[1]] -> labels[0], ...; NULL outside."""
    v = col(value)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        hit = (v > lo) & (v <= hi)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def value_of(one_row: DataFrame) -> Column:
    """The value (or the struct of values) of a one-row aggregate, as an uncorrelated scalar subquery."""
    if len(one_row.columns) == 1:
        return one_row.toDF("value").scalar()
    return one_row.select(F.struct(*one_row.columns)).scalar()


def stable_hash(*parts) -> Column:
    """A 60-bit number from the text of the parts, the same on every engine and run."""
    text = F.concat_ws(":", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
