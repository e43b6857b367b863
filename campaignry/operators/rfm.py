"""Additive RFM score with nine labels, its profiles and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.functions import rules
from campaignry.operators.features import quantile_bin, scoring_inputs
from campaignry.plans.ordering import SortedRuns, after_keys, long_frame, rank_cut_ends
from campaignry.schema import SEGMENTS
from campaignry.session import cut_lineage, local_frame
from campaignry.tables import Tables

# The labels, the columns of a score, and the metrics of the profile and the radar.
LABELS = ["Champions", "Loyal Customers", "Potential Loyalists", "New Customers", "High-Value Infrequent",
          "Can't Lose Them", "At Risk", "Needs Attention", "Hibernating"]
PROFILE = ["recency_days", "freq_12m", "total_revenue", "annual_income", "credit_score", "n_active_products"]
SCORES = ["customer_id", "R", "F", "M", "rfm_score", "rfm_segment", "customer_segment"]
RADAR_LABELS = ["Champions", "Loyal Customers", "At Risk", "Can't Lose Them", "Hibernating", "New Customers"]
RADAR = ["recency_days", "freq_12m", "total_revenue", "annual_income", "n_active_products", "credit_score"]


def _metrics() -> dict[str, Column]:
    return {"r": F.col("recency_days"), "f": F.col("freq_12m"),
            "m": F.when(F.col("total_revenue") > 0, F.col("total_revenue"))}


def _cuts(t: Tables, feat: DataFrame) -> tuple[list[float], list[tuple], list[tuple] | None]:
    """Quintile edges of R, and the last keys of each rank range of F and M; M has none without revenue.

    All come from one range sort.
    """
    if "rfm_cuts" not in t._memo:
        with SortedRuns(long_frame(feat, _metrics(), keep=["customer_id"]), tie="customer_id") as runs:
            edges = [float(v) for v in runs.percentiles([0, 0.2, 0.4, 0.6, 0.8, 1], ["r"])["r"]]
            ends = {"f": rank_cut_ends(runs.size("f"), 5), "m": rank_cut_ends(runs.size("m"), 4)}
            keys = runs.pick(ends)
            has_revenue = runs.size("m") > 0
        t._memo["rfm_cuts"] = (edges, [keys["f", r] for r in ends["f"]], [keys["m", r] for r in ends["m"]] if has_revenue else None)
    return t._memo["rfm_cuts"]


def _scored(t: Tables, feat: DataFrame) -> DataFrame:
    """R from recency quintiles, F from frequency rank fifths, M 0 or revenue rank quarter 1-4.

    Rank ties follow the customer id. Beyond the cuts a row needs only itself.
    """
    edges, fifths, quarters = _cuts(t, feat)
    metrics = _metrics()
    fifth = after_keys(metrics["f"], F.col("customer_id"), fifths)
    quarter = F.lit(0) if quarters is None else after_keys(metrics["m"], F.col("customer_id"), quarters)
    scored = feat.withColumns({
        "R": F.lit(5) - quantile_bin("recency_days", edges), "F": fifth + 1,
        "M": F.when(F.col("total_revenue") > 0, quarter + 1).otherwise(0)})
    scored = scored.withColumn("rfm_score", F.col("R") + F.col("F") + F.col("M"))
    return scored.withColumn("rfm_segment", rules.first_match(
        rules.ADDITIVE_LABELS, rules.ADDITIVE_OTHER, F.col("R"), F.col("F"), F.col("M")))


def rfm_labels(t: Tables) -> DataFrame:
    """The same scores and labels without the holdings, which no score depends on."""
    if "rfm" in t._memo:
        return t._memo["rfm"]
    if "rfm_labels" not in t._memo:
        t._memo["rfm_labels"] = _scored(t, scoring_inputs(t)).select(*SCORES, *[m for m in PROFILE if m != "n_active_products"])
    return t._memo["rfm_labels"]


def rfm_score_py(t: Tables) -> DataFrame:
    """Scores, labels and the metrics of the profile, active holdings among them."""
    if "rfm" not in t._memo:
        t._memo["rfm"] = cut_lineage(_scored(t, scoring_inputs(t, holdings=True)).select(*SCORES, *PROFILE))
    return t._memo["rfm"]


def rfm_segment_stats(t: Tables) -> DataFrame:
    return rfm_labels(t).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(F.col("total_revenue").cast("decimal(25,2)")).alias("total_revenue"),
        F.min("rfm_score").alias("min_score"), F.max("rfm_score").alias("max_score"),
    ).withColumn("mean_revenue", k.over("total_revenue", "customers"))


def rfm_fm_grid(t: Tables) -> DataFrame:
    """Mean R per frequency (rows) and monetary (columns) score, 0 where empty."""
    wide = rfm_labels(t).groupBy("F").pivot("M", [0, 1, 2, 3, 4]).agg(k.over(F.sum("R"), F.count("R"))).fillna(0.0)
    return wide.select("F", *[F.col(f"`{i}`").alias(f"m{i}") for i in range(5)])


def rfm_bank_mix(t: Tables) -> DataFrame:
    """Label shares within each bank segment, in percent."""
    counts = rfm_labels(t).filter(F.col("customer_segment").isin(SEGMENTS)).groupBy("customer_segment", "rfm_segment").agg(
        F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy("customer_segment"))  # at most nine rows each
    return counts.withColumn("pct", k.share("n", whole))


def rfm_profile(t: Tables) -> DataFrame:
    """Mean, exact median and count of six metrics per label."""
    pairs = F.array(*[F.struct(F.concat_ws("|", "rfm_segment", F.lit(m)).alias("grp"),
                               F.col(m).cast("decimal(18,4)").alias("val")) for m in PROFILE])
    rows = rfm_score_py(t).select(F.explode(pairs).alias("e")).select("e.grp", "e.val")
    with SortedRuns(rows) as runs:
        med = runs.percentiles([0.5])
        stats = runs.rows.groupBy("grp").agg(
            (F.sum((F.col("val") * F.col("_weight")).cast("decimal(38,4)")).cast("double") / F.sum("_weight")).alias("mean"),
            F.sum("_weight").alias("n")).collect()
    return local_frame(t.spark, [(*r["grp"].split("|"), r["mean"], float(med[r["grp"]][0]), r["n"]) for r in stats],
        "rfm_segment string, metric string, mean double, median double, n long",
    ).withColumns({"mean": F.round("mean", 4), "median": F.round("median", 4)})


def rfm_radar(t: Tables) -> DataFrame:
    """Label means scaled to 0-1 over the six compared labels; recency inverted first."""
    means = rfm_score_py(t).filter(F.col("rfm_segment").isin(RADAR_LABELS)).groupBy("rfm_segment").agg(
        *[F.avg(F.col(m).cast("double")).alias(m) for m in RADAR])
    every = Window.partitionBy()  # six rows at most
    turned = means.withColumn("recency_days", F.max("recency_days").over(every) - F.col("recency_days"))
    scaled = lambda m: (F.col(m) - F.min(m).over(every)) / (F.max(m).over(every) - F.min(m).over(every) + F.lit(1e-9))
    return turned.select("rfm_segment", *[F.round(scaled(m), 6).alias(m) for m in RADAR])


def rfm_share(t: Tables) -> DataFrame:
    rows = rfm_segment_stats(t)
    every = Window.partitionBy()  # nine rows at most
    return rows.select(
        "rfm_segment", k.ratio(F.col("customers") * 100, F.sum("customers").over(every), 1).alias("customers_pct"),
        k.ratio(F.col("total_revenue") * 100, F.sum("total_revenue").over(every), 1).alias("revenue_pct"))
