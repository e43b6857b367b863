"""A/B results per campaign and over all campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.tables import Tables


def ab_counts(interactions: DataFrame) -> DataFrame:
    return interactions.filter(F.col("ab_variant").isNotNull()).groupBy("campaign_id", "ab_variant").agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("conversions"),
        k.n_if(k.responded()).alias("responses"), k.n_if(k.outcome_is("Opted Out")).alias("optouts"),
    )


def ab_revenue(conversions: DataFrame) -> DataFrame:
    return conversions.filter(F.col("ab_variant").isNotNull()).groupBy("campaign_id", "ab_variant").agg(
        F.sum("revenue_attributed").alias("variant_revenue"), F.count(F.lit(1)).alias("variant_conversions"))


def ab_test_results(t: Tables) -> DataFrame:
    arms = ab_counts(t.campaign_interactions).join(
        ab_revenue(t.campaign_conversions), ["campaign_id", "ab_variant"], "left"
    ).withColumn("cvr", k.pct("conversions", "contacts"))
    none = F.lit(0).cast("decimal(25,2)")
    side = lambda v, c: F.max(F.when(F.col("ab_variant") == v, F.col(c)))
    wide = arms.groupBy("campaign_id").agg(*[
        side(v, c).alias(f"{v.lower()}_{n}") for v in ("A", "B")
        for c, n in (("contacts", "contacts"), ("conversions", "conversions"), ("cvr", "cvr"),
                     ("variant_revenue", "revenue"))
    ])
    dim = t.campaign_dim().filter("ab_test_enabled")
    rows = dim.join(wide, "campaign_id", "left").withColumns(
        {f"{v}_{n}": k.zero(f"{v}_{n}") for v in "ab" for n in ("contacts", "conversions", "cvr")}
        | {f"{v}_revenue": F.coalesce(f"{v}_revenue", none) for v in "ab"})
    a, b = F.col("a_cvr"), F.col("b_cvr")
    relative = k.ratio((b - a) * 100, a)
    return rows.select(
        "campaign_id", "campaign_code", "campaign_name", "campaign_type", "product_name", "product_category",
        "channel_name", "start_date", "end_date", "a_contacts", "a_conversions", "a_cvr", "a_revenue",
        "b_contacts", "b_conversions", "b_cvr", "b_revenue",
        F.round(b - a, 2).alias("cvr_uplift_pp"), F.round(relative, 1).alias("cvr_relative_uplift_pct"),
        F.round(F.col("b_revenue") - F.col("a_revenue"), 0).alias("revenue_uplift"),
        F.when(b > a, "B").when(a > b, "A").otherwise("No Clear Winner").alias("winning_variant"),
        F.when(F.abs(relative) > 10, "Recommend Scale-Up of Winning Variant").otherwise(
            "Inconclusive — Continue Testing").alias("scale_recommendation"),
    )


def ab_overall(t: Tables) -> DataFrame:
    """One row per variant, with the overall uplift of B over A and the winner beside it."""
    counts = ab_counts(t.campaign_interactions).groupBy("ab_variant").agg(
        F.sum("contacts").alias("contacts"), F.sum("conversions").alias("conversions"))
    revenue = ab_revenue(t.campaign_conversions).groupBy("ab_variant").agg(F.sum("variant_revenue").alias("r"))
    rows = counts.join(revenue, "ab_variant", "left").select(
        "ab_variant", "contacts", "conversions", k.share("conversions", "contacts").alias("cvr"),
        F.coalesce("r", F.lit(0).cast("decimal(25,2)")).alias("revenue"))
    pick = lambda v: F.max(F.when(F.col("ab_variant") == v, F.col("cvr")))
    best = k.value_of(rows.agg(pick("A").alias("a"), pick("B").alias("b")))
    a, b = best["a"], best["b"]
    return rows.select(
        "ab_variant", "contacts", "conversions", "cvr", "revenue",
        ((b - a) / F.nullif(a, F.lit(0.0)) * 100).alias("relative_uplift_pct"),
        F.when(a.isNotNull() & b.isNotNull(), F.when(b > a, "B").otherwise("A")).alias("winner"),
    )


def ab_campaign_pivot(t: Tables) -> DataFrame:
    """CVR per variant for campaigns that have both, uplift, and the share of campaigns B wins."""
    arms = ab_counts(t.campaign_interactions).withColumn("cvr", k.share("conversions", "contacts"))
    wide = arms.groupBy("campaign_id").pivot("ab_variant", ["A", "B"]).agg(F.max("cvr")).dropna(subset=["A", "B"])
    rows = wide.select("campaign_id", F.col("A").alias("cvr_a"), F.col("B").alias("cvr_b"),
                       (F.col("B") - F.col("A")).alias("uplift"))
    wins = rows.agg(k.share(F.count_if(F.col("uplift") > 0), F.count(F.lit(1))))
    return rows.withColumn("b_wins_pct", k.value_of(wins))
