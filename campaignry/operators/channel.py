"""Channel scorecard against benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.tables import Tables


def channel_reach(interactions: DataFrame) -> DataFrame:
    """Counts and distinct campaigns / customers per channel.

    Grouping by (channel, customer) and by (channel, campaign) first keeps a channel with most of
    the traffic from landing in one task.
    """
    campaigns = interactions.select("channel_id", "campaign_id").distinct().groupBy("channel_id").agg(
        F.count("campaign_id").alias("campaigns_using_channel"))
    by_customer = interactions.groupBy("channel_id", "customer_id").agg(
        F.count(F.lit(1)).alias("contacts"),
        k.n_if(k.outcome_is("Converted")).alias("conversions"),
        k.n_if(k.responded()).alias("responses"),
        k.n_if(k.outcome_is("Opted Out")).alias("optouts"),
    )
    totals = by_customer.groupBy("channel_id").agg(
        F.sum("contacts").alias("total_contacts"), F.sum("conversions").alias("total_conversions"),
        F.sum("responses").alias("total_responses"), F.sum("optouts").alias("total_optouts"),
        F.count("customer_id").alias("unique_customers_reached"),
    )
    return totals.join(campaigns, "channel_id")


def channel_analysis(t: Tables) -> DataFrame:
    stats = channel_reach(t.campaign_interactions)
    revenue = t.campaign_conversions.groupBy("channel_id").agg(F.sum("revenue_attributed").alias("revenue"))
    spend = t.campaigns.groupBy("channel_id").agg(
        F.sum("total_budget").alias("spend"), F.count(F.lit(1)).alias("campaigns"))
    rows = (
        t.campaign_channels.filter("is_active").join(stats, "channel_id", "left")
        .join(revenue, "channel_id", "left").join(spend, "channel_id", "left")
    )
    counts = ["total_contacts", "total_conversions", "total_responses", "total_optouts",
              "campaigns_using_channel", "unique_customers_reached"]
    none = F.lit(0).cast("decimal(25,2)")
    rows = rows.withColumns({c: k.zero(c) for c in counts}).withColumns({
        "total_spend": F.coalesce("spend", none), "total_revenue": F.coalesce("revenue", none),
        "total_campaigns": k.zero("campaigns"),
    })
    rows = rows.withColumns({
        "conversion_rate_pct": k.pct("total_conversions", "total_contacts"),
        "cost_per_acquisition": k.cpa("total_spend", "total_conversions"),
    })
    # CVR / CPA = 100 * conversions^2 / (contacts * spend)
    won = F.col("total_conversions").cast("decimal(18,0)")
    efficiency = (won * won * 100).cast("decimal(38,0)") / F.nullif(
        (F.col("total_contacts").cast("decimal(14,0)") * F.col("total_spend").cast("decimal(18,2)")),
        F.lit(0).cast("decimal(33,2)"))
    return rows.select(
        "channel_id", "channel_name", "channel_description", *counts,
        "conversion_rate_pct", k.pct("total_responses", "total_contacts").alias("response_rate_pct"),
        k.pct("total_optouts", "total_contacts").alias("optout_rate_pct"),
        "total_spend", "total_campaigns", "cost_per_acquisition", "total_revenue",
        k.ratio("total_revenue", "total_conversions", 2).alias("revenue_per_conversion"),
        k.roi("total_revenue", "total_spend").alias("roi_pct"), "benchmark_cvr", "benchmark_cpa",
        (F.col("conversion_rate_pct") - F.col("benchmark_cvr")).alias("cvr_gap_vs_benchmark"),
        (F.col("cost_per_acquisition") - F.col("benchmark_cpa")).alias("cpa_gap_vs_benchmark"),
        F.when(F.col("conversion_rate_pct") >= F.col("benchmark_cvr"), "Above Benchmark").otherwise(
            "Below Benchmark").alias("cvr_benchmark_status"),
        k.cpa_flag("cost_per_acquisition", "benchmark_cpa").alias("cpa_benchmark_status"),
        F.when(won > 0, F.round(efficiency, 4)).alias("efficiency_index"),
    ).orderBy(F.desc("total_conversions"))
