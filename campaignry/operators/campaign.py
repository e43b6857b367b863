"""Campaign scorecard and the rankings built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.plans.ordering import tile_of
from campaignry.tables import Tables


def outcome_counts(interactions: DataFrame, *keys: str) -> DataFrame:
    """Eight outcome counts in one pass over the facts, combined map-side."""
    return interactions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_contacts"),
        k.n_if(k.outcome_is("Converted")).alias("total_conversions"),
        k.n_if(k.responded()).alias("total_responses"),
        k.n_if(k.outcome_is("Opted Out")).alias("total_optouts"),
        k.n_if(k.outcome_is("Interested")).alias("total_interested"),
        k.n_if(k.outcome_is("Callback Requested")).alias("total_callbacks"),
        k.n_if(k.outcome_is("Declined")).alias("total_declined"),
        k.n_if(k.outcome_is("No Response")).alias("total_no_response"),
    )


COUNTS = [
    "total_contacts", "total_conversions", "total_responses", "total_optouts", "total_interested",
    "total_callbacks", "total_declined", "total_no_response",
]


def campaign_revenue(conversions: DataFrame) -> DataFrame:
    sums = conversions.groupBy("campaign_id").agg(
        F.sum("revenue_attributed").alias("total_revenue"), F.count(F.lit(1)).alias("conversion_count")
    )
    return sums.withColumn("avg_revenue_per_conversion", k.over("total_revenue", "conversion_count"))


def campaign_performance(t: Tables) -> DataFrame:
    """One scorecard row per campaign: volumes, rates, cost, revenue, benchmark flags."""
    counts = outcome_counts(t.campaign_interactions, "campaign_id")
    revenue = campaign_revenue(t.campaign_conversions).select(
        "campaign_id", "total_revenue", "conversion_count"
    )
    base = t.campaign_dim().join(counts, "campaign_id", "left").join(revenue, "campaign_id", "left")
    base = base.withColumns({c: k.zero(c) for c in COUNTS}).withColumn(
        "revenue_attributed", F.coalesce("total_revenue", F.lit(0).cast("decimal(25,2)"))
    )
    base = base.withColumns({
        "conversion_rate_pct": k.pct("total_conversions", "total_contacts"),
        "response_rate_pct": k.pct("total_responses", "total_contacts"),
        "optout_rate_pct": k.pct("total_optouts", "total_contacts"),
        "cost_per_acquisition": k.cpa("total_budget", "total_conversions"),
        "roi_pct": k.roi("revenue_attributed", "total_budget"),
    })
    return base.select(
        "campaign_id", "campaign_code", "campaign_name", "campaign_type", F.col("status").alias("campaign_status"),
        "product_id", "product_name", "product_category", "channel_id", "channel_name",
        "target_segment", "campaign_manager", "ab_test_enabled", "start_date", "end_date",
        F.datediff("end_date", "start_date").alias("campaign_duration_days"),
        F.year("start_date").alias("campaign_year"), F.quarter("start_date").alias("campaign_quarter"),
        k.quarter_label("start_date").alias("campaign_quarter_label"),
        k.month_key("start_date").alias("campaign_month"), k.month_label("start_date").alias("campaign_month_label"),
        "total_budget", "contacts_target", *COUNTS,
        "conversion_rate_pct", "response_rate_pct", "optout_rate_pct", "cost_per_acquisition", "revenue_attributed",
        F.coalesce(k.ratio("revenue_attributed", "conversion_count", 2), F.lit(0)).alias("avg_revenue_per_conversion"),
        "roi_pct", F.round(F.col("revenue_attributed") - F.col("total_budget"), 2).alias("net_revenue"),
        k.cpa_flag("cost_per_acquisition").alias("cpa_status"), k.roi_flag("roi_pct").alias("roi_status"),
        F.col("benchmark_cvr").alias("channel_benchmark_cvr"), F.col("benchmark_cpa").alias("channel_benchmark_cpa"),
        (F.col("conversion_rate_pct") - F.col("benchmark_cvr")).alias("cvr_vs_benchmark"),
    )


def _completed(t: Tables) -> DataFrame:
    return campaign_performance(t).filter(F.col("campaign_status") == "Completed")


def top_campaigns_roi(t: Tables, min_contacts: int = 500, top: int = 10) -> DataFrame:
    """The limit is a top-k heap, so the rank window only ever sees those rows."""
    best = (
        _completed(t).filter(F.col("total_contacts") > min_contacts)
        .orderBy(F.desc_nulls_last("roi_pct"), "campaign_code").limit(top)
    )
    return best.select(
        "campaign_code", "campaign_name", "channel_name", "product_category", "total_budget", "revenue_attributed",
        "roi_pct", "conversion_rate_pct", "cost_per_acquisition",
        F.rank().over(Window.orderBy(F.desc_nulls_last("roi_pct"))).alias("roi_rank"),
    )


def rank_in_groups(t: Tables) -> DataFrame:
    cvr, r = F.desc_nulls_last("conversion_rate_pct"), F.desc_nulls_last("roi_pct")
    return _completed(t).select(
        "campaign_code", "product_category", "channel_name", "conversion_rate_pct", "roi_pct", "total_contacts",
        F.rank().over(Window.partitionBy("product_category").orderBy(cvr)).alias("rank_within_product"),
        F.rank().over(Window.partitionBy("channel_name").orderBy(cvr)).alias("rank_within_channel"),
        F.dense_rank().over(Window.partitionBy("product_category", "channel_name").orderBy(r)).alias(
            "rank_product_channel"),
    ).orderBy("product_category", "rank_within_product")


def worst_cpa(t: Tables, worst: int = 5) -> DataFrame:
    """The dearest campaigns; their quartile follows from their position and the campaign count."""
    rows = _completed(t).filter(F.col("total_conversions") > 0)
    order = [F.desc("cost_per_acquisition"), F.asc("campaign_code")]
    dear = rows.orderBy(*order).limit(worst).withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
    total = k.value_of(rows.agg(F.count(F.lit(1))))
    return dear.select(
        "campaign_code", "campaign_name", "channel_name", "product_category", "total_budget", "total_conversions",
        "cost_per_acquisition", "channel_benchmark_cpa",
        F.round(F.col("cost_per_acquisition") - F.col("channel_benchmark_cpa"), 2).alias("excess_vs_benchmark"),
        tile_of(F.col("_rn"), total, 4).alias("cpa_quartile"),
    )


def peer_benchmark(t: Tables, min_contacts: int = 300) -> DataFrame:
    peers = Window.partitionBy("campaign_type", "channel_name")
    rows = _completed(t).filter(F.col("total_contacts") >= min_contacts)
    mean = k.ratio(F.sum("conversion_rate_pct").over(peers), F.count("conversion_rate_pct").over(peers))
    return rows.select(
        "campaign_code", "campaign_type", "channel_name", "product_category", "conversion_rate_pct",
        F.round(mean, 2).alias("peer_avg_cvr"), F.round(F.col("conversion_rate_pct") - mean, 2).alias("cvr_vs_peer_avg"),
        F.rank().over(peers.orderBy(F.desc_nulls_last("conversion_rate_pct"))).alias("peer_rank"),
        F.count(F.lit(1)).over(peers).alias("peer_group_size"),
    ).orderBy("campaign_type", "channel_name", "peer_rank")


def kpi_ctr(t: Tables) -> DataFrame:
    """Click-through rate per campaign, with the documented engagement list."""
    by = t.campaign_interactions.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("total_contacts"),
        k.n_if(F.col("interaction_type").isin(k.CLICK_TYPES)).alias("total_engagements"),
    )
    return by.withColumn("ctr_pct", k.pct("total_engagements", "total_contacts"))


def kpi_targets(t: Tables) -> DataFrame:
    """Documented KPI thresholds as flags. A missing rate never meets its target."""
    perf = campaign_performance(t).join(kpi_ctr(t).select("campaign_id", "ctr_pct"), "campaign_id", "left")
    met = lambda cond: F.coalesce(cond, F.lit(False))
    return perf.select(
        "campaign_id", "conversion_rate_pct", "ctr_pct", "optout_rate_pct", "response_rate_pct",
        met(F.col("conversion_rate_pct") >= 15).alias("cvr_target_met"),
        met(F.col("ctr_pct") >= 25).alias("ctr_target_met"),
        met(F.col("response_rate_pct") >= 20).alias("response_target_met"),
        met(F.col("cost_per_acquisition") <= k.CPA_BENCHMARK).alias("cpa_target_met"),
        met(F.col("roi_pct") >= k.ROI_TARGET).alias("roi_target_met"),
        met(F.col("optout_rate_pct") > 2).alias("compliance_review"),
    )


def reach(t: Tables) -> DataFrame:
    """Distinct customers contacted per campaign; the first step removes repeats per (campaign, customer)."""
    pairs = t.campaign_interactions.select("campaign_id", "customer_id").distinct()
    return pairs.groupBy("campaign_id").agg(F.count("customer_id").alias("customers_reached"))


def funnel_campaign(t: Tables) -> DataFrame:
    """Five-stage distinct-customer funnel per completed campaign.

    Every stage is a flag on the (campaign, customer) pair, so one aggregation over the facts
    replaces a distinct count per stage.
    """
    pair = t.campaign_interactions.groupBy("campaign_id", "customer_id").agg(
        F.max(F.when(F.col("interaction_type").isin(k.ENGAGED_TYPES), 1).otherwise(0)).alias("engaged"),
        F.max(F.when(k.responded(), 1).otherwise(0)).alias("responded"),
        F.max(F.when(k.outcome_is("Converted"), 1).otherwise(0)).alias("converted"),
    )
    touched = pair.groupBy("campaign_id").agg(
        F.count("customer_id").alias("s1"), F.sum("engaged").alias("s2"),
        F.sum("responded").alias("s3"), F.sum("converted").alias("s4"),
    )
    active = (
        t.customer_products.filter((F.col("status") == "Active") & F.col("campaign_id").isNotNull())
        .select("campaign_id", "customer_id").distinct()
        .groupBy("campaign_id").agg(F.count("customer_id").alias("s5"))
    )
    rows = t.campaign_dim().filter(F.col("status") == "Completed").join(touched, "campaign_id", "left").join(
        active, "campaign_id", "left")
    names = ["stage_1_contacted", "stage_2_engaged", "stage_3_responded", "stage_4_converted", "stage_5_activated"]
    rows = rows.withColumns({n: k.zero(f"s{i}").cast("long") for i, n in enumerate(names, 1)})
    return rows.select(
        "campaign_code", "campaign_name", "channel_name", "product_category", *names,
        *[k.pct(names[i + 1], names[i], 1).alias(f"stage_{i + 1}_to_{i + 2}_pct") for i in range(4)],
        k.pct("stage_4_converted", "stage_1_contacted").alias("end_to_end_cvr_pct"),
    ).orderBy(F.desc_nulls_last("end_to_end_cvr_pct"))
