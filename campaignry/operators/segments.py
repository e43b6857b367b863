"""Recency / frequency / monetary segments of the customer base and the lists drawn from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.functions import rules
from campaignry.plans.ordering import SortedRuns, after_keys, long_frame, percentiles, tile_ends, tile_of
from campaignry.session import cut_lineage, local_frame
from campaignry.tables import Tables

NEVER = 9999


def interaction_summary(t: Tables) -> DataFrame:
    """Last touch, all-time count and 12-month counts per customer in one pass."""
    recent = F.col("interaction_date") >= F.add_months(t.today, -12)
    return t.campaign_interactions.groupBy("customer_id").agg(
        F.max("interaction_date").alias("last_interaction_date"),
        F.count(F.lit(1)).alias("total_interactions_all_time"),
        k.n_if(recent).alias("interactions_last_12m"),
        k.n_if(recent & k.outcome_is("Converted")).alias("conversions_last_12m"),
    )


def holding_summary(t: Tables) -> DataFrame:
    active = F.col("status") == "Active"
    return t.customer_products.groupBy("customer_id").agg(
        k.n_if(active).alias("active_products"), F.count(F.lit(1)).alias("total_products_ever"),
        F.sum(F.when(active, F.col("product_value"))).alias("total_balance"),
    )


def revenue_summary(t: Tables) -> DataFrame:
    return t.campaign_conversions.groupBy("customer_id").agg(
        F.sum("revenue_attributed").alias("total_revenue"), F.count(F.lit(1)).alias("total_conversions"))


def rfm_inputs(t: Tables) -> DataFrame:
    """Per-customer aggregates of the three fact tables side by side."""
    return interaction_summary(t).join(revenue_summary(t), "customer_id", "full").join(
        holding_summary(t), "customer_id", "full")


def rfm_combine(t: Tables) -> DataFrame:
    """Active customers with gaps filled: 9999 days if never touched, zeros elsewhere.

    The aggregates leave their shuffle partitioned by customer, so only the customer table moves
    for the three joins.
    """
    none = F.lit(0).cast("decimal(25,2)")
    rows = t.customers.filter("is_active")
    for facts in (interaction_summary(t), revenue_summary(t), holding_summary(t)):
        rows = rows.join(facts, "customer_id", "left")
    return rows.select(
        "customer_id", "customer_code", "first_name", "last_name", "customer_segment", "region", "annual_income",
        "credit_score", "acquisition_date", "is_dnc", "last_interaction_date",
        F.coalesce(F.datediff(t.today, "last_interaction_date"), F.lit(NEVER)).alias("recency_days"),
        k.zero("interactions_last_12m").alias("interactions_last_12m"),
        k.zero("conversions_last_12m").alias("conversions_last_12m"), "total_interactions_all_time",
        F.coalesce("total_revenue", none).alias("total_revenue_attributed"),
        k.zero("total_conversions").alias("total_conversions"), k.zero("active_products").alias("active_products"),
        k.zero("total_products_ever").alias("total_products_ever"),
        F.coalesce("total_balance", none).alias("total_product_balance"),
    )


def quintiles(base: DataFrame, metrics: dict[str, Column], tiles: int = 5) -> dict[str, Column]:
    """NTILE per metric, ties broken by customer id, without sending all customers to one task.

    One range sort of all metrics finds the last key of each tile; a row's tile is then the number
    of such keys before it, which needs no join and no window.
    """
    rows = long_frame(base, metrics, keep=["customer_id"])
    with SortedRuns(rows, tie="customer_id") as runs:
        ends = {m: tile_ends(runs.size(m), tiles) for m in metrics}
        keys = runs.pick({m: [r for r in e if r > 0] for m, e in ends.items()})
    return {
        m: after_keys(c, F.col("customer_id"), [keys[(m, r)] for r in ends[m] if r > 0])
        + 1
        for m, c in metrics.items()
    }


def customer_segments(t: Tables) -> DataFrame:
    """RFM quintiles, label and targeting recommendation of every active customer.

    The customer rows are cut once: the three fact aggregations behind them are not repeated for
    the sort and the final projection.
    """
    if "customer_segments" in t._memo:
        return t._memo["customer_segments"]
    base = cut_lineage(rfm_combine(t))
    tiles = quintiles(base, {
        "r": F.col("recency_days"), "f": F.col("interactions_last_12m"), "m": F.col("total_revenue_attributed")})
    scored = base.withColumns({"r_score": F.lit(6) - tiles["r"], "f_score": tiles["f"], "m_score": tiles["m"]})
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    out = scored.withColumns({
        "rfm_score": r * 100 + f * 10 + m,
        "rfm_segment": rules.first_match(rules.QUINTILE_LABELS, rules.QUINTILE_OTHER, r, f, m),
        "targeting_recommendation": F.when(F.col("is_dnc"), rules.ACTION_BANNED).otherwise(
            rules.first_match(rules.ACTIONS, rules.ACTION_OTHER, r, f, m)),
    })
    t._memo["customer_segments"] = out
    return out


def top_customers(t: Tables, top: int = 20) -> DataFrame:
    """Rank and decile of the top rows follow from their position and the customer count."""
    rows = customer_segments(t).filter(~F.col("is_dnc"))
    order = [F.desc_nulls_last("total_revenue_attributed"), F.asc("customer_id")]
    best = rows.orderBy(*order).limit(top).withColumns({
        "revenue_rank": F.rank().over(Window.orderBy(F.desc("total_revenue_attributed"))),
        "_rn": F.row_number().over(Window.orderBy(*order)),
    })
    total = k.value_of(rows.agg(F.count(F.lit(1))))
    return best.select(
        "customer_code", F.concat_ws(" ", "first_name", "last_name").alias("customer_name"), "customer_segment",
        "region", "annual_income", "total_revenue_attributed", "total_conversions", "active_products", "rfm_segment",
        "revenue_rank", tile_of(F.col("_rn"), total, 10).alias("revenue_decile"),
    )


def segment_percentiles(t: Tables) -> DataFrame:
    """Exact revenue percentiles of paying customers per segment, from one range sort."""
    rows = customer_segments(t).filter("total_revenue_attributed > 0")
    found = percentiles(rows, "total_revenue_attributed", [0.25, 0.5, 0.75, 0.9], group="customer_segment")
    frame = local_frame(t.spark, [(g, *v) for g, v in sorted(found.items())],
        "customer_segment string, p25 double, p50 double, p75 double, p90 double")
    whole = lambda c: F.round(c.cast("decimal(24,6)"), 0)
    return frame.select(
        "customer_segment", whole(F.col("p25")).alias("p25_revenue"), whole(F.col("p50")).alias("median_revenue"),
        whole(F.col("p75")).alias("p75_revenue"), whole(F.col("p90")).alias("p90_revenue"),
        whole(F.col("p90") - F.col("p25")).alias("iqr_spread"),
    ).orderBy(F.desc("median_revenue"))


def multi_responders(t: Tables, min_campaigns: int = 3, top: int = 50) -> DataFrame:
    """Customers who answered several campaigns; distinct campaigns via (customer, campaign) pairs."""
    pairs = (
        t.campaign_interactions
        .filter(k.responded() & (F.col("interaction_outcome") != "Opted Out"))
        .groupBy("customer_id", "campaign_id").agg(
            F.max(F.when(k.outcome_is("Converted"), 1).otherwise(0)).alias("won"),
            F.min("interaction_date").alias("lo"), F.max("interaction_date").alias("hi"))
    )
    who = pairs.groupBy("customer_id").agg(
        F.count("campaign_id").alias("campaigns_responded"), F.sum("won").alias("campaigns_converted"),
        F.min("lo").alias("first_interaction"), F.max("hi").alias("last_interaction"),
    ).filter(F.col("campaigns_responded") >= min_campaigns)
    seg = customer_segments(t).select("customer_id", "customer_segment", "region", "rfm_segment",
                                      "total_revenue_attributed")
    return who.join(seg, "customer_id").orderBy(
        F.desc("campaigns_converted"), F.desc("total_revenue_attributed"), "customer_id").limit(top).select(
        "customer_id", "customer_segment", "region", "campaigns_responded", "campaigns_converted", "first_interaction",
        "last_interaction", F.datediff("last_interaction", "first_interaction").alias("active_span_days"),
        k.pct("campaigns_converted", "campaigns_responded", 1).alias("personal_cvr_pct"),
        "rfm_segment", "total_revenue_attributed",
    )


def warm_leads(t: Tables, top: int = 100) -> DataFrame:
    pairs = t.campaign_interactions.filter(F.col("interaction_outcome").isin(k.WARM)).groupBy(
        "customer_id", "campaign_id").agg(F.max("interaction_date").alias("hi"))
    warm = pairs.groupBy("customer_id").agg(
        F.max("hi").alias("latest_warm_interaction"), F.count("campaign_id").alias("warm_campaign_count"))
    seg = customer_segments(t).filter((F.col("active_products") == 1) & ~F.col("is_dnc"))
    return warm.join(seg, "customer_id").withColumn(
        "days_since_warm_lead", F.datediff(t.today, "latest_warm_interaction")
    ).orderBy("days_since_warm_lead", "customer_id").limit(top).select(
        "customer_code", "customer_segment", "region", "annual_income", "active_products", "latest_warm_interaction",
        "warm_campaign_count", "rfm_segment", "targeting_recommendation", "days_since_warm_lead",
    )


def engagement(t: Tables) -> DataFrame:
    """Distinct campaigns and silent / opt-out row counts per customer."""
    pairs = t.campaign_interactions.groupBy("customer_id", "campaign_id").agg(
        k.n_if(k.outcome_is("No Response")).alias("silent"), k.n_if(k.outcome_is("Opted Out")).alias("optout"),
        F.max("interaction_date").alias("hi"))
    return pairs.groupBy("customer_id").agg(
        F.count("campaign_id").alias("total_campaigns"), F.sum("silent").alias("no_response_count"),
        F.sum("optout").alias("optout_count"), F.max("hi").alias("last_contact_date"),
        k.n_if(F.col("silent") > 0).alias("silent_campaigns"),
    )


def churn_risk(t: Tables, min_campaigns: int = 3) -> DataFrame:
    """Silent rows are compared with distinct campaigns, as in the source queries."""
    seen = engagement(t).filter(F.col("total_campaigns") >= min_campaigns)
    held = holding_summary(t).select("customer_id", "active_products")
    silent, total = F.col("no_response_count"), F.col("total_campaigns")
    return seen.join(t.customers.filter("is_active"), "customer_id").join(held, "customer_id", "left").select(
        "customer_code", "customer_segment", "annual_income", "acquisition_date", "total_campaigns",
        "no_response_count", "optout_count", "last_contact_date",
        F.datediff(t.today, "last_contact_date").alias("days_since_last_contact"),
        k.pct("no_response_count", "total_campaigns", 1).alias("non_response_rate_pct"), "active_products",
        F.when(F.col("optout_count") > 0, "High Risk — Opted Out")
        .when(silent == total, "High Risk — Never Responded")
        .when(silent * 10 > total * 7, "Medium Risk").otherwise("Low Risk").alias("churn_risk_label"),
    )


def churn_kpi(t: Tables, min_campaigns: int = 3) -> DataFrame:
    """Share of contacted customers who stayed silent in at least three campaigns."""
    return engagement(t).agg(
        F.count(F.lit(1)).alias("customers"),
        k.n_if(F.col("silent_campaigns") >= min_campaigns).alias("silent_customers"),
    ).withColumn("churn_risk_pct", k.pct("silent_customers", "customers"))
