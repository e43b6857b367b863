"""Revenue attribution at conversion grain, conversion typing and first touch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.plans.ordering import running_sums
from campaignry.tables import Tables


def derive_conversions(t: Tables) -> DataFrame:
    """Converted interactions with the campaign's product and its standard revenue."""
    won = t.campaign_interactions.filter(k.outcome_is("Converted"))
    dim = t.campaign_dim().select("campaign_id", "product_id", "product_category", "revenue_value")
    return won.join(dim, "campaign_id").select(
        "interaction_id", "campaign_id", "customer_id", "product_id", "channel_id",
        F.coalesce("response_date", "interaction_date").alias("conversion_date"),
        F.col("revenue_value").alias("revenue_attributed"), "ab_variant",
    )


def conversion_type(t: Tables) -> DataFrame:
    """New / Upsell / Cross-Sell per conversion, in each customer's order of response.

    A conversion is New if it is the customer's first, Cross-Sell if it is the first of its
    category, Upsell otherwise. The firsts are minima, combined map-side, and are matched back on
    the unique interaction id, so a customer with very many conversions is never sorted in one task.
    """
    dim = t.campaign_dim().select("campaign_id", "product_category")
    won = t.campaign_interactions.filter(k.outcome_is("Converted")).join(dim, "campaign_id")
    position = F.struct(
        F.col("response_date").isNull().alias("late"), F.col("response_date").alias("r"),
        F.col("interaction_date").alias("d"), F.col("interaction_id").alias("id"),
    )
    first_in_category = won.groupBy("customer_id", "product_category").agg(F.min(position).alias("p"))
    first_of_customer = first_in_category.groupBy("customer_id").agg(F.min("p").alias("q"))
    firsts = first_in_category.join(first_of_customer, "customer_id").select(
        F.col("p.id").alias("interaction_id"), (F.col("p.id") == F.col("q.id")).alias("is_first"))
    return won.select("interaction_id", "customer_id", "product_category").join(firsts, "interaction_id", "left").select(
        "interaction_id", "customer_id", "product_category",
        F.when(F.col("is_first").isNull(), "Upsell").when(F.col("is_first"), "New").otherwise("Cross-Sell").alias(
            "conversion_type"),
    )


def typed_conversions(t: Tables) -> DataFrame:
    """Conversions with their type; derived only if the table does not hold it."""
    if "conversion_type" in t.campaign_conversions.columns:
        return t.campaign_conversions
    kinds = conversion_type(t).select("interaction_id", "conversion_type")
    return t.campaign_conversions.join(kinds, "interaction_id", "left")


def counted_conversions(t: Tables) -> DataFrame:
    """Conversions without their type, each as often as ``typed_conversions`` holds it.

    Matching the types repeats a conversion only if its interaction id was won more than once, so without such ids
    the types are not derived.
    """
    if "conversion_type" in t.campaign_conversions.columns:
        return t.campaign_conversions
    won = t.campaign_interactions.filter(k.outcome_is("Converted") & F.col("interaction_id").isNotNull())
    times = won.join(t.campaign_dim().select("campaign_id"), "campaign_id").groupBy("interaction_id").agg(F.count(F.lit(1)).alias("n"))
    most = times.agg(F.max("n").alias("n")).first()["n"]
    return t.campaign_conversions if most is None or most == 1 else typed_conversions(t)


def conversion_dates(conversions: DataFrame) -> DataFrame:
    d = F.col("conversion_date")
    return conversions.withColumns({
        "conversion_year": F.year(d), "conversion_quarter": F.quarter(d),
        "conversion_quarter_label": k.quarter_label(d), "conversion_month": k.month_key(d),
        "conversion_month_label": k.month_label(d), "conversion_day_of_week": F.dayofweek(d) - 1,
        "conversion_day_name": F.rpad(F.date_format(d, "EEEE"), 9, " "),
    })


def revenue_roi(t: Tables) -> DataFrame:
    conv = conversion_dates(typed_conversions(t)).drop("channel_name")
    camp = t.campaign_dim().select(
        "campaign_id", "campaign_code", "campaign_name", "campaign_type", F.col("total_budget").alias("campaign_budget"),
        F.col("start_date").alias("campaign_start_date"), F.col("end_date").alias("campaign_end_date"))
    prod = t.product_dim().select("product_id", "product_name", "product_category",
                             F.col("revenue_value").alias("product_standard_revenue"))
    chan = t.channel_dim().select("channel_id", "channel_name", "benchmark_cpa")
    cust = t.customers.select("customer_id", "customer_segment", "region",
                              F.col("annual_income").alias("customer_annual_income"),
                              F.col("credit_score").alias("customer_credit_score"))
    rows = conv.join(camp, "campaign_id").join(prod, "product_id").join(chan, "channel_id").join(cust, "customer_id")
    return rows.select(
        "conversion_id", "conversion_date", "conversion_type", "revenue_attributed", "ab_variant",
        "conversion_year", "conversion_quarter", "conversion_quarter_label", "conversion_month",
        "conversion_month_label", "conversion_day_of_week", "conversion_day_name",
        "campaign_id", "campaign_code", "campaign_name", "campaign_type", "campaign_budget", "campaign_start_date",
        "campaign_end_date", "product_id", "product_name", "product_category", "product_standard_revenue",
        "channel_id", "channel_name", "benchmark_cpa", "customer_id", "customer_segment", "region",
        "customer_annual_income", "customer_credit_score",
        F.round(F.col("revenue_attributed") - F.col("product_standard_revenue"), 2).alias("revenue_variance_vs_standard"),
        k.ratio(F.col("revenue_attributed") * 100, "campaign_budget", 4).alias("revenue_as_pct_of_budget"),
    )


def running_revenue(t: Tables) -> DataFrame:
    """Revenue per campaign and conversion day: running total by date, share, cumulative share by size.

    Both running totals go over range partitions; ties on revenue are broken by campaign and day.
    """
    day = t.campaign_conversions.groupBy("campaign_id", "channel_id", "product_id", "conversion_date").agg(
        F.sum("revenue_attributed").alias("campaign_revenue"))
    names = t.campaign_dim().select("campaign_id", "campaign_name")
    rows = (
        day.join(names, "campaign_id").join(t.product_category(), "product_id")
        .join(t.channel_dim().select("channel_id", "channel_name"), "channel_id")
        .groupBy("campaign_id", "campaign_name", "product_category", "channel_name", "conversion_date")
        .agg(F.sum("campaign_revenue").cast("decimal(25,2)").alias("campaign_revenue"))
    )
    unique = ["conversion_date", "campaign_id", "product_category", "channel_name"]
    by_day = running_sums(rows, [F.col(c) for c in unique], {"running_total_revenue": "campaign_revenue"})
    by_size = running_sums(by_day, [F.desc("campaign_revenue"), *[F.col(c) for c in unique]],
                           {"_cumulative": "campaign_revenue"})
    total = k.value_of(by_size.agg(F.sum("campaign_revenue")))
    return by_size.select(
        "campaign_id", "campaign_name", "product_category", "channel_name", "conversion_date", "campaign_revenue",
        "running_total_revenue",
        k.ratio(F.col("campaign_revenue") * 100, total, 2).alias("pct_of_total_revenue"),
        k.ratio(F.col("_cumulative") * 100, total, 2).alias("cumulative_pct_revenue"),
    )


def first_touch(t: Tables) -> DataFrame:
    """Revenue credited to the campaign of the customer's first touch on or before the conversion.

    The first touch of a path is the customer's earliest touch whenever that is not after the
    conversion, so one minimum per customer is enough and no pairs are formed.
    """
    earliest = t.campaign_interactions.groupBy("customer_id").agg(
        F.min(F.struct("interaction_date", "interaction_id", "campaign_id")).alias("touch"))
    per_customer = t.campaign_conversions.groupBy("customer_id", "conversion_date").agg(
        F.sum("revenue_attributed").alias("revenue"), F.count(F.lit(1)).alias("n"))
    paths = per_customer.join(earliest, "customer_id").filter(F.col("touch.interaction_date") <= F.col("conversion_date"))
    return paths.groupBy(F.col("touch.campaign_id").alias("campaign_id")).agg(
        F.sum("n").alias("conversions"), F.sum("revenue").alias("first_touch_revenue"))
