"""Monthly trend view, quarter trend and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.tables import Tables


def _month_windows():
    """Unpartitioned on purpose: these run over one row per calendar month."""
    time = Window.orderBy("month_start")
    return time, time.rowsBetween(Window.unboundedPreceding, Window.currentRow), time.rowsBetween(-2, Window.currentRow)


def monthly_base(interactions: DataFrame) -> DataFrame:
    """Month counts with distinct customers and campaigns, via (month, customer) and (month, campaign)."""
    dated = interactions.withColumn("month_start", k.month_of("interaction_date"))
    by_customer = dated.groupBy("month_start", "customer_id").agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("conversions"),
        k.n_if(k.responded()).alias("responses"), k.n_if(k.outcome_is("Opted Out")).alias("optouts"),
    )
    totals = by_customer.groupBy("month_start").agg(
        F.sum("contacts").alias("total_contacts"), F.sum("conversions").alias("total_conversions"),
        F.sum("responses").alias("total_responses"), F.sum("optouts").alias("total_optouts"),
        F.count("customer_id").alias("unique_customers_contacted"),
    )
    live = dated.select("month_start", "campaign_id").distinct().groupBy("month_start").agg(
        F.count("campaign_id").alias("active_campaigns"))
    m = F.col("month_start")
    return totals.join(live, "month_start").select(
        "month_start", k.month_key(m).alias("month_key"), k.month_label(m).alias("month_label"),
        F.year(m).alias("year_num"), F.quarter(m).alias("quarter_num"), F.month(m).alias("month_num"),
        "total_contacts", "total_conversions", "total_responses", "total_optouts",
        "unique_customers_contacted", "active_campaigns",
    )


def monthly_revenue(conversions: DataFrame) -> DataFrame:
    return conversions.groupBy(k.month_of("conversion_date").alias("month_start")).agg(
        F.sum("revenue_attributed").alias("total_revenue"), F.count(F.lit(1)).alias("conversion_count"),
    ).withColumn("avg_revenue_per_conversion", k.over("total_revenue", "conversion_count"))


def monthly_budget(campaigns: DataFrame) -> DataFrame:
    """Budget per touched month: daily budget times the days of the whole month."""
    touched = campaigns.select(
        "total_budget", F.greatest(F.datediff("end_date", "start_date") + 1, F.lit(1)).alias("days"),
        F.explode(F.sequence(k.month_of("start_date"), k.month_of("end_date"), F.expr("INTERVAL 1 MONTH"))).alias(
            "month_start"),
    )
    daily = F.col("total_budget").cast("double") / F.col("days")
    return touched.groupBy("month_start").agg(
        F.round(F.sum(daily * F.dayofmonth(F.last_day("month_start"))), 4).alias("apportioned_budget"))


def monthly_combined(t: Tables) -> DataFrame:
    rows = (
        monthly_base(t.campaign_interactions)
        .join(monthly_revenue(t.campaign_conversions).drop("conversion_count"), "month_start", "left")
        .join(monthly_budget(t.campaigns), "month_start", "left")
    )
    return rows.withColumns({
        "total_revenue": F.coalesce("total_revenue", F.lit(0).cast("decimal(25,2)")),
        "avg_revenue_per_conversion": F.coalesce("avg_revenue_per_conversion", F.lit(0.0)),
        "apportioned_budget": F.coalesce("apportioned_budget", F.lit(0.0)),
        "conversion_rate_pct": k.pct("total_conversions", "total_contacts"),
        "response_rate_pct": k.pct("total_responses", "total_contacts"),
        "optout_rate_pct": k.pct("total_optouts", "total_contacts"),
    })


def monthly_trends(t: Tables) -> DataFrame:
    """Month KPIs with month-on-month, year-on-year (12 rows back), cumulative, rolling and rank columns."""
    time, to_date, last_3 = _month_windows()
    conv, rev, cvr = F.col("total_conversions"), F.col("total_revenue"), F.col("conversion_rate_pct")
    prev, prev_rev, last_year = F.lag(conv).over(time), F.lag(rev).over(time), F.lag(conv, 12).over(time)
    in_year = Window.partitionBy("year_num")
    return monthly_combined(t).withColumns({
        "conversions_mom_change": conv - prev,
        "conversions_mom_pct_change": k.ratio((conv - prev) * 100, prev, 1),
        "revenue_mom_change": F.round(rev - prev_rev, 0),
        "revenue_mom_pct_change": k.ratio((rev - prev_rev) * 100, prev_rev, 1),
        "cvr_mom_pp_change": F.round(cvr - F.lag(cvr).over(time), 2),
        "conversions_same_month_ly": last_year,
        "conversions_yoy_pct_change": k.ratio((conv - last_year) * 100, last_year, 1),
        "cumulative_conversions": F.sum(conv).over(to_date),
        "cumulative_revenue": F.round(F.sum(rev).over(to_date), 0),
        "conversions_3m_avg": k.ratio(F.sum(conv).over(last_3), F.count(conv).over(last_3), 1),
        "cvr_3m_avg": k.ratio(F.sum(cvr).over(last_3), F.count(cvr).over(last_3), 2),
        "rank_by_conversions_in_year": F.rank().over(in_year.orderBy(conv.desc())),
        "rank_by_revenue_in_year": F.rank().over(in_year.orderBy(rev.desc())),
    }).orderBy("month_start")


def cvr_trend(t: Tables) -> DataFrame:
    time, _, last_3 = _month_windows()
    cvr = F.col("conversion_rate_pct")
    mean = k.ratio(F.sum(cvr).over(last_3), F.count(cvr).over(last_3))
    base = monthly_base(t.campaign_interactions).withColumn(
        "conversion_rate_pct", k.pct("total_conversions", "total_contacts"))
    return base.select(
        "month_start", "month_label", "total_contacts", "total_conversions", "conversion_rate_pct",
        F.round(mean, 2).alias("cvr_3m_rolling_avg"),
        F.round(cvr - F.lag(cvr, 1).over(time), 2).alias("cvr_mom_pp_change"),
        F.when(cvr >= mean, "Above Trend").otherwise("Below Trend").alias("trend_position"),
    ).orderBy("month_start")


def trend_qoq(t: Tables) -> DataFrame:
    by = t.campaign_interactions.groupBy(F.trunc("interaction_date", "quarter").alias("quarter_start")).agg(
        F.count(F.lit(1)).alias("total_contacts"), k.n_if(k.outcome_is("Converted")).alias("total_conversions"))
    rev = t.campaign_conversions.groupBy(F.trunc("conversion_date", "quarter").alias("quarter_start")).agg(
        F.sum("revenue_attributed").alias("rev"))
    rows = by.join(rev, "quarter_start", "left").withColumn(
        "total_revenue", F.coalesce("rev", F.lit(0).cast("decimal(25,2)"))).drop("rev")
    w = Window.orderBy("quarter_start")
    prev, prev_rev = F.lag("total_conversions").over(w), F.lag("total_revenue").over(w)
    return rows.withColumns({
        "conversions_qoq_pct": k.ratio((F.col("total_conversions") - prev) * 100, prev, 1),
        "revenue_qoq_pct": k.ratio((F.col("total_revenue") - prev_rev) * 100, prev_rev, 1),
    })


def dim_date(t: Tables) -> DataFrame:
    """Calendar from the first to the last interaction or conversion day."""
    days = t.campaign_interactions.select(F.col("interaction_date").alias("d")).unionByName(
        t.campaign_conversions.select(F.col("conversion_date").alias("d")))
    span = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    d = F.col("date_key")
    return span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date_key")).select(
        "date_key", F.year(d).alias("year_num"), F.quarter(d).alias("quarter_num"), F.month(d).alias("month_num"),
        F.dayofmonth(d).alias("day_num"), (F.dayofweek(d) - 1).alias("day_of_week"), k.month_key(d).alias("month_key"),
        F.weekday(d).isin(5, 6).alias("is_weekend"),
    )
