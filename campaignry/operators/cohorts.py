"""Acquisition cohorts: first conversion, revenue and product penetration by age."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.schema import CATEGORIES
from campaignry.tables import Tables


def cohort_members(t: Tables) -> DataFrame:
    return t.customers.filter("is_active").select("customer_id", k.month_of("acquisition_date").alias("cohort_start"))


def cohort_assign(t: Tables) -> DataFrame:
    """Cohort sizes; customer ids are distinct per cohort before they are counted."""
    return cohort_members(t).distinct().groupBy("cohort_start").agg(F.count("customer_id").alias("cohort_size"))


def _age(later) -> object:
    return k.month_index(later) - k.month_index("cohort_start")


def cohort_conversion(t: Tables) -> DataFrame:
    first = t.campaign_conversions.groupBy("customer_id").agg(F.min("conversion_date").alias("first_date"))
    rows = cohort_members(t).join(first, "customer_id", "left").withColumn("age", _age("first_date"))
    age = F.col("age")
    buckets = {
        "month_0_pct": age == 0, "month_1_pct": age == 1, "month_2_pct": age == 2, "month_3_pct": age == 3,
        "months_4_to_6_pct": age.between(4, 6), "month_7_plus_pct": age > 6,
        "ever_converted_pct": F.col("first_date").isNotNull(), "never_converted_pct": F.col("first_date").isNull(),
    }
    by = rows.groupBy("cohort_start").agg(
        F.count("customer_id").alias("cohort_size"), *[k.n_if(c).alias(n) for n, c in buckets.items()])
    return by.select(k.month_key("cohort_start").alias("cohort_month"), "cohort_size",
                     *[k.pct(n, "cohort_size", 1).alias(n) for n in buckets]).orderBy("cohort_month")


def cohort_revenue(t: Tables) -> DataFrame:
    """Revenue is first summed per customer and month, so one busy customer is one short group."""
    spent = t.campaign_conversions.groupBy("customer_id", k.month_of("conversion_date").alias("m")).agg(
        F.sum("revenue_attributed").alias("revenue"))
    rows = spent.join(cohort_members(t), "customer_id").withColumn("age", _age("m"))
    age = F.col("age")
    buckets = {
        "revenue_per_member_month_0": age == 0, "revenue_per_member_month_1": age == 1,
        "revenue_per_member_month_2": age == 2, "revenue_per_member_months_3_5": age.between(3, 5),
        "revenue_per_member_months_6_11": age.between(6, 11), "revenue_per_member_months_12_plus": age >= 12,
        "lifetime_revenue_per_member": F.lit(True),
    }
    by = rows.groupBy("cohort_start").agg(*[F.sum(F.when(c, F.col("revenue"))).alias(n) for n, c in buckets.items()])
    return by.join(cohort_assign(t), "cohort_start").select(
        k.month_key("cohort_start").alias("cohort_month"), "cohort_size",
        *[k.ratio(n, "cohort_size", 0).alias(n) for n in buckets]).orderBy("cohort_month")


def cohort_penetration(t: Tables) -> DataFrame:
    held = t.customer_products.filter(F.col("status") == "Active").join(t.product_category(), "product_id").groupBy(
        "customer_id", "product_category").agg(F.count(F.lit(1)).alias("n"))
    rows = held.join(cohort_members(t), "customer_id")
    name = lambda c: f"{c.lower().replace(' ', '_')}_pct"
    by = rows.groupBy("cohort_start").agg(
        *[k.n_if(F.col("product_category") == c).alias(name(c)) for c in CATEGORIES], F.sum("n").alias("held"))
    return by.join(cohort_assign(t), "cohort_start").select(
        k.month_key("cohort_start").alias("cohort_month"), "cohort_size",
        *[k.pct(name(c), "cohort_size", 1).alias(name(c)) for c in CATEGORIES],
        k.ratio("held", "cohort_size", 2).alias("avg_products_per_customer")).orderBy("cohort_month")
