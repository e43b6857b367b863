"""Customer feature matrix: demographics, recency, frequency, money, holdings, engagement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.operators.revenue import counted_conversions, typed_conversions
from campaignry.plans.ordering import percentiles
from campaignry.schema import CATEGORIES, CONVERSION_TYPES, SEGMENTS
from campaignry.session import cut_lineage
from campaignry.tables import Tables

# The continuous columns that are standardised for clustering.
SCALE_COLUMNS = [
    "age", "log_income", "credit_score", "tenure_days", "recency_days", "log_freq_total", "log_freq_12m",
    "response_rate", "optout_rate", "log_revenue", "n_conversions", "avg_revenue_per_conv", "n_active_products",
    "n_product_categories", "log_product_value", "cross_sell_score", "channels_used", "campaigns_touched",
    "interaction_span_days",
]


def snake(name: str) -> str:
    return name.lower().replace("-", "_").replace(" ", "_")


def quantile_bin(value, edges: list[float]):
    """0-based right-closed bin; repeated edges are dropped, the outer edges only bound the range."""
    inner = sorted(set(edges))[1:-1]
    v = k.col(value).cast("double")
    return F.when(v.isNotNull(), reduce(lambda a, e: a + F.when(v > e, 1).otherwise(0), inner, F.lit(0)))


def demographic(t: Tables) -> DataFrame:
    edges = percentiles(t.customers, "annual_income", [i / 10 for i in range(11)]).get("all", [0.0, 0.0])
    rank = F.create_map(*[F.lit(x) for i, s in enumerate(SEGMENTS, 1) for x in (s, i)])
    return t.customers.select(
        "customer_id", F.col("annual_income").cast("double").alias("annual_income"), "credit_score", "customer_segment",
        "number_of_products", "is_active", "is_dnc", "employment_status", "gender", "region",
        k.years_between(t.today, "date_of_birth").alias("age"),
        F.datediff(t.today, "acquisition_date").alias("tenure_days"),
        F.log1p(F.col("annual_income").cast("double")).alias("log_income"),
        (quantile_bin("annual_income", edges) + 1).alias("income_decile"),
        rank[F.col("customer_segment")].alias("segment_rank"),
    )


def recency(t: Tables) -> DataFrame:
    return t.campaign_interactions.groupBy("customer_id").agg(
        F.datediff(t.today, F.max("interaction_date")).alias("recency_days"))


def _touches(t: Tables) -> DataFrame:
    """Interactions per (customer, campaign): a count of these rows is a distinct count of campaigns."""
    return t.campaign_interactions.groupBy("customer_id", "campaign_id").agg(
        F.count(F.lit(1)).alias("n"), k.n_if(F.col("interaction_date") >= F.date_sub(t.today, 365)).alias("n12"),
        k.n_if(k.responded()).alias("answered"), k.n_if(k.outcome_is("Opted Out")).alias("out"),
        F.min("interaction_date").alias("lo"), F.max("interaction_date").alias("hi"), F.count("ab_variant").alias("ab"),
    )


def _channels_used(t: Tables) -> DataFrame:
    pairs = t.campaign_interactions.select("customer_id", "channel_id").distinct()
    return pairs.groupBy("customer_id").agg(F.count("channel_id").alias("channels_used"))


def _engagement_columns() -> list:
    return [
        F.count("campaign_id").alias("campaigns_touched"),
        F.max(F.when(F.col("ab") > 0, 1).otherwise(0)).alias("ab_participant_flag"),
        F.datediff(F.max("hi"), F.min("lo")).alias("interaction_span_days"),
    ]


def _frequency_columns(total, recent, answered, out) -> dict:
    return {
        "total_interactions": total, "freq_12m": recent, "responded_count": answered, "optout_count": out,
        "response_rate": answered.cast("double") / total, "optout_rate": out.cast("double") / total,
        "log_freq_total": F.log1p(total.cast("double")), "log_freq_12m": F.log1p(recent.cast("double")),
    }


def frequency(t: Tables) -> DataFrame:
    by = t.campaign_interactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), k.n_if(F.col("interaction_date") >= F.date_sub(t.today, 365)).alias("n12"),
        k.n_if(k.responded()).alias("answered"), k.n_if(k.outcome_is("Opted Out")).alias("out"))
    cols = _frequency_columns(*[F.col(c) for c in ("n", "n12", "answered", "out")])
    return by.select("customer_id", *[c.alias(n) for n, c in cols.items()])


def engagement(t: Tables) -> DataFrame:
    return _touches(t).groupBy("customer_id").agg(*_engagement_columns()).join(_channels_used(t), "customer_id")


def interaction_features(t: Tables) -> DataFrame:
    """Recency, frequency and engagement; both distinct counts work on pairs, so no row is multiplied."""
    by = _touches(t).groupBy("customer_id").agg(
        F.sum("n").alias("n"), F.sum("n12").alias("n12"), F.sum("answered").alias("answered"), F.sum("out").alias("out"),
        F.datediff(t.today, F.max("hi")).alias("recency_days"), *_engagement_columns())
    cols = _frequency_columns(*[F.col(c) for c in ("n", "n12", "answered", "out")])
    return by.join(_channels_used(t), "customer_id").select(
        "customer_id", "recency_days", *[c.alias(n) for n, c in cols.items()], "channels_used", "campaigns_touched",
        "ab_participant_flag", "interaction_span_days")


def monetary(t: Tables) -> DataFrame:
    per_product = typed_conversions(t).groupBy("customer_id", "product_id").agg(
        F.sum("revenue_attributed").alias("s"), F.count(F.lit(1)).alias("n"), F.max("revenue_attributed").alias("m"),
        *[k.n_if(F.col("conversion_type") == c).alias(f"conv_{snake(c)}") for c in CONVERSION_TYPES])
    kinds = [f"conv_{snake(c)}" for c in CONVERSION_TYPES]
    by = per_product.groupBy("customer_id").agg(
        F.sum("s").cast("double").alias("total_revenue"), F.sum("n").alias("n_conversions"),
        F.max("m").cast("double").alias("max_single_conversion"), F.count("product_id").alias("n_distinct_products_bought"),
        *[F.sum(c).alias(c) for c in kinds])
    return by.withColumns({
        "avg_revenue_per_conv": F.col("total_revenue") / F.col("n_conversions"), "log_revenue": F.log1p("total_revenue")})


def product(t: Tables) -> DataFrame:
    per_category = t.customer_products.filter(F.col("status") == "Active").join(t.product_category(), "product_id").groupBy(
        "customer_id", "product_category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("product_value").alias("s"), F.count("product_value").alias("nv"),
        F.max("product_value").alias("m"))
    by = per_category.groupBy("customer_id").agg(
        F.sum("n").alias("n_active_products"), F.count("product_category").alias("n_product_categories"),
        F.sum("s").cast("double").alias("total_product_value"),
        (F.sum("s").cast("double") / F.sum("nv")).alias("avg_product_value"), F.max("m").cast("double").alias("max_product_value"),
        *[F.max(F.when(F.col("product_category") == c, 1).otherwise(0)).alias(f"has_{snake(c)}") for c in CATEGORIES])
    return by.withColumns({
        "log_product_value": F.log1p("total_product_value"),
        "is_multi_product": F.when(F.col("n_active_products") >= 2, 1).otherwise(0),
        "cross_sell_score": F.col("n_product_categories").cast("double") / len(CATEGORIES)})


def build_feature_matrix(t: Tables) -> DataFrame:
    """One row per customer; no touch means recency = tenure, any other missing number is 0.

    Text columns keep their NULLs. The rows are cut once, since scaling, scoring and clustering all
    start from them.
    """
    if "features" not in t._memo:
        feat = (
            demographic(t).join(interaction_features(t), "customer_id", "left").join(monetary(t), "customer_id", "left")
            .join(product(t), "customer_id", "left")
            .withColumn("recency_days", F.coalesce("recency_days", "tenure_days")).fillna(0)
        )
        t._memo["features"] = cut_lineage(feat)
    return t._memo["features"]


def scoring_inputs(t: Tables, holdings: bool = False) -> DataFrame:
    """The columns of the feature matrix that the RFM score and its profiles read, one row per customer.

    A matrix already cut is taken as it is. Otherwise the facts are aggregated for these columns alone: no pairs of
    customer and campaign or channel, no conversion types, and holdings only when asked for.
    """
    if "features" in t._memo:
        return t._memo["features"]
    touches = t.campaign_interactions.groupBy("customer_id").agg(
        F.datediff(t.today, F.max("interaction_date")).alias("recency_days"),
        k.n_if(F.col("interaction_date") >= F.date_sub(t.today, 365)).alias("freq_12m"))
    money = counted_conversions(t).groupBy("customer_id").agg(F.sum("revenue_attributed").cast("double").alias("total_revenue"))
    rows = t.customers.select(
        "customer_id", F.col("annual_income").cast("double").alias("annual_income"), "credit_score", "customer_segment",
        F.datediff(t.today, "acquisition_date").alias("tenure_days"),
    ).join(touches, "customer_id", "left").join(money, "customer_id", "left")
    if holdings:
        active = t.customer_products.filter(F.col("status") == "Active").join(t.product_category().select("product_id"), "product_id")
        rows = rows.join(active.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_active_products")), "customer_id", "left")
    return cut_lineage(rows.withColumn("recency_days", F.coalesce("recency_days", "tenure_days")).drop("tenure_days").fillna(0))


def scale_features(t: Tables) -> DataFrame:
    """Zero mean and unit population deviation; constant columns become 0."""
    feat = build_feature_matrix(t)
    stats = feat.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in SCALE_COLUMNS],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in SCALE_COLUMNS]).first()
    scaled = lambda c: (F.col(c).cast("double") - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)
    return feat.select("customer_id", *[scaled(c).alias(c) for c in SCALE_COLUMNS])
