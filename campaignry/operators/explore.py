"""Exploratory aggregates: the data behind the distribution, segment, channel and summary charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry.functions import kpi as k
from campaignry.operators.campaign import outcome_counts
from campaignry.plans.ordering import SortedRuns, percentiles
from campaignry.schema import CATEGORIES
from campaignry.session import cut_lineage, local_frame
from campaignry.tables import Tables

# Band edges (right-closed) and their labels.
AGE_EDGES, AGE_LABELS = [17, 25, 35, 45, 55, 65, 100], ["18–25", "26–35", "36–45", "46–55", "56–65", "65+"]
CREDIT_EDGES = [299, 579, 669, 739, 799, 999]
CREDIT_LABELS = ["Poor 300-579", "Fair 580-669", "Good 670-739", "Very Good 740-799", "Excellent 800+"]
INCOME_LABELS = ["Q1 (Lowest)", "Q2", "Q3", "Q4", "Q5 (Highest)"]


def contacts_by_customer(t: Tables) -> DataFrame:
    """Contacts and conversions per customer: facts shrink to customers before any join."""
    return t.campaign_interactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("conversions"))


def revenue_by_customer(t: Tables) -> DataFrame:
    return t.campaign_conversions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("revenue_attributed").alias("revenue"))


def enrich_lookup(t: Tables) -> DataFrame:
    """Interactions with channel, segment and region names."""
    return (
        t.campaign_interactions.join(t.channel_dim().select("channel_id", "channel_name"), "channel_id", "left")
        .join(t.customers.select("customer_id", "customer_segment", "region"), "customer_id", "left")
        .select("interaction_id", "campaign_id", "customer_id", "channel_name", "customer_segment", "region")
    )


def age_band(t: Tables) -> DataFrame:
    return t.customers.select("customer_id", k.years_between(t.today, "date_of_birth").alias("age")).withColumn(
        "age_band", k.band("age", AGE_EDGES, AGE_LABELS))


# Number of bins per histogram.
BINS = {"age": 30, "log_income": 40, "credit_score": 35, "total_budget": 15, "duration_days": 15, "recency_days": 40,
        "freq_12m": 20, "total_revenue": 40}


def _long(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), c.cast("double").alias("v")) for m, c in metrics.items()])
    return df.select(F.explode(pairs).alias("p")).select("p.metric", "p.v").filter("v IS NOT NULL")


def hist(t: Tables) -> DataFrame:
    """Equal-width histograms; the top edge belongs to the last bin."""
    touch = t.campaign_interactions.groupBy("customer_id").agg(
        F.max("interaction_date").alias("last"),
        k.n_if(F.col("interaction_date") >= F.date_sub(t.today, 365)).alias("freq"))
    values = cut_lineage(reduce(DataFrame.unionByName, [
        _long(t.customers, {"age": k.years_between(t.today, "date_of_birth"), "log_income": F.log1p("annual_income"),
                            "credit_score": F.col("credit_score")}),
        _long(t.campaigns, {"total_budget": F.col("total_budget"),
                            "duration_days": F.datediff("end_date", "start_date")}),
        _long(touch, {"recency_days": F.datediff(t.today, "last"), "freq_12m": F.when(F.col("freq") > 0, F.col("freq"))}),
        _long(revenue_by_customer(t), {"total_revenue": F.when(F.col("revenue") > 0, F.col("revenue"))}),
    ]))
    bins = F.create_map(*[F.lit(x) for kv in BINS.items() for x in kv])[F.col("metric")]
    span = values.groupBy("metric").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("bins", bins)
    at = F.floor((F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * F.col("bins"))
    rows = values.join(F.broadcast(span), "metric")  # one row per metric
    return rows.withColumn("bin", F.least(F.coalesce(at, F.lit(0)), F.col("bins") - 1)).groupBy("metric", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.first(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / F.col("bins")), 6).alias("bin_from"))


def value_counts(t: Tables, top_regions: int = 10) -> DataFrame:
    def counts(df: DataFrame, dimension: str, column: str) -> DataFrame:
        return df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(dimension).alias("dimension"), "value", "n")
    dim = t.campaign_dim()
    return reduce(DataFrame.unionByName, [
        counts(t.customers, "customer_segment", "customer_segment"),
        counts(t.customers, "region", "region").orderBy(F.desc("n"), "value").limit(top_regions),
        counts(t.customers, "employment_status", "employment_status"), counts(dim, "campaign_type", "campaign_type"),
        counts(dim, "campaign_channel", "channel_name"), counts(dim, "campaign_product", "product_category"),
        counts(dim, "campaign_status", "status"),
    ])


def income_by_segment(t: Tables) -> DataFrame:
    """Box statistics of income and credit score per segment: exact quartiles plus the mean."""
    pairs = F.array(*[F.struct(F.concat_ws("|", "customer_segment", F.lit(m)).alias("grp"),
                               F.col(m).cast("decimal(18,4)").alias("val")) for m in ("annual_income", "credit_score")])
    rows = t.customers.select(F.explode(pairs).alias("e")).select("e.grp", "e.val").filter("val IS NOT NULL")
    with SortedRuns(rows) as runs:
        found = runs.percentiles([0.25, 0.5, 0.75])
        stats = runs.rows.groupBy("grp").agg(
            (F.sum((F.col("val") * F.col("_weight")).cast("decimal(38,4)")).cast("double") / F.sum("_weight")).alias("mean"),
            F.sum("_weight").alias("n")).collect()
    return local_frame(t.spark, [(*r["grp"].split("|"), r["n"], r["mean"], *[float(v) for v in found[r["grp"]]]) for r in stats],
        "customer_segment string, metric string, n long, mean double, q1 double, median double, q3 double",
    ).withColumns({c: F.round(c, 4) for c in ("mean", "q1", "median", "q3")})


def _cvr_by(rows: DataFrame, band: Column, name: str) -> DataFrame:
    return rows.withColumn(name, band).filter(F.col(name).isNotNull()).groupBy(name).agg(
        F.sum("contacts").alias("contacts"), F.sum("conversions").alias("conversions")
    ).withColumn("cvr", k.share("conversions", "contacts"))


def cvr_by_age(t: Tables) -> DataFrame:
    rows = contacts_by_customer(t).join(t.customers.select("customer_id", "date_of_birth"), "customer_id")
    return _cvr_by(rows, k.band(k.years_between(t.today, "date_of_birth"), AGE_EDGES, AGE_LABELS), "age_band")


def cvr_by_credit_band(t: Tables) -> DataFrame:
    rows = contacts_by_customer(t).join(t.customers.select("customer_id", "credit_score"), "customer_id")
    return _cvr_by(rows, k.band("credit_score", CREDIT_EDGES, CREDIT_LABELS), "credit_band")


def cvr_by_income_quintile(t: Tables) -> DataFrame:
    """Quintiles over interaction rows: customer incomes weighted by their contacts."""
    rows = cut_lineage(contacts_by_customer(t).join(t.customers.select("customer_id", "annual_income"), "customer_id"))
    edges = percentiles(rows, "annual_income", [0.2, 0.4, 0.6, 0.8], weight="contacts").get("all", [])
    v = F.col("annual_income").cast("double")
    at = reduce(lambda a, e: a + F.when(v > e, 1).otherwise(0), sorted(set(edges)), F.lit(1))
    label = F.element_at(F.array(*[F.lit(x) for x in INCOME_LABELS]), at)
    return _cvr_by(rows, F.when(v.isNotNull(), label), "income_quintile")


def argbest_band(t: Tables) -> DataFrame:
    best = lambda df, dim, col: df.agg(F.max_by(col, F.struct("cvr", col)).alias("band"), F.max("cvr").alias("cvr")).select(
        F.lit(dim).alias("dimension"), "band", "cvr")
    return reduce(DataFrame.unionByName, [
        best(cvr_by_age(t), "age", "age_band"), best(cvr_by_income_quintile(t), "income", "income_quintile"),
        best(cvr_by_credit_band(t), "credit", "credit_band")])


CORR_COLUMNS = ["age", "annual_income", "credit_score", "number_of_products", "total_interactions", "pct_converted"]


def corr_matrix(t: Tables) -> DataFrame:
    """Pearson pairs in one aggregation over complete rows."""
    rows = t.customers.select(
        "customer_id", k.years_between(t.today, "date_of_birth").alias("age"), "annual_income", "credit_score",
        "number_of_products",
    ).join(contacts_by_customer(t).select(
        "customer_id", F.col("contacts").alias("total_interactions"),
        k.share("conversions", "contacts").alias("pct_converted")), "customer_id", "left")
    whole = rows.select(*[F.col(c).cast("double").alias(c) for c in CORR_COLUMNS]).dropna()
    pairs = [(a, b) for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]]
    one = whole.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    items = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"`{a}|{b}`").alias("corr"))
                      for a, b in pairs])
    return one.select(F.explode(items).alias("e")).select("e.col_a", "e.col_b", F.round("e.corr", 6).alias("corr"))


# Campaign and channel frames with unrounded ratios.

def camp_kpi(t: Tables) -> DataFrame:
    counts = outcome_counts(t.campaign_interactions, "campaign_id").select(
        "campaign_id", "total_contacts", "total_conversions", "total_responses", "total_optouts")
    revenue = t.campaign_conversions.groupBy("campaign_id").agg(F.sum("revenue_attributed").alias("r"))
    rows = t.campaign_dim().join(counts, "campaign_id", "left").join(revenue, "campaign_id", "left")
    rows = rows.withColumn("revenue", F.coalesce("r", F.lit(0).cast("decimal(25,2)")))
    return rows.select(
        "campaign_id", "campaign_code", "campaign_type", "status", "channel_name", "product_category", "total_budget",
        "total_contacts", "total_conversions", "total_responses", "total_optouts", "revenue",
        k.share("total_conversions", "total_contacts").alias("cvr"), k.share("total_responses", "total_contacts").alias("rr"),
        k.over("total_budget", "total_conversions").alias("cpa"),
        k.share(F.col("revenue") - F.col("total_budget"), "total_budget").alias("roi_pct"),
        F.datediff("end_date", "start_date").alias("duration"),
    )


def _done(t: Tables) -> DataFrame:
    return camp_kpi(t).filter(F.col("status") == "Completed")


def cvr_by_type(t: Tables) -> DataFrame:
    """Box statistics over campaigns; F.percentile holds at most one value per campaign."""
    rows = _done(t)
    by = rows.groupBy("campaign_type").agg(
        F.count("cvr").alias("n"), F.percentile("cvr", F.lit(0.5)).alias("median_cvr"),
        F.percentile("cvr", F.lit(0.25)).alias("q1_cvr"), F.percentile("cvr", F.lit(0.75)).alias("q3_cvr"))
    out = by.withColumn("overall_mean_cvr", k.value_of(rows.agg(F.avg("cvr"))))
    return out.withColumns({c: F.round(c, 6) for c in ("median_cvr", "q1_cvr", "q3_cvr", "overall_mean_cvr")})


def roi_by_product(t: Tables) -> DataFrame:
    by = _done(t).groupBy("product_category").agg(F.round(F.percentile("roi_pct", F.lit(0.5)), 6).alias("median_roi_pct"))
    m = F.col("median_roi_pct")
    return by.withColumn("roi_band", F.when(m >= 200, "at or above 200").when(m >= 100, "at or above 100").otherwise("below 100"))


def top10_cvr(t: Tables, top: int = 10) -> DataFrame:
    return _done(t).orderBy(F.desc_nulls_last("cvr"), "campaign_code").limit(top).select(
        "campaign_code", "channel_name", "product_category", "cvr")


def channel_cpa(t: Tables) -> DataFrame:
    return _done(t).groupBy("channel_name").agg(
        k.ratio(F.sum("total_budget"), F.sum("total_conversions"), 2).alias("cpa"))


def monthly_cvr(t: Tables) -> DataFrame:
    return t.campaign_interactions.groupBy(k.month_of("interaction_date").alias("month_start")).agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("conversions"),
    ).withColumn("cvr", k.share("conversions", "contacts"))


def channel_stats(t: Tables) -> DataFrame:
    counts = outcome_counts(t.campaign_interactions, "channel_id")
    revenue = t.campaign_conversions.groupBy("channel_id").agg(F.sum("revenue_attributed").alias("revenue"))
    budget = t.campaigns.groupBy("channel_id").agg(F.sum("total_budget").alias("budget"))
    rows = t.channel_dim().select("channel_id", "channel_name").join(counts, "channel_id").join(
        revenue, "channel_id", "left").join(budget, "channel_id", "left")
    return rows.select(
        "channel_name", F.col("total_contacts").alias("contacts"), F.col("total_conversions").alias("conversions"),
        k.share("total_conversions", "total_contacts").alias("cvr"), k.share("total_optouts", "total_contacts").alias("opt_rate"),
        k.share("total_interested", "total_contacts").alias("int_rate"),
        k.share("total_no_response", "total_contacts").alias("nr_rate"), "revenue", "budget",
        k.over("budget", "total_conversions").alias("cpa"),
        k.share(F.col("revenue") - F.col("budget"), "budget").alias("roi_pct"))


def argbest_channel(t: Tables) -> DataFrame:
    return channel_stats(t).agg(
        F.max_by("channel_name", "cvr").alias("best_cvr"), F.max_by("channel_name", "roi_pct").alias("best_roi"),
        F.min_by("channel_name", "cpa").alias("lowest_cpa"))


# Conversion analysis.

def funnel_rows(t: Tables) -> DataFrame:
    seen = t.campaign_interactions.agg(
        F.count(F.lit(1)).alias("s1"), k.n_if(F.col("interaction_type").isin(k.ENGAGED_TYPES)).alias("s2"),
        k.n_if(k.responded()).alias("s3"), k.n_if(k.outcome_is("Converted")).alias("s4"))
    row = seen.withColumn("s5", k.value_of(t.customer_products.agg(k.n_if(F.col("status") == "Active"))))
    stages = ["1. Contacted", "2. Engaged", "3. Responded", "4. Converted", "5. Activated"]
    items = F.array(*[F.struct(
        F.lit(s).alias("stage"), F.col(f"s{i}").alias("n"), k.share(f"s{i}", "s1").alias("pct_of_contacts"),
        (k.share(f"s{i}", f"s{i - 1}") if i > 1 else F.lit(None).cast("double")).alias("pct_of_previous"),
    ) for i, s in enumerate(stages, 1)])
    return row.select(F.explode(items).alias("e")).select("e.*")


def _with_customer(t: Tables, facts: DataFrame, *cols: str) -> DataFrame:
    return facts.join(t.customers.select("customer_id", *cols), "customer_id")


def segment_cvr(t: Tables) -> DataFrame:
    return _cvr_by(_with_customer(t, contacts_by_customer(t), F.col("customer_segment").alias("s")),
                   F.col("s"), "customer_segment")


def segment_product_mix(t: Tables) -> DataFrame:
    per = t.campaign_conversions.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("n"))
    rows = _with_customer(t, per.join(t.product_category(), "product_id"), "customer_segment")
    wide = rows.groupBy("customer_segment").pivot("product_category", CATEGORIES).agg(F.sum("n")).fillna(0)
    return wide.select("customer_segment", *[F.col(f"`{c}`").alias(c.lower().replace(" ", "_")) for c in CATEGORIES])


def segment_revenue(t: Tables) -> DataFrame:
    return _with_customer(t, revenue_by_customer(t), "customer_segment").groupBy("customer_segment").agg(
        (F.sum("revenue").cast("double") / 1_000_000).alias("revenue_m"))


def products_held_dist(t: Tables) -> DataFrame:
    """Holders by number of active products; the last column takes all of five and more, so no holder is lost."""
    held = t.customer_products.filter(F.col("status") == "Active").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_products"))
    wide = _with_customer(t, held, "customer_segment").groupBy("customer_segment").agg(
        *[k.n_if(F.col("n_products") == i).alias(f"products_{i}") for i in (1, 2, 3, 4)],
        k.n_if(F.col("n_products") >= 5).alias("products_5_plus"))
    return wide


def category_cvr(t: Tables) -> DataFrame:
    counts = t.campaign_interactions.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("conversions"))
    rows = t.campaign_dim().select("campaign_id", F.col("product_category").alias("c")).join(counts, "campaign_id", "left")
    return _cvr_by(rows, F.col("c"), "product_category")


def category_rev(t: Tables) -> DataFrame:
    per = t.campaign_conversions.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("revenue_attributed").alias("revenue"))
    return per.join(t.product_category(), "product_id").groupBy("product_category").agg(
        F.sum("revenue").alias("total_revenue"), F.sum("n").alias("conversions")
    ).withColumn("rev_per_conv", k.over("total_revenue", "conversions"))


def region_stats(t: Tables, top: int = 12) -> DataFrame:
    rows = _cvr_by(_with_customer(t, contacts_by_customer(t), F.col("region").alias("r")), F.col("r"), "region")
    best = rows.orderBy(F.desc("conversions"), "region").limit(top)
    mean = F.avg("cvr").over(Window.partitionBy())  # over the top rows only
    return best.withColumn("above_mean_cvr", F.col("cvr") >= mean).withColumn("mean_cvr", F.round(mean, 6))


def rfm_distributions(t: Tables) -> DataFrame:
    """Counts and medians of the raw recency, 12-month frequency and revenue distributions."""
    touch = cut_lineage(t.campaign_interactions.groupBy("customer_id").agg(
        F.datediff(t.today, F.max("interaction_date")).alias("recency"),
        k.n_if(F.col("interaction_date") >= F.date_sub(t.today, 365)).alias("freq")))
    money = cut_lineage(revenue_by_customer(t).select("customer_id", "revenue"))
    med = lambda df, c: percentiles(df, c, [0.5]).get("all", [None])[0]
    medians = (med(touch, "recency"), med(touch.filter("freq > 0"), "freq"), med(money.filter("revenue > 0"), "revenue"))
    counts = touch.agg(F.count(F.lit(1)).alias("a"), k.n_if(F.col("freq") > 0).alias("b")).first()
    customers, ever = t.customers.count(), money.count()
    return local_frame(t.spark, [(counts["a"], counts["b"], ever, customers - ever, ever / customers * 100 if customers else None, *medians)],
        "with_interactions long, active_12m long, ever_converted long, never_converted long, ever_converted_pct double, "
        "median_recency double, median_freq_12m double, median_revenue double")


def exec_summary(t: Tables) -> DataFrame:
    """One row of headline numbers: the conversion totals with the other totals beside them."""
    inter = t.campaign_interactions.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("won"))
    named = inter.join(t.channel_dim().select("channel_id", "channel_name"), "channel_id", "left").withColumn(
        "cvr", k.share("won", "contacts"))
    seen = k.value_of(named.agg(F.sum("contacts").alias("contacts"), F.sum("won").alias("won"),
                                F.max_by("channel_name", "cvr").alias("best")))
    spent = k.value_of(t.campaigns.agg(F.count(F.lit(1)).alias("n"), F.sum("total_budget").alias("budget")))
    row = t.campaign_conversions.agg(
        F.count(F.lit(1)).alias("total_conversions"), F.sum("revenue_attributed").alias("total_revenue")
    ).withColumns({
        "total_customers": k.value_of(t.customers.agg(F.count(F.lit(1)))), "total_campaigns": spent["n"],
        "total_budget": spent["budget"], "total_contacts": seen["contacts"], "_won": seen["won"],
        "top_cvr_channel": seen["best"],
        "top_revenue_segment": k.value_of(segment_revenue(t).agg(F.max_by("customer_segment", "revenue_m"))),
    })
    return row.select(
        "total_customers", "total_campaigns", "total_contacts", "total_conversions",
        k.share("_won", "total_contacts").alias("overall_cvr"), "total_revenue", "total_budget",
        k.share(F.col("total_revenue") - F.col("total_budget"), "total_budget").alias("overall_roi"),
        k.over("total_budget", "total_conversions").alias("average_cpa"), "top_revenue_segment", "top_cvr_channel")


def cvr_summary(t: Tables) -> DataFrame:
    """CVR by channel and by segment in one list."""
    chan = t.campaign_interactions.groupBy("channel_id").agg(
        F.count(F.lit(1)).alias("contacts"), k.n_if(k.outcome_is("Converted")).alias("conversions")).join(
        t.channel_dim().select("channel_id", "channel_name"), "channel_id")
    a = chan.select(F.lit("channel").alias("dimension"), F.col("channel_name").alias("value"), "contacts", "conversions")
    b = segment_cvr(t).select(F.lit("segment").alias("dimension"), F.col("customer_segment").alias("value"),
                              "contacts", "conversions")
    return a.unionByName(b).withColumn("cvr_pct", k.pct("conversions", "contacts", 1))
