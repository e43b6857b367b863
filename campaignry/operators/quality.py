"""Data-quality checks, constraint rules and table profiles; the measures of one table share one aggregate pass."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry import schema as S
from campaignry.functions import kpi as k
from campaignry.plans.ordering import SortedRuns
from campaignry.session import cut_lineage, local_frame
from campaignry.tables import Tables


def _rows(one_row: DataFrame, key: str = "measure", value: str = "actual", kind: str = "double") -> DataFrame:
    """A one-row aggregate as (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").cast(kind).alias(value)) for c in one_row.columns])
    return one_row.select(F.explode(pairs).alias("_p")).select(f"_p.{key}", f"_p.{value}")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _n(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _agg(df: DataFrame, measures: list[Column]) -> DataFrame:
    """One aggregate pass of the measures whose columns the table has; a missing column costs only its own measures."""
    usable = []
    for m in measures:
        try:
            df.agg(m).schema
        except AnalysisException:
            continue
        usable.append(m)
    return df.agg(*usable) if usable else df.limit(0).agg(F.count(F.lit(1)).alias("_none"))


# Measures: each function returns a one-row aggregate whose columns are named measures.

def customer_measures(t: Tables) -> DataFrame:
    return _agg(t.customers, [
        _n("customers"), k.n_if(F.col("customer_segment").isNull()).alias("null_segment"),
        k.n_if(F.col("region").isNull()).alias("null_region"),
        k.n_if(F.datediff(t.today, "date_of_birth") / F.lit(365.25) < 18).alias("underage"),
        k.n_if(~F.col("credit_score").between(300, 999)).alias("bad_credit"),
        k.n_if(F.col("number_of_products") < 0).alias("negative_products"),
    ])


def campaign_measures(t: Tables) -> DataFrame:
    return _agg(t.campaigns, [
        _n("campaigns"), k.n_if(F.col("end_date") <= F.col("start_date")).alias("bad_campaign_dates"),
        k.n_if(F.col("campaign_type").isNull()).alias("null_campaign_type"),
        k.n_if(F.col("start_date").isNull()).alias("null_start_date"),
    ])


def interaction_measures(t: Tables) -> DataFrame:
    have = t.campaign_interactions.columns
    counts = [_n("n")] + [x for x in (k.n_if(F.col("interaction_outcome").isNull()).alias("gaps"), k.n_if(k.outcome_is("Opted Out")).alias("out"))
                          if "interaction_outcome" in have]
    by_channel = t.campaign_interactions.groupBy(*["channel_id"] * ("channel_id" in have)).agg(*counts)
    return _agg(by_channel, [
        F.coalesce(F.sum("n"), F.lit(0)).alias("interactions"), F.coalesce(F.sum("gaps"), F.lit(0)).alias("null_outcome"),
        k.pct(F.sum("out"), F.sum("n")).alias("optout_rate"), F.count("channel_id").alias("live_channels")])


def conversion_measures(t: Tables) -> DataFrame:
    return _agg(t.campaign_conversions, [
        _n("conversions"), k.n_if(F.col("product_id").isNull()).alias("null_conv_product"),
        k.n_if(F.col("revenue_attributed").isNull()).alias("null_revenue"),
        k.n_if(F.col("revenue_attributed") <= 0).alias("unpaid_conversions"),
    ])


def small_measures(t: Tables) -> list[DataFrame]:
    return [t.products.agg(_n("products")), t.campaign_channels.agg(_n("channels"))]


def conversion_link_measures(t: Tables) -> DataFrame:
    """Everything that compares a conversion with its interaction, from one join on the unique id."""
    i = t.campaign_interactions.select("interaction_id", "interaction_date", "interaction_outcome", F.lit(1).alias("i"))
    c = t.campaign_conversions.select(F.col("interaction_id").alias("cid"), "conversion_date", F.lit(1).alias("c"))
    both = i.join(c, F.col("interaction_id") == F.col("cid"), "full")
    return both.agg(
        k.n_if(F.col("c").isNotNull() & F.col("i").isNull()).alias("conv_without_interaction"),
        k.n_if(F.col("conversion_date") < F.col("interaction_date")).alias("conv_before_interaction"),
        k.n_if(F.col("c").isNotNull() & (F.col("interaction_outcome") != "Converted")).alias("conv_not_converted"),
        k.pct(k.n_if(F.col("c").isNotNull() & F.col("i").isNotNull()), F.count("i"), 1).alias("overall_cvr"),
    )


def dnc_measures(t: Tables) -> DataFrame:
    buyers = t.campaign_conversions.select("customer_id").distinct()
    return t.customers.filter("is_dnc").join(buyers, "customer_id", "left_semi").agg(_n("dnc_with_conversions"))


def orphans(child: DataFrame, key: str, parent: DataFrame, name: str) -> DataFrame:
    """Rows whose key has no parent; the child is counted per key first, so a hot key is one row."""
    counted = child.groupBy(key).agg(_n("n"))
    return counted.join(parent.select(key), key, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(name))


def orphan_measures(t: Tables) -> dict[str, DataFrame]:
    inter, conv, held = t.campaign_interactions, t.campaign_conversions, t.customer_products
    keyed = {
        "interactions -> campaigns": (inter, "campaign_id", t.campaigns),
        "interactions -> customers": (inter, "customer_id", t.customers),
        "interactions -> channels": (inter, "channel_id", t.campaign_channels),
        "conversions -> interactions": (conv, "interaction_id", inter),
        "conversions -> products": (conv, "product_id", t.products),
        "customer_products -> customers": (held, "customer_id", t.customers),
        "campaigns -> products": (t.campaigns, "product_id", t.products),
    }
    return {n: orphans(c, key, p, n) for n, (c, key, p) in keyed.items()}


# Name, severity, measure, lowest and highest accepted value, open upper end, description.
CHECKS = [
    ("Row count: customers >= 5,000", "FAIL", "customers", 5000, None, False, ">= 5,000"),
    ("Row count: campaigns between 10 and 200", "FAIL", "campaigns", 10, 200, False, "between 10 and 200"),
    ("Row count: interactions >= 50,000", "FAIL", "interactions", 50000, None, False, ">= 50,000"),
    ("Row count: conversions >= 1,000", "FAIL", "conversions", 1000, None, False, ">= 1,000"),
    ("Row count: products = 10", "FAIL", "products", 10, 10, False, "= 10"),
    ("Row count: channels = 5", "FAIL", "channels", 5, 5, False, "= 5"),
    ("No NULL customer_segment", "FAIL", "null_segment", 0, 0, False, "= 0 nulls"),
    ("No NULL region", "FAIL", "null_region", 0, 0, False, "= 0 nulls"),
    ("No NULL interaction_outcome", "FAIL", "null_outcome", 0, 0, False, "= 0 nulls"),
    ("No NULL product_id in conversions", "FAIL", "null_conv_product", 0, 0, False, "= 0 nulls"),
    ("No NULL revenue_attributed", "FAIL", "null_revenue", 0, 0, False, "= 0 nulls"),
    ("FK integrity: interactions -> campaigns", "FAIL", "interactions -> campaigns", 0, 0, False, "= 0 orphans"),
    ("FK integrity: interactions -> customers", "FAIL", "interactions -> customers", 0, 0, False, "= 0 orphans"),
    ("FK integrity: conversions -> interactions", "FAIL", "conv_without_interaction", 0, 0, False, "= 0 orphans"),
    ("FK integrity: conversions -> products", "FAIL", "conversions -> products", 0, 0, False, "= 0 orphans"),
    ("RULE: conversion_date >= interaction_date", "FAIL", "conv_before_interaction", 0, 0, False, "= 0 violations"),
    ("RULE: campaign end_date > start_date", "FAIL", "bad_campaign_dates", 0, 0, False, "= 0 violations"),
    ("RULE: all conversions link to Converted interactions", "FAIL", "conv_not_converted", 0, 0, False, "= 0 violations"),
    ("RULE: revenue_attributed > 0 on all conversions", "FAIL", "unpaid_conversions", 0, 0, False, "= 0 violations"),
    ("RULE: customers age >= 18", "FAIL", "underage", 0, 0, False, "= 0 underage customers"),
    ("RULE: credit_score within 300–999", "FAIL", "bad_credit", 0, 0, False, "= 0 out-of-range scores"),
    ("WARN: overall conversion rate between 5% and 40%", "WARN", "overall_cvr", 5, 40, False, "between 5% and 40%"),
    ("WARN: DNC customers with conversions = 0", "WARN", "dnc_with_conversions", 0, 0, False, "= 0"),
    ("WARN: opt-out rate < 10%", "WARN", "optout_rate", None, 10, True, "< 10%"),
    ("WARN: all 5 channels have interactions", "WARN", "live_channels", 5, 5, False, "= 5 channels active"),
]


def judge(t: Tables, parts: list, checks=CHECKS) -> DataFrame:
    """PASS / WARN / FAIL per check. A check that cannot be computed is FAIL, whatever its severity."""
    measured, wanted = [], {c[2] for c in checks}
    for part in parts:
        try:
            frame = part(t)
        except AnalysisException:  # a missing table column
            continue
        for one in frame if isinstance(frame, list) else [frame]:
            names = [c for c in one.columns if c in wanted]
            if names:
                measured.append(_rows(one.select(*[F.col(f"`{c}`") for c in names])))
    plan = local_frame(t.spark, [(*c[:3], None if c[3] is None else float(c[3]), None if c[4] is None else float(c[4]), *c[5:]) for c in checks],
        "name string, severity string, measure string, lo double, hi double, open_end boolean, expected string")
    joined = plan.join(_union(measured).withColumn("_known", F.lit(True)), "measure", "left")
    a = F.col("actual")
    ok = (F.col("lo").isNull() | (a >= F.col("lo"))) & (
        F.col("hi").isNull() | F.when(F.col("open_end"), a < F.col("hi")).otherwise(a <= F.col("hi")))
    return joined.select(
        "name", "severity", "actual", "expected",
        F.when(F.col("_known").isNull(), "FAIL").when(a.isNotNull() & ok, "PASS").otherwise(F.col("severity")).alias("status"))


def _named(names: list[str]):
    def part(t: Tables) -> list[DataFrame]:
        found = orphan_measures(t)
        return [found[n] for n in names]
    return part


def dq_run(t: Tables, checks=CHECKS) -> DataFrame:
    return judge(t, [
        customer_measures, campaign_measures, interaction_measures, conversion_measures, small_measures,
        conversion_link_measures, dnc_measures,
        _named(["interactions -> campaigns", "interactions -> customers", "conversions -> products"]),
    ], checks)


def dq_totals(t: Tables) -> DataFrame:
    """Checks per status."""
    return dq_run(t).groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def dq_rowcounts(t: Tables) -> DataFrame:
    parts = [customer_measures, campaign_measures, interaction_measures, conversion_measures, small_measures]
    return judge(t, parts, [c for c in CHECKS if c[0].startswith("Row count")])


def dq_warn(t: Tables) -> DataFrame:
    parts = [interaction_measures, conversion_link_measures, dnc_measures]
    return judge(t, parts, [c for c in CHECKS if c[1] == "WARN"])


def _count_rows(frames: list[DataFrame], names: dict[str, str], key: str = "check_name", value: str = "violations") -> DataFrame:
    rows = _union([_rows(f.select(*[F.col(f"`{c}`").alias(names[c]) for c in f.columns if c in names]), key, value, "long")
                   for f in frames])
    return rows


def dq_nulls(t: Tables) -> DataFrame:
    names = {
        "null_segment": "customers.customer_segment", "null_region": "customers.region",
        "null_campaign_type": "campaigns.campaign_type", "null_start_date": "campaigns.start_date",
        "null_outcome": "interactions.outcome", "null_conv_product": "conversions.product_id",
        "null_revenue": "conversions.revenue",
    }
    return _count_rows([customer_measures(t), campaign_measures(t), interaction_measures(t), conversion_measures(t)],
                       names, value="null_count")


def dq_orphans(t: Tables) -> DataFrame:
    found = orphan_measures(t)
    return _union([_rows(f, "check_name", "orphan_rows", "long") for f in found.values()])


def dq_rules(t: Tables) -> DataFrame:
    names = {
        "conv_before_interaction": "conversion_date >= interaction_date", "bad_campaign_dates": "campaign end_date > start_date",
        "conv_not_converted": "conversion -> Converted interaction", "unpaid_conversions": "revenue_attributed > 0",
        "underage": "age >= 18", "bad_credit": "credit_score within 300-999", "negative_products": "number_of_products >= 0",
    }
    return _count_rows([conversion_link_measures(t), campaign_measures(t), conversion_measures(t), customer_measures(t)], names)


def row_counts(t: Tables) -> DataFrame:
    return _union([t[n].agg(_n("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n in S.LOAD_ORDER])


def dist_segment(t: Tables) -> DataFrame:
    counts = t.customers.groupBy("customer_segment").agg(_n("n"))
    # The window runs over one row per segment.
    return counts.withColumn("pct", k.pct("n", F.sum("n").over(Window.partitionBy()), 1))


def dist_cvr_channel(t: Tables) -> DataFrame:
    """Joined on the unique interaction id, counted per channel id, named last."""
    c = t.campaign_conversions.select("interaction_id", "conversion_id")
    by = t.campaign_interactions.select("interaction_id", "channel_id").join(c, "interaction_id", "left").groupBy(
        "channel_id").agg(F.count("interaction_id").alias("total_contacts"), F.count("conversion_id").alias("conversions"))
    return by.join(t.channel_dim().select("channel_id", "channel_name"), "channel_id").select(
        "channel_name", "total_contacts", "conversions", k.pct("conversions", "total_contacts", 1).alias("conversion_rate_pct"))


def dist_rev_category(t: Tables) -> DataFrame:
    by = t.campaign_conversions.groupBy("product_id").agg(F.count("conversion_id").alias("n"), F.sum("revenue_attributed").alias("s"))
    return by.join(t.product_category(), "product_id").groupBy("product_category").agg(
        F.sum("n").alias("conversions"), F.sum("s").alias("s")).select(
        "product_category", "conversions", F.round("s", 0).alias("total_revenue_gbp"),
        k.ratio("s", "conversions", 0).alias("avg_revenue_per_conversion"))


# Declarative constraints. A rule holds when its condition is true or NULL.

def row_rules(t: Tables) -> dict[str, dict[str, Column]]:
    c = F.col
    listed = lambda name, values: c(name).isin(values)
    return {
        "products": {
            "category listed": listed("product_category", S.CATEGORIES), "revenue not negative": c("revenue_value") >= 0,
            "age at least 18": c("min_eligibility_age") >= 18},
        "campaign_channels": {
            "name listed": listed("channel_name", S.CHANNELS), "ctr is a percentage": c("benchmark_ctr").between(0, 100),
            "cvr is a percentage": c("benchmark_cvr").between(0, 100)},
        "customers": {
            "segment listed": listed("customer_segment", S.SEGMENTS), "gender listed": listed("gender", S.GENDERS),
            "employment listed": listed("employment_status", S.EMPLOYMENT),
            "credit score in range": c("credit_score").between(300, 999),
            "born before today": c("date_of_birth") < t.today, "income positive": c("annual_income") > 0},
        "campaigns": {
            "type listed": listed("campaign_type", S.CAMPAIGN_TYPES), "status listed": listed("status", S.CAMPAIGN_STATUS),
            "ends after start": c("end_date") > c("start_date"), "budget not negative": c("total_budget") >= 0,
            "contacts not negative": c("contacts_target") >= 0,
            "target segment listed": listed("target_segment", ["All", *S.SEGMENTS])},
        "campaign_interactions": {
            "type listed": listed("interaction_type", S.INTERACTION_TYPES),
            "outcome listed": listed("interaction_outcome", S.OUTCOMES), "variant listed": listed("ab_variant", S.VARIANTS),
            "response not before interaction": c("response_date") >= c("interaction_date")},
        "campaign_conversions": {
            "type listed": listed("conversion_type", S.CONVERSION_TYPES), "revenue not negative": c("revenue_attributed") >= 0,
            "variant listed": listed("ab_variant", S.VARIANTS)},
        "customer_products": {
            "status listed": listed("status", S.HOLDING_STATUS), "closed after opening": c("closure_date") > c("acquisition_date"),
            "value not negative": c("product_value") >= 0},
    }


# Rules on a column that a table may lack.
OPTIONAL = {
    ("campaign_conversions", "type listed"): "conversion_type", ("customer_products", "closed after opening"): "closure_date",
    ("customers", "gender listed"): "gender", ("customers", "employment listed"): "employment_status",
    ("products", "age at least 18"): "min_eligibility_age",
}

UNIQUE_KEYS = {
    "products": [["product_id"], ["product_code"]],
    "campaign_channels": [["channel_id"], ["channel_name"]],
    "customers": [["customer_id"], ["customer_code"]],
    "campaigns": [["campaign_id"], ["campaign_code"]],
    "campaign_interactions": [["interaction_id"]],
    "campaign_conversions": [["conversion_id"], ["interaction_id"]],
    "customer_products": [["customer_product_id"], ["customer_id", "product_id", "status"]],
}


def usable_rules(t: Tables, table: str) -> dict[str, Column]:
    """Row rules and NOT NULL rules whose columns the table has."""
    df, out = t[table], {}
    for name, rule in row_rules(t)[table].items():
        if OPTIONAL.get((table, name), df.columns[0]) in df.columns:
            out[name] = rule
    for f in S.SCHEMAS[table]:
        if not f.nullable and f.name in df.columns:
            out[f"{f.name} not null"] = F.col(f.name).isNotNull()
    return out


def surplus(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows beyond the first of each key; NULL keys count as equal."""
    return df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("extra")).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias(name))


def constraint_check(t: Tables) -> DataFrame:
    parts = []
    for table in S.LOAD_ORDER:
        df = t[table]
        broken = df.agg(*[k.n_if(~rule).alias(name) for name, rule in usable_rules(t, table).items()])
        found = [_rows(broken, "constraint_name", "violations", "long")]
        for keys in UNIQUE_KEYS[table]:
            if set(keys) <= set(df.columns):
                found.append(_rows(surplus(df, keys, f"unique {', '.join(keys)}"), "constraint_name", "violations", "long"))
        parts += [f.select(F.lit(table).alias("table_name"), "constraint_name", "violations") for f in found]
    return _union(parts)


def dq_score(t: Tables) -> DataFrame:
    """Share of the records of each table that pass every row rule."""
    parts = []
    for table in S.LOAD_ORDER:
        good = reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(True)) for r in usable_rules(t, table).values()])
        parts.append(t[table].agg(_n("records"), k.n_if(good).alias("passing")).select(
            F.lit(table).alias("table_name"), "records", "passing", k.pct("passing", "records").alias("dq_score_pct")))
    return _union(parts)


# Profiles.

BY_DESIGN = {
    ("campaign_interactions", "response_date"), ("campaign_interactions", "ab_variant"),
    ("customer_products", "closure_date"), ("campaign_conversions", "ab_variant"),
}


def profile_schema(t: Tables) -> DataFrame:
    parts = []
    for table in S.LOAD_ORDER:
        df = t[table]
        cols = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
                         for f in df.schema])
        parts.append(df.agg(_n("row_count")).select(
            F.lit(table).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            F.explode(cols).alias("c")).select("table_name", "row_count", "column_count", "c.column_name", "c.data_type"))
    return _union(parts)


def _null_counts(t: Tables, table: str) -> DataFrame:
    df = t[table]
    one = df.agg(*[k.n_if(F.col(c).isNull()).alias(c) for c in df.columns], _n("_n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])
    return one.select(F.lit(table).alias("table_name"), F.col("_n").alias("total_rows"), F.explode(pairs).alias("p")).select(
        "table_name", "total_rows", "p.column_name", "p.null_count")


def profile_nulls(t: Tables) -> DataFrame:
    rows = _union([_null_counts(t, n) for n in S.LOAD_ORDER]).filter("null_count > 0")
    by_design = reduce(lambda a, b: a | b, [
        (F.col("table_name") == a) & (F.col("column_name") == b) for a, b in sorted(BY_DESIGN)])
    return rows.select("table_name", "column_name", "null_count", k.pct("null_count", "total_rows").alias("null_pct"), "total_rows",
                       F.when(by_design, "By Design").otherwise("Investigate").alias("classification"))


def mean_null_pct(t: Tables) -> DataFrame:
    rows = _union([_null_counts(t, n) for n in S.LOAD_ORDER])
    return rows.groupBy("table_name").agg(
        k.ratio(F.sum("null_count") * 100, F.max("total_rows") * F.count("column_name"), 4).alias("mean_null_pct"))


def repeated_prints(frames: dict[str, DataFrame]) -> DataFrame:
    """table_name and fingerprint of all rows that may be repeated: eight bytes a row are grouped, not rows."""
    prints = _union([df.select(F.lit(n).alias("table_name"), F.xxhash64(*df.columns).alias("fingerprint")) for n, df in frames.items()])
    return prints.groupBy("table_name", "fingerprint").count().filter("count > 1").select("table_name", "fingerprint")


def repeated_rows(df: DataFrame, prints: DataFrame) -> DataFrame:
    """The rows under these fingerprints. The written fingerprints have a known size: few are broadcast, many are joined."""
    names = [f"_c{i}" for i in range(len(df.columns))]  # no clash with the join's own column
    return df.toDF(*names).withColumn("fingerprint", F.xxhash64(*names)).join(prints, "fingerprint", "left_semi").drop("fingerprint")


def dup_rows(t: Tables) -> DataFrame:
    """Rows beyond the first of their kind. Whole rows are compared only where a fingerprint of them occurs again."""
    prints = cut_lineage(repeated_prints({n: t[n] for n in S.LOAD_ORDER}))
    rows = {n: repeated_rows(t[n], prints.filter(F.col("table_name") == n).select("fingerprint")) for n in S.LOAD_ORDER}
    return _union([surplus(df, df.columns, "duplicate_rows").select(F.lit(n).alias("table_name"), "duplicate_rows") for n, df in rows.items()])


def dup_keys(t: Tables) -> DataFrame:
    return _union([
        surplus(t[n], [key], "duplicate_keys").select(F.lit(n).alias("table_name"), F.lit(key).alias("key_column"), "duplicate_keys")
        for n, key in S.PRIMARY_KEYS.items() if key in t[n].columns])


def validate_enums(t: Tables) -> DataFrame:
    """Invalid codes and ranges; a missing code is invalid here."""
    bad = lambda name, values: ~F.coalesce(F.col(name).isin(values), F.lit(False))
    links = conversion_link_measures(t).select(F.col("conv_before_interaction").alias("conversion_date < interaction"))
    return _union([_rows(f, "check_name", "violations", "long") for f in (
        t.customers.agg(
            k.n_if(bad("customer_segment", S.SEGMENTS)).alias("customer_segment invalid values"),
            k.n_if(~F.col("credit_score").between(300, 999)).alias("credit_score out of 300-999")),
        t.campaign_interactions.agg(k.n_if(bad("interaction_outcome", S.OUTCOMES)).alias("interaction_outcome invalid values")),
        t.campaigns.agg(k.n_if(F.col("end_date") <= F.col("start_date")).alias("campaigns with end <= start")), links)])


# The numeric columns screened for outliers.
OUTLIER_COLUMNS = {
    "customers": ["annual_income", "credit_score"], "campaigns": ["total_budget", "contacts_target"],
    "campaign_conversions": ["revenue_attributed"], "customer_products": ["product_value"],
}


def outliers(t: Tables) -> DataFrame:
    """Quartile fences and z-scores per numeric column.

    All columns share one sorted value histogram, so repeated values cost one row and no column's
    values meet in one task. Quartiles, then mean and spread, then the counts are read from it.
    """
    frames = [
        t[table].select(F.explode(F.array(*[
            F.struct(F.lit(f"{table}.{c}").alias("grp"), F.col(c).cast("decimal(18,4)").alias("val")) for c in cols
        ])).alias("e")).select("e.grp", "e.val") for table, cols in OUTLIER_COLUMNS.items()]
    with SortedRuns(_union(frames).filter("val IS NOT NULL")) as runs:
        quart = {g: [float(v) for v in q] for g, q in runs.percentiles([0.25, 0.5, 0.75]).items()}
        w, v = F.col("_weight"), F.col("val").cast("double")
        first = {r["grp"]: r for r in runs.rows.groupBy("grp").agg(
            F.sum("_weight").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
            (F.sum((F.col("val") * w).cast("decimal(38,4)")).cast("double") / F.sum("_weight")).alias("mean")).collect()}
        base = local_frame(t.spark, [(g, float(first[g]["mean"]), q[0] - 1.5 * (q[2] - q[0]), q[2] + 1.5 * (q[2] - q[0])) for g, q in quart.items()],
            "g string, mean double, fence_lo double, fence_hi double")
        per = runs.rows.join(F.broadcast(base), F.col("grp") == F.col("g"))  # one row per screened column
        second = {r["grp"]: r for r in per.groupBy("grp").agg(
            F.sum(w * (v - F.col("mean")) * (v - F.col("mean"))).alias("ss"),
            F.sum(F.when((v < F.col("fence_lo")) | (v > F.col("fence_hi")), w).otherwise(0)).alias("iqr")).collect()}
        std = {g: (second[g]["ss"] / (first[g]["n"] - 1)) ** 0.5 if first[g]["n"] > 1 else None for g in quart}
        limits = local_frame(t.spark, [(g, float(first[g]["mean"]), std[g]) for g in quart if std[g]], "g string, mean double, std double")
        z = {r["grp"]: r["z"] for r in runs.rows.join(F.broadcast(limits), F.col("grp") == F.col("g")).groupBy("grp").agg(
            F.sum(F.when(F.abs((v - F.col("mean")) / F.col("std")) > 3, w).otherwise(0)).alias("z")).collect()}
    out = [(*g.split("."), first[g]["lo"], first[g]["hi"], first[g]["mean"], quart[g][1], std[g], int(second[g]["iqr"]),
            int(z.get(g, 0)), float(second[g]["iqr"]) / first[g]["n"] * 100) for g in quart]
    frame = local_frame(t.spark, out, "table_name string, column_name string, min double, max double, mean double, median double, std double, "
             "iqr_outliers long, z_outliers long, iqr_pct double")
    return frame.withColumns({c: F.round(c, 2) for c in ("min", "max", "mean", "median", "std", "iqr_pct")})
