"""DuckDB texts of the checks, constraints and profiles."""

from campaignry.operators.quality import CHECKS as FIXED
from oracle.text import AS_OF, CONV, OPT, dbl, gbp, pct, q, rnd, when

def rows_in(table: str, bad: str = "TRUE") -> str:
    return f"SELECT coalesce(sum(CASE WHEN {bad} THEN 1 ELSE 0 END), 0)::BIGINT FROM {table}"


def strays(table: str, key: str, home: str) -> str:
    """Rows whose key is null or unknown at home."""
    return rows_in(table, f"{key} IS NULL OR {key} NOT IN (SELECT {key} FROM {home})")


def mismatched(rule: str) -> str:
    """Conversions that break a rule against their own interaction, by a lookup of each."""
    return f"""SELECT count(*) FROM campaign_conversions w
      WHERE EXISTS (FROM campaign_interactions seen WHERE seen.interaction_id = w.interaction_id AND {rule})"""


SIZES = {"customers": "customers", "campaigns": "campaigns", "interactions": "campaign_interactions",
         "conversions": "campaign_conversions", "products": "products", "channels": "campaign_channels"}
GAPS = {"null_segment": ("customers", "customer_segment"), "null_region": ("customers", "region"),
        "null_outcome": ("campaign_interactions", "interaction_outcome"), "null_conv_product": ("campaign_conversions", "product_id"),
        "null_revenue": ("campaign_conversions", "revenue_attributed"), "null_campaign_type": ("campaigns", "campaign_type"),
        "null_start_date": ("campaigns", "start_date")}
KEYS = {"i_campaign": ("campaign_interactions", "campaign_id", "campaigns"), "i_customer": ("campaign_interactions", "customer_id", "customers"),
        "i_channel": ("campaign_interactions", "channel_id", "campaign_channels"),
        "c_interaction": ("campaign_conversions", "interaction_id", "campaign_interactions"),
        "c_product": ("campaign_conversions", "product_id", "products"), "h_customer": ("customer_products", "customer_id", "customers"),
        "g_product": ("campaigns", "product_id", "products")}
MEASURES = (
    {m: rows_in(t) for m, t in SIZES.items()} | {m: rows_in(t, f"{c} IS NULL") for m, (t, c) in GAPS.items()}
    | {m: strays(*key) for m, key in KEYS.items()} | {
        "early": mismatched("seen.interaction_date > w.conversion_date"), "unlinked": mismatched("seen.interaction_outcome != 'Converted'"),
        "dates": rows_in("campaigns", "start_date >= end_date"), "unpaid": rows_in("campaign_conversions", "NOT revenue_attributed > 0"),
        "underage": rows_in("customers", f"18 * 365.25 > ({AS_OF} - date_of_birth)"),
        "credit": rows_in("customers", "credit_score < 300 OR credit_score > 999"), "negative": rows_in("customers", "0 > number_of_products"),
        # An interaction without a conversion counts once, one with several as often as they are.
        "cvr": f"""SELECT {pct('sum(won)', 'sum(greatest(won, 1))', 1)} FROM (SELECT coalesce(n, 0) AS won FROM campaign_interactions
          LEFT JOIN (SELECT interaction_id, count(*) AS n FROM campaign_conversions GROUP BY ALL) USING (interaction_id))""",
        "dnc": """SELECT count(*) FROM (SELECT customer_id FROM customers WHERE is_dnc INTERSECT SELECT customer_id FROM campaign_conversions)""",
        "optout": f"SELECT {pct(when(OPT), 'count(*)')} FROM campaign_interactions",
        "live": "SELECT count(*) FROM (SELECT channel_id FROM campaign_interactions WHERE channel_id IS NOT NULL GROUP BY ALL)",
    }
)

# Names, severities, limits and expected texts are fixed values and stand in one place; the library's measure names differ.
OWN = {"interactions -> campaigns": "i_campaign", "interactions -> customers": "i_customer", "conv_without_interaction": "c_interaction",
       "conversions -> products": "c_product", "conv_before_interaction": "early", "bad_campaign_dates": "dates", "conv_not_converted": "unlinked",
       "unpaid_conversions": "unpaid", "bad_credit": "credit", "overall_cvr": "cvr", "dnc_with_conversions": "dnc", "optout_rate": "optout",
       "live_channels": "live"}


def limit(lo, hi, below: bool) -> str:
    return " AND ".join([f"v >= {lo}"] * (lo is not None) + [f"v {'<' if below else '<='} {hi}"] * (hi is not None))


CHECKS = [(name, severity, OWN.get(m, m), limit(lo, hi, below), said) for name, severity, m, lo, hi, below, said in FIXED]

def checks(some) -> str:
    return q(" UNION ALL ".join(
        f"SELECT '{n}' AS name, '{s}' AS severity, v AS actual, '{e}' AS expected, CASE WHEN {c} THEN 'PASS' ELSE '{s}' END AS status "
        f"FROM (SELECT CAST(({MEASURES[m]}) AS DOUBLE) AS v)" for n, s, m, c, e in some))


def counts(names: dict, value: str, key: str = "check_name") -> str:
    return q(" UNION ALL ".join(f"SELECT '{n}' AS {key}, ({MEASURES[m]}) AS {value}" for n, m in names.items()))


TABLES = ["products", "campaign_channels", "customers", "campaigns", "campaign_interactions", "campaign_conversions", "customer_products"]
COLS = {
    "products": ["product_id", "product_code", "product_name", "product_category", "revenue_value", "min_eligibility_age", "is_active"],
    "campaign_channels": ["channel_id", "channel_name", "channel_description", "benchmark_ctr", "benchmark_cvr", "benchmark_cpa", "is_active"],
    "customers": ["customer_id", "customer_code", "first_name", "last_name", "region", "city", "customer_segment", "gender",
                  "employment_status", "annual_income", "credit_score", "number_of_products", "is_active", "is_dnc",
                  "date_of_birth", "acquisition_date"],
    "campaigns": ["campaign_id", "campaign_code", "campaign_name", "campaign_type", "product_id", "channel_id", "target_segment",
                  "start_date", "end_date", "total_budget", "contacts_target", "ab_test_enabled", "campaign_manager", "status"],
    "campaign_interactions": ["interaction_id", "campaign_id", "customer_id", "channel_id", "interaction_date", "interaction_type",
                              "interaction_outcome", "response_date", "ab_variant"],
    "campaign_conversions": ["conversion_id", "interaction_id", "campaign_id", "customer_id", "product_id", "channel_id",
                             "conversion_date", "revenue_attributed", "ab_variant"],
    "customer_products": ["customer_product_id", "customer_id", "product_id", "campaign_id", "acquisition_date", "closure_date",
                          "status", "product_value"],
}
NOT_NULL = {
    "products": ["product_id", "product_code", "product_name", "product_category", "revenue_value", "min_eligibility_age", "is_active"],
    "campaign_channels": ["channel_id", "channel_name", "is_active"],
    "customers": ["customer_id", "customer_code", "first_name", "last_name", "date_of_birth", "region", "customer_segment",
                  "number_of_products", "is_active", "is_dnc", "acquisition_date"],
    "campaigns": ["campaign_id", "campaign_code", "campaign_name", "campaign_type", "product_id", "channel_id", "start_date",
                  "end_date", "total_budget", "contacts_target", "ab_test_enabled", "status"],
    "campaign_interactions": ["interaction_id", "campaign_id", "customer_id", "channel_id", "interaction_date", "interaction_type",
                              "interaction_outcome"],
    "campaign_conversions": ["conversion_id", "interaction_id", "campaign_id", "customer_id", "product_id", "channel_id",
                             "conversion_date", "revenue_attributed"],
    "customer_products": ["customer_product_id", "customer_id", "product_id", "acquisition_date", "status"],
}
SEG = "('Mass Market', 'Affluent', 'Premier', 'Private Banking')"
OUT = "('Pending', 'Interested', 'Not Interested', 'Converted', 'Opted Out', 'No Response', 'Callback Requested', 'Declined')"
RULES = {
    "products": {
        "category listed": "product_category IN ('Credit Card', 'Savings Account', 'Fixed Deposit', 'Personal Loan', 'Home Loan')",
        "revenue not negative": "revenue_value >= 0", "age at least 18": "min_eligibility_age >= 18"},
    "campaign_channels": {
        "name listed": "channel_name IN ('Email', 'SMS', 'Branch', 'Telemarketing', 'Digital')",
        "ctr is a percentage": "benchmark_ctr BETWEEN 0 AND 100", "cvr is a percentage": "benchmark_cvr BETWEEN 0 AND 100"},
    "customers": {
        "segment listed": f"customer_segment IN {SEG}",
        "gender listed": "gender IN ('Male', 'Female', 'Non-Binary', 'Prefer Not to Say')",
        "employment listed": "employment_status IN ('Employed', 'Self-Employed', 'Unemployed', 'Retired', 'Student', 'Part-Time')",
        "credit score in range": "credit_score BETWEEN 300 AND 999", "born before today": f"date_of_birth < {AS_OF}",
        "income positive": "annual_income > 0"},
    "campaigns": {
        "type listed": "campaign_type IN ('Acquisition', 'Retention', 'Cross-Sell', 'Upsell', 'Win-Back', 'Awareness')",
        "status listed": "status IN ('Planned', 'Active', 'Paused', 'Completed', 'Cancelled')", "ends after start": "end_date > start_date",
        "budget not negative": "total_budget >= 0", "contacts not negative": "contacts_target >= 0",
        "target segment listed": "target_segment IN ('All', 'Mass Market', 'Affluent', 'Premier', 'Private Banking')"},
    "campaign_interactions": {
        "type listed": "interaction_type IN ('Sent', 'Delivered', 'Opened', 'Clicked', 'Called', 'Visited Branch', 'Web Visit')",
        "outcome listed": f"interaction_outcome IN {OUT}", "variant listed": "ab_variant IN ('A', 'B', 'C')",
        "response not before interaction": "response_date >= interaction_date"},
    "campaign_conversions": {"revenue not negative": "revenue_attributed >= 0", "variant listed": "ab_variant IN ('A', 'B', 'C')"},
    "customer_products": {
        "status listed": "status IN ('Active', 'Closed', 'Suspended', 'Pending Activation')",
        "closed after opening": "closure_date > acquisition_date", "value not negative": "product_value >= 0"},
}
UNIQUE = {
    "products": ["product_id", "product_code"], "campaign_channels": ["channel_id", "channel_name"],
    "customers": ["customer_id", "customer_code"], "campaigns": ["campaign_id", "campaign_code"],
    "campaign_interactions": ["interaction_id"], "campaign_conversions": ["conversion_id", "interaction_id"],
    "customer_products": ["customer_product_id", "customer_id, product_id, status"],
}


def constraints() -> str:
    parts = []
    for t in TABLES:
        rules = RULES[t] | {f"{c} not null": f"{c} IS NOT NULL" for c in NOT_NULL[t]}
        parts += [f"SELECT '{t}' AS table_name, '{n}' AS constraint_name, count(*) FILTER (WHERE NOT ({r})) AS violations FROM {t}"
                  for n, r in rules.items()]
        parts += [f"""SELECT '{t}', 'unique {keys}', CAST(COALESCE(sum(n - 1), 0) AS BIGINT) FROM
            (SELECT count(*) AS n FROM {t} GROUP BY {keys})""" for keys in UNIQUE[t]]
    return q(" UNION ALL ".join(parts))


def score() -> str:
    parts = []
    for t in TABLES:
        rules = [f"COALESCE({r}, TRUE)" for r in RULES[t].values()] + [f"{c} IS NOT NULL" for c in NOT_NULL[t]]
        good = f"count(*) FILTER (WHERE {' AND '.join(rules)})"
        parts.append(f"SELECT '{t}' AS table_name, count(*) AS records, {good} AS passing, {pct(good, 'count(*)')} AS dq_score_pct FROM {t}")
    return q(" UNION ALL ".join(parts))


def null_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS total_rows FROM {t}"
        for t in TABLES for c in COLS[t])


KINDS = "lower(replace(replace(typeof(any_value({c})), 'VARCHAR', 'string'), 'INTEGER', 'int'))"
OUTLIERS = [("customers", "annual_income"), ("customers", "credit_score"), ("campaigns", "total_budget"),
            ("campaigns", "contacts_target"), ("campaign_conversions", "revenue_attributed"), ("customer_products", "product_value")]


def outliers() -> str:
    parts = [f"""SELECT '{t}' AS table_name, '{c}' AS column_name, round(min(x), 2) AS min, round(max(x), 2) AS max, round(any_value(m), 2) AS mean,
      round(any_value(md), 2) AS median, round(any_value(s), 2) AS std,
      count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
      count(*) FILTER (WHERE abs((x - m) / s) > 3) AS z_outliers,
      round(CAST(count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS DOUBLE) / count(*) * 100, 2) AS iqr_pct
      FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {t} WHERE {c} IS NOT NULL),
      (SELECT avg(CAST({c} AS DOUBLE)) AS m, stddev_samp(CAST({c} AS DOUBLE)) AS s, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
        quantile_cont(CAST({c} AS DOUBLE), 0.5) AS md, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {t})""" for t, c in OUTLIERS]
    return q(" UNION ALL ".join(parts))


SQL = {
    "dq_run": checks(CHECKS),
    "dq_totals": f"SELECT status, count(*) AS checks FROM ({checks(CHECKS)}) GROUP BY status",
    "dq_rowcounts": checks(CHECKS[:6]),
    "dq_warn": checks(CHECKS[21:]),
    "dq_nulls": counts({"customers.customer_segment": "null_segment", "customers.region": "null_region",
        "campaigns.campaign_type": "null_campaign_type", "campaigns.start_date": "null_start_date", "interactions.outcome": "null_outcome",
        "conversions.product_id": "null_conv_product", "conversions.revenue": "null_revenue"}, "null_count"),
    "dq_orphans": counts({"interactions -> campaigns": "i_campaign", "interactions -> customers": "i_customer",
        "interactions -> channels": "i_channel", "conversions -> interactions": "c_interaction", "conversions -> products": "c_product",
        "customer_products -> customers": "h_customer", "campaigns -> products": "g_product"}, "orphan_rows"),
    "dq_rules": counts({"conversion_date >= interaction_date": "early", "campaign end_date > start_date": "dates",
        "conversion -> Converted interaction": "unlinked", "revenue_attributed > 0": "unpaid", "age >= 18": "underage",
        "credit_score within 300-999": "credit", "number_of_products >= 0": "negative"}, "violations"),
    "row_counts": q(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)),
    "dist_segment": q(f"SELECT customer_segment, n, {pct('n', 'sum(n) OVER ()', 1)} AS pct FROM (SELECT customer_segment, count(*) AS n FROM customers GROUP BY 1)"),
    "dist_cvr_channel": q(f"""SELECT channel_name, count(ci.interaction_id) AS total_contacts, count(cv.conversion_id) AS conversions,
      {pct('count(cv.conversion_id)', 'count(ci.interaction_id)', 1)} AS conversion_rate_pct FROM campaign_interactions ci
      JOIN campaign_channels ch ON ci.channel_id = ch.channel_id LEFT JOIN campaign_conversions cv ON cv.interaction_id = ci.interaction_id GROUP BY 1"""),
    "dist_rev_category": q(f"""SELECT product_category, count(*) AS conversions, {rnd('sum(rev_p)', '100', 0)} AS total_revenue_gbp,
      {rnd('sum(rev_p)', '100 * count(*)', 0)} AS avg_revenue_per_conversion FROM campaign_conversions JOIN products USING (product_id) GROUP BY 1"""),
    "constraint_check": constraints(),
    "dq_score": score(),
    "profile_schema": q(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(COLS[t])} AS column_count, '{c}' AS column_name, {KINDS.format(c=c)} AS data_type FROM {t}"
        for t in TABLES for c in COLS[t])),
    "profile_nulls": q(f"""SELECT table_name, column_name, null_count, {pct('null_count', 'total_rows')} AS null_pct, total_rows,
      CASE WHEN (table_name, column_name) IN (('campaign_interactions', 'response_date'), ('campaign_interactions', 'ab_variant'),
        ('customer_products', 'closure_date'), ('campaign_conversions', 'ab_variant')) THEN 'By Design' ELSE 'Investigate' END AS classification
      FROM nr WHERE null_count > 0""", nr=null_rows()),
    "mean_null_pct": q(f"""SELECT table_name, {rnd('sum(null_count) * 100', 'max(total_rows) * count(*)', 4)} AS mean_null_pct FROM nr GROUP BY 1""", nr=null_rows()),
    "dup_rows": q(" UNION ALL ".join(f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) -
      (SELECT count(*) FROM (SELECT DISTINCT {', '.join(COLS[t])} FROM {t})) AS duplicate_rows""" for t in TABLES)),
    "dup_keys": q(" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{UNIQUE[t][0]}' AS key_column, count(*) - count(DISTINCT {UNIQUE[t][0]}) AS duplicate_keys FROM {t}" for t in TABLES)),
    "outliers": outliers(),
    "validate_enums": q(f"""SELECT 'customer_segment invalid values' AS check_name, count(*) AS violations FROM customers WHERE customer_segment NOT IN {SEG} OR customer_segment IS NULL
      UNION ALL SELECT 'credit_score out of 300-999', count(*) FROM customers WHERE credit_score NOT BETWEEN 300 AND 999
      UNION ALL SELECT 'interaction_outcome invalid values', count(*) FROM campaign_interactions WHERE interaction_outcome NOT IN {OUT} OR interaction_outcome IS NULL
      UNION ALL SELECT 'campaigns with end <= start', count(*) FROM campaigns WHERE end_date <= start_date
      UNION ALL SELECT 'conversion_date < interaction', count(*) FROM campaign_conversions cv JOIN campaign_interactions ci USING (interaction_id)
        WHERE cv.conversion_date < ci.interaction_date"""),
}
