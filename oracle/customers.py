"""DuckDB texts of features, additive RFM, data rules and load reports."""

from oracle.text import AS_OF, CONV, OPT, RESP, TABLES, dbl, gbp, pct, q, rnd, when
from oracle.views import TYPED

AGE = f"CAST(floor(({AS_OF} - date_of_birth) / CAST(365.25 AS DOUBLE)) AS INTEGER)"
CATS = ["Credit Card", "Savings Account", "Fixed Deposit", "Personal Loan", "Home Loan"]


def snake(c: str) -> str:
    return c.lower().replace("-", "_").replace(" ", "_")


def r6(x: str, name: str | None = None) -> str:
    return f"round(CAST({x} AS DOUBLE), 6) AS {name or x}"


FEAT = dict(
    TYPED,
    qe="SELECT " + ", ".join(f"quantile_cont(CAST(annual_income AS DOUBLE), {i / 10}) AS e{i}" for i in range(1, 10)) + " FROM customers",
    demo=f"""SELECT customer_id, CAST(annual_income AS DOUBLE) AS annual_income, credit_score, customer_segment, number_of_products, is_active, is_dnc,
      employment_status, gender, region, {AGE} AS age, {AS_OF} - acquisition_date AS tenure_days, ln(1 + CAST(annual_income AS DOUBLE)) AS log_income,
      CASE WHEN annual_income IS NOT NULL THEN 1 + {' + '.join(f'CAST(CAST(annual_income AS DOUBLE) > e{i} AS INTEGER)' for i in range(1, 10))} END AS income_decile,
      CASE customer_segment WHEN 'Mass Market' THEN 1 WHEN 'Affluent' THEN 2 WHEN 'Premier' THEN 3 ELSE 4 END AS segment_rank FROM customers, qe""",
    it=f"""SELECT customer_id, {AS_OF} - max(interaction_date) AS recency_days, count(*) AS total_interactions,
      count(*) FILTER (WHERE interaction_date >= {AS_OF} - 365) AS freq_12m, {when(RESP)} AS responded_count, {when(OPT)} AS optout_count,
      count(DISTINCT channel_id) AS channels_used, count(DISTINCT campaign_id) AS campaigns_touched,
      CASE WHEN count(ab_variant) > 0 THEN 1 ELSE 0 END AS ab_participant_flag, max(interaction_date) - min(interaction_date) AS interaction_span_days
      FROM campaign_interactions GROUP BY 1""",
    fr="""SELECT *, responded_count / total_interactions AS response_rate, optout_count / total_interactions AS optout_rate,
      ln(1 + total_interactions) AS log_freq_total, ln(1 + freq_12m) AS log_freq_12m FROM it""",
    mo=f"""SELECT customer_id, {gbp('sum(rev_p)')} AS total_revenue, count(*) AS n_conversions, {gbp('max(rev_p)')} AS max_single_conversion,
      count(DISTINCT product_id) AS n_distinct_products_bought, {', '.join(f"{when(f'''conversion_type = '{c}' ''')} AS conv_{snake(c)}" for c in ('New', 'Cross-Sell', 'Upsell', 'Reactivation'))},
      {gbp('sum(rev_p)')} / count(*) AS avg_revenue_per_conv, ln(1 + {gbp('sum(rev_p)')}) AS log_revenue
      FROM (SELECT cv.*, conversion_type FROM campaign_conversions cv JOIN typed USING (interaction_id)) GROUP BY 1""",
    pr=f"""SELECT customer_id, count(*) AS n_active_products, count(DISTINCT product_category) AS n_product_categories, {gbp('sum(val_p)')} AS total_product_value,
      {gbp('sum(val_p)')} / count(val_p) AS avg_product_value, {gbp('max(val_p)')} AS max_product_value,
      {', '.join(f"CAST(max(CASE WHEN product_category = '{c}' THEN 1 ELSE 0 END) AS INTEGER) AS has_{snake(c)}" for c in CATS)},
      ln(1 + {gbp('sum(val_p)')}) AS log_product_value, CASE WHEN count(*) >= 2 THEN 1 ELSE 0 END AS is_multi_product,
      count(DISTINCT product_category) / 5 AS cross_sell_score FROM customer_products JOIN products USING (product_id) WHERE status = 'Active' GROUP BY 1""",
)
PLAIN = ["credit_score", "number_of_products", "age", "tenure_days", "income_decile", "segment_rank", "total_interactions", "freq_12m", "responded_count",
         "optout_count", "channels_used", "campaigns_touched", "ab_participant_flag", "interaction_span_days", "n_conversions", "n_distinct_products_bought",
         "conv_new", "conv_cross_sell", "conv_upsell", "conv_reactivation", "n_active_products", "n_product_categories",
         *[f"has_{snake(c)}" for c in CATS], "is_multi_product"]
REAL = ["annual_income", "log_income", "response_rate", "optout_rate", "log_freq_total", "log_freq_12m", "total_revenue", "max_single_conversion",
        "avg_revenue_per_conv", "log_revenue", "total_product_value", "avg_product_value", "max_product_value", "log_product_value", "cross_sell_score"]
MATRIX = dict(FEAT, fm="SELECT customer_id, customer_segment, is_active, is_dnc, employment_status, gender, region, COALESCE(recency_days, tenure_days) AS recency_days, "
              + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in PLAIN) + ", " + ", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in REAL)
              + " FROM demo LEFT JOIN fr USING (customer_id) LEFT JOIN mo USING (customer_id) LEFT JOIN pr USING (customer_id)")
SCALE = ["age", "log_income", "credit_score", "tenure_days", "recency_days", "log_freq_total", "log_freq_12m", "response_rate", "optout_rate", "log_revenue",
         "n_conversions", "avg_revenue_per_conv", "n_active_products", "n_product_categories", "log_product_value", "cross_sell_score", "channels_used",
         "campaigns_touched", "interaction_span_days"]

RFM = dict(
    MATRIX,
    re="SELECT " + ", ".join(f"quantile_cont(recency_days, {p}) AS q{i}" for i, p in enumerate((0.2, 0.4, 0.6, 0.8), 1)) + " FROM fm",
    rk="""SELECT *, row_number() OVER (ORDER BY freq_12m, customer_id) AS fr_rank, count(*) OVER () AS n,
      CASE WHEN total_revenue > 0 THEN row_number() OVER (PARTITION BY total_revenue > 0 ORDER BY total_revenue, customer_id) END AS m_rank,
      count(*) OVER (PARTITION BY total_revenue > 0) AS nm FROM fm""",
    rs=f"""SELECT *, 5 - ({' + '.join(f'CAST(recency_days > q{i} AS INTEGER)' for i in range(1, 5))}) AS R,
      1 + {' + '.join(f'CAST(5 * (fr_rank - 1) > (n - 1) * {j} AS INTEGER)' for j in range(1, 5))} AS F,
      CASE WHEN total_revenue > 0 THEN 1 + {' + '.join(f'CAST(4 * (m_rank - 1) > (nm - 1) * {j} AS INTEGER)' for j in range(1, 4))} ELSE 0 END AS M FROM rk, re""",
    rl="""SELECT *, R + F + M AS rfm_score, CASE WHEN R >= 4 AND F >= 4 AND M >= 4 THEN 'Champions' WHEN R >= 3 AND F >= 4 THEN 'Loyal Customers'
      WHEN R >= 4 AND F <= 2 THEN 'New Customers' WHEN R >= 3 AND F >= 3 THEN 'Potential Loyalists' WHEN R <= 2 AND F >= 4 AND M >= 4 THEN 'Can''t Lose Them'
      WHEN R <= 2 AND F >= 3 THEN 'At Risk' WHEN R >= 3 AND M >= 4 THEN 'High-Value Infrequent' WHEN R >= 4 AND M = 0 THEN 'New Customers'
      WHEN R <= 2 AND F <= 2 AND M <= 2 THEN 'Hibernating' ELSE 'Needs Attention' END AS rfm_segment FROM rs""",
    st="""SELECT rfm_segment, count(*) AS customers, sum(CAST(round(total_revenue * 100) AS BIGINT)) AS rev_p, min(rfm_score) AS min_score,
      max(rfm_score) AS max_score FROM rl GROUP BY 1""",
)
PROFILE = ["recency_days", "freq_12m", "total_revenue", "annual_income", "credit_score", "n_active_products"]
RADAR = ["recency_days", "freq_12m", "total_revenue", "annual_income", "n_active_products", "credit_score"]

HASH = "CAST(('0x' || substr(md5({}), 1, 15)) AS BIGINT)"
ALLOC = dict(
    al0="""SELECT campaign_id, target_segment, contacts_target, contacts_target * (SELECT count(*) FROM campaign_interactions) // (SELECT sum(contacts_target) FROM campaigns) AS s
      FROM campaigns""",
    al="""SELECT campaign_id, target_segment, contacts_target, CAST(s + CASE WHEN campaign_id = (SELECT campaign_id FROM al0 ORDER BY contacts_target DESC, campaign_id LIMIT 1)
      THEN (SELECT count(*) FROM campaign_interactions) - (SELECT sum(s) FROM al0) ELSE 0 END AS BIGINT) AS allocated FROM al0""",
)
AUDIENCE = dict(
    ALLOC,
    el=f"SELECT customer_id, customer_segment, {HASH.format('concat_ws(chr(58), 42, customer_id)')} AS h FROM customers WHERE is_active AND NOT is_dnc",
    po="SELECT customer_id, h, 'All' AS pool FROM el UNION ALL SELECT customer_id, h, customer_segment FROM el",
    pl="SELECT pool, customer_id, row_number() OVER (PARTITION BY pool ORDER BY h, customer_id) - 1 AS place, count(*) OVER (PARTITION BY pool) AS size FROM po",
    sz="SELECT pool, any_value(size) AS size FROM pl GROUP BY 1",
    wi=f"""SELECT campaign_id, allocated, CASE WHEN target_segment <> 'All' AND size >= allocated THEN target_segment ELSE 'All' END AS pool
      FROM al LEFT JOIN sz ON sz.pool = al.target_segment""",
    wn=f"""SELECT campaign_id, wi.pool, size, least(allocated, size) AS n,
      {HASH.format("concat_ws(chr(58), 42, 'campaign', campaign_id)")} % size AS start FROM wi JOIN sz USING (pool)""",
)
SEED = [("CC-CLASSIC", "Classic Credit Card", "Credit Card", "450.00", 18), ("CC-PLATINUM", "Platinum Credit Card", "Credit Card", "850.00", 21),
        ("SA-EASY", "Easy Access Savings", "Savings Account", "120.00", 18), ("SA-REGULAR", "Regular Saver Account", "Savings Account", "180.00", 18),
        ("FD-12M", "12-Month Fixed Deposit", "Fixed Deposit", "380.00", 18), ("FD-24M", "24-Month Fixed Deposit", "Fixed Deposit", "520.00", 18),
        ("PL-PERSONAL", "Personal Loan", "Personal Loan", "1200.00", 18), ("PL-CAR", "Car Finance Loan", "Personal Loan", "1800.00", 18),
        ("HL-RESIDENTIAL", "Residential Mortgage", "Home Loan", "4500.00", 18), ("HL-BTL", "Buy-to-Let Mortgage", "Home Loan", "6000.00", 21)]
LOADED = ["products", "campaign_channels", "customers", "campaigns", "campaign_interactions", "campaign_conversions", "customer_products"]

SQL = {
    "feat_demographic": q(f"""SELECT customer_id, {r6('annual_income')}, credit_score, customer_segment, number_of_products, is_active, is_dnc, employment_status,
      gender, region, age, tenure_days, {r6('log_income')}, income_decile, segment_rank FROM demo""", **FEAT),
    "feat_recency": q("SELECT customer_id, recency_days FROM it", **FEAT),
    "feat_frequency": q(f"""SELECT customer_id, total_interactions, freq_12m, responded_count, optout_count, {r6('response_rate')}, {r6('optout_rate')},
      {r6('log_freq_total')}, {r6('log_freq_12m')} FROM fr""", **FEAT),
    "feat_monetary": q(f"""SELECT customer_id, n_conversions, n_distinct_products_bought, conv_new, conv_cross_sell, conv_upsell, conv_reactivation,
      {r6('total_revenue')}, {r6('max_single_conversion')}, {r6('avg_revenue_per_conv')}, {r6('log_revenue')} FROM mo""", **FEAT),
    "feat_product": q(f"""SELECT customer_id, n_active_products, n_product_categories, {', '.join(f'has_{snake(c)}' for c in CATS)}, is_multi_product,
      {', '.join(r6(c) for c in ('total_product_value', 'avg_product_value', 'max_product_value', 'log_product_value', 'cross_sell_score'))} FROM pr""", **FEAT),
    "feat_engagement": q("SELECT customer_id, channels_used, campaigns_touched, ab_participant_flag, interaction_span_days FROM it", **FEAT),
    "build_feature_matrix": q(f"""SELECT customer_id, customer_segment, is_active, is_dnc, employment_status, gender, region, recency_days, {', '.join(PLAIN)},
      {', '.join(r6(c) for c in REAL)} FROM fm""", **MATRIX),
    "scale_features": q("SELECT customer_id, " + ", ".join(
        r6(f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END", c) for c in SCALE) + " FROM fm", **MATRIX),
    "rfm_score_py": q(f"""SELECT customer_id, R, F, M, rfm_score, rfm_segment, customer_segment, recency_days, freq_12m, {r6('total_revenue')},
      {r6('annual_income')}, credit_score, n_active_products FROM rl""", **RFM),
    "rfm_label_py": q("SELECT customer_id, rfm_segment FROM rl", **RFM),
    "rfm_segment_stats": q(f"SELECT rfm_segment, customers, {gbp('rev_p')} AS total_revenue, min_score, max_score, {gbp('rev_p')} / customers AS mean_revenue FROM st", **RFM),
    "rfm_fm_grid": q("SELECT F, " + ", ".join(f"COALESCE(CAST(sum(R) FILTER (WHERE M = {i}) AS DOUBLE) / count(*) FILTER (WHERE M = {i}), 0.0) AS m{i}" for i in range(5))
                     + " FROM rl GROUP BY 1", **RFM),
    "rfm_bank_mix": q("""SELECT customer_segment, rfm_segment, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY customer_segment) AS DOUBLE) * 100.0 AS pct FROM
      (SELECT customer_segment, rfm_segment, count(*) AS n FROM rl GROUP BY 1, 2)""", **RFM),
    "rfm_profile": q(" UNION ALL ".join(f"""SELECT rfm_segment, '{m}' AS metric, round(avg(CAST({m} AS DOUBLE)), 4) AS mean,
      round(quantile_cont(CAST({m} AS DOUBLE), 0.5), 4) AS median, count(*) AS n FROM rl GROUP BY 1""" for m in PROFILE), **RFM),
    "rfm_radar": q("SELECT rfm_segment, " + ", ".join(r6(f"({m} - min({m}) OVER ()) / (max({m}) OVER () - min({m}) OVER () + 1e-9)", m) for m in RADAR) + f"""
      FROM (SELECT rfm_segment, max(recency_days) OVER () - recency_days AS recency_days, {', '.join(RADAR[1:])} FROM
        (SELECT rfm_segment, {', '.join(f'avg(CAST({m} AS DOUBLE)) AS {m}' for m in RADAR)} FROM rl WHERE rfm_segment IN
        ('Champions', 'Loyal Customers', 'At Risk', 'Can''t Lose Them', 'Hibernating', 'New Customers') GROUP BY 1))""", **RFM),
    "rfm_share": q(f"SELECT rfm_segment, {pct('customers', 'sum(customers) OVER ()', 1)} AS customers_pct, {pct('rev_p', 'sum(rev_p) OVER ()', 1)} AS revenue_pct FROM st", **RFM),
    "product_count": q("""SELECT customer_id, COALESCE(n, 0) AS number_of_products FROM customers LEFT JOIN
      (SELECT customer_id, count(*) AS n FROM customer_products WHERE status = 'Active' GROUP BY 1) USING (customer_id)"""),
    "allocate_contacts": q("SELECT campaign_id, target_segment, contacts_target, allocated FROM al", **ALLOC),
    "target_audience": q("""SELECT campaign_id, wn.pool, customer_id FROM wn JOIN pl ON wn.pool = pl.pool AND (pl.place - wn.start + wn.size) % wn.size < wn.n""", **AUDIENCE),
    "dnc_refresh": q(f"""SELECT customer_id, is_dnc AS was_dnc, is_dnc OR customer_id IN (SELECT customer_id FROM campaign_interactions WHERE {OPT}) AS is_dnc FROM customers"""),
    "src_csv_typed": q("""SELECT customer_id, customer_code, first_name, last_name, region, city, customer_segment, gender, employment_status,
      CAST(annual_income AS DOUBLE) AS annual_income, credit_score, number_of_products, is_active, is_dnc, date_of_birth, acquisition_date FROM customers"""),
    "src_parquet": "SELECT o_orderkey, o_custkey FROM orders",
    "bronze_audit": "SELECT 'orders.parquet' AS source_file, count(*) AS rows_loaded, count(*) AS rows_stamped FROM orders",
    "load_append": q(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows_loaded FROM {n}" for n in LOADED)),
    "load_reconcile": q(" UNION ALL ".join(f"""SELECT '{n}' AS table_name, 0 AS rows_before, count(*) AS source_rows, count(*) AS rows_after, count(*) AS rows_loaded,
      'OK' AS status, FALSE AS appended_to_existing FROM {n}""" for n in LOADED)),
    "load_totals": q("SELECT * FROM c UNION ALL SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM c",
                     c=" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in LOADED)),
    "upsert_seed": q("""SELECT product_id, product_code, product_name, product_category, CAST(revenue_value AS DOUBLE) AS revenue_value, min_eligibility_age, is_active FROM products
      UNION ALL SELECT (SELECT max(product_id) FROM products) + row_number() OVER (ORDER BY c), c, n, g, CAST(v AS DOUBLE), a, TRUE FROM (VALUES """
      + ", ".join(f"('{c}', '{n}', '{g}', {v}, {a})" for c, n, g, v, a in SEED) + ") AS s(c, n, g, v, a) WHERE c NOT IN (SELECT product_code FROM products)"),
    "default_columns": q("""SELECT customer_id, CASE WHEN annual_income IS NOT NULL THEN customer_segment ELSE 'Mass Market' END AS customer_segment,
      CASE WHEN gender IS NOT NULL THEN number_of_products ELSE 0 END AS number_of_products, CASE WHEN employment_status IS NOT NULL THEN is_active ELSE TRUE END AS is_active,
      FALSE AS is_dnc, TRUE AS stamped, TRUE AS touched FROM customers"""),
    "gold_views": q("""SELECT 'vw_campaign_performance' AS view_name, (SELECT count(*) FROM campaigns) AS row_count UNION ALL SELECT 'vw_channel_analysis', 5
      UNION ALL SELECT 'vw_customer_segments', (SELECT count(*) FROM customers WHERE is_active) UNION ALL SELECT 'vw_revenue_roi', (SELECT count(*) FROM campaign_conversions)
      UNION ALL SELECT 'vw_monthly_trends', (SELECT count(DISTINCT date_trunc('month', interaction_date)) FROM campaign_interactions)
      UNION ALL SELECT 'vw_ab_test_results', (SELECT count(*) FROM campaigns WHERE ab_test_enabled)"""),
    "sink_csv": q("SELECT customer_id, R, F, M, rfm_score, rfm_segment FROM rl", **RFM),
}
