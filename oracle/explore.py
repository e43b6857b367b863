"""DuckDB texts of the exploratory aggregates."""

from oracle.text import AS_OF, CONV, OPT, RESP, dbl, gbp, pct, q, rnd, when

AGE = f"CAST(floor(({AS_OF} - date_of_birth) / CAST(365.25 AS DOUBLE)) AS INTEGER)"
AGE_BAND = """CASE WHEN age > 17 AND age <= 25 THEN '18–25' WHEN age > 25 AND age <= 35 THEN '26–35' WHEN age > 35 AND age <= 45 THEN '36–45'
  WHEN age > 45 AND age <= 55 THEN '46–55' WHEN age > 55 AND age <= 65 THEN '56–65' WHEN age > 65 AND age <= 100 THEN '65+' END"""
CREDIT_BAND = """CASE WHEN credit_score > 299 AND credit_score <= 579 THEN 'Poor 300-579' WHEN credit_score > 579 AND credit_score <= 669 THEN 'Fair 580-669'
  WHEN credit_score > 669 AND credit_score <= 739 THEN 'Good 670-739' WHEN credit_score > 739 AND credit_score <= 799 THEN 'Very Good 740-799'
  WHEN credit_score > 799 AND credit_score <= 999 THEN 'Excellent 800+' END"""
WON = f"count(*) FILTER (WHERE {CONV})"


def share(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) * 100.0)"


def cvr_by(rows: str, band: str, name: str) -> str:
    return f"""SELECT {name}, contacts, conversions, {share('conversions', 'contacts')} AS cvr FROM
      (SELECT {band} AS {name}, count(*) AS contacts, {WON} AS conversions FROM {rows} GROUP BY 1) WHERE {name} IS NOT NULL"""


JOINED = f"(SELECT i.*, {AGE} AS age, annual_income, credit_score, customer_segment, region FROM campaign_interactions i JOIN customers USING (customer_id))"
BY_AGE = cvr_by(JOINED, AGE_BAND, "age_band")
BY_CREDIT = cvr_by(JOINED, CREDIT_BAND, "credit_band")
EDGES = dict(
    ji=f"SELECT *, CAST(annual_income AS DOUBLE) AS inc FROM {JOINED}",
    ed="""SELECT quantile_cont(inc, 0.2) AS e1, quantile_cont(inc, 0.4) AS e2, quantile_cont(inc, 0.6) AS e3, quantile_cont(inc, 0.8) AS e4 FROM ji""",
)
INCOME_BAND = """CASE WHEN inc <= e1 THEN 'Q1 (Lowest)' WHEN inc <= e2 THEN 'Q2' WHEN inc <= e3 THEN 'Q3' WHEN inc <= e4 THEN 'Q4'
  WHEN inc > e4 THEN 'Q5 (Highest)' END"""
BY_INCOME = cvr_by("ji, ed", INCOME_BAND, "income_quintile")

KPI = dict(
    ks=f"""SELECT campaign_id, count(*) AS total_contacts, {WON} AS total_conversions, {when(RESP)} AS total_responses, {when(OPT)} AS total_optouts
      FROM campaign_interactions GROUP BY 1""",
    kr="SELECT campaign_id, sum(rev_p) AS rev_p FROM campaign_conversions GROUP BY 1",
    ck=f"""SELECT c.campaign_id, campaign_code, campaign_type, status, channel_name, product_category, {dbl('total_budget')} AS total_budget,
      total_contacts, total_conversions, total_responses, total_optouts, {gbp('COALESCE(rev_p, 0)')} AS revenue,
      {share('total_conversions', 'total_contacts')} AS cvr, {share('total_responses', 'total_contacts')} AS rr,
      CAST(total_budget AS DOUBLE) / NULLIF(CAST(total_conversions AS DOUBLE), 0) AS cpa,
      (CAST(COALESCE(rev_p, 0) - CAST(total_budget * 100 AS BIGINT) AS DOUBLE) / 100.0) / CAST(total_budget AS DOUBLE) * 100.0 AS roi_pct,
      end_date - start_date AS duration
      FROM campaigns c JOIN products p USING (product_id) JOIN campaign_channels ch ON c.channel_id = ch.channel_id
      LEFT JOIN ks ON ks.campaign_id = c.campaign_id LEFT JOIN kr ON kr.campaign_id = c.campaign_id""",
)
DONE = "(SELECT * FROM ck WHERE status = 'Completed')"

CHAN = dict(
    cs=f"""SELECT channel_id, count(*) AS contacts, {WON} AS conversions, {when(OPT)} AS o, {when("interaction_outcome = 'Interested'")} AS i,
      {when("interaction_outcome = 'No Response'")} AS n FROM campaign_interactions GROUP BY 1""",
    st=f"""SELECT channel_name, contacts, conversions, {share('conversions', 'contacts')} AS cvr, {share('o', 'contacts')} AS opt_rate,
      {share('i', 'contacts')} AS int_rate, {share('n', 'contacts')} AS nr_rate, {gbp('rev_p')} AS revenue, {gbp('bud_p')} AS budget,
      (CAST(bud_p AS DOUBLE) / 100.0) / conversions AS cpa,
      (CAST(rev_p - bud_p AS DOUBLE) / 100.0) / (CAST(bud_p AS DOUBLE) / 100.0) * 100.0 AS roi_pct
      FROM cs JOIN campaign_channels USING (channel_id)
      LEFT JOIN (SELECT channel_id, sum(rev_p) AS rev_p FROM campaign_conversions GROUP BY 1) USING (channel_id)
      LEFT JOIN (SELECT channel_id, sum(CAST(total_budget * 100 AS BIGINT)) AS bud_p FROM campaigns GROUP BY 1) USING (channel_id)""",
)

SEG_REV = """SELECT customer_segment, CAST(sum(rev_p) AS DOUBLE) / 100.0 / 1000000 AS revenue_m FROM campaign_conversions JOIN customers USING (customer_id) GROUP BY 1"""

BINS = {"age": 30, "log_income": 40, "credit_score": 35, "total_budget": 15, "duration_days": 15, "recency_days": 40, "freq_12m": 20, "total_revenue": 40}
HIST = dict(
    tc=f"""SELECT customer_id, max(interaction_date) AS last, count(*) FILTER (WHERE interaction_date >= {AS_OF} - 365) AS freq
      FROM campaign_interactions GROUP BY 1""",
    lv=f"""SELECT 'age' AS metric, CAST({AGE} AS DOUBLE) AS v FROM customers
      UNION ALL SELECT 'log_income', ln(1 + CAST(annual_income AS DOUBLE)) FROM customers WHERE annual_income IS NOT NULL
      UNION ALL SELECT 'credit_score', credit_score FROM customers UNION ALL SELECT 'total_budget', total_budget FROM campaigns
      UNION ALL SELECT 'duration_days', end_date - start_date FROM campaigns UNION ALL SELECT 'recency_days', {AS_OF} - last FROM tc
      UNION ALL SELECT 'freq_12m', freq FROM tc WHERE freq > 0
      UNION ALL SELECT 'total_revenue', CAST(sum(rev_p) AS DOUBLE) / 100.0 FROM campaign_conversions GROUP BY customer_id HAVING sum(rev_p) > 0""",
    sp=f"""SELECT metric, min(v) AS lo, max(v) AS hi, any_value(CASE metric {' '.join(f"WHEN '{m}' THEN {n}" for m, n in BINS.items())} END) AS bins
      FROM lv GROUP BY 1""",
)

CORR = ["age", "annual_income", "credit_score", "number_of_products", "total_interactions", "pct_converted"]


def value_counts() -> str:
    one = lambda d, c, t, tail="": (f"SELECT * FROM (SELECT '{d}' AS dimension, {c} AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY 2 {tail})")
    g = "campaigns JOIN products USING (product_id) JOIN campaign_channels ch ON campaigns.channel_id = ch.channel_id"
    return " UNION ALL ".join([
        one("customer_segment", "customer_segment", "customers"), one("region", "region", "customers", "ORDER BY n DESC, value LIMIT 10"),
        one("employment_status", "employment_status", "customers"), one("campaign_type", "campaign_type", g),
        one("campaign_channel", "channel_name", g), one("campaign_product", "product_category", g), one("campaign_status", "status", g)])


SQL = {
    "enrich_lookup": q("""SELECT interaction_id, campaign_id, customer_id, channel_name, customer_segment, region FROM campaign_interactions
      LEFT JOIN campaign_channels USING (channel_id) LEFT JOIN customers USING (customer_id)"""),
    "age_band": q(f"SELECT customer_id, age, {AGE_BAND} AS age_band FROM (SELECT customer_id, {AGE} AS age FROM customers)"),
    "hist": q("""SELECT metric, bin, count(*) AS n, round(any_value(lo + (hi - lo) * bin / bins), 6) AS bin_from FROM
      (SELECT metric, lo, hi, bins, least(CAST(floor((v - lo) / (hi - lo) * bins) AS BIGINT), bins - 1) AS bin FROM lv JOIN sp USING (metric)) GROUP BY 1, 2""", **HIST),
    "value_counts": q(value_counts()),
    "income_by_segment": q(" UNION ALL ".join(
        f"""SELECT customer_segment, '{c}' AS metric, count({c}) AS n, round(avg({dbl(c)}), 4) AS mean, round(quantile_cont({dbl(c)}, 0.25), 4) AS q1,
          round(quantile_cont({dbl(c)}, 0.5), 4) AS median, round(quantile_cont({dbl(c)}, 0.75), 4) AS q3 FROM customers GROUP BY 1"""
        for c in ("annual_income", "credit_score"))),
    "cvr_by_age": q(BY_AGE),
    "cvr_by_credit_band": q(BY_CREDIT),
    "cvr_by_income_quintile": q(BY_INCOME, **EDGES),
    "argbest_band": q(" UNION ALL ".join(
        f"SELECT * FROM (SELECT '{d}' AS dimension, {c} AS band, cvr FROM ({t}) ORDER BY cvr DESC, {c} DESC LIMIT 1)"
        for d, c, t in (("age", "age_band", BY_AGE), ("income", "income_quintile", BY_INCOME), ("credit", "credit_band", BY_CREDIT))), **EDGES),
    "corr_matrix": q(" UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM cf" for i, a in enumerate(CORR) for b in CORR[i + 1:]),
        cf=f"""SELECT CAST({AGE} AS DOUBLE) AS age, {dbl('annual_income')} AS annual_income, {dbl('credit_score')} AS credit_score,
          {dbl('number_of_products')} AS number_of_products, {dbl('n')} AS total_interactions, {share('w', 'n')} AS pct_converted FROM customers
          JOIN (SELECT customer_id, count(*) AS n, {WON} AS w FROM campaign_interactions GROUP BY 1) USING (customer_id)
          WHERE annual_income IS NOT NULL AND credit_score IS NOT NULL"""),
    "camp_kpi": q("SELECT * FROM ck", **KPI),
    "cvr_by_type": q(f"""SELECT campaign_type, count(cvr) AS n, round(quantile_cont(cvr, 0.5), 6) AS median_cvr, round(quantile_cont(cvr, 0.25), 6) AS q1_cvr,
      round(quantile_cont(cvr, 0.75), 6) AS q3_cvr, round((SELECT avg(cvr) FROM {DONE}), 6) AS overall_mean_cvr FROM {DONE} GROUP BY 1""", **KPI),
    "roi_by_product": q(f"""SELECT *, CASE WHEN median_roi_pct >= 200 THEN 'at or above 200' WHEN median_roi_pct >= 100 THEN 'at or above 100' ELSE 'below 100' END AS roi_band
      FROM (SELECT product_category, round(quantile_cont(roi_pct, 0.5), 6) AS median_roi_pct FROM {DONE} GROUP BY 1)""", **KPI),
    "top10_cvr": q(f"SELECT campaign_code, channel_name, product_category, cvr FROM {DONE} ORDER BY cvr DESC NULLS LAST, campaign_code LIMIT 10", **KPI),
    "channel_cpa": q(f"SELECT channel_name, {rnd('sum(CAST(total_budget * 100 AS BIGINT))', '100 * sum(total_conversions)', 2)} AS cpa FROM {DONE} GROUP BY 1", **KPI),
    "monthly_cvr": q(f"""SELECT month_start, contacts, conversions, {share('conversions', 'contacts')} AS cvr FROM (SELECT
      CAST(date_trunc('month', interaction_date) AS DATE) AS month_start, count(*) AS contacts, {WON} AS conversions FROM campaign_interactions GROUP BY 1)"""),
    "channel_stats": q("SELECT * FROM st", **CHAN),
    "argbest_channel": q("""SELECT arg_max(channel_name, cvr) AS best_cvr, arg_max(channel_name, roi_pct) AS best_roi, arg_min(channel_name, cpa) AS lowest_cpa FROM st""", **CHAN),
    "ab_overall": q(f"""SELECT ab_variant, contacts, conversions, cvr, revenue, (b - a) / a * 100 AS relative_uplift_pct, CASE WHEN b > a THEN 'B' ELSE 'A' END AS winner
      FROM ov, (SELECT max(cvr) FILTER (WHERE ab_variant = 'A') AS a, max(cvr) FILTER (WHERE ab_variant = 'B') AS b FROM ov)""",
      ov=f"""SELECT ab_variant, contacts, conversions, {share('conversions', 'contacts')} AS cvr, {gbp('COALESCE(rev_p, 0)')} AS revenue FROM
        (SELECT ab_variant, count(*) AS contacts, {WON} AS conversions FROM campaign_interactions WHERE ab_variant IS NOT NULL GROUP BY 1)
        LEFT JOIN (SELECT ab_variant, sum(rev_p) AS rev_p FROM campaign_conversions GROUP BY 1) USING (ab_variant)"""),
    "ab_campaign_pivot": q(f"""SELECT *, {share('count(*) FILTER (WHERE uplift > 0) OVER ()', 'count(*) OVER ()')} AS b_wins_pct FROM pv""",
      pv=f"""SELECT campaign_id, cvr_a, cvr_b, cvr_b - cvr_a AS uplift FROM (SELECT campaign_id, max(c) FILTER (WHERE ab_variant = 'A') AS cvr_a,
        max(c) FILTER (WHERE ab_variant = 'B') AS cvr_b FROM (SELECT campaign_id, ab_variant, {share(WON, 'count(*)')} AS c FROM campaign_interactions
        WHERE ab_variant IS NOT NULL GROUP BY 1, 2) GROUP BY 1) WHERE cvr_a IS NOT NULL AND cvr_b IS NOT NULL"""),
    "funnel_rows": q(f"""SELECT stage, n, {share('n', 's1')} AS pct_of_contacts, {share('n', 'p')} AS pct_of_previous FROM
      (SELECT '1. Contacted' AS stage, s1 AS n, s1, NULL AS p FROM f UNION ALL SELECT '2. Engaged', s2, s1, s1 FROM f
       UNION ALL SELECT '3. Responded', s3, s1, s2 FROM f UNION ALL SELECT '4. Converted', s4, s1, s3 FROM f
       UNION ALL SELECT '5. Activated', (SELECT count(*) FROM customer_products WHERE status = 'Active'), s1, s4 FROM f)""",
      f=f"""SELECT count(*) AS s1, {when("interaction_type IN ('Opened','Clicked','Called','Visited Branch','Web Visit')")} AS s2,
        {when(RESP)} AS s3, {WON} AS s4 FROM campaign_interactions"""),
    "segment_cvr": q(cvr_by(JOINED, "customer_segment", "customer_segment")),
    "segment_product_mix": q("SELECT customer_segment, " + ", ".join(
        f"count(*) FILTER (WHERE product_category = '{c}') AS {c.lower().replace(' ', '_')}"
        for c in ("Credit Card", "Savings Account", "Fixed Deposit", "Personal Loan", "Home Loan")) + """
      FROM campaign_conversions JOIN products USING (product_id) JOIN customers USING (customer_id) GROUP BY 1"""),
    "segment_revenue": q(SEG_REV),
    "products_held_dist": q("SELECT customer_segment, " + ", ".join(f"count(*) FILTER (WHERE n = {i}) AS products_{i}" for i in (1, 2, 3, 4)) + """, count(*) FILTER (WHERE n >= 5) AS products_5_plus
      FROM (SELECT customer_id, count(*) AS n FROM customer_products WHERE status = 'Active' GROUP BY 1) JOIN customers USING (customer_id) GROUP BY 1"""),
    "category_cvr": q(cvr_by("campaign_interactions JOIN campaigns USING (campaign_id) JOIN products USING (product_id)", "product_category", "product_category")),
    "category_rev": q(f"""SELECT product_category, {gbp('sum(rev_p)')} AS total_revenue, count(*) AS conversions,
      (CAST(sum(rev_p) AS DOUBLE) / 100.0) / count(*) AS rev_per_conv FROM campaign_conversions JOIN products USING (product_id) GROUP BY 1"""),
    "region_stats": q(f"""SELECT *, cvr >= avg(cvr) OVER () AS above_mean_cvr, round(avg(cvr) OVER (), 6) AS mean_cvr FROM
      (SELECT * FROM ({cvr_by(JOINED, 'region', 'region')}) ORDER BY conversions DESC, region LIMIT 12)"""),
    "rfm_distributions": q(f"""SELECT (SELECT count(*) FROM tc) AS with_interactions, (SELECT count(*) FROM tc WHERE freq > 0) AS active_12m,
      (SELECT count(*) FROM mo) AS ever_converted, (SELECT count(*) FROM customers) - (SELECT count(*) FROM mo) AS never_converted,
      {dbl('(SELECT count(*) FROM mo)')} / (SELECT count(*) FROM customers) * 100 AS ever_converted_pct,
      (SELECT quantile_cont({AS_OF} - last, 0.5) FROM tc) AS median_recency, (SELECT quantile_cont(freq, 0.5) FROM tc WHERE freq > 0) AS median_freq_12m,
      (SELECT quantile_cont(r, 0.5) FROM mo WHERE r > 0) AS median_revenue""", tc=HIST["tc"],
      mo="SELECT customer_id, CAST(sum(rev_p) AS DOUBLE) / 100.0 AS r FROM campaign_conversions GROUP BY 1"),
    "exec_summary": q(f"""SELECT (SELECT count(*) FROM customers) AS total_customers, (SELECT count(*) FROM campaigns) AS total_campaigns, contacts AS total_contacts,
      n AS total_conversions, {share('won', 'contacts')} AS overall_cvr, {gbp('rev_p')} AS total_revenue, {gbp('bud_p')} AS total_budget,
      (CAST(rev_p - bud_p AS DOUBLE) / 100.0) / (CAST(bud_p AS DOUBLE) / 100.0) * 100.0 AS overall_roi, (CAST(bud_p AS DOUBLE) / 100.0) / n AS average_cpa,
      (SELECT arg_max(customer_segment, revenue_m) FROM ({SEG_REV})) AS top_revenue_segment, (SELECT arg_max(channel_name, cvr) FROM st) AS top_cvr_channel
      FROM (SELECT count(*) AS contacts, {WON} AS won FROM campaign_interactions), (SELECT count(*) AS n, sum(rev_p) AS rev_p FROM campaign_conversions),
      (SELECT sum(CAST(total_budget * 100 AS BIGINT)) AS bud_p FROM campaigns)""", **CHAN),
    "cvr_summary": q(f"""SELECT *, {pct('conversions', 'contacts', 1)} AS cvr_pct FROM (SELECT 'channel' AS dimension, channel_name AS value, count(*) AS contacts, {WON} AS conversions
      FROM campaign_interactions JOIN campaign_channels USING (channel_id) GROUP BY 2
      UNION ALL SELECT 'segment', customer_segment, count(*), {WON} FROM {JOINED} GROUP BY 2)"""),
}
