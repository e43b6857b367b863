"""DuckDB texts of the scorecard views and the queries on them."""

from oracle.text import AS_OF, CONV, OPT, RESP, dbl, gbp, pct, q, rnd, when

COUNTS = f"""count(*) AS total_contacts, {when(CONV)} AS total_conversions, {when(RESP)} AS total_responses,
  {when(OPT)} AS total_optouts, {when("interaction_outcome = 'Interested'")} AS total_interested,
  {when("interaction_outcome = 'Callback Requested'")} AS total_callbacks,
  {when("interaction_outcome = 'Declined'")} AS total_declined,
  {when("interaction_outcome = 'No Response'")} AS total_no_response"""
NAMES = ["total_contacts", "total_conversions", "total_responses", "total_optouts", "total_interested",
         "total_callbacks", "total_declined", "total_no_response"]

PERF = dict(
    s=f"SELECT campaign_id, {COUNTS} FROM campaign_interactions GROUP BY campaign_id",
    r="SELECT campaign_id, sum(rev_p) AS rev_p, count(*) AS n FROM campaign_conversions GROUP BY campaign_id",
    b="""SELECT c.*, product_name, product_category, channel_name, benchmark_cvr, benchmark_cpa, benchmark_ctr,
      CAST(total_budget * 100 AS BIGINT) AS bud_p, """ + ", ".join(f"COALESCE({n}, 0) AS {n}" for n in NAMES) + """,
      COALESCE(rev_p, 0) AS rev_p, COALESCE(n, 0) AS n
      FROM campaigns c JOIN products p ON c.product_id = p.product_id
      JOIN campaign_channels ch ON c.channel_id = ch.channel_id
      LEFT JOIN s ON c.campaign_id = s.campaign_id LEFT JOIN r ON c.campaign_id = r.campaign_id""",
    k=f"""SELECT *, {pct('total_conversions', 'total_contacts')} AS conversion_rate_pct,
      {pct('total_responses', 'total_contacts')} AS response_rate_pct,
      {pct('total_optouts', 'total_contacts')} AS optout_rate_pct,
      {rnd('bud_p', 'total_conversions * 100', 2)} AS cost_per_acquisition,
      {rnd('(rev_p - bud_p) * 100', 'bud_p', 1)} AS roi_pct FROM b""",
    perf=f"""SELECT campaign_id, campaign_code, campaign_name, campaign_type, status AS campaign_status, product_id,
      product_name, product_category, channel_id, channel_name, target_segment, campaign_manager, ab_test_enabled,
      start_date, end_date, end_date - start_date AS campaign_duration_days, year(start_date) AS campaign_year,
      quarter(start_date) AS campaign_quarter, concat('Q', quarter(start_date)) AS campaign_quarter_label,
      strftime(start_date, '%Y-%m') AS campaign_month, strftime(start_date, '%b %Y') AS campaign_month_label,
      {dbl('total_budget')} AS total_budget, contacts_target, {', '.join(NAMES)}, conversion_rate_pct, response_rate_pct,
      optout_rate_pct, cost_per_acquisition, {gbp('rev_p')} AS revenue_attributed,
      COALESCE({rnd('rev_p', 'n * 100', 2)}, 0.0) AS avg_revenue_per_conversion, roi_pct,
      {gbp('rev_p - bud_p')} AS net_revenue,
      CASE WHEN cost_per_acquisition <= 45 THEN 'Within Benchmark' ELSE 'Exceeds Benchmark' END AS cpa_status,
      CASE WHEN roi_pct >= 200 THEN 'Above Target' ELSE 'Below Target' END AS roi_status,
      {dbl('benchmark_cvr')} AS channel_benchmark_cvr, {dbl('benchmark_cpa')} AS channel_benchmark_cpa,
      round(conversion_rate_pct - benchmark_cvr, 2) AS cvr_vs_benchmark FROM k""",
)

CHANNEL = dict(
    cs=f"""SELECT channel_id, count(*) AS total_contacts, {when(CONV)} AS total_conversions, {when(RESP)} AS total_responses,
      {when(OPT)} AS total_optouts, count(DISTINCT campaign_id) AS campaigns_using_channel,
      count(DISTINCT customer_id) AS unique_customers_reached FROM campaign_interactions GROUP BY channel_id""",
    cr="SELECT channel_id, sum(rev_p) AS rev_p FROM campaign_conversions GROUP BY channel_id",
    cb="""SELECT channel_id, sum(CAST(total_budget * 100 AS BIGINT)) AS bud_p, count(*) AS total_campaigns
      FROM campaigns GROUP BY channel_id""",
    j=f"""SELECT ch.*, COALESCE(total_contacts, 0) AS total_contacts, COALESCE(total_conversions, 0) AS total_conversions,
      COALESCE(total_responses, 0) AS total_responses, COALESCE(total_optouts, 0) AS total_optouts,
      COALESCE(campaigns_using_channel, 0) AS campaigns_using_channel,
      COALESCE(unique_customers_reached, 0) AS unique_customers_reached, COALESCE(rev_p, 0) AS rev_p,
      COALESCE(bud_p, 0) AS bud_p, COALESCE(total_campaigns, 0) AS total_campaigns
      FROM campaign_channels ch LEFT JOIN cs ON ch.channel_id = cs.channel_id LEFT JOIN cr ON ch.channel_id = cr.channel_id
      LEFT JOIN cb ON ch.channel_id = cb.channel_id WHERE ch.is_active""",
    chan=f"""SELECT *, {pct('total_conversions', 'total_contacts')} AS conversion_rate_pct,
      {rnd('bud_p', 'total_conversions * 100', 2)} AS cost_per_acquisition FROM j""",
    view=f"""SELECT channel_id, channel_name, channel_description, total_contacts, total_conversions, total_responses,
      total_optouts, campaigns_using_channel, unique_customers_reached, conversion_rate_pct,
      {pct('total_responses', 'total_contacts')} AS response_rate_pct, {pct('total_optouts', 'total_contacts')} AS optout_rate_pct,
      {gbp('bud_p')} AS total_spend, total_campaigns, cost_per_acquisition, {gbp('rev_p')} AS total_revenue,
      {rnd('rev_p', 'total_conversions * 100', 2)} AS revenue_per_conversion,
      {rnd('(rev_p - bud_p) * 100', 'bud_p', 1)} AS roi_pct, {dbl('benchmark_cvr')} AS benchmark_cvr,
      {dbl('benchmark_cpa')} AS benchmark_cpa, round(conversion_rate_pct - benchmark_cvr, 2) AS cvr_gap_vs_benchmark,
      round(cost_per_acquisition - benchmark_cpa, 2) AS cpa_gap_vs_benchmark,
      CASE WHEN conversion_rate_pct >= benchmark_cvr THEN 'Above Benchmark' ELSE 'Below Benchmark' END AS cvr_benchmark_status,
      CASE WHEN cost_per_acquisition <= benchmark_cpa THEN 'Within Benchmark' ELSE 'Exceeds Benchmark' END AS cpa_benchmark_status,
      CASE WHEN total_conversions > 0 THEN
        {rnd('CAST(total_conversions AS HUGEINT) * total_conversions * 10000', 'CAST(total_contacts AS HUGEINT) * bud_p', 4)}
        END AS efficiency_index FROM chan""",
)

TYPED = dict(
    tw=f"""SELECT i.interaction_id, i.customer_id, p.product_category,
      row_number() OVER (PARTITION BY i.customer_id ORDER BY response_date NULLS LAST, interaction_date, interaction_id) AS rc,
      row_number() OVER (PARTITION BY i.customer_id, p.product_category ORDER BY response_date NULLS LAST, interaction_date, interaction_id) AS rk
      FROM campaign_interactions i JOIN campaigns c ON i.campaign_id = c.campaign_id
      JOIN products p ON c.product_id = p.product_id WHERE {CONV}""",
    typed="""SELECT interaction_id, customer_id, product_category,
      CASE WHEN rc = 1 THEN 'New' WHEN rk > 1 THEN 'Upsell' ELSE 'Cross-Sell' END AS conversion_type FROM tw""",
)

DATES = """year(conversion_date) AS conversion_year, quarter(conversion_date) AS conversion_quarter,
  concat('Q', quarter(conversion_date)) AS conversion_quarter_label, strftime(conversion_date, '%Y-%m') AS conversion_month,
  strftime(conversion_date, '%b %Y') AS conversion_month_label, dayofweek(conversion_date) AS conversion_day_of_week,
  rpad(strftime(conversion_date, '%A'), 9, ' ') AS conversion_day_name"""

ROI = dict(TYPED, roi=f"""SELECT conversion_id, conversion_date, conversion_type, {dbl('revenue_attributed')} AS revenue_attributed,
  ab_variant, {DATES}, c.campaign_id, campaign_code, campaign_name, campaign_type, {dbl('total_budget')} AS campaign_budget,
  c.start_date AS campaign_start_date, c.end_date AS campaign_end_date, p.product_id, product_name, p.product_category,
  {dbl('revenue_value')} AS product_standard_revenue, ch.channel_id, channel_name, {dbl('benchmark_cpa')} AS benchmark_cpa,
  cu.customer_id, customer_segment, region, {dbl('annual_income')} AS customer_annual_income,
  credit_score AS customer_credit_score, {gbp('rev_p - CAST(revenue_value * 100 AS BIGINT)')} AS revenue_variance_vs_standard,
  {rnd('rev_p * 100', 'CAST(total_budget * 100 AS BIGINT)', 4)} AS revenue_as_pct_of_budget
  FROM campaign_conversions cv JOIN campaigns c ON cv.campaign_id = c.campaign_id JOIN products p ON cv.product_id = p.product_id
  JOIN campaign_channels ch ON cv.channel_id = ch.channel_id JOIN customers cu ON cv.customer_id = cu.customer_id
  LEFT JOIN typed ON typed.interaction_id = cv.interaction_id""")

MONTH = "CAST(date_trunc('month', {}) AS DATE)"
BASE_COLS = """month_start, strftime(month_start, '%Y-%m') AS month_key, strftime(month_start, '%b %Y') AS month_label,
  year(month_start) AS year_num, quarter(month_start) AS quarter_num, month(month_start) AS month_num"""

TREND = dict(
    mb0=f"""SELECT {MONTH.format('interaction_date')} AS month_start, count(*) AS total_contacts, {when(CONV)} AS total_conversions,
      {when(RESP)} AS total_responses, {when(OPT)} AS total_optouts, count(DISTINCT customer_id) AS unique_customers_contacted,
      count(DISTINCT campaign_id) AS active_campaigns FROM campaign_interactions GROUP BY 1""",
    mb=f"SELECT {BASE_COLS}, * EXCLUDE (month_start) FROM mb0",
    mr=f"""SELECT {MONTH.format('conversion_date')} AS month_start, sum(rev_p) AS rev_p, count(*) AS n
      FROM campaign_conversions GROUP BY 1""",
    bud=f"""SELECT month_start, round(sum(CAST(total_budget AS DOUBLE) / days * day(last_day(month_start))), 4) AS apportioned_budget
      FROM (SELECT total_budget, greatest(end_date - start_date + 1, 1) AS days,
        CAST(unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date), INTERVAL 1 MONTH)) AS DATE) AS month_start
        FROM campaigns) GROUP BY 1""",
    co=f"""SELECT mb.*, COALESCE(rev_p, 0) AS rev_p, COALESCE(CAST(rev_p AS DOUBLE) / 100.0 / n, 0.0) AS avg_revenue_per_conversion,
      COALESCE(apportioned_budget, 0.0) AS apportioned_budget,
      {pct('total_conversions', 'total_contacts')} AS conversion_rate_pct, {pct('total_responses', 'total_contacts')} AS response_rate_pct,
      {pct('total_optouts', 'total_contacts')} AS optout_rate_pct,
      CAST(round({pct('total_conversions', 'total_contacts')} * 100) AS BIGINT) AS bp
      FROM mb LEFT JOIN mr ON mb.month_start = mr.month_start LEFT JOIN bud ON mb.month_start = bud.month_start""",
    cl="""SELECT *, lag(total_conversions) OVER w AS pc, lag(rev_p) OVER w AS pr, lag(bp) OVER w AS pb,
      lag(total_conversions, 12) OVER w AS ly, CAST(sum(total_conversions) OVER td AS BIGINT) AS cc, sum(rev_p) OVER td AS cr,
      sum(total_conversions) OVER l3 AS s3, sum(bp) OVER l3 AS b3, count(*) OVER l3 AS n3
      FROM co WINDOW w AS (ORDER BY month_start), td AS (ORDER BY month_start ROWS UNBOUNDED PRECEDING),
      l3 AS (ORDER BY month_start ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
TRENDS = f"""SELECT month_start, month_key, month_label, year_num, quarter_num, month_num, total_contacts, total_conversions,
  total_responses, total_optouts, unique_customers_contacted, active_campaigns, {gbp('rev_p')} AS total_revenue,
  avg_revenue_per_conversion, apportioned_budget, conversion_rate_pct, response_rate_pct, optout_rate_pct,
  total_conversions - pc AS conversions_mom_change, {pct('total_conversions - pc', 'pc', 1)} AS conversions_mom_pct_change,
  {rnd('rev_p - pr', '100', 0)} AS revenue_mom_change, {pct('rev_p - pr', 'pr', 1)} AS revenue_mom_pct_change,
  {gbp('bp - pb')} AS cvr_mom_pp_change, ly AS conversions_same_month_ly,
  {pct('total_conversions - ly', 'ly', 1)} AS conversions_yoy_pct_change, cc AS cumulative_conversions,
  {rnd('cr', '100', 0)} AS cumulative_revenue, {rnd('s3', 'n3', 1)} AS conversions_3m_avg, {rnd('b3', 'n3 * 100', 2)} AS cvr_3m_avg,
  rank() OVER (PARTITION BY year_num ORDER BY total_conversions DESC) AS rank_by_conversions_in_year,
  rank() OVER (PARTITION BY year_num ORDER BY rev_p DESC) AS rank_by_revenue_in_year FROM cl"""

AB = dict(
    ac=f"""SELECT campaign_id, ab_variant, count(*) AS contacts, {when(CONV)} AS conversions, {when(RESP)} AS responses,
      {when(OPT)} AS optouts FROM campaign_interactions WHERE ab_variant IS NOT NULL GROUP BY 1, 2""",
    ar="""SELECT campaign_id, ab_variant, sum(rev_p) AS rev_p, count(*) AS variant_conversions
      FROM campaign_conversions WHERE ab_variant IS NOT NULL GROUP BY 1, 2""",
    va=f"""SELECT ac.*, COALESCE(rev_p, 0) AS rev_p, CAST(round({pct('conversions', 'contacts')} * 100) AS BIGINT) AS bp
      FROM ac LEFT JOIN ar ON ac.campaign_id = ar.campaign_id AND ac.ab_variant = ar.ab_variant""",
    ab="""SELECT c.campaign_id, campaign_code, campaign_name, campaign_type, product_name, product_category, channel_name,
      start_date, end_date, COALESCE(a.contacts, 0) AS a_contacts, COALESCE(a.conversions, 0) AS a_conversions,
      COALESCE(a.bp, 0) AS a_bp, COALESCE(a.rev_p, 0) AS a_rev, COALESCE(b.contacts, 0) AS b_contacts,
      COALESCE(b.conversions, 0) AS b_conversions, COALESCE(b.bp, 0) AS b_bp, COALESCE(b.rev_p, 0) AS b_rev
      FROM campaigns c JOIN products p ON c.product_id = p.product_id JOIN campaign_channels ch ON c.channel_id = ch.channel_id
      LEFT JOIN va a ON c.campaign_id = a.campaign_id AND a.ab_variant = 'A'
      LEFT JOIN va b ON c.campaign_id = b.campaign_id AND b.ab_variant = 'B' WHERE ab_test_enabled""",
    abv=f"""SELECT * EXCLUDE (a_bp, b_bp, a_rev, b_rev), {gbp('a_bp')} AS a_cvr, {gbp('b_bp')} AS b_cvr, {gbp('a_rev')} AS a_revenue,
      {gbp('b_rev')} AS b_revenue, {gbp('b_bp - a_bp')} AS cvr_uplift_pp, {pct('b_bp - a_bp', 'a_bp', 1)} AS cvr_relative_uplift_pct,
      {rnd('b_rev - a_rev', '100', 0)} AS revenue_uplift,
      CASE WHEN b_bp > a_bp THEN 'B' WHEN a_bp > b_bp THEN 'A' ELSE 'No Clear Winner' END AS winning_variant,
      CASE WHEN a_bp > 0 AND abs(b_bp - a_bp) * 10 > a_bp THEN 'Recommend Scale-Up of Winning Variant'
        ELSE 'Inconclusive — Continue Testing' END AS scale_recommendation FROM ab""",
)

RFM = dict(
    ia=f"""SELECT customer_id, max(interaction_date) AS last_interaction_date, count(*) AS total_interactions_all_time,
      count(*) FILTER (WHERE interaction_date >= {AS_OF} - INTERVAL 12 MONTH) AS interactions_last_12m,
      count(*) FILTER (WHERE interaction_date >= {AS_OF} - INTERVAL 12 MONTH AND {CONV}) AS conversions_last_12m
      FROM campaign_interactions GROUP BY 1""",
    ca="SELECT customer_id, sum(rev_p) AS rev_p, count(*) AS total_conversions FROM campaign_conversions GROUP BY 1",
    ha="""SELECT customer_id, count(*) FILTER (WHERE status = 'Active') AS active_products, count(*) AS total_products_ever,
      sum(val_p) FILTER (WHERE status = 'Active') AS bal_p FROM customer_products GROUP BY 1""",
    base=f"""SELECT cu.customer_id, customer_code, first_name, last_name, customer_segment, region,
      {dbl('annual_income')} AS annual_income, credit_score, acquisition_date, is_dnc, last_interaction_date,
      COALESCE({AS_OF} - last_interaction_date, 9999) AS recency_days, COALESCE(interactions_last_12m, 0) AS interactions_last_12m,
      COALESCE(conversions_last_12m, 0) AS conversions_last_12m, total_interactions_all_time, COALESCE(rev_p, 0) AS rev_p,
      COALESCE(total_conversions, 0) AS total_conversions, COALESCE(active_products, 0) AS active_products,
      COALESCE(total_products_ever, 0) AS total_products_ever, COALESCE(bal_p, 0) AS bal_p
      FROM customers cu LEFT JOIN ia ON cu.customer_id = ia.customer_id LEFT JOIN ca ON cu.customer_id = ca.customer_id
      LEFT JOIN ha ON cu.customer_id = ha.customer_id WHERE is_active""",
    sc="""SELECT *, 6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS r_score,
      ntile(5) OVER (ORDER BY interactions_last_12m, customer_id) AS f_score, ntile(5) OVER (ORDER BY rev_p, customer_id) AS m_score FROM base""",
    seg="""SELECT *, r_score * 100 + f_score * 10 + m_score AS rfm_score,
      CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
           WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 3 THEN 'Loyal Customers'
           WHEN r_score >= 3 AND f_score >= 2 THEN 'Potential Loyalists' WHEN r_score >= 2 AND f_score >= 2 THEN 'At Risk'
           WHEN r_score = 5 AND f_score <= 1 THEN 'New Customers' ELSE 'Lost' END AS rfm_segment,
      CASE WHEN is_dnc THEN 'Excluded — DNC' WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Priority: Upsell / Reward'
           WHEN r_score >= 3 AND f_score >= 3 THEN 'Include: Retention Campaign'
           WHEN r_score >= 3 AND f_score >= 2 THEN 'Include: Cross-Sell Campaign'
           WHEN r_score <= 2 AND f_score <= 2 THEN 'Include: Win-Back Campaign' ELSE 'Monitor — No Action' END AS targeting_recommendation
      FROM sc""",
)
RFM_BASE = {n: RFM[n] for n in ("ia", "ca", "ha", "base")}
SEG_OUT = f"""* EXCLUDE (rev_p, bal_p), {gbp('rev_p')} AS total_revenue_attributed, {gbp('bal_p')} AS total_product_balance"""

COHORT = dict(
    cc="""SELECT customer_id, CAST(date_trunc('month', acquisition_date) AS DATE) AS cohort_start FROM customers WHERE is_active""",
    cz="SELECT cohort_start, count(DISTINCT customer_id) AS cohort_size FROM cc GROUP BY 1",
)
AGE = "(year({0}) * 12 + month({0})) - (year(cohort_start) * 12 + month(cohort_start))"
CM = "strftime(cohort_start, '%Y-%m') AS cohort_month"


def pick(cols: str, **extra) -> str:
    return f"SELECT campaign_id, {cols} FROM perf"


COMPLETED = "FROM perf WHERE campaign_status = 'Completed'"

SQL = {
    "campaign_performance": q("SELECT * FROM perf", **PERF),
    "outcome_counts": q(f"SELECT campaign_id, {COUNTS} FROM campaign_interactions GROUP BY campaign_id"),
    "campaign_revenue": q(f"""SELECT campaign_id, {gbp('sum(rev_p)')} AS total_revenue, count(*) AS conversion_count,
      CAST(sum(rev_p) AS DOUBLE) / 100.0 / count(*) AS avg_revenue_per_conversion FROM campaign_conversions GROUP BY 1"""),
    "kpi_rates": q(pick("conversion_rate_pct, response_rate_pct, optout_rate_pct"), **PERF),
    "kpi_cpa": q(pick("total_budget, total_conversions, cost_per_acquisition"), **PERF),
    "kpi_roi": q(pick("revenue_attributed, total_budget, roi_pct"), **PERF),
    "kpi_net_revenue": q(pick("net_revenue, avg_revenue_per_conversion"), **PERF),
    "flag_cpa": q(pick("cost_per_acquisition, cpa_status"), **PERF),
    "flag_roi": q(pick("roi_pct, roi_status"), **PERF),
    "benchmark_gap": q("""SELECT channel_id, conversion_rate_pct, cost_per_acquisition, cvr_gap_vs_benchmark, cpa_gap_vs_benchmark,
      cvr_benchmark_status, cpa_benchmark_status FROM view""", **CHANNEL),
    "campaign_dates": q(pick("""campaign_duration_days, campaign_year, campaign_quarter, campaign_quarter_label,
      campaign_month, campaign_month_label"""), **PERF),
    "channel_analysis": q("SELECT * FROM view", **CHANNEL),
    "channel_reach": q("""SELECT channel_id, total_contacts, total_conversions, total_responses, total_optouts,
      campaigns_using_channel, unique_customers_reached FROM cs""", **CHANNEL),
    "efficiency_index": q("SELECT channel_id, efficiency_index FROM view", **CHANNEL),
    "revenue_roi": q("SELECT * FROM roi", **ROI),
    "conversion_type": q("SELECT * FROM typed", **TYPED),
    "conversion_dates": q(f"SELECT conversion_id, {DATES} FROM campaign_conversions"),
    "revenue_variance": q("SELECT conversion_id, revenue_variance_vs_standard, revenue_as_pct_of_budget FROM roi", **ROI),
    "monthly_base": q("SELECT * FROM mb", **TREND),
    "monthly_revenue": q(f"""SELECT month_start, {gbp('rev_p')} AS total_revenue, n AS conversion_count,
      CAST(rev_p AS DOUBLE) / 100.0 / n AS avg_revenue_per_conversion FROM mr""", **TREND),
    "monthly_budget": q("SELECT * FROM bud", **TREND),
    "monthly_trends": q(TRENDS, **TREND),
    **{n: q(f"SELECT month_start, {c} FROM (SELECT * FROM trends)", **TREND, trends=TRENDS) for n, c in {
        "trend_mom": "conversions_mom_change, conversions_mom_pct_change, revenue_mom_change, revenue_mom_pct_change, cvr_mom_pp_change",
        "trend_yoy": "conversions_same_month_ly, conversions_yoy_pct_change",
        "trend_cumulative": "cumulative_conversions, cumulative_revenue",
        "trend_rolling3": "conversions_3m_avg, cvr_3m_avg",
        "trend_year_rank": "year_num, rank_by_conversions_in_year, rank_by_revenue_in_year"}.items()},
    "ab_test_results": q("SELECT * FROM abv", **AB),
    "ab_counts": q("SELECT * FROM ac", **AB),
    "ab_revenue": q(f"SELECT campaign_id, ab_variant, {gbp('rev_p')} AS variant_revenue, variant_conversions FROM ar", **AB),
    "ab_uplift": q("SELECT campaign_id, cvr_uplift_pp, cvr_relative_uplift_pct, revenue_uplift FROM abv", **AB),
    "ab_winner": q("SELECT campaign_id, winning_variant, scale_recommendation FROM abv", **AB),
    "rfm_inputs": q(f"""SELECT customer_id, last_interaction_date, total_interactions_all_time, interactions_last_12m,
      conversions_last_12m, {gbp('rev_p')} AS total_revenue, total_conversions, active_products, total_products_ever,
      {gbp('bal_p')} AS total_balance FROM ia FULL JOIN ca USING (customer_id) FULL JOIN ha USING (customer_id)""", **RFM),
    "rfm_combine": q(f"SELECT {SEG_OUT} FROM base", **RFM),
    "customer_segments": q(f"SELECT {SEG_OUT} FROM seg", **RFM),
    "rfm_score_sql": q("SELECT customer_id, r_score, f_score, m_score, rfm_score FROM seg", **RFM),
    "rfm_label_sql": q("SELECT customer_id, rfm_segment FROM seg", **RFM),
    "rfm_recommend": q("SELECT customer_id, targeting_recommendation FROM seg", **RFM),
    "top_campaigns_roi": q(f"""SELECT campaign_code, campaign_name, channel_name, product_category, total_budget,
      revenue_attributed, roi_pct, conversion_rate_pct, cost_per_acquisition, rank() OVER (ORDER BY roi_pct DESC NULLS LAST) AS roi_rank
      {COMPLETED} AND total_contacts > 500 ORDER BY roi_rank, campaign_code LIMIT 10""", **PERF),
    "rank_in_groups": q(f"""SELECT campaign_code, product_category, channel_name, conversion_rate_pct, roi_pct, total_contacts,
      rank() OVER (PARTITION BY product_category ORDER BY conversion_rate_pct DESC NULLS LAST) AS rank_within_product,
      rank() OVER (PARTITION BY channel_name ORDER BY conversion_rate_pct DESC NULLS LAST) AS rank_within_channel,
      dense_rank() OVER (PARTITION BY product_category, channel_name ORDER BY roi_pct DESC NULLS LAST) AS rank_product_channel
      {COMPLETED}""", **PERF),
    "worst_cpa": q(f"""SELECT campaign_code, campaign_name, channel_name, product_category, total_budget, total_conversions,
      cost_per_acquisition, channel_benchmark_cpa, round(cost_per_acquisition - channel_benchmark_cpa, 2) AS excess_vs_benchmark,
      ntile(4) OVER (ORDER BY cost_per_acquisition DESC, campaign_code) AS cpa_quartile
      {COMPLETED} AND total_conversions > 0 ORDER BY cost_per_acquisition DESC NULLS LAST, campaign_code LIMIT 5""", **PERF),
    "peer_benchmark": q(f"""SELECT campaign_code, campaign_type, channel_name, product_category, conversion_rate_pct,
      {rnd('sum(bp) OVER w', '100 * count(*) OVER w', 2)} AS peer_avg_cvr,
      {rnd('bp * (count(*) OVER w) - sum(bp) OVER w', '100 * count(*) OVER w', 2)} AS cvr_vs_peer_avg,
      rank() OVER (PARTITION BY campaign_type, channel_name ORDER BY conversion_rate_pct DESC NULLS LAST) AS peer_rank,
      count(*) OVER w AS peer_group_size
      FROM (SELECT *, CAST(round(conversion_rate_pct * 100) AS BIGINT) AS bp {COMPLETED} AND total_contacts >= 300)
      WINDOW w AS (PARTITION BY campaign_type, channel_name)""", **PERF),
    "top_customers": q(f"""SELECT customer_code, concat_ws(' ', first_name, last_name) AS customer_name, customer_segment, region,
      annual_income, {gbp('rev_p')} AS total_revenue_attributed, total_conversions, active_products, rfm_segment,
      rank() OVER (ORDER BY rev_p DESC) AS revenue_rank, ntile(10) OVER (ORDER BY rev_p DESC, customer_id) AS revenue_decile
      FROM seg WHERE NOT is_dnc ORDER BY rev_p DESC, customer_id LIMIT 20""", **RFM),
    "segment_percentiles": q("""SELECT customer_segment, round(p25) AS p25_revenue, round(p50) AS median_revenue, round(p75) AS p75_revenue,
      round(p90) AS p90_revenue, round(p90 - p25) AS iqr_spread FROM (SELECT customer_segment,
      quantile_cont(rev_p / 100.0, 0.25) AS p25, quantile_cont(rev_p / 100.0, 0.5) AS p50, quantile_cont(rev_p / 100.0, 0.75) AS p75,
      quantile_cont(rev_p / 100.0, 0.9) AS p90 FROM base WHERE rev_p > 0 GROUP BY 1)""", **RFM_BASE),
    "multi_responders": q(f"""SELECT customer_id, customer_segment, region, campaigns_responded, campaigns_converted, first_interaction,
      last_interaction, last_interaction - first_interaction AS active_span_days,
      {pct('campaigns_converted', 'campaigns_responded', 1)} AS personal_cvr_pct, rfm_segment, {gbp('rev_p')} AS total_revenue_attributed
      FROM mrr JOIN seg USING (customer_id) WHERE campaigns_responded >= 3
      ORDER BY campaigns_converted DESC, rev_p DESC, customer_id LIMIT 50""", **RFM,
      mrr=f"""SELECT customer_id, count(DISTINCT campaign_id) AS campaigns_responded,
        count(DISTINCT campaign_id) FILTER (WHERE {CONV}) AS campaigns_converted, min(interaction_date) AS first_interaction,
        max(interaction_date) AS last_interaction FROM campaign_interactions
        WHERE interaction_outcome NOT IN ('No Response', 'Pending', 'Opted Out') GROUP BY 1"""),
    "warm_leads": q(f"""SELECT customer_code, customer_segment, region, annual_income, active_products, latest_warm_interaction,
      warm_campaign_count, rfm_segment, targeting_recommendation, {AS_OF} - latest_warm_interaction AS days_since_warm_lead
      FROM wl JOIN seg USING (customer_id) WHERE active_products = 1 AND NOT is_dnc
      ORDER BY days_since_warm_lead, customer_id LIMIT 100""", **RFM,
      wl="""SELECT customer_id, max(interaction_date) AS latest_warm_interaction, count(DISTINCT campaign_id) AS warm_campaign_count
        FROM campaign_interactions WHERE interaction_outcome IN ('Interested', 'Callback Requested') GROUP BY 1"""),
    "churn_risk": q(f"""SELECT customer_code, customer_segment, {dbl('annual_income')} AS annual_income, acquisition_date, total_campaigns,
      no_response_count, optout_count, last_contact_date, {AS_OF} - last_contact_date AS days_since_last_contact,
      {pct('no_response_count', 'total_campaigns', 1)} AS non_response_rate_pct, active_products,
      CASE WHEN optout_count > 0 THEN 'High Risk — Opted Out' WHEN no_response_count = total_campaigns THEN 'High Risk — Never Responded'
           WHEN no_response_count * 10 > total_campaigns * 7 THEN 'Medium Risk' ELSE 'Low Risk' END AS churn_risk_label
      FROM ce JOIN customers cu ON ce.customer_id = cu.customer_id LEFT JOIN ha ON ce.customer_id = ha.customer_id WHERE is_active""",
      ha=RFM["ha"], ce=f"""SELECT customer_id, count(DISTINCT campaign_id) AS total_campaigns,
        {when("interaction_outcome = 'No Response'")} AS no_response_count, {when(OPT)} AS optout_count,
        max(interaction_date) AS last_contact_date FROM campaign_interactions GROUP BY 1 HAVING count(DISTINCT campaign_id) >= 3"""),
    "churn_kpi": q(f"""SELECT count(*) AS customers, count(*) FILTER (WHERE n >= 3) AS silent_customers,
      {pct('count(*) FILTER (WHERE n >= 3)', 'count(*)')} AS churn_risk_pct FROM (SELECT customer_id,
      count(DISTINCT campaign_id) FILTER (WHERE interaction_outcome = 'No Response') AS n FROM campaign_interactions GROUP BY 1)"""),
    "running_revenue": q(f"""SELECT campaign_id, campaign_name, product_category, channel_name, conversion_date, {gbp('rev_p')} AS campaign_revenue,
      {gbp('sum(rev_p) OVER (ORDER BY conversion_date, campaign_id, product_category, channel_name ROWS UNBOUNDED PRECEDING)')} AS running_total_revenue,
      {rnd('rev_p * 100', 'sum(rev_p) OVER ()', 2)} AS pct_of_total_revenue,
      {rnd('100 * sum(rev_p) OVER (ORDER BY rev_p DESC, conversion_date, campaign_id, product_category, channel_name ROWS UNBOUNDED PRECEDING)',
           'sum(rev_p) OVER ()', 2)} AS cumulative_pct_revenue
      FROM (SELECT cv.campaign_id, campaign_name, product_category, channel_name, conversion_date, sum(rev_p) AS rev_p
        FROM campaign_conversions cv JOIN campaigns c ON cv.campaign_id = c.campaign_id JOIN products p ON cv.product_id = p.product_id
        JOIN campaign_channels ch ON cv.channel_id = ch.channel_id GROUP BY ALL)"""),
    "cvr_trend": q(f"""SELECT month_start, month_label, total_contacts, total_conversions, conversion_rate_pct,
      {rnd('b3', 'n3 * 100', 2)} AS cvr_3m_rolling_avg, {gbp('bp - pb')} AS cvr_mom_pp_change,
      CASE WHEN bp * n3 >= b3 THEN 'Above Trend' ELSE 'Below Trend' END AS trend_position FROM cl""", **TREND),
    "funnel_campaign": q(f"""SELECT campaign_code, campaign_name, channel_name, product_category, s1 AS stage_1_contacted,
      s2 AS stage_2_engaged, s3 AS stage_3_responded, s4 AS stage_4_converted, s5 AS stage_5_activated,
      {pct('s2', 's1', 1)} AS stage_1_to_2_pct, {pct('s3', 's2', 1)} AS stage_2_to_3_pct, {pct('s4', 's3', 1)} AS stage_3_to_4_pct,
      {pct('s5', 's4', 1)} AS stage_4_to_5_pct, {pct('s4', 's1')} AS end_to_end_cvr_pct FROM f""",
      f="""SELECT c.*, channel_name, product_category,
        (SELECT count(DISTINCT customer_id) FROM campaign_interactions i WHERE i.campaign_id = c.campaign_id) AS s1,
        (SELECT count(DISTINCT customer_id) FROM campaign_interactions i WHERE i.campaign_id = c.campaign_id
          AND interaction_type IN ('Opened','Clicked','Called','Visited Branch','Web Visit')) AS s2,
        (SELECT count(DISTINCT customer_id) FROM campaign_interactions i WHERE i.campaign_id = c.campaign_id
          AND interaction_outcome NOT IN ('No Response', 'Pending')) AS s3,
        (SELECT count(DISTINCT customer_id) FROM campaign_interactions i WHERE i.campaign_id = c.campaign_id
          AND interaction_outcome = 'Converted') AS s4,
        (SELECT count(DISTINCT customer_id) FROM customer_products h WHERE h.campaign_id = c.campaign_id AND h.status = 'Active') AS s5
        FROM campaigns c JOIN products p ON c.product_id = p.product_id JOIN campaign_channels ch ON c.channel_id = ch.channel_id
        WHERE status = 'Completed'"""),
    "cohort_assign": q("SELECT cohort_start, cohort_size FROM cz", **COHORT),
    "cohort_conversion": q(f"""SELECT {CM}, cohort_size, {pct(when('age = 0'), 'cohort_size', 1)} AS month_0_pct,
      {pct(when('age = 1'), 'cohort_size', 1)} AS month_1_pct, {pct(when('age = 2'), 'cohort_size', 1)} AS month_2_pct,
      {pct(when('age = 3'), 'cohort_size', 1)} AS month_3_pct, {pct(when('age BETWEEN 4 AND 6'), 'cohort_size', 1)} AS months_4_to_6_pct,
      {pct(when('age > 6'), 'cohort_size', 1)} AS month_7_plus_pct, {pct(when('f IS NOT NULL'), 'cohort_size', 1)} AS ever_converted_pct,
      {pct(when('f IS NULL'), 'cohort_size', 1)} AS never_converted_pct
      FROM (SELECT cohort_start, f, {AGE.format('f')} AS age FROM cc LEFT JOIN
        (SELECT customer_id, min(conversion_date) AS f FROM campaign_conversions GROUP BY 1) USING (customer_id))
      JOIN cz USING (cohort_start) GROUP BY cohort_start, cohort_size""", **COHORT),
    "cohort_revenue": q(f"""SELECT {CM}, cohort_size, """ + ", ".join(
        f"{rnd(f'(sum(rev_p) FILTER (WHERE {c}))', 'cohort_size * 100', 0)} AS {n}" for n, c in {
            "revenue_per_member_month_0": "age = 0", "revenue_per_member_month_1": "age = 1", "revenue_per_member_month_2": "age = 2",
            "revenue_per_member_months_3_5": "age BETWEEN 3 AND 5", "revenue_per_member_months_6_11": "age BETWEEN 6 AND 11",
            "revenue_per_member_months_12_plus": "age >= 12", "lifetime_revenue_per_member": "TRUE"}.items()) + f"""
      FROM (SELECT cohort_start, rev_p, {AGE.format('conversion_date')} AS age FROM campaign_conversions JOIN cc USING (customer_id))
      JOIN cz USING (cohort_start) GROUP BY cohort_start, cohort_size""", **COHORT),
    "cohort_penetration": q(f"""SELECT {CM}, cohort_size, """ + ", ".join(
        f"""{pct(f"(count(DISTINCT customer_id) FILTER (WHERE product_category = '{c}'))", 'cohort_size', 1)} AS {c.lower().replace(' ', '_')}_pct"""
        for c in ("Credit Card", "Savings Account", "Fixed Deposit", "Personal Loan", "Home Loan")) + f""",
      {rnd('count(*)', 'cohort_size', 2)} AS avg_products_per_customer
      FROM (SELECT cohort_start, customer_id, product_category FROM customer_products JOIN cc USING (customer_id)
        JOIN products USING (product_id) WHERE status = 'Active') JOIN cz USING (cohort_start) GROUP BY cohort_start, cohort_size""", **COHORT),
    "kpi_ctr": q(f"""SELECT campaign_id, count(*) AS total_contacts, {when("interaction_type IN ('Opened','Clicked','Responded','Visited Branch')")} AS total_engagements,
      {pct(when("interaction_type IN ('Opened','Clicked','Responded','Visited Branch')"), 'count(*)')} AS ctr_pct FROM campaign_interactions GROUP BY 1"""),
    "kpi_targets": q(f"""SELECT perf.campaign_id, conversion_rate_pct, ctr_pct, optout_rate_pct, response_rate_pct,
      COALESCE(conversion_rate_pct >= 15, FALSE) AS cvr_target_met, COALESCE(ctr_pct >= 25, FALSE) AS ctr_target_met,
      COALESCE(response_rate_pct >= 20, FALSE) AS response_target_met, COALESCE(cost_per_acquisition <= 45, FALSE) AS cpa_target_met,
      COALESCE(roi_pct >= 200, FALSE) AS roi_target_met, COALESCE(optout_rate_pct > 2, FALSE) AS compliance_review
      FROM perf LEFT JOIN (SELECT campaign_id, {pct(when("interaction_type IN ('Opened','Clicked','Responded','Visited Branch')"), 'count(*)')} AS ctr_pct
        FROM campaign_interactions GROUP BY 1) USING (campaign_id)""", **PERF),
    "reach": q("SELECT campaign_id, count(DISTINCT customer_id) AS customers_reached FROM campaign_interactions GROUP BY 1"),
    "trend_qoq": q(f"""SELECT quarter_start, total_contacts, total_conversions, {gbp('rev_p')} AS total_revenue,
      {pct('total_conversions - lag(total_conversions) OVER w', 'lag(total_conversions) OVER w', 1)} AS conversions_qoq_pct,
      {pct('rev_p - lag(rev_p) OVER w', 'lag(rev_p) OVER w', 1)} AS revenue_qoq_pct
      FROM (SELECT quarter_start, total_contacts, total_conversions, COALESCE(rev_p, 0) AS rev_p FROM
       (SELECT CAST(date_trunc('quarter', interaction_date) AS DATE) AS quarter_start, count(*) AS total_contacts, {when(CONV)} AS total_conversions
        FROM campaign_interactions GROUP BY 1) LEFT JOIN
       (SELECT CAST(date_trunc('quarter', conversion_date) AS DATE) AS quarter_start, sum(rev_p) AS rev_p FROM campaign_conversions GROUP BY 1)
        USING (quarter_start)) WINDOW w AS (ORDER BY quarter_start)"""),
    "dim_date": q("""SELECT d AS date_key, year(d) AS year_num, quarter(d) AS quarter_num, month(d) AS month_num, day(d) AS day_num,
      dayofweek(d) AS day_of_week, strftime(d, '%Y-%m') AS month_key, dayofweek(d) IN (0, 6) AS is_weekend
      FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT min(d) AS lo, max(d) AS hi FROM
        (SELECT interaction_date AS d FROM campaign_interactions UNION ALL SELECT conversion_date FROM campaign_conversions)))"""),
    "derive_conversions": q(f"""SELECT interaction_id, i.campaign_id, customer_id, c.product_id, i.channel_id,
      COALESCE(response_date, interaction_date) AS conversion_date, {dbl('revenue_value')} AS revenue_attributed, ab_variant
      FROM campaign_interactions i JOIN campaigns c ON i.campaign_id = c.campaign_id JOIN products p ON c.product_id = p.product_id WHERE {CONV}"""),
    "first_touch": q(f"""SELECT touch AS campaign_id, count(*) AS conversions, {gbp('sum(rev_p)')} AS first_touch_revenue
      FROM (SELECT cv.conversion_id, any_value(rev_p) AS rev_p, arg_min(i.campaign_id, i.interaction_date * 1) AS touch FROM
        (SELECT conversion_id, customer_id, conversion_date, rev_p FROM campaign_conversions) cv
        JOIN (SELECT customer_id, interaction_id, campaign_id, row_number() OVER (PARTITION BY customer_id ORDER BY interaction_date, interaction_id) AS interaction_date,
              interaction_date AS d FROM campaign_interactions) i ON i.customer_id = cv.customer_id AND i.d <= cv.conversion_date
        GROUP BY cv.conversion_id) GROUP BY 1"""),
}
