"""DuckDB texts of the propensity data set and its split."""

from oracle.text import CONV, RESP, pct, q
from oracle.customers import AGE, HASH

NUMERIC = ["age", "log_income", "credit_score", "tenure_at_interaction", "number_of_products", "campaign_duration_days", "budget_per_contact",
           "days_into_campaign", "hist_interactions", "hist_cvr", "hist_response_rate"]
CATEGORICAL = ["customer_segment", "employment_status", "channel_name", "campaign_type", "product_category", "interaction_type"]
BINARY = ["ab_variant_B", "ab_test_enabled", "is_existing_holder", "is_target_segment"]

DATA = dict(
    hs=f"""SELECT customer_id, count(*) AS hist_interactions, CAST(count(*) FILTER (WHERE {CONV}) AS DOUBLE) / count(*) AS hist_cvr,
      CAST(count(*) FILTER (WHERE {RESP}) AS DOUBLE) / count(*) AS hist_response_rate FROM campaign_interactions GROUP BY 1""",
    hc="SELECT DISTINCT customer_id, product_category FROM customer_products JOIN products USING (product_id) WHERE status = 'Active'",
    rd=f"""SELECT interaction_id, i.customer_id, i.campaign_id, {AGE} AS age, ln(1 + CAST(annual_income AS DOUBLE)) AS log_income, credit_score,
      greatest(interaction_date - acquisition_date, 0) AS tenure_at_interaction, number_of_products, end_date - start_date AS campaign_duration_days,
      CAST(total_budget AS DOUBLE) / greatest(contacts_target, 1) AS budget_per_contact, greatest(interaction_date - start_date, 0) AS days_into_campaign,
      hist_interactions, hist_cvr, hist_response_rate, customer_segment, employment_status, channel_name, campaign_type, p.product_category, interaction_type,
      CASE WHEN ab_variant = 'B' THEN 1 ELSE 0 END AS ab_variant_B, CAST(ab_test_enabled AS INTEGER) AS ab_test_enabled,
      CASE WHEN hc.customer_id IS NOT NULL THEN 1 ELSE 0 END AS is_existing_holder, CASE WHEN customer_segment = target_segment THEN 1 ELSE 0 END AS is_target_segment,
      CASE WHEN {CONV} THEN 1 ELSE 0 END AS converted FROM campaign_interactions i JOIN campaigns c ON i.campaign_id = c.campaign_id
      JOIN products p ON c.product_id = p.product_id JOIN campaign_channels ch ON i.channel_id = ch.channel_id JOIN customers cu ON i.customer_id = cu.customer_id
      JOIN hs ON hs.customer_id = i.customer_id LEFT JOIN hc ON hc.customer_id = i.customer_id AND hc.product_category = p.product_category""",
    me="SELECT " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in NUMERIC) + " FROM rd",
    ml="SELECT interaction_id, customer_id, campaign_id, " + ", ".join(f"COALESCE(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in NUMERIC) + ", "
       + ", ".join(f"COALESCE({c}, 'Unknown') AS {c}" for c in CATEGORICAL) + ", " + ", ".join(BINARY) + ", converted FROM rd, me",
    sp=f"""SELECT *, row_number() OVER (PARTITION BY converted ORDER BY {HASH.format("concat_ws(chr(58), 42, interaction_id)")}, interaction_id)
      <= CAST(floor(count(*) OVER (PARTITION BY converted) * CAST(0.2 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS is_test FROM ml""",
    fo=f"""SELECT *, CASE WHEN NOT is_test THEN ntile(5) OVER (PARTITION BY converted, is_test ORDER BY {HASH.format("concat_ws(chr(58), 42, interaction_id)")}, interaction_id) - 1 END AS fold FROM sp""",
)
COLS = "interaction_id, customer_id, campaign_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in NUMERIC) + ", " + ", ".join(CATEGORICAL + BINARY) + ", converted"
RAW = "interaction_id, customer_id, campaign_id, " + ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in NUMERIC) + ", " + ", ".join(CATEGORICAL + BINARY) + ", converted"


def part(dim: str, col: str) -> str:
    return f"SELECT '{dim}' AS dimension, {col} AS value, count(*) AS n, CAST(sum(converted) AS BIGINT) AS positives FROM sp {'' if dim == 'part' else 'WHERE NOT is_test'} GROUP BY 2"


SQL = {
    "ml_customer_history": q("SELECT * FROM hs", **DATA),
    "ml_held_categories": q("SELECT customer_id, array_to_string(list_sort(list(product_category)), '|') AS held_categories FROM hc GROUP BY 1", **DATA),
    "build_ml_dataset": q(f"SELECT {COLS} FROM ml", **DATA),
    "ml_impute": q("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE rd.{c} IS NULL) AS filled, round(any_value(m_{c}), 6) AS fill_value FROM rd, me" for c in NUMERIC) + ") WHERE filled > 0", **DATA),
    "ml_split": q(f"SELECT interaction_id, converted, is_test, fold FROM fo", **DATA),
    "ml_overview": q(f"SELECT *, {pct('positives', 'n')} AS positive_pct FROM (" + " UNION ALL ".join([
        part("part", "CASE WHEN is_test THEN 'test' ELSE 'train' END"), part("segment", "customer_segment"), part("channel", "channel_name")]) + ")", **DATA),
    "ml_prep": q(f"""SELECT interaction_id, converted, n / (2.0 * nc) AS weight, fold, n_features, round(s + b + x, 6) AS feature_sum FROM
      (SELECT interaction_id, converted, fold, CAST(count(*) OVER () AS DOUBLE) AS n, count(*) OVER (PARTITION BY converted) AS nc,
        (SELECT {' + '.join(f'count(DISTINCT {c}) - 1' for c in CATEGORICAL)} + {len(NUMERIC) + len(BINARY)} FROM fo WHERE NOT is_test) AS n_features,
        {' + '.join(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()' for c in NUMERIC)} AS s, {' + '.join(BINARY)} AS b,
        {' + '.join(f'CASE WHEN {c} > (SELECT min({c}) FROM fo WHERE NOT is_test) THEN 1 ELSE 0 END' for c in CATEGORICAL)} AS x
       FROM fo WHERE NOT is_test)""", **DATA),
}
