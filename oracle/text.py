"""Shared pieces of the DuckDB texts: the table derivation and exact half-up rounding."""

TABLES = """
WITH campaign_channels AS (
  SELECT *, concat(channel_name, ' channel') AS channel_description FROM (VALUES
    (1,'Email',CAST(22.00 AS DECIMAL(5,2)),CAST(12.00 AS DECIMAL(5,2)),CAST(30.00 AS DECIMAL(10,2)),TRUE),
    (2,'SMS',18.00,10.00,20.00,TRUE),(3,'Branch',45.00,35.00,80.00,TRUE),
    (4,'Telemarketing',30.00,20.00,60.00,TRUE),(5,'Digital',28.00,15.00,25.00,TRUE)
  ) AS t(channel_id,channel_name,benchmark_ctr,benchmark_cvr,benchmark_cpa,is_active)
), products AS (
  SELECT p_partkey AS product_id, concat('P-', CAST(p_partkey AS STRING)) AS product_code, p_name AS product_name,
    CASE p_type WHEN 'SMALL' THEN 'Credit Card' WHEN 'MEDIUM' THEN 'Savings Account' WHEN 'STANDARD' THEN 'Fixed Deposit'
                WHEN 'LARGE' THEN 'Personal Loan' ELSE 'Home Loan' END AS product_category,
    CAST(p_retailprice AS DECIMAL(15,2)) AS revenue_value,
    CASE WHEN p_size > 40 THEN 21 ELSE 18 END AS min_eligibility_age, TRUE AS is_active
  FROM part
), customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_code, n_name AS first_name, c_name AS last_name,
    r_name AS region, n_name AS city,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Affluent' WHEN 'MACHINERY' THEN 'Premier'
                      WHEN 'FURNITURE' THEN 'Private Banking' ELSE 'Mass Market' END AS customer_segment,
    CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Non-Binary' END AS gender,
    CASE c_custkey % 7 WHEN 0 THEN 'Employed' WHEN 1 THEN 'Self-Employed' WHEN 2 THEN 'Unemployed' WHEN 3 THEN 'Retired'
                       WHEN 4 THEN 'Student' WHEN 5 THEN 'Part-Time' END AS employment_status,
    CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal * 10 AS DECIMAL(15,2)) END AS annual_income,
    CAST(300 + (c_custkey * 7919) % 700 AS INT) AS credit_score, CAST(c_custkey % 5 AS INT) AS number_of_products,
    c_custkey % 33 <> 0 AS is_active, c_custkey % 50 = 7 AS is_dnc,
    DATE '1940-01-01' + CAST((c_custkey * 53) % 14000 AS INT) AS date_of_birth,
    DATE '1995-01-01' + CAST((c_custkey * 37) % 1500 AS INT) AS acquisition_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), campaigns AS (
  SELECT id AS campaign_id, concat('CMP-', CAST(id AS STRING)) AS campaign_code, concat(n_name, '-', CAST(k AS STRING)) AS campaign_name,
    CASE id % 6 WHEN 0 THEN 'Acquisition' WHEN 1 THEN 'Retention' WHEN 2 THEN 'Cross-Sell' WHEN 3 THEN 'Upsell'
                WHEN 4 THEN 'Win-Back' ELSE 'Awareness' END AS campaign_type,
    id AS product_id, CAST(id % 5 + 1 AS INT) AS channel_id,
    CASE id % 4 WHEN 0 THEN 'All' WHEN 1 THEN 'Mass Market' WHEN 2 THEN 'Affluent' ELSE 'Premier' END AS target_segment,
    DATE '1995-01-01' + CAST((id * 47) % 2300 AS INT) AS start_date,
    DATE '1995-01-01' + CAST((id * 47) % 2300 + 30 + id % 60 AS INT) AS end_date,
    CAST(2000 + (id * 977) % 9000 AS DECIMAL(15,2)) AS total_budget, CAST(200 + id * 10 AS INT) AS contacts_target,
    id % 3 = 0 AS ab_test_enabled, concat('Manager ', CAST(id % 5 AS STRING)) AS campaign_manager,
    CASE WHEN id % 10 = 9 THEN 'Active' ELSE 'Completed' END AS status
  FROM (SELECT n_nationkey * 2 + k AS id, n_name, k FROM nation CROSS JOIN (VALUES (0),(1)) AS v(k)) AS s
), campaign_interactions AS (
  SELECT o_orderkey AS interaction_id, CAST(cid AS INT) AS campaign_id, o_custkey AS customer_id,
    CAST(cid % 5 + 1 AS INT) AS channel_id, CAST(o_orderdate AS DATE) AS interaction_date,
    CASE CAST(substr(o_orderpriority,1,1) AS INT) WHEN 1 THEN 'Called' WHEN 2 THEN 'Clicked' WHEN 3 THEN 'Opened'
         WHEN 4 THEN 'Sent' ELSE 'Delivered' END AS interaction_type,
    CASE WHEN h < 19 THEN 'Converted' WHEN h < 35 THEN 'Interested' WHEN h < 45 THEN 'Not Interested'
         WHEN h < 51 THEN 'Callback Requested' WHEN h < 59 THEN 'Declined' WHEN h < 63 THEN 'Opted Out'
         WHEN h < 68 THEN 'Pending' ELSE 'No Response' END AS interaction_outcome,
    CASE WHEN h < 63 THEN CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 7 AS INT) END AS response_date,
    CASE WHEN cid % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END END AS ab_variant
  FROM (SELECT *, (o_orderkey*3 + o_custkey) % 50 AS cid, (o_orderkey*7 + o_custkey*13) % 100 AS h FROM orders) AS s
), campaign_conversions AS (
  SELECT i.interaction_id AS conversion_id, i.interaction_id, i.campaign_id, i.customer_id, c.product_id, i.channel_id,
    COALESCE(i.response_date, i.interaction_date) AS conversion_date,
    CAST(p.revenue_value * (1 + i.interaction_id % 5) / 2 AS DECIMAL(15,2)) AS revenue_attributed,
    CAST(CAST(p.revenue_value * (1 + i.interaction_id % 5) / 2 AS DECIMAL(15,2)) * 100 AS BIGINT) AS rev_p, i.ab_variant
  FROM campaign_interactions i JOIN campaigns c ON i.campaign_id = c.campaign_id JOIN products p ON c.product_id = p.product_id
  WHERE i.interaction_outcome = 'Converted'
), customer_products AS (
  SELECT l_orderkey * 10 + l_linenumber AS customer_product_id, o_custkey AS customer_id, l_partkey AS product_id,
    CASE WHEN l_orderkey % 4 <> 0 THEN CAST((o_orderkey*3 + o_custkey) % 50 AS INT) END AS campaign_id,
    CAST(l_shipdate AS DATE) AS acquisition_date,
    CASE l_returnflag WHEN 'R' THEN CAST(l_shipdate AS DATE) + CAST(60 + l_orderkey % 600 AS INT) END AS closure_date,
    CASE l_returnflag WHEN 'R' THEN 'Closed' WHEN 'N' THEN 'Suspended' ELSE 'Active' END AS status,
    CAST(l_extendedprice AS DECIMAL(15,2)) AS product_value,
    CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * 100 AS BIGINT) AS val_p
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
"""

AS_OF = "DATE '2001-08-02'"


def q(body: str, **more: str) -> str:
    """The table derivation, further named steps, and the final SELECT."""
    steps = "".join(f", {name} AS ({text})\n" for name, text in more.items())
    return TABLES.rstrip() + "\n" + steps + body


def rnd(num: str, den: str, dp: int) -> str:
    """num / den for whole numbers, rounded half away from zero to dp places, as DOUBLE."""
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (f"(CASE WHEN {d} <> 0 THEN CAST(sign({n}) AS DOUBLE) * "
            f"CAST((2 * abs({n}) * {10 ** dp} + {d}) // (2 * {d}) AS DOUBLE) / {10 ** dp}.0 END)")


def pct(part: str, whole: str, dp: int = 2) -> str:
    return rnd(f"({part}) * 100", whole, dp)


def gbp(pence: str) -> str:
    return f"(CAST({pence} AS DOUBLE) / 100.0)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def when(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


CONV = "interaction_outcome = 'Converted'"
RESP = "interaction_outcome NOT IN ('No Response', 'Pending')"
OPT = "interaction_outcome = 'Opted Out'"
