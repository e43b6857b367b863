"""Derives the seven tables from the order/line-item star of the test data."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignry.session import local_frame
from campaignry.tables import Tables, if_small

AS_OF = date(2001, 8, 2)

# The channel register with its benchmarks.
CHANNEL_ROWS = [
    (1, "Email", "22.00", "12.00", "30.00"),
    (2, "SMS", "18.00", "10.00", "20.00"),
    (3, "Branch", "45.00", "35.00", "80.00"),
    (4, "Telemarketing", "30.00", "20.00", "60.00"),
    (5, "Digital", "28.00", "15.00", "25.00"),
]


# Declared types of the raw columns in use; no footer is read to infer them.
RAW = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_extendedprice double, l_returnflag string, "
                "l_shipdate timestamp_ntz",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(RAW[name]).parquet(f"{folder}/{name}.parquet")


def channels(spark: SparkSession) -> DataFrame:
    rows = [(i, n, f"{n} channel", Decimal(ctr), Decimal(cvr), Decimal(cpa), True) for i, n, ctr, cvr, cpa in CHANNEL_ROWS]
    return local_frame(spark, rows, (
        "channel_id int, channel_name string, channel_description string, benchmark_ctr decimal(5,2), "
        "benchmark_cvr decimal(5,2), benchmark_cpa decimal(10,2), is_active boolean"))


def products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey AS product_id", "concat('P-', CAST(p_partkey AS STRING)) AS product_code", "p_name AS product_name",
        """CASE p_type WHEN 'SMALL' THEN 'Credit Card' WHEN 'MEDIUM' THEN 'Savings Account'
             WHEN 'STANDARD' THEN 'Fixed Deposit' WHEN 'LARGE' THEN 'Personal Loan' ELSE 'Home Loan' END AS product_category""",
        "CAST(p_retailprice AS DECIMAL(15,2)) AS revenue_value",
        "CASE WHEN p_size > 40 THEN 21 ELSE 18 END AS min_eligibility_age", "TRUE AS is_active",
    )


def customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(place, customer.c_nationkey == place.n_nationkey).selectExpr(
        "c_custkey AS customer_id", "c_name AS customer_code", "n_name AS first_name", "c_name AS last_name",
        "r_name AS region", "n_name AS city",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Affluent' WHEN 'MACHINERY' THEN 'Premier'
             WHEN 'FURNITURE' THEN 'Private Banking' ELSE 'Mass Market' END AS customer_segment""",
        """CASE c_custkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Non-Binary' END AS gender""",
        """CASE c_custkey % 7 WHEN 0 THEN 'Employed' WHEN 1 THEN 'Self-Employed' WHEN 2 THEN 'Unemployed'
             WHEN 3 THEN 'Retired' WHEN 4 THEN 'Student' WHEN 5 THEN 'Part-Time' END AS employment_status""",
        "CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal * 10 AS DECIMAL(15,2)) END AS annual_income",
        "CAST(300 + (c_custkey * 7919) % 700 AS INT) AS credit_score",
        "CAST(c_custkey % 5 AS INT) AS number_of_products",
        "c_custkey % 33 <> 0 AS is_active", "c_custkey % 50 = 7 AS is_dnc",
        "date_add(DATE '1940-01-01', CAST((c_custkey * 53) % 14000 AS INT)) AS date_of_birth",
        "date_add(DATE '1995-01-01', CAST((c_custkey * 37) % 1500 AS INT)) AS acquisition_date",
    )


def campaigns(nation: DataFrame) -> DataFrame:
    two = nation.select("n_nationkey", "n_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    return two.selectExpr("n_nationkey * 2 + k AS id", "n_name", "k").selectExpr(
        "id AS campaign_id", "concat('CMP-', CAST(id AS STRING)) AS campaign_code",
        "concat(n_name, '-', CAST(k AS STRING)) AS campaign_name",
        """CASE id % 6 WHEN 0 THEN 'Acquisition' WHEN 1 THEN 'Retention' WHEN 2 THEN 'Cross-Sell'
             WHEN 3 THEN 'Upsell' WHEN 4 THEN 'Win-Back' ELSE 'Awareness' END AS campaign_type""",
        "id AS product_id", "CAST(id % 5 + 1 AS INT) AS channel_id",
        """CASE id % 4 WHEN 0 THEN 'All' WHEN 1 THEN 'Mass Market' WHEN 2 THEN 'Affluent'
             ELSE 'Premier' END AS target_segment""",
        "date_add(DATE '1995-01-01', CAST((id * 47) % 2300 AS INT)) AS start_date",
        "date_add(DATE '1995-01-01', CAST((id * 47) % 2300 + 30 + id % 60 AS INT)) AS end_date",
        "CAST(2000 + (id * 977) % 9000 AS DECIMAL(15,2)) AS total_budget",
        "CAST(200 + id * 10 AS INT) AS contacts_target", "id % 3 = 0 AS ab_test_enabled",
        "concat('Manager ', CAST(id % 5 AS STRING)) AS campaign_manager",
        "CASE WHEN id % 10 = 9 THEN 'Active' ELSE 'Completed' END AS status",
    )


def interactions(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey", "o_custkey", "o_orderpriority", "CAST(o_orderdate AS DATE) AS d",
        "(o_orderkey * 3 + o_custkey) % 50 AS cid", "(o_orderkey * 7 + o_custkey * 13) % 100 AS h",
    ).selectExpr(
        "o_orderkey AS interaction_id", "CAST(cid AS INT) AS campaign_id", "o_custkey AS customer_id",
        "CAST(cid % 5 + 1 AS INT) AS channel_id", "d AS interaction_date",
        """CASE CAST(substr(o_orderpriority, 1, 1) AS INT) WHEN 1 THEN 'Called' WHEN 2 THEN 'Clicked'
             WHEN 3 THEN 'Opened' WHEN 4 THEN 'Sent' ELSE 'Delivered' END AS interaction_type""",
        """CASE WHEN h < 19 THEN 'Converted' WHEN h < 35 THEN 'Interested' WHEN h < 45 THEN 'Not Interested'
             WHEN h < 51 THEN 'Callback Requested' WHEN h < 59 THEN 'Declined' WHEN h < 63 THEN 'Opted Out'
             WHEN h < 68 THEN 'Pending' ELSE 'No Response' END AS interaction_outcome""",
        "CASE WHEN h < 63 THEN date_add(d, CAST(1 + o_orderkey % 7 AS INT)) END AS response_date",
        "CASE WHEN cid % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END END AS ab_variant",
    )


def conversions(inter: DataFrame, campaign_product: DataFrame) -> DataFrame:
    won = inter.filter(F.col("interaction_outcome") == "Converted")
    return won.join(campaign_product, "campaign_id").selectExpr(
        "interaction_id AS conversion_id", "interaction_id", "campaign_id", "customer_id", "product_id", "channel_id",
        "COALESCE(response_date, interaction_date) AS conversion_date",
        "CAST(revenue_value * (1 + interaction_id % 5) / 2 AS DECIMAL(15,2)) AS revenue_attributed", "ab_variant",
    )


def holdings(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).selectExpr(
        "l_orderkey * 10 + l_linenumber AS customer_product_id", "o_custkey AS customer_id", "l_partkey AS product_id",
        "CASE WHEN l_orderkey % 4 <> 0 THEN CAST((o_orderkey * 3 + o_custkey) % 50 AS INT) END AS campaign_id",
        "CAST(l_shipdate AS DATE) AS acquisition_date",
        "CASE l_returnflag WHEN 'R' THEN date_add(CAST(l_shipdate AS DATE), CAST(60 + l_orderkey % 600 AS INT)) END AS closure_date",
        "CASE l_returnflag WHEN 'R' THEN 'Closed' WHEN 'N' THEN 'Suspended' ELSE 'Active' END AS status",
        "CAST(l_extendedprice AS DECIMAL(15,2)) AS product_value",
    )


def star_tables(spark: SparkSession, folder: str) -> Tables:
    raw = {n: read_table(spark, folder, n) for n in RAW}
    camp, prod, inter = campaigns(raw["nation"]), products(raw["part"]), interactions(raw["orders"])
    campaign_product = if_small(
        camp.select("campaign_id", "product_id").join(prod.select("product_id", "revenue_value"), "product_id")
    )
    return Tables(
        products=prod,
        campaign_channels=channels(spark),
        customers=customers(raw["customer"], raw["nation"], raw["region"]),
        campaigns=camp,
        campaign_interactions=inter,
        campaign_conversions=conversions(inter, campaign_product),
        customer_products=holdings(raw["lineitem"], raw["orders"]),
        as_of=AS_OF,
        folder=folder,
    )
