"""Plans and hot keys: what must hold when the tables no longer fit one machine."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignry.catalog import operators
from campaignry.operators import explore, load, propensity, revenue, segments
from campaignry.plans.ordering import SortedRuns, long_frame
from campaignry.session import local_frame, shared_dir
from campaignry.sources.star import star_tables
from campaignry.tables import if_small

SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "20",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """A third of all interactions and conversions belong to one customer; the facts come from several tasks."""
    t = star_tables(spark, "/root/testdata/sf0.01")
    one = lambda d: d.withColumn("customer_id", F.when(F.col("interaction_id") % 3 == 0, F.lit(7).cast("long")).otherwise(F.col("customer_id"))).repartition(8)
    return replace(t, campaign_interactions=one(t.campaign_interactions), campaign_conversions=one(t.campaign_conversions).withColumn("conversion_type", F.lit("New")), _memo={})


@pytest.mark.parametrize("operator", [propensity.raw_dataset, revenue.revenue_roi, explore.enrich_lookup])
def test_a_hot_customer_is_split(spark, hot, operator):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        df = operator(hot)
        rows = len(df.collect())
        assert "skew=true" in plan(df)
        assert rows == (hot.campaign_conversions if operator is revenue.revenue_roi else hot.campaign_interactions).count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_customer_results(hot):
    seg = {r["customer_id"]: r for r in segments.customer_segments(hot).collect()}
    assert seg[7]["total_interactions_all_time"] > 4000
    sizes = np.bincount([r["m_score"] for r in seg.values()])[1:]
    assert sizes.max() - sizes.min() <= 1 and sum(sizes) == len(seg)


def test_hot_value_is_spread_over_partitions(spark):
    """Nine of ten rows share a value; with the id in the key no partition holds them all."""
    rows = [(i, 0 if i % 10 else i) for i in range(20_000)]
    df = local_frame(spark, rows, "customer_id long, v long").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with SortedRuns(long_frame(df, {"v": F.col("v")}, keep=["customer_id"]), tie="customer_id") as runs:
            parts, ends = runs.runs["v"]
            assert len(parts) == 4 and max(np.diff([0, *ends])) < 10_000
            assert runs.pick({"v": [1, 18_000, 20_000]})["v", 20_000] == (19_990, 19_990)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


FACT_FREE = ["campaign_performance", "channel_analysis", "revenue_roi", "funnel_campaign", "cohort_conversion", "cohort_penetration",
             "churn_risk", "multi_responders", "running_revenue", "target_audience", "allocate_contacts", "exec_summary", "dq_run",
             "constraint_check", "outliers", "build_feature_matrix", "build_ml_dataset", "conversion_type", "first_touch"]


@pytest.mark.parametrize("name", FACT_FREE)
def test_no_pairs_and_no_python(star, name):
    text = plan(operators()[name](star))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text, node


def test_filters_and_columns_reach_the_scan(star):
    text = load.src_parquet(star)._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" in text and "o_orderpriority" not in text


def test_broadcast_needs_a_checked_size(spark):
    df = spark.range(100).toDF("id")
    big = spark.range(1000).toDF("id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(if_small(df, 100), "id"))
        assert "BroadcastHashJoin" not in plan(big.join(if_small(df, 99), "id"))
        wide = df.withColumn("s", F.repeat(F.lit("x"), 1000))
        assert "BroadcastHashJoin" not in plan(big.join(if_small(wide, 100, max_bytes=50_000), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) and (configured is None or shared_dir(spark) == configured)
