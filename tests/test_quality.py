from dataclasses import replace
from datetime import date

from tests.conftest import rows_by, touch, won
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campaignry.functions import kpi
from campaignry.operators import quality
from campaignry.session import cut_lineage, local_frame


def test_orphans_duplicates_and_rules(make):
    t = make(campaign_interactions=[touch(1, 1, outcome="Converted"), touch(1, 99), touch(2, 2, campaign=50, outcome="Odd")],
             campaign_conversions=[won(1, 1, day=date(2001, 1, 1), revenue=0), won(77, 2)])
    orphans = {r["check_name"]: r["orphan_rows"] for r in quality.dq_orphans(t).collect()}
    assert orphans["interactions -> campaigns"] == 1 and orphans["interactions -> customers"] == 1
    assert orphans["conversions -> interactions"] == 1 and orphans["conversions -> products"] == 0
    rules = {r["check_name"]: r["violations"] for r in quality.dq_rules(t).collect()}
    assert rules["revenue_attributed > 0"] == 1 and rules["conversion_date >= interaction_date"] == 2
    found = rows_by(quality.constraint_check(t), "table_name", "constraint_name")
    assert found["campaign_interactions", "unique interaction_id"]["violations"] == 1
    assert found["campaign_interactions", "outcome listed"]["violations"] == 1
    assert found["campaign_interactions", "variant listed"]["violations"] == 0  # NULL passes a domain check
    keys = {r["table_name"]: r["duplicate_keys"] for r in quality.dup_keys(t).collect()}
    assert keys["campaign_interactions"] == 1 and keys["customers"] == 0
    score = rows_by(quality.dq_score(t), "table_name")["campaign_interactions"]
    assert (score["records"], score["passing"]) == (3, 2)


def test_full_run_reports_all_checks_and_missing_columns_fail(make):
    t = make(campaign_interactions=[touch(1, 1, outcome="Converted")], campaign_conversions=[won(1, 1)])
    got = rows_by(quality.dq_run(t), "name")
    assert len(got) == 25 and got["Row count: channels = 5"]["status"] == "FAIL"
    assert got["WARN: overall conversion rate between 5% and 40%"]["status"] == "WARN"
    assert got["No NULL region"]["status"] == "PASS"
    broken = rows_by(quality.dq_run(replace(t, customers=t.customers.drop("region"), _memo={}, _dims={})), "name")
    assert broken["No NULL region"]["status"] == "FAIL" and broken["No NULL region"]["actual"] is None


def test_empty_tables_do_not_pass_silently(make):
    got = rows_by(quality.dq_run(make()), "name")
    assert got["WARN: opt-out rate < 10%"]["status"] == "WARN" and got["WARN: opt-out rate < 10%"]["actual"] is None


def test_null_profile_marks_designed_gaps(make):
    t = make(campaign_interactions=[touch(1, 1), touch(2, 2)])
    got = rows_by(quality.profile_nulls(t), "table_name", "column_name")
    assert got["campaign_interactions", "response_date"]["classification"] == "By Design"
    assert got["customers", "annual_income"]["classification"] == "Investigate"
    assert float(got["campaign_interactions", "ab_variant"]["null_pct"]) == 100.0


def test_shares_sum_to_100(star):
    assert abs(sum(float(r["pct"]) for r in quality.dist_segment(star).collect()) - 100) <= 0.2


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=20))
def test_pct_rounds_half_up_exactly(spark, pairs):
    df = local_frame(spark, [(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a long, b long")
    for r in df.select("a", "b", kpi.pct("a", "b").alias("p")).collect():
        if r["b"] == 0:
            assert r["p"] is None
        else:
            assert int(r["p"] * 100) == (2 * r["a"] * 10000 + r["b"]) // (2 * r["b"])


def test_a_missing_column_fails_its_own_check_only(star):
    whole = rows_by(quality.dq_run(star), "name")
    for table, column, names in (
        ("customers", "region", {"No NULL region"}), ("customers", "credit_score", {"RULE: credit_score within 300–999"}),
        ("campaigns", "end_date", {"RULE: campaign end_date > start_date"}),
        ("campaign_conversions", "revenue_attributed", {"No NULL revenue_attributed", "RULE: revenue_attributed > 0 on all conversions"}),
    ):
        less = rows_by(quality.dq_run(replace(star, **{table: star[table].drop(column)}, _memo={}, _dims={})), "name")
        assert {n for n in whole if less[n]["status"] == "FAIL" and less[n]["actual"] is None} == names
        assert all(less[n]["status"] == whole[n]["status"] for n in whole if n not in names)


def test_repeated_rows_are_found_by_fingerprint_and_compared_whole(spark):
    rows = [(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "b"), (None, None), (4, "c")]
    df = local_frame(spark, rows, "fingerprint int, table_name string")
    prints = quality.repeated_prints({"x": df, "y": df.limit(1)})
    assert [r["table_name"] for r in prints.collect()] == ["x", "x"]
    found = quality.repeated_rows(df, prints.select("fingerprint"))
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "a")] * 3 + [(2, None)] * 2
    assert quality.surplus(found, found.columns, "n").first()["n"] == 3
    every = local_frame(spark, [(r.fingerprint,) for r in df.select(F.xxhash64(*df.columns).alias("fingerprint")).collect()], "fingerprint long")
    found = quality.repeated_rows(df, every.distinct())  # fingerprints of rows that differ do no harm
    assert quality.surplus(found, found.columns, "n").first()["n"] == 3
    assert quality.surplus(quality.repeated_rows(df, prints.limit(0).select("fingerprint")), ["_c0", "_c1"], "n").first()["n"] == 0


def test_whole_rows_are_not_shuffled_for_their_repeats(star):
    """The join of rows with fingerprints broadcasts the fingerprints; only rows under them are grouped."""
    prints = cut_lineage(quality.repeated_prints({"customers": star.customers}))
    plan = quality.repeated_rows(star.customers, prints.select("fingerprint"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
