from collections import defaultdict
from dataclasses import replace
from datetime import date

import numpy as np
import pytest
from tests.conftest import money, rows_by, touch, won
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import functions as F

from campaignry.operators import clusters, derive, explore, features, revenue, rfm


def test_customer_without_history(make):
    people = [dict(customer_id=i, customer_code=f"C{i}", acquisition_date=date(2001, 7, 3), date_of_birth=date(1981, 8, 2),
                   annual_income=money(1000 * i) if i < 4 else None, customer_segment="Premier") for i in range(1, 6)]
    t = make(customers=people, campaign_interactions=[touch(1, 1, outcome="Opted Out"), touch(2, 1)],
             campaign_conversions=[won(1, 1)], customer_products=[
                 dict(customer_product_id=1, customer_id=1, product_id=1, status="Active", product_value=money(10)),
                 dict(customer_product_id=2, customer_id=1, product_id=2, status="Closed", product_value=money(99))])
    got = rows_by(features.build_feature_matrix(t), "customer_id")
    assert got[2]["recency_days"] == got[2]["tenure_days"] == 30 and got[2]["total_interactions"] == 0
    assert got[1]["optout_rate"] == 0.5 and got[1]["n_active_products"] == 1 and got[1]["has_home_loan"] == 0
    assert got[1]["is_multi_product"] == 0 and got[1]["cross_sell_score"] == 0.2 and got[1]["conv_new"] == 1
    assert got[5]["annual_income"] == 0 and got[5]["income_decile"] == 0 and got[1]["segment_rank"] == 3
    scaled = features.scale_features(t).toPandas()
    assert np.allclose(scaled["credit_score"], 0)  # a constant column


def test_scaling_uses_the_population_deviation(star):
    raw = features.build_feature_matrix(star).toPandas().set_index("customer_id").sort_index()
    got = features.scale_features(star).toPandas().set_index("customer_id").sort_index()
    for c in features.SCALE_COLUMNS:
        x = raw[c].astype(float)
        want = (x - x.mean()) / (x.std(ddof=0) or 1.0)
        assert np.allclose(got[c], want), c


def test_label_branches_are_all_reachable_or_ordered(star):
    rows = rfm.rfm_score_py(star).collect()
    assert {r["rfm_segment"] for r in rows} <= set(rfm.LABELS)
    assert all(2 <= r["rfm_score"] <= 14 and (r["M"] == 0) == (r["total_revenue"] == 0) for r in rows)
    sizes = np.bincount([r["F"] for r in rows])[1:]
    assert sizes.max() - sizes.min() <= 1
    assert abs(sum(float(r["customers_pct"]) for r in rfm.rfm_share(star).collect()) - 100) <= 0.5


def test_the_grid_and_the_labels_do_not_read_holdings(star):
    """Scores depend on no holding, so the joins behind the holdings are not made for them."""
    rows = rfm.rfm_score_py(replace(star, _memo={})).collect()
    unread = star.customer_products.withColumn("status", F.raise_error(F.lit("holdings were read")).cast("string"))
    t = replace(star, customer_products=unread, _memo={})
    cells = defaultdict(list)
    for r in rows:
        cells[r["F"], r["M"]].append(r["R"])
    want = {(f, m): np.mean(cells[f, m]) if cells[f, m] else 0 for f in range(1, 6) for m in range(5)}
    grid = rfm.rfm_fm_grid(t).collect()
    assert len(grid) == 5 and {(r["F"], m): r[f"m{m}"] for r in grid for m in range(5)} == pytest.approx(want)
    assert {r["customer_id"]: r["rfm_segment"] for r in rfm.rfm_labels(t).collect()} == {r["customer_id"]: r["rfm_segment"] for r in rows}
    assert sum(r["customers"] for r in rfm.rfm_segment_stats(t).collect()) == len(rows)


@pytest.mark.parametrize("repeated", [False, True])
def test_scoring_inputs_equal_the_feature_matrix(make, repeated):
    """Repeated and missing ids count as in the matrix: a conversion is taken once per win of its interaction id."""
    people = [dict(customer_id=i, customer_code="C", customer_segment="Premier", acquisition_date=day, date_of_birth=date(1981, 8, 2),
                   annual_income=money(1000) if i else None) for i, day in [
                       (1, date(2001, 7, 3)), (2, None), (3, date(2000, 1, 1)), (3, date(2000, 1, 2)), (4, date(1999, 1, 1)), (None, None)]]
    touches = [touch(1, 1, outcome="Converted"), touch(2, 3, outcome="Converted", day=date(1999, 5, 5)), touch(3, 3),
               touch(None, 3, outcome="Converted"), touch(None, 4, outcome="Converted"), touch(4, None), touch(5, 9, day=None)]
    if repeated:
        touches += [touch(1, 1, outcome="Converted"), touch(2, 4, outcome="Converted")]
    held = [dict(customer_product_id=i, customer_id=c, product_id=p, status=s, product_value=money(5)) for i, (c, p, s) in enumerate(
        [(1, 1, "Active"), (1, 2, "Active"), (1, 2, "Active"), (3, 2, "Closed"), (3, 9, "Active"), (0, 1, "Active"), (None, 1, "Active")])]
    t = make(customers=people, campaign_interactions=touches, customer_products=held, campaign_conversions=[
        won(1, 1), won(1, 1, revenue=50), won(2, 3, revenue=70), won(None, 3, revenue=20), won(9, 4, revenue=30), won(8, None)])
    t = replace(t, campaign_conversions=t.campaign_conversions.drop("conversion_type"))
    assert ("conversion_type" in revenue.counted_conversions(t).columns) == repeated
    cols = ["customer_id", "customer_segment", *rfm.PROFILE]
    got, want = [sorted(map(repr, build(replace(t, _memo={})).select(cols).collect())) for build in (
        lambda t: features.scoring_inputs(t, holdings=True), features.build_feature_matrix)]
    assert got == want and len(got) == 6
    assert {r["total_revenue"] for r in features.scoring_inputs(replace(t, _memo={})).filter("customer_id = 1").collect()} == {300 if repeated else 150}


def test_silhouette_equals_the_evaluator_and_brute_force(star):
    rows = clusters.labelled(star)
    mean = np.mean([r["silhouette"] for r in clusters.silhouette_points(star).collect()])
    assert mean == pytest.approx(ClusteringEvaluator(predictionCol="cluster").evaluate(rows), abs=1e-9)
    pdf = rows.toPandas()
    x, lab = pdf[features.SCALE_COLUMNS].to_numpy(), pdf["cluster"].to_numpy()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    got = {r["customer_id"]: r["silhouette"] for r in clusters.silhouette_points(star).collect()}
    for i, cid in enumerate(pdf["customer_id"]):
        own = lab == lab[i]
        if own.sum() == 1:
            assert got[cid] == 0
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        assert got[cid] == pytest.approx((b - a) / max(a, b), abs=1e-9)


def test_projection_matches_the_eigenvectors(star):
    x = features.scale_features(star).toPandas().sort_values("customer_id")[features.SCALE_COLUMNS].to_numpy()
    _, s, v = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    got = clusters.pca_project(star).toPandas().sort_values("customer_id")
    for c, name in enumerate(["pc1", "pc2"]):
        assert np.allclose(np.abs(got[name]), np.abs(x @ v[c]), atol=1e-6)
    assert got["pc1_variance_pct"].iloc[0] == pytest.approx(s[0] ** 2 / (s**2).sum() * 100, abs=1e-6)


def test_allocation_and_audience(make):
    camp = dict(campaign_type="Upsell", product_id=1, channel_id=1, total_budget=money(1), start_date=date(2001, 1, 1),
                end_date=date(2001, 2, 1), status="Completed")
    people = [dict(customer_id=i, customer_code=f"C{i}", customer_segment="Premier" if i % 4 == 0 else "Affluent", is_dnc=i == 7,
                   is_active=i != 9) for i in range(1, 41)]
    t = make(customers=people, campaigns=[
        {**camp, "campaign_id": 1, "campaign_code": "A", "target_segment": "Premier", "contacts_target": 10},
        {**camp, "campaign_id": 2, "campaign_code": "B", "target_segment": "Premier", "contacts_target": 30},
        {**camp, "campaign_id": 3, "campaign_code": "C", "target_segment": "All", "contacts_target": 61}])
    alloc = {r["campaign_id"]: r["allocated"] for r in derive.allocate_contacts(t, total=80).collect()}
    assert alloc == {1: 7, 2: 23, 3: 50} and sum(alloc.values()) == 80
    rows = derive.target_audience(t, total=80).collect()
    by = {c: [r["customer_id"] for r in rows if r["campaign_id"] == c] for c in (1, 2, 3)}
    assert len(by[1]) == 7 and all(i % 4 == 0 for i in by[1])          # enough Premier customers
    assert len(by[2]) == 23 and any(i % 4 for i in by[2])              # falls back to everyone
    assert len(by[3]) == 38                                            # never more than there are
    assert all(len(set(v)) == len(v) and not {7, 9} & set(v) for v in by.values())


def test_ban_refresh(make):
    t = make(campaign_interactions=[touch(1, 2, outcome="Opted Out"), touch(2, 2, outcome="Opted Out")])
    assert {r["customer_id"]: r["is_dnc"] for r in derive.dnc_refresh(t).collect()} == {1: False, 2: True, 3: False, 4: False, 5: False}


def test_histogram_edges(make):
    people = [dict(customer_id=i, customer_code=f"C{i}", credit_score=300 + i) for i in range(0, 36)]
    got = [r for r in explore.hist(make(customers=people)).collect() if r["metric"] == "credit_score"]
    assert sum(r["n"] for r in got) == 36 and {r["bin"]: r["n"] for r in got}[34] == 2  # the top edge stays in the last bin


def test_audience_is_drawn_without_writing_out_positions(star, monkeypatch):
    """Runs cut into chunks, wrapped ones too, give each campaign its positions; the customers meet pieces, not single seats."""
    want = sorted(map(tuple, derive.target_audience(star, total=900).collect()))
    monkeypatch.setattr(derive, "CHUNK", 7)
    df = derive.target_audience(star, total=900)
    assert sorted(map(tuple, df.collect())) == want and len(set(want)) == len(want)
    assert {c: sum(w[0] == c for w in want) for c, _, _ in want} == {
        r["campaign_id"]: r["allocated"] for r in derive.allocate_contacts(star, 900).collect() if r["allocated"]}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "place" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)


def test_all_starts_share_a_pass_and_end_where_spark_ends(star, monkeypatch):
    from pyspark.ml.clustering import KMeans
    rounds, one_round = [], clusters.one_round
    monkeypatch.setattr(clusters, "one_round", lambda rows, centres: rounds.append(len(centres)) or one_round(rows, centres))
    got = clusters.best_fits(star, [2, 4], 42, 3, 40)
    assert rounds[0] == 6 and len(rounds) <= 40 and rounds == sorted(rounds, reverse=True)
    rows = clusters.vectors(star)
    for n in (2, 4):
        fits = [KMeans(k=n, seed=42 + i, maxIter=40).fit(rows) for i in range(3)]
        want = min(fits, key=lambda m: m.summary.trainingCost)
        assert got[n].cost == pytest.approx(want.summary.trainingCost, rel=1e-9)
        assert np.allclose(got[n].points, np.array(want.clusterCenters()), atol=1e-8)
        mine, theirs = [{r["customer_id"]: r["prediction"] for r in m.transform(rows).collect()} for m in (got[n], want)]
        assert mine == theirs
