import random
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaignry.catalog import operators
from campaignry.operators import propensity as p
from campaignry.session import local_frame


SMALL_SEARCH = p.Search(
    logreg=[{"C": 0.1, "penalty": "l2"}], folds=3,
    forest=[{"n_estimators": 30, "max_depth": 5, "min_samples_leaf": 5, "max_features": "sqrt"}],
    boost=[{"n_estimators": 15, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8, "colsample_bytree": 0.8, "min_child_weight": 5, "gamma": 0}])


def scored_rows(n=400, seed=3):
    """Two models with many tied scores; the first follows the label."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        for model, s in (("a", 0.35 * y + rng.choice([0.1, 0.25, 0.33, 0.5, 0.61])), ("b", round(rng.random(), 2))):
            out.append((i, model, y, float(s)))
    return out


def brute(rows, model):
    y = np.array([r[2] for r in rows if r[1] == model])
    s = np.array([r[3] for r in rows if r[1] == model])
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean())
    ap, seen = 0.0, 0.0
    for v in sorted(set(s), reverse=True):
        hit = s >= v
        recall = y[hit].sum() / y.sum()
        ap += (recall - seen) * y[hit].mean()
        seen = recall
    return y, s, auc, ap


def test_metrics_match_brute_force(spark):
    rows = scored_rows()
    df = local_frame(spark, rows, "interaction_id long, model string, converted int, score double")
    got = {r["model"]: r for r in p.curve_metrics(p.score_curve(df)).collect()}
    for m in "ab":
        y, s, auc, ap = brute(rows, m)
        hit = s >= 0.5
        assert got[m]["roc_auc"] == pytest.approx(auc, abs=6e-5) and got[m]["avg_precision"] == pytest.approx(ap, abs=6e-5)
        assert got[m]["precision"] == pytest.approx(y[hit].mean(), abs=6e-5) and got[m]["recall"] == pytest.approx(hit[y == 1].mean(), abs=6e-5)
        assert got[m]["accuracy"] == pytest.approx((hit == y).mean(), abs=6e-5)


def test_threshold_sweep_matches_brute_force(spark):
    rows = scored_rows()
    df = local_frame(spark, rows, "interaction_id long, model string, converted int, score double")
    for r in p.threshold_table(df).collect():
        y, s, *_ = brute(rows, r["model"])
        hit = s >= r["b"] / 100
        assert (r["contacts"], r["captured"], r["rows"], r["positives"]) == (hit.sum(), y[hit].sum(), len(y), y.sum())


def test_split_is_exact_stratified_and_repeatable(star):
    rows = p.ml_split(star).collect()
    for c in (0, 1):
        mine = [r for r in rows if r["converted"] == c]
        test = [r for r in mine if r["is_test"]]
        assert len(test) == int(len(mine) * 0.2 + 0.5)
        folds = np.bincount([r["fold"] for r in mine if not r["is_test"]])
        assert len(folds) == 5 and folds.max() - folds.min() <= 1
    [star._memo.pop(key) for key in list(star._memo) if key[0] == "split"]
    assert {r["interaction_id"] for r in p.ml_split(star).filter("is_test").collect()} == {r["interaction_id"] for r in rows if r["is_test"]}


def test_dataset_has_no_gaps(star):
    data = p.build_ml_dataset(star)
    assert data.count() == star.campaign_interactions.count()
    assert data.select(sum(F.count_if(F.col(c).isNull()) for c in p.FEATURES).alias("n")).first()["n"] == 0


def test_unseen_level_becomes_zeros(star):
    model, _, _, names = p.prepared(star)
    odd = p.test_rows(star).limit(1).withColumn("channel_name", F.lit("Carrier Pigeon"))
    vec = model.transform(odd).first()["features"].toArray()
    assert len(vec) == len(names) and all(vec[i] == 0 for i, n in enumerate(names) if n.startswith("channel_name="))


def test_draws_are_distinct_and_in_the_space():
    some = p.draws(p.BOOST_SPACE, 25)
    assert len({tuple(sorted(d.items())) for d in some}) == 25
    assert all(d[k] in v for d in some for k, v in p.BOOST_SPACE.items())
    assert len(p.Search().logreg) == 12 and len(p.Search().forest) == 20


def test_models_learn_and_reports_hold(star):
    star._memo["search"] = SMALL_SEARCH
    got = {r["model"]: r for r in p.ml_metrics(star).collect()}
    assert set(got) == set(p.MODELS) and all(r["roc_auc"] > 0.6 for r in got.values())
    sweep = p.ml_threshold_sweep(star).orderBy("threshold").collect()
    assert len(sweep) == 80 and sum(r["is_best_f1"] for r in sweep) == 1
    assert all(a["contacts"] >= b["contacts"] for a, b in zip(sweep, sweep[1:]))
    assert p.ml_roi_scenarios(star).count() == 6
    assert all(r["score"] >= 0.65 for r in p.target_list(star).collect())
    assert p.ml_rank_agreement(star).count() == 15
    confusion = p.ml_confusion(star).collect()
    for m in p.MODELS:
        assert sum(r["n"] for r in confusion if r["model"] == m) == p.test_rows(star).count()


def test_results_follow_their_arguments(star):
    assert p.ml_split(star, test_share=0.5).filter("is_test").count() > p.ml_split(star).filter("is_test").count()
    three = p.ml_split(star, folds=3).filter("NOT is_test").groupBy("fold").count().collect()
    assert len(three) == 3 and max(r["count"] for r in three) - min(r["count"] for r in three) <= 2


def test_one_setting_is_cross_validated_and_named(star):
    star._memo["search"] = SMALL_SEARCH
    row = p.ml_logreg(star).first()
    assert 0.5 < row["cv_auc"] <= 1 and row["best_setting"] == "C=0.1, penalty=l2"


def test_registered_queries_run_the_default_search(monkeypatch):
    trained = ["ml_logreg", "ml_rf", "ml_gbt", "ml_metrics", "ml_curves", "ml_confusion", "ml_importance", "ml_rank_agreement",
               "ml_threshold_sweep", "ml_roi_scenarios", "ml_save", "target_list"]
    for name in trained:
        monkeypatch.setattr(p, name, lambda t: t._memo.get("search") or p.Search())
    full = p.Search()
    assert (len(full.logreg), len(full.forest), len(full.boost), full.folds) == (12, 20, 25, 5)
    assert all(operators()[name](SimpleNamespace(_memo={})) == full for name in trained)
