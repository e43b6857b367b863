from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from campaignry.catalog import operators
from campaignry.operators import propensity as p
from campaignry.operators import search as s
from campaignry.session import local_frame


def test_auc_counts_pairs_with_half_credit_for_ties():
    rng = np.random.default_rng(2)
    label, score = rng.integers(0, 2, 200), rng.integers(0, 9, 200) / 9
    pos, neg = score[label == 1], score[label == 0]
    want = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert s.auc(label, score) == pytest.approx(want) and s.auc(np.ones(3), np.ones(3)) == 0.5


def test_bounded_rows_do_not_depend_on_their_order(spark):
    rows = local_frame(spark, [(i,) for i in range(50)], "interaction_id long")
    some = {r[0] for r in s.bounded(rows, 20).collect()}
    assert len(some) == 20 and some == {r[0] for r in s.bounded(rows.repartition(7), 20).collect()}
    assert s.bounded(rows, 99).count() == 50 and s.data_print(rows) == s.data_print(rows.repartition(3)) != s.data_print(rows.limit(49))


def test_a_stopped_search_goes_on(star, monkeypatch):
    """The second driver does only the fits that the first has not finished, and ends with the same figures."""
    c = s.Candidates("logistic_regression_test", [{"C": v, "penalty": "l2"} for v in (0.01, 1, 100)], p._logreg)
    train = p.train_rows(star, 3)
    first, done = s.FoldSearch(train, p.preprocessor, 3, 300), []
    for name in list(first.kept.all()):
        if name.startswith(c.name):  # from an earlier run of this test
            first.kept.fs.delete(first.kept.path(f"{name}={first.kept.all()[name]!r}"), False)
    score = first.score

    def fails(*args):
        done.append(args)
        if len(done) == 5:
            raise RuntimeError("lost")
        return score(*args)
    monkeypatch.setattr(first, "score", fails)
    with pytest.raises(RuntimeError, match="lost"):
        first.run(c, 1)
    again, more = s.FoldSearch(train, p.preprocessor, 3, 300), []
    assert again.kept.folder == first.kept.folder
    monkeypatch.setattr(again, "score", lambda *args: more.append(args) or score(*args))
    means = again.run(c, 1)
    assert len(more) == 5 and again.run(c, 1) == means and len(more) == 5
    assert all(0 <= m <= 1 for m in means)
    held = [first.part(f)[1].count() for f in range(3)]
    assert sum(held) == 300  # the folds are parts of the bounded rows
    first.close()
    again.close()


def test_auc_of_a_frame_is_the_auc_of_its_arrays(spark):
    rng = np.random.default_rng(2)
    label, score = rng.integers(0, 2, 300).astype(float), rng.integers(0, 9, 300) / 9
    rows = local_frame(spark, list(zip(label.tolist(), score.tolist())), "label double, score double").repartition(3)
    assert s.frame_auc(rows) == pytest.approx(s.auc(label, score)) and s.frame_auc(rows.filter("label = 1")) == 0.5


def test_folds_too_large_for_a_task_are_fitted_over_the_cluster(star, monkeypatch):
    """The same figures, and no broadcast of the rows."""
    train = p.train_rows(star, 3)
    boost = {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 2, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1, "gamma": 0}
    cases = [s.Candidates("boosted_large_test", [boost, boost | {"max_depth": 1}], p._boost, p.held_scores, spread=p.fit_spread),
             s.Candidates("logreg_large_test", [{"C": 0.1, "penalty": "l2"}], p._logreg)]
    monkeypatch.setattr(s.Kept, "put", lambda *args: None)
    small, large = s.FoldSearch(train, p.preprocessor, 3), s.FoldSearch(train, p.preprocessor, 3, task_rows=100)
    assert small.small and not large.small and small.size == large.size == train.count()
    monkeypatch.setattr(large, "scores", None)
    for c in cases:
        assert large.run(c) == pytest.approx(small.run(c), abs=1e-6)
    assert not large._parts
    small.close()


MODEL_QUERIES = ["ml_confusion", "ml_curves", "ml_importance", "ml_metrics", "ml_rank_agreement", "ml_rf", "ml_roi_scenarios", "ml_save",
                 "ml_threshold_sweep", "target_list", "ml_gbt", "ml_logreg"]


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_folds_and_final_fits_read_all_training_rows(star, monkeypatch, name):
    """More rows than the search once took for its folds (2,000) and its final fits (20,000)."""
    class Seen(Exception):
        pass

    n, t = 21_000, replace(star, _memo={})
    rows = star.spark.range(n).select(
        F.col("id").alias("interaction_id"), (F.col("id") % 2).cast("int").alias("converted"), (F.col("id") % 5).cast("int").alias("fold"),
        array_to_vector(F.array(F.col("id").cast("double"))).alias("features"))
    monkeypatch.setattr(p, "train_rows", lambda t, folds=5: rows)
    monkeypatch.setattr(p, "prepared", lambda t, folds=5: (None, s.with_weights(rows), None, ["id"]))
    folds = []
    monkeypatch.setattr(s.FoldSearch, "run", lambda self, c, parallelism=None: folds.append(self.rows.count()) or [0.5] * len(c.settings))

    def final(self, c, setting, rows, n, kind):
        raise Seen(rows.count(), n)
    monkeypatch.setattr(s.FoldSearch, "final", final)
    if name == "ml_save":
        monkeypatch.setattr(p, "save_models", lambda t, folder: p.models(t))
    with pytest.raises(Seen) as seen:
        operators()[name](t).collect()
    assert folds == [n] and seen.value.args == (n, n)
