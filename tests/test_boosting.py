import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from campaignry.operators import boosting as b
from campaignry.operators import propensity as p
from campaignry.operators import search as s
from campaignry.session import local_frame, scratch_path

ONE = {"n_estimators": 1, "learning_rate": 0.5, "max_depth": 1, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1, "gamma": 0}


def data(n=400, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 3, n).astype(float), rng.normal(size=n)], axis=1)
    y = (rng.random(n) < b.sigmoid(2 * x[:, 0] - 1.5 * (x[:, 1] == 2))).astype(float)
    return x, y, np.where(y == 1, 2.0, 1.0)


def test_first_split_is_the_best_of_all_cuts():
    x, y, w = data(60)
    trees = b.grow(x, y, w, ONE)
    g, h, best = (0.5 - y) * w, 0.25 * w, (-1.0,)
    part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
    for f in range(3):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            if h[left].sum() >= 1 and h[~left].sum() >= 1:
                gain = 0.5 * (part(left) + part(~left) - part(np.ones(len(y), bool)))
                best = max(best, (gain, f, cut))
    assert (trees.gain[0, 0], trees.feature[0, 0], trees.threshold[0, 0]) == (pytest.approx(best[0]), best[1], best[2])
    left = x[:, best[1]] <= best[2]
    assert trees.value[0, 1] == pytest.approx(-0.5 * g[left].sum() / (h[left].sum() + 1))
    assert np.allclose(trees.margin(x), np.where(left, trees.value[0, 1], trees.value[0, 2]))


def test_boosting_lowers_the_loss_and_limits_hold():
    x, y, w = data()
    setting = ONE | {"n_estimators": 40, "max_depth": 3, "learning_rate": 0.1}
    loss = lambda t: -(w * np.where(y == 1, np.log(b.sigmoid(t.margin(x))), np.log(1 - b.sigmoid(t.margin(x))))).sum()
    few, many = b.grow(x, y, w, setting | {"n_estimators": 5}), b.grow(x, y, w, setting)
    assert loss(many) < loss(few) < -(w * np.log(0.5)).sum()
    assert (b.grow(x, y, w, setting | {"gamma": 1e6}).feature == -1).all()  # no split is worth it
    assert (b.grow(x, y, w, setting | {"min_child_weight": 1e6}).feature == -1).all()
    half = setting | {"subsample": 0.7, "colsample_bytree": 0.6}
    assert (b.grow(x, y, w, half).value == b.grow(x, y, w, half).value).all()  # reruns agree
    assert all(len(np.unique(f[f >= 0])) <= 2 for f in b.grow(x, y, w, half).feature)
    fresh, label, _ = data(seed=6)
    assert s.auc(label, b.held_scores(setting, x, y, w, fresh)) > 0.75


def test_no_rows_and_one_class_give_half():
    x, y, w = data(20)
    assert (b.held_scores(ONE, x[:0], y[:0], w[:0], x) == 0.5).all() and (b.held_scores(ONE, x, y * 0, w, x) == 0.5).all()
    assert len(b.held_scores(ONE, x, y, w, x[:0])) == 0


def test_model_scores_saves_and_loads(spark):
    x, y, w = data()
    rows = local_frame(spark, [(list(map(float, r)), float(a), float(c)) for r, a, c in zip(x, y, w)], "x array<double>, label double, pos_weight double")
    rows = rows.select(array_to_vector("x").alias("features"), "label", "pos_weight")
    setting = ONE | {"n_estimators": 20, "max_depth": 4}
    model = b.BoostedTreesClassifier(setting).fit(rows.repartition(3))
    path = scratch_path(spark, "boost")
    model.write().save(path)
    model.write().overwrite().save(path)
    for m in (model, b.BoostedTreesModel.load(path)):
        got = m.transform(rows).select(vector_to_array("features").alias("x"), vector_to_array("probability").alias("p"), "prediction").collect()
        want = b.sigmoid(m.trees.margin(np.array([r["x"] for r in got])))
        assert np.allclose([r["p"][1] for r in got], want) and all(r["prediction"] == (r["p"][1] > 0.5) for r in got)
        assert sum(m.featureImportances.toArray()) == pytest.approx(1) and m.featureImportances.toArray().argmax() == 0
        assert m.transform(rows.filter(F.lit(False))).count() == 0


def test_search_in_tasks_equals_fits_one_by_one(star):
    settings = [ONE | {"n_estimators": 5}, ONE | {"n_estimators": 8, "max_depth": 3}]
    c = s.Candidates("boosted_test", settings, p._boost, b.held_scores)
    search = s.FoldSearch(p.train_rows(star, 3), p.preprocessor, 3, 300)
    got = search.scores(c, [(i, f) for i in range(2) for f in range(3)])
    for (i, f), value in got.items():
        x, y, w, held, label = search.arrays(f)
        assert value == pytest.approx(s.auc(label, b.held_scores(settings[i], x, y, w, held)))
    assert search.run(c) == pytest.approx([sum(got[i, f] for f in range(3)) / 3 for i in range(2)])
    search.close()


def test_inputs_that_never_meet_share_a_column_and_count_the_same():
    x, y, w = data(300)
    x = np.concatenate([x, np.eye(4)[np.random.default_rng(1).integers(0, 4, 300)], (x[:, :1] > 0).astype(float)], axis=1)
    cuts = b.cut_points(x)
    inputs = b.Inputs(b.bin_codes(x, cuts), b.alone)
    assert len(inputs.narrow) == 5 and len(inputs.bundles) < 5
    node, rows = np.arange(300) % 3, np.arange(300)
    asked = np.array([True, False, True, True, False, True, True, True])
    cells = inputs.histograms(rows, node, 3, y, w, asked)
    sums = np.stack([np.bincount(node, v, 3) for v in (y, w)])
    left, feature, last = inputs.left_sums(cells, sums, asked)
    assert sorted(set(feature)) == list(np.flatnonzero(asked))
    for i in range(len(feature)):
        for n in range(3):
            mine = (node == n) & (inputs.codes[feature[i]] <= last[i])
            assert left[:, n, i] == pytest.approx([y[mine].sum(), w[mine].sum()])


def boost_rows(spark, n=700):
    x, y, w = data(n)
    rows = local_frame(spark, [(list(map(float, r)), float(a), float(c)) for r, a, c in zip(x, y, w)], "x array<double>, label double, pos_weight double")
    return x, rows.select("x", array_to_vector("x").alias("features"), "label", "pos_weight")


def test_cuts_of_all_rows_are_those_of_one_task(spark):
    x, rows = boost_rows(spark)
    assert all((a == c).all() and len(a) == len(c) for a, c in zip(b.exact_cuts(rows.repartition(5), "x", len(x)), b.cut_points(x), strict=True))


def test_fits_spread_over_tasks_grow_the_trees_of_one_task(spark):
    x, rows = boost_rows(spark)
    settings = [ONE | {"n_estimators": 2, "max_depth": 3, "colsample_bytree": 0.6, "learning_rate": 0.1}, ONE,
                ONE | {"n_estimators": 2, "max_depth": 2, "subsample": 0.7}]
    many = b.fit_spread(rows.repartition(3), len(x), settings)
    for setting, spread in zip(settings[:2], many):
        one = b.BoostedTreesClassifier(setting).fit(rows)
        assert (one.trees.feature == spread.trees.feature).all() and (one.trees.threshold == spread.trees.threshold).all()
        assert np.allclose(one.trees.value, spread.trees.value) and np.allclose(one.trees.margin(x), spread.trees.margin(x))
    assert s.auc(np.array([r["label"] for r in rows.collect()]), many[2].trees.margin(x)) > 0.7
    one_class = b.BoostedTreesClassifier(settings[0], task_rows=200).fit(rows.withColumn("label", F.lit(1.0)))
    assert (one_class.trees.feature == -1).all()


def test_sums_over_tasks_go_in_slices(monkeypatch):
    class Three:
        def getTaskInfos(self):
            return [None] * 3

        def allGather(self, text):
            sent.append(len(text))
            return [text] * 3
    sent = []
    monkeypatch.setattr(b, "SENT", 240)
    sums = np.arange(24.0).reshape(2, 3, 4)
    assert (b.summed(Three(), sums) == 3 * sums).all() and len(sent) == 3
