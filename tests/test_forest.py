import numpy as np
import pytest

from campaignry.operators import forest as f
from campaignry.operators import propensity as p
from campaignry.operators.search import auc

SETTING = {"n_estimators": 60, "max_depth": None, "min_samples_leaf": 1, "max_features": "sqrt"}


def data(n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 3, n).astype(float), *rng.normal(size=(3, n))], axis=1)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x[:, 0] + 1.5 * (x[:, 1] == 2)))).astype(float)
    return x, y, np.where(y == 1, 2.0, 1.0)


def test_forest_learns_and_repeats():
    x, y, w = data()
    args = (x[:400], y[:400], w[:400], x[400:])
    for setting in (SETTING, SETTING | {"max_depth": 5, "max_features": 0.3}, SETTING | {"min_samples_leaf": 20, "max_features": "log2"}):
        got = f.forest_scores(setting, *args)
        assert auc(y[400:], got) > 0.8 and got.min() >= 0 and got.max() <= 1
        assert (got == f.forest_scores(setting, *args)).all()


def test_limits_hold():
    x, y, w = data()
    mean = (w * y).sum() / w.sum()
    assert np.allclose(f.forest_scores(SETTING | {"min_samples_leaf": 400}, x, y, w, x[:9]), mean, atol=0.05)  # no split leaves enough rows
    assert len(set(f.forest_scores(SETTING | {"n_estimators": 1, "max_depth": 1}, x, y, w, x).round(9))) <= 2
    assert (f.forest_scores(SETTING, x, np.ones(len(x)), w, x[:4]) == 1).all()
    assert len(f.forest_scores(SETTING, x, y, w, x[:0])) == 0 and (f.forest_scores(SETTING, x[:0], y[:0], w[:0], x[:3]) == 0.5).all()
    assert [f.inputs_of_a_node(s, 41) for s in ("sqrt", "log2", 0.3)] == [7, 6, 13]


def test_the_first_split_is_the_best_of_all_cuts():
    x, y, w = data(60)
    codes = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(f.cut_points(x, f.BINS), x.T)], axis=1)
    every = np.arange(x.shape[1])[None, :]
    gain, feature, at = f.best_splits(codes, np.zeros(60, dtype=int), np.ones(60), w, w * y, 1, every, 5)
    gini = lambda m: 2 * (w * y)[m].sum() * (w * (1 - y))[m].sum() / w[m].sum()
    found = max(gini(codes[:, 0] >= 0) - gini(codes[:, j] <= b) - gini(codes[:, j] > b) for j in range(x.shape[1]) for b in range(f.BINS)
                if 5 <= (codes[:, j] <= b).sum() <= 55)
    assert gain[0] == pytest.approx(found)
    left = codes[:, feature[0]] <= at[0]
    assert gini(left | True) - gini(left) - gini(~left) == pytest.approx(found)


def test_the_search_fits_forests_in_tasks():
    assert p._candidates("Random Forest", p.Search()).in_task is f.forest_scores
    assert p._candidates("Random Forest", p.Search()).weight == "weight"


def test_a_query_of_one_model_fits_no_other(star, monkeypatch):
    from dataclasses import replace
    t, asked, rows = replace(star, _memo={}), [], p.test_rows(star)

    def scored(t, names=tuple(p.MODELS)):
        asked.extend(names)
        return rows.limit(20).select(*p.IDS, "converted", p.F.lit(names[0]).alias("model"), p.F.lit(0.7).alias("score"))
    monkeypatch.setattr(p, "scored", scored)
    assert p.target_list(t).count() == 20 and p.ml_roi_scenarios(t).count() == 6 and p.ml_threshold_sweep(t).count() == 80
    assert asked == ["Boosted Trees"]
    assert p.all_scored(t).count() == 60 and asked == ["Boosted Trees", "Logistic Regression", "Random Forest"]


def test_counting_and_sorting_find_the_best_splits():
    rng = np.random.default_rng(4)
    for many in (1, 3, 40):
        node = np.concatenate([np.arange(many), rng.integers(0, many, 400)])
        cols = f.drawn_inputs(rng, many, 9, 4)
        assert all(len(set(c)) == 4 and c.max() < 9 for c in cols)
        codes, cnt, kind = rng.integers(0, f.BINS, (len(node), 4)).astype(np.uint8), rng.poisson(1, len(node)) + 1, rng.integers(0, 2, len(node))
        codes[:, 1] //= 16
        kinds = np.array([0.0, 1.0]), np.array([0.7, 2.5])
        cw = cnt * kinds[1][kind]
        want = f.best_splits(codes, node, cnt, cw, cw * kinds[0][kind], many, cols, 3)
        gini = lambda m: 2 * (cw * kind)[m].sum() * (cw * (1 - kind))[m].sum() / max(cw[m].sum(), 1e-300)
        for found in (f.counted_splits, f.sorted_splits):
            gain, col, at = found(codes, node, cnt, kind, kinds, many, cols, 3)
            assert gain == pytest.approx(want[0])
            for i in np.flatnonzero(gain > 0):  # the split named has the gain named
                here, low = node == i, codes[:, list(cols[i]).index(col[i])] <= at[i]
                assert gain[i] == pytest.approx(gini(here) - gini(here & low) - gini(here & ~low))
    assert (np.sort(f.drawn_inputs(rng, 5, 4, 4), axis=1) == np.arange(4)).all()


def test_many_different_weights_and_trees_in_batches():
    x, y, w = data()
    odd = w * np.random.default_rng(1).uniform(0.9, 1.1, len(w))
    shallow = SETTING | {"max_depth": 5}
    assert auc(y[400:], f.forest_scores(shallow, x[:400], y[:400], odd[:400], x[400:])) > 0.8
    few = f.forest_scores(SETTING | {"n_estimators": 31}, x[:400], y[:400], w[:400], x[400:])
    assert few.min() >= 0 and few.max() <= 1 and auc(y[400:], few) > 0.8
