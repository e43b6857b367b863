"""Centroid clustering against plain rounds with all distances."""

import hashlib
import math
import random

import numpy as np
import pytest

from campaignry.llm import kmeans
from campaignry.session import local_frame

DDL = "vec_id long, embedding array<float>, label int, cluster int, distance long, kind string"


def frame(spark, rows):
    return local_frame(spark, [(i, e, 0, 9, 9, "x") for i, e in rows], DDL)


def plain(rows, plan):
    kept = [(i, [math.floor(plan.scale * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == plan.dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{plan.seed}{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [e for _, e in order[: plan.clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(plan.rounds + 1):
        near = [min((far(e, c), j) for j, c in enumerate(centroids)) for _, e in kept]
        if turn < plan.rounds:
            groups = [[e for (_, e), (_, k) in zip(kept, near) if k == j] for j in range(len(centroids))]
            centroids = [[sum(col) // len(g) for col in zip(*g)] if g else c for g, c in zip(groups, centroids)]
    sums = [sum(d for d, k in near if k == j) for j in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, j, d, sums[j], sum(sums), digest[j]) for (i, _), (d, j) in zip(kept, near)]


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("dims,clusters,spread", [(4, 8, 1.0), (2, 5, 0.004), (64, 3, 1.0), (3, 1, 1.0)])
def test_against_plain_rounds(spark, dims, clusters, spread):
    """Small spreads make many ties: equal vectors and equal distances."""
    rng = random.Random(dims)
    rows = [(rng.choice([None, *range(150)]), [rng.gauss(0, spread) + 3 * spread * (k % 4) for _ in range(dims)]) for k in range(160)]
    rows += [(1, None), (2, [1.0] * (dims + 1)), (3, []), (4, [None] * dims), (5, [float("nan")] * dims), (6, [float("inf")] * dims), rows[0], rows[0]]
    plan = kmeans.ClusterPlan(clusters=clusters, dims=dims)
    got = kmeans.clustered(frame(spark, rows).repartition(3), plan).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain(rows, plan), key=key)


def test_fewer_vectors_than_centroids_and_none(spark):
    plan = kmeans.ClusterPlan(dims=2)
    rows = [(1, [0.5, 0.25]), (2, [-3.0, 1.0]), (2, [-3.0, 1.0])]
    assert sorted(map(tuple, kmeans.clustered(frame(spark, rows), plan).collect())) == sorted(plain(rows, plan))
    assert kmeans.clustered(frame(spark, []), plan).collect() == []


def test_bounds_leave_out_distances_and_keep_the_result():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(-2000, 2000, 64) + rng.integers(-300, 300, (400, 64)) for _ in range(8)])
    c = before = x[rng.choice(len(x), 8, replace=False)]
    state, took = None, []
    for _ in range(9):
        if state is None:
            state = kmeans.assign_all(x, c)
        else:
            *state, n = kmeans.reassign(x, *state, kmeans.Geometry.of(c, before))
            took.append(n)
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        assert (state[0] == d.argmin(axis=1)).all()
        before, c = c, np.array([x[state[0] == j].sum(axis=0) // max((state[0] == j).sum(), 1) if (state[0] == j).any() else c[j] for j in range(8)])
    assert took[-1] < len(x)  # of 8 * len(x) distances a round


def test_components_too_large_for_exact_sums_stop_the_job(spark):
    with pytest.raises(Exception, match="too large"):
        kmeans.clustered(frame(spark, [(1, [1e30, 0.0])]), kmeans.ClusterPlan(dims=2)).collect()
