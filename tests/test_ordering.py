import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from campaignry.plans.ordering import (
    SortedRuns, after_keys, long_frame, percentiles, rank_cut_ends, running_sums, tile_ends, tile_of,
)
from campaignry.session import local_frame


def hot_rows(n=900, seed=1):
    """A third of the rows hold one value."""
    rng = random.Random(seed)
    return [(i, 7 if i % 3 == 0 else rng.randint(0, 500), "ab"[i % 2]) for i in range(n)]


@pytest.mark.parametrize("probs", [[0.0, 0.25, 0.5, 0.75, 1.0], [0.1, 0.9]])
def test_percentiles_match_numpy(spark, probs):
    rows = hot_rows()
    df = local_frame(spark, rows, "id long, v long, g string")
    found = percentiles(df, "v", probs, group="g")
    for g in "ab":
        want = np.quantile([v for _, v, h in rows if h == g], probs)
        assert found[g] == pytest.approx(list(want), abs=1e-9)


def test_weighted_percentiles_equal_repeated_rows(spark):
    rows = [(i, (i * 37) % 50, 1 + i % 5) for i in range(60)]
    df = local_frame(spark, rows, "id long, v long, w long")
    want = np.quantile(np.repeat([v for _, v, _ in rows], [w for *_, w in rows]), [0.2, 0.5, 0.8])
    assert percentiles(df, "v", [0.2, 0.5, 0.8], weight="w")["all"] == pytest.approx(list(want))


@pytest.mark.parametrize("n,tiles", [(7, 5), (3, 5), (100, 4), (901, 10), (5, 5)])
def test_tiles_equal_the_window_function(spark, n, tiles):
    df = local_frame(spark, hot_rows(n), "customer_id long, v long, g string")
    with SortedRuns(long_frame(df, {"v": F.col("v")}, keep=["customer_id"]), tie="customer_id") as runs:
        ends = [r for r in tile_ends(runs.size("v"), tiles) if r > 0]
        keys = runs.pick({"v": ends})
    tile = after_keys(F.col("v"), F.col("customer_id"), [keys["v", r] for r in ends if r < n]) + 1
    order = Window.orderBy("v", "customer_id")
    both = df.select(tile.alias("a"), F.ntile(tiles).over(order).alias("b"),
                     tile_of(F.row_number().over(order), F.lit(n), tiles).alias("c")).collect()
    if n >= tiles:
        assert all(r["a"] == r["b"] for r in both)
    assert all(r["c"] == r["b"] for r in both)


@pytest.mark.parametrize("n,bins", [(7, 5), (10, 4), (23, 5), (1000, 5)])
def test_rank_cuts_equal_qcut(n, bins):
    want = pd.qcut(pd.Series(range(1, n + 1)), q=bins, labels=False)
    ends = rank_cut_ends(n, bins)
    assert [sum(r > e for e in ends) for r in range(1, n + 1)] == list(want)


def test_running_sums_over_partitions(spark):
    rows = hot_rows(700)
    df = local_frame(spark, rows, "id long, v long, g string")
    got = {r["id"]: r["total"] for r in running_sums(df, [F.desc("v"), F.col("id")], {"total": "v"}).collect()}
    total = 0
    for i, v, _ in sorted(rows, key=lambda r: (-r[1], r[0])):
        total += v
        assert got[i] == total


def test_no_rows(spark):
    df = local_frame(spark, [], "id long, v long, g string")
    assert percentiles(df, "v", [0.5]) == {}
    assert running_sums(df, [F.col("id")], {"total": "v"}).count() == 0
    assert math.isclose(sum(tile_ends(0, 4)), 0)
