"""Order-based work over rows that do not fit one task.

An unpartitioned window puts every row into a single task, and a percentile aggregate keeps all
distinct values of a group in one buffer. The helpers here range-partition on the ordering key
instead, so a sorted run is spread over the executors, and need on the driver only one total per
(partition, group). Keys end in a unique column or are pre-aggregated, so that a value held by a
third of all rows is still split over partitions or collapsed to one row.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from fractions import Fraction
from itertools import accumulate

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campaignry.session import cut_lineage, local_frame

_PID = "_pid"
_W = "_weight"


def long_frame(df: DataFrame, metrics: dict[str, Column], keep: list[str] = (), as_type: str = "decimal(18,4)") -> DataFrame:
    """One row per (metric, input row): columns ``grp``, ``val`` and the kept ones."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("grp"), c.cast(as_type).alias("val")) for name, c in metrics.items()
    ])
    return df.select(*keep, F.explode(entries).alias("_e")).select(*keep, "_e.grp", "_e.val").filter("val IS NOT NULL")


class SortedRuns:
    """Rows sorted by (group, value, tie) over range partitions, with per-partition weights.

    Ranks are 1-based positions in the group's order, counted with the weight of each row.
    """

    def __init__(self, df: DataFrame, tie: str | None = None, weight: str | None = None):
        w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
        if tie is None:
            rows = df.groupBy("grp", "val").agg(F.sum(w).alias(_W))
            self.key = ["grp", "val"]
        else:
            rows = df.select("grp", "val", F.col(tie).alias("tie"), w.alias(_W))
            self.key = ["grp", "val", "tie"]
        self.rows = (
            rows.repartitionByRange(*self.key)
            .withColumn(_PID, F.spark_partition_id())
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
        # One row per partition, plus one per group that starts inside it.
        totals = self.rows.groupBy("grp", _PID).agg(F.sum(_W).alias("t")).collect()
        per_group = defaultdict(list)
        for r in totals:
            per_group[r["grp"]].append((r[_PID], int(r["t"])))
        self.runs = {}
        for g, parts in per_group.items():
            parts.sort()
            self.runs[g] = ([p for p, _ in parts], list(accumulate(t for _, t in parts)))

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.rows.unpersist()

    def size(self, group) -> int:
        return self.runs[group][1][-1] if group in self.runs else 0

    def pick(self, wanted: dict[object, list[int]]) -> dict[tuple, tuple]:
        """{(group, rank): (value, tie)} for a handful of ranks per group."""
        targets, pids = [], set()
        for g, ranks in wanted.items():
            if g not in self.runs:
                continue
            parts, ends = self.runs[g]
            for r in sorted(set(ranks)):
                i = bisect_left(ends, r)
                before = ends[i - 1] if i else 0
                targets.append((g, parts[i], r - before, r))
                pids.add(parts[i])
        if not targets:
            return {}
        spark = self.rows.sparkSession
        kind = self.rows.schema["grp"].dataType.simpleString()
        goals = local_frame(spark, targets, f"g {kind}, p int, local long, rank long")
        in_run = Window.partitionBy(_PID, "grp").orderBy(*self.key).rowsBetween(Window.unboundedPreceding, 0)
        tie = F.col("tie") if "tie" in self.key else F.lit(None).cast("long").alias("tie")
        ranked = (
            self.rows.filter(F.col(_PID).isin([int(p) for p in pids]))
            .withColumn("_end", F.sum(_W).over(in_run))
        )
        hits = ranked.join(
            F.broadcast(goals),  # one row per asked rank
            (ranked["grp"] == goals["g"]) & (ranked[_PID] == goals["p"])
            & (goals["local"] <= ranked["_end"]) & (goals["local"] > ranked["_end"] - ranked[_W]),
        ).select(ranked["grp"], "rank", "val", tie)
        return {(r["grp"], r["rank"]): (r["val"], r["tie"]) for r in hits.collect()}

    def percentiles(self, probs: list[float], groups=None) -> dict[object, list]:
        """Exact linearly interpolated percentiles per group."""
        spots = {}
        for g in self.runs if groups is None else groups:
            n = self.size(g)
            spots[g] = [Fraction(str(p)) * (n - 1) for p in probs]
        wanted = {g: [r for h in hs for r in (math.floor(h) + 1, math.ceil(h) + 1)] for g, hs in spots.items()}
        found = self.pick(wanted)
        out = {}
        for g, hs in spots.items():
            vals = []
            for h in hs:
                lo, hi = found[(g, math.floor(h) + 1)][0], found[(g, math.ceil(h) + 1)][0]
                if isinstance(lo, float):
                    vals.append(lo + (hi - lo) * float(h - math.floor(h)))
                else:
                    vals.append(Fraction(lo) + (Fraction(hi) - Fraction(lo)) * (h - math.floor(h)))
            out[g] = vals
        return out


def percentiles(df: DataFrame, value: str, probs: list[float], group: str | None = None,
                weight: str | None = None, as_type: str = "decimal(18,4)") -> dict[object, list[float]]:
    """Exact percentiles of one column, optionally per group of a small coded column."""
    g = F.lit("all") if group is None else F.col(group)
    keep = [] if weight is None else [weight]
    rows = df.select(*keep, g.alias("grp"), F.col(value).cast(as_type).alias("val")).filter("val IS NOT NULL")
    with SortedRuns(rows, weight=weight) as runs:
        return {k: [float(v) for v in vs] for k, vs in runs.percentiles(probs).items()}


def tile_ends(n: int, tiles: int) -> list[int]:
    """Last rank of each tile but the final one; the first n mod tiles get one row more."""
    q, r = divmod(n, tiles)
    return [j * q + min(j, r) for j in range(1, tiles)]


def tile_of(row_number, n, tiles: int) -> Column:
    """NTILE from a row number and a total, both columns or numbers."""
    n_ = F.lit(n) if isinstance(n, int) else n
    q, r = F.floor(n_ / tiles), n_ % tiles
    big = r * (q + 1)
    return F.when(row_number <= big, F.floor((row_number - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((row_number - big - 1) / F.greatest(q, F.lit(1))) + 1
    ).cast("int")


def rank_cut_ends(n: int, bins: int) -> list[int]:
    """Last rank of each right-closed equal-width cut of the ranks 1..n, but the final one."""
    return [1 + ((n - 1) * j) // bins for j in range(1, bins)]


def after_keys(value: Column, tie: Column, keys: list[tuple], value_type: str = "decimal(18,4)") -> Column:
    """How many of the given (value, tie) keys lie strictly before the row's key."""
    out = F.lit(0)
    v = value.cast(value_type)
    for k_val, k_tie in keys:
        kv = F.lit(k_val).cast(value_type)
        out = out + F.when((v > kv) | ((v == kv) & (tie > F.lit(k_tie))), 1).otherwise(0)
    return out


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Adds exact running totals {output: column} in the given total order, over range partitions.

    ``order`` must be unique per row. The frame is cut first so that partition borders stay fixed
    between the pass that totals the partitions and the pass that reads them.
    """
    runs = cut_lineage(df.repartitionByRange(*order).withColumn(_PID, F.spark_partition_id()))
    totals = runs.groupBy(_PID).agg(*[F.sum(c).alias(o) for o, c in sums.items()])
    # One row per partition: the window below is as small as the partition count.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(_PID).alias("_p"), *[F.coalesce(F.sum(o).over(before), F.lit(0)).alias(f"_before_{o}") for o in sums]
    )
    local = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = runs.join(F.broadcast(offsets), F.col(_PID) == F.col("_p"))
    out = out.withColumns({o: F.sum(c).over(local) + F.col(f"_before_{o}") for o, c in sums.items()})
    return out.drop(_PID, "_p", *[f"_before_{o}" for o in sums])
