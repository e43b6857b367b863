"""Centroid clustering by Lloyd's rounds, with Shallot bounds that leave out most distances and change no result.

A vector carries its nearest and second nearest centroid, an upper bound of the distance to the first and a lower bound
of the distance to all others. Centroid moves widen the bounds. Where they still part, or the nearest centroid's half
gap to its neighbour does, the vector stays. Else the remembered second is measured and the scan starts from the closer
of the two: its neighbours come in order of their distance to it, and the ball around it, of the radius of its
distance plus that of the second best so far, shrinks with each better second. Centroids inside the ball are compared
by exact integer distances, ties to the smaller number; the bounds are doubles rounded away from each other.

Each round reads the state of the last one from the shared folder, writes its own and gives the older one back. Only
the moved vectors change the centroid sums; a task writes at most one row a centroid for them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.session import drop_table, local_frame, scratch_path, shuffles_dropped

LIMIT = 1 << 26  # components beyond it could leave the range of exact 64-bit sums
WIDE, NARROW = 1 + 1e-12, 1 - 1e-12  # more than the rounding of any step


@dataclass(frozen=True)
class ClusterPlan:
    clusters: int = 8
    rounds: int = 10
    dims: int = 64
    scale: int = 1024
    seed: str = "3:"


def whole_vectors(rows: DataFrame, plan: ClusterPlan) -> DataFrame:
    """(vec_id, vector) of the rows kept: all components there and finite, as array<long>."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    fine = (F.size("embedding") == plan.dims) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = rows.filter(F.coalesce(fine, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * plan.scale)).alias("vector"))
    far = F.exists("vector", lambda v: (v > LIMIT) | (v < -LIMIT))
    return scaled.withColumn("vector", F.when(far, F.raise_error(F.lit("a component is too large for exact sums")).cast("array<bigint>"))
                             .otherwise(F.col("vector")))


def first_centroids(vectors: DataFrame, plan: ClusterPlan) -> np.ndarray:
    """The vectors of the smallest hashes of their ids; ties by the vector, vectors without id last."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(plan.seed), F.col("vec_id").cast("string")), 256).alias("h"), "vector")
    rows = hashed.orderBy(F.col("h").asc_nulls_last(), "vector").limit(plan.clusters).collect()
    return np.array([r["vector"] for r in rows], np.int64).reshape(len(rows), plan.dims)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distance of each vector to the centroid of its row."""
    gap = vectors - centroids
    return np.einsum("ij,ij->i", gap, gap)


@dataclass
class Geometry:
    """What a round needs of the centroids: neighbours in order, their distances, half gaps and moves."""

    centroids: np.ndarray
    order: np.ndarray
    gaps: np.ndarray
    half: np.ndarray
    moved: np.ndarray
    others: np.ndarray  # the largest move of any other centroid

    @classmethod
    def of(cls, centroids: np.ndarray, before: np.ndarray) -> Geometry:
        k = len(centroids)
        gaps = np.array([[float(((a - b) ** 2).sum()) for b in centroids] for a in centroids]).reshape(k, k) ** 0.5
        order = np.lexsort((np.broadcast_to(np.arange(k), (k, k)), np.where(np.eye(k, dtype=bool), -1, gaps)), axis=1)
        sorted_gaps = np.take_along_axis(gaps, order, axis=1) * NARROW
        half = sorted_gaps[:, 1] / 2 if k > 1 else np.full(k, np.inf)
        moved = (((centroids - before) ** 2).sum(axis=1).astype(float) ** 0.5) * WIDE
        others = np.array([np.delete(moved, i).max(initial=0) for i in range(k)])
        return cls(centroids, order, sorted_gaps, half, moved, others)


def assign_all(x: np.ndarray, c: np.ndarray):
    """Nearest and second nearest centroid of every vector, by all distances, and the bounds; the first round."""
    d = np.stack([squared(x, c[j]) for j in range(len(c))], axis=1)
    order = np.argsort(d, axis=1, kind="stable")
    rows = np.arange(len(x))
    if len(c) == 1:
        return order[:, 0], order[:, 0], d[:, 0].astype(float) ** 0.5 * WIDE, np.full(len(x), np.inf)
    a, b = order[:, 0], order[:, 1]
    return a, b, d[rows, a].astype(float) ** 0.5 * WIDE, d[rows, b].astype(float) ** 0.5 * NARROW


def reassign(x: np.ndarray, a: np.ndarray, b: np.ndarray, upper: np.ndarray, lower: np.ndarray, g: Geometry):
    """The state after a move of the centroids, and the number of distances it took."""
    a, b = a.copy(), b.copy()
    upper = (upper + g.moved[a]) * WIDE
    lower = (lower - g.others[a]) * NARROW
    took = 0
    open_ = np.flatnonzero(upper >= np.maximum(lower, g.half[a]))
    if len(open_) and len(g.centroids) > 1:
        da = squared(x[open_], g.centroids[a[open_]])
        took += len(open_)
        upper[open_] = da.astype(float) ** 0.5 * WIDE
        still = upper[open_] >= np.maximum(lower[open_], g.half[a[open_]])
        open_, da = open_[still], da[still]
    else:
        open_ = open_[:0]
    if len(open_):
        v, best, next_ = x[open_], a[open_], b[open_]
        db = squared(v, g.centroids[next_])
        took += len(open_)
        swap = (db < da) | ((db == da) & (next_ < best))
        best, next_, da, db = np.where(swap, next_, best), np.where(swap, best, next_), np.where(swap, db, da), np.where(swap, da, db)
        start, radius = best.copy(), da.astype(float) ** 0.5 * WIDE
        skip = next_.copy()
        alive = np.arange(len(open_))
        for t in range(1, len(g.centroids)):
            ball = radius[alive] + db[alive].astype(float) ** 0.5 * WIDE
            alive = alive[g.gaps[start[alive], t] <= ball * WIDE]
            if not len(alive):
                break
            j = g.order[start[alive], t]
            new = j != skip[alive]
            rows, j = alive[new], j[new]
            d = squared(v[rows], g.centroids[j])
            took += len(rows)
            first = (d < da[rows]) | ((d == da[rows]) & (j < best[rows]))
            second = ~first & ((d < db[rows]) | ((d == db[rows]) & (j < next_[rows])))
            f, s = rows[first], rows[second]
            db[f], next_[f] = da[f], best[f]
            da[f], best[f] = d[first], j[first]
            db[s], next_[s] = d[second], j[second]
        a[open_], b[open_] = best, next_
        upper[open_], lower[open_] = da.astype(float) ** 0.5 * WIDE, db.astype(float) ** 0.5 * NARROW
    return a, b, upper, lower, took


STATE = "kind int, vec_id long, vector binary, a int, b int, upper double, lower double, distance long, cluster int, count long, sums array<long>"
_state = pa.schema([("kind", pa.int32()), ("vec_id", pa.int64()), ("vector", pa.binary()), ("a", pa.int32()), ("b", pa.int32()),
                    ("upper", pa.float64()), ("lower", pa.float64()), ("distance", pa.int64()), ("cluster", pa.int32()),
                    ("count", pa.int64()), ("sums", pa.list_(pa.int64()))])


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in _state], schema=_state)


def _step(plan: ClusterPlan, g: Geometry, first: bool):
    """Rows of kind 0: the vectors and their new state. Kind 1: what a task adds to the count and sums of each centroid."""
    k = len(g.centroids)

    def run(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, plan.dims), np.int64)
        for batch in batches:
            n = len(batch)
            if first:
                x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(n, plan.dims)
                a, b, upper, lower = assign_all(x, g.centroids)
                moved, left = np.arange(n), a[:0]
                packed = pa.array([row.tobytes() for row in x.astype(np.int32)], pa.binary())
            else:
                packed = batch.column("vector")
                x = np.frombuffer(b"".join(packed.to_pylist()), np.int32).reshape(n, plan.dims).astype(np.int64)
                old, second, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "upper", "lower"))
                a, b, upper, lower, _ = reassign(x, old.astype(np.int64), second.astype(np.int64), upper, lower, g)
                moved = np.flatnonzero(a != old)
                left = old[moved]
            np.add.at(counts, a[moved], 1)
            np.add.at(sums, a[moved], x[moved])
            if len(left):
                np.add.at(counts, left, -1)
                np.add.at(sums, left, -x[moved])
            yield _batch(kind=pa.array(np.zeros(n, np.int32)), vec_id=batch.column("vec_id"), vector=packed, a=pa.array(a), b=pa.array(b),
                         upper=pa.array(upper), lower=pa.array(lower), distance=pa.array(squared(x, g.centroids[a])))
        some = np.flatnonzero(counts | sums.any(axis=1))
        if len(some):
            yield _batch(kind=pa.array(np.ones(len(some), np.int32)), cluster=pa.array(some), count=pa.array(counts[some]),
                         sums=pa.array(list(sums[some]), pa.list_(pa.int64())))
    return run


def _written(rows: DataFrame, plan: ClusterPlan, g: Geometry, first: bool) -> str:
    path = scratch_path(rows.sparkSession, "clusters")
    with shuffles_dropped(rows.sparkSession):
        rows.mapInArrow(_step(plan, g, first), STATE).write.partitionBy("kind").parquet(path)
    return path


def _added(spark, path: str, k: int, plan: ClusterPlan) -> tuple[list[int], list[list[int]]]:
    """Changes of counts and sums, one row a centroid and place; Python integers, since the sums have no bound."""
    rows = spark.read.schema(STATE).parquet(path).filter("kind = 1").select(
        "cluster", F.posexplode(F.concat(F.array("count"), "sums")).alias("i", "x"))
    n, sums = [0] * k, [[0] * plan.dims for _ in range(k)]
    for r in rows.groupBy("cluster", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s")).collect():  # k * (dims + 1) rows
        if r["i"]:
            sums[r["cluster"]][r["i"] - 1] = int(r["s"])
        else:
            n[r["cluster"]] = int(r["s"])
    return n, sums


def cluster(rows: DataFrame, plan: ClusterPlan = ClusterPlan()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector, and the final centroids.

    A row is kept if its embedding has exactly ``plan.dims`` components, none null or not finite; a null embedding goes,
    a null vec_id stays and seeds no centroid while there are others. Repeated rows are vectors of their own. With fewer vectors
    than centroids, each is one. Without vectors there are no centroids and no rows. Components beyond 2^26 after
    scaling stop the job, since their sums might not be exact. Other columns are not read.
    """
    spark = rows.sparkSession
    vectors = whole_vectors(rows.select("vec_id", "embedding"), plan)
    c = first_centroids(vectors, plan)
    k = len(c)
    if not k:
        return local_frame(spark, [], "vec_id long, cluster int, distance long"), c
    path, counts, sums, before = None, [0] * k, [[0] * plan.dims for _ in range(k)], c
    for turn in range(plan.rounds + 1):
        state = vectors if path is None else spark.read.schema(STATE).parquet(path).filter("kind = 0").select(
            "vec_id", "vector", "a", "b", "upper", "lower")
        old, path = path, _written(state, plan, Geometry.of(c, before), path is None)
        if old:
            drop_table(spark, old)
        if turn < plan.rounds:
            n, s = _added(spark, path, k, plan)
            counts = [x + y for x, y in zip(counts, n)]
            sums = [[x + y for x, y in zip(xs, ys)] for xs, ys in zip(sums, s)]
            before, c = c, np.array([[v // m for v in vs] if m else list(old_c) for vs, m, old_c in zip(sums, counts, c.tolist())], np.int64)
    done = spark.read.schema(STATE).parquet(path).filter("kind = 0")
    return done.select("vec_id", F.col("a").alias("cluster"), "distance"), c


def clustered(rows: DataFrame, plan: ClusterPlan = ClusterPlan()) -> DataFrame:
    """Adds to ``cluster`` the distance summed over a vector's cluster and over all, and the digest of its centroid."""
    import hashlib

    spark = rows.sparkSession
    done, c = cluster(rows, plan)
    by = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    per = [(j, by.get(j, 0), sum(by.values()), hashlib.sha256(",".join(map(str, c[j].tolist())).encode()).hexdigest()) for j in range(len(c))]
    facts = local_frame(spark, per, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")  # one row a centroid
    return done.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(plan: ClusterPlan = ClusterPlan()) -> str:
    """The same rounds with all distances, one block of SQL a round."""
    parts = [f"""e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {plan.dims} AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0)""",
             f"""v AS MATERIALIZED (SELECT r, i, CAST(floor({plan.scale} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM e, unnest(range(1, {plan.dims + 1})) AS t(i))""",
             f"""c0 AS MATERIALIZED (SELECT s.j, i, x FROM v JOIN (SELECT r, row_number() OVER (ORDER BY sha256('{plan.seed}' || vec_id)) - 1 AS j
  FROM e QUALIFY j < {plan.clusters}) AS s USING (r))"""]
    for t in range(plan.rounds + 1):
        parts.append(f"""a{t} AS MATERIALIZED (SELECT r, j, d FROM (SELECT r, j, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS d
  FROM v JOIN c{t} AS c USING (i) GROUP BY r, j) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if t < plan.rounds:
            parts.append(f"""c{t + 1} AS MATERIALIZED (SELECT c.j, c.i, coalesce(m.x, c.x) AS x FROM c{t} AS c LEFT JOIN
  (SELECT j, i, CAST((s - ((s % n + n) % n)) // n AS BIGINT) AS x FROM (SELECT j, i, sum(x) AS s, count(*) AS n FROM v JOIN a{t} USING (r) GROUP BY j, i)) AS m
  USING (j, i))""")
    t = plan.rounds
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, p.digest AS centroid_sha256
FROM a{t} JOIN e USING (r) JOIN (SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS digest FROM c{t} GROUP BY j) AS p USING (j)"""
