"""K-Means customer clusters on the standardised features, with projection, silhouettes and profiles."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from campaignry.functions import kpi as k
from campaignry.operators.features import SCALE_COLUMNS, build_feature_matrix, scale_features
from campaignry.operators.rfm import LABELS, rfm_labels
from campaignry.session import cut_lineage, local_frame
from campaignry.tables import Tables

# Names by cluster number and the profiled metrics.
CLUSTER_NAMES = ["Mass-Market Browsers", "Affluent Engagers", "Premier Multi-Product", "Dormant Low-Value",
                 "High-Value Home Buyers"]
PROFILE = ["annual_income", "credit_score", "age", "tenure_days", "recency_days", "freq_12m", "total_revenue",
           "n_active_products", "n_product_categories", "response_rate", "cross_sell_score"]

BLOCK = 2_048  # rows of a matrix


def vectors(t: Tables) -> DataFrame:
    """Scaled features beside their vector, cut once: K-Means passes over them many times."""
    if "vectors" not in t._memo:
        rows = VectorAssembler(inputCols=SCALE_COLUMNS, outputCol="features").transform(scale_features(t))
        t._memo["vectors"] = cut_lineage(rows)
    return t._memo["vectors"]


@dataclass
class Centres:
    """The centres of one start, in Spark's numbering, and the cost of the rows at the centres of the last round."""

    points: np.ndarray  # clusters x features
    cost: float = 0.0

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.points)

    def transform(self, rows: DataFrame, label: str = "prediction") -> DataFrame:
        """The nearest centre by squared distance; the smaller number of equal ones."""
        away = lambda c: reduce(lambda a, b: a + b, [
            (F.col(n) - F.lit(float(v))) * (F.col(n) - F.lit(float(v))) for n, v in zip(SCALE_COLUMNS, c)])
        near = F.array_min(F.array(*[F.struct(away(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(self.points)]))
        return rows.withColumn(label, near["i"])


def blocks(t: Tables) -> DataFrame:
    """The scaled features as matrices of at most BLOCK rows, cut once: a round of K-Means multiplies them as they are.

    They are dealt over all cores, since a round is arithmetic, not bytes.
    """
    if "blocks" not in t._memo:
        def packed(batches):
            for batch in batches:
                x = batch.to_numpy(dtype=float)
                yield pd.DataFrame({"block": [x[i:i + BLOCK].tobytes() for i in range(0, len(x), BLOCK)]})
        made = vectors(t).select(*SCALE_COLUMNS).mapInPandas(packed, "block binary")
        t._memo["blocks"] = cut_lineage(made.repartition(t.spark.sparkContext.defaultParallelism))
    return t._memo["blocks"]


def nearest(x: np.ndarray, centres: np.ndarray, starts: list[int]) -> np.ndarray:
    """Sums, counts and cost of one block for the stacked centres of several starts.

    Columns: the features, the count, and in the first row of each start its cost.
    """
    away = (centres ** 2).sum(axis=1) - 2 * (x @ centres.T)
    norm = (x ** 2).sum(axis=1)
    mine, cost = np.zeros(away.shape), np.zeros(len(centres))
    for lo, hi in zip(starts[:-1], starts[1:]):
        part = away[:, lo:hi]
        best = part.argmin(axis=1)
        mine[np.arange(len(x)), lo + best] = 1.0
        cost[lo] = np.maximum(part[np.arange(len(x)), best] + norm, 0.0).sum()
    return np.column_stack([mine.T @ x, mine.sum(axis=0), cost])


def one_round(rows: DataFrame, centres: list[np.ndarray]) -> list[np.ndarray]:
    """One pass over the blocks for all starts: a table of sums, counts and cost per start."""
    width, starts = len(SCALE_COLUMNS), np.cumsum([0, *map(len, centres)]).tolist()
    stacked = np.concatenate(centres)

    def passed(batches):
        total = np.zeros((len(stacked), width + 2))
        for batch in batches:
            for block in batch["block"]:
                total += nearest(np.frombuffer(block).reshape(-1, width), stacked, starts)
        yield pd.DataFrame({"sums": [total.tobytes()]})
    # One row per task, in a fixed order so that reruns add them up alike.
    parts = rows.mapInPandas(passed, "sums binary").collect()
    total = sum(np.frombuffer(p["sums"]).reshape(-1, width + 2) for p in sorted(parts, key=lambda r: bytes(r["sums"])))
    return [total[lo:hi] for lo, hi in zip(starts[:-1], starts[1:])]


def best_fits(t: Tables, ks, seed: int, n_init: int, max_iter: int, tol: float = 1e-4) -> dict[int, Centres]:
    """The cheapest of several seeded starts per K.

    Spark draws the starts (k-means||). All starts of all K then move together: one pass over the rows a round, and a start
    leaves when, by Spark's rule, no centre has moved by more than ``tol``.
    """
    kept = vectors(t).select("features").persist()
    features = kept.select("features")  # a plan of its own, so that each fit keeps its decoded vectors for its passes
    tasks = [(n, seed + i) for n in ks for i in range(n_init)]
    start = inheritable_thread_target(t.spark)(
        lambda task: np.array(KMeans(k=task[0], seed=task[1], maxIter=0).fit(features).clusterCenters()))
    with ThreadPool(min(len(tasks), 4)) as pool:  # each holds the vectors once
        fits = [Centres(points) for points in pool.map(start, tasks)]
    kept.unpersist()
    rows = blocks(t).persist()
    moving = list(range(len(fits)))
    for _ in range(max_iter):
        found = one_round(rows, [fits[i].points for i in moving])
        still = []
        for i, table in zip(moving, found):
            old, count = fits[i].points, table[:, -2:-1]
            new = np.where(count > 0, table[:, :-2] / np.maximum(count, 1), old)  # a centre without rows stays
            fits[i] = Centres(new, float(table[0, -1]))
            if (((new - old) ** 2).sum(axis=1) > tol * tol).any():
                still.append(i)
        moving = still
        if not moving:
            break
    rows.unpersist()
    return {n: min((f for f, (k_, _) in zip(fits, tasks) if k_ == n), key=lambda f: f.cost) for n in ks}


def kmeans_scan(t: Tables, ks=range(2, 11), seed: int = 42, n_init: int = 10, max_iter: int = 300) -> DataFrame:
    """Inertia and silhouette per K. The silhouette is linear in the rows, so all rows are used."""
    fits = best_fits(t, list(ks), seed, n_init, max_iter)
    rows, judge = vectors(t).persist(), ClusteringEvaluator()
    out = [(n, fits[n].cost, float(judge.evaluate(fits[n].transform(rows)))) for n in ks]
    rows.unpersist()
    return local_frame(t.spark, out, "k int, inertia double, silhouette double")


def fitted(t: Tables, clusters: int = 5, seed: int = 42, n_init: int = 20, max_iter: int = 500) -> Centres:
    key = ("kmeans", clusters, seed, n_init, max_iter)
    if key not in t._memo:
        t._memo[key] = best_fits(t, [clusters], seed, n_init, max_iter)[clusters]
    return t._memo[key]


def labelled(t: Tables) -> DataFrame:
    return fitted(t).transform(vectors(t), "cluster")


def kmeans_fit(t: Tables) -> DataFrame:
    """Cluster sizes and shares with the overall silhouette."""
    rows = labelled(t)
    quality = ClusteringEvaluator(predictionCol="cluster").evaluate(rows)
    sizes = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers"))
    total = F.sum("customers").over(Window.partitionBy())  # one row per cluster
    return sizes.select("cluster", "customers", k.share("customers", total).alias("pct"), F.lit(quality).alias("silhouette"))


def _pca(t: Tables):
    if "pca" not in t._memo:
        t._memo["pca"] = PCA(k=2, inputCol="features", outputCol="pc").fit(vectors(t))
    return t._memo["pca"]


def pca_project(t: Tables) -> DataFrame:
    """Two principal components per customer; the inputs are already centred."""
    model = _pca(t)
    xy = vector_to_array("pc")
    ratio = model.explainedVariance.toArray()
    return model.transform(labelled(t)).select(
        "customer_id", "cluster", xy[0].alias("pc1"), xy[1].alias("pc2"),
        F.lit(float(ratio[0]) * 100).alias("pc1_variance_pct"), F.lit(float(ratio[1]) * 100).alias("pc2_variance_pct"))


def pca_loadings(t: Tables, top: int = 5) -> DataFrame:
    """The strongest features per component by absolute loading."""
    weights = abs(_pca(t).pc.toArray())
    rows = [(f"PC{c + 1}", SCALE_COLUMNS[i], float(weights[i][c])) for i in range(len(SCALE_COLUMNS)) for c in range(2)]
    frame = local_frame(t.spark, rows, "component string, feature string, loading double")
    order = Window.partitionBy("component").orderBy(F.desc("loading"), "feature")  # one row per feature
    return frame.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)


def pca_centroids(t: Tables) -> DataFrame:
    centres = fitted(t).clusterCenters()
    axes = _pca(t).pc.toArray()
    rows = [(i, float(c @ axes[:, 0]), float(c @ axes[:, 1])) for i, c in enumerate(centres)]
    return local_frame(t.spark, rows, "cluster int, pc1 double, pc2 double")


def silhouette_points(t: Tables) -> DataFrame:
    """Silhouette per customer on squared Euclidean distance.

    The mean distance of a point to a cluster follows from the cluster's size, vector sum and sum
    of squared norms, so no pair of customers is ever formed.
    """
    rows = labelled(t)
    norm = reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in SCALE_COLUMNS])
    # One row per cluster.
    stats = rows.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(norm).alias("q"), *[F.sum(c).alias(c) for c in SCALE_COLUMNS]).collect()

    def mean_distance(s):
        dot = reduce(lambda a, b: a + b, [F.col(c) * F.lit(s[c] / s["n"]) for c in SCALE_COLUMNS])
        return norm + F.lit(s["q"] / s["n"]) - 2 * dot

    own = reduce(lambda a, s: a.when(F.col("cluster") == s["cluster"], mean_distance(s) * F.lit(s["n"] / max(s["n"] - 1, 1))),
                 stats[1:], F.when(F.col("cluster") == stats[0]["cluster"], mean_distance(stats[0]) * F.lit(
                     stats[0]["n"] / max(stats[0]["n"] - 1, 1))))
    other = F.least(*[F.when(F.col("cluster") != s["cluster"], mean_distance(s)) for s in stats]) if len(stats) > 1 else F.lit(None)
    alone = reduce(lambda a, s: a | ((F.col("cluster") == s["cluster"]) & F.lit(s["n"] == 1)), stats, F.lit(False))
    scored = rows.select("customer_id", "cluster", own.alias("a"), other.alias("b"), alone.alias("alone"))
    return scored.select("customer_id", "cluster", F.when(F.col("alone"), 0.0).otherwise(
        (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))).alias("silhouette"))


def _assigned(t: Tables) -> DataFrame:
    return build_feature_matrix(t).join(labelled(t).select("customer_id", "cluster"), "customer_id")


def cluster_profile(t: Tables) -> DataFrame:
    """Mean of each metric per cluster, with the overall mean as cluster NULL."""
    return _assigned(t).rollup("cluster").agg(*[F.round(F.avg(F.col(c).cast("double")), 1).alias(c) for c in PROFILE])


def cluster_rfm_crosstab(t: Tables) -> DataFrame:
    """Label shares within each cluster and the dominant label."""
    rows = labelled(t).select("customer_id", "cluster").join(rfm_labels(t).select("customer_id", "rfm_segment"), "customer_id")
    counts = rows.groupBy("cluster", "rfm_segment").agg(F.count(F.lit(1)).alias("n"))
    pct = counts.withColumn("pct", k.share("n", F.sum("n").over(Window.partitionBy("cluster"))))  # nine rows each
    wide = pct.groupBy("cluster").pivot("rfm_segment", LABELS).agg(F.max("pct")).fillna(0.0)
    name = lambda s: s.lower().replace("'", "").replace(" ", "_").replace("-", "_")
    wide = wide.select("cluster", *[F.col(f"`{s}`").alias(name(s)) for s in LABELS])
    best = pct.groupBy("cluster").agg(F.max_by("rfm_segment", F.struct("n", "rfm_segment")).alias("dominant_label"),
                                      F.max("pct").alias("dominant_pct"))
    return wide.join(best, "cluster")


def cluster_assign(t: Tables) -> DataFrame:
    names = F.create_map(*[F.lit(x) for i, n in enumerate(CLUSTER_NAMES) for x in (i, n)])
    return _assigned(t).join(rfm_labels(t).select("customer_id", "rfm_segment"), "customer_id").select(
        "customer_id", "cluster", "customer_segment", "annual_income", "credit_score", "age", "tenure_days", "recency_days",
        "freq_12m", "total_revenue", "n_active_products", "response_rate", names[F.col("cluster")].alias("cluster_name"), "rfm_segment")


def cluster_summary(t: Tables) -> DataFrame:
    mean = lambda c: F.round(F.avg(F.col(c).cast("double")), 0)
    return cluster_assign(t).groupBy("cluster", "cluster_name").agg(
        F.count("customer_id").alias("customers"), mean("annual_income").alias("avg_income"), mean("credit_score").alias("avg_credit"),
        mean("total_revenue").alias("avg_revenue"), mean("n_active_products").alias("avg_products"),
        F.round(F.round(F.sum("total_revenue"), 0) / 1_000_000, 2).alias("total_revenue_m"))
