"""Cross-validated search that goes on where it stopped: every finished fit is kept in the shared folder.

A fit is named by the training data, the fold and the setting, so that all queries of one data set share a search, and a
driver that was lost costs the fits under way. Every fit reads all training rows outside its fold. Rows that one task can hold are
broadcast as bin numbers, and a fit is a task; beyond, and for models that Spark fits, the rows lie in partitions over the cluster.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from campaignry.functions import kpi as k
from campaignry.operators.boosting import TASK_ROWS, bin_codes, cut_points
from campaignry.session import cut_lineage, local_frame, shared_dir

FITS = 3  # raised when fits of the same rows come out otherwise, so that those kept from before do not count
PART_ROWS = 25_000  # rows of a partition that Spark's own models go over in each round


class Kept:
    """Numbers by name. Each is an empty file that bears both, so that one listing reads them all."""

    def __init__(self, spark, folder: str):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.path = lambda name="": path(f"{folder}/{name}" if name else folder)
        self.fs = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.folder = folder
        self.fs.mkdirs(self.path())

    def all(self) -> dict[str, float]:
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path()) if s.isFile()]
        return {n.partition("=")[0]: float(n.partition("=")[2]) for n in names if "=" in n}

    def put(self, name: str, value: float) -> None:
        self.fs.create(self.path(f"{name}={value!r}"), True).close()


def short_hash(*parts) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


def data_print(rows: DataFrame) -> str:
    """Names the rows of a table, whatever their order."""
    seen = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
    return short_hash(sorted(rows.columns), *map(str, seen))


def bounded(rows: DataFrame, most: int, key: str = "interaction_id") -> DataFrame:
    """All rows, or the first ``most`` in the order of a hash of their key."""
    return rows.orderBy(k.stable_hash(F.lit("rows"), key), key).limit(most)


def auc(label: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve with half credit for ties; 0.5 where one class is missing."""
    order = np.argsort(score, kind="stable")
    _, inverse, counts = np.unique(score[order], return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    pos = label[order] == 1
    n, m = pos.sum(), (~pos).sum()
    return float((rank[pos].sum() - n * (n + 1) / 2) / (n * m)) if n and m else 0.5


def frame_auc(rows: DataFrame) -> float:
    """What ``auc`` gives of the columns label and score, without bringing the rows together: the curve has a point each distinct score."""
    rows = rows.persist()
    seen = {r[0] for r in rows.select("label").distinct().collect()}
    whole = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    value = float(whole.evaluate(rows)) if len(seen) == 2 else 0.5
    rows.unpersist()
    return value


def dealt(rows: DataFrame, n: int) -> DataFrame:
    """The rows in as many partitions as their number asks for, kept for the many rounds of a fit."""
    parts = math.ceil(n / PART_ROWS)
    return (rows.repartition(parts) if parts > 1 else rows.coalesce(1)).persist()


def with_weights(rows: DataFrame) -> DataFrame:
    """Label, balanced class weight and weight of the positives, by the classes of these rows."""
    n = {r["converted"]: r["n"] for r in rows.groupBy("converted").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, pos, neg = sum(n.values()), n.get(1, 0), n.get(0, 0)
    weight = F.when(F.col("converted") == 1, total / (2.0 * max(pos, 1))).otherwise(total / (2.0 * max(neg, 1)))
    scale = F.when(F.col("converted") == 1, round(neg / max(pos, 1), 2)).otherwise(1.0)
    return rows.withColumns({"label": F.col("converted").cast("double"), "weight": weight, "pos_weight": scale})


@dataclass
class Candidates:
    """The settings of one model; ``build`` makes its estimator from a setting and a number of rows.

    ``in_task``, if given, scores held rows inside one task from a setting and the arrays of inputs, labels, weights (the column
    ``weight``) and held inputs. ``spread``, if given, fits several settings at once on rows that no task can hold, from the rows,
    their number, the settings and the weight.
    """

    name: str
    settings: list[dict]
    build: Callable
    in_task: Callable | None = None
    weight: str = "pos_weight"
    spread: Callable | None = None


class FoldSearch:
    """Folds of the training rows, each prepared by a pipeline fitted on its own training part alone.

    All rows take part unless a caller gives ``max_rows``; the model queries do not. Beyond ``task_rows`` no task holds them all.
    """

    def __init__(self, train: DataFrame, preprocessor: Callable, folds: int, max_rows: int | None = None, task_rows: int = TASK_ROWS):
        self.spark, self.folds, self.preprocessor = train.sparkSession, folds, preprocessor
        self.rows = train if max_rows is None else cut_lineage(bounded(train, max_rows).coalesce(1))
        self.size = self.rows.count()
        self.small = self.size <= task_rows
        self.kept = Kept(self.spark, f"{shared_dir(self.spark).rstrip('/')}/search-{short_hash(data_print(self.rows), folds, FITS)}")
        self._parts: dict[int, tuple[DataFrame, DataFrame, int]] = {}

    def part(self, fold: int) -> tuple[DataFrame, DataFrame, int]:
        if fold not in self._parts:
            train, held = self.rows.filter(F.col("fold") != fold), self.rows.filter(F.col("fold") == fold)
            model = self.preprocessor(train)[0].fit(train)
            ready = dealt(with_weights(model.transform(train)).select("features", "label", "weight", "pos_weight"), self.size)
            test = dealt(model.transform(held).select("features", F.col("converted").cast("double").alias("label")), self.size // self.folds)
            self._parts[fold] = (ready, test, ready.count())
            test.count()
        return self._parts[fold]

    def score(self, c: Candidates, setting: dict, fold: int) -> float:
        ready, _, n = self.part(fold)
        return self.score_of(c.build(setting, n).fit(ready), fold)

    def score_of(self, model, fold: int) -> float:
        rows = model.transform(self.part(fold)[1]).select("label", vector_to_array("probability")[1].alias("score"))
        if not self.small:
            return frame_auc(rows)
        out = rows.toPandas()
        return auc(out["label"].to_numpy(), out["score"].to_numpy())

    def arrays(self, fold: int, weight: str = "pos_weight") -> tuple:
        """Inputs, labels and weights of a fold's training part, inputs and labels of its held part; at most ``task_rows`` rows."""
        ready, test, _ = self.part(fold)
        features = vector_to_array("features").alias("x")
        train, held = ready.select(features, "label", F.col(weight).alias("weight")).toPandas(), test.select(features, "label").toPandas()
        stacked = lambda rows: np.stack(rows["x"].to_numpy()) if len(rows) else np.zeros((0, 1))
        return (stacked(train), train["label"].to_numpy(), train["weight"].to_numpy(dtype=float), stacked(held), held["label"].to_numpy())

    def scores(self, c: Candidates, tasks: list[tuple[int, int]]) -> dict[tuple[int, int], float]:
        """AUC of each (setting, fold), one Spark task a fit. The folds, at most ``task_rows`` rows each, are broadcast.

        Trees depend on the order of the inputs alone, so bin numbers stand for them: one byte each.
        """
        def packed(fold):
            x, y, w, held, label = self.arrays(fold, c.weight)
            cuts = cut_points(x) if len(x) else None
            return (bin_codes(x, cuts).T, y, w, bin_codes(held, cuts).T, label) if len(x) and len(held) else (x, y, w, held, label)
        folds = self.spark.sparkContext.broadcast({fold: packed(fold) for fold in sorted({fold for _, fold in tasks})})
        settings, in_task = c.settings, c.in_task

        def fits(batches):
            for batch in batches:
                for i, fold in zip(batch["i"], batch["fold"]):
                    x, y, w, held, label = folds.value[fold]
                    value = auc(label, in_task(settings[i], x, y, w, held)) if len(label) else 0.5
                    yield pd.DataFrame({"i": [i], "fold": [fold], "auc": [value]})
        todo = local_frame(self.spark, tasks, "i int, fold int").repartition(len(tasks))
        found = todo.mapInPandas(fits, "i int, fold int, auc double").collect()
        folds.unpersist()
        return {(r["i"], r["fold"]): r["auc"] for r in found}

    def run(self, c: Candidates, parallelism: int | None = None) -> list[float]:
        """Mean AUC of each setting; fits that are kept from before are not done again."""
        name = lambda i, fold: f"{c.name}-{short_hash(c.settings[i])}-{fold}"
        have = self.kept.all()
        todo = [(i, fold) for i in range(len(c.settings)) for fold in range(self.folds) if name(i, fold) not in have]
        side_by_side = parallelism or self.spark.sparkContext.defaultParallelism
        if c.in_task and self.small:
            wave = 4 * side_by_side
            for at in range(0, len(todo), wave):  # a lost driver costs one wave
                for (i, fold), value in self.scores(c, todo[at:at + wave]).items():
                    self.kept.put(name(i, fold), value)
                    have[name(i, fold)] = value
            todo = []

        @inheritable_thread_target(self.spark)
        def one(task):
            i, fold = task
            value = self.score(c, c.settings[i], fold)
            self.kept.put(name(i, fold), value)
            return name(i, fold), value

        # Large folds are held one after the other, and a forest of all their rows takes the cluster for itself.
        needed = sorted({fold for _, fold in todo})
        for batch in [needed] if self.small else [[fold] for fold in needed]:
            for fold in batch:
                self.part(fold)
            mine = [task for task in todo if task[1] in batch]
            if mine and c.spread and not self.small:
                ready, _, n = self.part(batch[0])
                for (i, fold), model in zip(mine, c.spread(ready, n, [c.settings[i] for i, _ in mine], c.weight)):
                    have[name(i, fold)] = self.score_of(model, fold)
                    self.kept.put(name(i, fold), have[name(i, fold)])
            elif mine:
                pool = ThreadPool(min(side_by_side if self.small or not c.in_task else 1, len(mine)))
                try:
                    have |= dict(pool.imap_unordered(one, mine))
                finally:
                    pool.terminate()
            if not self.small:
                self.close()
        return [sum(have[name(i, fold)] for fold in range(self.folds)) / self.folds for i in range(len(c.settings))]

    def close(self) -> None:
        for ready, test, _ in self._parts.values():
            ready.unpersist()
            test.unpersist()
        self._parts.clear()

    def final(self, c: Candidates, setting: dict, rows: DataFrame, n: int, kind):
        """The model of a setting on all the rows given, from the folder if it has been fitted before."""
        name = f"{c.name}-{short_hash(setting, n)}-model"
        path = f"{self.kept.folder}/{name}"
        if f"{name}-done" not in self.kept.all():
            c.build(setting, n).fit(rows).write().overwrite().save(path)
            self.kept.put(f"{name}-done", 1.0)
        return kind.load(path)
