"""Boosted trees over all labelled rows: one task a fit, or one fit spread over the tasks of a barrier stage.

Spark's own boosting runs a chain of small jobs for every level of every tree, which no cluster shortens. Here each input is cut
into quantile bins once, and each tree grows level by level from histograms of first and second derivatives of the logistic loss.
Up to TASK_ROWS rows a task holds all rows of its fit, so that a search is one Spark job of many fits. Beyond, every task holds
its share of the rows as bin numbers, and the tasks add up their histograms; all of them grow the same trees. An exchange between
the tasks of a stage takes Spark a second, so many fits go through one exchange. Scoring is a pandas UDF over all rows.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Generator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignry.plans.ordering import SortedRuns
from campaignry.session import local_frame

BINS = 64
TASK_ROWS = 250_000  # a fit of more rows is spread over tasks; the result covers all rows either way
SENT = 32 << 20  # bytes of one exchange between the tasks of a fit
HELD, STATE = 512 << 20, 48  # bytes that the fits under way in a task hold, and that one of them holds a row
SHRINK = 1.0  # added to the second derivatives of a leaf
NODES = "tree int, node int, feature int, threshold double, value double, gain double"


def sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))


def cut_points(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """At most bins - 1 ascending cuts per column; a value belongs to the first cut that is not below it."""
    asked = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(col, asked, method="lower")) for col in x.T]


@dataclass
class Trees:
    """Complete binary trees: node i has children 2 i + 1 and 2 i + 2; a feature of -1 marks a leaf."""

    feature: np.ndarray  # trees x nodes
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > threshold[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            out += value[node]
        return out


def bin_codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin numbers by column."""
    return np.stack([np.searchsorted(c, col, side="left").astype(np.uint8) for c, col in zip(cuts, x.T)])


class Inputs:
    """Bin numbers by column, and the histograms of their nodes.

    Inputs of two bins whose upper bins never meet in a row, such as the codes of one category, are counted in one pass over a
    column that names the one that holds.
    """

    def __init__(self, codes: np.ndarray, total: Callable):
        self.codes = codes
        wide = total(np.count_nonzero(codes > 1, axis=1).astype(float)) > 0
        self.wide, self.narrow = np.flatnonzero(wide), np.flatnonzero(~wide)
        ones = codes[self.narrow].astype(np.float32) if len(self.narrow) else np.zeros((0, codes.shape[1]), dtype=np.float32)
        together = np.zeros((len(ones), len(ones)))
        for at in range(0, codes.shape[1], 1 << 20):  # the counts of a block are whole in single precision
            together += ones[:, at:at + (1 << 20)] @ ones[:, at:at + (1 << 20)].T
        together = total(together)
        self.bundles: list[list[int]] = []  # positions in narrow
        for i in range(len(ones)):
            home = next((b for b in self.bundles if len(b) < 255 and not together[i, b].any()), None)
            home.append(i) if home else self.bundles.append([i])
        self.named = np.zeros((len(self.bundles), codes.shape[1]), dtype=np.uint8)
        for named, bundle in zip(self.named, self.bundles):
            for at, i in enumerate(bundle):
                named[codes[self.narrow[i]] == 1] = at + 1

    def histograms(self, rows, node, many: int, g, h, asked) -> np.ndarray:
        """Sums of both derivatives by node and cell: BINS cells for each asked wide input, then the upper bin of each asked narrow one."""
        wide, narrow = self.wide[asked[self.wide]], asked[self.narrow]
        out = np.zeros((2, many, len(wide) * BINS + int(narrow.sum())))
        key, base = np.empty(len(rows), dtype=np.int64), node * BINS
        for i, f in enumerate(wide):
            np.add(base, self.codes[f].take(rows), out=key)
            for d, v in enumerate((g, h)):
                out[d, :, i * BINS:(i + 1) * BINS] = np.bincount(key, v, many * BINS).reshape(many, BINS)
        place = len(wide) * BINS + np.cumsum(narrow) - 1
        for named, bundle in zip(self.named, self.bundles):
            mine = [(at, i) for at, i in enumerate(bundle, 1) if narrow[i]]
            if mine:
                size = len(bundle) + 1
                np.add(node * size, named.take(rows), out=key)
                for d, v in enumerate((g, h)):
                    sums = np.bincount(key, v, many * size).reshape(many, size)
                    for at, i in mine:
                        out[d, :, place[i]] = sums[:, at]
        return out

    def left_sums(self, cells: np.ndarray, sums: np.ndarray, asked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums at or below each cut of each asked input, and the input and last bin on the left of every cut."""
        wide, narrow = self.wide[asked[self.wide]], self.narrow[asked[self.narrow]]
        edge = len(wide) * BINS
        steps = np.cumsum(cells[:, :, :edge].reshape(*cells.shape[:2], len(wide), BINS), axis=3).reshape(*cells.shape[:2], edge)
        left = np.concatenate([steps, sums[:, :, None] - cells[:, :, edge:]], axis=2)
        return left, np.concatenate([np.repeat(wide, BINS), narrow]), np.concatenate([np.tile(np.arange(BINS), len(wide)), np.zeros(len(narrow), dtype=np.int64)])


def alone(sums: np.ndarray) -> np.ndarray:
    """The totals of a fit that no other task shares."""
    return sums


def grown(fits: list[Generator], total: Callable = alone) -> list[Trees]:
    """The trees of fits that go on in step: what they ask to be added up goes through one exchange."""
    out, given = {}, dict.fromkeys(range(len(fits)))
    while given:
        asked = {}
        for i, sums in given.items():
            try:
                asked[i] = fits[i].send(sums)
            except StopIteration as ended:
                out[i] = ended.value
        flat = total(np.concatenate([a.ravel() for a in asked.values()])) if asked else None
        ends = np.cumsum([a.size for a in asked.values()])
        given = {i: flat[end - a.size:end].reshape(a.shape) for (i, a), end in zip(asked.items(), ends)}
    return [out[i] for i in range(len(fits))]


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, setting: dict, seed: int = 42) -> Trees:
    """Fits all rounds of one setting. Without rows, or with one class only, every tree is one leaf."""
    cuts = cut_points(x) if len(x) else [np.zeros(0)] * x.shape[1]
    return grown([growth(Inputs(bin_codes(x, cuts), alone), cuts, y, w, setting, seed)])[0]


def growth(inputs: Inputs, cuts: list[np.ndarray], y: np.ndarray, w: np.ndarray, setting: dict, seed: int = 42, part: int | None = None) -> Generator:
    """The trees of rows given by their bins. It yields sums over its rows and is sent those over all rows.

    With a part number the rows are one part of all, which draws its own share of them; all parts draw the same columns.
    """
    width, n = inputs.codes.shape
    depth, rounds = setting["max_depth"], setting["n_estimators"]
    size = 2 ** (depth + 1) - 1
    out = Trees(np.full((rounds, size), -1, dtype=np.int32), np.zeros((rounds, size)), np.zeros((rounds, size)), np.zeros((rounds, size)))
    rows_in_all, positives = yield np.array([n, float((y > 0).sum())])
    if not rows_in_all or positives in (0, rows_in_all):
        return out
    rng = np.random.default_rng(seed)
    own = rng if part is None else np.random.default_rng([seed, part])
    drawn, used = int(round(n * setting["subsample"])), max(1, int(round(width * setting["colsample_bytree"])))
    drawn = max(1, drawn) if part is None else drawn
    least = max(setting["min_child_weight"], 1e-9)
    margin, flat = np.zeros(n), inputs.codes.reshape(-1)
    for t in range(rounds):
        p = sigmoid(margin)
        g, h = (p - y) * w, p * (1 - p) * w
        rows = np.sort(own.choice(n, drawn, replace=False)) if drawn < n else np.arange(n)
        asked = np.zeros(width, dtype=bool)
        asked[rng.choice(width, used, replace=False) if used < width else slice(None)] = True
        g, h = g[rows], h[rows]
        # Open nodes of a level, by their number in the tree; where each of all rows and each drawn row in an open node is.
        opened, node, at = np.zeros(1, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        first = yield np.concatenate([inputs.histograms(rows, at, 1, g, h, asked), np.array([[[g.sum()]], [[h.sum()]]])], axis=2)
        cells, sums = first[:, :, :-1], first[:, :, -1]
        weigh = lambda now, s: out.value.__setitem__((t, now), -setting["learning_rate"] * s[0] / (s[1] + SHRINK))
        weigh(opened, sums)
        for level in range(depth):
            left, feature, last = inputs.left_sums(cells, sums, asked)
            (gl, hl), (ga, ha) = left, sums[:, :, None]
            gr, hr = ga - gl, ha - hl
            gains = 0.5 * (gl ** 2 / (hl + SHRINK) + gr ** 2 / (hr + SHRINK) - ga ** 2 / (ha + SHRINK)) - setting["gamma"]
            gains[(hl < least) | (hr < least)] = -np.inf
            best = gains.argmax(axis=1)
            top = gains[np.arange(len(opened)), best]
            split = np.flatnonzero(top > 1e-9)
            if not len(split):
                break
            now, best = opened[split], best[split]
            f, b = feature[best], last[best]
            out.feature[t, now], out.gain[t, now] = f, top[split]
            out.threshold[t, now] = [cuts[i][j] for i, j in zip(f, b)]
            # All rows of a split node move on; the others stay in their leaf.
            order = np.full(size, -1)
            order[now] = np.arange(len(now))
            which = order[node]
            moves = np.flatnonzero(which >= 0)
            which = which[moves]
            node[moves] = 2 * node[moves] + 1 + (flat.take(f[which] * n + moves) > b[which])
            pair = np.stack([left[:, split, best], sums[:, split] - left[:, split, best]], axis=2)  # derivative, node, side
            opened, sums = np.stack([2 * now + 1, 2 * now + 2], axis=1).ravel(), pair.reshape(2, -1)
            weigh(opened, sums)
            if level + 1 == depth:
                break
            # Rows of the lighter child are counted, the other child is what is left of its parent.
            light = (pair[1, :, 1] < pair[1, :, 0]).astype(np.int64)
            order = np.full(size, -1)
            order[opened] = np.arange(len(opened))
            at = order[node[rows]]
            counted = np.flatnonzero(at >= 0)
            rows, g, h, at = rows[counted], g[counted], h[counted], at[counted]
            mine = np.flatnonzero(at % 2 == light[at // 2])
            few = yield inputs.histograms(rows[mine], at[mine] // 2, len(now), g[mine], h[mine], asked)
            whole, cells = cells[:, split], np.empty((2, len(opened), cells.shape[2]))
            cells[:, 2 * np.arange(len(now)) + light], cells[:, 2 * np.arange(len(now)) + 1 - light] = few, whole - few
        margin += out.value[t][node]
    return out


def held_scores(setting: dict, x: np.ndarray, y: np.ndarray, w: np.ndarray, held: np.ndarray) -> np.ndarray:
    return sigmoid(grow(x, y, w, setting).margin(held))


class BoostedTreesModel:
    """Fitted trees with the columns and the storage of a Spark classifier."""

    def __init__(self, trees: Trees, width: int):
        self.trees, self.width = trees, width

    @property
    def featureImportances(self):
        """Gain by input, in shares."""
        inner = self.trees.feature >= 0
        total = np.bincount(self.trees.feature[inner], self.trees.gain[inner], self.width)
        return Vectors.dense(total / (total.sum() or 1.0))

    def transform(self, rows: DataFrame) -> DataFrame:
        trees = self.trees

        @F.pandas_udf("double")
        def chance(features: pd.Series) -> pd.Series:
            return pd.Series(sigmoid(trees.margin(np.stack(features.to_numpy()))) if len(features) else [], dtype="float64")
        out = rows.withColumn("probability", chance(vector_to_array("features")))
        return out.withColumns({"prediction": (F.col("probability") > 0.5).cast("double"),
                                "probability": array_to_vector(F.array(1 - F.col("probability"), "probability"))})

    def write(self) -> MLWriter:
        return _Writer(self)

    @staticmethod
    def load(path: str) -> BoostedTreesModel:
        nodes = SparkSession.getActiveSession().read.parquet(path).toPandas()  # rounds x nodes, bounded by the setting
        return _model(nodes)


def _nodes(trees: Trees, width: int) -> pd.DataFrame:
    """One row a node, and one of tree -1 that holds the number of inputs."""
    rounds, size = trees.feature.shape
    rows = pd.DataFrame({"tree": np.repeat(np.arange(rounds), size), "node": np.tile(np.arange(size), rounds), "feature": trees.feature.ravel(),
                         "threshold": trees.threshold.ravel(), "value": trees.value.ravel(), "gain": trees.gain.ravel()})
    return pd.concat([rows, pd.DataFrame([{"tree": -1, "node": 0, "feature": width, "threshold": 0.0, "value": 0.0, "gain": 0.0}])])


def _model(nodes: pd.DataFrame) -> BoostedTreesModel:
    width = int(nodes.loc[nodes["tree"] < 0, "feature"].iloc[0])
    nodes = nodes[nodes["tree"] >= 0].sort_values(["tree", "node"])
    shape = (nodes["tree"].nunique(), nodes["node"].nunique())
    return BoostedTreesModel(Trees(*[nodes[c].to_numpy().reshape(shape) for c in ("feature", "threshold", "value", "gain")]), width)


class _Writer(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        rows = _nodes(self.model.trees, self.model.width)
        local_frame(self.sparkSession, list(rows.itertuples(index=False, name=None)), NODES).coalesce(1).write.parquet(path)


def exact_cuts(rows: DataFrame, column: str, n: int, bins: int = BINS) -> list[np.ndarray]:
    """The cut points of an array column of all rows, as ``cut_points`` finds them, from one row a distinct value."""
    ranks = sorted({math.floor(q * (n - 1)) for q in np.linspace(0, 1, bins + 1)[1:-1]})
    counts = rows.select(F.posexplode(column).alias("input", "value")).groupBy("input", "value").agg(F.count(F.lit(1)).alias("n"))
    with SortedRuns(counts.select(F.col("input").alias("grp"), F.col("value").alias("val"), "n"), weight="n") as runs:
        found = runs.pick({g: [r + 1 for r in ranks] for g in runs.runs})
        return [np.unique([v for (g, _), (v, _) in found.items() if g == f]) for f in sorted(runs.runs)]


def summed(parts: BarrierTaskContext, sums: np.ndarray) -> np.ndarray:
    """The sums of all tasks, added in the order of the tasks, so that all get the same bits."""
    flat = np.ascontiguousarray(sums, dtype=np.float64).ravel()
    out, step = np.zeros(len(flat)), max(1, SENT // 8 // len(parts.getTaskInfos()))
    for at in range(0, len(flat), step):
        for text in parts.allGather(base64.b64encode(flat[at:at + step].tobytes()).decode()):
            out[at:at + step] += np.frombuffer(base64.b64decode(text))
    return out.reshape(sums.shape)


class BoostedTreesClassifier:
    """An estimator over features, label and a weight. One task holds up to ``task_rows`` rows, more are spread over all tasks."""

    def __init__(self, setting: dict, weight: str = "pos_weight", task_rows: int = TASK_ROWS):
        self.setting, self.weight, self.task_rows = setting, weight, task_rows

    def fit(self, rows: DataFrame) -> BoostedTreesModel:
        n = rows.count()
        return self._in_task(_plain(rows, self.weight)) if n <= self.task_rows else fit_spread(rows, n, [self.setting], self.weight)[0]

    def _in_task(self, plain: DataFrame) -> BoostedTreesModel:
        setting = self.setting

        def fitted(batches):
            got = pd.concat([b for b in batches if len(b)], ignore_index=True)
            x = np.stack(got["x"].to_numpy())
            yield _nodes(grow(x, got["y"].to_numpy(), got["w"].to_numpy(), setting), x.shape[1])
        return _model(plain.coalesce(1).mapInPandas(fitted, NODES).toPandas())


def _plain(rows: DataFrame, weight: str) -> DataFrame:
    return rows.select(vector_to_array("features").alias("x"), F.col("label").alias("y"), F.col(weight).cast("double").alias("w"))


def fit_spread(rows: DataFrame, n: int, settings: list[dict], weight: str = "pos_weight") -> list[BoostedTreesModel]:
    """The models of all settings, each over all n rows, which are spread over the tasks of a barrier stage.

    As many fits go on in step as a task can hold; fits of like length keep each other company.
    """
    plain = _plain(rows, weight)
    cuts = exact_cuts(plain, "x", n)
    tasks = plain.sparkSession.sparkContext.defaultParallelism
    order = sorted(range(len(settings)), key=lambda i: settings[i]["n_estimators"] * settings[i]["max_depth"])
    step, out = max(1, HELD // (STATE * math.ceil(n / tasks))), {}
    for at in range(0, len(order), step):
        mine = order[at:at + step]

        def fitted(batches, asked=tuple(settings[i] for i in mine)):
            context = BarrierTaskContext.get()
            held = [(bin_codes(np.stack(b["x"].to_numpy()), cuts), b["y"].to_numpy(), b["w"].to_numpy()) for b in batches if len(b)]
            held.append((np.zeros((len(cuts), 0), dtype=np.uint8), np.zeros(0), np.zeros(0)))
            codes, y, w = [np.concatenate(v, axis=-1) for v in zip(*held)]
            del held
            total = lambda sums: summed(context, sums)
            inputs = Inputs(codes, total)
            trees = grown([growth(inputs, cuts, y, w, setting, part=context.partitionId()) for setting in asked], total)
            if context.partitionId() == 0:
                for i, one in enumerate(trees):
                    yield _nodes(one, len(cuts)).assign(fit=i)
        nodes = plain.repartition(tasks).mapInPandas(fitted, f"{NODES}, fit int", barrier=True).toPandas()
        out |= {i: _model(nodes[nodes["fit"] == k]) for k, i in enumerate(mine)}
    return [out[i] for i in range(len(settings))]
