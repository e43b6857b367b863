"""Quality rules: counts of each whole text, and a calibrated logistic regression on hashed n-grams.

The classifier learns from labelled rows: hashed word unigrams and bigrams and character trigrams, as shares of the
text. Training takes at most ``max_rows`` labelled documents, drawn by a hash of the id, of which a fifth is held out
to calibrate the probabilities. All documents are scored in Arrow batches against a fixed threshold; the model that
each task receives has a fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from campaignry.llm.batches import Texts, list_array, span_ids, text_runs, value_ids
from campaignry.session import scratch_path

_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_pct: int = 50
    threshold: float = 0.5  # least calibrated probability of good quality
    max_rows: int = 6000  # labelled documents the classifier learns from
    bits: int = 15  # hash buckets of words and of characters, as a power of two
    iterations: int = 60
    penalty: float = 1e-6


@dataclass(frozen=True)
class Model:
    word: np.ndarray  # weight of each word bucket
    char: np.ndarray
    bias: float
    slope: float  # calibration: probability = 1 / (1 + exp(-(slope * margin + shift)))
    shift: float


def text_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of every text of a run; equality of words and lines is that of their bytes."""
    words, data, bounds, n = texts.words(), texts.data, texts.bounds, texts.n
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    chars = np.bincount(words.doc, weights=points[words.ends] - points[words.starts], minlength=n)

    breaks = np.flatnonzero(data == 10)
    ends = np.concatenate((bounds[1:], breaks))
    after = np.concatenate((bounds[1:], breaks + 1))
    order = np.argsort(ends, kind="stable")  # at one place, the end of a text comes before a break that opens the next
    ends, starts = ends[order], np.concatenate(([0], after[order][:-1]))
    filled = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[filled], ends[filled]
    line_doc = np.searchsorted(bounds, starts, side="right") - 1
    lines = span_ids(data, starts, ends)
    distinct = np.unique(line_doc * (len(lines) + 1) + lines)
    dup = np.bincount(line_doc, minlength=n) - np.bincount(distinct // (len(lines) + 1), minlength=n)

    ids = words.ids()
    covered = np.zeros(words.n, bool)
    at = np.flatnonzero(words.doc[:-2] == words.doc[2:]) if words.n > 2 else np.zeros(0, np.int64)
    if len(at):
        many = int(ids.max()) + 1
        window = value_ids(value_ids(ids[at] * many + ids[at + 1]) * many + ids[at + 2])
        window = value_ids(words.doc[at] * (int(window.max()) + 1) + window)
        again = at[np.bincount(window)[window] > 1]
        for shift in range(3):
            covered[again + shift] = True
    repeated = np.bincount(words.doc, weights=covered, minlength=n)
    out = [words.counts, chars, symbols[bounds[1:]] - symbols[bounds[:-1]], dup, repeated]
    return dict(zip(COUNTS, (x.astype(np.int64) for x in out)))


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def gram_buckets(texts: Texts, bits: int):
    """(bucket, text) of every word unigram and bigram, and of every character trigram."""
    words = texts.words()
    h = words.hashes()
    pair = np.flatnonzero(words.doc[:-1] == words.doc[1:]) if words.n > 1 else np.zeros(0, np.int64)
    both = np.concatenate((h, h[pair] * np.uint64(3) + h[pair + 1] * np.uint64(5) if len(pair) else h[:0]))
    word = _bucket(both, bits), np.concatenate((words.doc, words.doc[pair]))
    points = np.frombuffer(texts.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))[texts.bounds]
    doc = np.repeat(np.arange(texts.n), np.diff(starts))
    c = np.flatnonzero(doc[:-2] == doc[2:]) if len(doc) > 2 else np.zeros(0, np.int64)
    tri = points[c] * np.uint64(0xD6E8FEB86659FD93) ^ points[c + 1] * np.uint64(0xA0761D6478BD642F) ^ points[c + 2] * np.uint64(0xE7037ED1A0B428DB) if len(c) else points[:0]
    return word, (_bucket(tri, bits), doc[c])


def margins(texts: Texts, model: Model) -> np.ndarray:
    bits = int(len(model.word)).bit_length() - 1
    total = np.full(texts.n, model.bias)
    for (bucket, doc), weight in zip(gram_buckets(texts, bits), (model.word, model.char)):
        count = np.maximum(np.bincount(doc, minlength=texts.n), 1)
        total += np.bincount(doc, weights=weight[bucket], minlength=texts.n) / count
    return total


def _features(bits: int):
    """Each text's sparse vector, in the stored form of one: shares of its word grams, then of its character grams."""
    def run(batches):
        for batch in batches:
            index, value, sizes = [], [], []
            for texts in text_runs(batch.column("text")):
                parts = []
                for k, (bucket, doc) in enumerate(gram_buckets(texts, bits)):
                    cell, count = np.unique(doc << (bits + 1) | k << bits | bucket, return_counts=True)
                    total = np.maximum(np.bincount(doc, minlength=texts.n), 1)
                    parts.append((cell, count / total[cell >> (bits + 1)]))
                cell, share = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(cell)
                cell, share = cell[order], share[order]
                index.append(cell & ((2 << bits) - 1))
                value.append(share)
                sizes.append(np.bincount(cell >> (bits + 1), minlength=texts.n))
            sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            index = np.concatenate(index) if index else np.zeros(0, np.int64)
            value = np.concatenate(value) if value else np.zeros(0)
            n = len(batch)
            vector = pa.StructArray.from_arrays(
                [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, 2 << bits, np.int32)),
                 list_array(index.astype(np.int32), sizes, pa.int32()), list_array(value, sizes, pa.float64())],
                names=["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("held_out"), vector], names=["label", "held_out", "features"])
    return run


def labelled(docs: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """text, label, held_out of at most ``max_rows`` labelled documents; ids with contradicting labels are left out."""
    votes = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(
        F.min("quality").alias("lo"), F.max("quality").alias("hi")).filter("lo = hi")
    draw = votes.select("doc_id", F.col("hi").cast("double").alias("label"), F.xxhash64("doc_id").alias("h"))
    draw = draw.orderBy("h", "doc_id").limit(rules.max_rows).withColumn("held_out", F.pmod("h", F.lit(5)) == 0)
    # At most max_rows rows of three numbers: the broadcast is bounded by that parameter.
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(draw.drop("h")), "doc_id").select("text", "label", "held_out")


def train(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> Model | None:
    """The calibrated classifier; none where the labels have fewer than two classes, so that the base rules decide."""
    rows = labelled(docs, labels, rules).mapInArrow(
        _features(rules.bits), "label double, held_out boolean, features struct<type:tinyint,size:int,indices:array<int>,values:array<double>>")
    path = scratch_path(docs.sparkSession, "features")
    rows.write.parquet(path)  # read back as vectors, without a Python function
    stored = StructType().add("label", DoubleType()).add("held_out", BooleanType()).add("features", VectorUDT())
    vectors = docs.sparkSession.read.schema(stored).parquet(path)
    seen = {(r[0], r[1]) for r in vectors.select("label", "held_out").distinct().collect()}
    if len({c for c, _ in seen}) < 2:
        return None
    fit_on = vectors.filter("NOT held_out") if len({c for c, held in seen if not held}) == 2 else vectors
    fitted = LogisticRegression(maxIter=rules.iterations, regParam=rules.penalty, standardization=False).fit(fit_on)
    weights, slope, shift = fitted.coefficients.toArray(), 1.0, 0.0
    if len({c for c, held in seen if held}) == 2:
        raw = fitted.transform(vectors.filter("held_out")).select("label", vector_to_array("rawPrediction")[1].alias("raw"))
        scored = VectorAssembler(inputCols=["raw"], outputCol="margin").transform(raw)
        platt = LogisticRegression(featuresCol="margin", maxIter=50, regParam=0.0).fit(scored)
        if platt.coefficients[0] > 0:
            slope, shift = float(platt.coefficients[0]), float(platt.intercept)
    half = 1 << rules.bits
    return Model(weights[:half].copy(), weights[half:].copy(), float(fitted.intercept), slope, shift)


RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, probability double, kept boolean"


def _judge(batch_text: pa.Array, model: Model | None, rules: Rules):
    parts = []
    for texts in text_runs(batch_text):
        c = text_counts(texts)
        failed = (c["n_words"] < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_pct * c["n_words"])
        p = np.ones(texts.n) if model is None else 1 / (1 + np.exp(-(model.slope * margins(texts, model) + model.shift)))
        parts.append([*c.values(), failed, p, ~failed & (p >= rules.threshold)])
    kinds = [np.int64] * 5 + [bool, float, bool]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, k) for k in kinds]


def quality_rules(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per input row: doc_id, the five counts, base_failed, probability, kept.

    Nulls: a null text has no words and fails; a null id stays null and is never a training row. Repeated rows get
    equal results; a document that is labelled twice alike counts once for each of its rows. Without labels of both
    classes the base rules alone decide (probability 1). An empty table gives no rows. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rules))
    names = [x.split()[0] for x in RESULT.split(", ")]

    def run(batches):
        for batch in batches:
            columns = _judge(batch.column("text"), model.value, rules)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *map(pa.array, columns)], names=names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with all their columns: rows go through the batches whole and nothing is shuffled."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rules))
    at = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]  # positions, so that any column names pass

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_judge(batch.column(at), model.value, rules)[-1]))

    plain = docs.toDF(*names)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
