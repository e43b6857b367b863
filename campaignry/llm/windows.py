"""Substring dedup: Rabin-Karp hashes of every window of 50 words, counted over all documents, merged to intervals.

Texts are taken in chunks of about 8 MB. A chunk rolls two hashes over all windows of its documents, combines equal
windows (the smallest document of each is known at once) and deals the rest out by ranges of the hash. A range finds
the smallest document of every window over all chunks and answers each chunk with the places that a smaller document
has, too. The chunk merges its repeated windows to maximal intervals of words, which are joined with the texts.

A window that occurs in a third of all documents costs one entry per chunk, not one per document. Windows are told
apart by 88 bits of hash. Only the last join moves texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.llm.batches import _P, _P_INV, Words, _power, list_array, mixed, text_runs
from campaignry.llm.planes import pack, unpack
from campaignry.session import cut_lineage

LAST = np.iinfo(np.int64).max  # stands for a missing id, behind all others
DEALT = "chunk long, bucket long, kind int, data binary"
SPANS = "doc_id long, digest long, starts array<int>, ends array<int>"
_dealt = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
_spans = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


@dataclass(frozen=True)
class WindowPlan:
    words: int = 50
    chunk_bytes: int = 1 << 23  # text whose equal windows are combined before they are dealt out
    range_bytes: int = 1 << 23  # text whose windows fall into one range of hashes
    max_range_bits: int = 20

    def range_bits(self, text_bytes: int) -> int:
        return min(max(-(-text_bytes // self.range_bytes) - 1, 1).bit_length(), self.max_range_bits)


def rolled(words: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, 64-bit hash and 24-bit check of every window that lies in one text."""
    if words.n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    at = np.flatnonzero(words.doc[: words.n - size + 1] == words.doc[size - 1:])
    out = []
    hashes = words.hashes()
    for salt in (0x2545F4914F6CDD1D, 0xA24BAED4963EE407):
        total = np.zeros(words.n + 1, np.uint64)
        np.cumsum(mixed(hashes ^ np.uint64(salt)) * _power("p", _P, words.n), out=total[1:])
        out.append(mixed((total[at + size] - total[at]) * _power("inverse", _P_INV, words.n)[at]))
    return at, out[0], (out[1] >> np.uint64(40)).astype(np.uint32)


def grouped(hashes: np.ndarray, check: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by hash, and in it the smallest document of each entry's window."""
    order = np.argsort(hashes, kind="stable")
    h, c = hashes[order], check[order]
    if len(h) and ((h[1:] == h[:-1]) & (c[1:] != c[:-1])).any():
        order = np.lexsort((check, hashes))
        h, c = hashes[order], check[order]
    opens = np.ones(len(h), bool)
    opens[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(opens)
    least = np.minimum.reduceat(docs[order], first) if len(first) else docs[:0]
    return order, np.repeat(least, np.diff(np.append(first, len(h))))


class _Chunk:
    """Documents and windows of a run of texts."""

    def __init__(self):
        self.bytes, self.words = 0, 0
        self.docs, self.digests, self.counts, self.at, self.row, self.hash, self.check = ([] for _ in range(7))

    def add(self, texts, docs: np.ndarray, digests: np.ndarray, size: int) -> None:
        words = texts.words()
        at, h, check = rolled(words, size)
        self.row.append(words.doc[at] + sum(map(len, self.docs)))
        self.at.append(at + self.words)
        self.hash.append(h)
        self.check.append(check)
        self.docs.append(docs)
        self.digests.append(digests)
        self.counts.append(words.counts)
        self.words += words.n
        self.bytes += len(texts.data)

    def rows(self, bits: int) -> pa.RecordBatch:
        """Kind 0: the documents. Kind 1: windows whose smallest document of the chunk they lie in, by range. Kind 2: the others."""
        docs, digests, counts, at, row, h, check = (np.concatenate(x) for x in (
            self.docs, self.digests, self.counts, self.at, self.row, self.hash, self.check))
        table = pack(docs, digests, counts.astype(np.int64))
        chunk = int.from_bytes(hashlib.blake2b(table, digest_size=8).digest(), "little", signed=True)
        order, least = grouped(h, check, docs[row])
        mine = docs[row[order]]
        again = at[order[mine > least]].astype(np.uint32)
        sent = order[mine == least]
        own = chunk % (1 << bits)
        out = [(chunk, own, 0, table)] + [(chunk, own, 2, pack(np.sort(again)))] * bool(len(again))
        bucket = (h[sent] >> np.uint64(64 - bits)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        for a, b in zip(cut, np.append(cut[1:], len(sent))):
            part = sent[a:b]
            out.append((chunk, int(bucket[a]), 1, pack(h[part], check[part], docs[row[part]], at[part].astype(np.uint32))))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _dealt)], schema=_dealt)


def _deal(plan: WindowPlan, bits: int):
    def run(batches):
        chunk = _Chunk()
        for batch in batches:
            docs = batch.column("doc_id").fill_null(int(LAST)).to_numpy(zero_copy_only=False)
            digests = batch.column("digest").to_numpy(zero_copy_only=False)
            for texts in text_runs(batch.column("text")):
                here = slice(texts.first, texts.first + texts.n)
                chunk.add(texts, docs[here], digests[here], plan.words)
                if chunk.bytes >= plan.chunk_bytes:
                    yield chunk.rows(bits)
                    chunk = _Chunk()
        if chunk.docs:
            yield chunk.rows(bits)
    return run


def _rows_by(batches, key: str) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of sorted batches by the value of a column."""
    now, rows = None, []
    for batch in batches:
        for value, *row in zip(*(batch.column(c).to_pylist() for c in (key, "chunk", "kind", "data"))):
            if value != now and rows:
                yield now, rows
                rows = []
            now = value
            rows.append(tuple(row))
    if rows:
        yield now, rows


def _answer(batches):
    """Places of a range's windows that a smaller document has, too, by chunk. Other kinds pass through."""
    for bucket, rows in _rows_by(batches, "bucket"):
        out = [(chunk, bucket, kind, data) for chunk, kind, data in rows if kind != 1]
        asked = [(chunk, unpack(data, np.uint64, np.uint32, np.int64, np.uint32)) for chunk, kind, data in rows if kind == 1]
        if asked:
            h, check, docs, at = (np.concatenate(c) for c in zip(*(x for _, x in asked)))
            order, least = grouped(h, check, docs)
            again = np.zeros(len(h), bool)
            again[order[docs[order] > least]] = True
            edge = np.cumsum([0] + [len(x[0]) for _, x in asked])
            for (chunk, _), a, b in zip(asked, edge[:-1], edge[1:]):
                if again[a:b].any():
                    out.append((chunk, bucket, 2, pack(at[a:b][again[a:b]])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _dealt)], schema=_dealt)


def _merge(plan: WindowPlan):
    """Maximal intervals of covered words, per document that has any."""
    def run(batches):
        for chunk, rows in _rows_by(batches, "chunk"):
            tables = [data for _, kind, data in rows if not kind]
            if not tables:
                raise RuntimeError("the documents changed while they were read; give a stored table")
            docs, digests, counts = unpack(tables[0], np.int64, np.int64, np.int64)
            hits = [unpack(data, np.uint32)[0] for _, kind, data in rows if kind == 2]
            if not hits:
                continue
            at = np.concatenate(hits).astype(np.int64)
            first = np.concatenate(([0], np.cumsum(counts)))
            change = np.bincount(at, minlength=first[-1] + 1) - np.bincount(at + plan.words, minlength=first[-1] + 1)
            covered = np.cumsum(change) > 0
            edge = np.zeros(len(covered) + 1, bool)
            edge[1:-1] = covered[1:] != covered[:-1]
            edge[0] = covered[0]
            edge[first] = True  # an interval ends with its document
            cuts = np.flatnonzero(edge)
            inside = np.flatnonzero(covered[np.minimum(cuts[:-1], len(covered) - 1)])
            starts, ends = cuts[inside], cuts[inside + 1]
            row = np.searchsorted(first, starts, side="right") - 1
            each = np.bincount(row, minlength=len(docs))
            some = np.flatnonzero(each)
            base = first[row]
            yield pa.RecordBatch.from_arrays([
                pa.array(docs[some], mask=docs[some] == LAST), pa.array(digests[some]),
                list_array(starts - base, each[some], pa.int32()), list_array(ends - base, each[some], pa.int32())], schema=_spans)
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("digest", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """(doc_id, digest, starts, ends) of every document with repeated windows; digest is xxhash64 of its text.

    Spans are counted in words, ends exclusive, do not overlap and lie in order.
    """
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    dealt = _keyed(docs).mapInArrow(_deal(plan, plan.range_bits(total)), DEALT)
    answers = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_answer, DEALT)
    spans = answers.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_merge(plan), SPANS)
    return cut_lineage(spans.dropDuplicates(["doc_id", "digest"]))  # equal rows of one id have equal spans


def _cut(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.large_string()),
                        ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
    for batch in batches:
        starts, ends = batch.column("starts"), batch.column("ends")
        for texts in text_runs(batch.column("text")):
            words = texts.words()
            here = slice(texts.first, texts.first + texts.n)
            s, e = starts[here], ends[here]
            base = np.repeat(words.first[:-1], s.value_lengths().fill_null(0).to_numpy())
            change = np.zeros(words.n + 1, np.int64)
            np.add.at(change, base + s.flatten().to_numpy(), 1)
            np.add.at(change, base + e.flatten().to_numpy(), -1)
            keep = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            a, sizes, doc = words.starts[keep], words.ends[keep] - words.starts[keep] + 1, words.doc[keep]
            last = np.ones(len(keep), bool)
            last[:-1] = doc[1:] != doc[:-1]
            edge = np.concatenate(([0], np.cumsum(sizes)))
            padded = np.append(words.data, np.uint8(32))
            data = padded[np.repeat(a - edge[:-1], sizes) + np.arange(edge[-1])]
            data[edge[1:] - 1] = 32
            stay = np.ones(len(data), bool)
            stay[edge[1:][last] - 1] = False  # no space behind the last word of a text
            left = np.bincount(doc, minlength=texts.n)
            each = np.bincount(doc, weights=sizes, minlength=texts.n).astype(np.int64) - (left > 0)
            text = pa.Array.from_buffers(pa.large_string(), texts.n, [
                None, pa.py_buffer(np.concatenate(([0], np.cumsum(each)))), pa.py_buffer(data[stay])])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[here], pa.array(words.counts), pa.array(words.counts - left), text,
                                              s, e], schema=schema)


def cut_documents(docs: DataFrame, plan: WindowPlan = WindowPlan()) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text, starts, ends (of the removed spans, in words; null for none).

    A word goes if some window over it also starts in a document of a smaller id. Nulls: a null text is empty; a
    missing id counts as larger than all others, so copies without id give way to those with one but not to each
    other. Rows of one id are never held against each other. Texts without words, or shorter than a window, stay as
    they are. An empty table gives no rows. Other columns are not read. The documents are read three times, so give a
    stored table.
    """
    rows = _keyed(docs).join(repeated_spans(docs, plan).hint("merge").withColumnsRenamed({"doc_id": "id", "digest": "print"}),
                             F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("print")), "left")
    return rows.select("doc_id", "text", "starts", "ends").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_text string, starts array<int>, ends array<int>")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
seen AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS s FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
least AS (SELECT s, min(doc_id) AS first_doc FROM seen GROUP BY s),
hit AS (SELECT doc_id, i FROM seen JOIN least USING (s) WHERE first_doc < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM hit, unnest(range(50)) AS u(k)),
per AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, j: ps IS NULL OR NOT list_contains(ps, j)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)
"""
