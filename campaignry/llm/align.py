"""Cross-tokenizer alignment: where the tokens of two vocabularies end together, which overlap, and how often.

Both tokenizers cut a text into words of one leading space and what follows, and no token of either reaches over such a
border. Equal words of a chunk of texts are therefore encoded and aligned once; documents are sums over their words.

Alignment is an intersection of two sorted lists of byte ends. The shorter list drives: each of its ends is searched in
the longer by doubling steps from the place of its left neighbour and by halving the last step. Common ends slice the
tokens into groups; the difference of the ranks of a token's two ends is the range of tokens it overlaps.

A chunk writes its words, links and pair counts once. Pair counts are summed over all chunks, the highest of each id of
the second vocabulary is found, and each chunk gets the totals of its own pairs back.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.llm.batches import list_array, span_ids, text_runs, value_ids
from campaignry.llm.planes import pack, unpack
from campaignry.session import cut_lineage

BYTE_FILE, PIECE_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # fixed value: the sign for a space in pieces
# Fixed value: how the byte vocabulary cuts texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class AlignPlan:
    chunk_bytes: int = 1 << 23  # text whose equal words share their work
    byte_file: str = BYTE_FILE
    piece_file: str = PIECE_FILE


def byte_of_sign() -> dict[str, int]:
    """The sign for each byte in byte-level vocabularies: visible Latin-1 characters stand for themselves, the rest from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """Token bytes of one vocabulary, and its encoder for words that begin with a space."""

    def __init__(self, tokens: list[bytes], encode):
        self.size, self.encode = len(tokens), encode
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = np.array([str(i) for i in range(self.size)], object)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        each = self.lengths[ids]
        edge = np.concatenate(([0], np.cumsum(each)))
        return self.data[np.repeat(self.at[ids] - edge[:-1], each) + np.arange(edge[-1])]


def byte_side(text: str) -> Side:
    """From the JSON text of a byte-level vocabulary whose merges come in the order of their ids."""
    import tiktoken

    model = json.loads(text)
    sign = byte_of_sign()
    special = {t["content"] for t in model.get("added_tokens", []) if t.get("special")}
    ids = {t: i for t, i in model["model"]["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    made = [ids[a + b] for a, b in merges]
    if any(x >= y for x, y in zip(made, made[1:])):
        raise ValueError("merges are not in the order of their ids")
    raw = {bytes(sign[c] for c in t): i for t, i in ids.items()}
    tokens = [b""] * (max(model["model"]["vocab"].values()) + 1)
    for t, i in raw.items():
        tokens[i] = t
    return Side(tokens, tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=raw, special_tokens={}).encode_ordinary)


def piece_side(proto: bytes) -> Side:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=proto)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        none = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
        tokens.append(b"" if none else bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
    blank = [model.piece_to_id(SPACE)]
    return Side(tokens, lambda word: model.encode(word[1:], num_threads=1) if len(word) > 1 else blank)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """How many values of ``long`` lie below each value of ``short``; both sorted.

    Values at every second step of a stride start from the place of their left neighbour, then the stride halves, so
    that the search distance of a value is that to its neighbour's place.
    """
    n, m = len(short), len(long)
    place = np.zeros(n, np.int64)
    stride = 1 << max(n - 1, 0).bit_length()
    while stride and n:
        mine = np.arange(0 if stride >= n else stride, n, 2 * stride)
        keys, low = short[mine], place[np.maximum(mine - stride, 0)]
        high, step = low.copy(), 1  # low: all before it are below the key
        going = np.arange(len(mine))
        while len(going):
            going = going[high[going] < m]
            going = going[long[high[going]] < keys[going]]
            low[going] = high[going] + 1
            high[going] += step
            step *= 2
        high = np.minimum(high, m)
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) // 2
            below = long[middle] < keys[going]
            low[going] = np.where(below, middle + 1, low[going])
            high[going] = np.where(below, high[going], middle)
            going = going[low[going] < high[going]]
        place[mine] = low
        stride //= 2
    return place


@dataclass
class Alignment:
    """Tokens after which a common end lies, and links as pairs of token numbers."""

    a_cuts: np.ndarray
    b_cuts: np.ndarray
    a: np.ndarray
    b: np.ndarray


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Alignment:
    turned = len(a_ends) > len(b_ends)
    short, long = (b_ends, a_ends) if turned else (a_ends, b_ends)
    place = gallop(short, long)
    common = np.zeros(len(short), bool)
    inside = place < len(long)
    common[inside] = long[place[inside]] == short[inside]
    s_cuts, l_cuts = np.flatnonzero(common), place[common]
    first = np.concatenate(([0], (place + common)[:-1])) if len(short) else place  # tokens that end at or before its start
    each = place - first + 1
    edge = np.cumsum(each) - each
    s = np.repeat(np.arange(len(short)), each)
    l = np.repeat(first - edge, each) + np.arange(len(s))  # noqa: E741
    return Alignment(l_cuts, s_cuts, l, s) if turned else Alignment(s_cuts, l_cuts, s, l)


def _encoded(side: Side, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    ids = [side.encode(w) for w in words]
    counts = np.array([len(x) for x in ids], np.int64)
    return np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum())), counts


def _same_bytes(side: Side, ids: np.ndarray, counts: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Whether the tokens of each word give its bytes."""
    first = np.concatenate(([0], np.cumsum(counts)))
    edge = np.concatenate(([0], np.cumsum(side.lengths[ids])))[first]
    data = side.joined(ids).tobytes()
    return np.array([data[x:y] == w for x, y, w in zip(edge[:-1].tolist(), edge[1:].tolist(), words)], bool)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of so many values."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    edge = np.concatenate(([0], np.cumsum(counts)))
    return total[edge[1:]] - total[edge[:-1]]


def _group_texts(a_ids, b_ids, a_cuts, b_cuts, names_a, names_b) -> list[str]:
    a, b = names_a[a_ids].tolist(), names_b[b_ids].tolist()
    out, i, j = [], 0, 0
    for x, y in zip((a_cuts + 1).tolist(), (b_cuts + 1).tolist()):
        out.append((a[i] if x == i + 1 else ",".join(a[i:x])) + "|" + (b[j] if y == j + 1 else ",".join(b[j:y])))
        i, j = x, y
    return out


class _Words:
    """Words of a chunk of texts: unique ones, and the numbers of those of each document in order."""

    def __init__(self, texts: list):
        bounds = np.concatenate([np.zeros(1, np.int64)] + [np.diff(t.bounds) for t in texts]).cumsum()
        data = np.concatenate([t.data for t in texts])
        full = np.diff(bounds) > 0
        at = bounds[:-1][full]
        data = np.insert(data, at, 32)  # the leading space of every text that is not empty
        first = at + np.arange(len(at))
        opens = data == 32
        opens[1:] &= (data[:-1] > 32) & (data[:-1] < 127)  # behind a visible ASCII character both tokenizers cut
        opens[first] = True
        starts = np.flatnonzero(opens)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        self.word = span_ids(data, starts, ends)
        self.unique = int(self.word.max()) + 1 if len(self.word) else 0
        one = np.zeros(self.unique, np.int64)
        one[self.word[::-1]] = np.arange(len(self.word))[::-1]
        raw = data.tobytes()
        self.bytes = [raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        self.doc = np.flatnonzero(full)[np.searchsorted(first, starts, side="right") - 1]
        self.counts = np.bincount(self.doc, minlength=len(full))


CHUNKS = "chunk long, pairs array<long>, counts array<long>, data binary, links binary, digests binary"
_chunks = pa.schema([("chunk", pa.int64()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("data", pa.binary()),
                     ("links", pa.binary()), ("digests", pa.binary())])


def _chunk_row(texts: list, docs: pa.Array, a_side: Side, b_side: Side) -> pa.RecordBatch:
    w = _Words(texts)
    plain = [x.decode() for x in w.bytes]
    (a_ids, a_counts), (b_ids, b_counts) = _encoded(a_side, plain), _encoded(b_side, plain)
    good = _same_bytes(a_side, a_ids, a_counts, w.bytes) & _same_bytes(b_side, b_ids, b_counts, w.bytes)
    # A document with a word that does not come back has no tokens; its words count nowhere.
    lossless = np.ones(len(docs), bool)
    lossless[w.doc[~good[w.word]]] = False
    a_ids, b_ids = a_ids[np.repeat(good, a_counts)], b_ids[np.repeat(good, b_counts)]
    a_counts, b_counts = np.where(good, a_counts, 0), np.where(good, b_counts, 0)
    found = align(np.cumsum(a_side.lengths[a_ids]), np.cumsum(b_side.lengths[b_ids]))
    word_of_a = np.repeat(np.arange(w.unique), a_counts)
    groups = np.bincount(word_of_a[found.a_cuts], minlength=w.unique)
    links = np.bincount(word_of_a[found.a], minlength=w.unique)
    texts_of = _group_texts(a_ids, b_ids, found.a_cuts, found.b_cuts, a_side.names, b_side.names)
    edge = np.concatenate(([0], np.cumsum(groups))).tolist()
    said = np.array([";".join(texts_of[x:y]) for x, y in zip(edge[:-1], edge[1:])] + [""], object)[:-1]

    use = lossless[w.doc]
    word, doc = w.word[use], w.doc[use]
    per_doc = np.where(lossless, w.counts, 0)
    numbers = [_sums(x[word], per_doc) for x in (a_counts, b_counts, groups, links)]
    digests, at = [], np.concatenate(([0], np.cumsum(per_doc))).tolist()
    for x, y in zip(at[:-1], at[1:]):
        digests.append(hashlib.sha256(";".join(said[word[x:y]].tolist()).encode()).digest() if y > x else bytes(32))
    # Links come in the order of the words on either side, so the links of a word stand together.
    order = np.argsort(word_of_a[found.a], kind="stable")
    key = (a_ids[found.a] * b_side.size + b_ids[found.b])[order]
    pair = value_ids(key)
    pairs = np.zeros(int(pair.max()) + 1 if len(pair) else 0, np.int64)
    pairs[pair] = key
    many = np.bincount(word, minlength=w.unique)
    counts = np.bincount(pair, weights=np.repeat(many, links), minlength=len(pairs)).astype(np.int64)
    has = docs.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
    table = pack(docs.fill_null(0).to_numpy(zero_copy_only=False), has, per_doc, *numbers)
    return pa.RecordBatch.from_arrays([
        pa.array([uuid.uuid4().int >> 65], pa.int64()), list_array(pairs, np.array([len(pairs)]), pa.int64()),
        list_array(counts, np.array([len(pairs)]), pa.int64()), pa.array([pack_two(table, pack(word.astype(np.uint32)))], pa.binary()),
        pa.array([pack_two(pack(links), pack(pair.astype(np.uint32)))], pa.binary()), pa.array([b"".join(digests)], pa.binary())], schema=_chunks)


def pack_two(first: bytes, second: bytes) -> bytes:
    return len(first).to_bytes(8, "little") + first + second


def unpack_two(data: bytes) -> tuple[bytes, bytes]:
    n = int.from_bytes(data[:8], "little")
    return data[8: 8 + n], data[8 + n:]


_built: dict[int, tuple[Side, Side]] = {}


def _sides(files) -> tuple[Side, Side]:
    if files.id not in _built:
        _built.clear()
        _built[files.id] = byte_side(files.value[0]), piece_side(files.value[1])
    return _built[files.id]


class _Files:
    """The two vocabulary files, sent once to each executor; their size does not depend on the corpus."""

    def __init__(self, spark, plan: AlignPlan):
        self.id = uuid.uuid4().hex
        with open(plan.byte_file, encoding="utf-8") as f, open(plan.piece_file, "rb") as g:
            self.sent = spark.sparkContext.broadcast((f.read(), g.read()))

    @property
    def value(self):
        return self.sent.value


def _cut_chunks(files: _Files, plan: AlignPlan):
    def run(batches):
        texts, docs, held = [], [], 0

        def row():
            return _chunk_row(texts, pa.concat_arrays(docs), *_sides(files))
        for batch in batches:
            for part in text_runs(batch.column("text")):
                texts.append(part)
                docs.append(batch.column("doc_id").slice(part.first, part.n))
                held += len(part.data)
                if held >= plan.chunk_bytes:
                    yield row()
                    texts, docs, held = [], [], 0
        if texts:
            yield row()
    return run


OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _documents(batches):
    schema = pa.schema([(x.split(" ")[0], pa.string() if x.endswith("string") else pa.int64()) for x in OUT.split(", ")])
    for batch in batches:
        for data, links, digests, found in zip(*(batch.column(c) for c in ("data", "links", "digests", "found"))):
            table, words = unpack_two(data.as_py())
            doc, has, per_doc, n_a, n_b, n_groups, n_links = unpack(table, *[np.int64] * 7)
            word = unpack(words, np.uint32)[0]
            each, pair = unpack_two(links.as_py())
            each, pair = unpack(each, np.int64)[0], unpack(pair, np.uint32)[0]
            found = found.values
            total, best = np.zeros(len(found) if found is not None else 0, np.int64), None
            best = np.zeros(len(total), np.int64)
            if len(total):
                place = found.field("place").to_numpy()
                total[place] = found.field("total").to_numpy()
                best[place] = found.field("best").to_numpy(zero_copy_only=False)
            sums = [_sums(_sums(x[pair], each)[word], per_doc) for x in (best, total)]
            raw = digests.as_py()
            sha = [raw[32 * i: 32 * i + 32].hex() if n else "" for i, n in enumerate(per_doc.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(doc, mask=has == 0), *map(pa.array, (n_a, n_b, n_groups, n_links, *sums)),
                                              pa.array(sha, pa.string())], schema=schema)


def pair_totals(chunks: DataFrame, b_size: int) -> DataFrame:
    """(pair, total, best): how many links of the corpus hold it, and whether no pair of the same second id has more."""
    pairs = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("e")).groupBy(F.col("e.pairs").alias("pair")).agg(
        F.sum("e.counts").alias("total")).withColumn("b", F.col("pair") % b_size)
    pairs = cut_lineage(pairs)
    highest = pairs.groupBy("b").agg(F.max("total").alias("highest"))
    return pairs.join(F.broadcast(highest), "b").select("pair", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))


def _chunked(docs: DataFrame, plan: AlignPlan) -> tuple[DataFrame, int]:
    files = _Files(docs.sparkSession, plan)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut_lineage(rows.mapInArrow(_cut_chunks(files, plan), CHUNKS)), piece_side(files.value[1]).size


def token_pairs(docs: DataFrame, plan: AlignPlan = AlignPlan()) -> DataFrame:
    """(a, b, links, best): the linked token ids of the two vocabularies over the whole corpus."""
    chunks, size = _chunked(docs, plan)
    found = pair_totals(chunks, size)
    return found.select(F.floor(F.col("pair") / size).alias("a"), (F.col("pair") % size).alias("b"), F.col("total").alias("links"),
                        (F.col("best") == 1).alias("best"))


def aligned_documents(docs: DataFrame, plan: AlignPlan = AlignPlan()) -> DataFrame:
    """One row per input row: the numbers of tokens, groups and links, of best links, the summed pair counts, the digest of the groups.

    Nulls: a null text is empty; a null doc_id stays null. Texts that are empty, or that one of the tokenizers does not
    give back byte by byte, have no tokens: zeros and an empty digest, and they add to no pair. Repeated rows count as
    often as they occur. An empty table gives no rows. Other columns are not read.
    """
    chunks, size = _chunked(docs, plan)
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair")).join(pair_totals(chunks, size), "pair")
    found = asked.groupBy("chunk").agg(F.collect_list(F.struct("place", "total", "best")).alias("found"))  # bounded by a chunk's text
    rows = chunks.select("chunk", "data", "links", "digests").join(found.hint("merge"), "chunk", "left")
    none = F.array().cast("array<struct<place:int,total:bigint,best:int>>")
    return rows.select("data", "links", "digests", F.coalesce("found", none).alias("found")).mapInArrow(_documents, OUT)
