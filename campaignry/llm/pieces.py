"""Merge-type piece encoding with seeded merge dropout, and its lossless decoding.

The vocabulary comes from a model file; the merges are done here. A text becomes its characters after one leading
space; the agenda always merges the adjacent pair whose union is the piece of the best score, the leftmost of equals.
A candidate is skipped where a hash keyed by seed, document, copy, the word and its number in the document, place and
piece falls below the dropout rate, so a rerun gives the same pieces and each occurrence of a word is cut on its own. Characters without a piece become byte pieces.

No piece holds a space after another character, so a text falls into independent words of leading spaces and other
characters. Many words are worked on in lockstep; a long word uses a heap. A short word is merged once without skips, and
every occurrence that skips none of the candidates that came up there shares the result; the others are worked out one
by one.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from campaignry.llm.batches import Texts, list_array, mixed, span_hashes, span_ids, text_runs

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # fixed value: the sign for a space in pieces
NONE = np.iinfo(np.int32).max
RUN_BYTES = 1 << 20  # texts that share their equal words
LOCKSTEP = 48  # longest word, in symbols, that is worked on in lockstep
SHARED = 16  # longest word, in symbols, whose equal occurrences may share their work
CHUNK = 1 << 15  # occurrences whose decisions are made at once


@dataclass(frozen=True)
class Dropout:
    rate: float = 0.1
    seed: int = 29


def read_model(path: str = MODEL_FILE) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id; kind 0 is an ordinary piece, 1 a byte, 2 neither."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    other = [2 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else int(model.is_byte(i)) for i in ids]
    return [(model.id_to_piece(i), model.get_score(i), other[i]) for i in ids]


class Vocabulary:
    """Lookup tables built from the pieces: characters, bytes, and the pairs whose union is a piece."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.size = len(pieces)
        plain = {p: i for i, (p, _, kind) in enumerate(pieces) if not kind}
        self.char = {ord(p): i for p, i in plain.items() if len(p) == 1 and p != SPACE} | {32: plain[SPACE]}
        self.byte = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == 1}
        by_score = sorted(plain.values(), key=lambda i: (-pieces[i][1], i))
        self.rank = np.full(self.size, NONE, np.int32)
        self.rank[by_score] = np.arange(len(by_score))
        self.at_rank = np.array(by_score, np.int32)
        pairs = sorted((plain[p[:k]] * self.size + plain[p[k:]], int(self.rank[i])) for p, i in plain.items()
                       for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain)
        self._fill(np.array([c for c, _ in pairs], np.int64), np.array([r for _, r in pairs], np.int32))
        texts = [bytes([int(p[1:-1], 16)]) if kind == 1 else b"" if kind == 2 else p.replace(SPACE, " ").encode()
                 for p, _, kind in pieces]
        self.text_size = np.array([len(t) for t in texts], np.int64)
        self.text_at = np.concatenate(([0], np.cumsum(self.text_size)))[:-1]
        self.text = np.frombuffer(b"".join(texts), np.uint8)

    def _fill(self, codes: np.ndarray, ranks: np.ndarray) -> None:
        """Pairs in a table of a power of two cells, each at the first free cell from its hash on."""
        self.shift = np.uint64(64 - int(4 * len(codes)).bit_length())
        cells = 1 << (64 - int(self.shift))
        self.cell_code, self.cell_rank = np.full(cells, -1, np.int64), np.full(cells, NONE, np.int32)
        at, wait = self._cell(codes), np.arange(len(codes))
        while len(wait):
            free = wait[self.cell_code[at[wait]] < 0]
            _, pick = np.unique(at[free], return_index=True)
            won = free[pick]
            self.cell_code[at[won]], self.cell_rank[at[won]] = codes[won], ranks[won]
            wait = np.setdiff1d(wait, won)
            at[wait] = (at[wait] + 1) & (cells - 1)

    def _cell(self, codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair makes, NONE where it makes none."""
        code = left.astype(np.int64) * self.size + right
        at = self._cell(code)
        found = self.cell_code[at]
        out = np.where(found == code, self.cell_rank[at], NONE)
        wait = np.flatnonzero((found != code) & (found >= 0))
        while len(wait):
            at[wait] = (at[wait] + 1) & (len(self.cell_code) - 1)
            found = self.cell_code[at[wait]]
            hit = found == code[wait]
            out[wait[hit]] = self.cell_rank[at[wait[hit]]]
            wait = wait[~hit & (found >= 0)]
        return out


def _skips(key: np.ndarray, place: np.ndarray, rank: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether the candidate of this word key, start and piece is skipped."""
    return mixed(key ^ (place.astype(np.uint64) << np.uint64(32) | rank.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) < limit


def _symbols(vocab: Vocabulary, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Piece of every character (bytes where it has none) of the words, and the number of symbols of each word."""
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    text = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])].tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    lengths = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    lengths = lengths[ends] - lengths[starts]
    known = np.flatnonzero(np.bincount(points)) if len(points) else np.zeros(0, np.int64)
    index = np.zeros(int(known[-1]) + 1 if len(known) else 1, np.int32)
    index[known] = np.arange(len(known))
    place = index[points]
    lists = [[vocab.char[c]] if c in vocab.char else [vocab.byte[b] for b in chr(c).encode()] for c in known.tolist()]
    sizes = np.array([len(x) for x in lists], np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    flat = np.array([i for x in lists for i in x], np.int32)
    each = sizes[place]
    out_at = np.concatenate(([0], np.cumsum(each)))
    gather = np.repeat(offsets[place] - out_at[:-1], each) + np.arange(out_at[-1])
    bounds = out_at[np.concatenate(([0], np.cumsum(lengths)))]
    return flat[gather] if len(flat) else np.zeros(0, np.int32), bounds


def _lockstep(vocab: Vocabulary, symbols: np.ndarray, starts: np.ndarray, width: int, lengths: np.ndarray, key: np.ndarray | None = None,
              limit: np.uint64 = np.uint64(0), first: np.ndarray | None = None, trace: list | None = None):
    """Final symbols (-1 beyond the end) of words of at most ``width`` symbols, one merge a word and round, and the first ranks.

    Without a key nothing is skipped; ``trace`` then gets word, place and rank of every candidate that comes up.
    ``first`` are the ranks of the words' adjacent characters, if known.
    """
    n = len(starts)
    column = np.arange(width)
    inside = column < lengths[:, None]
    sym = np.where(inside, symbols[np.minimum(starts[:, None] + column, len(symbols) - 1)], -1).astype(np.int32)
    out = sym.copy()
    place = np.broadcast_to(column.astype(np.int32), (n, width)).copy()
    who = np.arange(n)

    def candidates(rows, at):
        left, right = sym[rows, at], sym[rows, at + 1]
        r = np.where(right >= 0, vocab.ranks(left, right), NONE)
        some = np.flatnonzero(r != NONE)
        if key is not None:
            r[some[_skips(key[rows[some]], place[rows[some], at[some]], r[some], limit)]] = NONE
        elif trace is not None:
            trace.append((who[rows[some]], place[rows[some], at[some]], r[some]))
        return r

    if first is None:
        rank = np.full((n, width), NONE, np.int32)
        for c in range(width - 1):
            rows = np.flatnonzero(sym[:, c + 1] >= 0)
            rank[rows, c] = candidates(rows, np.full(len(rows), c))
    else:
        rank = first.copy()
        rows, at = np.nonzero(rank != NONE)
        rank[rows, at] = np.where(_skips(key[rows], at, rank[rows, at], limit), NONE, rank[rows, at])
    before_merges = rank.copy() if first is None else first
    while len(who):
        at = rank.argmin(axis=1)
        rows = np.arange(len(who))
        best = rank[rows, at]
        done = best == NONE
        if done.any():
            out[who[done]] = sym[done]
            keep = ~done
            who, sym, place, rank, at, best = who[keep], sym[keep], place[keep], rank[keep], at[keep], best[keep]
            key = key[keep] if key is not None else None
            rows = np.arange(len(who))
            if not len(who):
                break
        sym[rows, at] = vocab.at_rank[best]
        source = np.minimum(column + (column > at[:, None]), width - 1)
        last = sym[:, -1].copy()
        source += (rows * width)[:, None]
        sym, place, rank = (x.take(source) for x in (sym, place, rank))
        sym[:, -1] = np.where(at == width - 1, last, -1)
        rank[:, -1] = NONE
        rank[rows, at] = NONE
        here = rows[at < width - 1]
        rank[here, at[here]] = candidates(here, at[here])
        before = rows[at > 0]
        rank[before, at[before] - 1] = candidates(before, at[before] - 1)
    return out, before_merges


def _heaped(vocab: Vocabulary, symbols: np.ndarray, key: np.uint64, limit: np.uint64) -> np.ndarray:
    """The same agenda with a heap, for one long word."""
    sym, n = symbols.tolist(), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def push(lefts: list[int]) -> None:
        lefts = [i for i in lefts if 0 <= i and after[i] < n]
        if not lefts:
            return
        r = vocab.ranks(np.array([sym[i] for i in lefts]), np.array([sym[after[i]] for i in lefts]))
        skip = _skips(np.full(len(lefts), key, np.uint64), np.array(lefts), r, limit)
        for i, x, s in zip(lefts, r.tolist(), skip.tolist()):
            if x != NONE and not s:
                heapq.heappush(heap, (x, i, sym[i], sym[after[i]]))

    push(list(range(n - 1)))
    while heap:
        r, i, left, right = heapq.heappop(heap)
        j = after[i]
        if sym[i] != left or j >= n or sym[j] != right:
            continue
        sym[i], sym[j] = int(vocab.at_rank[r]), -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        push([before[i], i])
    return np.array([s for s in sym if s >= 0], np.int32)


def _leaves(trace: list, n: int, word: np.ndarray, key: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Which occurrences skip a candidate that comes up while their word is merged without skips; the others end as it does."""
    owner, place, rank = (np.concatenate(x) for x in zip(*trace)) if trace else (np.zeros(0, np.int64),) * 3
    order = np.argsort(owner, kind="stable")
    place, rank = place[order], rank[order]
    many = np.bincount(owner, minlength=n)
    first = np.cumsum(many) - many
    out = np.zeros(len(word), bool)
    for a in range(0, len(word), CHUNK):
        each = many[word[a: a + CHUNK]]
        ends = np.cumsum(each)
        at = np.arange(ends[-1]) + np.repeat(first[word[a: a + CHUNK]] - ends + each, each)
        skip = np.flatnonzero(_skips(np.repeat(key[a: a + CHUNK], each), place[at], rank[at], limit))
        out[a + np.searchsorted(ends, skip, side="right")] = True
    return out


def encode_run(vocab: Vocabulary, texts: Texts, doc_keys: np.ndarray, drop: Dropout) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts of a run, one after the other, and the number of ids of each text."""
    full = np.diff(texts.bounds) > 0
    at = texts.bounds[:-1][full]
    data = np.insert(texts.data, at, 32)  # the leading space of every text that is not empty
    first = at + np.arange(len(at))
    if not len(first):
        return np.zeros(0, np.int32), np.zeros(texts.n, np.int64)
    blank = data == 32
    opens = blank.copy()
    opens[1:] &= ~blank[:-1]
    opens[first] = True
    starts = np.flatnonzero(opens)
    ends = np.append(starts[1:], len(data))
    doc = np.flatnonzero(full)[np.searchsorted(first, starts, side="right") - 1]
    word = span_ids(data, starts, ends)
    serial = np.arange(len(starts)) - np.searchsorted(starts, first)[np.searchsorted(first, starts, side="right") - 1]
    limit = np.uint64(min(int(drop.rate * 2.0**64), 2**64 - 1))
    firsts = np.zeros(int(word.max()) + 1, np.int64)
    firsts[word[::-1]] = np.arange(len(word))[::-1]  # the first place of each word
    hashes = span_hashes(data, starts[firsts], ends[firsts])
    key = mixed(hashes[word] ^ np.uint64((drop.seed * 0xD6E8FEB86659FD93 + 1) % 2**64)
                ^ mixed(doc_keys[doc] ^ serial.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
    symbols, bounds = _symbols(vocab, data, starts[firsts], ends[firsts])
    lengths = np.diff(bounds)
    back, sizes, done, known = np.zeros(len(word), np.int64), [], [], 0

    def add(cut: np.ndarray) -> int:
        nonlocal known
        sizes.append((cut >= 0).sum(axis=1))
        done.append(cut[cut >= 0])
        known += len(cut)
        return known - len(cut)

    for low, width in ((0, 6), (6, 10), (10, SHARED), (SHARED, 28), (28, LOCKSTEP)):
        rows = np.flatnonzero((lengths > low) & (lengths <= width))
        if not len(rows):
            continue
        number = np.full(len(lengths), -1)
        number[rows] = np.arange(len(rows))
        here = np.flatnonzero(number[word] >= 0)
        mine, trace, first = number[word[here]], [], None
        alone = np.full(len(here), bool(limit))  # occurrences that are worked out one by one
        if width <= SHARED or not limit:
            cut, first = _lockstep(vocab, symbols, bounds[rows], width, lengths[rows], trace=trace)
            back[here] = add(cut) + mine
            if limit:
                alone = _leaves(trace, len(rows), mine, key[here], limit)
        own = here[alone]
        if len(own):
            cut, _ = _lockstep(vocab, symbols, bounds[word[own]], width, lengths[word[own]], key[own], limit,
                               None if first is None else first[mine[alone]])
            back[own] = add(cut) + np.arange(len(own))
    for i in np.flatnonzero(lengths[word] > LOCKSTEP):
        w = word[i]
        back[i] = add(_heaped(vocab, symbols[bounds[w]: bounds[w] + lengths[w]], key[i], limit)[None, :])
    sizes, flat = np.concatenate(sizes), np.concatenate(done)
    offset = np.cumsum(sizes) - sizes
    each = sizes[back]
    out_at = np.concatenate(([0], np.cumsum(each)))
    ids = flat[np.repeat(offset[back] - out_at[:-1], each) + np.arange(out_at[-1])]
    return ids, np.bincount(doc, weights=each, minlength=texts.n).astype(np.int64)


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> bytes:
    """The text of one id sequence: the pieces' characters without the leading space."""
    each = vocab.text_size[ids]
    at = np.concatenate(([0], np.cumsum(each)))
    return vocab.text[np.repeat(vocab.text_at[ids] - at[:-1], each) + np.arange(at[-1])].tobytes()[1:]


def decoded_digests(vocab: Vocabulary, column: pa.Array) -> list[str]:
    """SHA-256 of the text of each id sequence of a list column."""
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [hashlib.sha256(decode_ids(vocab, flat[a:b])).hexdigest() for a, b in zip(at[:-1], at[1:])]


def _vocabulary(spark, path: str):
    return spark.sparkContext.broadcast(read_model(path))  # the pieces of a vocabulary file, 32,000 here


_built: dict[int, Vocabulary] = {}


def _tables(pieces) -> Vocabulary:
    key = id(pieces.value)
    if key not in _built:
        _built.clear()
        _built[key] = Vocabulary(pieces.value)
    return _built[key]


def numbered(docs: DataFrame) -> DataFrame:
    """Adds mix_copy, the number from 0 of a row among those of equal id and text, so that copies are cut differently."""
    alike = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return docs.withColumn("mix_copy", F.row_number().over(alike) - 1)


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text and the number of the copy, 0 where the documents have none."""
    copy = F.coalesce(F.col("mix_copy").cast("long"), F.lit(0)) if "mix_copy" in docs.columns else F.lit(0)
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), copy.cast("long").alias("mix_copy"))


def encode(docs: DataFrame, drop: Dropout = Dropout(), path: str = MODEL_FILE) -> DataFrame:
    """doc_id, ids, text_sha256 per row.

    Nulls: a null text is empty and has no ids; rows with a null id are keyed alike. Repeated rows get equal ids,
    unless a column mix_copy numbers them. A literal U+2581 in a text becomes byte pieces, so that decoding gives it
    back. An empty table gives no rows. Other columns are not read.
    """
    pieces = _vocabulary(docs.sparkSession, path)
    return _texts(docs).mapInArrow(
        _encoder(pieces, drop), "doc_id long, ids array<int>, text_sha256 string")


def _encoder(pieces, drop: Dropout):
    def run(batches):
        vocab = _tables(pieces)
        for batch in batches:
            keys = mixed(batch.column("doc_id").cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
                         ^ np.uint64(drop.seed % 2**64))
            copies = batch.column("mix_copy").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = np.where(copies == 0, keys, mixed(keys ^ copies * np.uint64(0xE7037ED1A0B428DB)))
            ids, sizes, digests = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], []
            for texts in text_runs(batch.column("text"), RUN_BYTES):
                x, n = encode_run(vocab, texts, keys[texts.first: texts.first + texts.n], drop)
                ids.append(x)
                sizes.append(n)
                raw = texts.data.tobytes()
                digests += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(texts.bounds[:-1].tolist(), texts.bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), list_array(np.concatenate(ids), np.concatenate(sizes), pa.int32()),
                                              pa.array(digests, pa.string())], names=["doc_id", "ids", "text_sha256"])
    return run


def decode(encoded: DataFrame, path: str = MODEL_FILE, keep_text: bool = True) -> DataFrame:
    """Adds decoded_sha256, and the text if asked, to rows with a column ids; other columns stay."""
    pieces = _vocabulary(encoded.sparkSession, path)
    names = [c for c in encoded.columns if c not in ("decoded", "decoded_sha256")]
    rows = encoded.select(*[F.col(f"`{c}`") for c in names])
    more = [("decoded", pa.string())] * keep_text + [("decoded_sha256", pa.string())]
    schema = StructType([*rows.schema.fields, *[StructField(name, StringType()) for name, _ in more]])

    def run(batches):
        vocab = _tables(pieces)
        for batch in batches:
            column = batch.column("ids")
            flat, at = column.values.to_numpy(), column.offsets.to_numpy()
            texts = [decode_ids(vocab, flat[a:b]) for a, b in zip(at[:-1], at[1:])]
            new = {"decoded": texts, "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in texts]}
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array([t.decode() for t in new[n]] if n == "decoded" else new[n], k)
                                                                for n, k in more]], names=[*names, *[n for n, _ in more]])

    return rows.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, drop: Dropout = Dropout(), path: str = MODEL_FILE) -> DataFrame:
    """doc_id, ids, n_ids, text_sha256 and whether the ids decode to the very text.

    Both ways run in one step, so that a task has one Python worker. Edge cases as in ``encode``.
    """
    pieces = _vocabulary(docs.sparkSession, path)
    encoder = _encoder(pieces, drop)

    def run(batches):
        for batch in encoder(batches):
            digests = decoded_digests(_tables(pieces), batch.column("ids"))
            same = pc.equal(batch.column("text_sha256"), pa.array(digests, pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"),
                                              pc.list_value_length(batch.column("ids")).cast(pa.int64()), batch.column("text_sha256"), same],
                                             names=["doc_id", "ids", "n_ids", "text_sha256", "lossless"])

    return _texts(docs).mapInArrow(
        run, "doc_id long, ids array<int>, n_ids long, text_sha256 string, lossless boolean")
