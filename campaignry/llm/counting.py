"""Edit-aware token counts: a tree of token sums over the pre-tokens of each document, updated where it is edited.

A document's pre-tokens fall into leaves of a fixed number. The state of a document is the character length and the
token sum of each leaf, and above them a binary tree of sums. An edit re-encodes from the last pre-token that surely
ends before it until the new pre-token borders meet old leaf borders again; all other leaves keep their sums, and only
the sums above changed leaves are added up anew.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 32  # pre-tokens of a leaf
CACHED = 200_000  # pre-tokens whose counts a worker remembers
EDITS = "doc_id long, start long, end long, replacement string"


def read_ranks(path: str = VOCABULARY_FILE) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}


class Counter:
    """Tokens of single pre-tokens, remembered up to a bound."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= CACHED:
                self.known.clear()
            n = self.known[piece] = len(self.encoding.encode_ordinary(piece))
        return n

    def leaves(self, text: str) -> tuple[list[int], list[int]]:
        """Length and tokens of each leaf."""
        pieces = self.pattern.findall(text)
        known, count = self.known, self.count
        counts = [known.get(p) or count(p) for p in pieces]
        lengths = list(map(len, pieces))
        at = range(0, len(pieces), LEAF)
        return [sum(lengths[i: i + LEAF]) for i in at], [sum(counts[i: i + LEAF]) for i in at]


def tree(sums: list[int]) -> list[int]:
    """Sums of pairs, level above level, root last; the leaves themselves come first."""
    out, level = list(sums), list(sums)
    while len(level) > 1:
        level = [sum(level[i: i + 2]) for i in range(0, len(level), 2)]
        out += level
    return out


@dataclass
class State:
    """Leaf lengths and token sums of one text, with the sums above them."""
    lengths: list[int] = field(default_factory=list)
    nodes: list[int] = field(default_factory=list)

    @classmethod
    def of(cls, counter: Counter, text: str) -> State:
        lengths, sums = counter.leaves(text)
        return cls(lengths, tree(sums))

    @property
    def total(self) -> int:
        return self.nodes[-1] if self.nodes else 0

    def edited(self, counter: Counter, text: str, start: int, end: int, replacement: str) -> tuple[State, str, int]:
        """State and text after text[start:end] became the replacement, and the characters re-encoded.

        A pre-token depends on its characters and on two more (blanks before a word leave it their last; 're, 've and
        'll need both letters), so leaves that end two characters before ``start`` hold. Re-encoding begins at the first other leaf and stops at the first old leaf border behind the edit that is a border of the
        new pre-tokens, too: from there on both cut the same characters the same way.
        """
        start = min(max(start, 0), len(text))
        end = min(max(end, start), len(text))
        new = text[:start] + replacement + text[end:]
        shift = len(new) - len(text)
        sums = self.nodes[: len(self.lengths)]
        borders, at = [0], 0
        for n in self.lengths:
            at += n
            borders.append(at)
        first = 0
        while first < len(sums) and borders[first + 1] + 1 < start:
            first += 1
        begin = borders[first]
        old = {b + shift: i for i, b in enumerate(borders) if b >= end and i > first}
        lengths, tokens, size, n, held = [], [], 0, 0, 0
        stop, place = len(sums), begin
        for m in counter.pattern.finditer(new, begin):
            if m.start() in old and m.start() > begin:
                stop = old[m.start()]
                break
            size += m.end() - m.start()
            n += counter.count(m.group())
            held += 1
            place = m.end()
            if held == LEAF:
                lengths.append(size)
                tokens.append(n)
                size = n = held = 0
        if held:
            lengths.append(size)
            tokens.append(n)
        after = State(self.lengths[:first] + lengths + self.lengths[stop:], self._sums(sums, first, tokens, stop))
        return after, new, place - begin

    def _sums(self, sums: list[int], first: int, tokens: list[int], stop: int) -> list[int]:
        """The tree after leaves first..stop were replaced; with as many leaves as before, only sums above them change."""
        leaves = sums[:first] + tokens + sums[stop:]
        if len(leaves) != len(sums):
            return tree(leaves)
        out = leaves + self.nodes[len(sums):]
        base, size, lo, hi = 0, len(leaves), first, max(first, first + len(tokens) - 1)
        while size > 1:
            above = base + size
            lo, hi = lo // 2, hi // 2
            for i in range(lo, min(hi, (size - 1) // 2) + 1):
                out[above + i] = sum(out[base + 2 * i: min(base + 2 * i + 2, above)])
            base, size = above, (size + 1) // 2
        return out


_counter: dict[int, Counter] = {}


def _of(ranks) -> Counter:
    key = id(ranks.value)
    if key not in _counter:
        _counter.clear()
        _counter[key] = Counter(ranks.value)
    return _counter[key]


STATES = "doc_id long, leaf_chars array<int>, nodes array<int>"


def count_tokens(docs: DataFrame, path: str = VOCABULARY_FILE) -> DataFrame:
    """doc_id, leaf_chars and nodes (the tree of token sums, root last) per row; a null or empty text has neither."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))  # the entries of a vocabulary file

    def run(batches):
        counter = _of(ranks)
        for batch in batches:
            states = [State.of(counter, t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array([s.lengths for s in states], pa.list_(pa.int32())),
                pa.array([s.nodes for s in states], pa.list_(pa.int32()))], names=["doc_id", "leaf_chars", "nodes"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, STATES)


AFTER = "doc_id long, n_tokens_before long, n_tokens long, text_chars long, reencoded_chars long, leaf_chars array<int>, nodes array<int>, text string"


def apply_edits(rows: DataFrame, path: str = VOCABULARY_FILE) -> DataFrame:
    """Rows doc_id, text, leaf_chars, nodes, edits (array of start, end, replacement) with their edits applied in order.

    Positions are characters of the text as the earlier edits of the row left it; they are held inside the text. A
    null replacement is empty. Rows without edits keep their state.
    """
    ranks = rows.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches):
        counter = _of(ranks)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                state, text, done = State(r["leaf_chars"] or [], r["nodes"] or []), r["text"] or "", 0
                before = state.total
                for e in r["edits"] or []:
                    state, text, n = state.edited(counter, text, e["start"] or 0, e["end"] or 0, e["replacement"] or "")
                    done += n
                out.append((r["doc_id"], before, state.total, len(text), done, state.lengths, state.nodes, text))
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * 2 + [pa.string()]
            columns = list(zip(*out)) if out else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in AFTER.split(", ")])

    return rows.select("doc_id", "text", "leaf_chars", "nodes", "edits").mapInArrow(run, AFTER)


def counted_after_edits(docs: DataFrame, edits, path: str = VOCABULARY_FILE) -> DataFrame:
    """Counts the documents, then applies ``edits``, a column of each document's edits, to the kept trees.

    Columns: doc_id, n_tokens_before, n_tokens, text_chars, reencoded_chars. Nulls: a null text is empty; null ids stay.
    Repeated rows get equal results. An empty table gives no rows. Other columns are not read.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def keep(batches):
        counter = _of(ranks)
        for batch in batches:
            states = [State.of(counter, t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([s.lengths for s in states], pa.list_(pa.int32())),
                                              pa.array([s.nodes for s in states], pa.list_(pa.int32()))],
                                             names=["doc_id", "text", "edits", "leaf_chars", "nodes"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), edits.alias("edits"))
    kinds = f"doc_id long, text string, edits {rows.schema['edits'].dataType.simpleString()}, leaf_chars array<int>, nodes array<int>"
    return apply_edits(rows.mapInArrow(keep, kinds), path).select("doc_id", "n_tokens_before", "n_tokens", "text_chars", "reencoded_chars")


def sample_edits(text):
    """Three edits that any text admits: a word put in the middle, a cut of ten characters, words at the end."""
    n = F.coalesce(F.length(text), F.lit(0))
    middle, third = F.floor(n / 2), F.floor(n / 3)

    def edit(a, b, new):
        return F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"), F.lit(new).alias("replacement"))

    return F.array(edit(middle, middle, " inserted"), edit(third, third + 10, ""), edit(n, n + 100, " and so on"))
