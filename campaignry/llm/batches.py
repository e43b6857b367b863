"""Vectorised views of Arrow text batches: words, lines and hashes as numpy arrays, no object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20  # texts are worked on in runs of about this size; a longer text is a run of its own
_P = np.uint64(0x9E3779B97F4A7C55)  # odd base of the rolling hash
_P_INV = np.uint64(pow(int(_P), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span of ``data``, from one rolling sum."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power("p", _P, n), out=total[1:])
    h = (total[ends] - total[starts]) * _power("inverse", _P_INV, n + 1)[starts]
    return mixed(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Texts:
    """A run of texts: ``data`` holds their UTF-8 bytes, ``bounds`` the offsets of the texts in it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first = data, bounds, first
        self.n = len(bounds) - 1

    def words(self, lower: bool = False) -> Words:
        return Words(self, lower)


class Words:
    """Runs of other than white space: byte spans ``starts``/``ends`` and the index ``doc`` of their text."""

    def __init__(self, texts: Texts, lower: bool):
        data = texts.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        self.data = data
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.ones(len(data) + 1, bool)  # a text border ends a word, too
        edge[1:-1] = blank[1:] != blank[:-1]
        edge[texts.bounds] = True
        at = np.flatnonzero(edge)
        inside = ~blank[at[:-1]] if len(data) else np.zeros(0, bool)
        self.starts, self.ends = at[:-1][inside], at[1:][inside]
        self.doc = np.searchsorted(texts.bounds, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=texts.n)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))  # of each text's words
        self.n = len(self.starts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def ids(self) -> np.ndarray:
        """Small numbers, equal for equal words of this run; by the bytes, not by a hash."""
        return span_ids(self.data, self.starts, self.ends)


def span_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.int64)
    sizes = ends - starts
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    keep = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
    packed = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[keep])])
    return packed.dictionary_encode().indices.to_numpy().astype(np.int64)


def value_ids(values: np.ndarray) -> np.ndarray:
    return pa.array(values).dictionary_encode().indices.to_numpy().astype(np.int64)


def text_runs(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    """A batch's texts in runs of about ``size`` bytes; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        j = min(j, len(column))
        yield Texts(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], i)
        i = j


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
