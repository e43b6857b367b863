"""Substring dedup against plain Python over all windows."""

import hashlib
import random

import pytest
from tests.llm.conftest import sentence

from campaignry.llm import windows


def plain(given, size):
    """Removed words by the definition; a missing id lies behind all others."""
    texts = [((i is None, i or 0), (t or "").replace("\x00", "\x00").split()) for i, t in given]
    least = {}
    for i, w in texts:
        for k in range(len(w) - size + 1):
            s = tuple(w[k: k + size])
            least[s] = min(least.get(s, i), i)
    out = []
    for (i, w), (doc, _) in zip(texts, given):
        gone = set()
        for k in range(len(w) - size + 1):
            if least[tuple(w[k: k + size])] < i:
                gone |= set(range(k, k + size))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def key(r):
    return tuple((x is None, x) for x in r)


@pytest.mark.parametrize("chunk_bytes", [1, 700, 1 << 23])
def test_against_all_windows(spark, documents, chunk_bytes):
    rng = random.Random(8)
    passages = [sentence(rng, 12) for _ in range(4)]
    given = [(rng.choice([None, *range(40)]), " \n".join(rng.choice([sentence(rng, rng.randint(0, 9)), rng.choice(passages)]) for _ in range(rng.randint(0, 5))))
             for _ in range(120)]
    given += [(7, None), (8, ""), (9, " \t "), (3, "z " * 30), (2, "z " * 12), (5, "z " * 5), (6, "é " * 11 + "x"), (11, "é " * 11)]
    given += [given[0], given[0]]
    plan = windows.WindowPlan(words=10, chunk_bytes=chunk_bytes, range_bytes=256)
    rows = windows.cut_documents(documents(given).repartition(3), plan).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=key) == sorted(plain(given, 10), key=key)
    for r in rows:  # maximal intervals: apart from each other, their lengths the removed words
        spans = list(zip(r["starts"] or [], r["ends"] or []))
        assert sum(b - a for a, b in spans) == r["n_removed"] and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_copies_shorter_than_a_window_stay(documents):
    short, long = " ".join(f"w{i}" for i in range(49)), " ".join(f"w{i}" for i in range(50))
    rows = {r["doc_id"]: r["n_removed"] for r in windows.cut_documents(documents([(1, short), (2, short), (3, long), (4, long)])).collect()}
    assert rows == {1: 0, 2: 0, 3: 0, 4: 50}


def test_very_long_text_and_empty_table(documents):
    words = [f"w{i}" for i in range(60_000)]
    rows = windows.cut_documents(documents([(1, " ".join(words)), (2, " ".join(words[100:200])), (3, "w5 " * 20_000)])).collect()
    by = {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in rows}
    assert by[1][:2] == (60_000, 0) and by[2] == (100, 100, hashlib.sha256(b"").hexdigest()) and by[3][1] == 0
    assert windows.cut_documents(documents([])).collect() == []
