"""Alignment of two tokenizers against a plain walk over whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from campaignry.llm import align

TEXTS = [None, "", " ", "  ", "a", " a", "a b ", "a  b", "a\n  b", "a \nb", "don't you'll x's", "<|endoftext|> <s> <unk>", "x▁y", "▁", "a\x00b", "é ü 😀 漢字 かな",
         "tab\t\ttab", "nb\u00a0 sp \u3000 x", "12 345,6 -- !!", "x" * 5000, "word " * 3000, "one\r\n two\x0b three", "end  ", "ǅ ß ﬁ"]


def walked(rows):
    """The contract's numbers by whole texts, one token after the other, with the libraries' own encoders."""
    import sentencepiece
    import tokenizers

    pieces = sentencepiece.SentencePieceProcessor(model_file=align.PIECE_FILE)
    merges = tokenizers.Tokenizer.from_file(align.BYTE_FILE)
    merges.encode_special_tokens = True
    sign = align.byte_of_sign()
    raw_a = {i: bytes(sign[c] for c in t) for t, i in merges.get_vocab(with_added_tokens=False).items() if all(c in sign for c in t)}

    def raw_b(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    found, seen = [], Counter()
    for _, text in rows:
        whole = (" " + (text or "")).encode()
        a = merges.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if not text or b"".join(raw_a[i] for i in a) != whole or b"".join(raw_b(i) for i in b) != whole:
            found.append(None)
            continue
        ends = np.cumsum([len(raw_a[i]) for i in a]).tolist(), np.cumsum([len(raw_b(i)) for i in b]).tolist()
        i = j = x = y = 0
        links, groups = [], []
        while i < len(a):
            links.append((a[i], b[j]))
            e, f = ends[0][i], ends[1][j]
            i, j = i + (e <= f), j + (f <= e)
            if e == f:
                groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
                x, y = i, j
        seen.update(links)
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (_, b), n in seen.items():
        top[b] = max(top[b], n)
    return [(i, 0, 0, 0, 0, 0, 0, "") if r is None else
            (i, *r[:3], len(r[3]), sum(seen[x] == top[x[1]] for x in r[3]), sum(seen[x] for x in r[3]), r[4]) for (i, _), r in zip(rows, found)]


@pytest.mark.parametrize("chunk_bytes", [1, 1 << 23])
def test_against_a_walk_over_whole_texts(spark, documents, chunk_bytes):
    rng = random.Random(3)
    signs = "ab éß漢1.,'\n\t  "
    given = [(i, t) for i, t in enumerate(TEXTS + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 80))) for _ in range(80)])]
    given += [(None, "a b"), (4, "a"), (4, "a")]
    got = align.aligned_documents(documents(given).repartition(3), align.AlignPlan(chunk_bytes=chunk_bytes)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(walked(given), key=key)


def test_empty_table_has_no_rows(documents):
    assert align.aligned_documents(documents([])).collect() == []


def test_pairs_of_the_corpus(documents):
    rows = align.token_pairs(documents([(1, "the cat"), (2, "the cat"), (3, "the dog")])).collect()
    by = {(r["a"], r["b"]): (r["links"], r["best"]) for r in rows}
    assert max(by.values()) == (3, True) and sum(n for n, _ in by.values()) >= 6


def test_gallop_finds_the_places_of_a_plain_search():
    rng = np.random.default_rng(5)
    for n, m in [(0, 0), (0, 5), (1, 0), (1, 1), (7, 100), (100, 100), (1000, 3000)]:
        for top in (3, 50, 100_000):
            short, long = (np.sort(rng.integers(0, top, k)) for k in (n, m))
            assert (align.gallop(short, long) == np.searchsorted(long, short)).all()
