"""Differencing against a plain form and the optimum of small cases; checksums and sizes against the standard library."""

import random
import zlib
from itertools import product

from campaignry.llm import sharding


def plain(sizes, shards):
    """Differencing by its definition: scan for the two partial partitions of largest spread, combine them oppositely ordered."""
    parts = [(i, [s] + [0] * (shards - 1)) for i, s in enumerate(sizes)]
    serial = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (min(p[1]) - max(p[1]), p[0]))
        (_, a), (_, b), *parts = parts
        parts.append((serial, sorted((x + y for x, y in zip(sorted(a, reverse=True), sorted(b))), reverse=True)))
        serial += 1
    return parts[0][1]


def items(sizes, shards):
    return [([s] + [0] * (shards - 1), [[(i,)]] + [[]] * (shards - 1)) for i, s in enumerate(sizes)]


def test_differencing_equals_its_definition():
    rng = random.Random(4)
    for _ in range(60):
        shards = rng.randint(2, 6)
        sizes = [rng.choice([rng.randint(1, 20), rng.randint(1, 5000)]) for _ in range(rng.randint(1, 40))]
        sums, groups = sharding.differenced(items(sizes, shards), shards)
        held = [[i for (i,) in sharding.members(g)] for g in groups]
        assert sums == plain(sizes, shards) and [sum(sizes[i] for i in h) for h in held] == sums
        assert sorted(i for h in held for i in h) == list(range(len(sizes)))


def test_differencing_stays_near_the_optimum():
    rng = random.Random(9)
    for _ in range(25):
        sizes = [rng.randint(1, 60) for _ in range(8)]
        best = min(max(sum(s for s, p in zip(sizes, way) if p == k) for k in range(2)) for way in product(range(2), repeat=8))
        largest = max(sharding.differenced(items(sizes, 2), 2)[0])
        assert best <= largest <= best * 7 / 6 + 1  # the bound of two-way differencing


def test_sizes_and_checksums(documents):
    texts = ["", None, "abc", "é€𝄞", "x" * 5000, "abc"]
    got = {r["doc_id"]: r for r in sharding.shard(documents(list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        assert (got[i]["size"], got[i]["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
    assert got[2]["shard"] == got[5]["shard"]
