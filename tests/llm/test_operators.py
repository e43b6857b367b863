"""The corpus operators against plain Python on small fixtures, and on awkward input."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.llm.conftest import sentence

import corpus_pipeline
from campaignry.llm import components, counting, exact, jaccard, licenses, mixing, pieces, quality, queries, secrets, sharding, warc
from campaignry.session import local_frame

SMALL = "/root/testdata/sf0.001"
SPACE = re.compile(r"[\x20\x09-\x0D]+")
AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "one"), (None, None), (5, "x" * 50_000), (6, "é ü 😀 ▁ a\x00b"),
           (7, "a b c d e f"), (8, "A b  c d e f"), (9, "word " * 20_000)]


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in ("pipeline", "op1_warc", "op10_quality_rules", "op13_centroids")])
def test_awkward_and_empty_documents(name, spark, documents, monkeypatch):
    for given in (AWKWARD, []):
        monkeypatch.setattr(queries, "table", lambda *_: documents(given))
        got = rows(queries.queries()[name](spark, "none"))
        assert len(got) == len(given)
        ids = lambda xs: sorted((x for x in xs), key=lambda v: (v is None, v or 0))
        assert ids(r["doc_id"] for r in got) == ids(d[0] for d in given)


# Exact duplicates

def test_exact_duplicates(documents):
    given = [(5, "a  b"), (3, "a\tb"), (9, "a b "), (3, "a b"), (7, None), (8, ""), (None, "a b")]
    got = rows(exact.exact_duplicates(documents(given)))
    by = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got)
    assert by == Counter({(5, 3, 4, False): 1, (3, 3, 4, True): 1, (3, 3, 4, False): 1, (None, 3, 4, False): 1, (9, 9, 1, True): 1,
                          (7, 7, 2, True): 1, (8, 7, 2, False): 1})
    assert {r["text_sha256"] for r in got if r["doc_id"] == 5} == {hashlib.sha256(b"a b").hexdigest()}
    kept = rows(exact.drop_exact_duplicates(documents(given)))
    assert sorted(r["doc_id"] for r in kept) == [3, 7, 9] and set(kept[0]) == {"doc_id", "text", "lang", "source", "n_chars", "size", "kept", "hash"}
    assert sorted(r["doc_id"] for r in rows(exact.drop_exact_duplicates(documents([(1, "x"), (2, "x"), (3, "y")])))) == [1, 3]


# Mixing

def test_mix_targets_and_words(documents):
    rng = random.Random(2)
    given = [(i, sentence(rng, rng.randint(1, 60)), s) for i, s in enumerate(["b"] * 300 + ["a"] * 40 + [None] * 60 + ["c"] * 5)]
    got = rows(mixing.mix(documents(given)))
    size = {i: len(t.split()) for i, t, _ in given}
    total, sources = sum(size.values()), sorted({s for *_, s in given}, key=lambda s: (s is None, s or ""))
    own = {s: sum(size[i] for i, _, x in given if x == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, open_, left = {}, set(sources), 1.5 * total
    while True:  # reshare by weight until none is above its cap
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * own[s]}
        if not full:
            break
        for s in full:
            target[s] = 2.0 * own[s]
            left -= target[s]
        open_ -= full
        if not open_:
            break
    target |= {s: weight[s] * left / sum(weight[x] for x in open_) for s in open_}
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == own[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["taken"] >= (r["target"] // r["source_size"]) * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 31 for s in sources)  # half of the largest document
    again = mixing.mixed_documents(documents(given))
    assert sum(len(r["text"].split()) for r in rows(again)) == sum(taken.values())


def test_mix_prefers_good_documents(documents):
    given = [(i, ("word " * 10) if i % 2 else ("##### " * 10)) for i in range(400)]
    got = rows(mixing.mix(documents(given), mixing.MixPlan(share_pct=50)))
    good = sum(r["taken"] for r in got if r["doc_id"] % 2)
    assert good > 3 * sum(r["taken"] for r in got if not r["doc_id"] % 2)


# Sharding

def test_shards_are_even_and_groups_whole(documents):
    rng = random.Random(4)
    texts = [sentence(rng, rng.randint(1, 80)) for _ in range(500)]
    given = [(i, t) for i, t in enumerate(texts + texts[:50] + texts[:50])]
    got = rows(sharding.shard(documents(given)))
    by, homes = defaultdict(list), defaultdict(set)
    for r in got:
        by[r["shard"]].append(r)
        homes[given[r["doc_id"]][1]].add(r["shard"])
        assert r["size"] == len(given[r["doc_id"]][1].encode()) + 1
    assert set(by) == set(range(16)) and all(len(h) == 1 for h in homes.values())
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by.values())
    sums = [sum(r["size"] for r in rs) for rs in by.values()]
    assert max(sums) - min(sums) < 0.01 * max(sums)


def test_a_group_of_a_third_of_all_rows_is_dealt_out(documents):
    given = [(i, "the same text " * 3) for i in range(300)] + [(300 + i, f"text number {i} " * 3) for i in range(600)]
    got = rows(sharding.shard(documents(given)))
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) < 1.05 * min(sums.values())


def test_groups_up_to_a_shard_stay_whole(documents):
    other = [f"text number {i:04d} of many" for i in range(2000)]
    share = sum(len(t) + 1 for t in other) / 16
    given = other + ["half a shard of copies"] * round(0.55 * share / 23) + ["nearly a whole one of copies"] * round(0.95 * share / 29)
    given += ["two and a half shards and so on"] * round(3.2 * share / 31)
    total = sum(len(t) + 1 for t in given) / 16
    homes, sums = defaultdict(set), Counter()
    for r in rows(sharding.shard(documents(list(enumerate(given))))):
        homes[given[r["doc_id"]]].add(r["shard"])
        sums[r["shard"]] += r["size"]
    assert [len(homes[t]) for t in given[2000:]] == [1 if t[0] in "hn" else 3 for t in given[2000:]]
    assert all(len(homes[t]) == 1 for t in other) and max(sums.values()) < 1.02 * total


# N-gram join

def brute_components(given):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in given:
        w = [x for x in SPACE.split((t or "").translate(lower)) if x]
        sets.append({tuple(w[j: j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    home = list(range(len(given)))

    def find(i):
        while home[i] != i:
            i = home[i]
        return i
    for i in range(len(given)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                home[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(given):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(given)}


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else rng.choice(["q", "r", "s"]) + str(rng.random()) for w in text.split())


@pytest.mark.parametrize("plan", [jaccard.JoinPlan(), jaccard.JoinPlan(block=8, members=5, buckets=256, max_signature_bits=256)])
def test_components_match_brute_force(documents, plan):
    rng = random.Random(6)
    texts = [sentence(rng, rng.choice([3, 4, 5, 6, 20, 60, 200])) for _ in range(60)]
    passage, base = sentence(rng, 60), sentence(rng, 120)
    texts += [edited(rng, t, s) for t in texts[:40] for s in (0.0, 0.01, 0.03)]
    texts += [sentence(rng, 10) + " " + passage + " " + sentence(rng, 12) for _ in range(25)]
    texts += [edited(rng, base, 0.025) for _ in range(60)]  # a group whose members are near the threshold
    chain = sentence(rng, 100).split()
    for _ in range(30):  # each one linked with its neighbours only
        chain = chain[6:] + sentence(rng, 6).split()
        texts.append(" ".join(chain))
    order = list(range(len(texts)))
    rng.shuffle(order)
    given = [(i, texts[k].upper() if k % 7 == 0 else texts[k].replace(" ", "\n ")) for i, k in enumerate(order)] + [(900, None), (901, " "), (902, "x")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(jaccard.near_duplicates(documents(given), plan))}
    assert got == brute_components(given)
    kept = {r["doc_id"] for r in rows(jaccard.drop_near_duplicates(documents(given), plan))}
    assert kept == {c for _, c in got.values()}


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 200))) for _ in range(2))
        x, y = jaccard.signature(a, 512), jaccard.signature(b, 512)
        w = min(len(x), len(y))
        assert jaccard.overlap_bound(jaccard.folded(x, w), jaccard.folded(y, w), len(a), len(b)) >= len(np.intersect1d(a, b))


def test_rows_without_id_keep_their_links(documents):
    """The doubles of a text without id go, where its text also has an id or not; links pass through texts without id."""
    words = [f"w{i}" for i in range(60)]
    text = lambda *gone: " ".join(w for i, w in enumerate(words) if i not in gone)
    stay = lambda given: sorted(((r["doc_id"], r["text"]) for r in rows(jaccard.drop_near_duplicates(documents(given)))), key=str)
    assert stay([(None, text()), (1, text()), (None, "")]) == [(1, text()), (None, "")]
    assert stay([(None, text()), (None, text())]) == [(None, text())]
    assert stay([(None, text()), (5, text(0)), (7, text(0)), (7, text(0))]) == [(5, text(0))]
    assert stay([(4, text()), (4, text()), (4, "else " * 9)]) == sorted([(4, text()), (4, "else " * 9)], key=str)
    chain = [(9, text(*range(10))), (None, text()), (3, text(*range(50, 60)))]  # 46, 56 and 46 shingles; the ends share 36 of 56
    assert {r["component_id"] for r in rows(jaccard.near_duplicates(documents(chain)))} == {3}
    assert stay([]) == []


def test_blocks_write_no_pairs(spark):
    """Sets that all pass the bound with each other: a tree, not all pairs, from either block step."""
    rng, plan = np.random.default_rng(6), jaccard.JoinPlan()
    base = np.unique(jaccard.mixed(np.arange(400, dtype=np.uint64)))
    sets = [np.sort(rng.choice(base, 370, replace=False)) for _ in range(60)]
    sig = [jaccard.signature(x, plan.max_signature_bits).tobytes() for x in sets]
    n = len(sets)
    block = {"key": [1] * n, "band": [2] * n, "component": [1] * n, "i": [0] * n, "j": [0] * n, "node": list(range(n)), "n": [370] * n,
             "comp": list(range(n)), "home": [True] * n, "block": [0] * n, "signature": sig, "shingles": [x.tobytes() for x in sets]}
    for step in (jaccard._forest, jaccard._joining):
        assert sum(len(b) for b in step(plan)([pa.RecordBatch.from_pydict(block)])) == n - 1
    block["comp"] = [0] * n
    assert sum(len(b) for b in jaccard._joining(plan)([pa.RecordBatch.from_pydict(block)])) == 0


@pytest.mark.parametrize("edges_of_a_task", [10, 1 << 17])
def test_connected_components(spark, monkeypatch, edges_of_a_task):
    monkeypatch.setattr(components, "EDGES", edges_of_a_task)
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 200) if i % 50] + [(1000, 1000 + i) for i in range(1, 60)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(80)]
    home = {}

    def find(x):
        home.setdefault(x, x)
        while home[x] != x:
            x = home[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        home[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in rows(components.components(local_frame(spark, edges, "u long, v long")))}
    loops = {a for a, b in edges if a == b} - {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in home if x not in loops}


# Pieces

def encoded(texts, drop):
    vocab = pieces.Vocabulary(pieces.read_model())
    ids, sizes = [], []
    for run in pieces.text_runs(pa.array(texts)):
        x, n = pieces.encode_run(vocab, run, np.arange(run.first, run.first + run.n).astype(np.uint64), drop)
        ids.append(x)
        sizes.append(n)
    at = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    return vocab, [np.concatenate(ids)[a:b] for a, b in zip(at[:-1], at[1:])]


TEXTS = ["Hello  world\n\tfoo", "", " ", "a▁b", "ﬁ é a\xa0b", "x" * 300 + " yyyy", " 日本語 テスト 😀😀", "the the the " * 50, "a" * 30 + "thequickbrown" * 4]


def test_pieces_equal_the_reference_encoder_without_dropout():
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    _, got = encoded(TEXTS, pieces.Dropout(rate=0.0))
    for text, ids in zip(TEXTS, got):
        if pieces.SPACE not in text:
            assert ids.tolist() == model.encode(text)


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.6, 1.0])
def test_pieces_decode_losslessly_and_repeat(rate):
    vocab, got = encoded(TEXTS, pieces.Dropout(rate=rate))
    assert [pieces.decode_ids(vocab, ids).decode() for ids in got] == TEXTS
    assert all((a == b).all() for a, b in zip(got, encoded(TEXTS, pieces.Dropout(rate=rate))[1]))
    if 0 < rate < 1:
        assert any(a.tolist() != b.tolist() for a, b in zip(got, encoded(TEXTS, pieces.Dropout(rate=rate, seed=1))[1]))


def plain_agenda(text, doc_key, drop):
    """The agenda of one text, word by word, in ordinary Python."""
    whole = 2**64

    def mix(x):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * factor % whole
        return x ^ x >> 31
    model = pieces.read_model()
    number = {p: i for i, (p, _, kind) in enumerate(model) if not kind}
    order = {i: r for r, i in enumerate(sorted(number.values(), key=lambda i: (-model[i][1], i)))}
    byte = {int(p[3:-1], 16): i for i, (p, _, kind) in enumerate(model) if kind == 1}
    out = []
    for serial, word in enumerate(re.findall(" +[^ ]*", " " + text) if text else []):
        raw = np.frombuffer(word.encode(), np.uint8)
        h = int(pieces.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
        key = mix(h ^ (drop.seed * 0xD6E8FEB86659FD93 + 1) % whole ^ mix(doc_key ^ serial * 0xA0761D6478BD642F % whole))
        parts = []  # (string of the piece or None for a byte, id, place)
        for c in word:
            c = pieces.SPACE if c == " " else "" if c == pieces.SPACE else c
            ids = [(c, number[c])] if c in number else [(None, byte[x]) for x in (c or pieces.SPACE).encode()]
            parts += [(p, i, len(parts) + k) for k, (p, i) in enumerate(ids)]
        while True:
            open_ = []
            for k, ((p, _, place), (q, _, _)) in enumerate(zip(parts, parts[1:])):
                made = number.get(p + q) if p and q else None
                if made is not None and mix(key ^ (place << 32 | order[made]) * 0x9E3779B97F4A7C15 % whole) >= int(drop.rate * 2.0**64):
                    open_.append((order[made], k, p + q, made, place))
            if not open_:
                break
            _, k, string, made, place = min(open_)
            parts[k: k + 2] = [(string, made, place)]
        out += [i for _, i, _ in parts]
    return out


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5])
def test_pieces_equal_a_plain_agenda(rate):
    rng = random.Random(7)
    words = ["thequickbrownfoxjumpsoverthelazydog", "abcabcabcabcabcabcabcabcabcabc", "international", "the", "of", "naïve", "日本語", "x" * 70]
    texts = [*TEXTS, *words, *(" ".join(rng.choice(words) for _ in range(60)) for _ in range(4))]
    drop = pieces.Dropout(rate=rate)
    assert [ids.tolist() for ids in encoded(texts, drop)[1]] == [plain_agenda(t, i, drop) for i, t in enumerate(texts)]


def test_encode_and_decode_tables(documents):
    given = [(1, "one  two\n"), (None, None), (3, "a▁b"), (3, "")]
    back = rows(pieces.decode(pieces.encode(documents(given), pieces.Dropout(rate=0.4))))
    assert sorted(((r["doc_id"], r["decoded"]) for r in back), key=str) == sorted(((i, t or "") for i, t in given), key=str)
    assert all(r["decoded_sha256"] == r["text_sha256"] for r in back)


def test_every_occurrence_is_cut_on_its_own(documents, monkeypatch):
    text = "international " * 400
    drop = pieces.Dropout(rate=0.3)
    vocab, (ids,) = encoded([text], drop)
    parts = [bytes(vocab.text[at: at + n]).decode() for at, n in zip(vocab.text_at[ids].tolist(), vocab.text_size[ids].tolist())]
    assert len(set("|".join(parts).split(" "))) > 20
    rng = random.Random(4)
    texts = [*TEXTS, text, *(sentence(rng, 300) for _ in range(5))]
    shared = encoded(texts, drop)[1]
    monkeypatch.setattr(pieces, "SHARED", 0)
    assert all(a.tolist() == b.tolist() for a, b in zip(shared, encoded(texts, drop)[1]))


def test_copies_are_cut_differently(documents, spark):
    text = sentence(random.Random(3), 200)
    docs = documents([(1, text), (1, text)])
    a, b = (r["ids"] for r in rows(corpus_pipeline.encode_pieces(spark, docs, "")))
    c, d = (r["ids"] for r in rows(pieces.encoded_documents(docs)))
    assert a != b and c == d and c in (a, b)


# Secrets and licenses

def test_secret_spans(documents):
    key = "AKIA" + "B" * 16
    given = [(1, f"é password = 'abcdefghijkl' {key}"), (2, "secret=token:abcdefghijklmnop"), (3, "pwd: hunter2x"),
             (4, "user: bob pwd: hunter2x"), (5, "deadbeef" * 3 + " AKIASHORT"), (6, "user: bob " + "z " * 300 + "pwd: hunter2x")]
    got = {r["doc_id"]: r for r in rows(secrets.secret_scan(documents(given)))}
    assert got[1]["spans"] == f"assign:2:26,access:28:{28 + 20}" and (got[1]["n_assign"], got[1]["n_access"], got[1]["n_hex"]) == (1, 1, 0)
    assert got[1]["base_sha256"] == hashlib.sha256(got[1]["spans"].encode()).hexdigest()
    assert got[2]["n_assign"] == 0 and got[3]["spans"] == "" and got[6]["spans"] == ""
    assert got[4]["spans"] == "linked:10:23" and got[4]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[5]["spans"] == "hex:0:24"


def test_license_labels(documents):
    given = [(1, "Released under the MIT License, see LICENSE."), (2, "CC BY-NC cc by nc 4.0"), (3, "under the Apache License, Version 2.0 or so"),
             (4, "nothing here"), (5, "SPDX-License-Identifier: GPL"), (6, "under the mit licenses")]
    got = {r["doc_id"]: r for r in rows(licenses.license_scan(documents(given)))}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["base_labels"], got[1]["labels"]) == (1, 1, "mit", "mit")
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"], got[2]["labels"]) == (2, 0, 3, "cc-by-nc")
    assert got[3]["base_labels"] == "apache-2" and got[3]["labels"] == "apache-2" and 0 < got[3]["score"] <= 1
    assert (got[4]["labels"], got[4]["score"], got[4]["first_word"], got[4]["n_words"]) == ("", 0.0, None, 2)
    assert got[6]["n_base"] == 0
    assert len(licenses.rules()) > 250


def test_license_prefilters_drop_nothing(documents, monkeypatch):
    texts = ["Distributed under the terms of the Apache 2.0 license.", "Published under CC0 1.0", "Licensed under the Expat License", "under the FreeBSD 2 clause licence",
             "modified BSD license", "Available under the original BSD Licence", "version 2.1.0"]
    for *_, words in licenses._worded():
        words = words.split()
        texts.append("x. " + " ".join(w.rstrip("?").split("|")[0] for w in words) + ".")
        texts.append(", ".join(w.split("|")[-1] for w in words if not w.endswith("?")).upper())
    labels = lambda: {r["doc_id"]: (r["labels"], r["score"]) for r in rows(licenses.license_scan(documents(list(enumerate(texts)))))}
    got = labels()
    assert [got[i][0] for i in range(7)] == ["apache-2", "cc0", "mit", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", ""]
    assert all(got[i][0] for i in range(7, len(texts)))
    assert all(keyword.strip() for _, _, keyword, *_ in licenses.rules())
    listed = [(i, label, "", *rest) for i, label, _, *rest in licenses.rules()]
    monkeypatch.setattr(licenses, "GATE", "")
    monkeypatch.setattr(licenses, "rules", lambda: listed)
    assert labels() == got


# Token counts

def test_edits_keep_the_counts_right():
    counter, rng = counting.Counter(counting.read_ranks()), random.Random(8)
    for text in ["", "a", sentence(rng, 500), "  \n\n  x\t\t y  " * 40, "it's we'll " * 60, "é" * 200 + "1234 " * 50]:
        state = counting.State.of(counter, text)
        for _ in range(25):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 5, 80]))
            state, text, _ = state.edited(counter, text, a, b, rng.choice(["", " ", "\n ", "word", " it's", "'s", "12"]))
            assert state.total == len(counter.encoding.encode_ordinary(text)) and sum(state.lengths) == len(text)
            assert state.nodes == counting.tree(state.nodes[: len(state.lengths)])


def test_edits_behind_blanks_and_contractions_at_leaf_borders():
    counter = counting.Counter(counting.read_ranks())
    for unit in ("x  ", "x   y", "'rx", "'lx'vx", "a\n\n b", "  "):
        for pad in range(counting.LEAF + 1):
            text = " w" * pad + unit * 40
            state, at = counting.State.of(counter, text), 0
            for n in state.lengths:
                at += n
                for start in range(max(0, at - 1), min(len(text), at + 3) + 1):
                    for new in (" insb", "e", "l"):
                        after, changed, _ = state.edited(counter, text, start, start + (new != " insb"), new)
                        assert after.total == len(counter.encoding.encode_ordinary(changed)), (unit, pad, start, new)


def test_edits_touch_little(documents):
    text = sentence(random.Random(1), 5000)
    docs = documents([(1, text), (2, None)])
    got = {r["doc_id"]: r for r in rows(counting.counted_after_edits(docs, counting.sample_edits(docs["text"])))}
    assert 0 < got[1]["reencoded_chars"] < len(text) / 10 and got[2]["n_tokens_before"] == 0 and got[2]["n_tokens"] == 3


# Quality

def counted(text):
    w = [x for x in SPACE.split(text or "") if x]
    seen = Counter(tuple(w[j: j + 3]) for j in range(len(w) - 2))
    covered = {j + s for j in range(len(w) - 2) if seen[tuple(w[j: j + 3])] > 1 for s in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE.sub("", line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_counts_match_brute_force(documents, spark):
    rng = random.Random(5)
    given = AWKWARD + [(100 + i, "\n".join(rng.choice(["a b c", "", " ", "d e f é#", "x y"]) for _ in range(rng.randint(0, 30)))) for i in range(40)]
    labels = local_frame(spark, [], "doc_id long, quality int, toxic int")
    got = rows(quality.quality_rules(documents(given), labels))
    want = Counter((d, *counted(t)) for d, t in given)
    assert Counter((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and r["kept"] == (not r["base_failed"])


def test_classifier_on_held_out_rows(spark):
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels"))
    half = quality.quality_rules(docs, labels.filter("doc_id % 2 = 0"))
    held = half.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed").select("quality", "kept").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in held)
    assert len(held) > 100 and right / len(held) > 0.97


# Archive

def test_archive_round_trip(spark):
    pages = [(1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b", None), (4, "http://c", ""), (5, "http://d", "x" * 70_000 + "\r\n\r\ny"),
             (2, "http://again", "<p>é</p>"), (None, "http://e", "z")]
    got = rows(warc.archived_pages(local_frame(spark, pages, "page_id long, url string, html string")))
    assert len(got) == len(pages)
    sha = lambda s: base64.b32encode(hashlib.sha1(s.encode()).digest()).decode()
    full = {p: h or "" for p, _, h in pages}
    for r in got:
        assert r["payload_digest"] == sha(full[r["page_id"]]) and r["payload_bytes"] == len(full[r["page_id"]].encode())
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter({(1, "revisit", 2): 1, (2, "response", None): 1, (2, "revisit", 2): 1, (3, "revisit", 4): 1, (4, "response", None): 1,
                             (5, "response", None): 1, (None, "response", None): 1})
    assert rows(warc.archived_pages(local_frame(spark, [], "page_id long, url string, html string"))) == []
    large = rows(warc.archived_pages(local_frame(spark, pages[:2], "page_id long, url string, html string"), min_revisit_bytes=100))
    assert all(r["record_type"] == "response" for r in large)


def test_a_damaged_record_is_refused():
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC/1.0\r\n\r\n")
    head = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1:0>\r\nWARC-Payload-Digest: sha1:"
            + base64.b32encode(hashlib.sha1(b"abc").digest()) + b"\r\nContent-Length: %d\r\n\r\n")
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    assert warc.parse_record(head % len(block) + block + b"\r\n\r\n")[4] == 3
    with pytest.raises(ValueError):
        warc.parse_record(head % len(block) + block.replace(b"abc", b"abd") + b"\r\n\r\n")
