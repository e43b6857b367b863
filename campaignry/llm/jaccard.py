"""Exact n-gram Jaccard self-join of whole documents, and the connected groups it leaves.

A document is the set of 64-bit hashes of its shingles; documents of one set are one node. Two linked sets share a
shingle within the first n - ceil(t n) + 1 of either in any common order, so only that prefix is sent out. The order
puts shingles of crowded hash buckets last; the bucket counts cover all documents and have a fixed size, which is what
bounds the one broadcast. Shingles that one node alone has are dropped where their hash range meets.

A tile is a shingle and a size band. Bands grow by the ratio of a link, so linked sets lie in one band or in
neighbouring ones: every node stands at home in its own band and as a guest in the next, and guests are held against
those at home only.

1. In each tile all nodes are held against its smallest node and two drawn by hash; then, tile by tile, the nodes outside
   the commonest component against a drawn member of it. Both are linear in the tile; links are contracted to components.
2. Tiles that still hold several components go through all pairs across components in blocks of bounded size. A bit
   count of the signatures bounds the overlap from above. A block tells only which nodes are joined by pairs that pass:
   a forest, one row less than its nodes.
3. The trees of all blocks form groups, in which every pair that passed has both ends. Each node's set goes to its group
   once (per block of a large group); there the bound and then the intersection of the sorted arrays decide, and only
   links that join two components come out.

Pairs inside a component need no decision, so a group of n near copies costs about n comparisons and no link between
components is lost. No step writes a row per pair of a group.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignry.llm.batches import list_array, mixed, text_runs
from campaignry.llm.components import components
from campaignry.llm.planes import pack, unpack
from campaignry.session import cut_lineage

CHUNK = 4096  # counters per row while the bucket counts are summed
SENT = 1 << 19  # prefix shingles of a task that are combined before they are dealt out


@dataclass(frozen=True)
class JoinPlan:
    words: int = 5
    percent: int = 75  # similarity of a link, as a whole per cent
    buckets: int = 1 << 18  # counters of the shingle order
    block: int = 1024  # nodes of one side of a block
    block_shingles: int = 1 << 20  # and shingles of one side of a block of sets
    members: int = 2048  # sets per task group while pairs are decided
    rounds: int = 1  # rounds against the commonest component of a tile
    range_shingles: int = 1 << 19  # prefix shingles of a range of hashes
    max_signature_bits: int = 1 << 15

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, a, b):
        """Least intersection of linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def range_bits(self, shingles: int) -> int:
        return min(max(shingles // (4 * self.range_shingles), 1).bit_length(), 24)


def shingle_sets(column: pa.Array, k: int):
    """(row, sorted distinct shingle hashes) for each text with a word."""
    for texts in text_runs(column):
        words = texts.words(lower=True)
        h = words.hashes()
        salted = [mixed(h + np.uint64(0x9E3779B97F4A7C15 * (j + 1) % 2**64)) for j in range(k)]
        run = np.zeros(max(len(h) - k + 1, 0), np.uint64)
        for j, s in enumerate(salted):
            run += s[j: j + len(run)]
        run = mixed(run)
        for d in range(texts.n):
            lo, hi = words.first[d], words.first[d + 1]
            if hi - lo >= k:
                yield texts.first + d, np.unique(run[lo: hi - k + 1])
            elif hi > lo:
                short = sum((int(salted[j][lo + j]) for j in range(hi - lo)), 1 + int(hi - lo)) % 2**64
                yield texts.first + d, mixed(np.array([short], np.uint64))


def node_of(shingles: np.ndarray) -> int:
    """Name of a set: a 63-bit hash of its sorted members and its size."""
    weights = mixed(np.arange(len(shingles), dtype=np.uint64) + np.uint64(len(shingles) * 0x9E3779B97F4A7C15 % 2**64))
    total = np.bitwise_xor.reduce(mixed(shingles ^ weights))
    return int(mixed(np.array([total]))[0] >> np.uint64(1))


def signature_bits(n: int, most: int) -> int:
    return min(max(128, 1 << (8 * n - 1).bit_length()), most)


def signature(shingles: np.ndarray, most: int) -> np.ndarray:
    bits = np.zeros(signature_bits(len(shingles), most), np.uint8)
    bits[shingles & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def folded(sig: np.ndarray, words: int) -> np.ndarray:
    """A signature at a smaller width: the low bits of the hash pick the bit at any width."""
    return np.bitwise_or.reduce(sig.reshape(-1, words), axis=0)


def overlap_bound(a: np.ndarray, b: np.ndarray, na, nb):
    """Upper bound of the intersection: every bit that only one side has stands for a shingle the other lacks."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(na - only_a, nb - only_b)


NODES = "doc_id long, digest long, n long, node long, signature binary, chunk int, counts binary"


def _profile(plan: JoinPlan):
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
                        ("signature", pa.binary()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(plan.buckets, np.int64)
        for batch in batches:
            n, node, sig = np.zeros(len(batch), np.int64), np.full(len(batch), -1, np.int64), [None] * len(batch)
            waiting, held = [], 0
            for row, shingles in shingle_sets(batch.column("text"), plan.words):
                n[row], node[row] = len(shingles), node_of(shingles)
                sig[row] = signature(shingles, plan.max_signature_bits).tobytes()
                waiting.append(shingles & np.uint64(plan.buckets - 1))
                held += len(shingles)
                if held > 4 * plan.buckets:
                    counts += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=plan.buckets)
                    waiting, held = [], 0
            if waiting:
                counts += np.bincount(np.concatenate(waiting).astype(np.int64), minlength=plan.buckets)
            empty = pa.nulls(len(batch))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("digest"), pa.array(n), pa.array(node, mask=node < 0), pa.array(sig, pa.binary()),
                empty.cast(pa.int32()), empty.cast(pa.binary())], schema=schema)
        if counts.any():
            parts = counts.reshape(-1, min(CHUNK, plan.buckets))
            none = [None] * len(parts)
            yield pa.RecordBatch.from_pydict({
                "doc_id": none, "digest": none, "n": none, "node": none, "signature": none,
                "chunk": list(range(len(parts))), "counts": [zlib.compress(p.tobytes(), 1) for p in parts]}, schema=schema)
    return run


def _summed(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
            part = np.frombuffer(zlib.decompress(data), np.int64)
            sums[chunk] = sums[chunk] + part if chunk in sums else part
    yield pa.RecordBatch.from_pydict({"chunk": pa.array(sums.keys(), pa.int32()), "counts": pa.array(
        [zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())})


def bucket_counts(profile: DataFrame, plan: JoinPlan) -> np.ndarray:
    """Shingles of all documents per hash bucket: ``buckets`` numbers, whatever the input."""
    rows = profile.filter("chunk IS NOT NULL").select("chunk", "counts")
    rows = rows.repartition(64, "chunk").mapInArrow(_summed, "chunk int, counts binary")
    counts = np.zeros(plan.buckets, np.int64)
    size = min(CHUNK, plan.buckets)
    for r in rows.collect():
        counts[r["chunk"] * size: (r["chunk"] + 1) * size] += np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    return counts


ENTRIES = (np.int64, np.int64, np.int32, np.uint8)  # key, node, size, kind
ASKS, TELLS, MET = 0, 1, 2  # the only node of its task with the key; one of several; the others of those
_dealt = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])


def _ranges(key: np.ndarray, node: np.ndarray, n: np.ndarray, bits: int) -> pa.RecordBatch:
    """One row per hash range. Of a key that several nodes of a task have, one tells its range, the others are dealt by node."""
    order = np.argsort(key, kind="stable")
    key, node, n = key[order], node[order], n[order].astype(np.int32)
    opens = np.ones(len(key), bool)
    opens[1:] = key[1:] != key[:-1]
    kind = np.where(opens, np.where(np.append(opens[1:], True), ASKS, TELLS), MET).astype(np.uint8)
    place = np.where(kind == MET, mixed(key.view(np.uint64) ^ node.view(np.uint64)), key.view(np.uint64))
    bucket = (place >> np.uint64(64 - bits)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[by], prepend=-1))
    out = []
    for a, b in zip(cut, np.append(cut[1:], len(by))):
        part = by[a:b]
        out.append((int(bucket[part[0]]), pack(key[part], node[part], n[part], kind[part])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _dealt)], schema=_dealt)


def _prefixes(plan: JoinPlan, counts, bits: int):
    def run(batches):
        crowd, seen, held = counts.value, set(), 0
        keys, nodes, sizes, lengths = [], [], [], []

        def row():
            return _ranges(np.concatenate(keys), np.repeat(np.array(nodes, np.int64), lengths), np.repeat(np.array(sizes, np.int64), lengths), bits)
        for batch in batches:
            for _, shingles in shingle_sets(batch.column("text"), plan.words):
                node = node_of(shingles)
                if node in seen:  # copies met by one task send their prefix once
                    continue
                seen.add(node)
                at = crowd[(shingles & np.uint64(plan.buckets - 1)).astype(np.int64)]
                p = plan.prefix(len(shingles))
                keys.append(shingles[np.lexsort((shingles, at))[:p]].view(np.int64))
                nodes.append(node)
                sizes.append(len(shingles))
                lengths.append(p)
                held += p
                if held >= SENT:
                    yield row()
                    keys, nodes, sizes, lengths, held = [], [], [], [], 0
        if keys:
            yield row()
    return run


def _shared(batches):
    """The entries of keys that several nodes have, range by range, each once."""
    schema = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("n", pa.int64())])

    def met(rows: list[bytes]) -> pa.RecordBatch:
        key, node, n, kind = (np.concatenate(c) for c in zip(*(unpack(r, *ENTRIES) for r in rows)))
        order = np.lexsort((kind, node, key))
        key, node, n, kind = key[order], node[order], n[order], kind[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        several = (node[first] != node[np.append(first[1:], len(key)) - 1]) | (np.maximum.reduceat(kind, first) > ASKS)
        keep = np.repeat(several, np.diff(np.append(first, len(key))))
        keep[1:] &= (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        return pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(node[keep]), pa.array(n[keep].astype(np.int64))], schema=schema)

    now, rows = None, []
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
            if bucket != now and rows:
                yield met(rows)
                rows = []
            now = bucket
            rows.append(data)
    if rows:
        yield met(rows)


def _ordered(a: str, b: str):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _size_ok(plan: JoinPlan, x, y):
    return F.lit(plan.percent) * F.greatest(x, y) <= 100 * F.least(x, y)


def _bounded_pairs(plan: JoinPlan):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            c = batch.to_pydict()
            keep = []
            for na, nb, sa, sb in zip(c["na"], c["nb"], c["sa"], c["sb"]):
                x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
                w = min(len(x), len(y))
                keep.append(overlap_bound(folded(x, w), folded(y, w), na, nb) >= plan.overlap(na, nb))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=schema).filter(pa.array(keep, pa.bool_()))
    return run


def _linked(own: np.ndarray, mine: np.ndarray, need: int) -> bool:
    """Exact test by merging two sorted arrays of distinct values."""
    both = np.concatenate((own, mine))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum()) >= need


def _decided(plan: JoinPlan):
    """Rows sorted by (tile, salt, member): the tile's own set comes first and is held against the others."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches):
        tile, own = None, None
        for batch in batches:
            u, v = [], []
            column = batch.column("shingles")
            for i, (t, s, member, node) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("tile", "salt", "member", "node")))):
                mine = np.frombuffer(column[i].as_buffer(), np.uint64)
                if not member:
                    tile, own = (t, s), mine.copy()
                elif tile == (t, s) and _linked(own, mine, plan.overlap(len(own), len(mine))):
                    u.append(t)
                    v.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)
    return run


def _fetched(plan: JoinPlan):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        seen = set()
        for batch in batches:
            asked = batch.column("node").to_pylist()
            nodes, sets = [], []
            for i, shingles in shingle_sets(batch.column("text"), plan.words):
                if asked[i] not in seen and node_of(shingles) == asked[i]:
                    seen.add(asked[i])
                    nodes.append(asked[i])
                    sets.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], schema=schema)
    return run


def _sets(asked: DataFrame, texts: DataFrame, nodes: DataFrame, plan: JoinPlan) -> DataFrame:
    """(node, shingles) of the nodes asked for, each from one text."""
    wanted = nodes.join(asked.distinct().hint("merge"), "node").select(
        "node", F.col("source.doc_id").alias("id"), F.col("source.digest").alias("print"))
    rows = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("print")))
    return rows.select("node", "text").mapInArrow(_fetched(plan), "node long, shingles binary")


def links(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, plan: JoinPlan) -> DataFrame:
    """The pairs (u, v) of node pairs (a, b) that are linked, by their whole sets."""
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m"))
    salts = F.floor(F.col("m") / plan.members).cast("int")
    own = sizes.select(F.col("a").alias("tile"), F.explode(F.sequence(F.lit(0), salts)).alias("salt"), F.lit(False).alias("member"),
                       F.col("a").alias("node"))
    members = pairs.join(sizes, "a").select(F.col("a").alias("tile"), F.pmod(F.xxhash64("b"), salts + 1).cast("int").alias("salt"),
                                            F.lit(True).alias("member"), F.col("b").alias("node"))
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), texts, nodes, plan)
    rows = own.unionAll(members).join(sets.hint("merge"), "node").repartition("tile", "salt").sortWithinPartitions("tile", "salt", "member")
    return cut_lineage(rows.mapInArrow(_decided(plan), "u long, v long"))


def _screened(pairs: DataFrame, nodes: DataFrame, plan: JoinPlan) -> DataFrame:
    """Pairs that pass the bit count of their signatures."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("signature").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("signature").alias("sb"))
    rows = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b").filter(_size_ok(plan, F.col("na"), F.col("nb")))
    return cut_lineage(rows.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_bounded_pairs(plan), "a long, b long"))


def _tiles(met: DataFrame, plan: JoinPlan) -> DataFrame:
    """Rows (key, band, home, node, n) of the tiles with two nodes or more, one of them at home, and the tile's lead and drawn nodes."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / plan.percent)) + 1e-9).cast("int")
    rows = met.withColumn("band", band).withColumn("home", F.explode(F.array(F.lit(True), F.lit(False))))
    rows = rows.withColumn("band", F.when(F.col("home"), F.col("band")).otherwise(F.col("band") + 1))
    drawn = F.struct(F.xxhash64("key", "node").alias("h"), "n", "node")
    tiles = rows.groupBy("key", "band").agg(
        F.count(F.lit(1)).alias("m"), F.max("home").alias("lived"), F.min(F.struct("n", "node")).alias("lead"),
        F.min(drawn).alias("low"), F.max(drawn).alias("high")).filter("m > 1 AND lived").drop("lived")
    return cut_lineage(rows.join(tiles, ["key", "band"]))


def _star_pairs(tiles: DataFrame, plan: JoinPlan) -> DataFrame:
    """Each node of a tile with its smallest node and with two drawn ones.

    The smallest is the same in most tiles of a group, so it decides most of the group at the cost of one pair a
    node; drawn ones differ from tile to tile and offer as many partners as the node has tiles.
    """
    partners = F.array("lead", F.struct("low.n", "low.node"), F.struct("high.n", "high.node"))
    pairs = tiles.select("n", "node", F.explode(partners).alias("o")).filter("o.node != node")
    return pairs.filter(_size_ok(plan, F.col("n"), F.col("o.n"))).select(*_ordered("node", "o.node")).distinct()


def _open_rows(tiles: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of the tiles that hold several components and more than two nodes: the two of a pair have been decided."""
    rows = tiles.filter("m > 2").join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    several = rows.groupBy("key", "band").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).filter("first != last")
    return cut_lineage(rows.join(several.select("key", "band"), ["key", "band"]).select("key", "band", "m", "home", "node", "n", "comp"))


def _outsider_pairs(open_rows: DataFrame, plan: JoinPlan, turn: int) -> DataFrame:
    """Each node outside a tile's commonest component with a drawn member of it."""
    drawn = F.struct(F.xxhash64("key", "node", F.lit(turn)).alias("h"), "n", "node")
    parts = open_rows.groupBy("key", "band", "comp").agg(F.count(F.lit(1)).alias("many"), F.min(drawn).alias("o"))
    lead = parts.groupBy("key", "band").agg(F.max(F.struct("many", F.col("comp").alias("most"), "o")).alias("lead"))
    rows = open_rows.join(lead.select("key", "band", "lead.most", "lead.o"), ["key", "band"]).filter("comp != most")
    return rows.filter(_size_ok(plan, F.col("n"), F.col("o.n"))).select(*_ordered("node", "o.node")).distinct()


class _Trees:
    """Union of small numbers with path halving."""

    def __init__(self, of):
        self.up = list(range(len(of)))
        first = {}
        for i, x in enumerate(of):
            self.join(first.setdefault(x, i), i)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _passing(plan: JoinPlan, n: np.ndarray, comp: np.ndarray, side: np.ndarray | None, home: np.ndarray | None, sigs: list[np.ndarray]):
    """Pairs (i, js) of rows in order of size that lie in different components and pass size and bit count."""
    width = np.array([len(s) for s in sigs])
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        # Sizes within the ratio of a link differ by less than a factor of two, widths by one step at most.
        near = np.flatnonzero((width == w) | (width == 2 * w))
        matrix = np.stack([folded(sigs[i], w) for i in near])
        for i in own:
            lo, hi = np.searchsorted(near, i, "right"), np.searchsorted(n[near], 100 * n[i] // plan.percent, "right")
            js = near[lo:hi]
            ok = comp[js] != comp[i]
            if side is not None:
                ok &= side[js] != side[i]
            if home is not None and not home[i]:
                ok &= home[js]
            js, m = js[ok], matrix[lo:hi][ok]
            if len(js):
                bound = overlap_bound(matrix[lo - 1], m, n[i], n[js])
                js = js[bound >= plan.overlap(n[i], n[js])]
                if len(js):
                    yield i, js


def _blocks(batches, names: tuple[str, ...], key: int):
    """Lists of rows of equal first columns, from sorted batches."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in names)):
            if row[:key] != now:
                if rows:
                    yield rows
                now, rows = row[:key], []
            rows.append(row)
    if rows:
        yield rows


_pairs = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _forest(plan: JoinPlan):
    """Of the pairs of a tile block that pass the bound, those that join two trees."""
    def run(batches):
        for rows in _blocks(batches, ("key", "band", "i", "j", "node", "n", "comp", "home", "block", "signature"), 4):
            rows.sort(key=lambda r: (r[5], r[4]))
            node, n, comp, home, side = (np.array([r[c] for r in rows]) for c in (4, 5, 6, 7, 8))
            trees, u, v = _Trees(node), [], []
            for i, js in _passing(plan, n, comp, None if rows[0][2] == rows[0][3] else side, home, [np.frombuffer(r[9], np.uint64) for r in rows]):
                for j in js.tolist():
                    if trees.join(int(i), j):
                        u.append(node[i])
                        v.append(node[j])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_pairs)
    return run


def _joining(plan: JoinPlan):
    """The links of a group block that join two components."""
    def run(batches):
        for rows in _blocks(batches, ("component", "i", "j", "node", "n", "comp", "block", "signature", "shingles"), 3):
            rows.sort(key=lambda r: (r[4], r[3]))
            node, n, comp, side = (np.array([r[c] for r in rows]) for c in (3, 4, 5, 6))
            trees, u, v = _Trees(comp.tolist()), [], []
            own = [np.frombuffer(r[8], np.uint64) for r in rows]
            for i, js in _passing(plan, n, comp, None if rows[0][1] == rows[0][2] else side, None, [np.frombuffer(r[7], np.uint64) for r in rows]):
                for j in js.tolist():
                    i = int(i)
                    if trees.find(i) != trees.find(j) and _linked(own[i], own[j], int(plan.overlap(n[i], n[j]))):
                        trees.join(i, j)
                        u.append(node[i])
                        v.append(node[j])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=_pairs)
    return run


def _paired_blocks(rows: DataFrame, keys: list[str], blocks) -> DataFrame:
    """Each row once for every block that it meets."""
    rows = rows.withColumn("blocks", blocks.cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    return rows.repartition(*keys, "i", "j").sortWithinPartitions(*keys, "i", "j")


def _last_links(open_rows: DataFrame, texts: DataFrame, nodes: DataFrame, plan: JoinPlan) -> DataFrame:
    """Links across the components of the open tiles, enough to join all that are linked."""
    if open_rows.isEmpty():
        return open_rows.select(F.col("node").alias("u"), F.col("comp").alias("v"))
    rows = open_rows.join(nodes.select("node", "signature").hint("merge"), "node")
    rows = _paired_blocks(rows, ["key", "band"], F.ceil(F.col("m") / plan.block))
    forest = cut_lineage(rows.mapInArrow(_forest(plan), "u long, v long").distinct())
    groups = cut_lineage(components(forest).join(nodes.select("node", "n", "signature").hint("merge"), "node"))
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("m") / plan.block), F.ceil(F.col("all") / plan.block_shingles))
    rows = groups.join(open_rows.select("node", "comp").distinct(), "node").join(sizes, "component")
    rows = rows.join(_sets(groups.select("node"), texts, nodes, plan).hint("merge"), "node")
    rows = _paired_blocks(rows, ["component"], blocks)
    return cut_lineage(rows.mapInArrow(_joining(plan), "u long, v long").distinct())


def _grown(comps: DataFrame, more: DataFrame) -> DataFrame:
    """Components after more links."""
    edges = comps.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return cut_lineage(components(edges.unionAll(more)))


def _keyed(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("digest", F.xxhash64("text"))


def linked_rows(docs: DataFrame, plan: JoinPlan = JoinPlan()) -> DataFrame:
    """(doc_id, digest, n, component) per input row: xxhash64 of the text, size of the set, name of the component (null if empty)."""
    spark = docs.sparkSession
    texts = _keyed(docs)
    profile = cut_lineage(texts.mapInArrow(_profile(plan), NODES))
    rows = profile.filter("chunk IS NULL")
    source = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
    nodes = cut_lineage(rows.filter("n > 0").groupBy("node", "n").agg(source.alias("source"), F.max("signature").alias("signature")))
    counts = bucket_counts(profile, plan)
    sent = spark.sparkContext.broadcast(counts)  # plan.buckets numbers
    dealt = texts.mapInArrow(_prefixes(plan, sent, plan.range_bits(int(counts.sum()))), "bucket long, data binary")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    tiles = _tiles(cut_lineage(dealt.mapInArrow(_shared, "key long, node long, n long")), plan)

    tried = _screened(_star_pairs(tiles, plan), nodes, plan)
    comps = cut_lineage(components(links(tried, texts, nodes, plan)))
    for turn in range(plan.rounds):
        more = _outsider_pairs(_open_rows(tiles, comps), plan, turn).join(tried, ["a", "b"], "left_anti")
        more = _screened(more, nodes, plan)
        if more.isEmpty():
            break
        tried = tried.unionAll(more)
        comps = _grown(comps, links(more, texts, nodes, plan))
    last = _last_links(_open_rows(tiles, comps), texts, nodes, plan)
    if not last.isEmpty():
        comps = _grown(comps, last)
    return rows.join(comps, "node", "left").select(
        "doc_id", "digest", "n", F.coalesce("component", "node").alias("component"))


def near_duplicates(docs: DataFrame, plan: JoinPlan = JoinPlan()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links).

    Nulls: a null text is empty; empty sets link with nothing. A row without id belongs to the component of its text
    and passes links on, but names none: component_id is null if no row of the component has an id. Repeated rows get
    equal results; rows of one id and different texts each follow their own text. An empty table gives no rows. Other
    columns are not read. The documents are read more than once, so give a stored table.
    """
    rows = cut_lineage(linked_rows(docs, plan))
    names = rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(names, "component", "left").select("doc_id", F.col("n").alias("n_shingles"),
                                                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, plan: JoinPlan = JoinPlan()) -> DataFrame:
    """The documents with all their columns, one row of each component: of the smallest id, then of the smallest digest of its text.

    Texts without words all stay. Rows without id count behind all others, so one of them stays only where no row of its
    component has an id. Of repeated rows of that id and text one stays, whichever other columns they have. An empty table
    stays empty.
    """
    rows = cut_lineage(linked_rows(docs, plan).filter("n > 0"))
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("best"))
    kept = best.select("best.doc_id", "best.digest")
    again = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["digest"] == b["digest"])
    kept = cut_lineage(kept.alias("k").join(again.alias("r"), same(kept, again), "left").select(
        F.col("k.doc_id").alias("id"), F.col("k.digest").alias("print"), F.col("r.copies").isNotNull().alias("repeated")))
    every = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = every.select("doc", "doc_id", F.xxhash64("text").alias("digest"), F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("worded"))
    found = every.filter("worded").join(kept.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("print")))
    out = every.filter("NOT worded").select("doc.*").unionByName(found.filter("NOT repeated").select("doc.*"))
    if kept.filter("repeated").isEmpty():
        return out
    once = found.filter("repeated").groupBy("doc_id", "digest").agg(F.first("doc").alias("doc"))
    return out.unionByName(once.select("doc.*"))


WORD = r"[^\x20\x09-\x0D]"
