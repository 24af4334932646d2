"""Near-duplicate groups by an LSH forest over MinHash signatures.

A document's set is its distinct word shingles; equal sets are one node. Each
tree of the forest is an order of all signatures of ``DEEPEST`` minima, and
nodes that share the first ``DEPTH`` of them are a region of it. Sorted
signatures lie by longest common prefix, so the depth follows the region:

1. Neighbours in the sorted orders of some trees, the nodes with the longest
   common prefixes, are candidates first. In a region of near copies, however
   large, they join all of it with a pair a node, not all pairs.
2. In every region of every tree, nodes that are still in different groups are
   candidates pair by pair, unless one bit of every minimum tells them apart.
3. A region with too many of those is not compared pairwise. Its nodes go
   through an exact way: two sets of the similarity share one of the rarest
   few shingles of either (the prefix filter), so nodes that still differ in
   group meet under those; under a shingle that is too common, block by block.

Every candidate pair is confirmed on the full sets of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Emitter, arrow_schema, join_counted, shuffle_partitions, text_rows, write_buckets, write_table
from .components import components
from .fingerprint import word_hashes
from .token_store import mix

SHINGLE_WORDS = 2
#: Links: PERCENT * union <= 100 * intersection.
PERCENT = 80
#: A pair of similarity s is a candidate with probability 1 - (1 - s^DEPTH)^TREES: all but
#: three in a million at 0.8, all but one in 10^11 at 0.9.
TREES, DEPTH = 24, 4
#: Trees whose neighbours are candidates in the first pass; their signatures go further.
NEIGHBOUR_TREES, DEEPEST = 4, 6
#: Minima of a signature: the trees' first ones, then what some have further.
MINIMA = TREES * DEPTH + NEIGHBOUR_TREES * (DEEPEST - DEPTH)
#: One bit of every minimum is compared before a pair is a candidate. Most of them that may differ: at a similarity
#: of 0.8 a tenth do in the mean, and more than this many once in ten million.
MAX_BITS = 26
#: Candidate pairs of different groups that one region may give, and nodes it may hold, before it goes the exact way.
MAX_PAIRS, MAX_NODES = 4096, 1 << 13
#: Nodes of a block, and shingles they may have together, where a shingle of the exact way is too common.
BLOCK, BLOCK_SHINGLES = 512, 1 << 18
#: Shingles of a pair of blocks that are counted at once.
SLAB = 4096
#: The exact way ranks shingles by how common they are among its nodes; it knows at most so many common ones.
COMMON = 1 << 17
#: Shingles that a task gathers before it adds them up.
COUNTED = 1 << 20
#: Digests of sets that a task remembers, to hand on a repeated text once.
SEEN = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_A = np.random.default_rng(11).integers(0, 2**31, size=(MINIMA, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = np.random.default_rng(12).integers(0, 2**32, size=(MINIMA, 1), dtype=np.uint32)


def shingles(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The set as ascending hashes; with fewer words than a shingle, one for all of them."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    k = min(shingle_words, len(words))
    hashes = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for j in range(k):
        hashes = hashes * _BASE + words[j : j + len(hashes)]
    return np.unique(mix(hashes, k))


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minima of ``MINIMA`` permutations."""
    x = (hashes >> _U(32)).astype(np.uint32)
    low = np.full(MINIMA, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 2048):
        low = np.minimum(low, (_A * x[i : i + 2048] + _B).min(axis=1))
    return low


def places_of(low: np.ndarray) -> list[bytes]:
    """A node's place in each tree: the tree's number and its minima, as bytes that sort alike."""
    raw = low.astype(">u4").tobytes()
    further, step = 4 * TREES * DEPTH, 4 * (DEEPEST - DEPTH)
    return [bytes([t]) + raw[4 * DEPTH * t : 4 * DEPTH * (t + 1)] + (raw[further + step * t : further + step * (t + 1)] if t < NEIGHBOUR_TREES else b"") for t in range(TREES)]


def bits(low: np.ndarray) -> bytes:
    """A bit of each minimum: equal minima have equal bits, others by chance."""
    return np.packbits(low >> np.uint32(7) & np.uint32(1)).tobytes()


def unlike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits differ, over the last axis of arrays of bytes."""
    return np.bitwise_count(a ^ b).sum(axis=-1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _node(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def marked(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n, node, text): the size of each row's set and its digest (null: an empty
    set), and the text where a task meets the set first. Written."""
    ddl = "doc_id long, n long, node binary, text string"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = Emitter(schema), set()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = shingles(text, shingle_words)
                node = _node(hashes)
                first = node is not None and node not in seen
                if first and len(seen) < SEEN:
                    seen.add(node)
                out.add((doc, len(hashes), node, text if first else None), 64 + len(text) * first)
                if out.full():
                    yield from out.take()
        yield from out.take()

    return write_table(text_rows(docs).mapInArrow(run, ddl), "marked")


def node_texts(rows: DataFrame) -> DataFrame:
    """(node, n, text): a text of each distinct set, in buckets of the node, so that joins on
    it move only their other side."""
    once = rows.where("text is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("text").alias("text"))
    return write_buckets(once, "nodes", "node")


def forest(texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(place, node, n, bits): each node's place in the order of every tree: the tree's number
    and the signature's minima, as bytes that sort alike."""
    ddl = "place binary, node binary, n long, bits binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, places, marks = batch.column(0).to_pylist(), [], []
            for text in batch.column(2).to_pylist():
                low = signature(shingles(text, shingle_words))
                places += places_of(low)
                marks += [bits(low)] * TREES
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.binary()), pa.array([x for x in nodes for _ in range(TREES)], pa.binary()),
                                              pa.array(np.repeat(batch.column(1).to_numpy(), TREES)), pa.array(marks, pa.binary())], schema=schema)

    return texts.select("node", "n", "text").mapInArrow(run, ddl)


def regions(places: DataFrame) -> DataFrame:
    """(place, node, n, bits, before): the rows that share a region with a neighbour in the
    sorted order, with the node before them in it if the two can be similar. Rows at
    the edges of a partition stay, as their neighbours lie elsewhere."""
    spark, ddl = places.sparkSession, "place binary, node binary, n long, bits binary, before binary"
    schema, width = arrow_schema(ddl), 1 + 4 * DEPTH

    def close(x: tuple, y: tuple) -> bool:
        return (100 * min(x[2], y[2]) >= PERCENT * max(x[2], y[2])
                and (int.from_bytes(x[3]) ^ int.from_bytes(y[3])).bit_count() <= MAX_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, last, keep = Emitter(schema), None, True  # the first row lies at an edge
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if last is not None:
                    joined = last[0][:width] == row[0][:width]
                    if keep or joined:
                        out.add(last, 100)
                        if out.full():
                            yield from out.take()
                    keep = joined
                    row = (*row, last[1] if joined and close(last, row) else None)
                else:
                    row = (*row, None)
                last = row
        if last is not None:
            out.add(last, 100)
        yield from out.take()

    by = ["place", "node"]
    return places.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by).mapInArrow(run, ddl)


MET = "a binary, b binary, key binary, chunk long, node binary, n long, root binary"


def meetings(keyed: DataFrame) -> DataFrame:
    """``MET`` of rows (key, node, n, root, bits): pairs (a, b) of nodes under one key that are
    in different groups, of similar size and of similar bits, where there are any; instead
    the rows themselves, numbered in chunks, where there are too many such pairs or a
    key's rows lie in several partitions."""
    spark, schema = keyed.sparkSession, arrow_schema(MET)

    def pairs(nodes: list[bytes], n: np.ndarray, roots: list[bytes], marks: list[bytes | None]) -> list[tuple[bytes, bytes]] | None:
        names: dict[bytes, int] = {}
        group = np.array([names.setdefault(r, len(names)) for r in roots])
        if len(names) == 1:
            return []
        m, out = len(nodes), []
        if m > MAX_NODES:
            return None
        known = None if marks[0] is None else np.frombuffer(b"".join(marks), dtype=np.uint8).reshape(m, -1)
        largest = np.bincount(group).argmax()
        few = np.flatnonzero(group != largest)  # a pair of two groups has a node outside the largest
        for i in few.tolist():
            ok = (group != group[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i])) & ((group == largest) | (np.arange(m) > i))
            if known is not None:
                ok &= unlike(known, known[i]) <= MAX_BITS
            out += [tuple(sorted((nodes[i], nodes[j]))) for j in np.flatnonzero(ok).tolist()]
            if len(out) > MAX_PAIRS:
                return None
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, held, edge = Emitter(schema), None, [], True
        chunk = TaskContext.get().partitionId() << 32

        def close(held: list[tuple], whole: bool) -> int:
            found = pairs([r[0] for r in held], np.array([r[1] for r in held]), [r[2] for r in held], [r[3] for r in held]) if whole else None
            if found is not None:
                for a, b in found:
                    out.add((a, b, None, None, None, None, None), 60)
                return 0
            number = size = rows = 0
            for r in held:
                if rows == BLOCK or rows and size + r[1] > BLOCK_SHINGLES:
                    number, size, rows = number + 1, 0, 0
                size, rows = size + r[1], rows + 1
                out.add((None, None, key, chunk + number, *r[:3]), 100)
            return number + 1

        for batch in batches:
            for k, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if k != key or len(held) > MAX_NODES:
                    if held:
                        chunk += close(held, not edge and k != key)
                        edge = k == key  # the rest of a key cut here goes the same way
                        if out.full():
                            yield from out.take()
                    key, held = k, []
                held.append(row)
        if held:
            close(held, False)
        yield from out.take()

    by = ["key", "root", "n", "node"]  # chunks hold few groups
    rows = keyed.select("key", "node", "n", "root", "bits").repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by)
    return rows.mapInArrow(run, MET)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    schema = arrow_schema("a binary, b binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = None, None
        for batch in batches:
            ok = []
            for b, x, y in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)]):
                if b != known:
                    known, own = b, shingles(y, shingle_words)
                ok.append(similar(shingles(x, shingle_words), own))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(ok, pa.bool_()))

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with ``root``: the group of their node by now."""
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def rarest(texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(key, node, n, root): each node (node, n, least, root, text) under its rarest shingles. If
    a partner has ``least`` shingles or more, the two share PERCENT / (100 + PERCENT) of
    both sizes together, so one of the n + 1 less that many rarest of the node is shared.
    Any order of the shingles serves; this one puts those last that are common
    among these nodes, of which at most ``COMMON`` reach the driver."""
    some, ddl = arrow_schema("key long, n long"), "key binary, node binary, n long, root binary"
    schema = arrow_schema(ddl)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shingles with the number of texts that have them, added up over many texts."""
        held, size = [], 0

        def add_up() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], schema=some)

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(shingles(text, shingle_words))
                size += len(held[-1])
                if size > COUNTED:
                    yield add_up()
                    held, size = [], 0
        if held:
            yield add_up()

    total = texts.agg(F.sum("n")).first()[0] or 0
    counts = texts.select("text").mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > max(BLOCK, total // COMMON))
    common = counts.collect()
    keys = np.array(sorted((r.key for r in common)), dtype=np.int64)
    often = {r.key: r.n for r in common}
    weight = np.array([often[k] for k in keys.tolist()], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for node, root, least, text in zip(*[c.to_pylist() for c in batch.columns]):
                hashes = shingles(text, shingle_words)
                x, n = hashes.view(np.int64), len(hashes)
                at = np.minimum(np.searchsorted(keys, x), max(len(keys) - 1, 0))
                rank = np.where(keys[at] == x, weight[at], 0) if len(keys) else np.zeros(n)
                shared = -(-PERCENT * (n + max(least, -(-PERCENT * n // 100))) // (100 + PERCENT))
                for k in np.lexsort((x, rank))[: n - shared + 1].tolist():
                    out.add((hashes[k].tobytes(), node, n, root), 80)
                    if out.full():
                        yield from out.take()
        yield from out.take()

    return texts.select("node", "root", "least", "text").mapInArrow(run, ddl)


def block_links(crowded: DataFrame, texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Links between nodes under the same key (key, chunk, node, n, root), chunk against
    chunk; chunks that cannot hold a link of two groups do not meet."""
    chunks = write_table(crowded.groupBy("key", "chunk").agg(F.min("n").alias("n"), F.max("n").alias("m"), F.min("root").alias("r"), F.max("root").alias("s")), "chunks")
    other = chunks.select("key", *[F.col(c).alias(f"{c}2") for c in ("chunk", "n", "m", "r", "s")])
    one_group = (F.col("r") == F.col("s")) & (F.col("r2") == F.col("s2")) & (F.col("r") == F.col("r2"))
    far = (100 * F.col("m") < PERCENT * F.col("n2")) | (100 * F.col("m2") < PERCENT * F.col("n"))
    met = chunks.join(other, "key").where((F.col("chunk") <= F.col("chunk2")) & ~one_group & ~far)
    sides = met.select("key", F.col("chunk").alias("c1"), F.col("chunk2").alias("c2"), F.explode(F.array_distinct(F.array("chunk", "chunk2"))).alias("chunk"))
    rows = sides.join(crowded, ["key", "chunk"]).join(texts.select("node", "text"), "node")
    schema = arrow_schema("a binary, b binary")

    def run(table: pa.Table) -> pa.Table:
        nodes, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
        own = table.column("chunk").to_numpy() == table.column("c1")[0].as_py()
        left, right = np.flatnonzero(own), np.flatnonzero(~own) if (~own).any() else np.flatnonzero(own)
        sets = [shingles(t, shingle_words) for t in table.column("text").to_pylist()]
        sizes = np.array([len(x) for x in sets])
        both = common_counts([sets[i] for i in left], [sets[j] for j in right])
        i, j = np.nonzero(100 * both >= PERCENT * (sizes[left][:, None] + sizes[right][None, :] - both))
        # one link joins two groups
        found = {tuple(sorted((roots[x], roots[y]))): tuple(sorted((nodes[x], nodes[y]))) for x, y in zip(left[i].tolist(), right[j].tolist()) if roots[x] != roots[y]}
        return pa.Table.from_arrays([pa.array([p[k] for p in found.values()], pa.binary()) for k in (0, 1)], schema=schema)

    return rows.select("key", "c1", "c2", "chunk", "node", "root", "text").groupBy("key", "c1", "c2").applyInArrow(run, "a binary, b binary")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, by products of incidence matrices over the shingles
    that occur twice, some at a time."""
    sets = [*left, *right]
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(where, kind="stable")
    order = order[times[where[order]] > 1]
    where, owner = np.cumsum(np.diff(where[order], prepend=-1) > 0) - 1, owner[order]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for first in range(0, int(where[-1]) + 1 if len(where) else 0, SLAB):
        lo, hi = np.searchsorted(where, [first, first + SLAB])
        has = np.zeros((len(sets), SLAB), dtype=np.float32)
        has[owner[lo:hi], where[lo:hi] - first] = 1
        out += has[: len(left)] @ has[len(left) :].T
    return out.astype(np.int64)


def grown(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further links: only the groups that these join are worked on."""
    ends = links
    for side in ("a", "b"):
        ends = (ends.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
                .withColumn(side, F.coalesce(f"{side}_root", side)).drop(f"{side}_root"))
    joined = write_table(components(write_table(ends.where("a <> b").select("a", "b").distinct(), "joins")), "joined")
    known = roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("over")), "root", "left").select("node", F.coalesce("over", "root").alias("root"))
    return write_table(known.unionByName(joined.join(roots.select("node"), "node", "left_anti")), "roots")


def node_groups(texts: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(node, root): the nodes that have links, and a node that names their component."""
    places = write_table(forest(texts, shingle_words), "forest")
    shared = write_table(regions(places), "regions")
    tree = F.conv(F.hex(F.substring("place", 1, 1)), 16, 10).cast("int")
    near = shared.where(F.col("before").isNotNull() & (tree < NEIGHBOUR_TREES)).select(F.least("node", "before").alias("a"), F.greatest("node", "before").alias("b"))
    tried = write_table(near.distinct(), "pairs")
    roots = write_table(components(write_table(confirmed(tried, texts, shingle_words), "links")), "roots")

    rooted = _rooted(shared.select("place", "node", "n", "bits"), roots)
    met = write_table(meetings(rooted.withColumn("key", F.substring("place", 1, 1 + 4 * DEPTH))), "met")
    more = write_table(met.where("a is not null").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    roots = grown(roots, write_table(confirmed(more, texts, shingle_words), "links"))

    crowded = _rooted(met.where("node is not null").select("key", "node", "n"), roots)
    mixed = crowded.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.min("n").alias("least")).where("r <> s")
    rest = write_table(crowded.join(mixed.select("key", "least"), "key").groupBy("node").agg(
        F.min("n").alias("n"), F.min("root").alias("root"), F.min("least").alias("least")), "crowded")
    if rest.isEmpty():
        return roots
    # no bits: this way is exact
    prefixed = rarest(write_table(rest.join(texts.select("node", "text"), "node"), "crowded-texts"), shingle_words)
    met = write_table(meetings(prefixed.withColumn("bits", F.lit(None).cast("binary"))), "met")
    done = tried.unionByName(more)
    last = write_table(met.where("a is not null").select("a", "b").distinct().join(done, ["a", "b"], "left_anti"), "pairs")
    links = write_table(confirmed(last, texts, shingle_words), "links")
    blocks = write_table(block_links(met.where("node is not null").drop("a", "b"), texts, shingle_words), "links")
    return grown(roots, links.unionByName(blocks))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the least doc_id reachable over links, and
    whether the row has it.

    A text without words has an empty set, is linked with nothing and names its own
    component. Repeated rows are returned each, and each is kept or not as its id is.
    A null doc_id is never the least; a component of null ids alone has a null
    component_id, and its rows are kept. Other columns are ignored; an empty table
    gives no rows."""
    rows = marked(docs, shingle_words)
    roots = node_groups(node_texts(rows), shingle_words)
    nodes = write_table(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "nodes")
    rooted = write_table(_rooted(nodes, roots), "rooted")
    ids = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("size"))
    classes = write_table(join_counted(rooted, ids, "root", "size").select("node", "component_id", "copies"), "classes")
    linked = join_counted(rows.where("node is not null"), classes, "node", "copies").select("doc_id", "n", "component_id")
    alone = rows.where("node is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
