"""Trie of conversation prefixes, with counts per node.

A node is a distinct sequence of first turns. Its digest is the exclusive or
of a 128-bit hash of each (depth, role, text), so prefixes of a conversation of
any length are running aggregates over blocks of turns, and the parent's digest
is the node's without its last turn.

Nodes are counted where conversations meet (one aggregation), then dealt to
shards by subtree: a node belongs to its highest ancestor at a depth of
``ANCHOR_DEPTHS`` whose subtree is light. In a shard the distinct digests get
slots of a minimal perfect hash, verified against the digests stored there;
counts are scattered into flat arrays and added up through the array of parent
slots, deepest nodes first. What lies above the shards, few nodes unless
conversations are very long, gets the shards' totals and is added up by pointer
doubling, so neither a common first turn nor a long conversation is one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Emitter, arrow_schema, numbered, shuffle_partitions, write_table
from .token_store import PerfectHash, mix

#: Turns of one conversation that are digested in one piece; not fewer than the deepest anchor.
BLOCK = 1024
#: Depths whose nodes may head a shard's subtree.
ANCHOR_DEPTHS = (1, 2, 4, 8, 16, 32)
#: A subtree is light up to this many turns, or up to a 16th of a shuffle partition's
#: share: there are then at most 16 heavier nodes a partition at each depth.
LIGHT = 4096
LIGHT_PARTS = 16
#: Characters of conversation ids, joined, that are handed on at once.
ENDS_CHARS = 1 << 16

KEY = ["depth", "s1", "s2"]


def parent_key() -> list[Column]:
    return [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2")]


def head_turns(conv: Column) -> Column:
    """How many turns a rebuilt conversation takes from its donor."""
    return F.crc32(conv.cast("string").cast("binary")) % 9


def donor(conv: Column) -> Column:
    return conv - conv % 5


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, c1, c2, bytes, len): the turns of every rebuilt conversation, as hashes
    and bytes of text; (conv, len): every rebuilt conversation."""
    c = conversations.where("conv_id is not null")
    role, text = [F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text")]
    rows = c.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                    F.xxhash64(role, text).alias("c1"), F.xxhash64(F.lit(7), F.octet_length(role), text, role).alias("c2"), F.octet_length(text).cast("long").alias("bytes"))
    turns = write_table(numbered(rows, "conv", ["turn", "role", "text"], ("turn", "role", "text")), "turns")
    sizes = turns.where("i = 0").select("conv", "n")
    conv = F.col("conv")
    spec = (sizes.select("conv", "n", head_turns(conv).alias("h"), donor(conv).alias("donor"))
            .join(sizes.select(conv.alias("donor"), F.col("n").alias("given")), "donor", "left")
            .withColumn("f", F.least("h", F.coalesce("given", F.lit(0).cast("long"))))
            .withColumn("len", F.col("f") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    spec = write_table(spec.select("conv", "donor", "n", "h", "f", "len"), "rebuilt")
    block = F.floor(F.col("i") / BLOCK).cast("long")
    blocks = spec.select("conv", "h", "f", "len", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / BLOCK).cast("long"))).alias("block"))
    out = ["conv", "depth", "c1", "c2", "bytes", "len"]
    own = (turns.where(F.col("i") >= head_turns(conv)).withColumn("block", block).join(blocks, ["conv", "block"])
           .withColumn("depth", F.col("i") + 1 - F.col("h") + F.col("f")).select(*out))
    heads = turns.where((F.col("i") < 8) & (F.col("conv") % 5 == 0)).select(conv.alias("donor"), "i", "c1", "c2", "bytes")
    given = (spec.where("f > 0").select("conv", "donor", "f", "len").join(heads, "donor").where("i < f")
             .withColumn("depth", F.col("i") + 1).select(*out))
    return write_table(own.unionByName(given), "rebuilt-turns"), spec.select("conv", "len")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with its node (depth, s1, s2), the parent's digest (p1, p2) and the digests
    of the ancestors at ``ANCHOR_DEPTHS`` (t1, t2, ...)."""
    g = turns.withColumns({"g1": F.xxhash64("c1", "depth"), "g2": F.xxhash64("depth", "c2"), "block": F.floor((F.col("depth") - 1) / BLOCK).cast("long")})
    marks = {f"t{k}": F.when(F.col("depth") <= k, F.col("g1")) for k in ANCHOR_DEPTHS}
    # conversations of several blocks: what the blocks before hold
    pieces = g.where(F.col("len") > BLOCK).groupBy("conv", "block").agg(
        F.bit_xor("g1").alias("x1"), F.bit_xor("g2").alias("x2"), *[F.bit_xor(m).alias(f"m{t}") for t, m in marks.items()])
    w = Window.partitionBy("conv").orderBy("block")
    carry = write_table(pieces.select(
        "conv", "block", *[F.bit_xor(x).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"before_{x}") for x in ("x1", "x2")],
        *[F.first(f"m{t}").over(w).alias(f"m{t}") for t in marks]).where("block > 0"), "carry")
    run = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = g.select("conv", "block", "depth", "len", "bytes", "g1", "g2", F.bit_xor("g1").over(run).alias("x1"), F.bit_xor("g2").over(run).alias("x2"))
    local = local.select("*", *[F.max(F.when(F.col("depth") == k, F.col("x1"))).over(run).alias(f"t{k}") for k in ANCHOR_DEPTHS])
    full = local.join(carry, ["conv", "block"], "left")
    s1, s2 = [F.col(x).bitwiseXOR(F.coalesce(f"before_{x}", F.lit(0).cast("long"))) for x in ("x1", "x2")]
    return full.select("conv", "depth", "len", "bytes", s1.alias("s1"), s2.alias("s2"), s1.bitwiseXOR(F.col("g1")).alias("p1"), s2.bitwiseXOR(F.col("g2")).alias("p2"),
                       *[F.coalesce(f"t{k}", f"mt{k}").alias(f"t{k}") for k in ANCHOR_DEPTHS])


def anchored(nodes: DataFrame, light: int) -> DataFrame:
    """``nodes`` with ``anchor``: the digest of the highest ancestor (or the node itself) at
    a depth of ``ANCHOR_DEPTHS`` whose subtree is light, else null. The heavy nodes at one
    depth share all turns among them, so the driver gets at most turns / light of them
    for each depth."""
    heavy: dict[int, list[int]] = {k: [] for k in ANCHOR_DEPTHS}
    for r in nodes.where(F.col("depth").isin(*ANCHOR_DEPTHS) & (F.col("weight") > light)).select("depth", "s1").collect():
        heavy[r.depth].append(r.s1)
    found = {k: np.array(v, dtype=np.int64) for k, v in heavy.items()}
    kept = [c for c in nodes.columns if not c.startswith("t") and c != "weight"]
    ddl = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields if f.name in kept], "anchor long"])
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, open_ = np.zeros(batch.num_rows, dtype=np.int64), np.ones(batch.num_rows, dtype=bool)
            for k in ANCHOR_DEPTHS:
                mark = batch.column(f"t{k}")
                digests = mark.fill_null(0).to_numpy()
                ok = open_ & mark.is_valid().to_numpy(zero_copy_only=False) & ~np.isin(digests, found[k])
                anchor[ok], open_[ok] = digests[ok], False
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(anchor, mask=open_)], schema=schema)

    return nodes.mapInArrow(run, ddl)


class Shard:
    """The nodes of some subtrees in flat arrays, each at its slot of a minimal perfect hash."""

    def __init__(self, depth: np.ndarray, s1: np.ndarray, s2: np.ndarray):
        for salt in range(64):
            self.salt = salt
            self.hash = PerfectHash.build(self._keys(depth, s1, s2))
            at = self.hash.slot(self._keys(depth, s1, s2))
            if np.bincount(at, minlength=len(at)).max(initial=1) == 1:  # else two digests fell on one key: another salt
                break
        self.at = at
        self.depth, self.s1, self.s2 = self.scatter(depth), self.scatter(s1), self.scatter(s2)

    def _keys(self, depth: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
        return s1.view(np.uint64) ^ mix(s2.view(np.uint64) ^ mix(depth, self.salt), self.salt)

    def scatter(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.at), dtype=values.dtype)
        out[self.at] = values
        return out

    def slots(self, depth: np.ndarray, s1: np.ndarray, s2: np.ndarray) -> np.ndarray:
        """The slots of digests; -1 for those that are not here, by the digest stored at the slot."""
        at = self.hash.slot(self._keys(depth, s1, s2))
        here = (at >= 0) & (at < len(self.s1))
        look = np.where(here, at, 0)
        return np.where(here & (self.depth[look] == depth) & (self.s1[look] == s1) & (self.s2[look] == s2), at, -1)


COUNTED = "depth long, s1 long, s2 long, p1 long, p2 long, conv long, n_convs long, n_children long, n_leaves long, saved long, parent_conv long, top boolean"


def count_shard(depth, s1, s2, p1, p2, conv, n_convs, bytes_) -> list[np.ndarray]:
    """The columns of ``COUNTED``, in slot order. ``top``: the parent is not in the shard."""
    shard = Shard(depth, s1, s2)
    parent = shard.scatter(shard.slots(depth - 1, p1, p2))
    conv, n_convs, deep = shard.scatter(conv), shard.scatter(n_convs), shard.depth
    inner = parent >= 0
    children = np.bincount(parent[inner], minlength=len(parent)).astype(np.int64)
    leaves = (children == 0).astype(np.int64)
    saved = (n_convs - 1) * shard.scatter(bytes_)
    order = np.argsort(-deep, kind="stable")
    cuts = np.flatnonzero(np.diff(deep[order])) + 1
    for level in np.split(order, cuts):
        below = level[parent[level] >= 0]
        np.add.at(leaves, parent[below], leaves[below])
        np.add.at(saved, parent[below], saved[below])
    above = np.where(inner, conv[np.where(inner, parent, 0)], 0)
    return [deep, shard.s1, shard.s2, shard.scatter(p1), shard.scatter(p2), conv, n_convs, children, leaves, saved, above, ~inner]


def _count_shards(light: int):
    """Whole subtrees, sorted by anchor, counted some at a time."""
    schema = arrow_schema(COUNTED)

    def counted(rows: list[np.ndarray]) -> pa.RecordBatch:
        cols = count_shard(*rows)
        return pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols[:10]], pa.array(cols[10], mask=cols[11]), pa.array(cols[11])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(k).to_numpy() for k in range(9)])
            rows += batch.num_rows
            if rows < light:
                continue
            cols = [np.concatenate(c) for c in zip(*held)]
            last = int(np.searchsorted(cols[0], cols[0][-1], side="left"))  # the last subtree may go on
            if last:
                yield counted([c[:last] for c in cols[1:]])
            held, rows = [[c[last:] for c in cols]], len(cols[0]) - last
        if rows:
            yield counted([np.concatenate(c) for c in zip(*held)][1:])

    return run


def above_shards(upper: DataFrame, tops: DataFrame) -> DataFrame:
    """``upper`` nodes with n_children, n_leaves and saved, from the totals of the shards'
    topmost nodes below them and, by pointer doubling, of each other."""
    own = ["n_children", "n_leaves", "saved"]
    below = (tops.select(*parent_key(), F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved")
             .unionByName(upper.where("depth > 0").select(*parent_key(), F.lit(1).cast("long").alias("n_children"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved")))
             .groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in own]))
    zero = F.lit(0).cast("long")
    state = (upper.select(*KEY, "p1", "p2", ((F.col("n_convs") - 1) * F.col("bytes")).alias("kept")).join(below, KEY, "left")
             .select(*KEY, F.coalesce("n_children", zero).alias("n_children"),
                     (F.coalesce("n_leaves", zero) + F.col("n_children").isNull().cast("long")).alias("n_leaves"),
                     (F.coalesce("saved", zero) + F.col("kept")).alias("saved"),
                     F.when(F.col("depth") > 0, F.struct(*parent_key())).alias("to")))
    state = write_table(state, "upper")
    deepest = state.agg(F.max("depth")).first()[0] or 0
    for _ in range(int(deepest).bit_length()):
        # every node hands its sum to the node it points at, and then points twice as far
        sums = state.where("to is not null").groupBy("to").agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        given = sums.select("to.depth", "to.s1", "to.s2", "more_leaves", "more_saved")
        jump = state.where("to is not null").select(F.col("to").alias("via"), *KEY).alias("a")
        next_ = state.select(F.struct(*KEY).alias("via"), F.col("to").alias("far")).where("far is not null")
        far = jump.join(next_, "via").select(*KEY, "far")
        state = write_table(state.join(given, KEY, "left").join(far, KEY, "left").select(
            *KEY, "n_children", (F.col("n_leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
            (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"), F.col("far").alias("to")), "upper")
    return upper.join(state.select(*KEY, *own), KEY)


ENDS = "depth long, s1 long, s2 long, ends_sha256 string"


def end_digests(ends: DataFrame) -> DataFrame:
    """``ENDS``: for every node where conversations end, the SHA-256 of their ids, ascending and
    joined by commas. Ids sorted by (node, id) are joined in pieces wherever they lie;
    then only pieces meet, in order, and are hashed as they come."""
    spark, by = ends.sparkSession, [*KEY, "conv"]
    pieces, schema = "depth long, s1 long, s2 long, first long, ids string", arrow_schema("depth long, s1 long, s2 long, first long, ids string")
    done = arrow_schema(ENDS)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, node, ids, size = Emitter(schema), None, [], 0
        for batch in batches:
            for d, a, b, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if ids and (node != (d, a, b) or size > ENDS_CHARS):
                    out.add((*node, ids[0], ",".join(map(str, ids))), size)
                    ids, size = [], 0
                    if out.full():
                        yield from out.take()
                node = (d, a, b)
                ids.append(conv)
                size += 20
        if ids:
            out.add((*node, ids[0], ",".join(map(str, ids))), size)
        yield from out.take()

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, node, sha = Emitter(done), None, None
        for batch in batches:
            for d, a, b, _, text in zip(*[c.to_pylist() for c in batch.columns]):
                if node == (d, a, b):
                    sha.update(b",")
                else:
                    if node:
                        out.add((*node, sha.hexdigest()))
                        if out.full():
                            yield from out.take()
                    node, sha = (d, a, b), hashlib.sha256()
                sha.update(text.encode())
        if node:
            out.add((*node, sha.hexdigest()))
        yield from out.take()

    n = shuffle_partitions(spark)
    joined = ends.select(*by).repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(join, pieces)
    return joined.repartition(n, *KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hash_, ENDS)


def trie(conversations: DataFrame, light: int | None = None) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns are ordered by turn (null first), then role, then text; a null role or text is
    empty. Rows without a conv_id belong to no conversation; repeated rows are turns
    each. The root has depth 0. Other columns are ignored; without conversations there
    are no rows. ``light``: turns of a subtree that one shard may hold."""
    spark = conversations.sparkSession
    turns, rebuilt_ = rebuilt(conversations)
    paths = write_table(prefixes(turns), "prefixes")
    total = rebuilt_.agg(F.min("conv").alias("conv"), F.count("*").alias("n"), F.sum("len").alias("turns")).first()
    if light is None:
        light = max(LIGHT, (total.turns or 0) // (LIGHT_PARTS * shuffle_partitions(spark)))
    nodes = write_table(paths.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"), *[F.max(f"t{k}").alias(f"t{k}") for k in ANCHOR_DEPTHS]), "nodes")
    dealt = write_table(anchored(nodes, light), "anchored")
    counted = write_table(
        dealt.where("anchor is not null").select("anchor", *KEY, "p1", "p2", "conv", "n_convs", "bytes")
        .repartition(shuffle_partitions(spark), "anchor").sortWithinPartitions("anchor").mapInArrow(_count_shards(light), COUNTED), "counted")
    root = spark.createDataFrame([(0, 0, 0, 0, 0, total.conv, total.n, 0)] if total.n else [],
                                 "depth long, s1 long, s2 long, p1 long, p2 long, conv long, n_convs long, bytes long")
    upper = dealt.where("anchor is null").select(*root.columns).unionByName(root)
    high = above_shards(upper, counted.where("top")).select(*KEY, "p1", "p2", "conv", "n_convs", "n_children", "n_leaves", "saved",
                                                            F.lit(None).cast("long").alias("parent_conv"), F.lit(True).alias("top"))
    all_ = counted.unionByName(write_table(high, "high"))
    # the parents of what the shards do not know: the root, else a node above them
    known = all_.where("not top or depth <= 1").withColumn("parent_conv", F.when(F.col("depth") == 1, F.lit(total.conv)).otherwise(F.col("parent_conv")))
    parents = upper.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("s1").alias("p1"), F.col("s2").alias("p2"), F.col("conv").alias("above"))
    open_ = all_.where("top and depth > 1").join(parents, ["depth", "p1", "p2"]).withColumn("parent_conv", F.col("above")).select(*all_.columns)
    ends = (paths.where("depth = len").select(*KEY, "conv")
            .unionByName(rebuilt_.where("len = 0").select(*[F.lit(0).cast("long").alias(k) for k in KEY], "conv")))
    return (known.unionByName(open_).join(end_digests(ends), KEY, "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
