"""Merkle manifest of a document table, with proofs gathered by pointer jumping.

Every document is a leaf; the leaves of a language, in ascending doc_id, are
the lowest level of a binary tree, and the trees' tops are the leaves of one
more tree over the languages. A node at index i of a level has the node at
index i >> D as its ancestor D levels up.

A node holds a segment: the siblings on its way to an ancestor. At first that
is its own sibling and the ancestor its parent. A self-join then puts the
segment of that ancestor behind the node's own, which doubles the distance to
the ancestor; after as many joins as the height has binary digits, every leaf
has reached the top. Only nodes whose level is a multiple of the distance are
met again, so the joined side shrinks from n / 2 nodes to a few.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Emitter, arrow_schema, numbered, shuffle_partitions, write_table

#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one task builds from one block of 2^BLOCK_LEVELS neighbouring nodes.
BLOCK_LEVELS = 8
#: A segment's entries: no sibling, one on the left, one on the right (32 bytes follow).
LONE, LEFT, RIGHT = b"-", b"L", b"R"


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests as lower-case hex text, one after another."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (binary) of the fields, each as length in bytes, colon and text; null: a dash."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


NODES = "tree string, level int, i long, n long, digest binary, segment binary, top boolean"


def _build(base: int, levels: int):
    """Blocks of one level, sorted, to the nodes of the next ``levels`` levels. ``top``
    marks a node without a segment yet: a block's highest, or the tree's."""
    schema = arrow_schema(NODES)

    def climb(out: Emitter, tree: str, block: int, n: int, nodes: list[bytes]) -> None:
        level, first = base, block << levels
        while n > 1 and level < base + levels:
            above = []
            for k in range(0, len(nodes), 2):
                pair = nodes[k : k + 2]
                if len(pair) == 1:
                    out.add((tree, level, first + k, n, pair[0], LONE, False), 150)
                else:
                    out.add((tree, level, first + k, n, pair[0], RIGHT + pair[1], False), 150)
                    out.add((tree, level, first + k + 1, n, pair[1], LEFT + pair[0], False), 150)
                above.append(digest(*pair))
            nodes, level, first, n = above, level + 1, first >> 1, (n + 1) >> 1
        out.add((tree, level, first, n, nodes[0], b"", True), 150)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, open_ = Emitter(schema), None
        for batch in batches:
            for tree, block, n, raw in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if open_ and open_[:2] != (tree, block):
                    climb(out, *open_)
                    open_ = None
                    if out.full():
                        yield from out.take()
                if open_ is None:
                    open_ = (tree, block, n, [])
                open_[3].append(raw)
        if open_:
            climb(out, *open_)
        yield from out.take()

    return run


def nodes_of(leaves: DataFrame) -> DataFrame:
    """``NODES`` of the trees over ``leaves`` (tree, i, n, digest): every node with its
    sibling as segment; a tree's top has an empty one. Each round builds
    ``BLOCK_LEVELS`` levels from blocks of neighbours; the driver sees the size of the
    largest tree."""
    spark, largest = leaves.sparkSession, leaves.agg(F.max("n")).first()[0] or 0
    bottom, tables, base = leaves.select("tree", "i", "n", "digest"), [], 0
    while True:
        blocks = (bottom.select("tree", F.shiftright("i", BLOCK_LEVELS).alias("block"), "n", "digest", "i")
                  .repartition(shuffle_partitions(spark), "tree", "block").sortWithinPartitions("tree", "block", "i")
                  .select("tree", "block", "n", "digest"))
        built = write_table(blocks.mapInArrow(_build(base, BLOCK_LEVELS), NODES), "merkle-nodes")
        base += BLOCK_LEVELS
        if (largest - 1) >> base <= 0:
            tables.append(built)
            break
        tables.append(built.where((~F.col("top")) | (F.col("n") == 1)))
        bottom = built.where(F.col("top") & (F.col("n") > 1))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def proofs(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tree, i, segment): each leaf's siblings up to its tree's top; (tree, digest): the tops."""
    nodes = nodes_of(leaves)
    tops = nodes.where(F.col("top")).select("tree", "digest")
    paths = nodes.where("level = 0").select("tree", "i", "segment")
    height = max(0, ((leaves.agg(F.max("n")).first()[0] or 1) - 1).bit_length())
    upper, distance = nodes.where("level > 0").select("tree", "level", "i", "segment"), 1
    while distance < height:
        # the ancestors `distance` up of nodes whose level is a multiple of twice as much
        ancestors = upper.where(F.col("level") % (2 * distance) == distance)
        met = ancestors.select("tree", "level", F.col("i").alias("above"), F.col("segment").alias("more"))
        paths = (paths.withColumn("above", F.shiftright("i", distance)).join(met.where(F.col("level") == distance).drop("level"), ["tree", "above"], "left")
                 .select("tree", "i", F.concat("segment", F.coalesce("more", F.lit(b""))).alias("segment")))
        rest = upper.where(F.col("level") % (2 * distance) == 0)
        upper = write_table(
            rest.select("tree", "level", "i", "segment", (F.col("level") + distance).alias("up"), F.shiftright("i", distance).alias("above"))
            .join(met.withColumnRenamed("level", "up"), ["tree", "up", "above"], "left")
            .select("tree", "level", "i", F.concat("segment", F.coalesce("more", F.lit(b""))).alias("segment")), "merkle-jumps")
        distance *= 2
    return paths, tops


def siblings(segment: bytes) -> Iterator[tuple[bytes, bytes | None]]:
    """(side, digest) of each level, from the leaf upwards; a lone node has none."""
    at = 0
    while at < len(segment):
        side = segment[at : at + 1]
        yield side, None if side == LONE else segment[at + 1 : at + 33]
        at += 1 if side == LONE else 33


def fold(leaf: bytes, segment: bytes) -> bytes:
    """The root that a leaf and its proof lead to."""
    for side, other in siblings(segment):
        leaf = digest(leaf) if other is None else digest(other, leaf) if side == LEFT else digest(leaf, other)
    return leaf


MANIFEST = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
            "proof binary")


def _verify(root: bytes):
    schema = arrow_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for doc, leaf, shown, subroot, proof in zip(*[c.to_pylist() for c in batch.columns]):
                others = digest(*[d for _, d in siblings(proof) if d is not None])
                folded = fold(shown, proof)
                out.add((doc, leaf.hex(), subroot.hex(), root.hex(), others.hex(), folded.hex(), folded == root, proof), 500 + len(proof))
                if out.full():
                    yield from out.take()
        yield from out.take()

    return run


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``MANIFEST``: each row's leaf, its language's root, the root of all, the proof (and
    its digest), and the root folded from the row as it is now shown. Rows where
    ``tampered`` holds are shown with n_chars + 1.

    A language's leaves ascend by doc_id (null first), those of one id by their digest;
    languages ascend by their bytes, a missing one first. Any field may be null; an
    empty text is not null. Repeated rows are leaves each. Columns beyond ``FIELDS``
    are not covered. An empty table gives no rows."""
    one_more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    shown = leaf_digest([one_more if f == "n_chars" else F.col(f) for f in FIELDS])
    leaf = leaf_digest([F.col(f) for f in FIELDS])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
                       leaf.alias("digest"), (F.when(tampered, shown) if tampered is not None else F.lit(None)).cast("binary").alias("shown"))
    leaves = write_table(numbered(rows, "tree", ["doc_id", "digest"]), "merkle-leaves")
    paths, tops = proofs(leaves)
    tops = write_table(tops, "merkle-subroots")
    trees = write_table(numbered(tops.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest"), "tree", ["lang"]), "merkle-trees")
    over, root = proofs(trees)
    above = (trees.select("i", F.col("lang").alias("tree"), F.col("digest").alias("subroot")).join(over.select("i", F.col("segment").alias("last")), "i"))
    top = root.first()  # one row, none of an empty table
    return (leaves.join(paths, ["tree", "i"]).join(write_table(above.drop("i"), "merkle-above"), "tree")
            .select("doc_id", F.col("digest").alias("leaf"), F.coalesce("shown", "digest").alias("shown"), "subroot",
                    F.concat("segment", "last").alias("proof")).mapInArrow(_verify(bytes(top.digest) if top else b""), MANIFEST))


def every_seventh() -> Column:
    """Whether 7 divides the CRC-32 of the document's id in decimal."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
