"""SimHash near-duplicate groups with pigeonring filtering.

A fingerprint is a ring of ``4 * max_distance`` segments. By the pigeonring
principle two fingerprints within ``max_distance`` bits have a start from
which every chain of l consecutive segments differs in at most
floor(l / 4) bits. So the first three segments of the chain are equal, and of
the next four at most one bit differs: one of their two halves is equal too.
Three segments and a half, at a start, are the index key (five eighths of a
fingerprint of 64 bits at a distance of 2). Pairs that meet under a key must
pass the budgets of the whole chain before their full distance is counted.

Equal fingerprints are one node. A key shared by more than ``MAX_BUCKET``
distinct fingerprints is not compared pairwise: its members are linked
exactly through shared midpoints, 65 rows for each member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Emitter, arrow_schema, join_counted, text_rows, write_table
from .components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
MAX_BUCKET = 128


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """A-Z lower-cased, words between ASCII white space, a bit set where over half of
    the shingle hashes have it; no words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    ends = np.cumsum(np.array([len(w) + 1 for w in words])) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 8192):
        counts += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the string columns ``keep``: the fingerprint's 64 bits as a long."""
    ddl = ", ".join(["doc_id long", "fp long", *[f"{c} string" for c in keep]])
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]], schema=schema)

    rows = text_rows(docs) if not keep else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *keep)
    return rows.mapInArrow(run, ddl)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _rotated(fp: Column, bits: int) -> Column:
    return fp if not bits else F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits))


def chain_keys(fp: Column, max_distance: int) -> Column:
    """Index keys: (start, half, three equal segments, equal half), as one long."""
    width = 16 // max_distance
    mask, keys = (1 << 2 * width) - 1, []
    for start in range(4 * max_distance):
        ring = _rotated(fp, start * width)
        first = F.shiftrightunsigned(ring, 64 - 3 * width)
        for half in (0, 1):
            part = F.shiftrightunsigned(ring, 64 - (5 + 2 * half) * width).bitwiseAND(F.lit(mask))
            tag = F.lit((start * 2 + half) << 5 * width)
            keys.append(tag.bitwiseOR(F.shiftleft(first, 2 * width)).bitwiseOR(part))
    return F.array(*keys)


def pigeonring(x: np.ndarray, y: np.ndarray, start: int, max_distance: int) -> np.ndarray:
    """Whether every chain from ``start`` keeps its budget."""
    m = 4 * max_distance
    width, bits = 64 // m, np.uint64(start * (64 // m))
    diff = x ^ y
    if start:
        diff = (diff << bits) | (diff >> (np.uint64(64) - bits))
    segment = np.uint64((1 << width) - 1)
    total, ok = np.zeros(diff.shape, dtype=np.int64), np.ones(diff.shape, dtype=bool)
    for length in range(1, m + 1):
        total += np.bitwise_count((diff >> np.uint64(64 - length * width)) & segment)
        ok &= total <= length * max_distance // m
    return ok


def _bucket_links(key: int, fps: list[int], max_distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links under one key."""
    x = np.array(sorted(set(fps)), dtype=np.int64)
    u = x.view(np.uint64)
    start = (key >> 5 * (16 // max_distance)) // 2
    i, j = np.triu_indices(len(u), 1)
    ok = pigeonring(u[i], u[j], start, max_distance)
    i, j = i[ok], j[ok]
    near = np.bitwise_count(u[i] ^ u[j]) <= max_distance
    root, out = list(range(len(u))), []

    def find(a: int) -> int:
        while root[a] != a:
            root[a] = a = root[root[a]]
        return a

    for a, b in zip(i[near].tolist(), j[near].tolist()):
        ra, rb = find(a), find(b)
        if ra != rb:
            root[rb] = ra
            out.append((int(x[a]), int(x[b])))
    return out


def links(fps: DataFrame, max_distance: int = MAX_DISTANCE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of distinct
    fingerprints (column ``fp``) within ``max_distance`` bits."""
    if max_distance not in (2, 4):
        raise ValueError("max_distance must be 2 or 4: segments have to divide 64 bits")
    schema = arrow_schema("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for key, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for pair in _bucket_links(key, members, max_distance):
                    out.add(pair)
                if out.full():
                    yield from out.take()
        yield from out.take()

    keyed = fps.select("fp", F.explode(chain_keys(F.col("fp"), max_distance)).alias("chain"))
    shared = write_table(keyed.groupBy("chain").agg(F.count("*").alias("members")).where("members > 1"), "chains")
    # a shared key's fingerprints meet only where there are few enough of them
    few = (keyed.join(shared.where(F.col("members") <= max_bucket), "chain").groupBy("chain")
           .agg(F.collect_list("fp").alias("fps")).mapInArrow(run, "a long, b long"))
    many = keyed.join(shared.where(F.col("members") > max_bucket), "chain").select("fp").distinct()
    return few.unionByName(midpoint_links(many, max_distance))


def midpoint_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Two fingerprints are within 2r bits if and only if their balls of r bits meet.
    A midpoint has as many members as a ball has points, and all of them are within 2r
    bits of each other, so each is linked to the least."""
    flips = [0] + [1 << i for i in range(64)]
    if max_distance == 4:
        flips += [1 << i | 1 << j for i in range(64) for j in range(i)]
    flips = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
    balls = fps.select("fp", F.explode(F.transform(F.lit(flips), lambda f: F.col("fp").bitwiseXOR(f))).alias("midpoint"))
    least = balls.groupBy("midpoint").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return balls.join(least, "midpoint").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
                    max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id): the least doc_id reachable over links.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows are returned each. A null doc_id is never the least; a
    component of null ids alone has a null component_id. Other columns are
    ignored; an empty table gives no rows."""
    marked = write_table(fingerprints(docs, shingle_words), "simhash")
    rooted = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), max_distance, max_bucket)
    ids = rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("size"))
    classes = write_table(join_counted(rooted, ids, "root", "size").select("fp", "component_id", "copies"), "simhash-classes")
    return join_counted(marked, classes, "fp", "copies").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def _rooted(nodes: DataFrame, max_distance: int, max_bucket: int) -> DataFrame:
    """The distinct fingerprints (column ``fp``) with the root of their component, written."""
    nodes = write_table(nodes, "simhash-nodes")
    roots = components(links(nodes.select("fp"), max_distance, max_bucket))
    return write_table(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-roots")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE,
             max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row of each component, all columns: that of the least id, fingerprint, text and
    further columns. An id whose texts are in several components may stay for each of
    them; rows without an id stay, and link others. The least row of every fingerprint is found while
    fingerprints are counted, so copies do not meet; documents themselves are read
    again and only the chosen ones move."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text, rest = F.coalesce(F.col("doc.text").cast("string"), F.lit("")), F.to_json("doc")
    keyed = keyed.withColumn("row_key", F.concat(F.sha2(text, 256), F.sha2(rest, 256)))
    rows = keyed.select(F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").alias("text"), "row_key")
    marked = write_table(fingerprints(rows, shingle_words, ("row_key",)), "simhash")
    nodes = marked.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "row_key")).alias("least"))
    first = _rooted(nodes, max_distance, max_bucket).groupBy("root").agg(F.min("least").alias("least")).select("least.row_key")
    kept = keyed.where("doc.doc_id is not null").join(first, "row_key", "left_semi").dropDuplicates(["row_key"])
    return kept.select("doc.*").unionByName(docs.where("doc_id is null"))
