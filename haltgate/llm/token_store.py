"""Token ids in binary shards with a keyed index.

A store is one Parquet folder; each row is a shard: a contiguous range of
ascending document keys. ``payload`` holds the raw little-endian ids of its
documents one after another. ``index`` is a minimal perfect hash of the
shard's keys: it gives each key a slot of its own among n slots without
storing keys. ``slots`` holds, for each slot, a 32-bit fingerprint of its key
and the document's place in the payload, so a lookup costs one hash, one
compare and one slice, and a key that is not stored is turned away by its
fingerprint (a stranger passes with probability 2^-32).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Emitter, KeyRanges, arrow_schema, shared_path, shuffle_partitions, text_rows
from .tokens import encoder, slices

#: Ids after which a shard is closed: what a reader holds at once (a longer document has a shard of its own).
SHARD_IDS = 2 << 20
#: Key ranges for each shuffle partition: several, so that their hashes fill the partitions evenly.
RANGES_PER_PARTITION = 4
SHARDS = ("shard long, range int, n_docs long, n_tokens long, first_key long, last_key long, "
          "width int, keys binary, index binary, slots binary, payload binary")
SLOT = np.dtype([("print", "<u4"), ("length", "<u8"), ("offset", "<u8")])
LOAD, LEVELS = 2.0, 40


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def stored_keys(ids: np.ndarray, nulls: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row: the document id, for repeated ids with the number
    of the repeat; a null id has a key of its own."""
    key = ids.astype(np.int64).view(np.uint64).copy()
    extra = repeats * 2 + nulls
    key[extra > 0] ^= mix(extra[extra > 0].astype(np.uint64), 91)
    return key


class PerfectHash:
    """Level by level: keys alone in their cell set its bit, the others go on to the
    next level; a key's slot is the number of set bits before its own."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.bits = np.concatenate([*levels, np.zeros(1, bool)])
        self.rank = np.concatenate([[0], np.cumsum(self.bits)])
        self.base = np.concatenate([[0], np.cumsum([len(x) for x in levels])]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels: list[np.ndarray] = []
        while len(keys) and len(levels) < LEVELS:
            size = int(len(keys) * LOAD) + 1
            cell = (mix(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(cell, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[cell]]
        return cls(levels, np.unique(keys))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slots; -1 for keys that meet no bit (some strangers do meet one)."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                break
            at = (mix(keys[open_], level + 1) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.rank[self.base[level] + at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = int(self.rank[-1]) + at[hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], dtype="<u4").tobytes()
        return sizes + np.packbits(self.bits[:-1]).tobytes() + self.rest.astype("<u8").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<u4", 1)[0])
        sizes = np.frombuffer(raw, "<u4", n, 4).astype(int)
        total, at = int(sizes.sum()), 4 + 4 * n
        bits = np.unpackbits(np.frombuffer(raw, np.uint8, (total + 7) // 8, at))[:total].astype(bool)
        cuts = np.cumsum(sizes)[:-1] if n else []
        return cls(np.split(bits, cuts) if n else [], np.frombuffer(raw[at + (total + 7) // 8 :], "<u8").astype(np.uint64))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 77) >> np.uint64(32)).astype(np.uint32)


class _Shard:
    def __init__(self):
        self.ids: list[int | None] = []
        self.raw: list[bytes] = []
        self.tokens = 0

    def row(self, number: int, range_: int, width: int, repeats: np.ndarray) -> tuple:
        nulls = np.array([i is None for i in self.ids])
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        keys = stored_keys(ids, nulls, repeats)
        lengths = np.array([len(r) // width for r in self.raw], dtype=np.int64)
        slots = np.zeros(len(keys), dtype=SLOT)
        hash_ = PerfectHash.build(keys)
        at = hash_.slot(keys)
        slots["print"][at], slots["length"][at] = fingerprints(keys), lengths
        slots["offset"][at] = np.cumsum(lengths) - lengths
        listed = np.zeros(len(keys), dtype=[("id", "<i8"), ("extra", "<u4")])
        listed["id"], listed["extra"] = ids, repeats * 2 + nulls
        known = ids[~nulls]
        return (range_ << 32 | number, range_, len(keys), self.tokens, *((int(known[0]), int(known[-1])) if len(known) else (None, None)),
                width, listed.tobytes(), hash_.dump(), slots.tobytes(), b"".join(self.raw))


def write_store(docs: DataFrame, vocabulary: str, end_id: int = 1, path: str | None = None, shard_ids: int = SHARD_IDS) -> str:
    """Encodes every text (null: empty), appends ``end_id`` and writes the shards in
    ascending doc_id order; returns the folder. Null ids come first; rows with the
    same id are ordered by their text and numbered. One shuffle of the texts by key
    range; a task holds one shard."""
    spark = docs.sparkSession
    rows = text_rows(docs)
    ranges = KeyRanges.of(rows, "doc_id", RANGES_PER_PARTITION * shuffle_partitions(spark))
    schema = arrow_schema(SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        width, end = enc.dtype.itemsize, np.array([end_id], dtype=enc.dtype).tobytes()
        out = Emitter(schema)
        shard, repeats, number, range_, last, repeat = _Shard(), [], 0, None, (None, False), 0

        def close() -> None:
            nonlocal shard, repeats, number
            if shard.ids:
                out.add(shard.row(number, range_, width, np.array(repeats, dtype=np.int64)), 2 * width * shard.tokens)
                number += 1
            shard, repeats = _Shard(), []

        for batch in batches:
            where, ids, texts = (batch.column(i).to_pylist() for i in range(3))
            for lo, hi in slices(len(texts), texts):
                for r, doc, raw in zip(where[lo:hi], ids[lo:hi], enc.encode(texts[lo:hi])):
                    if r != range_:
                        close()
                        range_, number, last = r, 0, (None, False)
                    elif shard.tokens + len(raw) // width >= shard_ids:
                        close()
                    repeat = repeat + 1 if last == (doc, True) else 0
                    last = (doc, True)
                    shard.ids.append(doc)
                    shard.raw.append(raw + end)
                    shard.tokens += len(raw) // width + 1
                    repeats.append(repeat)
                    if out.full():
                        yield from out.take()
        close()
        yield from out.take()

    path = path or shared_path(spark, "token-store")
    (rows.select(ranges.index(F.col("doc_id")).alias("range"), "doc_id", "text")
     .repartition(shuffle_partitions(spark), "range").sortWithinPartitions("range", F.col("doc_id").asc_nulls_first(), "text")
     .mapInArrow(run, SHARDS).write.option("compression", "zstd").parquet(path))
    return path


def open_store(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.sql import types as T

    return spark.read.schema(T._parse_datatype_string(SHARDS)).parquet(path)


def shard_starts(store: DataFrame) -> DataFrame:
    """(shard, shard_start): ids stored before each shard. The driver adds up one
    number for each key range, a fixed number of ranges; within a range Spark does."""
    spark = store.sparkSession
    sums = store.groupBy("range").agg(F.sum("n_tokens").alias("n")).orderBy("range").collect()
    before, total = [], 0
    for r in sums:
        before.append((r["range"], total))
        total += r["n"]
    base = F.broadcast(spark.createDataFrame(before, "range int, range_start long"))
    inside = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("range").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (store.select("shard", "range", "n_tokens").withColumn("inside", inside).join(base, "range")
            .select("shard", (F.col("range_start") + F.col("inside")).alias("shard_start")))


def _read(row: dict, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(found, offset, length) of each key by the shard's index."""
    hash_, slots = PerfectHash.load(row["index"]), np.frombuffer(row["slots"], dtype=SLOT)
    at = hash_.slot(keys)
    found = at >= 0
    found[found] = slots["print"][at[found]] == fingerprints(keys[found])
    place = slots[np.where(found, at, 0)] if len(slots) else np.zeros(len(keys), SLOT)
    return found, place["offset"].astype(np.int64), place["length"].astype(np.int64)


NEEDED = ("shard", "n_docs", "width", "keys", "index", "slots", "payload")


def read_all(store: DataFrame) -> DataFrame:
    """Every stored document by a keyed lookup of its own: doc_id, start, n_tokens,
    ids_crc32 of its ids as little-endian unsigned 32-bit integers."""
    out_ddl = "doc_id long, shard long, local_start long, n_tokens long, ids_crc32 long"
    schema = arrow_schema(out_ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(NEEDED)}
                listed = np.frombuffer(row["keys"], dtype=[("id", "<i8"), ("extra", "<u4")])
                nulls = (listed["extra"] & 1).astype(np.int64)
                found, offset, length = _read(row, stored_keys(listed["id"], nulls, (listed["extra"] >> 1).astype(np.int64)))
                if not found.all():
                    raise ValueError(f"shard {row['shard']}: {int((~found).sum())} keys are not in its index")
                payload = np.frombuffer(row["payload"], dtype=f"<u{row['width']}").astype("<u4")
                for doc, null, o, n in zip(listed["id"].tolist(), nulls.tolist(), offset.tolist(), length.tolist()):
                    out.add((None if null else doc, row["shard"], o, n, zlib.crc32(payload[o : o + n].tobytes())))
                if out.full():
                    yield from out.take()
        yield from out.take()

    docs = store.select(*NEEDED).mapInArrow(run, out_ddl)
    return (docs.join(shard_starts(store), "shard")
            .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"))


def lookup(store: DataFrame, doc_ids: list[int]) -> DataFrame:
    """The ids of a given list of documents: (doc_id, ids array<int>), no row for an
    absent key. The key ranges of the shards are pushed to the scan, so only the
    shards that may hold a key are read."""
    wanted = sorted(set(doc_ids))
    schema_ddl = "doc_id long, ids array<int>"
    schema = arrow_schema(schema_ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                row = {c: batch.column(k)[i].as_py() for k, c in enumerate(NEEDED)}
                keys = np.array(wanted, dtype=np.int64)
                found, offset, length = _read(row, keys.view(np.uint64))
                payload = np.frombuffer(row["payload"], dtype=f"<u{row['width']}")
                rows += [(int(keys[k]), payload[offset[k] : offset[k] + length[k]].astype(int).tolist()) for k in np.flatnonzero(found)]
            cols = list(zip(*rows)) if rows else [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    if not wanted:
        return store.sparkSession.createDataFrame([], schema_ddl)
    near = F.lit(False)
    for k in wanted:
        near = near | ((F.col("first_key") <= k) & (F.col("last_key") >= k))
    return store.where(near).select(*NEEDED).mapInArrow(run, schema_ddl)
