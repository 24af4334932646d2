"""Exact removal of long byte strings that occur more than once in the corpus.

Every window of ``length`` bytes names the least hashed ``GRAM``-gram inside it
as its anchor, so equal windows have equal anchors at equal offsets. The
windows of one anchor are a segment: a short string around the anchor. Then

1. equal texts are one text with a number of copies (all of a copied text goes);
2. equal segments are counted: all windows of a segment that occurs twice go;
3. of different segments around equal anchors, windows may still be equal.
   Such segments meet by anchor, and a run-length index over them
   (``run_length_index``) marks the windows that match another segment;
4. around an anchor with more than ``MAX_SEGMENTS`` different segments, these are
   cut into cells of windows by their distance from the anchor, the cells of
   which equal ones are counted as in 2 and different ones meet, as in 3, only
   if the bytes that all windows of the cell share are equal. Cells that are
   still too many are cut finer, down to single windows, so no anchor is ever
   gathered whole.

Shuffled are the distinct texts once (they are kept bucketed by their id for the
later joins), a row for each segment (one in about 150 bytes), and the segments
that share an anchor but are not equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Emitter, arrow_schema, shuffle_partitions, text_rows, write_buckets, write_table
from .run_length_index import RunLengthIndex

LENGTH = 400
GRAM = 100
MAX_SEGMENTS = 256
#: Windows of a cell around crowded anchors, ever finer.
CELLS = (32, 4, 1)
#: Bytes of segments that one run-length index holds.
INDEX_BYTES = 1 << 20
#: Bytes of a text whose windows are hashed at once.
BLOCK = 1 << 19

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_TABLE = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of substrings of a block by prefix sums modulo 2^64."""

    def __init__(self, size: int):
        self.size = size
        self.power = [_powers(b, size + 1) for b in _BASES]

    def prefix(self, data: np.ndarray, which: int) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * self.power[which][: len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [start, end): shifted to one power wherever they start, then mixed."""
        h = (prefix[end] - prefix[start]) * self.power[which][self.size - start]
        h ^= h >> _U(32)
        h *= _U(0xFF51AFD7ED558CCD)
        return h ^ (h >> _U(29))


_ROLLING: dict[int, Rolling] = {}


def rolling() -> Rolling:
    if 0 not in _ROLLING:
        _ROLLING[0] = Rolling(BLOCK)
    return _ROLLING[0]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by prefix and suffix minima of blocks of w."""
    n = len(x)
    pad = -n % w
    blocks = np.concatenate([x, np.full(pad, x.max(), dtype=x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.ascontiguousarray(np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def segments(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """(anchor hash, segment hash, first window, last window, anchor) of each segment of
    a text, windows by their start. A text is hashed block by block."""
    roll, parts = rolling(), []
    data = np.frombuffer(raw, dtype=np.uint8)
    for base in range(0, max(0, len(data) - length + 1), BLOCK - length + 1):
        block = data[base : base + BLOCK]
        n = len(block)
        one = roll.prefix(block, 0)
        at = np.arange(n - gram + 1)
        grams = roll.of(one, 0, at, at + gram)
        # the least hash, leftmost among equals, in one number; a block has fewer than 2^20 positions
        low = _U((1 << 20) - 1)
        anchor = (sliding_min((grams & ~low) | at.astype(np.uint64), length - gram + 1) & low).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [len(anchor) - 1]])
        where = anchor[first]
        whole = roll.of(roll.prefix(block, 1), 1, first, last + length)
        whole = (whole + (where - first).astype(np.uint64) * _U(_BASES[1])) ^ ((last - first).astype(np.uint64) << _U(48))
        parts.append(np.stack([grams[where].view(np.int64), whole.view(np.int64), first + base, last + base, where + base]))
    return list(np.concatenate(parts, axis=1)) if parts else [np.zeros(0, dtype=np.int64)] * 5


SEGMENTS = "key long, kind long, text_id binary, first int, last int, lead int, copies long"
CELL_ROWS = SEGMENTS + ", bytes binary"
WINDOWS = "text_id binary, first int, last int"


def _batches(parts: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One batch of parts, whose columns are arrays or one value for the whole part."""
    if parts:
        sizes, cols = [len(p[0]) for p in parts], []
        for i, f in enumerate(schema):
            if isinstance(parts[0][i], np.ndarray):
                cols.append(pa.array(np.concatenate([p[i] for p in parts])).cast(f.type))
            elif isinstance(parts[0][i], list):
                cols.append(pa.array([x for p in parts for x in p[i]], type=f.type))
            else:
                cols.append(pa.array([p[i] for p, n in zip(parts, sizes) for _ in range(n)], type=f.type))
        yield pa.RecordBatch.from_arrays(cols, schema=schema)


def _segment_rows(length: int, gram: int):
    """Rows (text_id, text, copies) -> ``SEGMENTS``."""
    schema = arrow_schema(SEGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for id_, text, copies in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                anchor, segment, first, last, at = segments(text.encode(), length, gram)
                if len(anchor):
                    parts.append((anchor, segment, id_, first, last, at - first, copies))
                    size += len(anchor)
                if size > 50_000:
                    yield from _batches(parts, schema)
                    parts, size = [], 0
            yield from _batches(parts, schema)

    return run


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _indexed_matches(length: int, index_bytes: int):
    """Rows (key, text_id, first, copies, bytes), sorted by key -> runs of matching windows
    of the texts that have one copy."""
    schema = arrow_schema(WINDOWS)

    def match(block: list[tuple]) -> Iterator[tuple]:
        stats = RunLengthIndex.build([row[-1] for row in block]).matching_statistics()
        at = 0
        for text_id, first, copies, raw in block:
            start, end = _runs(stats[at : at + len(raw) - length + 1] >= length)
            at += len(raw)
            if copies == 1:
                for s, e in zip(start.tolist(), end.tolist()):
                    yield text_id, first + s, first + e - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        block, size, group = [], 0, None
        for batch in batches:
            for key, *row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if key != group and size >= index_bytes:
                    for r in match(block):
                        out.add(r)
                    block, size = [], 0
                    if out.full():
                        yield from out.take()
                group = key
                block.append(tuple(row))
                size += len(row[-1])
        if block:
            for r in match(block):
                out.add(r)
        yield from out.take()

    return run


def _cells(length: int, width: int):
    """Rows (key, text_id, first, lead, copies, bytes) -> ``CELL_ROWS``. A cell holds the
    windows whose distance from the anchor is the same multiple of ``width``; its key
    is that of its segment with the cell and the bytes that all such windows share."""
    schema = arrow_schema(CELL_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = rolling()
        for batch in batches:
            parts, size = [], 0
            for key, id_, first, lead, copies, raw in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                data = np.frombuffer(raw, dtype=np.uint8)
                cell = (lead - np.arange(len(data) - length + 1)) // width
                begin = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1])
                end = np.concatenate([begin[1:], [len(cell)]]) - 1
                one, two = roll.prefix(data, 0), roll.prefix(data, 1)
                shared = lead - cell[begin] * width  # from here, in bytes of the segment
                core = roll.of(one, 0, shared, shared + length - width + 1)
                core = (core ^ _U(key & (2**64 - 1))) * _U(_BASES[0]) + cell[begin].astype(np.uint64) * _U(_BASES[1])
                kind = roll.of(two, 1, begin, end + length) ^ ((end - begin).astype(np.uint64) << _U(48)) ^ (end - shared).astype(np.uint64)
                parts.append((core.view(np.int64), kind.view(np.int64), id_, begin + first, end + first, lead - begin, copies,
                              [raw[b : e + length] for b, e in zip(begin.tolist(), end.tolist())]))
                size += len(begin)
                if size > 10_000:
                    yield from _batches(parts, schema)
                    parts, size = [], 0
            yield from _batches(parts, schema)

    return run


def text_id(text):
    return F.unhex(F.md5(text))


def _decide(rows: DataFrame, *carried: str) -> tuple[DataFrame, DataFrame]:
    """(equal, open) of rows with a key and a kind: ``WINDOWS`` of the rows whose kind
    occurs twice, and one row of each kind under a key that has several, with the
    number of ``kinds``."""
    distinct = rows.groupBy("key", "kind").agg(
        F.count("*").alias("times"), F.min(F.struct("text_id", "first", "last", "lead", "copies", *carried)).alias("one"))
    several = distinct.groupBy("key").agg(F.count("*").alias("kinds"), F.max("times").alias("most")).where("kinds > 1 or most > 1")
    known = write_table(distinct.join(several, "key").select("key", "kind", "times", "kinds", "one.*"), "kinds")
    equal = (rows.where("copies = 1").select("key", "kind", "text_id", "first", "last")
             .join(known.where("times > 1").select("key", "kind"), ["key", "kind"]).select("text_id", "first", "last"))
    return equal, known.where("kinds > 1")


def repeated_windows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, max_segments: int = MAX_SEGMENTS,
                     index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``WINDOWS``: ranges of starts of windows that occur at another position, for the
    texts (text_id, text, copies) that have one copy. Text ids are unique; texts
    shorter than ``length`` have no window."""
    parts = shuffle_partitions(texts.sparkSession)
    rows = write_table(texts.select("text_id", "text", "copies").mapInArrow(_segment_rows(length, gram), SEGMENTS), "segments")
    found, open_ = _decide(rows)

    # the bytes of the segments that are still open, cut out of their texts
    wanted = open_.groupBy("text_id").agg(F.collect_list(F.struct("key", "kinds", "first", "last", "lead", "copies")).alias("cut"))
    raw = F.encode("text", "utf-8")
    pieces = write_table(
        texts.select("text_id", "text").join(wanted, "text_id").select("text_id", raw.alias("raw"), "cut").select(
            "text_id", F.transform("cut", lambda c: F.struct(
                *[c[k].alias(k) for k in ("key", "kinds", "first", "lead", "copies")],
                F.substring(F.col("raw"), c["first"] + 1, c["last"] - c["first"] + length).alias("bytes"))).alias("cut"))
        .select("text_id", F.explode("cut").alias("c")).select("text_id", "c.*"), "pieces")

    def few_and_many(open_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        few = open_rows.where(F.col("kinds") <= max_segments).select("key", "text_id", "first", "copies", "bytes")
        return few, open_rows.where(F.col("kinds") > max_segments).select("key", "text_id", "first", "lead", "copies", "bytes")

    few, many = few_and_many(pieces)
    for width in CELLS:
        if many.isEmpty():
            break
        cells = write_table(many.mapInArrow(_cells(length, width), CELL_ROWS), "cells")
        equal, open_ = _decide(cells, "bytes")
        found = found.unionByName(equal)
        less, many = few_and_many(open_)
        few = few.unionByName(less)
    indexed = (few.repartition(parts, "key").sortWithinPartitions("key")
               .mapInArrow(_indexed_matches(length, index_bytes), WINDOWS))
    return found.unionByName(indexed)


def _cut_texts(length: int):
    """(text_id, text, ranges) -> what is left of the text."""
    schema = arrow_schema(CUTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Emitter(schema)
        for batch in batches:
            for id_, text, ranges in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                raw = text.encode()
                step = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(step, [r["first"] for r in ranges], 1)
                np.add.at(step, [r["last"] + length for r in ranges], -1)
                gone = np.cumsum(step[:-1]) > 0
                kept = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
                out.add((id_, int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest(),
                         kept.decode("utf-8", errors="ignore")), len(kept) + 200)
                if out.full():
                    yield from out.take()
        yield from out.take()

    return run


CUTS = "text_id binary, n_removed long, n_spans long, kept_sha256 string, kept_text string"
NOTHING = hashlib.sha256(b"").hexdigest()


def _distinct_texts(rows: DataFrame) -> DataFrame:
    """(text_id, text, copies), written in buckets of the text id, so that joins on it
    move only their other side."""
    once = (rows.select(text_id(F.col("text")).alias("text_id"), "text")
            .groupBy("text_id").agg(F.first("text").alias("text"), F.count("*").alias("copies")))
    return write_buckets(once, "texts", "text_id")


def removals(docs: DataFrame, length: int = LENGTH, **params) -> DataFrame:
    """``CUTS`` for every distinct text that loses bytes; see ``removed``."""
    texts = _distinct_texts(text_rows(docs).where(F.octet_length("text") >= length))
    ranges = repeated_windows(texts, length, **params)
    marked = ranges.groupBy("text_id").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    some = texts.join(marked, "text_id").select("text_id", "text", "ranges").mapInArrow(_cut_texts(length), CUTS)
    whole = texts.where("copies > 1").select(
        "text_id", F.octet_length("text").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(NOTHING).alias("kept_sha256"), F.lit("").alias("kept_text"))
    return write_table(some.unionByName(whole), "cuts")


def removed(docs: DataFrame, length: int = LENGTH, **params) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): every byte covered by a string
    of ``length`` bytes that also starts at another place of the corpus goes, judged
    on the input; matches end with the text.

    A null text is empty; a text shorter than ``length`` loses nothing. Repeated rows
    are copies of each other; a null doc_id stays null. Other columns are ignored; an
    empty table gives no rows."""
    cuts = removals(docs, length, **params).drop("kept_text")
    rows = text_rows(docs).select(
        "doc_id", text_id(F.col("text")).alias("text_id"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    none = F.lit(0).cast("long")
    return rows.join(cuts, "text_id", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def cut_documents(docs: DataFrame, length: int = LENGTH, **params) -> DataFrame:
    """The documents with what is left of their texts; all columns and rows stay, and
    ``n_chars``, where there is one, is counted anew. Bytes of a code point that lost
    others are dropped with them. A null text stays null."""
    cuts = removals(docs, length, **params).select(F.col("text_id"), "kept_text")
    # the documents travel as one column, so that theirs and these cannot clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    out = rows.withColumn("text_id", text_id(F.coalesce(F.col("doc.text").cast("string"), F.lit("")))).join(cuts, "text_id", "left")
    kept, columns = F.col("kept_text"), []
    for name, kind in docs.dtypes:
        own = F.col("doc").getField(name)
        if name == "text":
            own = F.coalesce(kept, own)
        elif name == "n_chars":
            own = F.when(kept.isNull(), own).otherwise(F.length(kept)).cast(kind)
        columns.append(own.alias(name))
    return out.select(*columns)
