"""Bounded-space online packing of documents into token windows.

Each partition keeps a fixed number of open windows. A piece goes into the
window it fits best; when none fits, the fullest window is emitted and a new
one is opened. What is still open when a partition ends is merged with the
leftovers of other partitions, groups of partitions at a time.

Documents longer than a window are cut into full windows and a rest. Nothing
is shuffled but the pieces of leftover windows: a fixed number of windows for
each partition.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Emitter, arrow_schema, text_rows, write_table
from .tokens import encoder, slices

WINDOW = 4096
OPEN_WINDOWS = 128
#: Partitions whose leftovers one task merges.
MERGE_PARTITIONS = 16
MERGED = 1 << 62

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


class OpenWindows:
    """A fixed number of open windows; ``place`` returns the windows it had to emit."""

    def __init__(self, size: int, count: int):
        self.size, self.count = size, count
        self.by_room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.pieces: dict[int, list[tuple]] = {}
        self.opened = 0

    def place(self, piece: tuple, length: int) -> list[list[tuple]]:
        emitted = []
        at = bisect_left(self.by_room, (length, -1))  # the least room that still holds the piece
        if at < len(self.by_room):
            room, window = self.by_room.pop(at)
        else:
            if len(self.by_room) >= self.count:
                _, fullest = self.by_room.pop(0)
                emitted.append(self.pieces.pop(fullest))
            room, window = self.size, self.opened
            self.opened += 1
            self.pieces[window] = []
        self.pieces[window].append(piece)
        if room == length:
            emitted.append(self.pieces.pop(window))
        else:
            insort(self.by_room, (room - length, window))
        return emitted

    def rest(self) -> list[list[tuple]]:
        return [self.pieces[w] for _, w in self.by_room]


def _lay(pieces: list[tuple], sequence: int | None) -> list[tuple]:
    """Rows of one window: (doc_id, start, length, crc, doc_tokens) with gapless offsets."""
    used, rows, total = 0, [], sum(p[2] for p in pieces)
    for p in pieces:
        rows.append((*p, sequence, used, total))
        used += p[2]
    return rows


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW,
         open_windows: int = OPEN_WINDOWS, merge_partitions: int = MERGE_PARTITIONS, keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``PIECES``, and ``padded_length``, the length at which the
    sequence is stored: ``window``, or its own number of tokens if that is a power of two.

    A null or empty text is its end id alone. Repeated rows are packed each;
    a null doc_id stays null. Other columns are ignored; an empty table gives
    no rows. Sequence ids are unique, not dense. Without ``keep_ids`` a worker drops
    the ids of chunks after each partition, for jobs whose other steps need the memory."""
    schema = arrow_schema(PIECES + ", part int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, serial = encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        windows, out = OpenWindows(window, open_windows), Emitter(schema)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(len(texts), texts):
                for doc, raw in zip(ids[lo:hi], enc.encode(texts[lo:hi])):
                    raw = np.frombuffer(raw, dtype=enc.dtype).astype("<u4").tobytes() + end
                    total = len(raw) // 4
                    for start in range(0, total, window):
                        piece = raw[start * 4 : (start + window) * 4]
                        length = len(piece) // 4
                        for done in windows.place((doc, start, length, zlib.crc32(piece), total), length):
                            for row in _lay(done, part << 32 | serial):
                                out.add((*row, part))
                            serial += 1
                    if out.full():
                        yield from out.take()
        if not keep_ids:
            enc.forget()
        for left in windows.rest():
            for row in _lay(left, None):
                out.add((*row, part))
        yield from out.take()

    placed = write_table(text_rows(docs).mapInArrow(run, PIECES + ", part int"), "packed")
    merged = merge_leftovers(placed.where("sequence_id is null"), window, merge_partitions)
    cols = [c.split()[0] for c in PIECES.split(", ")]
    full = placed.where("sequence_id is not null").select(cols).unionByName(merged.select(cols))
    tokens = F.col("sequence_tokens")
    return full.withColumn("padded_length", F.when(F.bit_count(tokens) == 1, tokens).otherwise(F.lit(window)).cast("long"))


def merge_leftovers(pieces: DataFrame, window: int = WINDOW, merge_partitions: int = MERGE_PARTITIONS) -> DataFrame:
    """Packs the pieces of leftover windows anew, longest first by best fit, for
    ``merge_partitions`` partitions at a time: at most that many times the open
    windows of a partition meet in one task."""

    schema = arrow_schema(PIECES)

    def merge(key, group):
        rows = list(zip(*[group.column(c).to_pylist() for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]))
        rows.sort(key=lambda r: (-r[2], r[0] is None, r[0] or 0, r[1]))
        windows, done = OpenWindows(window, len(rows) + 1), []
        for r in rows:
            done += windows.place(r, r[2])
        laid = []
        for n, w in enumerate(done + windows.rest()):
            laid += _lay(w, MERGED | key[0].as_py() << 32 | n)
        return pa.table([pa.array(c, type=f.type) for c, f in zip(zip(*laid), schema)], schema=schema)

    return (pieces.withColumn("merge_group", (F.col("part") / merge_partitions).cast("long"))
            .groupBy("merge_group").applyInArrow(merge, PIECES))
