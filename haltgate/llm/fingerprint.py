"""Threshold-scaled document sketches.

A document's sketch holds every distinct shingle hash below a fixed fraction
of the hash range. The threshold is the same for all documents, so the sketch
of a union is the union of sketches, and the share of one sketch that occurs in
another estimates containment however unequal the two documents are. With every
second hash kept, containment is off by 0.03 in the mean; one in 2^n texts of n
shingles has no hash below the threshold. Kept are the first 32 bits of a hash
below the fraction, written as base64: some two fifths of the text's own length.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Emitter, KeyRanges, arrow_schema, shuffle_partitions, text_rows

SHINGLE_WORDS = 5
#: One hash in so many is kept, a power of two. (1 - 1 / SCALE)^n of the texts of n shingles have none below the threshold.
SCALE = 2
#: Key ranges, and partitions that sketch them, for each shuffle partition: several, as a row holds a text's sketch and its edited text's.
RANGES_PER_PARTITION = 4
#: Bytes of result rows handed on at once.
OUT_BYTES = 1 << 20
#: Bytes of a text whose words are hashed at once.
BLOCK = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(5).integers(1, 2**63, size=256, dtype=np.uint64)[_LOWER]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """A hash of each word between ASCII white space, A-Z as a-z."""
    data, out, start = np.frombuffer(raw, dtype=np.uint8), [], 0
    while start < len(data):
        end = min(start + BLOCK, len(data))
        while end < len(data) and not _SPACE[data[end]]:  # a block ends with a word
            gap = np.flatnonzero(_SPACE[data[end : end + BLOCK]])
            end = end + int(gap[0]) if len(gap) else min(end + BLOCK, len(data))
        part = data[start:end]
        word = ~_SPACE[part]
        edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            lengths = last - first
            letters = part[word]
            begin = np.cumsum(lengths) - lengths
            place = np.arange(len(letters)) - np.repeat(begin, lengths)
            power = np.full(int(lengths.max()), _BASE, dtype=np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            out.append(_mix(np.add.reduceat(_VALUE[letters] * power[place], begin) + lengths.astype(np.uint64)))
        start = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def sketch(text: str | None, scale: int = SCALE, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The kept hashes, ascending, with 32 bits below the fraction. Fewer words than a
    shingle: one shingle of all words; no words: empty. If no hash is below the
    threshold, the least stands in, so that only texts without words have an empty
    sketch."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    n = max(1, len(words) - shingle_words + 1)
    hashes = np.zeros(n, dtype=np.uint64)
    for k in range(min(shingle_words, len(words))):
        hashes = hashes * _BASE + words[k : k + n]
    hashes = _mix(hashes + _U(len(words) if len(words) < shingle_words else shingle_words)) & ~_U(2**32 // scale - 1)
    kept = np.unique(hashes[hashes <= _U(2**64 // scale - 1)])
    return kept if len(kept) else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The sketch of two documents' shingles together."""
    both = np.union1d(a, b)
    kept = both[both <= _U(2**64 // scale - 1)]
    return kept if len(kept) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has too. Two texts without words contain
    each other; one without words neither contains nor is contained by another. A
    hash that stands in is in no sketch but an equal one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a)


#: Marks a hash that stands in; no character of base64.
STAND_IN = ":"


def dump(a: np.ndarray, scale: int = SCALE) -> str:
    """The hashes' 32 bits as base64; a hash that stands in as 16 hex digits behind a colon."""
    if len(a) and a[0] > _U(2**64 // scale - 1):
        return f"{STAND_IN}{int(a[0]):016x}"
    return base64.b64encode((a // _U(2**32 // scale)).astype(">u4").tobytes()).decode()


def load(text: str, scale: int = SCALE) -> np.ndarray:
    if text.startswith(STAND_IN):
        return np.array([int(text[1:], 16)], dtype=np.uint64)
    return np.frombuffer(base64.b64decode(text), dtype=">u4").astype(np.uint64) * _U(2**32 // scale)


def fingerprint(text: Column, scale: int = SCALE, shingle_words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("string")
    def sketched(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: dump(sketch(t, scale, shingle_words), scale))

    return sketched(text)


def containment_of(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Containment of fingerprint a in fingerprint b."""
    @F.pandas_udf("double")
    def estimated(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([containment(load(p, scale), load(q, scale)) for p, q in zip(x, y)], dtype=float)

    return estimated(a, b)


def merged(df: DataFrame, by: str, fingerprint_col: str, scale: int = SCALE) -> DataFrame:
    """(``by``, hash): the sketch of each group's documents together, a row for each
    hash, so that no group is gathered anywhere."""
    @F.pandas_udf("array<long>")
    def hashes(x: pd.Series) -> pd.Series:
        return x.map(lambda t: load(t, scale).view(np.int64).tolist())

    rows = df.select(by, F.explode(hashes(fingerprint_col)).alias("hash")).distinct()
    # hashes above the threshold stand in for documents without one below it
    low = F.shiftrightunsigned("hash", 1) <= F.lit((2**64 // scale - 1) >> 1)
    some = rows.where(low).select(by).distinct()
    return rows.where(low).unionByName(rows.where(~low).join(some, by, "left_anti").groupBy(by).agg(F.min("hash").alias("hash")))


EDITS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double, near_edited_jaccard double, near_next_jaccard double")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def edit_likeness(docs: DataFrame, scale: int = SCALE, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``EDITS``: each document's fingerprint, that of its edited text, and how much of
    the document's fingerprint the edited text and the next document have.

    The edited text has its last floor(n/2) code points replaced by the first as
    many (or all) of the next document in ascending doc_id (after the last: the
    first). Null texts are empty; null ids come first; rows with the same id follow
    by text. A lone document is its own next. Other columns are ignored; an empty
    table gives no rows. One shuffle of the texts by key range: the document that
    starts a range is also sent, marked, to the range before."""
    spark = docs.sparkSession
    rows = text_rows(docs)
    ranges = KeyRanges.of(rows, "doc_id", RANGES_PER_PARTITION * shuffle_partitions(spark))
    count = len(ranges.starts)
    schema = arrow_schema(EDITS)

    def row(doc, text: str, own: np.ndarray, after: str, next_: np.ndarray) -> tuple:
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        changed = sketch(edited, scale, shingle_words) if edited != text else own
        return (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), dump(own, scale), dump(changed, scale),
                containment(own, changed), containment(own, next_), jaccard(own, changed), jaccard(own, next_))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held, range_, ended = Emitter(schema, max_bytes=OUT_BYTES), None, None, False
        for batch in batches:
            for r, guest, doc, text in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if r != range_:
                    range_, held, ended = r, None, False
                if ended:  # further rows with the next range's first id
                    continue
                own = sketch(text, scale, shingle_words)
                if held is not None:
                    done = row(*held, text, own)
                    out.add(done, 100 + len(done[3]) + len(done[4]))
                    if out.full():
                        yield from out.take()
                held, ended = (doc, text, own), guest
        yield from out.take()

    at = ranges.index(F.col("doc_id"))
    marked = rows.select(at.alias("own"), ranges.heads(F.col("doc_id")).alias("head"), "doc_id", "text")
    before = F.struct(((F.col("own") + count - 1) % count).alias("range"), F.lit(True).alias("guest"))
    here = F.struct(F.col("own").alias("range"), F.lit(False).alias("guest"))
    placed = marked.select(F.explode(F.when(F.col("head"), F.array(here, before)).otherwise(F.array(here))).alias("to"), "doc_id", "text")
    return (placed.select("to.range", "to.guest", "doc_id", "text")
            .repartition(RANGES_PER_PARTITION * shuffle_partitions(spark), "range").sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "text")
            .mapInArrow(run, EDITS))
