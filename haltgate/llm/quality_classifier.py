"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed in the tasks that read the texts. The trees are grown
on the driver from the statistics of a bounded sample of labelled documents
and flattened into arrays; scoring walks all trees of a batch in numpy, one
step down for all rows at a time.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, text_rows

#: Most labelled documents to learn from (those with the least hash of their id).
TRAIN_ROWS = 20_000
KEEP_SCORE = 0.7

# -- statistics ---------------------------------------------------------------

STATISTICS = (
    "log_words", "log_chars", "mean_word_chars", "std_word_chars", "long_words", "distinct_words", "top_word", "repeated_next",
    "upper", "digits", "spaces", "punctuation", "symbols", "exclamations", "pipes", "non_ascii", "distinct_bytes", "entropy",
    "lines_per_word", "duplicate_lines", "short_lines", "worst_part_symbols", "worst_part_upper", "worst_part_distinct", "compressed",
)

_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\v\f\r", b".,;:?\"'()-", b"#*$%&<>@^~=+_{}[]\\/`", b"!", b"|", bytes(range(128, 256)))
_IN_CLASS = np.array([[float(c in chars) for c in range(256)] for chars in _CLASSES])
_UPPER, _SYMBOL = _IN_CLASS[0].astype(np.uint8), (_IN_CLASS[4] + _IN_CLASS[5] + _IN_CLASS[6]).astype(np.uint8)
#: Parts whose worst values count: words, and bytes.
PART_WORDS, PART_BYTES = 100, 600


def _worst(flags: np.ndarray) -> float:
    """The greatest share of set flags in any part (a short last part joins the one before)."""
    starts = np.arange(0, max(len(flags) - PART_BYTES // 2, 1), PART_BYTES)
    sizes = np.diff(np.append(starts, len(flags)))
    return float((np.add.reduceat(flags, starts, dtype=np.int64) / sizes).max())


def statistics(text: str | None) -> list[float]:
    """``STATISTICS`` of a whole text; finite for every text, the empty one included."""
    text = text or ""
    raw = text.encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(raw, dtype=np.uint8)
    counts = np.bincount(data, minlength=256)
    words = text.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) if words else np.zeros(1, dtype=np.int64)
    found = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    share = counts[counts > 0] / len(raw)
    parts = [words[s : s + PART_WORDS] for s in range(0, max(len(words) - PART_WORDS // 2, 1), PART_WORDS)]
    return [
        math.log1p(len(words)), math.log1p(len(text)), float(lengths.mean()), float(lengths.std()), float((lengths > 20).mean()),
        len(found) / n, max(found.values(), default=0) / n, sum(map(eq, words, words[1:])) / n, *(_IN_CLASS @ counts / len(raw)).tolist(),
        float(len(share)), float(-(share * np.log2(share)).sum()), len(lines) / n,
        1 - len(set(lines)) / max(len(lines), 1), sum(len(x) < 30 for x in lines) / max(len(lines), 1),
        _worst(_SYMBOL[data]), _worst(_UPPER[data]), min(len(set(p)) / max(len(p), 1) for p in parts), len(zlib.compress(raw, 1)) / len(raw),
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(STATISTICS))


# -- trees ----------------------------------------------------------------------

@dataclass
class Trees:
    """All trees in flat arrays. Node i of a tree has its children at 2i+1 and 2i+2;
    ``feature`` is -1 at a leaf. A row goes left where its value is below or at the threshold."""

    feature: np.ndarray  # (trees, nodes)
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        trees, rows = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(self.depth):
            feature = self.feature[trees, node]
            right = x[rows, np.maximum(feature, 0)] > self.threshold[trees, node]
            node = np.where(feature >= 0, 2 * node + 1 + right, node)
        return self.bias + self.value[trees, node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for i in range(0, len(x), 2048):
            out[i : i + 2048] = 1 / (1 + np.exp(-np.clip(self.raw(x[i : i + 2048]), -30, 30)))
        return out


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.1,
         l2: float = 2.0, least_rows: int = 10) -> Trees:
    """Boosted trees for the log loss. Values are binned once; a level's splits come from
    histograms of gradients over (node, feature, bin)."""
    n, width, nodes = len(x), x.shape[1], 2 ** (depth + 1) - 1
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, width), int)
    rate_one = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    out = Trees(np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes)), depth, float(np.log(rate_one / (1 - rate_one))))
    score = np.full(n, out.bias)
    columns = np.arange(width) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            live = node >= first
            cell = ((node[live] - first)[:, None] * (width * bins) + columns + binned[live]).ravel()
            shape = (count, width, bins)
            hist = [np.bincount(cell, np.repeat(v[live], width), count * width * bins).reshape(shape).cumsum(axis=2) for v in (g, h, np.ones(n))]
            gl, hl, nl = hist
            gt, ht, nt = (a[:, :, -1:] for a in hist)
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(nl < least_rows) | (nt - nl < least_rows)] = -1
            for f, e in enumerate(edges):
                gain[:, f, len(e):] = -1
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6:
                    out.feature[t, first + k], out.threshold[t, first + k] = f, edges[f][b]
            feature = out.feature[t, node]
            split = live & (feature >= 0)
            right = x[np.arange(n), np.maximum(feature, 0)] > out.threshold[t, node]
            node = np.where(split, 2 * node + 1 + right, node)
        sums = [np.bincount(node, v, nodes) for v in (g, h)]
        out.value[t] = -rate * sums[0] / (sums[1] + l2)
        score += out.value[t, node]
    return out


# -- Spark ------------------------------------------------------------------------

def held_out(key: Column, folds: int, fold: int) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % folds == fold


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled documents outside the held-out fold,
    those whose id has the least hash. Only their ids are broadcast: a bounded number."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .where(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
              .groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return text_rows(docs).join(F.broadcast(chosen), "doc_id")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """(doc_id, y, x): the statistics of at most ``rows`` rows of the sample. Repeats of an
    id with the same text are one row; of ids with several texts, those rows stay whose id
    and text have the least hash, so that each text counts alike."""
    schema = arrow_schema("doc_id long, y int, digest string, x array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(list(x), type=schema.field(3).type)], schema=schema)

    sample = training_sample(docs, labels, label, folds, fold, rows).select("doc_id", "y", F.sha2("text", 256).alias("digest"), "text")
    distinct = sample.mapInArrow(run, "doc_id long, y int, digest string, x array<double>").dropDuplicates(["doc_id", "digest"])
    return distinct.orderBy(F.xxhash64("doc_id", "digest"), "doc_id", "digest").limit(rows).select("doc_id", "y", "x")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, fold: int = 2,
          rows: int = TRAIN_ROWS, **params) -> Trees:
    """Trees from a bounded sample. The driver gets at most ``rows`` rows of statistics.
    Without labels every score is one half."""
    got = sorted(training_rows(docs, labels, label, folds, fold, rows).collect(), key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in got], dtype=float).reshape(len(got), len(STATISTICS))
    return grow(x, np.array([r.y for r in got], dtype=float), **params)


def score(docs: DataFrame, model: Trees, column: str = "score") -> DataFrame:
    """The documents' columns under ``doc`` and their score. A null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of trees

    @F.pandas_udf(T.DoubleType())
    def scored(texts):
        import pandas as pd

        return pd.Series(shared.value.score(matrix(texts.tolist())), dtype=float)

    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(doc, scored(F.col("text").cast("string")).alias(column))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, fold: int = 2,
             keep_score: float = KEEP_SCORE, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc`` (the input's columns), held_out, score, predicted.

    Scores depend on the text alone. Null and empty texts are scored like any other;
    repeated rows are scored each; a null doc_id is not held out and stays null;
    an empty table gives no rows. Labelled rows that disagree count as the greater."""
    model = train(docs, labels, label, folds, fold, rows)
    held = F.coalesce(held_out(F.col("doc.doc_id").cast("long"), folds, fold), F.lit(False))
    return score(docs, model).select("doc", held.alias("held_out"), "score", (F.col("score") >= keep_score).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """The documents predicted to be of quality, with their own columns."""
    return classify(docs, labels, **params).where("predicted = 1").select("doc.*")
