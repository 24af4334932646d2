"""Toxicity: a word classifier trained with counterfactual pairs.

The score of a text depends on which words of a learned vocabulary it has.
For every labelled document one sentence is rewritten: a mention of a group of
people is swapped for another group, or, where there is none, planted. The
training loss adds the squared change of the score's logit between the two,
so that naming a group can neither raise nor lower a score by itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, write_table
from .quality_classifier import held_out, training_sample

#: Most labelled documents to learn from (those with the least hash of their id).
TRAIN_ROWS = 20_000
VOCABULARY = 2_000
#: A word of the vocabulary is in so many documents of the sample, and its count among the
#: labelled ones is so many standard deviations from chance.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_DISTANCE = 5, 0.001, 4.0
FLAG_SCORE = 0.5
PAIR_WEIGHT = 4.0
L1 = 5e-5

# Neutral names of groups of people, singular and plural apart.
IDENTITY_TERMS = (
    "women men woman man girls boys muslims muslim christians christian jews jewish hindus hindu buddhists buddhist atheists "
    "black white asian african european american mexican arab indian chinese german french spanish gay lesbian straight bisexual "
    "transgender queer immigrants immigrant refugees refugee disabled deaf blind elderly young old poor rich "
    "frauen männer muslime christen juden schwarze weiße flüchtlinge ausländer femmes hommes musulmans chrétiens juifs noirs blancs "
    "réfugiés immigrés mujeres hombres musulmanes cristianos judíos negros blancos refugiados inmigrantes"
).split()

WORDS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: str | None) -> set[str]:
    return set(WORDS.findall(text.lower())) if text else set()


def counterfactual(text: str | None, terms: tuple[str, ...] = tuple(IDENTITY_TERMS)) -> tuple[str, str]:
    """Two versions of a text that differ in the group one sentence names. Which
    sentence and which groups follow from the text itself."""
    text = text or ""
    pick = zlib.crc32(text.encode())
    known = set(terms)
    sentences = [s for s in SENTENCE.split(text) if s.strip()] or [""]
    naming = [i for i, s in enumerate(sentences) if known & words_of(s)]
    at = naming[pick % len(naming)] if naming else pick % len(sentences)
    first, second = terms[pick % len(terms)], terms[(pick // len(terms)) % len(terms)]
    if second == first:
        second = terms[(terms.index(first) + 1) % len(terms)]

    def put(term: str) -> str:
        if naming:
            new = WORDS.sub(lambda m: term if m.group().lower() in known else m.group(), sentences[at])
        else:
            new = f"{sentences[at]} {term}"
        return "\n".join([*sentences[:at], new, *sentences[at + 1 :]])

    return (text if naming else put(first)), put(second)


@dataclass
class Model:
    words: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        weight = {w: self.weights[k] for w, k in self.words.items() if self.weights[k]}
        known = weight.keys()
        logits = [self.bias + sum(weight[w] for w in sorted(known & words_of(t))) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(logits, dtype=float), -30, 30)))


def fit(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], width: int, l1: float = L1,
        pair_weight: float = PAIR_WEIGHT, steps: int = 1000) -> tuple[np.ndarray, float]:
    """Weights and bias of the least log loss plus ``pair_weight`` times the mean squared
    change of the logit within pairs, with an L1 penalty: accelerated proximal gradient."""
    n = max(len(rows), 1)
    r = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    c = np.array([k for x in rows for k in x], dtype=np.int64)
    pr, pc, ps = [], [], []
    for i, (a, b) in enumerate(pairs):
        for k in set(a) ^ set(b):
            pr.append(i), pc.append(k), ps.append(1.0 if k in a else -1.0)
    pr, pc, ps = np.array(pr, dtype=np.int64), np.array(pc, dtype=np.int64), np.array(ps)
    m = max(len(pairs), 1)
    # a bound of the curvature: the longest row for the loss, two terms a pair for the rest
    longest = max((len(x) for x in rows), default=0) + 1
    step = 1 / (0.25 * min(longest, 64) + 2 * pair_weight)
    rate = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    w, b, w_, b_, t = np.zeros(width), float(np.log(rate / (1 - rate))), np.zeros(width), float(np.log(rate / (1 - rate))), 1.0
    for _ in range(steps):
        z = np.bincount(r, w_[c], n)[: len(rows)] + b_
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        change = np.bincount(pr, ps * w_[pc], m)
        grad = np.bincount(c, g[r], width) / n + 2 * pair_weight * np.bincount(pc, ps * change[pr], width) / m
        new = w_ - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        new_b = b_ - step * (g.sum() / n)
        t_ = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w_, b_ = new + (t - 1) / t_ * (new - w), new_b + (t - 1) / t_ * (new_b - b)
        w, b, t = new, new_b, t_
    return w, b


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0, rows: int = TRAIN_ROWS,
          vocabulary: int = VOCABULARY, **params) -> Model:
    """A model from a bounded sample. Words are counted by Spark; the driver gets the
    ``vocabulary`` words that tell the labels apart best and, for each document of
    the sample, the numbers of those it has. Equal texts count once; of ids that repeat with
    many texts, those stay whose digest has the least hash, ``rows`` texts in all."""
    texts = training_sample(docs, labels, label, folds, fold, rows).groupBy("text").agg(F.max("y").alias("y"))
    texts = write_table(texts.withColumn("digest", F.sha2("text", 256)), "toxicity-sample")
    least = texts.select("digest").orderBy(F.xxhash64("digest"), "digest").limit(rows)
    sample = texts.join(F.broadcast(least), "digest", "left_semi").select("text", "y")
    identity = set(IDENTITY_TERMS)

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = sorted(words_of(text))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], names=["word", "y"])

    totals = sample.agg(F.count("*").alias("n"), F.sum("y").alias("pos")).first()
    n, pos = totals.n, totals.pos or 0
    if not 0 < pos < n:
        return Model({}, np.zeros(0), 30.0 if n and pos == n else -30.0 if n else 0.0)
    share = pos / n
    counts = (sample.mapInArrow(list_words, "word string, y int").groupBy("word").agg(F.count("*").alias("df"), F.sum("y").alias("pos"))
              .where(F.col("df") >= max(LEAST_DOCUMENTS, LEAST_SHARE * n)))
    distance = F.abs(F.col("pos") - F.col("df") * share) / F.sqrt(F.col("df") * share * (1 - share) + 1)
    top = counts.where(distance >= LEAST_DISTANCE).orderBy(distance.desc(), "word").limit(vocabulary).select("word").collect()
    words = {w: k for k, w in enumerate(sorted({x.word for x in top} | identity))}

    schema = arrow_schema("y int, x array<int>, a array<int>, b array<int>")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = words.keys()
        pick = lambda t: sorted(words[w] for w in known & words_of(t))
        for batch in batches:
            out = [(y, pick(t), *map(pick, counterfactual(t))) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema)], schema=schema)

    got = sorted((r.x, r.y, r.a, r.b) for r in sample.mapInArrow(features, "y int, x array<int>, a array<int>, b array<int>").collect())
    weights, bias = fit([g[0] for g in got], np.array([g[1] for g in got], dtype=float), [(g[2], g[3]) for g in got], len(words), **params)
    return Model(words, weights, bias)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The documents' columns under ``doc`` and their score. A null text has no words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bounded vocabulary

    @F.pandas_udf(T.DoubleType())
    def scored(texts):
        import pandas as pd

        return pd.Series(shared.value.score(texts.tolist()), dtype=float)

    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(doc, scored(F.col("text").cast("string")).alias(column))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0,
             flag_score: float = FLAG_SCORE, rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc`` (the input's columns), held_out, score, predicted.

    Scores depend on the text alone. Null and empty texts are scored like any other;
    repeated rows are scored each; a null doc_id is not held out and stays null; an
    empty table gives no rows. Labelled rows that disagree count as the greater."""
    model = train(docs, labels, label, folds, fold, rows)
    held = F.coalesce(held_out(F.col("doc.doc_id").cast("long"), folds, fold), F.lit(False))
    return score(docs, model).select("doc", held.alias("held_out"), "score", (F.col("score") >= flag_score).cast("int").alias("predicted"))
