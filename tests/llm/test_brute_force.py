"""The trained queries as wholes, against plain versions of their training and scoring."""

import math
import re
import zlib

import numpy as np
import pytest

from haltgate.llm import quality_classifier as Q
from haltgate.llm import toxicity as X
from haltgate.llm.queries import QUERIES


@pytest.fixture(scope="module")
def rows(spark, sf):
    """(doc_id, text) of all documents and {doc_id: label} of each kind of label."""
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    return docs, {k: {r.doc_id: r[k] for r in labels if r[k] is not None} for k in ("quality", "toxic")}


def fold(doc, folds):
    return zlib.crc32(str(doc).encode()) % folds


# -- trees, row by row ---------------------------------------------------------------


def plain_tree(x, g, h, members, edges, depth, l2=2.0, least=10):
    """Nested (feature, threshold, left, right) or a leaf's value, from sums over every split."""
    gt, ht = math.fsum(g[i] for i in members), math.fsum(h[i] for i in members)
    best = (1e-6, None)
    if depth:
        for f, cuts in enumerate(edges):
            for cut in cuts:
                left = [i for i in members if x[i][f] <= cut]
                if least <= len(left) <= len(members) - least:
                    gl, hl = math.fsum(g[i] for i in left), math.fsum(h[i] for i in left)
                    gain = gl * gl / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt * gt / (ht + l2)
                    if gain > best[0] + 1e-9:  # of equal splits the first
                        best = (gain, (f, cut))
    if best[1] is None:
        return -0.1 * gt / (ht + l2)
    f, cut = best[1]
    sides = [[i for i in members if (x[i][f] <= cut) == left] for left in (True, False)]
    return (f, cut, *[plain_tree(x, g, h, s, edges, depth - 1, l2, least) for s in sides])


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def boosted(x, y, trees):
    rate = min(max(sum(y) / len(y), 1e-3), 1 - 1e-3)
    bias, grown = math.log(rate / (1 - rate)), []
    edges = [sorted(set(np.quantile([r[f] for r in x], [k / 64 for k in range(1, 64)]).tolist())) for f in range(len(x[0]))]
    score = [bias] * len(x)
    for _ in range(trees):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grown.append(plain_tree(x, [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p], list(range(len(x))), edges, 4))
        score = [s + walk(grown[-1], r) for s, r in zip(score, x)]
    return lambda row: 1 / (1 + math.exp(-(bias + sum(walk(t, row) for t in grown))))


def test_quality_query(spark, sf, rows, monkeypatch):
    docs, labels = rows
    grow, trees = Q.grow, 6
    monkeypatch.setattr(Q, "grow", lambda x, y, **k: grow(x, y, trees=trees))
    train = sorted((d, Q.statistics(t), labels["quality"][d]) for d, t in docs if d in labels["quality"] and fold(d, 4) != 2)
    score = boosted([r[1] for r in train], [r[2] for r in train], trees)
    got = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, sf).collect()}
    assert set(got) == {d for d, _ in docs}
    near = 0
    for d, t in docs:
        assert got[d].held_out == (fold(d, 4) == 2) and got[d].predicted == int(got[d].score >= 0.7)
        near += abs(got[d].score - score(Q.statistics(t))) < 1e-9
    assert near >= 0.99 * len(docs)  # sums in another order may part equal splits


# -- the counterfactual classifier, sum by sum -----------------------------------------


def plain_model(sample, width, pairs, l1, weight, steps=4000):
    """Proximal gradient without acceleration, over (word numbers, label) and pairs."""
    n, m = len(sample), len(pairs)
    rate = min(max(sum(y for _, y in sample) / n, 1e-3), 1 - 1e-3)
    w, b = [0.0] * width, math.log(rate / (1 - rate))
    step = 1 / (0.25 * min(max(len(x) for x, _ in sample) + 1, 64) + 2 * weight)
    for _ in range(steps):
        grad, gb = [0.0] * width, 0.0
        for x, y in sample:
            e = 1 / (1 + math.exp(-(b + sum(w[k] for k in x)))) - y
            gb += e / n
            for k in x:
                grad[k] += e / n
        for one, two in pairs:
            change = sum(w[k] for k in one) - sum(w[k] for k in two)
            for k in set(one) ^ set(two):
                grad[k] += 2 * weight / m * change * (1 if k in one else -1)
        w = [math.copysign(max(abs(a - step * g) - step * l1, 0.0), a - step * g) for a, g in zip(w, grad)]
        b -= step * gb
    return w, b


def words(text):
    return set(re.findall(r"[^\W\d_]+", text.lower()))


def test_toxicity_query(spark, sf, rows):
    docs, labels = rows
    sample = {}
    for d, t in docs:
        if d in labels["toxic"] and fold(d, 5) != 0:
            sample[t] = max(sample.get(t, 0), labels["toxic"][d])
    n, share = len(sample), sum(sample.values()) / len(sample)
    df, pos = {}, {}
    for t, y in sample.items():
        for x in words(t):
            df[x], pos[x] = df.get(x, 0) + 1, pos.get(x, 0) + y
    far = {x: abs(pos[x] - c * share) / math.sqrt(c * share * (1 - share) + 1) for x, c in df.items() if c >= max(5, 0.001 * n)}
    top = sorted((x for x in far if far[x] >= 4.0), key=lambda x: (-far[x], x))[:2000]
    number = {x: k for k, x in enumerate(sorted({*top, *X.IDENTITY_TERMS}))}
    pick = lambda t: {number[x] for x in words(t) if x in number}
    pairs = [tuple(map(pick, X.counterfactual(t))) for t in sample]
    w, b = plain_model([(pick(t), y) for t, y in sample.items()], len(number), pairs, X.L1, X.PAIR_WEIGHT)
    got = {r.doc_id: r for r in QUERIES["op10_toxicity"](spark, sf).collect()}
    assert set(got) == {d for d, _ in docs}
    for d, t in docs:
        score = 1 / (1 + math.exp(-(b + sum(w[k] for k in pick(t)))))
        assert abs(got[d].score - score) < 0.02 and got[d].held_out == (fold(d, 5) == 0) and got[d].predicted == int(got[d].score >= 0.5)
