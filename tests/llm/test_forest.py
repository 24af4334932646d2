"""LSH forest groups against all pairs of exact sets."""

import random
import re

import numpy as np
import pytest

from haltgate.llm import common, lsh_forest
from haltgate.llm.queries import op11_lsh_forest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]


def set_of(text):
    words = words_of(text)
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset([tuple(words)] if words else [])


def expected(rows):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows, from all pairs of distinct sets."""
    sets = [set_of(t) for _, t in rows]
    distinct = [s for s in dict.fromkeys(sets) if s]
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s:
            r = find(s)
            known = [d for d in (least.get(r), doc) if d is not None]
            least[r] = min(known) if known else None
    out = []
    for (doc, _), s in zip(rows, sets):
        component = least[find(s)] if s else doc
        out.append((doc, len(s), component, doc == component))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(r, words, share):
    return " ".join(r.choice("abcdefghij") + str(r.randint(0, 999)) if r.random() < share else w for w in words)


@pytest.fixture(scope="module")
def rows():
    """Chains of edits, a crowd of near copies, a crowd that shares most of its text but too little, short texts."""
    r = random.Random(8)
    word = lambda: "w" + str(r.randint(0, 5000))
    out = []
    for _ in range(30):
        words = [word() for _ in range(r.choice([3, 8, 40, 120]))]
        for _ in range(r.randint(1, 6)):
            out.append(" ".join(words))
            words = edited(r, words, 0.04).split()
    crowd = [word() for _ in range(60)]
    out += [edited(r, crowd, 0.02) for _ in range(150)]
    shared = [word() for _ in range(60)]
    out += [" ".join(shared + [word() for _ in range(12)]) for _ in range(120)]
    out += ["a", "A", "b", "a b", "b a", "a b c d e f", "A B c d e f g", "", None, " \n"]
    return [(k, t) for k, t in enumerate(out)]


@pytest.mark.parametrize("pairs,nodes,block,slab,common_", [(4096, 1 << 13, 512, 4096, 1 << 17), (3, 20, 4, 64, 1 << 17), (0, 5, 2, 7, 1)])
def test_equals_all_pairs(spark, rows, monkeypatch, pairs, nodes, block, slab, common_):
    """With small bounds every region goes the exact way, and on to blocks."""
    for name, value in (("MAX_PAIRS", pairs), ("MAX_NODES", nodes), ("BLOCK", block), ("SLAB", slab), ("COMMON", common_), ("COUNTED", 1 << 20 if slab > 64 else 50)):
        monkeypatch.setattr(lsh_forest, name, value)
    assert found(lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_odd_rows_and_empty_table(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(lsh_forest.near_duplicates(odd)) == expected(rows)
    assert lsh_forest.near_duplicates(nothing).collect() == []


def test_hot_text_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 3)
    rows = [(k, "one text that is a third of all rows and more") for k in range(200)] + [(200 + k, f"text number {k} of few") for k in range(150)]
    assert found(lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_very_long_text(spark):
    r = random.Random(1)
    long_ = [str(r.randint(0, 10**6)) for _ in range(300_000)]
    rows = [(1, " ".join(long_)), (2, edited(r, long_, 0.03)), (3, " ".join(long_[:200_000]))]
    assert found(lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_common_counts_equal_intersections():
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 300, size=int(r.integers(1, 200)), dtype=np.uint64)) for _ in range(40)]
    for slab in (5, 4096):
        lsh_forest.SLAB, old = slab, lsh_forest.SLAB
        got = lsh_forest.common_counts(sets[:15], sets[15:])
        lsh_forest.SLAB = old
        assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[15:]] for a in sets[:15]]
    assert lsh_forest.common_counts([sets[0][:1]], [sets[0][:1] + np.uint64(9999)]).tolist() == [[0]]


def test_bits_of_similar_sets_are_similar():
    """At the least similarity the bound on differing bits keeps every pair of many."""
    r, worst = np.random.default_rng(9), 0
    for _ in range(300):
        both = r.integers(0, 2**63, 800, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([both, r.integers(0, 2**63, 100, dtype=np.uint64)])) for _ in "ab")  # 800 of 1000
        x, y = (np.frombuffer(lsh_forest.bits(lsh_forest.signature(s)), dtype=np.uint8) for s in (a, b))
        worst = max(worst, int(lsh_forest.unlike(x, y)))
    assert worst <= lsh_forest.MAX_BITS - 4


def test_signatures_estimate_similarity():
    r = np.random.default_rng(2)
    a = np.unique(r.integers(0, 2**63, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:3000], r.integers(0, 2**63, 700, dtype=np.uint64)]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((lsh_forest.signature(a) == lsh_forest.signature(b)).mean() - true) < 0.12


def test_query(spark, sf, docs):
    assert found(op11_lsh_forest(spark, sf)) == expected([(r.doc_id, r.text) for r in docs.collect()])
