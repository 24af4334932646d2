"""Merkle manifest against a plain version on the same rows."""

import hashlib
import random
import zlib

import pytest

from haltgate.llm import merkle
from haltgate.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = (r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def grown(leaves):
    """(root, each leaf's (side, sibling) pairs upwards)."""
    paths, level, under = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, over = [], []
        for k in range(0, len(level), 2):
            run = level[k : k + 2]
            for j in range(len(run)):
                for i in under[k + j]:
                    paths[i].append(("none", "") if len(run) == 1 else ("right", run[1]) if j == 0 else ("left", run[0]))
            above.append(h(*run))
            over.append(sum(under[k : k + 2], []))
        level, under = above, over
    return level[0], paths


def expected(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.lang, []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in trees.values():
        t.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    low = {x: grown([leaf(r) for r in trees[x]]) for x in langs}
    root, high = grown([low[x][0] for x in langs])
    out = []
    for x, up in zip(langs, high):
        for r, path in zip(trees[x], low[x][1]):
            path = path + up
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            folded = leaf(r, int(bad))
            for side, other in path:
                folded = h(folded, other) if side != "left" else h(other, folded)
            out.append((r.doc_id, leaf(r), low[x][0], root, h(*[o for _, o in path]), folded, folded == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.drop("proof").collect()), key=str)


def manifest(df):
    return merkle.manifest(df, merkle.every_seventh())


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 2, "de": 1}, {"en": 70, "é": 33, None: 5, "": 1, "z": 64, "a": 17}])
def test_equals_plain_version(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)  # several rounds of blocks
    r = random.Random(3)
    rows = [(r.randint(-50, 400), f"text {k}", lang, None if k % 5 == 0 else "src", None if k % 6 == 0 else k)
            for lang, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(manifest(df)) == expected(df.collect())


def test_odd_rows_and_empty_table(spark, odd, nothing):
    rows = odd.selectExpr("doc_id", "text", "source", "n_chars", "IF(doc_id > 5, 'x', NULL) AS lang", "1 AS tree", "2 AS i", "3 AS n", "4 AS level", "5 AS digest", "6 AS shown")
    assert found(manifest(rows)) == expected(rows.collect())
    assert manifest(rows.where("false")).collect() == []


def test_largest_count_can_be_tampered_with(spark):
    df = spark.createDataFrame([(k, "t", "x", "s", 2**63 - 1) for k in range(20)], SCHEMA)
    assert found(manifest(df)) == expected(df.collect())


def test_query(spark, sf, docs):
    got = found(op13_merkle_manifest(spark, sf))
    assert got == expected(docs.collect())
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
