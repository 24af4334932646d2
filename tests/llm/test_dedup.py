"""Near-duplicate groups and repeated strings against brute force."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from haltgate.llm import common, components, queries, repeats, simhash
from haltgate.llm.run_length_index import RunLengthIndex

from .conftest import ODD

# -- groups ---------------------------------------------------------------------


def slow_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps, most):
    """Least index reachable, for a list of fingerprints."""
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def expected_groups(rows, most=2):
    fps = [slow_fingerprint(t) for _, t in rows]
    groups = slow_groups(fps, most)
    least = {}
    for (d, _), g in zip(rows, groups):
        least[g] = min(filter(lambda x: x is not None, (least.get(g), d)), default=None)
    return sorted(((d, f"{f:016x}", least[g]) for (d, _), f, g in zip(rows, fps, groups)), key=str)


@pytest.mark.parametrize("max_bucket", [1, simhash.MAX_BUCKET])
def test_near_duplicates(docs, texts, max_bucket):
    got = simhash.near_duplicates(docs, max_bucket=max_bucket).collect()
    assert sorted(map(tuple, got), key=str) == expected_groups(sorted(texts.items()))


def test_odd_rows(odd, nothing):
    got = simhash.near_duplicates(odd).collect()
    assert sorted(map(tuple, got), key=str) == expected_groups(ODD)
    assert simhash.near_duplicates(nothing).collect() == []
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    named = {c for _, _, c in expected_groups(ODD) if c is not None}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(named)
    assert kept.where("doc_id is null").count() == 2
    assert simhash.keep_one(nothing).collect() == []


def test_an_id_with_texts_in_two_groups_names_both(spark):
    """Each group keeps a row of its own, the same one on every run."""
    one, two = (" ".join(f"{c}{i}" for i in range(200)) for c in "ab")
    rows = [(1, one, "x"), (1, two, "x"), (2, one, "x"), (3, two, "x"), (1, one, "w"), (1, one, "w")]
    for parts in (1, 5):
        kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts))
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, one), (1, two)]


def test_columns_named_like_those_inside(spark):
    names = ["doc", "row_key", "fp", "root", "least", "copies", "text_id", "kept_text", "cut_text_id", "_simhash_row", "a", "b"]
    rows = [(1, "one two three four", *range(12)), (2, "one two three four", *range(12)), (3, "else", *range(12))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    assert sorted(map(tuple, simhash.keep_one(df).collect())) == [rows[0], rows[2]]
    cut = repeats.cut_documents(df, length=8, gram=3)
    assert cut.columns == df.columns
    assert sorted(map(tuple, cut.collect())) == [(1, "", *range(12)), (2, "", *range(12)), rows[2]]
    assert simhash.near_duplicates(df).count() == 3


def test_hot_fingerprint_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 3)
    rows = [(k, "the same text in a third of all rows") for k in range(60)] + [(60 + k, f"other text {k} here {k * 7}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str) == expected_groups(rows)


def test_a_row_without_an_id_links_two_others(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, n, keep=(): docs.selectExpr(
        "doc_id", "case text when 'a' then 0L when 'b' then 3L else 15L end as fp", *keep))
    docs = spark.createDataFrame([(4, "a"), (None, "b"), (6, "c")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect()), key=str) == [(4, "a"), (None, "b")]


@pytest.mark.parametrize("most,max_bucket", [(2, 128), (2, 2), (4, 128), (4, 2)])
def test_links_of_clustered_fingerprints(spark, most, max_bucket):
    """Chains and dense groups: every fingerprint is a few flips from another."""
    rng = np.random.default_rng(most * 100 + max_bucket)
    fps = {int(x) for x in rng.integers(0, 2**63, 20, dtype=np.uint64)}
    for _ in range(400):
        flips = rng.choice(64, size=int(rng.integers(1, 2 * most)), replace=False)
        fps.add(int(rng.choice(sorted(fps))) ^ sum(1 << int(b) for b in flips))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    rows = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components.components(simhash.links(rows, most, max_bucket)).collect()}
    ours = Counter(frozenset(f for f in signed if got.get(f, f) == root) for root in {got.get(f, f) for f in signed})
    groups = slow_groups(fps, most)
    assert ours == Counter(frozenset(s for s, g in zip(signed, groups) if g == k) for k in set(groups))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=5), st.sampled_from([2, 4]))
def test_pigeonring_keeps_every_near_pair(x, flips, most):
    y = x ^ sum(1 << b for b in flips)
    a, b = np.array([x], dtype=np.uint64), np.array([y], dtype=np.uint64)
    ok = any(simhash.pigeonring(a, b, s, most)[0] for s in range(4 * most))
    assert ok == (len(flips) <= most)  # the last budget of a chain is the distance itself


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(300, 301), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 300: 300, 301: 300}


# -- repeated strings ---------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(x % 2 for x in b)), max_size=6))
def test_matching_statistics(strings):
    got = RunLengthIndex.build(strings).matching_statistics()
    places = [(i, j) for i, s in enumerate(strings) for j in range(len(s))]
    for k, (i, j) in enumerate(places):
        best = 0
        for a, b in places:
            if (a, b) != (i, j):
                n = 0
                while j + n < len(strings[i]) and b + n < len(strings[a]) and strings[i][j + n] == strings[a][b + n]:
                    n += 1
                best = max(best, n)
        assert got[k] == best


def test_runs_are_few_in_repetitive_strings():
    base = bytes(np.random.default_rng(1).integers(97, 123, 2000, dtype=np.uint8))
    index = RunLengthIndex.build([base] * 20)
    assert index.runs < len(index.data) / 10


def expected_cuts(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(rows, raws):
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((d, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made_texts():
    """Shared passages in all places, periodic texts, near copies, multi-byte characters."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdeé"), int(rng.integers(1, 5))))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(40) for _ in range(4)]
    rows = []
    for d in range(60):
        parts = [text(int(rng.integers(0, 30)))]
        for _ in range(int(rng.integers(0, 3))):
            s = shared[int(rng.integers(0, 4))]
            a, b = sorted(rng.integers(0, len(s) + 1, 2))
            parts += [s[int(a) : int(b)] if rng.random() < 0.5 else s, text(int(rng.integers(0, 20)))]
        rows.append((d, " ".join(parts)))
    rows += [(100, "ab" * 200), (101, "ab" * 37 + "c"), (102, "x" * 500), (103, rows[0][1]), (104, shared[0]), (105, shared[0] + shared[0])]
    return rows


@pytest.mark.parametrize("params", [{}, {"max_segments": 1}, {"max_segments": 3, "index_bytes": 200}])
def test_removed(spark, params):
    rows = made_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeats.removed(df, length=40, gram=12, **params).collect()
    assert sorted(map(tuple, got), key=str) == expected_cuts(rows, 40)


def test_removed_across_blocks(spark, monkeypatch):
    """Segments that a block edge cuts are matched with whole ones."""
    monkeypatch.setattr(repeats, "BLOCK", 128)
    monkeypatch.setattr(repeats, "_ROLLING", {})
    one, two = repeats.segments(("ab cd " * 3 + "efghij" * 40).encode(), 40, 12), repeats.segments(("efghij" * 40).encode(), 40, 12)
    assert set(two[0].tolist()) <= set(one[0].tolist())
    for s in (one, two):
        windows = [w for a, b in zip(s[2].tolist(), s[3].tolist()) for w in range(a, b + 1)]
        assert windows == list(range(len(windows)))


def test_removed_whole_table(docs, texts):
    got = repeats.removed(docs).collect()
    assert sorted(map(tuple, got), key=str) == expected_cuts(sorted(texts.items()), 400)


def test_removed_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    res = con.execute(queries.ORACLE_SQL["op5_repeats"])
    cols = [d[0] for d in res.description]
    df = queries.QUERIES["op5_repeats"](spark, sf)
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(res.fetchall())


def test_removed_odd_rows(odd, nothing):
    got = repeats.removed(odd, length=5, gram=2).collect()
    assert sorted(map(tuple, got), key=str) == expected_cuts(ODD, 5)
    assert repeats.removed(nothing).collect() == []


def test_cut_documents(spark, nothing):
    rows = [(1, "é" * 30 + "unique", 36), (2, "é" * 30, 30), (3, None, None), (4, "short", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in repeats.cut_documents(df, length=20, gram=4).collect()}
    assert got == {1: ("unique", 6), 2: ("", 0), 3: (None, None), 4: ("short", 5)}
    assert repeats.cut_documents(nothing).collect() == []
