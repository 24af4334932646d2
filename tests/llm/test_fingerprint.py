"""Sketches against the exact shingle sets."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from haltgate.llm import fingerprint as K

from .conftest import ODD


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited(text, after):
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def share(a, b):
    return len(a & b) / len(a) if a else float(not b)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\té", max_size=60))
def test_equal_shingles_have_equal_hashes(text):
    """With every hash kept, a sketch is the set of shingles."""
    whole = K.sketch(text, scale=1)
    assert len(whole) == len(shingles(text))
    assert (K.sketch(text.upper().replace("É", "é") + "  ", scale=1) == whole).all()


def test_blocks_do_not_show(monkeypatch):
    text = " ".join(f"w{i % 97} é{i}" for i in range(3000))
    whole = K.sketch(text, scale=1)
    monkeypatch.setattr(K, "BLOCK", 64)
    assert (K.sketch(text, scale=1) == whole).all()


def test_threshold_and_merge():
    a, b = (" ".join(f"w{i}" for i in r) for r in (range(0, 3000), range(2000, 8000)))
    x, y = K.sketch(a), K.sketch(b)
    assert (x < 2**64 // K.SCALE).all() and abs(len(x) - 2996 / K.SCALE) < 80
    assert abs(K.containment(x, y) - 996 / 2996) < 0.08
    both = K.merge(x, y)
    assert K.containment(x, both) == K.containment(y, both) == 1
    assert (K.load(K.dump(x)) == x).all()
    tiny = K.sketch("one two")
    assert len(tiny) == 1 and (K.merge(tiny, x)[: len(x)] <= x.max()).all()


def check(rows, ordered):
    expected = {}
    for k, (d, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        expected.setdefault((d, len(t), hashlib.sha256(edited(t, after).encode()).hexdigest()), []).append((t, after))
    errors = []
    assert len(rows) == len(ordered)
    for r in rows:
        t, after = expected[(r.doc_id, r.n_chars, r.edited_sha256)].pop()
        assert r.fingerprint == K.dump(K.sketch(t)) and r.edited_fingerprint == K.dump(K.sketch(edited(t, after)))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if t == after:
            assert r.near_next == 1
        if len(shingles(t)) > 200:
            errors += [r.near_edited - share(shingles(t), shingles(edited(t, after))), r.near_next - share(shingles(t), shingles(after))]
    return errors


def test_edit_likeness(docs, texts):
    errors = check(K.edit_likeness(docs).collect(), sorted(texts.items()))
    assert np.abs(errors).mean() < 0.06


def test_odd_rows(odd, nothing, spark):
    ordered = sorted(((d, t or "") for d, t in ODD), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    check(K.edit_likeness(odd).collect(), ordered)
    assert K.edit_likeness(nothing).collect() == []
    lone = K.edit_likeness(spark.createDataFrame([(3, "a b c d e f")], "doc_id long, text string")).first()
    assert lone.near_next == 1 and lone.near_edited == 0
    assert lone.edited_sha256 == hashlib.sha256(b"a b c a b c").hexdigest()


def test_merged_groups(spark):
    a, b = " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(300, 900))
    rows = spark.createDataFrame([("g", a), ("g", b), ("h", "one two"), ("h", "")], "g string, text string")
    got = K.merged(rows.select("g", K.fingerprint(rows.text).alias("fp")), "g", "fp").collect()
    hashes = {g: np.sort(np.array([r.hash for r in got if r.g == g], dtype=np.int64).view(np.uint64)) for g in "gh"}
    assert (hashes["g"] == K.merge(K.sketch(a), K.sketch(b))).all() and (hashes["h"] == K.sketch("one two")).all()
    pair = spark.createDataFrame([(K.dump(K.sketch(a)), K.dump(K.sketch(b)))], "a string, b string")
    assert pair.select(K.containment_of(pair.a, pair.b)).first()[0] == K.containment(K.sketch(a), K.sketch(b))


def test_short_text_in_a_long_one(docs, spark):
    """A text of few shingles that stands whole in a longer one is contained in it, but for
    one in 2^n texts of n shingles, which have no hash below the threshold."""
    long_, without, expected = " ".join(f"w{i}" for i in range(5000)), 0, 0.0
    for n in range(5, 40):
        for at in range(0, 4800, 12):
            short = K.sketch(" ".join(f"w{i}" for i in range(at, at + n)))
            expected += K.SCALE ** -(n - 4)
            if short[0] > 2**64 // K.SCALE - 1:
                without += 1
                assert n < 25 and K.containment(short, K.sketch(long_)) == 0 and K.containment(short, short) == 1
            elif at % 240 == 0:
                assert K.containment(short, K.sketch(long_)) == 1
                assert K.containment(short, K.merge(short, K.sketch("other words " * 50))) == 1
    assert abs(without - expected) < 0.2 * expected
    pairs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(n)), long_) for n in range(15, 22)], "a string, b string")
    assert [r[0] for r in pairs.select(K.containment_of(K.fingerprint(pairs.a), K.fingerprint(pairs.b))).collect()] == [1.0] * 7


def test_errors_against_exact_sets_and_size(docs, texts):
    """Whole texts of all lengths: small errors, and fingerprints well below the texts."""
    ordered = sorted(texts.items())
    after = {d: ordered[(k + 1) % len(ordered)][1] for k, (d, _) in enumerate(ordered)}
    rows = K.edit_likeness(docs).collect()
    errors = [abs(r.near_edited - share(shingles(texts[r.doc_id]), shingles(edited(texts[r.doc_id], after[r.doc_id])))) for r in rows]
    assert np.mean(errors) < 0.04 and np.mean(np.array(errors) > 0.2) < 0.02
    assert sum(len(r.fingerprint) for r in rows) < 0.5 * sum(len(t.encode()) for t in texts.values())


def test_likeness_equals_the_exact_sets(docs, texts):
    """With every hash kept; short texts too."""
    ordered = [(d, " ".join(t.split()[: 5 + 3 * k % 40])) for k, (d, t) in enumerate(sorted(texts.items()))]
    after = {d: ordered[(k + 1) % len(ordered)][1] for k, (d, _) in enumerate(ordered)}
    rows = K.edit_likeness(docs.sparkSession.createDataFrame(ordered, "doc_id long, text string"), scale=1).collect()
    for r, (d, t) in zip(sorted(rows, key=lambda r: r.doc_id), ordered):
        a, b, c = shingles(t), shingles(edited(t, after[d])), shingles(after[d])
        assert (r.near_edited, r.near_next) == (share(a, b), share(a, c))
        assert (r.near_edited_jaccard, r.near_next_jaccard) == tuple(len(a & x) / len(a | x) if a | x else 1.0 for x in (b, c))


def test_no_estimate_from_a_least_hash_above_the_threshold():
    """A text without a hash below the threshold is in no longer one, as its hash cannot be there."""
    long_ = K.sketch(" ".join(f"w{i}" for i in range(3000)), scale=64)
    short = K.sketch("w1 w2 w3 w4 w5 w6", scale=64)
    assert len(short) == 1 and short[0] >= 2**64 // 64
    assert K.containment(short, long_) == 0 and K.containment(short, short) == 1
    assert K.containment(long_, short) == 0
    assert (K.load(K.dump(short, 64), 64) == short).all() and (K.load(K.dump(long_, 64), 64) == long_).all()
