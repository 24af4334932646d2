"""Token ids, packing and the token store against the library called on whole texts."""

import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haltgate.llm import edit_counts, packing, token_store, tokens
from haltgate.llm.queries import vocabulary
from haltgate.llm.tokens import ChunkEncoder

from .conftest import ODD

LIBRARY = Tokenizer.from_file(vocabulary())
ENCODER = ChunkEncoder(vocabulary(), memo_chunks=50)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("abÀéß.,!'s \n\t<|>")), max_size=60))
def test_ids_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(ENCODER.encode([text])[0], ENCODER.dtype).tolist() == library(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abÀéßs \t\x0b\x1c\n!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~7\u0338", max_size=20), max_size=6))
def test_ids_of_words_with_any_marks_are_the_librarys(texts):
    assert [np.frombuffer(raw, ENCODER.dtype).tolist() for raw in ENCODER.encode([*texts, None])] == [*map(library, texts), []]


def test_marks_are_encoded_apart_from_their_word():
    encoder = ChunkEncoder(vocabulary())
    encoder.encode(["Word### word$$$ word"])
    assert set(encoder.pieces) == {"", "word", "###", "$$$"}


def test_chunks_met_again_cost_no_call_each():
    """Once no more ids are kept, a text costs Python calls by its distinct chunks, not by all."""
    encoder, calls = ChunkEncoder(vocabulary(), memo_chunks=4), []
    encoder.encode(["one two three four"])
    text = "one two three four five, " * 2000
    sys.setprofile(lambda frame, event, _: event == "call" and calls.append(frame.f_code.co_name))
    try:
        raw = encoder.encode([text])[0]
    finally:
        sys.setprofile(None)
    assert len(calls) < 200
    assert np.frombuffer(raw, encoder.dtype).tolist() == library(text)


def test_ids_laid_out_in_parts(monkeypatch):
    monkeypatch.setattr(tokens, "LAID_CHUNKS", 3)
    texts = ["one two three four, five", "", None, " six\n", "seven 8 nine! ten eleven"]
    assert [np.frombuffer(raw, ENCODER.dtype).tolist() for raw in ENCODER.encode(texts)] == list(map(library, texts))
    assert ENCODER.encode([]) == [] and ENCODER.encode([None, " "]) == [b"", b""]


def check_packing(rows, expected, window):
    """``expected``: for each document, the ids of one copy and how many rows had them."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[(r.doc_id, r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    total = 0
    for (doc, n), ids in expected.items():
        got = sorted((r.start, r.length, r.ids_crc32) for r in pieces.pop((doc, n)))
        cut = [(s, len(ids[0][s : s + window]), crc(ids[0][s : s + window])) for s in range(0, n, window)]
        assert got == sorted(c for c in cut for _ in ids)
        total += n * len(ids)
    assert not pieces
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window and {r.sequence_tokens for r in parts} == {at}
        assert {r.padded_length for r in parts} == {at if at & (at - 1) == 0 else window}
    return 1 - total / (len(sequences) * window) if sequences else 0


def test_packing(docs, texts):
    expected = {}
    for d, t in texts.items():
        ids = [*library(t), 2]
        expected[(d, len(ids))] = [ids]
    assert check_packing(packing.pack(docs, vocabulary()).collect(), expected, 4096) < 0.05
    spread = docs.repartition(5)
    assert check_packing(packing.pack(spread, vocabulary(), window=256, open_windows=4, merge_partitions=2).collect(), expected, 256) < 0.1


def test_packing_odd_rows(odd, nothing):
    expected = defaultdict(list)
    for d, t in ODD:
        ids = [*library(t), 2]
        expected[(d, len(ids))].append(ids)
    check_packing(packing.pack(odd, vocabulary(), window=64).collect(), expected, 64)
    assert packing.pack(nothing, vocabulary()).collect() == []


def test_fullest_window_is_emitted_when_none_fits():
    windows = packing.OpenWindows(10, 2)
    assert windows.place(("a",), 6) == [] and windows.place(("b",), 7) == []
    assert windows.place(("c",), 5) == [[("b",)]]  # 7 of 10 was the fullest
    assert windows.place(("d",), 4) == [[("a",), ("d",)]]  # best fit, and full


def store_of(spark, df, tmp_path, **params):
    return token_store.open_store(spark, token_store.write_store(df, vocabulary(), path=str(tmp_path / "store"), **params))


def test_store_round_trip(spark, docs, texts, tmp_path):
    store = store_of(spark, docs, tmp_path, shard_ids=2000)
    start, expected = 0, []
    for d in sorted(texts):
        ids = [*library(texts[d]), 1]
        expected.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(tuple(r) for r in token_store.read_all(store).collect()) == expected
    wanted = sorted(texts)[::17]
    found = {r.doc_id: r.ids for r in token_store.lookup(store, [*wanted, 10**12, -5]).collect()}
    assert found == {d: [*library(texts[d]), 1] for d in wanted}
    assert token_store.lookup(store, []).collect() == []


def test_store_odd_rows(spark, odd, nothing, tmp_path):
    got = token_store.read_all(store_of(spark, odd, tmp_path)).collect()
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, expected = 0, []
    for d, t in order:
        ids = [*library(t), 1]
        expected.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert token_store.read_all(store_of(spark, nothing, tmp_path / "none")).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_perfect_hash(n):
    keys = token_store.mix(np.arange(n).astype(np.uint64))
    built = token_store.PerfectHash.build(keys)
    assert sorted(built.slot(keys).tolist()) == list(range(n))
    again = token_store.PerfectHash.load(built.dump())
    assert (again.slot(keys) == built.slot(keys)).all()


def test_perfect_hash_of_equal_keys_ends():
    built = token_store.PerfectHash.build(np.array([7, 7, 9], dtype=np.uint64))
    assert len(set(built.slot(np.array([7, 9], dtype=np.uint64)).tolist())) == 2


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab c.\n'é", max_size=80), st.lists(st.tuples(st.floats(0, 1), st.floats(0, 1), st.text(alphabet="x y\n", max_size=6)), max_size=5))
def test_tree_follows_edits(text, edits):
    tree = edit_counts.trees(ENCODER, [text])[0]
    for a, b, new in edits:
        a, b = sorted((int(a * len(text)), int(b * len(text))))
        first, last, leaves = tree.touched((a, b, new))
        tree.put(first, last, leaves, edit_counts.counter(ENCODER, [leaves])(leaves))
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.chars == len(text) and tree.tokens == len(library(text))


def edited(text):
    for a, b, new in edit_counts.spread_edits(text):
        text = text[:a] + new + text[b:]
    return text


def test_edited_counts(docs, texts, odd, nothing):
    import hashlib

    got = edit_counts.edited_counts(docs, vocabulary()).collect()
    assert len(got) == len(texts)
    for r in got:
        after = edited(texts[r.doc_id])
        assert (r.n_tokens, r.n_tokens_edited) == (len(library(texts[r.doc_id])), len(library(after)))
        assert r.edited_sha256 == hashlib.sha256(after.encode()).hexdigest()
        assert r.n_chars_encoded <= 600 or len(texts[r.doc_id]) < 2000
    rows = sorted((r.n_tokens, r.n_tokens_edited) for r in edit_counts.edited_counts(odd, vocabulary()).collect())
    assert rows == sorted((len(library(t)), len(library(edited(t or "")))) for _, t in ODD)
    assert edit_counts.edited_counts(nothing, vocabulary()).collect() == []


def test_stored_trees(docs, texts):
    for r in edit_counts.stored_trees(docs, vocabulary()).limit(40).collect():
        leaves = edit_counts.leaves_of(texts[r.doc_id])
        assert [len(x) for x in leaves] == r.leaf_chars and r.text == texts[r.doc_id]
        assert edit_counts.CountTree(leaves, r.leaf_tokens).tokens == len(library(texts[r.doc_id]))


def test_second_round_of_edits_encodes_only_what_it_touches(docs, texts):
    """Trees kept after one round of edits take the next one without encoding anything else."""
    import pyarrow as pa

    from haltgate.llm.common import arrow_schema, write_table

    kept = write_table(edit_counts.edit_trees(edit_counts.write_trees(docs, vocabulary()), vocabulary()), "test-trees")
    asked = []

    class Recorder:
        dtype = ENCODER.dtype

        def lookup(self, lists):
            asked.extend(c for x in lists for c in x)
            return ENCODER.lookup(lists)

    second = lambda text: [(len(text) // 3, len(text) // 3 + 4, "something new ")]
    rows = kept.select("doc_id", "text", "leaf_chars", "leaf_tokens").toArrow().to_batches()
    run = edit_counts._edit_rows(vocabulary(), second, True, arrow_schema(edit_counts.EDITED), lambda _: Recorder())
    got = [r for b in run(iter(rows)) for r in pa.Table.from_batches([b]).to_pylist()]
    assert len(got) == len(texts)
    for r in got:
        once = edited(texts[r["doc_id"]])
        a, b, new = second(once)[0]
        twice = once[:a] + new + once[b:]
        assert r["text"] == twice and r["n_tokens"] == len(library(once)) and r["n_tokens_edited"] == len(library(twice))
        assert sum(r["leaf_chars"]) == len(twice) and sum(r["leaf_tokens"]) == r["n_tokens_edited"]
        assert r["n_chars_encoded"] <= 200 or max(map(len, twice.split())) > 30
    assert len(asked) <= 8 * len(got)


def test_repeated_insertions_split_their_leaf():
    """A leaf does not grow with the words that edits put into it."""
    text = "one two three"
    tree = edit_counts.trees(ENCODER, [text])[0]
    most = 0
    for k in range(400):
        edit = (4, 4, f"word{k} and more ")
        first, last, leaves = tree.touched(edit)
        most = max(most, sum(map(len, leaves)))
        tree.put(first, last, leaves, edit_counts.counter(ENCODER, [leaves])(leaves))
        text = text[:4] + edit[2] + text[4:]
    assert tree.text() == text and tree.tokens == len(library(text))
    assert most < 3 * edit_counts.FULL_LEAF and max(map(len, tree.leaves)) <= edit_counts.FULL_LEAF
