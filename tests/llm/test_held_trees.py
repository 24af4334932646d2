"""Trees that a worker of op6 holds at a time."""

import numpy as np
import pyarrow as pa

from haltgate.llm import edit_counts as E


def test_a_part_has_few_bytes_or_one_text():
    sizes = [E.HELD_BYTES * 2 // 3, E.HELD_BYTES * 2 // 3, 5, 7, 3 * E.HELD_BYTES, 0, 11]
    batch = pa.RecordBatch.from_pydict({"doc_id": [3, None, 1, 1, 2, 9, 8], "text": ["é" * (n // 2) for n in sizes]})
    got = list(E.parts(batch))
    assert [p.num_rows for p in got] == [1, 3, 1, 2]
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))
    assert list(E.parts(batch.slice(0, 0))) == []


class Lengths:
    """An encoder whose chunks have a token for each byte."""

    dtype = np.dtype("<u2")

    def lookup(self, chunk_lists):
        return {c: b"\0\0" * len(c) for chunks in chunk_lists for c in chunks}


def test_leaves_are_counted_without_trees(monkeypatch):
    texts = ["", " \n", "a", "\t a  é ü x\x1c  z\n", "", "Wort, wort\r\n\r\nçä\x0b\x0c😀 ", " ", "b  "]
    want = [E.leaves_of(t) for t in texts]
    monkeypatch.setattr(E, "CountTree", None)
    ends, chars, tokens = E.leaf_counts(Lengths(), texts)
    assert ends.tolist() == [sum(map(len, want[:k])) for k in range(len(want) + 1)]
    assert chars.tolist() == [len(x) for leaves in want for x in leaves]
    assert tokens.tolist() == [len(b"".join(E.chunk_of(x))) for leaves in want for x in leaves]
    for some in ([], [""]):
        assert [x.tolist() for x in E.leaf_counts(Lengths(), some)] == [[0] * (len(some) + 1), [], []]


def test_trees_are_stored_part_by_part(monkeypatch):
    monkeypatch.setattr(E, "CountTree", None)
    monkeypatch.setattr(E, "encoder", lambda _: Lengths())
    counts = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("leaf_chars", counts), ("leaf_tokens", counts)])
    monkeypatch.setattr(E, "arrow_schema", lambda _: schema)
    monkeypatch.setattr(E, "text_rows", lambda docs: docs)

    class Docs:
        def mapInArrow(self, run, _):
            return list(run(iter([pa.RecordBatch.from_pydict({"doc_id": [5, None, 5], "text": ["é b", "", " cc"]})])))

    rows = [tuple(r.values()) for batch in E.stored_trees(Docs(), "") for r in batch.to_pylist()]
    assert rows == [(5, "é b", [2, 1], [2, 1]), (None, "", [], []), (5, " cc", [1, 2], [0, 2])]
