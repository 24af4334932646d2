"""Ids of chunks that a worker keeps after packing."""

from types import SimpleNamespace

import pyarrow as pa
import pytest

import corpus_pipeline
from haltgate.llm import packing
from haltgate.llm.queries import vocabulary
from haltgate.llm.tokens import ChunkEncoder


class Caught(Exception):
    pass


class Docs:
    def mapInArrow(self, run, _):
        self.run = run
        raise Caught


@pytest.mark.parametrize("keep", [True, False])
def test_ids_are_dropped_after_a_partition(monkeypatch, keep):
    enc, docs = ChunkEncoder(vocabulary()), Docs()
    schema = pa.schema([(c.split()[0], pa.int64()) for c in packing.PIECES.split(", ")] + [("part", pa.int32())])
    monkeypatch.setattr(packing, "arrow_schema", lambda _: schema)
    monkeypatch.setattr(packing, "text_rows", lambda d: d)
    monkeypatch.setattr(packing, "encoder", lambda _: enc)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    with pytest.raises(Caught):
        packing.pack(docs, vocabulary(), keep_ids=keep)
    got = []
    for _ in range(2):
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["One word, two words", ""]})
        got.append([tuple(r.values()) for out in docs.run(iter([batch])) for r in out.to_pylist()])
        assert bool(enc.memo) == keep and (len(enc.pieces) > 1) == keep
    assert got[0] == got[1] and len(got[0]) == 2


def test_the_pipeline_keeps_no_ids(monkeypatch):
    seen = {}
    monkeypatch.setattr(packing, "pack", lambda docs, words, **k: seen.update(k))
    corpus_pipeline.packed(None, None, "")
    assert seen == {"keep_ids": False}
