"""Suffix-array encoding against the library."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from haltgate.llm import sentence_pieces as S

from .conftest import ODD

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
ENCODER = S.PieceEncoder(MODEL, memo_units=20)


def ids_of(raw):
    return np.frombuffer(raw, ENCODER.dtype).tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(), st.sampled_from("thein r▁ \n")), max_size=80), min_size=1, max_size=6))
def test_ids_are_the_librarys(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = ENCODER.encode(texts)
    assert [ids_of(g) for g in got] == [LIBRARY.encode(t) for t in texts]
    assert [ENCODER.decode(g) for g in got] == [t.replace("▁", " ") for t in texts]


def test_long_units_and_runs():
    for t in ("ab" * 4000, "the" * 3000, " " * 500, "x" * 49 + " " + "y" * 48):
        assert ids_of(ENCODER.encode([t])[0]) == LIBRARY.encode(t)


def test_edges_are_all_occurrences():
    text = S._codes("the theory then the")
    positions, rows = ENCODER.edges(text)
    raw = "the theory then the"
    pieces = [LIBRARY.id_to_piece(int(i)) for i in ENCODER.piece_ids]
    expected = sorted((p, len(w)) for w in set(pieces) for p in range(len(raw)) if raw.startswith(w, p))
    assert list(zip(positions.tolist(), ENCODER.lengths[rows].tolist())) == expected


def expected_of(rows):
    return sorted(((d, len(i), zlib.crc32(np.array(i, "<u4").tobytes()), hashlib.sha256((t or "").replace("▁", " ").encode()).hexdigest())
                   for d, t in rows for i in [LIBRARY.encode(t or "")]), key=str)


def test_round_trip(docs, texts, odd, nothing):
    assert sorted(map(tuple, S.round_trip(docs, MODEL).collect()), key=str) == expected_of(texts.items())
    assert sorted(map(tuple, S.round_trip(odd, MODEL).collect()), key=str) == expected_of(ODD)
    assert S.round_trip(nothing, MODEL).collect() == []


def test_encoded_and_decoded(odd):
    got = S.decoded(S.encoded(odd, MODEL), MODEL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((d, (t or "").replace("▁", " ")) for d, t in ODD), key=str)
