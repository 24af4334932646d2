"""Token ids of whole texts by the ``tokenizers`` library, one library call per batch.

A text is cut at ASCII white space. The vocabulary drops white space and its
pre-tokens never cross it, so the ids of a text are the ids of its chunks in
order. Arrow numbers the distinct chunks of a batch of texts; only these are
looked up, and their ids are dealt to the texts by array. Each worker keeps the
ids of the chunks it has met (bounded).

Most new chunks are a word with a few marks behind it: two pre-tokens, which
the library would cut apart and lower-case. Those are cut here, so that
"Word," and "word" are encoded once, and go to the library joined by spaces;
every pre-token ends in an id of its own kind, which finds them again. Any
other chunk is joined by an added token, which the library always cuts out
first.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import islice
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed values of the vocabulary file: the added token that joins chunks, and its start.
SEPARATOR = "<|endoftext|>"
ADDED_START = b"<|"
#: Chunks whose ids one worker keeps; met later, a chunk is encoded anew each time.
MEMO_CHUNKS = 500_000

#: Chunks whose ids are laid out at once.
LAID_CHUNKS = 1 << 20

#: Letters that are composed and have one lower-case form, then ASCII marks but "'" and "<": two pre-tokens.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
#: Fixed value of the vocabulary file: how an id ends that ends a pre-token.
WORD_END = "</w>"


class ChunkEncoder:
    """``encode(texts)`` gives each text's ids as little-endian bytes of ``dtype``."""

    def __init__(self, vocabulary: str, memo_chunks: int = MEMO_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.lowered = Tokenizer.from_file(vocabulary)  # for pieces that its normalizer would not change
        self.lowered.normalizer = normalizers.Sequence([])
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(WORD_END)]] = True
        self.separator_id = self.tokenizer.token_to_id(SEPARATOR)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.memo_chunks = memo_chunks
        self.memo: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}

    def _piece_ids(self, new: list[str]) -> dict[str, bytes]:
        """Ids of single lower-case pre-tokens, a call for 50,000."""
        done: dict[str, bytes] = {}
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            ids = np.array(self.lowered.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype=np.int64)
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            assert len(cuts) == len(part), "a piece is not one pre-token"
            raw, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            done.update((c, raw[s * width : e * width]) for c, s, e in zip(part, [0, *cuts], cuts))
        return done

    def _ids(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        pieces, done, plain = self.pieces, {}, []
        words, marks, simple = [], [], []
        for c in chunks:
            m = SIMPLE.fullmatch(c.decode())
            if m:
                word, mark = m[1].lower(), m[2]
                simple.append(c), words.append(word), marks.append(mark)
            else:
                plain.append(c)
        asked = set(words).union(marks)
        new = asked.difference(pieces)
        found = self._piece_ids(list(new))
        if len(pieces) + len(found) <= self.memo_chunks:
            pieces.update(found)
            known = pieces
        else:
            kept = asked.difference(new)
            known = found | dict(zip(kept, map(pieces.__getitem__, kept)))
        done.update(zip(simple, map(add, map(known.__getitem__, words), map(known.__getitem__, marks))))
        joined = [c for c in plain if ADDED_START not in c]
        for i in range(0, len(joined), 50_000):
            part = joined[i : i + 50_000]
            ids = np.array(self.tokenizer.encode_batch_fast([SEPARATOR.join(c.decode() for c in part)], add_special_tokens=False)[0].ids, dtype=np.int64)
            cuts = np.flatnonzero(ids == self.separator_id)
            assert len(cuts) == len(part) - 1, "a chunk held the separator's id"
            raw, width = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
            starts = np.concatenate([[0], cuts + 1]).tolist()
            ends = np.concatenate([cuts, [len(ids)]]).tolist()
            done.update((c, raw[s * width : e * width]) for c, s, e in zip(part, starts, ends))
        for c in plain:
            if c not in done:
                done[c] = np.array(self.tokenizer.encode(c.decode(), add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return done

    def ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each of the chunks, which are distinct."""
        memo = self.memo
        ids = list(map(memo.get, chunks))
        new = [c for c, known in zip(chunks, ids) if known is None]
        if not new:
            return ids
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and full passes over the memo are slow
        try:
            found = self._ids(new)
            memo.update(islice(found.items(), max(self.memo_chunks - len(memo), 0)))
            return [found[c] if known is None else known for c, known in zip(chunks, ids)]
        finally:
            if collecting:
                gc.enable()

    def lookup(self, chunk_lists: list[list[bytes]]) -> dict[bytes, bytes]:
        """The ids of every chunk in the lists."""
        chunks = list(set().union(*chunk_lists))
        return dict(zip(chunks, self.ids_of(chunks)))

    def forget(self) -> None:
        """Drops the ids that are kept."""
        self.memo.clear()
        self.pieces.clear()
        self.pieces[""] = b""

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not texts:
            return []
        lists = pc.ascii_split_whitespace(pa.array([t or "" for t in texts], pa.large_string()))
        numbered = lists.values.dictionary_encode()
        which = numbered.indices.to_numpy()
        ids = self.ids_of(numbered.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist())
        table = np.frombuffer(b"".join(ids), dtype=self.dtype)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        laid = [table[:0]]
        for i in range(0, len(which), LAID_CHUNKS):
            part = which[i : i + LAID_CHUNKS]
            size = sizes[part]
            ends = np.cumsum(size)
            laid.append(table[np.repeat(starts[part] - ends + size, size) + np.arange(ends[-1])])
        tokens = np.concatenate(laid)
        bounds = np.concatenate([[0], np.cumsum(sizes[which])])[lists.offsets.to_numpy()].tolist()
        return [tokens[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]


class _Both(dict):
    """The batch's own entries, then the kept ones."""

    def __init__(self, memo: dict, found: dict):
        super().__init__(found)
        self.memo = memo

    def __missing__(self, key):
        return self.memo[key]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(vocabulary: str) -> ChunkEncoder:
    """The worker's encoder of this vocabulary: reused Python workers keep it between tasks."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = ChunkEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def slices(n: int, texts: list[str | None], max_chars: int = 4 << 20):
    """Index ranges over ``texts`` of at most ``max_chars`` characters (or one text)."""
    start = size = 0
    for i in range(n):
        length = len(texts[i] or "")
        if i > start and size + length > max_chars:
            yield start, i
            start = i
            size = 0
        size += length
    if start < n:
        yield start, n
