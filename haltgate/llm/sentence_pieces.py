"""SentencePiece encoding by suffix-array matching, and decoding.

For models of the byte-pair kind with identity normalisation. No piece but
runs of the space mark holds that mark behind its first character, so a text
is a sequence of units (space marks and what follows them) that are encoded
alone. The new units of a batch are one indexed text: its suffixes are sorted,
every piece is binary-searched for its range of occurrences, and the
occurrences are edges (start, length, piece), sorted by position. Relaxing
takes, for each unit and again and again, the edge of the best score over two
neighbouring symbols, leftmost among equals, as the library's merges do.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Emitter, arrow_schema, text_rows
from .tokens import _Both, slices

#: Fixed value of the format: the mark that stands for a space.
MARK = "▁"
#: Units whose ids one worker keeps.
MEMO_UNITS = 500_000
#: Characters of new units that are indexed at once; units up to LONG are relaxed together.
INDEX_CHARS, LONG = 400_000, 48
NONE = np.iinfo(np.int32).max


class PieceEncoder:
    def __init__(self, model: str, memo_units: int = MEMO_UNITS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        usable = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
        self.unknown = sp.unk_id()
        self.bytes = {int(pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.single = {p: i for i, (p, ok) in enumerate(zip(pieces, usable)) if ok and len(p) == 1}
        many = [i for i, (p, ok) in enumerate(zip(pieces, usable)) if ok and len(p) > 1]
        if any(MARK in pieces[i].lstrip(MARK) for i in many):
            raise ValueError("a piece holds the space mark behind other characters")
        first = sp.encode("a")
        self.prefix = MARK if first and pieces[first[0]].startswith(MARK) else ""
        lines = "" if any("\n" in pieces[i] for i in many) else "\n"
        self.unit = re.compile(rf"{MARK}*[^{MARK}{lines}]+|{MARK}+" + ("|\n" if lines else ""))
        self.longest = max((len(pieces[i]) for i in many), default=1)
        self.piece_ids = np.array(many, dtype=np.int32)
        self.lengths = np.array([len(pieces[i]) for i in many], dtype=np.int64)
        self.codes = np.zeros((len(many), self.longest), dtype=np.uint32)
        for row, i in enumerate(many):
            self.codes[row, : len(pieces[i])] = _codes(pieces[i])
        scores = np.array([sp.get_score(i) for i in many])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.dtype = np.dtype("<u2") if n <= 1 << 16 else np.dtype("<u4")
        self.memo_units, self.memo = memo_units, {}
        self.spelled = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i)
                        else bytes([int(pieces[i][3:5], 16)]) if sp.is_byte(i) else pieces[i].encode() for i in range(n)]

    # -- index ------------------------------------------------------------------

    def edges(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, rows of pieces) of all occurrences of pieces, sorted by position and length."""
        order = suffix_order(text, self.longest)
        low, high = self._search(text, order, False), self._search(text, order, True)
        count = high - low
        which = np.repeat(np.arange(len(count)), count)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        positions = order[np.repeat(low, count) + inside]
        by_position = np.lexsort((self.lengths[which], positions))
        return positions[by_position], which[by_position]

    def _search(self, text: np.ndarray, order: np.ndarray, upper: bool) -> np.ndarray:
        """Binary search of every piece at once for the first suffix that does not come
        before it (``upper``: that neither comes before it nor starts with it)."""
        padded = np.concatenate([text, np.zeros(self.longest, dtype=np.uint32)])
        mask = np.arange(self.longest) < self.lengths[:, None]
        rows = np.arange(len(self.lengths))
        low, high = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), len(order), dtype=np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            window = padded[order[np.minimum(middle, len(order) - 1)][:, None] + np.arange(self.longest)]
            differs = (window != self.codes) & mask
            at = differs.argmax(axis=1)
            equal = ~differs[rows, at]
            before = np.where(equal, upper, window[rows, at] < self.codes[rows, at])
            low = np.where(open_ & before, middle + 1, low)
            high = np.where(open_ & ~before, middle, high)
        return low

    # -- relaxing ---------------------------------------------------------------

    def _encode_units(self, units: list[str]) -> list[bytes]:
        text = _codes("\0".join(units))
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        begin = np.cumsum(lengths + 1) - lengths - 1
        text[begin[1:] - 1] = 0  # separators; characters are at least 1
        positions, rows = self.edges(text)
        best = np.full((self.longest + 1, len(text)), NONE, dtype=np.int32)
        piece = np.zeros((self.longest + 1, len(text)), dtype=np.int32)
        best[self.lengths[rows], positions] = self.rank[rows]
        piece[self.lengths[rows], positions] = self.piece_ids[rows]

        short = np.flatnonzero(lengths <= LONG)
        unit = np.repeat(short, lengths[short])
        start = np.repeat(begin[short], lengths[short]) + _counting(lengths[short])
        parts = [self._relax(unit, start, best)]
        for u in np.flatnonzero(lengths > LONG).tolist():
            ends = self._relax_long(int(begin[u]), int(lengths[u]), best)
            parts.append((np.full(len(ends) - 1, u), np.array(ends[:-1]), np.array(ends[1:])))
        unit, start, end = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(start)
        unit, start, end = unit[order], start[order], end[order]
        return self._ids(text, units, unit, start, end, piece)

    def _relax(self, unit: np.ndarray, start: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One merge in every unit a round; units without one are done."""
        end, done = start + 1, []
        while len(unit):
            length = np.append(end[1:], 0) - start
            same = np.append(unit[1:] == unit[:-1], False) & (length <= self.longest)
            rank = np.where(same, best[np.where(same, length, 0), start], NONE)
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(unit))))
            over = least == NONE
            done.append((unit[over], start[over], end[over]))
            hits = np.flatnonzero((rank == least) & ~over)
            hits = hits[np.concatenate([[True], unit[hits[1:]] != unit[hits[:-1]]])] if len(hits) else hits
            end[hits] = end[hits + 1]
            keep = ~over
            keep[hits + 1] = False
            unit, start, end = unit[keep], start[keep], end[keep]
        return tuple(np.concatenate(x) if done else np.zeros(0, dtype=np.int64) for x in zip(*done)) if done else (unit, start, end)

    def _relax_long(self, begin: int, n: int, best: np.ndarray) -> list[int]:
        """The same for one long unit, by a heap of edges over neighbouring symbols."""
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def edge(k: int):
            far = after[after[k]] if after[k] < n else n + 1
            if far <= n and far - k <= self.longest and best[far - k, begin + k] != NONE:
                return int(best[far - k, begin + k]), k, far
            return None

        heap = [e for k in range(n - 1) if (e := edge(k))]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            _, k, far = entry
            if not alive[k] or edge(k) != entry:
                continue
            alive[after[k]] = False
            after[k] = far
            if far < n:
                before[far] = k
            for j in (k, before[k]):
                if j >= 0 and (e := edge(j)):
                    heapq.heappush(heap, e)
        return [begin + k for k in range(n) if alive[k]] + [begin + n]

    def _ids(self, text, units, unit, start, end, piece) -> list[bytes]:
        one = end - start == 1
        ids = piece[np.where(one, 0, end - start), start].astype(np.int64)
        kinds, which = np.unique(text[start[one]], return_inverse=True)
        single = [self.single.get(chr(int(c) - 1)) for c in kinds]
        spelled = [[i] if i is not None else [self.bytes.get(b, self.unknown) for b in chr(int(c) - 1).encode()] if self.bytes else [self.unknown]
                   for c, i in zip(kinds, single)]
        count = np.ones(len(ids), dtype=np.int64)
        if len(kinds):
            count[one] = np.array([len(s) for s in spelled])[which]
            ids[one] = np.array([s[0] for s in spelled])[which]
        out = np.repeat(ids, count)
        at = np.cumsum(count) - count
        for k in np.flatnonzero(count > 1).tolist():
            out[at[k] : at[k] + count[k]] = spelled[int(np.searchsorted(kinds, text[start[k]]))]
        width = self.dtype.itemsize
        cuts = (np.cumsum(np.bincount(unit, count, len(units)).astype(np.int64)) * width).tolist()
        raw = out.astype(self.dtype).tobytes()
        return [raw[s:e] for s, e in zip([0, *cuts], cuts)]

    # -- texts --------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[bytes]:
        lists = [self.unit.findall(self.prefix + t.replace(" ", MARK)) if t else [] for t in texts]
        memo = self.memo
        new, found = list(set().union(*lists).difference(memo)), {}
        at = 0
        while at < len(new):
            size, last = 0, at
            while last < len(new) and (last == at or size + len(new[last]) <= INDEX_CHARS):
                size += len(new[last]) + 1
                last += 1
            found.update(zip(new[at:last], self._encode_units(new[at:last])))
            at = last
        room = self.memo_units - len(memo)
        known = memo
        if len(found) <= room:
            memo.update(found)
        else:
            memo.update(islice(found.items(), max(room, 0)))
            known = _Both(memo, found)
        get = known.__getitem__
        return [b"".join(map(get, units)) for units in lists]

    def decode(self, raw: bytes) -> str:
        """The text of ids: pieces one after another, space marks as spaces, without the
        mark that encoding puts before a text."""
        ids = np.frombuffer(raw, dtype=self.dtype).tolist()
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", errors="replace").removeprefix(self.prefix).replace(MARK, " ")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4") + np.uint32(1)


def _counting(lengths: np.ndarray) -> np.ndarray:
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by at least the next ``depth`` characters, by doubling."""
    rank, reach = np.unique(text, return_inverse=True)[1].astype(np.uint64) + np.uint64(1), 1
    while True:
        after = np.zeros(len(rank), dtype=np.uint64)
        after[: max(len(rank) - reach, 0)] = rank[reach:]
        key = rank << np.uint64(32) | after
        order = np.argsort(key)
        reach *= 2
        if reach >= depth:
            return order
        ordered = key[order]
        rank = np.empty(len(order), dtype=np.uint64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64) + np.uint64(1)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(model: str) -> PieceEncoder:
    if model not in _ENCODERS:
        _ENCODERS[model] = PieceEncoder(model)
    return _ENCODERS[model]


def encoded(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text, in binary, little-endian unsigned 32 bit."""
    schema = arrow_schema("doc_id long, ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(model), Emitter(schema)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(len(texts), texts):
                for doc, raw in zip(ids[lo:hi], enc.encode(texts[lo:hi])):
                    wide = np.frombuffer(raw, dtype=enc.dtype).astype("<u4").tobytes()
                    out.add((doc, wide), len(wide))
                    if out.full():
                        yield from out.take()
        yield from out.take()

    return text_rows(docs).mapInArrow(run, "doc_id long, ids binary")


def decoded(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    schema = arrow_schema("doc_id long, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(model), Emitter(schema)
        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = enc.decode(np.frombuffer(raw or b"", dtype="<u4").astype(enc.dtype).tobytes())
                out.add((doc, text), len(text))
                if out.full():
                    yield from out.take()
        yield from out.take()

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


ROUND_TRIP = "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string"


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``ROUND_TRIP`` of every whole text: how many ids, their checksum as little-endian
    unsigned 32-bit integers, and the digest of the text decoded from them.

    A null or empty text has no ids and decodes to the empty text. Repeated rows are
    encoded each; a null doc_id stays null. Other columns are ignored; an empty
    table gives no rows."""
    schema = arrow_schema(ROUND_TRIP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encoder(model), Emitter(schema)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(len(texts), texts):
                for doc, raw in zip(ids[lo:hi], enc.encode(texts[lo:hi])):
                    wide = np.frombuffer(raw, dtype=enc.dtype).astype("<u4")
                    out.add((doc, len(wide), zlib.crc32(wide.tobytes()), hashlib.sha256(enc.decode(raw).encode()).hexdigest()))
            yield from out.take()

    return text_rows(docs).mapInArrow(run, ROUND_TRIP)
