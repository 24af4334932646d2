"""Token counts that follow edits.

A document is kept as a segment tree over its pre-tokens: a leaf is a run of
characters between white space with the white space behind it, and every inner
node has the characters and tokens of its subtree. An edit finds its leaves by
descending the tree, re-encodes them with one leaf of context on either side,
writes the new leaves in their place and adds up the sums on the paths to the
root. Nothing else of the document is encoded again.

Trees are kept as a table (``write_trees``): the text with the characters and tokens of
its leaves. Edits are applied to that table (``edit_trees``), whose result is such a
table again, so each round of edits encodes only what it touches.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import Emitter, arrow_schema, text_rows, write_table
from .tokens import ChunkEncoder, encoder

#: Characters from which a leaf that holds several words is full.
FULL_LEAF = 256
#: Bytes of text whose trees a worker holds at a time; a longer text is alone.
HELD_BYTES = 1 << 20
LEAF = re.compile(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]*")
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))

Edit = tuple[int, int, str]  # code points from, to, replacement


def leaves_of(text: str) -> list[str]:
    return LEAF.findall(text)[:-1]


def chunk_of(leaf: str) -> list[bytes]:
    return leaf.encode().split()


class CountTree:
    """Segment tree over leaves; node 1 is the root, node i has children 2i and 2i+1."""

    def __init__(self, leaves: list[str], tokens: Sequence[int], chars: Sequence[int] | None = None):
        self.size = 1 << max(len(leaves) - 1, 0).bit_length()
        self.leaves = leaves + [""] * (self.size - len(leaves))
        self.sums = np.zeros((2 * self.size, 2), dtype=np.int64)  # characters, tokens
        self.sums[self.size : self.size + len(leaves), 0] = [len(x) for x in leaves] if chars is None else chars
        self.sums[self.size : self.size + len(leaves), 1] = tokens
        level = self.size
        while level > 1:
            self._add_up(level // 2, level - 1)
            level //= 2

    def _add_up(self, low: int, high: int) -> None:
        """The sums of nodes of one level, from their children."""
        at = self.sums[2 * low : 2 * high + 2]
        np.add(at[::2], at[1::2], out=self.sums[low : high + 1])

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, position: int) -> tuple[int, int]:
        """(leaf, position inside it) of a code point; the end of the text is in its last leaf."""
        if position >= self.chars:
            return self._last()
        node = 1
        while node < self.size:
            node *= 2
            if position >= self.sums[node, 0]:
                position -= int(self.sums[node, 0])
                node += 1
        return node - self.size, position

    def _last(self) -> tuple[int, int]:
        node = 1
        while node < self.size:
            node = 2 * node + (self.sums[2 * node + 1, 0] > 0)
        return int(node) - self.size, int(self.sums[node, 0])

    def _beside(self, leaf: int, step: int) -> int:
        """The nearest leaf with characters on one side, or the leaf itself."""
        at = leaf + step
        while 0 <= at < self.size and not self.leaves[at]:
            at += step
        return at if 0 <= at < self.size else leaf

    def touched(self, edit: Edit) -> tuple[int, int, list[str]]:
        """(first leaf, last leaf, new leaves): what an edit makes of the leaves it
        touches and of one leaf of context on either side."""
        start, end, replacement = edit
        (first, _), (last, _) = self.find(start), self.find(end)
        first, last = self._beside(first, -1), self._beside(last, 1)
        before = self._chars_before(first)
        text = "".join(self.leaves[first : last + 1])
        return first, last, leaves_of(text[: start - before] + replacement + text[end - before :])

    def _chars_before(self, leaf: int) -> int:
        node, total = leaf + self.size, 0
        while node > 1:
            if node % 2:
                total += int(self.sums[node - 1, 0])
            node //= 2
        return total

    def put(self, first: int, last: int, new: list[str], tokens: list[int]) -> None:
        """Writes new leaves over [first, last]. A few more than there are places share the
        last one; if they are many, or it is full, the tree is laid out anew."""
        room = last - first + 1
        if len(new) > room and sum(map(len, new[room - 1 :])) > FULL_LEAF:
            at, width = self.sums[self.size :, 1].tolist(), len(self.leaves)
            kept = [k for k in range(width) if self.leaves[k] and not first <= k <= last]
            before = [k for k in kept if k < first]
            rest = kept[len(before) :]
            self.__init__([*[self.leaves[k] for k in before], *new, *[self.leaves[k] for k in rest]],
                          [*[at[k] for k in before], *tokens, *[at[k] for k in rest]])
            return
        for k in range(room):
            share = slice(k, k + 1) if k < room - 1 else slice(k, None)
            self.leaves[first + k] = "".join(new[share])
            self.sums[self.size + first + k] = len(self.leaves[first + k]), sum(tokens[share])
        low, high = (first + self.size) // 2, (last + self.size) // 2
        while low:
            self._add_up(low, high)
            low, high = low // 2, high // 2

    def text(self) -> str:
        return "".join(self.leaves)


def counter(enc: ChunkEncoder, leaf_lists: list[list[str]]) -> Callable[[list[str]], list[int]]:
    """Tokens of leaves, all new ones encoded together."""
    chunks = [[c for leaf in leaves for c in chunk_of(leaf)] for leaves in leaf_lists]
    ids, width = enc.lookup(chunks), enc.dtype.itemsize
    return lambda leaves: [sum(len(ids[c]) for c in chunk_of(leaf)) // width for leaf in leaves]


def leaf_counts(enc: ChunkEncoder, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, chars, tokens): the characters and tokens of the leaves (``leaves_of``) of all
    texts, one after another, and where each text's leaves begin, with the end of the last."""
    raw = [t.encode() for t in texts]
    chunks = [r.split() for r in raw]
    ids, width = enc.lookup(chunks), enc.dtype.itemsize
    counts = np.fromiter(map(len, map(ids.__getitem__, chain.from_iterable(chunks))), dtype=np.int32) // width
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    space = _SPACE[data]
    head = np.zeros(len(data), dtype=bool)
    np.greater(space[:-1], space[1:], out=head[1:])
    head[begin[:-1][sizes > 0]] = True
    first = np.flatnonzero(head)
    chars = np.diff(np.append(first, len(data)))
    if len(data) and data.max() >= 0x80:  # bytes that continue a character do not count
        chars = np.add.reduceat((data & 0xC0) != 0x80, first, dtype=np.int64)
    # a leaf has one chunk, but the first of a text may be white space alone
    tokens = np.zeros(len(first), dtype=np.int32)
    tokens[~space[first]] = counts
    return np.searchsorted(first, begin), chars.astype(np.int32), tokens


def trees(enc: ChunkEncoder, texts: list[str]) -> list[CountTree]:
    ends, chars, tokens = leaf_counts(enc, texts)
    ends = ends.tolist()
    return [kept_tree(t, chars[a:b], tokens[a:b]) for t, a, b in zip(texts, ends, ends[1:])]


def parts(batch: pa.RecordBatch, most: int = HELD_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in parts whose texts (second column) have ``most`` bytes or are one."""
    start = size = 0
    for k, n in enumerate(pc.binary_length(batch.column(1)).to_pylist()):
        if k > start and size + n > most:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


TREES = "doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>"


def _tree_row(doc: int | None, tree: CountTree) -> tuple:
    part = tree.sums[tree.size :]
    part = part[part[:, 0] > 0]
    return doc, tree.text(), part[:, 0].astype(np.int32), part[:, 1].astype(np.int32)


def stored_trees(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``TREES``: every document's text with the leaves of its tree, from which
    ``CountTree`` is built again without encoding."""
    schema = arrow_schema(TREES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in parts(batch):
                ends, *counts = leaf_counts(enc, part.column(1).to_pylist())
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c), type=f.type) for c, f in zip(counts, list(schema)[2:])]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), *lists], schema=schema)

    return text_rows(docs).mapInArrow(run, TREES)


def write_trees(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``stored_trees``, kept as a table in the shared folder."""
    return write_table(stored_trees(docs, vocabulary), "trees")


def kept_tree(text: str, chars: np.ndarray, tokens: np.ndarray) -> CountTree:
    ends = np.cumsum(chars).tolist()
    return CountTree([text[a:b] for a, b in zip([0, *ends], ends)], tokens, chars)


def spread_edits(text: str, count: int = 3, removed: int = 16, added: int = 24) -> list[Edit]:
    """Edits that follow from the text: at evenly spread places, last first, ``removed`` code
    points give way to the first ``added`` of the text."""
    n, out = len(text), []
    for k in range(count, 0, -1):
        at = n * k // (count + 1)
        out.append((at, min(at + removed, n), text[:added]))
    return out


COUNTS = "doc_id long, n_tokens long, n_tokens_edited long, n_chars_encoded long, edited_sha256 string"
EDITED = TREES + ", n_tokens long, n_tokens_edited long, n_chars_encoded long"


def _edit_rows(vocabulary: str, edits: Callable[[str], list[Edit]], keep: bool, schema: pa.Schema,
               encode: Callable[[str], ChunkEncoder] = encoder):
    """``TREES`` -> ``EDITED`` (``keep``) or ``COUNTS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = encode(vocabulary), Emitter(schema)
        for batch in batches:
            for part in parts(batch):
                ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                built = [kept_tree(t, c.values.to_numpy(), n.values.to_numpy()) for t, c, n in zip(texts, part.column(2), part.column(3))]
                before = [t.tokens for t in built]
                todo = [edits(t) for t in texts]
                again = [0] * len(built)
                for turn in range(max(map(len, todo), default=0)):
                    live = [k for k, e in enumerate(todo) if turn < len(e)]
                    places = [built[k].touched(todo[k][turn]) for k in live]
                    count = counter(enc, [new for _, _, new in places])
                    for k, (first, last, new) in zip(live, places):
                        built[k].put(first, last, new, count(new))
                        again[k] += sum(map(len, new))
                for doc, n, encoded, tree in zip(ids, before, again, built):
                    if keep:
                        out.add((*_tree_row(doc, tree), n, tree.tokens, encoded), 8 * tree.size + tree.chars)
                    else:
                        out.add((doc, n, tree.tokens, encoded, hashlib.sha256(tree.text().encode()).hexdigest()))
                    if out.full():
                        yield from out.take()
        yield from out.take()

    return run


def edit_trees(kept: DataFrame, vocabulary: str, edits: Callable[[str], list[Edit]] = spread_edits) -> DataFrame:
    """``EDITED``: the kept trees after a round of edits, to be kept in turn, with the tokens
    before and after and the code points that the edits had encoded."""
    return kept.select("doc_id", "text", "leaf_chars", "leaf_tokens").mapInArrow(_edit_rows(vocabulary, edits, True, arrow_schema(EDITED)), EDITED)


def edited_counts(docs: DataFrame, vocabulary: str, edits: Callable[[str], list[Edit]] = spread_edits) -> DataFrame:
    """``COUNTS``: tokens of every whole text before and after its edits (places in the
    text as the edits before left it), the code points that the edits had encoded
    again, and the digest of the edited text. The trees are kept as a table first, and
    the edits applied to that.

    A null text is empty and its edits insert what they add. Repeated rows are
    counted each; a null doc_id stays null. Other columns are ignored; an empty
    table gives no rows."""
    return write_trees(docs, vocabulary).mapInArrow(_edit_rows(vocabulary, edits, False, arrow_schema(COUNTS)), COUNTS)
