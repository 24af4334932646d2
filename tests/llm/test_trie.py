"""Prefix trie against a plain version on the same rows."""

import hashlib
import random
import zlib

import pytest

from haltgate.llm import prefix_trie
from haltgate.llm.queries import op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    """Every node's row, by walking all prefixes of all rebuilt conversations."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv in own:
        own[conv] = [(r, t) for _, _, r, t in sorted(own[conv])]
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(own.get(c - int(c % 5 if c >= 0 else -((-c) % 5)), [])[:h] + own[c][h:])
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out, inner = [], {p[:-1] for p in members if p}
    leaves, saved, children = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, convs in members.items():
        if p:
            children[p[:-1]] += 1
        value = (len(convs) - 1) * (len(p[-1][1].encode()) if p else 0)
        for d in range(len(p) + 1):
            saved[p[:d]] += value
            leaves[p[:d]] += p not in inner
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(p))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    """Few texts, so that prefixes are shared; nulls, ties, repeats, negative ids, a long conversation."""
    r = random.Random(5)
    out = [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "é" * 3, None, ""])) for c in range(-12, 60) for t in range(r.randint(0, 6))]
    out += [(70, None, "user", "x"), (70, None, "user", "x"), (70, 3, None, None), (70, 3, "user", "y"), (None, 1, "user", "lost"), (None, None, None, None)]
    out += [(71, 0, "user", "a"), (2**62, 0, "user", "a"), (2**62, 1, "user", "b" * 20_000)]
    return out + [(c, t, "user", f"{t % 3}") for c in (80, 81, 82) for t in range(90)]


@pytest.mark.parametrize("light", [None, 1, 20])
def test_equals_plain_version(spark, rows, light, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 32)  # the long conversations take several blocks
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), light)) == expected(rows)


def test_common_conversation_ends_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS_CHARS", 100)
    rows = [(c, t, "user", "same") for c in range(400) for t in range(9)]
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_empty_table_and_further_columns(spark):
    wide = spark.createDataFrame([(1, 0, "user", "a", 1, 2, 3)], SCHEMA + ", depth int, conv int, i int")
    assert prefix_trie.trie(wide.limit(0)).collect() == []
    assert found(prefix_trie.trie(wide)) == expected([(1, 0, "user", "a")])


def test_shard_takes_keys_that_collide():
    """Digests whose 64-bit keys are equal get other keys by another salt."""
    import numpy as np

    depth = np.array([1, 1, 1], dtype=np.int64)
    s2 = np.array([5, 9, 9], dtype=np.int64)
    probe = prefix_trie.Shard.__new__(prefix_trie.Shard)
    probe.salt = 0
    zero = np.zeros(3, dtype=np.int64)
    s1 = probe._keys(depth, zero, s2).view(np.int64).copy()
    s1[2] += 1  # the first two have key 0
    assert probe._keys(depth, s1, s2)[0] == probe._keys(depth, s1, s2)[1]
    shard = prefix_trie.Shard(depth, s1, s2)
    assert shard.salt == 1 and sorted(shard.slots(depth, s1, s2)) == [0, 1, 2]
    assert list(shard.slots(depth + 1, s1, s2)) == [-1, -1, -1]


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(op12_prefix_trie(spark, sf)) == expected(rows)
