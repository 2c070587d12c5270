"""The burst trie of conversations against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from campusloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n int, ids string, c string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows: list[tuple]) -> list[tuple]:
    turns: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - (c - int(c / 100) * 100), [])[:h] + ts[h:])
    members: dict = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        if p:
            children[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if built[c] == p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(*r, 1, "clash", "clash") for r in rows], SCHEMA)


def result(df) -> list[tuple]:
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed: int, n: int) -> list[tuple]:
    """Conversations that share many first turns, some equal, of 0 to 12 turns."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        kind = rng.random()
        for t in range(rng.randint(1, 4) if kind < 0.7 else rng.randint(5, 12)):
            text = "hello" if t < 2 and kind < 0.8 else f"say {rng.randint(0, 2)}" + "é" * rng.randint(0, 1)
            rows.append((c, t, rng.choice(["user", "user", "assistant"]) if t else "user", text))
    return rows


@pytest.mark.parametrize(("seed", "limit"), [(1, 4096), (1, 10), (2, 3), (3, 1)])
def test_equals_brute_force(spark, seed, limit):
    rows = made(seed, 260)
    random.Random(9).shuffle(rows)
    assert result(prefix_trie.conversation_trie(frame(spark, rows).repartition(4), limit)) == by_hand(rows)


def test_long_common_beginning_bursts_in_one_round(spark):
    """Forty shared turns, then branches: heads form a chain, and every node of it has its own sums."""
    rows = [(c, t, "user", f"turn {t}" if t < 40 else f"own {c % 7} {t}") for c in range(1, 60) for t in range(40 + c % 3)]
    assert result(prefix_trie.conversation_trie(frame(spark, rows), 5)) == by_hand(rows)


def test_many_equal_conversations(spark):
    rows = [(c, t, "user", "same") for c in range(3000) for t in range(2)] + [(4000 + c, 0, "user", f"other {c}") for c in range(50)]
    assert result(prefix_trie.conversation_trie(frame(spark, rows), 20)) == by_hand(rows)


def test_nulls_ties_repeats_and_negative_ids(spark):
    rows = [(1, None, None, None), (1, 0, "", ""), (1, 0, "a", "x"), (1, 0, "a", "x"), (2, 0, None, "x" * 100_000), (2, 1, "b", None)]
    rows += [(None, 0, "user", "lost"), (-7, 3, "u", "neg"), (-107, 3, "u", "neg"), (100, 5, "r", "five"), (100, None, "r", "none"), (105, 1, "q", "z")]
    rows += [(0, t, "user", f"base {t}") for t in range(3)] + [(c, 0, "user", "only") for c in range(3, 30)]
    for limit in (4096, 2):
        assert result(prefix_trie.conversation_trie(frame(spark, rows), limit)) == by_hand(rows)


def test_one_very_long_conversation(spark):
    rows = [(7, t, "user", f"t{t % 5}") for t in range(3000)] + [(8, t, "user", f"t{t % 5}") for t in range(2990)] + [(9, 0, "user", "x")]
    got = prefix_trie.conversation_trie(frame(spark, rows), 1)
    want = by_hand(rows)
    assert result(got) == want


def test_empty_table(spark):
    assert result(prefix_trie.conversation_trie(frame(spark, []))) == []
    assert result(prefix_trie.conversation_trie(frame(spark, [(None, 1, "a", "b")]))) == []


def test_members_hash_over_many_stretches(spark):
    ids = [k * 700 - 9000 for k in range(60)]
    table = spark.createDataFrame([(b"k", i) for i in ids] + [(b"l", 5)], "key binary, conv_id long")
    got = {bytes(r.key): r.sha for r in prefix_trie.members_hash(table).collect()}
    assert got == {b"k": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), b"l": hashlib.sha256(b"5").hexdigest()}
