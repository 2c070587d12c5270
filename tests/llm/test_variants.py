"""Spelling variants against brute force on small tables."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from campusloom.llm import variants

SCHEMA = "doc_id long, text string, n long, word string"


def edits_one(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point, by trying each."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_hand(rows: list[tuple]) -> set[tuple]:
    total: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    words = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}
    form: dict = {}
    near: dict = {}
    for w, n in words.items():
        near[w] = sorted((x for x in words if edits_one(w, x)), key=lambda x: (-words[x], x))
        form[w] = near[w][0] if near[w] and words[near[w][0]] >= 5 * n else None

    def root(w: str) -> str:
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def result(df) -> list[tuple]:
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def made_texts(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    rows = []
    for doc in range(150):
        words = []
        for _ in range(60):
            word = stems[min(int(rng.expovariate(0.3)), len(stems) - 1)]
            if rng.random() < 0.3:
                k = rng.randrange(len(word))
                word = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("abcéZ") + word[k:], word[:k] + "b" + word[k + 1 :]])
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((doc, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made_texts(seed)
    got = result(variants.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)))
    assert len(got) == len(set(got)) and set(got) == by_hand(rows)
    assert any(r[1] for r in got)


def test_blocks_of_one_frequent_beginning(spark):
    """Hundreds of words with one beginning, in blocks far smaller than the section: no pair is lost or counted twice."""
    rng = random.Random(3)
    words = {"prefix" + "".join(rng.choice("ab") for _ in range(rng.randint(4, 8))) for _ in range(900)}
    table = spark.createDataFrame([(w, rng.choice([5, 6, 40])) for w in sorted(words)], "word string, n long")
    counts = {r.word: r for r in variants.near_words(table, block_rows=37).collect()}
    by_n = {r.word: r.n for r in table.collect()}
    for w in words:
        near = [x for x in words if edits_one(w, x)]
        if near:
            best = min(near, key=lambda x: (-by_n[x], x))
            assert (counts[w].n_near, counts[w].best, counts[w].best_n) == (len(near), best, by_n[best])
        else:
            assert w not in counts


def test_near_pairs_agree_with_edits():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("xyÿ") for _ in range(rng.choice([6, 7]))) for _ in range(300)})
    n = len(words)
    coded, one, group = [w.encode("latin-1") for w in words], np.ones(n, bool), np.zeros(n, int)
    found = set()
    for suffix in (False, True):
        for i, j in variants.near_pairs(coded, 7, group, group, one, np.full(n, suffix)):
            pairs = {frozenset((words[a], words[b])) for a, b in zip(i, j)}
            assert not pairs & found
            found |= pairs
    assert found == {frozenset((a, b)) for a in words for b in words if edits_one(a, b) and max(len(a), len(b)) == 7}


def test_chains_of_forms_reach_the_last(spark):
    names = ["colour", "colours", "colourss", "coloursss", "colourssss"]
    table = spark.createDataFrame([(w, 5 ** (k + 2)) for k, w in enumerate(names)], "word string, n long")
    got = {r.word: (r.form, r.root) for r in variants.group_variants(table).collect()}
    assert got == {w: (names[k + 1] if k < 4 else None, names[-1]) for k, w in enumerate(names)}


def test_ties_go_to_the_smaller_word(spark):
    table = spark.createDataFrame([("letter", 5), ("better", 25), ("lettea", 25)], "word string, n long")
    got = {r.word: r for r in variants.group_variants(table).collect()}
    assert got["letter"].form == "better" and got["letter"].n_near == 2 and got["better"].n_near == 1


def test_nulls_long_texts_repeats_and_clashing_columns(spark):
    long = "lighthouse " * 30_000 + "x" * 200_000 + " " + ("x" * 199_999 + "y ") * 5
    rows = [(None, "lighthouse " * 6), (1, None), (2, ""), (3, "lighthousse " * 7), (3, "lighthousse " * 7), (4, long), (4, long)]
    table = spark.createDataFrame([(*r, 9, "clash") for r in rows], SCHEMA)
    got = result(variants.variants(table))
    assert set(got) == by_hand(rows) and len(got) == len(set(got))
    assert {r[0]: r[1] for r in got}["lighthousse"] == "lighthouse"


def test_empty_table(spark):
    assert result(variants.variants(spark.createDataFrame([], SCHEMA))) == []
    assert result(variants.variants(spark.createDataFrame([(1, "one two")], "doc_id long, text string"))) == []
