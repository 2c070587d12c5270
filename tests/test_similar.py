"""Near-duplicate sections across documents against brute force, and the block helpers."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from campusloom.operators import blocks, similar


def by_hand(rows, overlap=0.65):
    out = {}
    for k, words in rows:
        near = [j for j, other in rows if j != k and words and len(words & other) > overlap * max(len(words), len(other))]
        out[k] = (len(near), min([k, *near]))
    return out


def sets_of(spark, rows):
    return spark.createDataFrame([(k, sorted(w), "x") for k, w in rows], "k long, words array<string>, word string")


def result(df):
    return {r.k: (r.n_similar, r.first.k) for r in df.collect()}


def made(seed, n, hot):
    """Sets around a few stems, of which a third share almost all words; `hot` words are in every set."""
    rng = random.Random(seed)
    stems = [{f"w{rng.randint(0, 60)}" for _ in range(rng.randint(2, 14))} for _ in range(12)]
    rows = []
    for k in range(n):
        words = set(stems[0] if rng.random() < 0.33 else rng.choice(stems))
        for _ in range(rng.randint(0, 4)):
            words ^= {f"w{rng.randint(0, 60)}"}
        rows.append((k, words | {f"hot{h}" for h in range(hot)} if rng.random() < 0.9 else set()))
    return rows


@pytest.mark.parametrize(("seed", "hot", "block_rows"), [(1, 0, 1024), (2, 3, 17), (3, 9, 40)])
def test_equals_brute_force(spark, seed, hot, block_rows):
    rows = made(seed, 330, hot)
    assert result(similar.similar_sets(sets_of(spark, rows), ["k"], "words", block_rows=block_rows)) == by_hand(rows)


def test_one_word_in_every_set(spark):
    """Sets of one hot word and one of their own meet by the hot word alone; its meeting is spread over blocks."""
    rows = [(k, {"all", f"own{k}"}) for k in range(700)] + [(1000 + k, {"all"}) for k in range(500)]
    assert result(similar.similar_sets(sets_of(spark, rows), ["k"], "words", overlap=0.4, block_rows=64)) == by_hand(rows, 0.4)


def test_thousands_of_equal_sets(spark):
    rows = [(k, {"a", "b", "c"}) for k in range(3000)] + [(5000, {"a", "b", "c", "d"})]
    got = result(similar.similar_sets(sets_of(spark, rows), ["k"], "words"))
    assert set(got.values()) == {(3000, 0)} and len(got) == 3001


def test_sections_nulls_empty_long_and_clashing_names(spark):
    long = " ".join(f"word{k}" for k in range(20_000))
    rows = [(1, None), (2, ""), (3, "too short"), (4, long + "\n" + "x" * 50), (5, "  " + long.upper() + " extra  "), (5, "x" * 50 + "\n\n" + "y" * 39), (None, "x" * 50)]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, section int, words string")
    got = {(r.doc_id, r.section, r.n_similar, r.first_doc_id, r.first_section) for r in similar.similar_sections(docs, "doc_id", "text").collect()}
    assert got == {(4, 0, 1, 4, 0), (4, 1, 2, None, 0), (5, 0, 1, 4, 0), (5, 0, 2, None, 0), (None, 0, 2, None, 0)}
    assert similar.similar_sections(docs.limit(0), "doc_id", "text").collect() == []


def test_block_pairs_hold_every_pair_once(spark):
    rows = spark.range(500).select((F.col("id") % 7 == 0).cast("int").alias("g"), "id")
    dealt = blocks.block_pairs(rows, ["g"], "id", 50).collect()
    groups: dict = {}
    for r in dealt:
        groups.setdefault((r.g, r.bi, r.bj), []).append((r.id, r.own))
    seen: dict = {}
    for (g, i, j), members in groups.items():
        for a, x in members:
            for b, y in members:
                if a < b and (i == j or x != y):
                    seen[(g, a, b)] = seen.get((g, a, b), 0) + 1
    ids = {g: [r.id for r in rows.collect() if r.g == g] for g in (0, 1)}
    assert set(seen.values()) == {1} and len(seen) == sum(len(v) * (len(v) - 1) // 2 for v in ids.values())


def test_look_up_spreads_a_frequent_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"), "id")
    table = spark.createDataFrame([(1, "one"), (4500, "other")], "k long, name string")
    got = blocks.looked_up(rows, ["k"], table, "id")
    assert got.filter("name = 'one'").count() == 4000 and got.filter("name = 'other'").count() == 1 and got.count() == 5000
    assert blocks.looked_up(rows, ["k"], table, "id", "inner").count() == 4001


def test_words_travel_only_with_possible_partners(spark, monkeypatch):
    """Sets that share one rare word and little else never meet with their words: these would fill the disk."""
    rows = [(i, sorted({f"shared{i // 4}", *(f"w{i}_{k}" for k in range(20 + i % 300))})) for i in range(400)]
    rows += [(1000 + i, sorted({*(f"twin{k}" for k in range(60)), f"own{i}"})) for i in range(3)]
    met = []
    whole = similar._meetings
    monkeypatch.setattr(similar, "_meetings", lambda r, overlap: met.append(r.count()) or whole(r, overlap))
    sets = spark.createDataFrame(rows, "k long, words array<string>")
    got = {r.k: (r.n_similar, r.first.k) for r in similar.similar_sets(sets, ["k"], "words").collect()}
    assert got == {k: (2, 1000) if k >= 1000 else (0, k) for k, _ in rows}
    assert met[0] <= 3 * 25


def test_signatures_of_different_lengths_never_rule_out_a_similar_pair(spark):
    rng = np.random.default_rng(5)
    pool = rng.integers(-(2**62), 2**62, 3000)
    sets = [pool[:n] for n in (10, 15, 16, 17, 24, 30, 33, 64, 65, 99, 128, 129, 190, 1024, 1025, 1500, 2300)]
    sets += [np.append(pool[5:n], rng.integers(-(2**62), 2**62, 5)) for n in (16, 17, 33, 65, 129, 1025)]
    df = spark.createDataFrame([(k, 1, s.tolist(), len(s)) for k, s in enumerate(sets)], "id long, copies long, ranked array<long>, size int").repartition(3)
    rows = similar._signed(df).withColumn("place", F.lit(0)).orderBy("id").toArrow()
    bounds = similar.Bounds(rows, 0.65)
    i, j = np.triu_indices(len(sets), 1)
    left = set(zip(*(x.tolist() for x in bounds.possible(i, j))))
    near = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if len(np.intersect1d(sets[a], sets[b])) > 0.65 * max(len(sets[a]), len(sets[b]))}
    assert near and near <= left


def test_words_are_ordered_without_a_shuffle(spark):
    """Every word of every set went through five shuffles to be joined with its count."""
    sets = [(k, 1, sorted({7, (k % 3 + 1) << 55, -(k + 1) * 10**17})) for k in range(60)]
    ordered = similar._ordered_words(spark.createDataFrame(sets, "id long, copies long, words array<long>"))
    assert "Exchange" not in ordered._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.ranked for r in ordered.collect()} == {k: [-(k + 1) * 10**17, (k % 3 + 1) << 55, 7] for k, _, _ in sets}


def test_pairs_are_formed_only_where_sizes_and_places_fit(spark, monkeypatch):
    """All pairs of a meeting were formed and then ruled out by size and place."""
    formed, whole = [], getattr(similar.Bounds, "signed", None)
    monkeypatch.setattr(similar.Bounds, "signed", lambda self, i, j: formed.extend(zip(i.tolist(), j.tolist())) or whole(self, i, j), raising=False)
    rng = np.random.default_rng(2)
    size = rng.integers(1, 200, 300)
    place = (rng.random(300) * similar._prefix(size, 0.65)).astype(int) if whole else size * 0
    group, own = np.sort(rng.integers(0, 3, 300)), rng.integers(0, 2, 300)
    single = group != 1
    table = pa.table({"size": size, "place": place, "signature": pa.array([bytes(8)] * 300, pa.binary())})
    list(similar._pairs(similar.Bounds(table, 0.65), group, own, single))
    fit = [
        (i, j) for i in range(300) for j in range(i + 1, 300)
        if group[i] == group[j] and (single[i] or own[i] != own[j]) and min(size[i] - place[i], size[j] - place[j]) >= int(0.65 * max(size[i], size[j]) + 1e-9) + 1
    ]
    assert sorted(tuple(sorted(p)) for p in formed) == fit


def test_repeated_words_count_once(spark):
    rows = [(1, ["a", "b", "a", "c"]), (2, ["c", "b", "a"]), (3, ["a", "a", "a", "d"]), (4, []), (5, None)]
    sets = spark.createDataFrame(rows, "k long, words array<string>")
    got = {r.k: (r.n_similar, r.first.k) for r in similar.similar_sets(sets, ["k"], "words").collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5)}
