"""The operators of campusloom.llm on small tables, against brute force, round trips and SQL."""

from __future__ import annotations

import collections
import os
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from campusloom.llm import groups, jaccard, licenses, mixing, packing, pii, quality, quality_rules, search, shared, tagger, token_files, toxicity, words
from campusloom.llm.queries import QUERIES, SQL
from campusloom.llm.tokens import TextEncoder
from tools.check_sql import norm

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, label int, size string, place string"
LONG = "word " * 60_000
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "one", "en", "a", 3), (5, "one", "en", "b", 3),
    (5, "one", "en", "b", 3), (6, LONG, "en", "a", len(LONG)), (None, "no id here", None, "a", 10), (7, "é ü  a\r\nb\x0bc 😀", "fr", "a", 20),
    (8, "mail a.b@c.example now +1 (884) 555-3918 4111111111111111 and 10.0.0.1\nReleased under the MIT License.", "en", "a", 99),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 0.5, 1, "x", "y") for r in ODD], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 0, 1), (8, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").limit(400)


def texts_of(df):
    return {r["doc_id"]: r["text"] or "" for r in df.select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*columns).collect())
    duck = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations"):
        duck.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    want = duck.execute(f"select {', '.join(columns)} from ({SQL[name]})").fetchall()
    assert got == sorted(tuple(norm(v) for v in r) for r in want)


# --- words, groups ---------------------------------------------------------


def test_word_hashes_follow_words():
    texts = ["a b a", "", "b\tc  é", "a"]
    w = words.Words([t.encode() for t in texts])
    assert w.counts.tolist() == [3, 0, 3, 1]
    flat = [x for t in texts for x in t.split()]
    assert len(set(w.hashes.tolist())) == len(set(flat))
    assert {a for a, _ in collections.Counter(zip(flat, w.hashes.tolist())).items()} == set(zip(flat, w.hashes.tolist()))
    assert w.hashes[0] == w.hashes[2] == w.hashes[6] and w.hashes[1] == w.hashes[3]


def test_shingles_of_short_and_empty_texts():
    w = words.Words([b"a b c d e f", b"", b"a b", b"a b"])
    s, bounds = words.shingles(w.hashes, w.bounds, 5)
    assert bounds.tolist() == [0, 2, 2, 3, 4] and s[2] == s[3]


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["label"] for r in groups.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in linked}
    assert groups.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shared_folder_is_asked_for(monkeypatch, spark):
    class Context:
        master = "spark://far:7077"

    class Session:
        conf = collections.namedtuple("Conf", "get")(lambda *_: None)
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared.shared_folder(Session())


# --- op 1, 3 ---------------------------------------------------------------


def test_licenses_by_brute_force(docs, odd):
    def best(unit):
        own = set(licenses.bigrams(unit))
        scored = [(2 * len(own & set(licenses.bigrams(t))) / (len(own) + len(licenses.bigrams(t)) or 1), -k, n) for k, (n, t) in enumerate(licenses.TEMPLATES)]
        return max(scored) if own and max(scored)[0] >= licenses.THRESHOLD else None

    for r in licenses.scan(docs.unionByName(odd, allowMissingColumns=True)).collect():
        text = r["text"] or ""
        units = dict.fromkeys(text.split("\n") + re.sub(r"([.!?])[\x20\x09-\x0D]+", r"\1\n", text).split("\n"))
        found = [m for m in map(best, units) if m]
        assert r["n_matches"] == len(found)
        assert r["license"] == (max(found)[2] if found else None)


def test_license_texts_by_brute_force(spark, docs):
    def best(text, notice):
        words = re.findall(r"[^\W_]+", text.lower())
        grams, own = [f"{a} {b}" for a, b in zip(words, words[1:])], set(licenses.bigrams(notice))
        windows = (set(grams[i : i + n]) for n in range(1, int(1.5 * len(own)) + 1) for i in range(len(grams) - n + 1))
        return max((2 * len(w & own) / (len(w) + len(own)) for w in windows), default=0)

    full = dict(licenses.FULL_TEXTS)
    wrap = lambda text, n=9: "\n".join(" * " + " ".join(text.split()[i : i + n]) for i in range(0, len(text.split()), n))
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by"
    texts = ["# This project is licensed under the MIT License, see below.", gpl, "", "license", "Released under the\nMIT License and Licensed under CC BY\n4.0"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "doc_id long, text string")
    short = licenses.TEMPLATES
    for r in licenses.scan_texts(df, short).collect():
        scored = [(d, -k, n) for k, (n, t) in enumerate(short) if (d := best(r.text or "", t)) >= licenses.THRESHOLD]
        assert (r.dice, r.license) == ((max(scored)[0], max(scored)[2]) if scored else (None, None))
        assert r.licenses == sorted({n for _, _, n in scored})
    got = {r.doc_id: r for r in licenses.scan_texts(df).collect()}
    assert got[0].license == "MIT" and "GPL-3.0" in got[1].licenses
    whole = spark.createDataFrame([(n, "Some words first.\n" + wrap(t) + "\nand after") for n, t in full.items()], "name string, text string")
    assert all(r.dice == 1.0 and r.name in r.licenses for r in licenses.scan_texts(whole).collect())


def test_native_operators_have_no_python(docs):
    for df in (licenses.scan(docs), licenses.scan_texts(docs), quality_rules.base_measures(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_rules_on_odd_rows(odd, none):
    rows = quality_rules.apply_rules(odd).collect()
    assert len(rows) == len(ODD)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and by[1]["base_failed"]
    assert by[6]["n_words"] == by[6]["n_repeat_words"] == 60_000 and by[6]["base_failed"]
    assert by[7]["n_words"] == 5
    assert quality_rules.apply_rules(none).count() == 0


def test_repeated_words_by_brute_force(docs):
    for r in quality_rules.base_measures(docs.limit(150)).collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        n = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + d for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for d in range(3)}
        assert r["n_repeat_words"] == len(covered)


# --- op 2 ------------------------------------------------------------------


def test_targets(spark):
    sized = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500), ("b", 90)], "source string, size long")
    got = {r["source"]: r for r in mixing.targets(sized).collect()}
    limit, weight = {"a": 30, "b": 3270, "c": 0, None: 1500}, {"a": 1, "b": 2, "c": 3, None: 1}
    target, open_ = dict.fromkeys(limit, 0.0), set(limit)
    while open_:
        rate = (1600 - sum(target[s] for s in limit if s not in open_)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if rate * weight[s] > limit[s]}
        for s in over or open_:
            target[s] = limit[s] if over else rate * weight[s]
        open_ = open_ - over if over else set()
    assert {s: round(r["target"], 6) for s, r in got.items()} == {s: round(t, 6) for s, t in target.items()}


def test_flight_keeps_both_sums():
    rng = np.random.default_rng(3)
    p, x = rng.random(500), rng.integers(1, 5000, 500).astype(float)
    q = mixing.flight(p, x, rng.random)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert q.sum() == pytest.approx(p.sum()) and q @ x == pytest.approx(p @ x)
    assert set(mixing.landing(q, rng.random)) <= {0.0, 1.0}


def test_flight_keeps_expectations():
    rng = np.random.default_rng(4)
    p, x = np.array([0.2, 0.5, 0.7, 0.4, 0.6]), np.array([3.0, 5.0, 2.0, 8.0, 3.0])
    mean = np.mean([mixing.landing(mixing.flight(p, x, rng.random), rng.random) for _ in range(4000)], 0)
    assert abs(mean - p).max() < 0.04


def test_mix_near_targets_in_any_partitioning(docs, odd, none):
    rows = docs.unionByName(odd, allowMissingColumns=True)
    small = lambda df: sorted((str(r["doc_id"]), r["taken"]) for r in mixing.mix_sources(df, block_rows=16).collect())
    assert small(rows) == small(rows.repartition(5))
    out = mixing.mix_sources(docs).toPandas()
    assert (out["taken"] <= 3 * out["size"]).all()
    sums = out.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), longest=("size", "max"))
    assert (abs(sums["taken"] - sums["target"]) <= sums["longest"]).all()
    assert mixing.mix_sources(none).count() == 0


# --- op 4 ------------------------------------------------------------------


def test_top_k_by_brute_force(spark):
    rng = np.random.default_rng(9)
    vectors = [(int(k), [float(v) for v in rng.choice([0.0, 0.0, 0.25, -0.5, 1.0], 6)]) for k in range(200)]
    vectors += [(200, None), (201, [1.0, None]), (202, [float("nan")]), (203, [float("inf")]), (None, [1.0]), (204, []), (50, vectors[50][1]), (7, vectors[7][1])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in search.top_k(df, F.col("vec_id") % 50 == 0, 5, candidate_rows=30, query_rows=2).collect())
    usable = [(k, [int(256 * x) if x >= 0 else -int(-256 * x) for x in v]) for k, v in vectors if k is not None and v is not None and k < 200 or k == 204]
    want = []
    for q, v in {k: v for k, v in usable if k % 50 == 0}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, u)), k) for k, u in usable if k != q)[:5]
        want += [(q, rank, k, -s) for rank, (s, k) in enumerate(scored, 1)]
    assert got == sorted(want)
    assert search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# --- op 5, 9 ---------------------------------------------------------------


def test_encoder_equals_library():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = ["", "a", " a", "a ", "a  b", "a\n\nb", "x\ty", "<|endoftext|> hi", "é ü\nß, Ça.", "don't I'll\n'tis 12 3.4", "a\xa0b", "a. b", "a,, b", ". a", "x). y", "1. 2, 3.\nA, ", "x² ½ 漢字 😀, ok", "a\x0bb", "a <|endoftext|> b", "no<|endoftext|>gap, <|endoftext", "\n", " \n", "a\n", "\na", "a \nb", "a\n b", "a\r b", LONG]
    for text, ids in zip(texts, TextEncoder(VOCABULARY).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:20]


def test_encoder_keeps_words_over_generations(monkeypatch):
    monkeypatch.setattr("campusloom.llm.tokens._MOST_KEPT", 5)
    texts = [f"every word {k}, again number{k % 3} here." for k in range(30)]
    encoder, tokenizer = TextEncoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.kept) + len(encoder.kept.older) < 40


def test_encoder_asks_the_library_for_many_words_at_once():
    """New words meet the library's model in calls of many, known ones in none; words of other forms keep their ids."""
    texts = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}tion word{k}!! É{chr(97 + k % 26)}ß, the end." for k in range(500)] + [None, "", "a  b"]
    encoder, tokenizer = TextEncoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    merge, calls = encoder.merge, []
    encoder.merge = lambda signs: calls.append(signs) or merge(signs)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert 0 < len(calls) <= 40
    calls.clear()
    column = pa.array(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(column.slice(100))] == want[100:] and not calls
    ids, bounds = encoder.ids(column.slice(100))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want[100:]


def test_encoder_joins_slices(monkeypatch):
    monkeypatch.setattr("campusloom.llm.tokens._MOST_BYTES", 40)
    texts = ["some words here, twice. ", None, "", "a longer text of more than forty bytes in all, whole.", "x\ty", "end"] * 3
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in TextEncoder(VOCABULARY).encode(texts)] == want


def test_token_files_of_rows_that_share_an_id(spark):
    """Several texts under one id and under none: places are those of the files, and one id is spread over files."""
    texts = [f"text {'word ' * (k % 7)}{k}" for k in range(300)]
    rows = [(5 if k % 3 else None, t) for k, t in enumerate(texts)] + [(5, "equal")] * 200 + [(4, "a <|endoftext|> b"), (6, None)]
    path = shared.new_path(spark, "test-ids")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        token_files.write_ids(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), path, VOCABULARY, end_id=2)
    finally:
        spark.conf.unset(merging)
    files = token_files.read_ids(spark, path)
    stored = sorted((r for r in files.collect()), key=lambda r: (r["chunk"], r["row"]))
    known = [r["doc_id"] for r in stored]
    assert known == sorted(known, key=lambda i: (i is not None, i or 0)) and len(stored) == len(rows)
    start, want = 0, []
    for r in stored:
        want.append((start, r["doc_id"], len(r["ids"]), zlib.crc32(np.array(r["ids"], "<u4").tobytes())))
        start += len(r["ids"])
    assert sorted(tuple(r) for r in token_files.positions(files).select("start", "doc_id", "n_tokens", "ids_crc32").collect()) == want
    tokenizer = Tokenizer.from_file(VOCABULARY)
    full = sorted((i is not None, i or 0, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows)
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["ids"]) for r in stored) == full
    assert files.filter("doc_id = 5").select("chunk").distinct().count() > 1
    for name in {r["chunk"] for r in stored}:  # a row's number is its place in its file
        numbers = [r["row"] for r in files.filter(F.col("chunk") == name).select("row").collect()]
        assert numbers == list(range(len(numbers)))


def test_plan_against_exhaustive_search():
    rng = np.random.default_rng(2)
    for _ in range(50):
        left = collections.Counter(rng.integers(1, 12, 8).tolist())
        room = int(rng.integers(1, 30))
        sums = {0}
        for x in left.elements():
            sums |= {s + x for s in sums if s + x <= room}
        chosen = packing.fullest(dict(left), room)
        assert sum(x * n for x, n in chosen.items()) == max(sums)
        assert all(n <= left[x] for x, n in chosen.items())
        plan = packing.plan(dict(left), 12)
        used = collections.Counter()
        for times, combination in plan:
            assert sum(x * n for x, n in combination.items()) <= 12
            used.update({x: n * times for x, n in combination.items()})
        assert used == left


def test_packing_places_every_piece(spark, docs, odd, none):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = docs.filter("doc_id > 10").unionByName(odd, allowMissingColumns=True)
    out = packing.pack(shared.cut(packing.pieces(rows, VOCABULARY, 128), "p"), 128, group_rows=10).toPandas()
    lengths = [len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in rows.collect()]
    assert len(out) == sum(-(-n // 128) for n in lengths) and out["length"].sum() == sum(lengths)
    out = out.sort_values(["sequence_id", "offset"])
    ends = out["offset"] + out["length"]
    new = out["sequence_id"].ne(out["sequence_id"].shift())
    assert (out["offset"] == ends.shift(fill_value=0).where(~new, 0)).all() and ends.max() <= 128
    assert out["sequence_id"].nunique() <= 1.02 * sum(lengths) / 128 + 2
    first = out[(out["doc_id"] == 6)].sort_values("piece")
    assert (first["length"].iloc[1:] == 128).all() and first["start"].tolist() == [0, *first["length"].cumsum().tolist()[:-1]]
    assert packing.pack(packing.pieces(none, VOCABULARY, 128), 128).count() == 0


def test_token_files_round_trip(spark, docs, odd, none):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = docs.filter("doc_id > 10").unionByName(odd, allowMissingColumns=True)
    path = shared.new_path(spark, "test-ids")
    token_files.write_ids(rows, path, VOCABULARY, end_id=2)
    got = sorted(tuple(r) for r in token_files.positions(token_files.read_ids(spark, path)).select("start", "doc_id", "n_tokens", "ids_crc32").collect())
    start, want = 0, []
    for r in sorted(rows.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        want.append((start, r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    found = token_files.read_ids(spark, path).filter("doc_id = 20")
    assert found.count() == 1 and "doc_id" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    empty = shared.new_path(spark, "test-ids")
    token_files.write_ids(none, empty, VOCABULARY)
    assert token_files.positions(token_files.read_ids(spark, empty)).count() == 0


# --- op 6, 8 ---------------------------------------------------------------


def test_trees_learn_a_conjunction():
    x = np.random.default_rng(5).random((3000, 4))
    y = ((x[:, 0] > 0.4) & (x[:, 2] < 0.6)).astype(float)
    model = quality.fit(x[:2000], y[:2000], trees=30)
    assert ((model.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    row, node = x[2500], 0
    for _ in range(4):
        node = 2 * node + 1 + int(row[model.feature[0][node]] > model.threshold[0][node])
    one = quality.Trees(0.0, model.feature[:1], model.threshold[:1], model.value[:1])
    assert one.margins(row[None])[0] == model.value[0][node - 15]


@pytest.mark.parametrize("seed", [1, 2])
def test_machine_learns_a_pair_without_effects_of_its_own(seed):
    """Both words are equally frequent in either kind of text; only their meeting decides. Judged on texts not learnt from."""
    rng = np.random.default_rng(seed)
    texts, y = [], []
    for _ in range(6000):
        a, b = rng.random(2) < 0.5
        texts.append(" ".join(["insult"] * int(a) + ["group"] * int(b) + [f"w{rng.integers(400)}" for _ in range(12)]))
        y.append(float(a == b))
    places, bounds = toxicity.hashed_terms(texts)
    cut, y = bounds[5000], np.array(y)
    model = toxicity.fit(places[:cut], bounds[:5001], y[:5000])
    assert ((model.scores(places[cut:], bounds[5000:] - cut) > 0.5) == y[5000:]).mean() > 0.95


def test_machine_learns_pairs():
    rng = np.random.default_rng(6)
    texts, y = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        texts.append(" ".join(["insult"] * int(a) + ["group"] * int(b) + [f"w{rng.integers(40)}" for _ in range(3)]))
        y.append(float(a and b))
    places, bounds = toxicity.hashed_terms(texts)
    model = toxicity.fit(places, bounds, np.array(y), epochs=40)
    scores = model.scores(places, bounds)
    assert ((scores > 0.5) == np.array(y)).mean() > 0.98
    own = places[bounds[3] : bounds[4]]
    known = own[model.held[own]]
    pairs = sum(float(model.factors[i] @ model.factors[j]) for k, i in enumerate(known) for j in known[k + 1 :])
    assert model.margins(own, np.array([0, len(own)]))[0] == pytest.approx(model.bias + model.weights[known].sum() + pairs, abs=1e-4)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_rows(odd, none, labels, module):
    rows = module.classify(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert module.classify(none, labels).count() == 0
    assert all(r["score"] == 0.5 for r in module.classify(odd, labels.limit(0)).collect())


@pytest.mark.parametrize(("name", "label", "least"), [("op8_quality_classifier", "quality", 0.95), ("op6_toxicity", "toxic", 0.97)])
def test_classifiers_on_held_out_labels(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    known = spark.read.parquet(f"{sf}/labels.parquet").toPandas().merge(QUERIES[name](spark, sf).toPandas(), on="doc_id")
    out = known[known["held_out"]]
    assert (out[label] == out["predicted"]).mean() > least


# --- op 7 ------------------------------------------------------------------


def brute_links(texts, k=5, threshold=0.8):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    links = collections.defaultdict(set)
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a].add(b), links[b].add(a)
    return links


def test_jaccard_with_a_hot_group_in_blocks(spark, odd):
    rng = np.random.default_rng(8)
    base = [f"w{k}" for k in range(80)]
    rows = []
    for n in range(120):
        w = list(base)
        for at in rng.integers(0, 80, rng.integers(0, 4)):
            w[at] = f"x{rng.integers(1000)}"
        rows.append((100 + n, " ".join(w)))
    rows += [(300 + n, " ".join(f"v{rng.integers(50)}" for _ in range(30))) for n in range(40)] + [(400 + n, "same words here") for n in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd, allowMissingColumns=True)
    texts = texts_of(df.filter("doc_id is not null"))
    links = brute_links(texts)
    for blocks in (16, 512):
        got = {r["doc_id"]: r for r in jaccard.join(df, block_rows=blocks).collect()}
        assert set(got) == set(texts)
        assert {i: r["n_links"] for i, r in got.items()} == {i: len(links[i]) for i in texts}
        for i, r in got.items():
            assert all(got[j]["class_id"] == r["class_id"] for j in links[i])
            assert r["class_id"] <= i and (links[i] or r["class_id"] == i)


def test_jaccard_of_nothing(none):
    assert jaccard.join(none).count() == 0


def test_least_matches_is_the_posterior_tail():
    draws = np.random.default_rng(1).beta(15 + 1, 20 - 15 + 1, 400_000)
    tail = (draws >= 0.8).mean()
    assert jaccard.least_matches(20, 0.8, tail * 0.9) <= 15 < jaccard.least_matches(20, 0.8, tail * 1.1)


# --- op 10 -----------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    chars, tags = pii.composed(1500)
    return tagger.fit(chars, tags, pii.ALLOWED, hidden=12, epochs=8)


def test_crf_by_enumeration():
    import itertools

    rng = np.random.default_rng(1)
    e, moves = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    paths = list(itertools.product(range(3), repeat=4))
    score = [sum(e[0, t, p[t]] for t in range(4)) + sum(moves[p[t], p[t + 1]] for t in range(3)) for p in paths]
    total, tag, pairs = tagger.crf_marginals(e, moves)
    assert total[0] == pytest.approx(np.log(np.exp(score).sum()))
    weight = np.exp(score - total[0])
    assert tag[0, 2, 1] == pytest.approx(sum(w for w, p in zip(weight, paths) if p[2] == 1))
    assert pairs.sum() == pytest.approx(3)
    assert tuple(tagger.viterbi(e, moves)[0]) == paths[int(np.argmax(score))]


def test_tagger_gradient():
    m = tagger.Tagger.new(3, pii.ALLOWED)
    chars, tags = pii.composed(2)
    _, gradients = m.gradients(chars, tags)
    for p, g in zip(m.parameters(), gradients, strict=True):
        at = np.unravel_index(abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-5
        up = m.gradients(chars, tags)[0]
        p[at] = old - 1e-5
        down = m.gradients(chars, tags)[0]
        p[at] = old
        assert g[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6)


def test_tagger_on_unseen_windows(model):
    chars, tags = pii.composed(300, seed=77)
    found = model.decode(chars)
    assert (found == tags).mean() > 0.9  # the fixture's tagger is smaller than the query's


def test_rules_equal_patterns_on_whole_text(docs):
    for text in texts_of(docs).values():
        want = [(m.start(), k, m.end()) for k, p in enumerate(pii.PATTERNS) for m in p.finditer(text) if pii.valid(k, m[0])]
        assert pii.rule_spans(text) == sorted(want)


PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def test_rules_equal_plain_patterns_on_random_strings():
    rng = np.random.default_rng(3)
    for _ in range(20_000):
        text = "".join(rng.choice(list("ab@@..19_-+( \n%"), rng.integers(0, 40)))
        want = [(m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text) if pii.valid(k, m[0])]
        assert pii.rule_spans(text) == sorted(want)


def test_ip_parts_of_thousands_of_zeros():
    assert pii.rule_spans("x 1.2.3." + "0" * 6000 + " y 1.2.3.256") == [(2, 1, 6008)]


def test_rules_take_linear_time_on_long_runs():
    text = "a" * 300_000 + " @ " + "1" * 300_000 + " . x@y.de_z@w.de"
    assert pii.rule_spans(text) == [(len(text) - 13, 0, len(text) - 7), (len(text) - 7, 0, len(text))]


def test_spans_run_through_windows():
    tags = np.zeros((3, pii.WINDOW), np.int64)
    spans = [(20, 2, 90), (90, 2, 100)]
    for row, start in enumerate((0, 32, 64)):
        tags[row] = pii.tags_of(spans, start)
    assert pii.reconcile(128, [0, 32, 64], tags) == spans


def test_pii_on_odd_rows(odd, none, model):
    rows = {r["doc_id"]: r for r in pii.find(odd, model).collect()}
    assert rows[1]["spans"] == rows[2]["spans"] == "" and rows[1]["base_sha256"] == rows[2]["base_sha256"]
    text = ODD[-1][1]
    base = pii.written(pii.rule_spans(text))
    assert set(base.split(",")) <= set(rows[8]["spans"].split(",")) and rows[8]["n_email"] == rows[8]["n_ip"] == 1
    masked = {r["doc_id"]: r["text"] for r in pii.redact(odd, model).collect()}
    assert masked[1] is None and masked[4] == "one" and "a.b@c.example" not in masked[8] and "10.0.0.1" not in masked[8]
    assert pii.find(none, model).count() == 0


# --- pipeline --------------------------------------------------------------


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    by_name = dict(p.STAGES)
    good = shared.cut(by_name["quality classifier"](spark, docs, SMALL), "good")
    scores = QUERIES["op8_quality_classifier"](spark, SMALL).filter("predicted = 1").select("doc_id")
    assert good.columns == docs.columns and sorted(r[0] for r in good.select("doc_id").collect()) == sorted(r[0] for r in scores.collect())
    one = shared.cut(by_name["n-gram Jaccard join"](spark, good, SMALL), "one")
    texts = texts_of(good)
    links, kept, seen = brute_links(texts), set(), set()
    for i in sorted(texts):
        if i not in seen:
            kept.add(i)
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in seen:
                    seen.add(j)
                    todo += links[j]
    assert one.columns == docs.columns and {r[0] for r in one.select("doc_id").collect()} == kept
    safe = shared.cut(by_name["PII"](spark, one, SMALL), "safe")
    for i, text in texts_of(safe).items():
        assert not pii.rule_spans(text) and (text == texts[i] or pii.rule_spans(texts[i]))
    mixed = shared.cut(by_name["mixing sources"](spark, safe, SMALL), "mixed")
    taken = mixing.mix_sources(safe).agg(F.sum("copies")).first()[0]
    assert mixed.columns == docs.columns and mixed.count() == taken
    packed = by_name["best-fit packing"](spark, mixed, SMALL)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_pipeline_on_odd_and_no_rows(spark, odd, none, labels, tmp_path):
    import corpus_pipeline as p

    for df in (odd, none):
        sf = str(tmp_path / str(df.count()))
        df.write.parquet(f"{sf}/documents.parquet")
        labels.write.parquet(f"{sf}/labels.parquet")
        out = p.run(spark, sf).toPandas()
        assert isinstance(out, pd.DataFrame) and (len(out) > 0) == os.path.exists(sf) * (df is odd)


def test_quality_rules_with_clashing_names(spark):
    schema = "doc_id long, text string, lang string, source string, kept string, base_failed int, n_words string, n_marks int, _lang int, _source int, _row int, _symbols int, low_symbols int, `a.b` int"
    rows = [(k, "some plain words " * 30 + str(k), "en", None if k % 2 else "s", "x", 1, "x", 1, 2, 3, 4, 5, 6, 7) for k in range(6)] + [(9, None, None, "s", None, 1, "x", 1, 2, 3, 4, 5, 6, 7)]
    out = quality_rules.apply_rules(spark.createDataFrame(rows, schema))
    got = out.collect()
    assert len(got) == 7 and len(set(out.columns)) == len(out.columns)
    for r in got:
        assert (r["_lang"], r["_source"], r["_row"], r["_symbols"], r["low_symbols"], r["a.b"]) == (2, 3, 4, 5, 6, 7)
        assert r["n_words"] == (0 if r["doc_id"] == 9 else 91) and r["kept"] in (True, False) and r["base_failed"]
    assert quality_rules.apply_rules(spark.createDataFrame([], schema)).count() == 0
