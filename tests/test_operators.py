"""Operators against brute force on small fixtures, hot keys included."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window as W, functions as F

from campusloom import rules
from campusloom.aliases import alias_table
from campusloom.functions import basics as B
from campusloom.operators import carry, graph, joins, matching as M, pages as H, predicates as P, quality as Q, ranking, records as R, reports as A, scan
from campusloom.plans import backfill, enrich
from campusloom.sources import readers, tables as S

STOP = {"a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "the", "to", "with"}


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to one key."""
    rnd = random.Random(7)
    rows = [(("hot" if i % 3 == 0 else f"k{rnd.randrange(20)}"), i, rnd.randrange(50), rnd.random() < 0.3) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, pos long, v long, reset boolean").repartition(5).cache()


def test_running_equals_plain_window(skewed):
    w = W.partitionBy("k").orderBy("pos")
    got = carry.running(
        skewed, ["k"], ["pos"], F.floor(F.col("pos") / 37), sums={"s": F.col("v")},
        maxes={"m": F.when(F.col("v") % 2 == 0, F.col("v"))}, maxes_before={"b": F.col("v")},
    )
    want = skewed.select(
        "*", F.sum("v").over(w).alias("s"), F.max(F.when(F.col("v") % 2 == 0, F.col("v"))).over(w).alias("m"),
        F.max("v").over(w.rowsBetween(W.unboundedPreceding, -1)).alias("b"),
    )
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_arrival_number_is_global_without_keys(skewed):
    rows = carry.arrival_number(skewed, [], ["pos"], F.floor(F.col("pos") / 100)).select("pos", "arrival_no").collect()
    assert all(r.arrival_no == r.pos + 1 for r in rows)


def test_counts_since_reset(skewed):
    got = scan.counts_since_reset(skewed, ["k"], ["pos"], "pos", {"n": ~F.col("reset")}, F.col("reset"), ttl=40)
    by_key = defaultdict(list)
    for r in skewed.collect():
        by_key[r.k].append(r)
    want = {}
    for k, rows in by_key.items():
        n, last = 0, None
        for r in sorted(rows, key=lambda r: r.pos):
            if last is not None and r.pos - last >= 40:
                n = 0
            n, last = (0 if r.reset else n + 1), r.pos
            want[r.pos] = n
    assert {r.pos: r.n for r in got.collect()} == want


def brute_search(queries, docs, weights, k):
    toks = lambda s: {t for t in "".join(c if c.isalnum() and c.isascii() else " " for c in (s or "").lower()).split() if t not in STOP}
    out = {}
    for q in set(queries):
        scored = []
        for d in docs:
            s = sum(w for f, w in weights.items() for t in toks(q) if t in toks(d[f]))
            if s:
                scored.append((-s, d["id"]))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out[(q, rank)] = (i, -s)
    return out


@pytest.mark.parametrize("first_block", [1, 7, 10_000])
def test_search_is_exact_for_any_blocks(spark, first_block):
    rnd = random.Random(3)
    words = ["data", "law", "art", "the", "bio", "music", "civil", "nano"]
    pick = lambda n: " ".join(rnd.choice(words[: rnd.choice([2, 5, 8])]) for _ in range(n))
    docs = [{"id": i, "title": pick(3), "field": pick(2)} for i in range(60)] + [{"id": 100 + i, "title": "data law", "field": "data"} for i in range(30)]
    queries = [pick(rnd.choice([1, 2, 3])) for _ in range(80)] + ["unknown", "the"]
    d = spark.createDataFrame([(x["id"], x["title"], x["field"]) for x in docs], "id long, title string, field string")
    q = spark.createDataFrame([(x,) for x in queries], "q string")
    weights = {"title": 10, "field": 6}
    got = M.search(q, "q", M.token_index(d, "id", weights), "id", 5, first_block).collect()
    assert {(r.q, r["rank"]): (r.id, r.score) for r in got} == brute_search(queries, docs, weights, 5)


def brute_slugs(names, taken):
    taken, out = set(taken), []
    for n in names:
        s, i = n, 0
        while s in taken:
            i += 1
            s = f"{n}-{i}"
        taken.add(s)
        out.append(s)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_slugs_equal_arrival_order(spark, seed):
    rnd = random.Random(seed)
    pool = ["a", "a-1", "a-2", "a-1-1", "b", "b-3", "c"]
    names = [rnd.choice(pool) for _ in range(60)] + ["a"] * 20
    taken = ["a-4", "b", "a-1-2"]
    new = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    ex = spark.createDataFrame([(t,) for t in taken], "slug string")
    got = ranking.assign_slugs(new.withColumn("at", F.col("id")), ex, "id", "name", "at", F.floor(F.col("id") / 9), block=7)
    assert [r.slug for r in got.orderBy("id").collect()] == brute_slugs(names, taken)


@pytest.mark.parametrize("clashes", [2, 50])
def test_slug_passes_do_not_grow_with_clashes(spark, monkeypatch, clashes):
    writes = []
    monkeypatch.setattr(ranking, "durable", lambda df, cut=ranking.durable: writes.append(1) or cut(df))
    names = [x for i in range(clashes) for x in ("campus", f"campus-{i + 1}", "campus")]
    new = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    got = ranking.assign_slugs(new.withColumn("at", F.col("id")), new.limit(0).select(F.col("name").alias("slug")), "id", "name", "at", F.floor(F.col("id") / 9), block=7)
    assert [r.slug for r in got.orderBy("id").collect()] == brute_slugs(names, [])
    assert len(writes) == 6


def test_batches_cover_all_keys(spark):
    from campusloom.sources.tables import batch_ends

    df = spark.createDataFrame([(k * k,) for k in range(1000)], "k long").repartition(5)
    assert batch_ends(df, "k", None, 300) == [299**2, 599**2, 899**2, 999**2]
    assert batch_ends(df, "k", 899**2, 300) == [999**2] and batch_ends(df, "k", 999**2, 300) == []


def test_backfill_of_one_course(spark):
    from campusloom.plans.backfill import link_scope

    scope = spark.createDataFrame([(1,), (2,)], "entity_id long")
    programs = spark.createDataFrame([(1, "Hot widget", "PhD"), (1, "cold gear", "PhD"), (2, None, "PhD"), (3, "widget", "PhD")], "entity_id long, category string, level string")
    courses = spark.createDataFrame([(7, "hot widget", "PhD")], "course_id long, title string, level string")
    got = link_scope(scope, programs, courses, (7, "hot widget")).collect()
    assert [(r.entity_id, r.category, r.course_id) for r in got] == [(1, "Hot widget", 7)]


def test_sections_against_brute_force(spark):
    import re

    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars < 4000").limit(40).collect()]
    marked = [t.replace("\n", "[PAGE 1]") for t in texts] + ["tiny", "[PAGE 1] " + "admission fees for the program " * 3 + "[SECTION 2]" + "news event " * 9]
    from campusloom import rules

    def brute(content):
        if len(content) < 50:
            return content
        parts = [p.strip() for p in re.split(rules.SECTION_MARK, content)]
        scored = sorted(
            ((-sum(w for p, w in rules.SECTION_SCORES if re.search(p, t, re.I)), i, t) for i, t in enumerate(parts) if len(t) >= 40)
        )
        kept = []
        for _, _, t in scored:
            ws = set(re.split(r"[ \t\n\x0b\f\r]+", t.lower())[:80])
            if not any(len(ws & k) / max(len(ws), len(k), 1) > 0.65 for _, k in kept):
                kept.append((t, ws))
            if len(kept) >= 8:
                break
        return "\n\n---\n\n".join(f"[SECTION {i + 1}]\n{t}" for i, (t, _) in enumerate(kept))

    df = spark.createDataFrame(list(enumerate(marked)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(ranking.preprocess_content(F.col("t"))).collect()]
    assert got == [brute(m) for m in marked]


def test_edge_lists_split_large_owners(spark):
    edges = spark.createDataFrame([("big", i) for i in range(1000)] + [("small", 1)], "o string, m long")
    rows = graph.edge_lists(edges, "o", "m", part_size=100).collect()
    assert len([r for r in rows if r.o == "big"]) == 10
    assert sorted(m for r in rows if r.o == "big" for m in r.members) == list(range(1000))
    assert max(len(r.members) for r in rows) < 200


def test_unmatched_ranking_details(spark):
    rows = [(1, "U1", " Law ", "UG", 3), (1, "U1", "law", None, 1), (2, "U2", "LAW", "UG", 2), (3, "U3", "Art", "PhD", 4), (3, "U3", "", "PhD", 5)]
    df = spark.createDataFrame(rows, "entity_id long, entity_name string, category string, level string, ord long")
    top = A.unmatched_ranking(df, samples=1).collect()
    assert [(r.category, r["count"], r.entity_count, r.sample_label, r.levels, r.sample_entities) for r in top] == [
        ("law", 3, 2, "law", {"UG": 2}, ["U1"]), ("art", 1, 1, "Art", {"PhD": 1}, ["U3"]),
    ]


def test_fill_gaps_with_the_built_in_rules(spark):
    df = spark.createDataFrame(
        [
            ("City Polytechnic", "Germany", "", None, [("Computer Science", "Undergraduate")], None, ["a"], None),
            ("Any University", "Nowhere", "USD 1", "5", [("X", "PhD")] * 3, ["Fall"], ["a", "b", "c"], ["Peer"]),
            ("Fine Academy", "Canada", " ", "", [], [], [], []),
        ],
        "name string, country_name string, tuition_fee string, total_students string, programs array<struct<category:string,level:string>>, "
        "intakes array<string>, admission_requirements array<string>, similar_universities array<string>",
    )
    a, b, c = R.fill_gaps(df, R.country_rules(spark)).orderBy(F.col("name") == "Fine Academy", F.desc("name")).collect()
    assert a.tuition_fee == "EUR 0–500/semester (estimated)" and a.total_students == "5,000–15,000 (estimated)"
    assert [p.category for p in a.programs] == ["Computer Science", "Mechanical Engineering", "Civil Engineering"]
    assert a.intakes == ["October", "April"] and len(a.admission_requirements) == 5 and a.similar_universities[0] == "Hochschule München"
    assert b.patched_fields == [] and b.tuition_fee == "USD 1" and b.programs[0].level == "PhD"
    assert len(c.patched_fields) == 6 and c.programs[0].category == "Fine Arts" and c.intakes == ["Fall", "Winter"]
    assert "Two letters" in c.admission_requirements[3]


def test_fill_after_extraction(spark):
    df = spark.createDataFrame(
        [("Foo University", "https://foo.ac.in/", None, "short", "Pune", [("Law", "PhD"), ("Art", "UG")], None, []), ("Bar", "x", "usa", "Bar " * 30, None, [], ["Fall"], ["a", "b"])],
        "name string, website string, country string, description string, city string, programs array<struct<category:string,level:string>>, intakes array<string>, admission_requirements array<string>",
    )
    foo, bar = R.fill_after_extraction(df).orderBy(F.desc("name")).collect()
    assert foo.country == "India" and foo.intakes == ["July", "January"] and len(foo.admission_requirements) == 5
    assert foo.description == "Foo University is a university, located in Pune, India, offering programs in Law, Art, at the phd and ug level. It is committed to academic excellence and student success."
    assert bar.country == "United States" and bar.description == ("Bar " * 30).strip() and bar.intakes == ["Fall"] and len(bar.admission_requirements) == 2


def test_content_checks_and_merge_of_courses(spark):
    df = spark.createDataFrame([(1, "s", ["h"]), (2, " ", None)], "course_id long, subtitle string, key_highlights array<string>")
    for c in P.COURSE_TEXTS[1:]:
        df = df.withColumn(c, F.lit("x"))
    item = lambda *n: F.array(F.struct(*[F.lit("v").alias(x) for x in n]))
    df = df.withColumn("popular_job_roles", F.array(F.lit("j"))).withColumn("entry_requirements", item("title", "description")).withColumn("faqs", item("question", "answer"))
    assert [r[0] for r in df.orderBy("course_id").select(R.course_content_complete()).collect()] == [True, False]


def test_external_only(spark):
    ext = spark.createDataFrame([(1, "d" * 90, "Rome", "Italy"), (2, None, None, "Atlantis")], "entity_id long, description string, city string, country string")
    names = spark.createDataFrame([(1, "A University"), (2, "B College")], "entity_id long, name string")
    one, two = enrich.enrich_external_only(ext, names, R.country_rules(spark)).orderBy("entity_id").collect()
    assert (one.confidence_score, one.status, one.crawl_attempts, one.is_enriched) == (0.62, "partial", 99, True)
    assert two.confidence_score == 0.5 and two.missing_fields == ["description", "city"] and not two.is_enriched


def test_score_cases(spark):
    base = {"description": "d" * 160, "city": "C", "country": "X", "tuition_fee": "f", "total_students": "1", "qs_ranking": 5.0, "acceptance_rate": 50.0,
            "intakes": ["a", "b"], "admission_requirements": ["a"] * 4, "programs": [("Law", "PhD")] * 5, "similar_universities": ["s"],
            "model_score": 0.9, "model_overridden": False, "hallucinations": []}
    thin = {**base, "description": None, "country": None, "programs": [], "intakes": [], "tuition_fee": None, "model_score": 0.5, "hallucinations": ["x"]}
    bad = {**base, "qs_ranking": 2000.0}
    menu = {**base, "description": "Click here for more of this and that"}
    schema = ("description string, city string, country string, tuition_fee string, total_students string, qs_ranking double, acceptance_rate double, intakes array<string>, "
              "admission_requirements array<string>, programs array<struct<category:string,level:string>>, similar_universities array<string>, model_score double, model_overridden boolean, hallucinations array<string>")
    df = spark.createDataFrame([tuple(r.values()) for r in (base, thin, bad, menu)], schema)
    full, low, critical, nav = Q.decide(df).collect()
    assert (full.structural_score, full.model_skipped, full.decision) == (0.97, True, "accept")
    # 0.55 + 0.04 + 0.05 + 0.02 + 0.02 + 0.02 + 0.01 = 0.71; minus 0.12, 0.06, 0.05 and 0.08
    assert low.structural_score == pytest.approx(0.71) and (low.confidence_score, low.decision) == (0.4, "reject")
    assert (critical.confidence_score, critical.decision) == (0.15, "reject") and nav.decision == "reject"


def test_priority_list_guard(spark):
    df = spark.createDataFrame([("country", 1), ("blog", 2)], "entity_type string, x int")
    with pytest.raises(ValueError, match="blog, country"):
        joins.require_kind(df, "course")
    assert joins.require_kind(df.limit(0), "course").count() == 0


def test_scope_errors(spark):
    e = spark.createDataFrame([(1, "a")], "entity_id long, slug string")
    with pytest.raises(ValueError, match="no record"):
        P.scope(e, F.lit(True), "university", "zzz")
    with pytest.raises(ValueError, match="unknown scope"):
        P.scope(e, F.lit(True), "planet")


def test_aliases(spark):
    names = spark.createDataFrame([("University of Sydney",), ("EPFL - EPF Lausanne",), ("University of Tokyo",)], "name string")
    rank = spark.createDataFrame([(1, "The University of Sydney (USYD)", "18"), (2, "EPFL", "26"), (3, "EPFL", "99")], "line_no long, institution_name string, rank string")
    got = {r.name: (r.matched_rank, r.confidence) for r in M.match_ranking(names, rank, alias_table(spark)).collect()}
    assert got == {"University of Sydney": ("18", "alias"), "EPFL - EPF Lausanne": ("26", "alias"), "University of Tokyo": (None, None)}


def test_set_columns_keeps_the_rest(spark):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id long, s string, attempts int")
    new = spark.createDataFrame([(2, None), (3, "n")], "id long, s string")
    got = {r.id: (r.s, r.attempts) for r in S.set_columns(old, new, ["id"], ["s"]).collect()}
    assert got == {1: ("a", 5), 2: (None, 6), 3: ("n", None)}


def test_backfill_resumes_and_dry_runs(spark, tmp_path):
    scope = spark.range(10).select(F.col("id").alias("entity_id"), F.lit("n").alias("name"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("country_id"))
    programs = spark.range(8).select(F.col("id").alias("entity_id"), F.lit("Law").alias("category"), F.lit("PhD").alias("level"))
    courses = spark.createDataFrame([(1, "Law", "PhD")], "course_id long, title string, level string")
    out = str(tmp_path / "run")
    dry = backfill.resumable_backfill(scope, programs, courses, out, "all", size=4, dry_run=True)
    assert dry["processed"] == 10 and not (tmp_path / "run").exists()
    first = backfill.resumable_backfill(scope, programs, courses, out, "all", size=4, max_batches=1)
    assert (first["processed"], first["linked"], first["last_id"], first["status"]) == (4, 4, 3, "paused")
    last = backfill.resumable_backfill(scope, programs, courses, out, "all", size=4, resume=True)
    assert (last["processed"], last["linked"], last["skipped"], last["status"]) == (10, 8, 1, "completed")
    assert spark.read.parquet(f"{out}/entity_course").count() == 8
    again = backfill.resumable_backfill(scope, programs, courses, out, "all", size=4, resume=True, max_batches=1)
    assert again["processed"] == 4  # a completed run starts afresh


def test_ranking_csv_with_mark_and_blanks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿"Institution Name","2025 Rank"\n"B, of ""X""", 2 \n\n,3\nC,\n"B, of ""X""",9\n', encoding="utf-8")
    rows = readers.read_ranking(spark, str(tmp_path / "r.csv")).orderBy("line_no").collect()
    assert [(r.institution_name, r["rank"]) for r in rows] == [('B, of "X"', "2"), ('B, of "X"', "9")]


def test_content_pieces_make_the_content(spark):
    """A record with a third of all rows and over a hundred pages, repeated, short, null and empty texts."""
    rng = random.Random(3)
    fill = lambda: "".join(rng.choices("ab é😀", k=rng.randint(60, 110)))
    rows = [("hot" if i % 3 == 0 else f"e{i % 40}", i, rng.choice([None, "", "short", "x" * 90, f" {fill()} tuition", fill(), fill()])) for i in range(2100)]
    pages = spark.createDataFrame(rows, "entity string, pos int, text string").repartition(7)
    whole = {r.entity: r.content for r in ranking.assemble_content(pages, "entity", "pos", "text").collect()}
    pieces = defaultdict(list)
    for r in ranking.content_pieces(pages, "entity", "pos", "text").orderBy("entity", "page_no").collect():
        pieces[r.entity].append(r)
    assert set(pieces) == set(whole) and len(pieces["hot"]) > 100
    for entity, parts in pieces.items():
        assert [p.page_no for p in parts] == list(range(1, len(parts) + 1))
        assert ranking.PIECE_RULE.join(p.piece for p in parts) == whole[entity]
        assert all(whole[entity][p.start : p.start + len(p.piece)] == p.piece for p in parts)
    assert ranking.content_pieces(pages.limit(0), "entity", "pos", "text").count() == 0


def test_smallest_containing_by_brute_force(spark):
    """Short and long words, parts that no text holds, repeated keys, a text of 10,000 characters."""
    rng = random.Random(5)
    names = ["".join(rng.choices("abC é", k=rng.randint(0, 12))) for _ in range(150)] + ["".join(rng.choices("abcd", k=10_000)), None]
    dim = [(rng.randrange(100), n) for n in names]
    words = ["".join(rng.choices("abcé", k=rng.randint(0, 7))) for _ in range(300)] + [names[-2].lower()[5_000:5_040], None, "zzzz"]
    want = {w: min(k for k, n in dim if n and w in n.lower()) for w in words if w and any(n and w in n.lower() for _, n in dim)}
    got = M.smallest_containing(spark.createDataFrame([(w,) for w in words], "w string"), spark.createDataFrame(dim, "id int, name string"), "w", "id", "name").collect()
    assert {r.w: r.id for r in got} == want and len(got) == len(want) > 40


def test_distinct_sketches(spark, tmp_path):
    """Kept sketches of runs, merged over a span, against the exact count; a new run adds its own only."""
    rows = spark.range(60_000).selectExpr("id % 3 AS run", "if(id % 4 = 0, 'hot', 'rest') AS kind", "CASE WHEN id % 50 <> 0 THEN id % 20000 END AS v")
    for run in range(3):
        A.distinct_sketches(rows.filter(F.col("run") == run), "run", ["kind"], "v").write.mode("append").parquet(str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))
    assert kept.count() == 6
    for span in ([0], [0, 2], [0, 1, 2]):
        exact = {r.kind: r.n for r in rows.filter(F.col("run").isin(span)).groupBy("kind").agg(F.countDistinct("v").alias("n")).collect()}
        for r in A.distinct_estimates(kept.filter(F.col("run").isin(span)), ["kind"]).collect():
            assert abs(r.n_estimated - exact[r.kind]) <= 4 * A.sketch_error() * exact[r.kind]
    none = A.distinct_sketches(rows.filter("run > 5"), "run", ["kind"], "v")
    assert A.distinct_estimates(none, ["kind"]).count() == 0
    nulls = A.distinct_sketches(rows.filter("v IS NULL"), "run", ["kind"], "v")
    assert {r.n_estimated for r in A.distinct_estimates(nulls, ["kind"]).collect()} == {0}


def test_sitemap_chain(spark):
    """Cycles, repeats, missing files, names of another site, depth and number of sub-maps."""
    index = spark.createDataFrame(
        [("i", 1, "i"), ("i", 2, "a"), ("i", 3, "programs"), ("i", 4, "a"), ("i", 5, "n"), ("n", 1, "i"), ("n", 2, "b"), ("n", 3, "x"), ("x", 1, "deep"), ("i", 6, "gone")],
        "source string, ord int, loc string",
    )
    entries = spark.createDataFrame([(m, k, f"{m}/{k}") for m in ("a", "b", "programs", "deep", "other") for k in (1, 2)], "source string, ord int, loc string")
    roots = spark.createDataFrame([(1, "i"), (1, "i"), (2, "a"), (3, "none"), (None, "a"), (4, "x")], "site int, source string")

    def reached(**more):
        return sorted({(r.site, r.source, r.depth) for r in readers.sitemap_chain(index, entries, roots, **more).collect()})

    found = readers.sitemap_chain(index, entries, roots)
    assert found.count() == found.distinct().count() == 2 * len(reached())
    assert reached() == [(1, "a", 1), (1, "b", 2), (1, "programs", 1), (2, "a", 0), (4, "deep", 1)]
    assert (1, "deep", 3) in reached(depth=3) and reached(depth=0) == [(2, "a", 0)]
    assert [r for r in reached(n=1) if r[0] == 1] == [(1, "programs", 1)]


def test_sitemap_index(spark, tmp_path):
    (tmp_path / "i.xml").write_text("<sitemapindex>" + "".join(f"<sitemap><loc> https://x.org/{n}.xml </loc></sitemap>" for n in ("a", "b", "programs", "c")) + "</sitemapindex>")
    index = readers.read_sitemaps(spark, str(tmp_path / "i.xml"), tag="sitemap")
    assert [r.loc for r in readers.pick_submaps(index).orderBy("rank").collect()] == [f"https://x.org/{n}.xml" for n in ("programs", "a", "b")]


def test_bound_reads_value_once(spark):
    df = spark.range(3).select(B.bound(F.col("id") + 1, lambda x: x * x).alias("v"))
    assert [r.v for r in df.collect()] == [1, 4, 9]


def test_links_of_every_spelling(spark):
    html = """<!-- <a href="/c">c</a> --><script>var t='<a href="/s">'</script><style>a:after{content:'<a href=/t>'}</style>
<A class=x HREF=/fees>f</A><a title="t" href='/p?a=1&amp;b=2'>p</a><a data-href="/no" href="/yes">y</a><a href="">e</a><abbr href="/n">n</abbr>"""
    rows = H.links(spark.createDataFrame([(1, "https://x.org/", html), (2, "https://x.org/", None)], "id int, url string, html string"), ["id"]).orderBy("pos").collect()
    assert [r.href for r in rows] == ["/fees", "/p?a=1&b=2", "/yes", ""]
    assert rows[1].link == "https://x.org/p?a=1&b=2"


def test_navigation_links_nest(spark):
    html = """<a href="/out">o</a><div class="top menu"><div><a href=/a>a</a></div><a href="/b&amp;c">b</a></div><a class="menu" href="/self">s</a>
<ul class="navigation"><li><a href="/d">d</a><li><a name="x">no</a></ul><div class="menubar"><a href="/e">e</a></div><nav><br><a href="/f">f</a></nav><!-- <nav><a href="/g"></a></nav> -->"""
    assert H.nav_hrefs(html) == ["/a", "/b&c", "/d", "/f"] and H.nav_hrefs(None) == []
    rows = H.nav_links(spark.createDataFrame([(1, "https://x.org/", html), (2, "https://x.org/", None)], "id int, url string, html string"), ["id"]).orderBy("pos").collect()
    assert [r.link for r in rows] == ["https://x.org/a", "https://x.org/b&c", "https://x.org/d", "https://x.org/f"]


@pytest.mark.parametrize("selector", ["class", "id"])
def test_every_noise_selector_is_dropped(selector):
    exact = rules.NOISE_CLASSES if selector == "class" else rules.NOISE_IDS
    parts = rules.NOISE_CLASS_PARTS if selector == "class" else rules.NOISE_ID_PARTS
    for name in [*exact, *(f"a-{p}-b" for p in parts)]:
        assert H.page_text(f'<body><div {selector}="{name}">noise</div>text</body>') == "text"
    for tag in rules.NOISE_TAGS:
        assert "noise" not in H.page_text(f"<body><{tag}>noise</{tag}>text</body>") or tag == "embed"


def test_country_rules_join_without_shuffle(spark, capsys):
    df = spark.range(10).select(F.lit("Fine Academy").alias("name"), F.col("id").cast("string").alias("country_name"))
    df.join(R.country_rules(spark), F.col("country_name") == F.col("country"), "left").explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_sections_are_all_kept_and_compared_whole(spark):
    rnd = random.Random(5)
    same = " ".join(f"w{i}" for i in range(80))
    parts = [" ".join(f"s{k}x{rnd.randrange(10_000)}" for _ in range(20)) for k in range(12)]
    parts += [same + " " + " ".join(f"{end}{i}" for i in range(80)) for end in "ab"] + [parts[3]]
    df = spark.createDataFrame([("[PAGE 1]".join(parts),)], "t string")
    got = df.select(ranking.preprocess_content(F.col("t"), None, None), ranking.preprocess_content(F.col("t"))).first()
    # No keyword, so in text order; the last part repeats one.
    assert got[0] == "\n\n---\n\n".join(f"[SECTION {i + 1}]\n{p}" for i, p in enumerate(parts[:-1]))
    assert got[1] == "\n\n---\n\n".join(f"[SECTION {i + 1}]\n{p}" for i, p in enumerate(parts[:8]))


def test_rewrite_candidates_behind_pages_of_another_kind(spark):
    from types import SimpleNamespace

    from registry import QUERIES

    url = "https://site.example.com"
    rows = [(f"{url}/courses/c{i}", 2, 0, 9, None) for i in range(300)] + [(f"{url}/programs/universities/c{i}", 2, i, 500, i / 500) for i in range(500)]
    perf = spark.createDataFrame(rows, "url string, run_no int, clicks long, impressions long, ctr double")
    # The first 420 universities have no record, odd ones have a title of their own.
    ids = [(i if i >= 420 else 2 * i + 1001, f"N{i}") for i in range(500)]
    entities = spark.createDataFrame(ids, "entity_id long, name string")
    got = QUERIES["rewrite_candidates"].build(SimpleNamespace(fx_perf=perf, fx_entity=entities)).collect()
    assert [(r.slug, r.meta_title) for r in got] == [(f"c{i}", "") for i in range(420, 440, 2)]


def test_records_are_kept_whole(spark, tmp_path):
    import json

    from campusloom.functions.hashing import external_key

    lists = {"intakes": 7, "admissionRequirements": 11, "similarUniversities": 9, "imageUrls": 31}
    texts = {"description": 6000, "city": 150, "totalStudents": 80, "tuitionFee": 300}
    raw = {k: [f"https://x.org/member{i}" for i in range(n)] for k, n in lists.items()} | {k: "x" * n for k, n in texts.items()}
    subjects = ["M" * 160 + end for end in "ab"]
    raw["programs"] = [{"category": s, "level": "PhD"} for s in subjects]
    df = spark.createDataFrame([(1, json.dumps(raw))], "id long, raw string")
    row = R.clean_response(df, "raw").first()
    assert [len(row[f]) for f in ("intakes", "admission_requirements", "similar_universities", "image_urls")] == [7, 11, 9, 31]
    assert [len(row[f]) for f in ("description", "city", "total_students", "tuition_fee")] == [6000, 150, 80, 300]
    assert [p.category for p in row.programs] == subjects
    few = R.clean_response(df, "raw", {"intakes": 6, "description": 800, "programs": 120}).first()
    assert (len(few.intakes), len(few.description), [p.category for p in few.programs]) == (6, 800, ["M" * 120])
    # A rank that needs repair: salvaged with the whole description and both subjects.
    bad = R.clean_response(df, "raw").withColumns({"qs_ranking": F.lit("#5"), "city": F.lit("Town"), "total_students": F.lit("9"), "tuition_fee": F.lit("9")}).drop("raw", "parsed")
    kept = R.validate(bad).first()
    assert kept.success and kept.salvaged and len(kept.description) == 6000 and [p.category for p in kept.programs] == subjects
    cut = R.validate(bad, 5000, 150).first()
    assert cut.success and len(cut.description) == 5000 and len(cut.programs) == 1
    urls = F.transform(F.sequence(F.lit(1), F.lit(31)), lambda i: i.cast("string"))
    assert len(df.select(R.provenance(urls, F.array(F.struct(F.lit("s").alias("source"))))).first()[0]) == 32
    (tmp_path / "m.xml").write_text("<urlset>" + "".join(f"<url><loc>https://x.org/{i}</loc></url>" for i in range(501)) + "</urlset>")
    maps = readers.read_sitemaps(spark, str(tmp_path / "m.xml"))
    assert [r["loc"] for r in maps.orderBy("ord").collect()] == [f"https://x.org/{i}" for i in range(501)]
    assert readers.pick_submaps(maps, None).count() == 501
    assert spark.createDataFrame([("n" * 80 + "a",), ("n" * 80 + "b",), ("N" * 80 + "B",)], "n string").select(external_key(F.col("n"))).distinct().count() == 2


def test_search_joins_only_blocks_that_can_enter(spark, monkeypatch):
    """One token in every document, asked for by every query: the first block settles it, whatever the table's size."""
    met = []
    monkeypatch.setattr(M, "durable", lambda df, cut=M.durable: (met.append(df) if df.columns[:2] == ["set_id", "key"] else None) or cut(df))
    docs = spark.range(3000).select("id", F.when(F.col("id") % 500 == 7, "common rare").otherwise("common").alias("title"))
    queries = spark.createDataFrame([("common",), ("rare common",), ("Common!",), ("rare",)], "q string")
    got = {}
    for r in M.search(queries, "q", M.token_index(docs, "id", {"title": 10}), "id", 3, first_block=6).orderBy("q", "rank").collect():
        got.setdefault(r.q, []).append((r.id, r.score))
    rare = [(7, 20.0), (507, 20.0), (1007, 20.0)]
    assert got == {"common": [(0, 10.0), (1, 10.0), (2, 10.0)], "Common!": [(0, 10.0), (1, 10.0), (2, 10.0)], "rare common": rare, "rare": [(i, 10.0) for i, _ in rare]}
    assert len(met) == 1


def test_search_without_matches_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "id long, title string")
    index = M.token_index(docs, "id", {"title": 1})
    queries = spark.createDataFrame([(None,), ("",), ("law",)], "q string")
    assert M.search(queries, "q", index, "id").collect() == []
    assert M.search(queries.limit(0), "q", index, "id").collect() == []


def test_long_program_lists_are_not_compared_all_with_all(spark):
    """6,000 programs of one record: with all keys computed anew per program this took minutes."""
    import time

    n = 6000
    programs = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.concat(F.lit(" Subject "), (i % 3000).cast("string")).alias("category"), F.lit("BSc").alias("level")))
    df = spark.range(1).select(programs.alias("programs"), F.transform(programs, lambda p: F.upper(p["category"])).alias("texts"))
    start = time.time()
    row = df.select(R.repair_programs("programs").alias("p"), R.distinct_ignoring_case(F.col("texts")).alias("t")).first()
    assert time.time() - start < 30
    assert [p.category for p in row.p] == [f"Subject {i % 3000}" for i in range(1, 3001)]
    assert row.t == [f" SUBJECT {i % 3000}" for i in range(1, 3001)]


def test_distinct_lists_keep_the_first_of_each_key(spark):
    programs = [("Law", "PhD"), (None, "PhD"), ("law", "PhD"), ("Art", None), ("LAW", "Diploma"), ("Art", "PhD"), ("Law", "PhD")]
    df = spark.createDataFrame([(programs, ["b  long", None, " A long", "", "a long ", "B  long", "tiny"]), ([], []), (None, None)], "p array<struct<category:string,level:string>>, t array<string>")
    got = df.select(R.distinct_programs(F.col("p")).alias("p"), R.distinct_ignoring_case(F.col("t")).alias("t")).collect()
    assert [tuple(x) for x in got[0].p] == [("Law", "PhD"), ("LAW", "Diploma"), ("Art", "PhD")]
    assert got[0].t == ["b  long", " A long"]
    assert (got[1].p, got[1].t, got[2].p, got[2].t) == ([], [], None, None)


def test_resumable_backfill_reads_its_programs_once(spark, tmp_path):
    """Every batch computed the whole programs anew."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    scope = spark.createDataFrame([(k, f"E{k}", k % 3) for k in range(12)], "entity_id long, name string, country_id int")
    programs = spark.createDataFrame([(k % 12, f"law {k % 5}", "PhD") for k in range(40)] + [(99, "law", "PhD")], "entity_id long, category string, level string")
    courses = spark.createDataFrame([(1, "f", "law 1", "PhD"), (2, "f", "law 2", "PhD")], "course_id long, field string, title string, level string")
    last = backfill.resumable_backfill(scope, programs.mapInArrow(counted, programs.schema), courses, str(tmp_path / "run"), "all", size=3)
    assert last["status"] == "completed" and last["processed"] == 12
    assert read.value == 41
