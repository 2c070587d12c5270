"""Lookups, run comparison, name and text matching, graph edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusloom.functions import basics as B, hashing, seo
from campusloom.operators import graph, joins, matching as M, ranking
from campusloom.plans import performance
from campusloom.sources import tables as S
from registry.base import query
from registry.scalars import BRAND, _CLASS, _NORM


@query(
    "J1",
    """SELECT a.url, round(a.ctr, 6) AS ctr_before, round(b.ctr, 6) AS ctr_after, round(b.ctr - a.ctr, 6) AS ctr_delta, a.impressions AS impressions_before, b.impressions AS impressions_after
FROM fx_perf a JOIN fx_perf b ON a.url = b.url WHERE a.run_no = 0 AND b.run_no = 2 AND a.meta_rewritten AND b.meta_rewritten""",
)
def run_difference(t):
    d = joins.run_difference(t.fx_perf, "run_no", 0, 2)
    return d.select("url", *[F.round(c, 6).alias(c) for c in ("ctr_before", "ctr_after", "ctr_delta")], "impressions_before", "impressions_after")


@query("J2", "SELECT e.entity_id, coalesce(c.name, 'Unknown') AS country_name FROM fx_entity e LEFT JOIN fx_country c ON e.country_id = c.country_id")
def country_names(t):
    return joins.with_country_name(t.fx_entity, t.fx_country).select("entity_id", "country_name")


@query("J3", "SELECT e.entity_id, c.name AS country_name, c.slug AS country_slug FROM fx_entity e LEFT JOIN fx_country c ON e.country_id = c.country_id")
def populated_countries(t):
    p = joins.populate(t.fx_entity, t.fx_country, "country_id", "country_id", ["name", "slug"], "country")
    return p.select("entity_id", F.col("country.name").alias("country_name"), F.col("country.slug").alias("country_slug"))


@query("J4", "SELECT url, clicks, url IN (SELECT url FROM fx_perf WHERE run_no < 2 AND meta_rewritten) AS rewritten FROM fx_perf WHERE run_no = 2")
def carried_flags(t):
    p = t.fx_perf
    return joins.flag_ever(p.filter("run_no = 2"), p.filter("run_no < 2"), "url", "meta_rewritten", "rewritten").select("url", "clicks", "rewritten")


@query("J5", "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM fx_failed_page)")
def pages_without_failures(t):
    failed = t.fx_failed_page.select(hashing.url_key(F.col("url")).alias("url_hash"))
    return joins.without_failed(t.pages.select("page_id", "url"), failed, hashing.url_key(F.col("url")))


_BY = "(SELECT norm, o, r FROM (SELECT {n} AS norm, trim(institution_name) AS o, trim(rank) AS r, row_number() OVER (PARTITION BY {n} ORDER BY line_no) AS k FROM fx_ranking) x WHERE k = 1)".format(n=_NORM.format(c="trim(institution_name)"))
_BO = "(SELECT o, r FROM (SELECT trim(institution_name) AS o, trim(rank) AS r, row_number() OVER (PARTITION BY trim(institution_name) ORDER BY line_no) AS k FROM fx_ranking) x WHERE k = 1)"
_MATCHED = f"""(SELECT e.entity_id, e.qs_ranking, CASE WHEN n.norm IS NOT NULL THEN n.o ELSE coalesce(ao.o, an.o) END AS matched_name, CASE WHEN n.norm IS NOT NULL THEN n.r ELSE coalesce(ao.r, an.r) END AS matched_rank,
  CASE WHEN n.norm IS NOT NULL THEN 'exact' WHEN coalesce(ao.r, an.r) IS NOT NULL THEN 'alias' END AS confidence
FROM fx_entity e LEFT JOIN {_BY} n ON n.norm = {_NORM.format(c='trim(e.name)')} LEFT JOIN fx_alias a ON a.db_name = trim(e.name) LEFT JOIN {_BO} ao ON ao.o = a.target LEFT JOIN {_BY} an ON an.norm = {_NORM.format(c='a.target')})"""


@query("J6 J7 S2", f"SELECT entity_id, matched_name, matched_rank, confidence FROM {_MATCHED} m")
def ranking_matches(t):
    return M.match_ranking(t.fx_entity, t.fx_ranking, t.fx_alias).select("entity_id", "matched_name", "matched_rank", "confidence")


_OUTCOME = "CASE WHEN matched_rank IS NULL AND qs_ranking IS NULL THEN 'already_null' WHEN matched_rank IS NULL THEN 'fake_rank' WHEN CAST(qs_ranking AS VARCHAR) = matched_rank THEN 'already_correct' ELSE 'updated' END"


@query("A11", f"SELECT entity_id, qs_ranking, matched_rank AS new_rank, {_OUTCOME} AS outcome FROM {_MATCHED} m")
def reconciled_ranking(t):
    return M.reconcile_ranking(t.fx_entity, t.fx_ranking, t.fx_alias).select("entity_id", "qs_ranking", "new_rank", "outcome")


@query("A11", f"SELECT {_OUTCOME} AS outcome, COUNT(*) AS n FROM {_MATCHED} m GROUP BY 1")
def reconciled_ranking_summary(t):
    from campusloom.operators.reports import outcome_summary

    return outcome_summary(M.reconcile_ranking(t.fx_entity, t.fx_ranking, t.fx_alias))


_PLACE = "CASE entity_id % 4 WHEN 0 THEN '  ' || lower(country) || ' ' WHEN 1 THEN split_part(country, '_', 2) || ' republic' WHEN 2 THEN 'Atlantis' ELSE country END"


@query(
    "J8",
    f"""SELECT entity_id, coalesce((SELECT MIN(country_id) FROM fx_country c WHERE lower(c.name) = p), (SELECT MIN(country_id) FROM fx_country c WHERE p <> '' AND contains(lower(c.name), split_part(p, ' ', 1))), old_id) AS resolved_country_id,
  CASE WHEN (SELECT MIN(country_id) FROM fx_country c WHERE lower(c.name) = p) IS NOT NULL THEN 'equal' WHEN (SELECT MIN(country_id) FROM fx_country c WHERE p <> '' AND contains(lower(c.name), split_part(p, ' ', 1))) IS NOT NULL THEN 'contains' ELSE 'kept' END AS resolved_by
FROM (SELECT entity_id, country_id AS old_id, lower(trim({_PLACE})) AS p FROM fx_record) x""",
)
def resolved_countries(t):
    k = F.col("entity_id") % 4
    place = (
        F.when(k == 0, F.concat(F.lit("  "), F.lower("country"), F.lit(" ")))
        .when(k == 1, F.concat(F.split_part("country", F.lit("_"), F.lit(2)), F.lit(" republic")))
        .when(k == 2, "Atlantis").otherwise(F.col("country"))
    )
    r = t.fx_record.select("entity_id", "country_id", place.alias("country"))
    return M.resolve_country(r, t.fx_country).select("entity_id", "resolved_country_id", "resolved_by")


# Text search written out: tokens, weights, top five, level preference.
_TOK = "list_filter(regexp_split_to_array(lower({c}), '[^a-z0-9]+'), lambda x: x <> '')"
_IDX = "(SELECT course_id, tok, SUM(w) AS w FROM (SELECT DISTINCT course_id, unnest({a}) AS tok, 10.0 AS w FROM fx_course UNION ALL SELECT DISTINCT course_id, unnest({b}) AS tok, 6.0 AS w FROM fx_course) u GROUP BY 1, 2)".format(a=_TOK.format(c="title"), b=_TOK.format(c="field"))
_TOP = f"""(SELECT category, course_id, score, row_number() OVER (PARTITION BY category ORDER BY score DESC, course_id) AS rank FROM
 (SELECT q.category, i.course_id, SUM(i.w) AS score FROM (SELECT DISTINCT category, unnest({_TOK.format(c='category')}) AS tok FROM fx_program) q JOIN {_IDX} i ON q.tok = i.tok GROUP BY 1, 2) s)"""
_MAPPED = "CASE level WHEN 'Undergraduate' THEN 'Bachelor' WHEN 'Postgraduate' THEN 'Master' WHEN 'PhD' THEN 'PhD' ELSE 'Diploma' END"
_BEST = f"""(SELECT d.category, d.level, coalesce(min(CASE WHEN c.level = {_MAPPED.replace('level', 'd.level')} THEN k.rank END), min(k.rank)) AS r FROM (SELECT DISTINCT category, level FROM fx_program) d
 LEFT JOIN {_TOP} k ON k.category = d.category AND k.rank <= 5 LEFT JOIN fx_course c ON c.course_id = k.course_id GROUP BY 1, 2)"""
_PICK = f"(SELECT b.category, b.level, k.course_id, k.score FROM {_BEST} b LEFT JOIN {_TOP} k ON k.category = b.category AND k.rank = b.r)"


@query("J9 J16", f"SELECT category, level, course_id, round(score, 3) AS score FROM {_PICK} p")
def program_matches(t):
    return M.match_programs(t.fx_program, t.fx_course).select("category", "level", "course_id", F.round("score", 3).alias("score"))


@query("J9", f"SELECT category, level, course_id, round(score, 3) AS score FROM {_PICK} p")
def program_matches_hot_tokens(t):
    """The same result in many small blocks."""
    m = M.match_programs(t.fx_program, t.fx_course, first_block=8)
    return m.select("category", "level", "course_id", F.round("score", 3).alias("score"))


@query("J10", "SELECT entity_id, category, level FROM fx_program WHERE list_contains(string_split(lower(category), ' '), 'widget')")
def programs_of_one_course(t):
    return M.match_one_course(t.fx_program, "hot widget").select("entity_id", "category", "level")


@query("J11", f"SELECT entity_id, COUNT(DISTINCT course_id) AS n_courses, COUNT(*) FILTER (WHERE course_id IS NULL) AS n_unmatched FROM fx_program f JOIN {_PICK} p ON p.category = f.category AND p.level = f.level GROUP BY entity_id")
def matches_per_record(t):
    linked = M.link_programs(t.fx_program, M.match_programs(t.fx_program, t.fx_course))
    courses = M.matched_courses(linked).groupBy("entity_id").agg(F.count(F.lit(1)).alias("c"))
    misses = linked.groupBy("entity_id").agg(F.count_if(F.col("course_id").isNull()).alias("n_unmatched"))
    return misses.join(courses, "entity_id", "left").select("entity_id", F.coalesce("c", F.lit(0)).alias("n_courses"), "n_unmatched")


_PERF_CLASSED = f"(SELECT p.*, c.entity_type, c.slug FROM fx_perf p JOIN ({_CLASS}) c ON c.url = p.url AND c.run_no = p.run_no)"
_PRIO = f"(SELECT entity_type, slug, impressions, ctr, url, row_number() OVER (ORDER BY ctr ASC NULLS FIRST, impressions DESC, url) AS rank FROM {_PERF_CLASSED} x WHERE run_no = (SELECT MAX(run_no) FROM fx_perf) AND slug IS NOT NULL)"


@query("J12 J13 J3", f"""SELECT slug, meta_title FROM (SELECT p.rank, p.slug, e.meta_title FROM {_PRIO} p
 JOIN (SELECT 'c' || CAST(entity_id AS VARCHAR) AS slug, name, CASE WHEN entity_id % 2 = 0 THEN '' ELSE name || ' own' END AS meta_title FROM fx_entity) e ON e.slug = p.slug WHERE p.entity_type = 'university' AND e.meta_title = '') x ORDER BY rank LIMIT 10""")
def rewrite_candidates(t):
    perf = performance.with_page_class(t.fx_perf)
    top = ranking.ctr_priorities(perf, "run_no", "run_no", limit=None, entity_type="university")
    # The sort key itself is the position: numbering the whole list would take one task.
    prio = top.withColumn("rank", F.struct("ctr", F.col("impressions").isNull(), -F.col("impressions"), "url"))
    rows = t.fx_entity.select(
        F.concat(F.lit("c"), F.col("entity_id").cast("string")).alias("slug"), "name",
        F.when(F.col("entity_id") % 2 == 0, "").otherwise(F.concat("name", F.lit(" own"))).alias("meta_title"),
    )
    return performance.rewrite_candidates(prio, rows, "university", "name", BRAND, 10).select("slug", "meta_title")


_OV = """CAST(len(list_intersect(a.w, b.w)) AS DOUBLE) / greatest(len(a.w), len(b.w), 1)"""


@query("J15", """SELECT entity_id, query, CAST(score AS DOUBLE) AS score, rank FROM (SELECT entity_id, query, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, entity_id) AS rank FROM
 (SELECT e.entity_id, q.query, SUM(CASE WHEN list_contains(e.n, q.tok) THEN 10 ELSE 0 END + CASE WHEN list_contains(e.d, q.tok) THEN 2 ELSE 0 END) AS score
  FROM (SELECT DISTINCT 'customer ' || lpad(CAST(entity_id AS VARCHAR), 9, '0') AS query, unnest(['customer', lpad(CAST(entity_id AS VARCHAR), 9, '0')]) AS tok FROM fx_entity) q
  JOIN (SELECT entity_id, regexp_split_to_array(lower(name), '[^a-z0-9]+') AS n, regexp_split_to_array(lower(coalesce(description, '')), '[^a-z0-9]+') AS d FROM fx_entity) e ON list_contains(e.n, q.tok) OR list_contains(e.d, q.tok) GROUP BY 1, 2) s) x WHERE rank <= 3""")
def entity_search(t):
    e = t.fx_entity
    queries = e.select(F.lower("name").alias("query"))
    index = M.token_index(e, "entity_id", {"name": 10, "description": 2})
    # Every name asks for the word that all names share, so its first block is kept near k.
    return M.search(queries, "query", index, "entity_id", k=3, first_block=8).select("entity_id", "query", "score", "rank")


@query(
    "J17",
    """SELECT DISTINCT replace(c.title, ' ', '-') AS course_slug, k.slug AS country_slug, 'study-' || replace(c.title, ' ', '-') || '-in-' || k.slug AS combo_slug
FROM fx_program p JOIN fx_course c ON c.title = p.category JOIN fx_entity e ON e.entity_id = p.entity_id JOIN fx_country k ON k.country_id = e.country_id""",
)
def combo_slugs(t):
    pairs = (
        t.fx_program.join(t.fx_course.select("title").distinct(), F.col("category") == F.col("title"))
        .join(t.fx_entity.select("entity_id", "country_id"), "entity_id")
        .join(t.fx_country.select("country_id", F.col("slug").alias("country_slug")), "country_id")
        .select(F.replace("title", F.lit(" "), F.lit("-")).alias("course_slug"), "country_slug")
    )
    return M.combo_slugs(pairs)


# --- graph ----------------------------------------------------------------

_LINKS = f"(SELECT DISTINCT f.entity_id, p.course_id FROM fx_program f JOIN {_PICK} p ON p.category = f.category AND p.level = f.level WHERE p.course_id IS NOT NULL)"


def links(t):
    return M.matched_courses(M.link_programs(t.fx_program, M.match_programs(t.fx_program, t.fx_course)))


@query("A8 U5", f"SELECT DISTINCT e.country_id, l.course_id FROM {_LINKS} l JOIN fx_entity e ON e.entity_id = l.entity_id WHERE e.country_id IS NOT NULL")
def country_course_edges(t):
    return graph.build_edges(t.fx_entity, links(t))["country_course"]


@query(
    "A8 U5",
    f"""SELECT course_id, 0 AS part_no, string_agg(CAST(entity_id AS VARCHAR), ',' ORDER BY entity_id) AS members FROM (SELECT course_id, entity_id FROM {_LINKS} l UNION SELECT course_id, course_id * 7 AS entity_id FROM fx_course) x GROUP BY course_id""",
)
def course_reference_lists(t):
    old = graph.edges_of_lists(t.fx_course.select("course_id", F.array(F.col("course_id") * 7).alias("top")), "course_id", "top", "entity_id")
    edges = graph.add_edges(old, graph.build_edges(t.fx_entity, links(t))["entity_course"])
    lists = graph.edge_lists(edges, "course_id", "entity_id")
    return lists.select("course_id", "part_no", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"))


@query("A8", f"SELECT course_id, COUNT(*) AS n_members FROM {_LINKS} l GROUP BY course_id")
def course_list_parts(t):
    """Lists cut into parts of 20 hold every member exactly once."""
    lists = graph.edge_lists(links(t), "course_id", "entity_id", part_size=20)
    return lists.groupBy("course_id").agg(F.sum(F.size("members")).alias("n_members"))


# --- upserts and caches ---------------------------------------------------

@query("S9", """SELECT url, run_no, clicks FROM fx_perf WHERE run_no < 2 AND NOT (run_no = 1 AND clicks % 2 = 0) UNION ALL SELECT url, run_no, clicks + 1000 AS clicks FROM fx_perf WHERE (run_no = 1 AND clicks % 2 = 0) OR run_no = 2""")
def upserted_runs(t):
    p = t.fx_perf.select("url", "run_no", "clicks")
    new = p.filter("(run_no = 1 AND clicks % 2 = 0) OR run_no = 2").withColumn("clicks", F.col("clicks") + 1000)
    return S.upsert(p.filter("run_no < 2"), new, ["url", "run_no"])


@query("S9 A11", f"SELECT m.entity_id, e.name, m.q AS qs_ranking FROM (SELECT entity_id, CASE WHEN {_OUTCOME} IN ('updated', 'fake_rank') THEN matched_rank ELSE CAST(qs_ranking AS VARCHAR) END AS q FROM {_MATCHED} x) m JOIN fx_entity e ON e.entity_id = m.entity_id")
def patched_ranks(t):
    r = M.reconcile_ranking(t.fx_entity, t.fx_ranking, t.fx_alias)
    new = r.filter(F.col("outcome").isin("updated", "fake_rank")).select("entity_id", F.col("new_rank").alias("qs_ranking"))
    old = t.fx_entity.select("entity_id", "name", F.col("qs_ranking").cast("string").alias("qs_ranking"))
    return S.set_columns(old, new, ["entity_id"], ["qs_ranking"], insert=False)


@query("S5", f"SELECT p.url, 'run-2' AS run_label, c.entity_type, c.slug, p.url IN (SELECT url FROM fx_perf WHERE run_no < 2 AND meta_rewritten) AS meta_rewritten FROM fx_perf p JOIN ({_CLASS}) c ON c.url = p.url AND c.run_no = p.run_no WHERE p.run_no = 2")
def pulled_snapshot(t):
    p = t.fx_perf
    rows = p.filter("run_no = 2").select("url", "clicks", "impressions", "ctr")
    run = S.pull_snapshot(rows, p.filter("run_no < 2"), "run-2", F.lit("2024-01-30").cast("date"))
    return run.select("url", "run_label", "entity_type", "slug", "meta_rewritten")


_CACHE = "(SELECT url AS curl, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(page_id % 48 AS INTEGER)) AS cached_at, page_id * 10 AS size FROM pages WHERE page_id % 3 <> 0)"


@query("S11", f"SELECT p.page_id, coalesce(c.size, -1) AS size, c.curl IS NOT NULL AS from_cache FROM pages p LEFT JOIN {_CACHE} c ON c.curl = p.url AND c.cached_at + INTERVAL 24 HOUR > TIMESTAMP '2024-01-02 12:00:00'")
def cached_pages(t):
    key = hashing.url_key(F.col("url"))
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("page_id") % 48).cast("int"), F.lit(0), F.lit(0))
    cache = t.pages.filter("page_id % 3 <> 0").select(key.alias("k"), at.alias("cached_at"), (F.col("page_id") * 10).alias("size"))
    now = F.lit("2024-01-02 12:00:00").cast("timestamp_ntz")
    out = S.with_cache(t.pages.select("page_id", key.alias("k")), cache, "k", now, S.HOURS["page"], lambda m: m.withColumn("size", F.lit(-1).cast("long")), ["size"])
    return out.select("page_id", "size", "from_cache")


@query("S12", "SELECT doc_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 5 = 0)")
def new_contents(t):
    d = t.documents.select(F.lit("site").alias("entity"), "doc_id", "text")
    memo = d.filter("doc_id % 5 = 0").select("entity", hashing.extraction_key(F.col("text")).alias("content_hash")).distinct()
    return S.new_extractions(d, memo, "entity", "text").select("doc_id")


@query("S10", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 4000 ORDER BY o_orderkey LIMIT 5000")
def next_key_batch(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    return S.key_range(o, "o_orderkey", 4000, S.batch_end(o, "o_orderkey", 4000, 5000))


@query("V22", f"""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE CASE WHEN doc_id % 3 = 0 THEN 4 ELSE 2 END END AS meta_score, doc_id % 4 <> 0 AND doc_id % 3 = 0 AS publish FROM documents""")
def gated_meta(t):
    d = F.col("doc_id").cast("string")
    body = F.concat(
        F.lit('```json\n{"title": "'), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Doc "), d)).otherwise(F.lit("Item 7")), F.lit(' | Good", "description": '),
        F.when(F.col("doc_id") % 4 == 0, "7").otherwise(F.concat(F.lit('"All there is to know on '), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Doc "), d)).otherwise(F.lit("it")), F.lit('"'))), F.lit("}\n```"),
    )
    r = t.documents.select("doc_id", F.concat(F.lit("Doc "), d).alias("name"), body.alias("raw"))
    return performance.gate_meta(r, F.col("name"), BRAND).select("doc_id", "meta_score", "publish")
