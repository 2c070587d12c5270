"""Coverage, progress, demand, merging by trust, top lists, rates, slugs."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusloom.functions import text as X, urls as U
from campusloom.operators import matching as M, predicates as P, ranking, records as R, reports as A
from campusloom.plans import backfill, performance
from campusloom.session import durable, spread
from registry.base import query
from registry.matching import _LINKS, _PICK, _PRIO, links
from registry.records import _REC
from registry.scalars import _IMG
from registry.sections import RANKED_SQL


@query(
    "A1 V23",
    """SELECT measure, n, total, CASE WHEN total > 0 THEN round(n * 100.0 / total, 1) ELSE 0 END AS pct FROM (
SELECT CAST(COUNT(*) AS BIGINT) AS total, unnest(['enriched', 'completed', 'partial', 'failed', 'pending']) AS measure, unnest([COUNT(*) FILTER (WHERE is_enriched), COUNT(*) FILTER (WHERE status = 'completed'),
 COUNT(*) FILTER (WHERE status = 'partial'), COUNT(*) FILTER (WHERE status = 'failed'), COUNT(*) FILTER (WHERE status = 'pending')]) AS n FROM fx_entity) x""",
)
def status_coverage(t):
    return A.status_coverage(t.fx_entity)


_MISS = {
    "description": "coalesce(description, '') = ''", "country": "country_id IS NULL", "tuition_fee": "coalesce(tuition_fee, '') = ''",
    "acceptance_rate": "acceptance_rate IS NULL", "intakes": "ni = 0", "programs": "np < 3", "similar": "ns = 0",
}


def _spec():
    return P.gaps(
        {
            "description": ("blank", "description"), "country": ("null", "country_id"), "tuition_fee": ("blank", "tuition_fee"),
            "acceptance_rate": ("null", "acceptance_rate"), "intakes": ("empty_list", "intakes"),
            "programs": ("short_list", "programs"), "similar": ("empty_or_null_list", "similar_universities"),
        }
    )


@query(
    "A2 P2",
    "SELECT field, missing, total, round((total - missing) * 100.0 / total, 1) AS filled_pct, '[' || repeat('█', CAST(round((total - missing) / CAST(total AS DOUBLE) * 20) AS INTEGER)) || repeat('░', 20 - CAST(round((total - missing) / CAST(total AS DOUBLE) * 20) AS INTEGER)) || ']' AS bar FROM (SELECT COUNT(*) AS total, unnest(["
    + ", ".join(f"'{k}'" for k in _MISS) + "]) AS field, unnest([" + ", ".join(f"COUNT(*) FILTER (WHERE {c})" for c in _MISS.values()) + f"]) AS missing FROM {_REC}) x",
)
def field_coverage(t):
    return A.field_coverage(t.record(), _spec())


_GAPS = {"tuition_fee": "coalesce(tuition_fee, '') = ''", "total_students": "coalesce(total_students, '') = ''", "similar_universities": "ns = 0", "programs": "np < 3", "intakes": "ni = 0", "admission_requirements": "nq < 3"}
_GAPS["any"] = "(" + ") OR (".join(_GAPS.values()) + ")"


@query("A3", "SELECT unnest([" + ", ".join(f"'{k}'" for k in _GAPS) + "]) AS field, unnest([" + ", ".join(f"COUNT(*) FILTER (WHERE {c})" for c in _GAPS.values()) + f"]) AS missing FROM {_REC}")
def gap_analysis(t):
    return A.gap_analysis(t.record(), P.gaps(P.PATCHABLE))


_PROG = """COUNT(*) FILTER (WHERE website <> '') AS total, COUNT(*) FILTER (WHERE status = 'completed') AS completed, COUNT(*) FILTER (WHERE status = 'partial') AS partial, COUNT(*) FILTER (WHERE status = 'failed') AS failed,
 COUNT(*) FILTER (WHERE NOT is_enriched AND status = 'pending') AS pending, COUNT(*) FILTER (WHERE status = 'processing') AS processing, COUNT(*) FILTER (WHERE confidence_score >= 0.8) AS high_confidence, COUNT(*) FILTER (WHERE confidence_score > 0 AND confidence_score < 0.8) AS low_confidence"""


@query("A4", f"SELECT *, completed + partial AS done, CASE WHEN total > 0 THEN round((completed + partial) * 100.0 / total, 1) ELSE 0 END AS done_pct FROM (SELECT {_PROG} FROM fx_entity) x")
def enrichment_progress(t):
    return A.progress(t.fx_entity)


@query("A4", f"SELECT *, completed + partial AS done, CASE WHEN total > 0 THEN round((completed + partial) * 100.0 / total, 1) ELSE 0 END AS done_pct FROM (SELECT country_id, {_PROG} FROM fx_entity GROUP BY country_id) x")
def progress_by_country(t):
    return A.progress(t.fx_entity, ["country_id"])


_ELIGIBLE = "(status = 'completed' OR is_enriched OR length(coalesce(description, '')) >= 300) AND country_id IS NOT NULL"
_LINKED = f"(SELECT f.entity_id, f.category, f.level, p.course_id FROM fx_program f JOIN fx_entity e ON e.entity_id = f.entity_id JOIN {_PICK} p ON p.category = f.category AND p.level = f.level WHERE {_ELIGIBLE.replace('country_id', 'e.country_id')})"


def _scope(t):
    return t.fx_entity.filter(P.is_eligible(F.col("status"), F.col("is_enriched"), F.col("description"), F.col("country_id")))


@query(
    "A5 J11",
    f"""SELECT c.category, c.count, c.entity_count, c.sample_label, l.levels, s.samples FROM
 (SELECT lower(category) AS category, COUNT(*) AS count, COUNT(DISTINCT entity_id) AS entity_count, MIN(category) AS sample_label FROM {_LINKED} u WHERE course_id IS NULL GROUP BY 1) c
 JOIN (SELECT category, string_agg(level || '=' || CAST(n AS VARCHAR), ',' ORDER BY level) AS levels FROM (SELECT lower(category) AS category, level, COUNT(*) AS n FROM {_LINKED} u WHERE course_id IS NULL GROUP BY 1, 2) y GROUP BY 1) l ON l.category = c.category
 JOIN (SELECT category, string_agg(name, ',' ORDER BY entity_id) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY entity_id) AS k FROM (SELECT DISTINCT lower(u.category) AS category, e.entity_id, e.name FROM {_LINKED} u JOIN fx_entity e ON e.entity_id = u.entity_id WHERE course_id IS NULL) z) w WHERE k <= 8 GROUP BY 1) s ON s.category = c.category""",
)
def unmatched_demand(t):
    r = backfill.unmatched_report(_scope(t), t.fx_program, t.fx_course)["ranking"]
    levels = F.array_join(F.array_sort(F.transform(F.map_entries("levels"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))), ",")
    return r.select("category", "count", "entity_count", "sample_label", levels.alias("levels"), F.array_join("sample_entities", ",").alias("samples"))


@query(
    "A6",
    f"""SELECT (SELECT COUNT(*) FROM fx_entity WHERE {_ELIGIBLE}) AS entities_scanned, COUNT(*) AS programs_scanned, COUNT(course_id) AS programs_matched, COUNT(*) - COUNT(course_id) AS programs_unmatched,
 COUNT(DISTINCT CASE WHEN course_id IS NOT NULL THEN CAST(entity_id AS VARCHAR) || '-' || CAST(course_id AS VARCHAR) END) AS course_links, COUNT(DISTINCT CASE WHEN course_id IS NULL THEN lower(category) END) AS unmatched_categories FROM {_LINKED} u""",
)
def matching_counters(t):
    return backfill.unmatched_report(_scope(t), t.fx_program, t.fx_course)["counters"]


@query(
    "A7 E2",
    f"""SELECT (SELECT COUNT(*) FROM fx_entity) AS processed, (SELECT COUNT(*) FROM fx_entity WHERE country_id IS NULL AND entity_id NOT IN (SELECT entity_id FROM fx_program)) AS skipped, (SELECT COUNT(*) FROM {_LINKS} l) AS course_links,
 (SELECT COUNT(*) FROM fx_program f JOIN {_PICK} p ON p.category = f.category AND p.level = f.level WHERE p.course_id IS NULL) AS programs_unmatched""",
)
def backfill_counters(t):
    return backfill.backfill(t.fx_entity, t.fx_program, t.fx_course, {})["counters"]


@query(
    "A9 V28",
    """SELECT entity_id, arg_max(country, confidence) FILTER (WHERE country IS NOT NULL) AS country, arg_max(city, confidence) FILTER (WHERE city IS NOT NULL) AS city, arg_max(acceptance_rate, confidence) FILTER (WHERE acceptance_rate IS NOT NULL) AS acceptance_rate,
 string_agg(source, ',' ORDER BY confidence DESC) AS sources FROM fx_source GROUP BY entity_id""",
)
def merged_sources(t):
    m = R.merge_by_confidence(t.fx_source, "entity_id", ["country", "city", "acceptance_rate"])
    return m.select("entity_id", "country", "city", "acceptance_rate", F.array_join(F.transform("sources", lambda s: s["source"]), ",").alias("sources"))


@query(
    "A9",
    """SELECT entity_id, string_agg(item, ',' ORDER BY src_no, pos) AS intakes FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, item ORDER BY src_no, pos) AS k FROM
 (SELECT entity_id, src_no, country AS item, 0 AS pos FROM fx_source WHERE country IS NOT NULL UNION ALL SELECT entity_id, src_no, city AS item, 1 AS pos FROM fx_source WHERE city IS NOT NULL) u) x WHERE k = 1 GROUP BY entity_id""",
)
def merged_source_lists(t):
    s = t.fx_source.withColumn("intakes", F.array("country", "city"))
    m = R.merge_by_confidence(s, "entity_id", ["country"], ["intakes"])
    return m.filter(F.size("intakes") > 0).select("entity_id", F.array_join("intakes", ",").alias("intakes"))


@query(
    "A10",
    """SELECT conv_id, arg_max(text, length(text) * 1000000 - turn) FILTER (WHERE length(text) > 60) AS description, arg_min(role, turn) AS role, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM conversations GROUP BY conv_id""",
)
def merged_partial_results(t):
    c = t.conversations.withColumn("roles", F.array("role"))
    m = R.merge_partial_results(c, "conv_id", "turn", ["role"], ["roles"], "text")
    return m.select("conv_id", F.col("text").alias("description"), "role", F.array_join(F.array_sort("roles"), ",").alias("roles"))


@query(
    "A12",
    """SELECT event_type, least(CAST((day(ts) - 1) // 10 AS INT), 2) AS span, COUNT(DISTINCT user_id) AS n_distinct, true AS within_error FROM events GROUP BY ALL
UNION ALL SELECT event_type, -1, COUNT(DISTINCT user_id), true FROM events GROUP BY ALL""",
)
def distinct_users_by_span(t):
    """Users of each kind of event over ten-day spans and over all days (-1): exact, and whether merged daily sketches agree within four standard errors."""
    days = t.events.select("event_type", "user_id", F.dayofmonth("ts").alias("day"), F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)).cast("int").alias("span"))
    sketches = durable(A.distinct_sketches(days, "day", ["event_type", "span"], "user_id"))
    estimated = A.distinct_estimates(sketches, ["event_type", "span"]).unionByName(A.distinct_estimates(sketches.withColumn("span", F.lit(-1)), ["event_type", "span"]))
    exact = days.unionByName(days.withColumn("span", F.lit(-1))).groupBy("event_type", "span").agg(F.countDistinct("user_id").alias("n_distinct"))
    within = F.abs(F.col("n_estimated") - F.col("n_distinct")) <= F.greatest(F.lit(1), 4 * A.sketch_error() * F.col("n_distinct"))
    return exact.join(estimated, ["event_type", "span"]).select("event_type", "span", "n_distinct", within.alias("within_error"))


@query("A12", "SELECT lang, source, COUNT(DISTINCT md5(text)) AS n_distinct FROM documents GROUP BY 1, 2")
def distinct_texts(t):
    return A.distinct_summary(t.documents.withColumn("h", F.md5("text")), "h", ["lang", "source"])


@query("A13", r"SELECT regexp_replace(regexp_extract(url, '://([^/?#]+)', 1), '^www\.', '') AS site, COUNT(*) AS pages, CAST(SUM(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1")
def crawl_totals(t):
    return A.crawl_totals(t.pages, U.bare_host(F.col("url")), F.col("html"))


@query("A13", f"SELECT CAST(entity_id % 7 AS BIGINT) AS site, image_type, COUNT(*) AS candidates FROM (SELECT entity_id, {_IMG} AS image_type FROM (SELECT entity_id, lower(url) AS l FROM fx_image) x) y WHERE image_type IS NOT NULL GROUP BY 1, 2")
def image_totals(t):
    return A.image_totals(t.fx_image, F.col("entity_id") % 7, U.image_type(F.col("url")))


# --- top lists ------------------------------------------------------------

@query("W3 W4 V7", f"SELECT entity_type, slug, impressions, ctr, url FROM {_PRIO} p WHERE rank <= 50")
def ctr_priorities(t):
    return ranking.ctr_priorities(performance.with_page_class(t.fx_perf), "run_no", "run_no", 50)


@query("W4", "SELECT url, clicks FROM fx_perf WHERE run_no = (SELECT MAX(run_no) FROM fx_perf)")
def newest_run(t):
    return ranking.latest_run(t.fx_perf, "run_no", "run_no").select("url", "clicks")


@query("W1", "SELECT user_id, event_id, rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events) x WHERE rank <= 12")
def top_per_site(t):
    return ranking.top_per_group(t.events, ["user_id"], [F.desc("value"), "event_id"], 12).select("user_id", "event_id", "rank")


@query("W2", r"SELECT k, page_id FROM (SELECT regexp_replace(lower(regexp_replace(url, '[?#].*$', '')), '/$', '') AS k, page_id, row_number() OVER (PARTITION BY regexp_replace(lower(regexp_replace(url, '[?#].*$', '')), '/$', '') ORDER BY length(html) DESC, page_id) AS n FROM pages) x WHERE n = 1")
def best_page_per_key(t):
    p = t.pages.select("page_id", U.path_key(F.col("url")).alias("k"), F.length("html").alias("n"))
    return ranking.best_per_key(p, ["k"], [F.desc("n"), "page_id"]).select("k", "page_id")


_LEN = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 3000 END"


@query(
    "W6",
    f"""SELECT o_custkey, o_orderkey FROM (SELECT *, coalesce(SUM(len) OVER w, 0) AS chars, COUNT(len) OVER w AS n FROM (SELECT o_custkey, o_orderkey, {_LEN} AS len FROM orders) x
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) y WHERE NOT (chars >= 4000 AND n >= 3)""",
)
def adaptive_reading(t):
    chars = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 3000)
    o = t.orders.select("o_custkey", "o_orderkey", chars.alias("len"))
    return ranking.adaptive_pages(o, "o_custkey", "o_orderkey", F.col("len")).select("o_custkey", "o_orderkey")


@query(
    "W7",
    """SELECT ts, sample_no, CASE WHEN ms > 0 AND done > od THEN round((done - od) / ms * 3600000) ELSE 0 END AS rate_per_hour, CASE WHEN ms > 0 AND done > od AND round((done - od) / ms * 3600000) > 0 THEN round(pending / round((done - od) / ms * 3600000), 1) END AS eta_hours
FROM (SELECT ts, done, pending, row_number() OVER (ORDER BY ts) AS sample_no, first_value(done) OVER w AS od, CAST(epoch_us(ts) - epoch_us(first_value(ts) OVER w) AS DOUBLE) / 1000 AS ms
 FROM (SELECT ts, event_id * 3 + event_id % 5 AS done, 50000 - event_id AS pending FROM events) s WINDOW w AS (ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) x""",
)
def processing_rate(t):
    s = t.events.select("ts", (F.col("event_id") * 3 + F.col("event_id") % 5).alias("done"), (50000 - F.col("event_id")).alias("pending"))
    return A.rate_and_eta(s).select("ts", "sample_no", "rate_per_hour", "eta_hours")


_SEC = ["admiss|apply|application", "tuition|fee|fees|cost|scholarship"]


@query(
    "W9",
    r"""SELECT conv_id, string_agg('[PAGE ' || CAST(n AS VARCHAR) || ']' || chr(10) || t, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY n) AS content FROM
 (SELECT conv_id, t, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN regexp_matches(t, '(?i)admiss|tuition|fee|program|course') THEN 0 ELSE 1 END, turn) AS n FROM
  (SELECT conv_id, turn, t, row_number() OVER (PARTITION BY conv_id, t ORDER BY turn) AS k FROM (SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations) a WHERE length(t) > 80) b WHERE k = 1) c GROUP BY conv_id""",
)
def assembled_content(t):
    return ranking.assemble_content(t.conversations, "conv_id", "turn", "text")


@query(
    "W9",
    r"""SELECT conv_id, n AS page_no, CAST(SUM(length(piece) + 7) OVER (PARTITION BY conv_id ORDER BY n) - length(piece) - 7 AS BIGINT) AS start, piece FROM
(SELECT conv_id, n, '[PAGE ' || CAST(n AS VARCHAR) || ']' || chr(10) || t AS piece FROM
 (SELECT conv_id, t, row_number() OVER (PARTITION BY conv_id ORDER BY CASE WHEN regexp_matches(t, '(?i)admiss|tuition|fee|program|course') THEN 0 ELSE 1 END, turn) AS n FROM
  (SELECT conv_id, turn, t, row_number() OVER (PARTITION BY conv_id, t ORDER BY turn) AS k FROM (SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS t FROM conversations) a WHERE length(t) > 80) b WHERE k = 1) c) d""",
)
def content_pieces(t):
    return ranking.content_pieces(t.conversations, "conv_id", "turn", "text")


@query(
    "W10",
    r"""SELECT doc_id, k AS chunk_no, chunk FROM (SELECT doc_id, chunk, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM
 (SELECT doc_id, i, substr(text, CAST(i * 16000 + 1 AS INTEGER), 16000) AS chunk FROM (SELECT doc_id, text, unnest(range(0, (length(text) - 1) // 16000 + 1)) AS i FROM documents WHERE length(text) > 0) a) b WHERE length(regexp_replace(chunk, '^\s+|\s+$', '', 'g')) > 100) c""",
)
def content_chunks(t):
    c = t.documents.select("doc_id", F.explode(ranking.chunks(F.col("text"))).alias("c"))
    return c.select("doc_id", F.col("c.chunk_no").cast("long").alias("chunk_no"), F.col("c.chunk").alias("chunk"))


@query(
    "W11 P12 P13 V25",
    f"""SELECT entity_id, image_type, arg_min(url, k) AS url FROM (SELECT entity_id, url, image_type, content_type, content_length, row_number() OVER (PARTITION BY entity_id, image_type ORDER BY pos, url) AS k FROM
 (SELECT *, {_IMG} AS image_type FROM (SELECT *, lower(url) AS l FROM fx_image) a WHERE regexp_matches(l, '\\.(jpg|jpeg|png|webp|gif|svg)') OR contains(l, 'image')) b WHERE image_type IS NOT NULL) c
WHERE k <= CASE WHEN image_type = 'logo' THEN 5 ELSE 8 END AND CASE WHEN ends_with(lower(url), '.svg') THEN image_type = 'logo' ELSE starts_with(content_type, 'image/') AND (coalesce(content_length, 0) = 0 OR content_length >= 5000) END GROUP BY 1, 2""",
)
def picked_images(t):
    c = t.fx_image.filter(U.is_image_link(F.col("url"))).withColumn("image_type", U.image_type(F.col("url"))).filter("image_type IS NOT NULL")
    ok = U.image_response_ok(F.col("url"), F.col("content_type"), F.col("content_length"), F.col("image_type"))
    return ranking.pick_images(c, ok)


@query("W12", "SELECT event_id, ts FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 20")
def last_errors(t):
    return ranking.last_errors(t.events.filter("event_type = 'error'").select("event_id", "ts"), "ts", "event_id")


@query(
    "W13 V1",
    r"""SELECT id, CASE WHEN s = 0 THEN base ELSE base || '-' || CAST(s AS VARCHAR) END AS slug FROM (SELECT w.id, w.base, w.k + COUNT(g.base) AS s FROM
 (SELECT p_partkey AS id, replace(p_name, ' ', '-') AS base, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS k FROM part) w LEFT JOIN
 (SELECT base, t - (row_number() OVER (PARTITION BY base ORDER BY t) - 1) AS at FROM (SELECT DISTINCT replace(p_name, ' ', '-') AS base, unnest([0, 3, 5]) AS t FROM part WHERE p_partkey % 5 = 0) a) g ON g.base = w.base AND g.at <= w.k GROUP BY w.id, w.base, w.k) x""",
)
def unique_slugs(t):
    base = F.replace("p_name", F.lit(" "), F.lit("-"))
    taken = t.part.filter("p_partkey % 5 = 0").select(base.alias("b")).distinct().select(
        F.explode(F.array(F.col("b"), F.concat("b", F.lit("-3")), F.concat("b", F.lit("-5")))).alias("slug")
    )
    new = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("at"))
    return ranking.assign_slugs(new, taken, "id", "name", "at", F.floor(F.col("at") / 500))


@query(
    "W14 U1",
    """SELECT site, url, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, url) AS rank FROM (SELECT DISTINCT page_id % 20 AS site, link AS url, """
    + "CASE " + " ".join(f"WHEN regexp_matches(lower(link), '{p}') THEN {w}" for p, w in __import__("campusloom.rules", fromlist=["x"]).CRAWL_SCORES)
    + """ ELSE 10 END AS score FROM fx_link) x WHERE score > 0) y WHERE rank <= 8""",
)
def pages_by_priority(t):
    return ranking.prioritize_pages(t.fx_link.select((F.col("page_id") % 20).alias("site"), F.col("link").alias("url")), "site")


@query("U1", "SELECT url FROM (SELECT url FROM pages WHERE page_id % 2 = 0 UNION SELECT url FROM pages WHERE page_id % 3 = 0) x")
def united_pages(t):
    from campusloom.operators.pages import union_pages

    p = t.pages.select("page_id", "url")
    return union_pages(p.filter("page_id % 2 = 0").select("url"), p.filter("page_id % 3 = 0").select("url"))


@query(
    "W8 J14 U4",
    RANKED_SQL,
)
def ranked_sections(t):
    """Paragraphs of a text as sections, all of them with all their words."""
    marked = F.regexp_replace("text", "\n", "[PAGE 1]")
    d = spread(t.documents.select("doc_id", "text"))
    return d.select("doc_id", ranking.preprocess_content(marked, words=None, keep=None).alias("content"))


@query(
    "W8",
    "SELECT doc_id, " + " + ".join(f"CASE WHEN regexp_matches(text, '(?i){p}') THEN {w} ELSE 0 END" for p, w in __import__("campusloom.rules", fromlist=["x"]).SECTION_SCORES) + " AS score FROM documents",
)
def section_scores(t):
    return spread(t.documents.select("doc_id", "text")).select("doc_id", ranking.section_score(F.col("text")).alias("score"))


@query("T8", "SELECT url, run_no, round(ctr, 6) AS ctr, round(lag(ctr) OVER (PARTITION BY url ORDER BY run_no), 6) AS previous_ctr, round(ctr - lag(ctr) OVER (PARTITION BY url ORDER BY run_no), 6) AS ctr_change FROM fx_perf")
def run_series(t):
    from campusloom.operators.joins import run_series as series

    s = series(t.fx_perf, "run_no")
    return s.select("url", "run_no", *[F.round(c, 6).alias(c) for c in ("ctr", "previous_ctr", "ctr_change")])
