"""Filters, record repair, merging, gap filling and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusloom import rules
from campusloom.functions import basics as B, seo
from campusloom.operators import joins, predicates as P, quality as Q, ranking, records as R
from campusloom.plans import enrich
from campusloom.session import spread
from registry.base import query
from registry.matching import _LINKS
from registry.scalars import BRAND

NOW = "2024-02-01 00:00:00"

_STATE = """(SELECT e.*, CASE WHEN entity_id % 8 = 0 THEN NULL ELSE TIMESTAMP '2024-01-31 00:00:00' + to_minutes(CAST(entity_id % 1440 AS INTEGER)) END AS last_enriched_at,
  CASE WHEN entity_id % 9 = 0 THEN 'Domain dead' WHEN entity_id % 9 = 1 THEN 'timeout' END AS failed_reason, entity_id AS created_at FROM fx_entity e) s"""


def with_state(t):
    """Records with the time of the last attempt and its reason."""
    minutes = (F.col("entity_id") % 1440).cast("int")
    at = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))
    reason = F.when(F.col("entity_id") % 9 == 0, "Domain dead").when(F.col("entity_id") % 9 == 1, "timeout")
    return (
        t.fx_entity.withColumn("last_enriched_at", F.when(F.col("entity_id") % 8 != 0, at))
        .withColumn("failed_reason", reason).withColumn("created_at", F.col("entity_id"))
    )


def now():
    return F.lit(NOW).cast("timestamp_ntz")


_N = "(CASE WHEN {c} = '' THEN 0 ELSE length({c}) - length(replace({c}, ';', '')) + 1 END)"
_REC = """(SELECT r.*, coalesce(p.n_programs, 0) AS np, {i} AS ni, {q} AS nq, {s} AS ns FROM fx_record r LEFT JOIN fx_program_count p ON r.entity_id = p.entity_id) r""".format(
    i=_N.format(c="r.intakes_text"), q=_N.format(c="r.requirements_text"), s=_N.format(c="r.similar_text")
)


# --- scans and filters ----------------------------------------------------

@query("S1", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000 AND o_orderstatus = 'F'")
def filtered_scan(t):
    from campusloom.sources.readers import scan

    where = (F.col("o_totalprice") > 1000) & (F.col("o_orderstatus") == "F")
    return scan(t.spark, f"{t.dir}/orders.parquet", ["o_orderkey", "o_totalprice"], where)


@query("P1", "SELECT entity_id, name FROM fx_entity WHERE (status = 'completed' OR is_enriched OR length(coalesce(description, '')) >= 300) AND country_id IS NOT NULL")
def eligible_records(t):
    e = t.fx_entity
    return e.filter(P.is_eligible(e.status, e.is_enriched, e.description, e.country_id)).select("entity_id", "name")


@query("P2", f"SELECT entity_id, coalesce(tuition_fee, '') = '' AS fee, qs_ranking IS NULL AS rank, ni = 0 AS intakes, np < 3 AS programs, nq < 3 AS requirements, ns = 0 AS similar FROM {_REC}")
def missing_fields(t):
    r = t.record()
    return r.select(
        "entity_id", P.gap("blank", r.tuition_fee).alias("fee"), P.gap("null", r.qs_ranking).alias("rank"),
        P.gap("empty_list", r.intakes).alias("intakes"), P.gap("short_list", r.programs).alias("programs"),
        P.gap("short_list", r.admission_requirements).alias("requirements"),
        P.gap("empty_or_null_list", r.similar_universities).alias("similar"),
    )


@query("P3", "SELECT country_id, name FROM fx_country WHERE country_id % 4 = 0 OR country_id % 3 = 0 OR country_id % 5 = 0")
def incomplete_countries(t):
    some = lambda k: F.when(F.col("country_id") % k == 0, F.array().cast("array<string>")).when(F.col("country_id") % k == 1, F.lit(None)).otherwise(F.array(F.lit("x")))
    c = t.fx_country.select(
        "country_id", "name", some(4).alias("career_opportunities"), some(3).alias("scholarships"),
        some(5).alias("eligibility_requirements"), F.array(F.lit("card")).alias("why_study_cards"),
    )
    return c.filter(P.incomplete_country()).select("country_id", "name")


@query(
    "P3 P4",
    """SELECT course_id FROM (SELECT c.course_id, COUNT(DISTINCT p.entity_id) AS n FROM fx_course c JOIN fx_program p ON p.category = c.title GROUP BY c.course_id) x
WHERE n >= 3 AND (course_id % 2 = 0 OR course_id % 3 = 0)""",
)
def courses_in_demand(t):
    demand = t.fx_program.groupBy("category").agg(F.count_distinct("entity_id").alias("n_universities"))
    links = t.fx_course.join(demand, F.col("category") == F.col("title"))
    text, items = F.lit("x"), F.array(F.lit("x"))
    c = links.select(
        "course_id", "n_universities", F.when(F.col("course_id") % 2 == 0, "").otherwise("s").alias("subtitle"),
        *[text.alias(n) for n in P.COURSE_TEXTS if n != "subtitle"],
        F.when(F.col("course_id") % 3 == 0, F.array().cast("array<string>")).otherwise(items).alias("faqs"),
        *[items.alias(n) for n in P.COURSE_LISTS if n != "faqs"],
    )
    return c.filter(P.worth_enriching_course(F.col("n_universities"))).select("course_id")


@query("P5", "SELECT entity_id FROM fx_entity WHERE (status = 'completed' OR is_enriched OR length(coalesce(description, '')) >= 300) AND country_id = 7")
def records_of_country(t):
    e = t.fx_entity
    ok = P.is_eligible(F.col("status"), F.col("is_enriched"), F.col("description"), F.col("country_id"))
    return P.scope(e, ok, "country", "Nation-7", countries=t.fx_country).select("entity_id")


@query(
    "P5",
    """SELECT entity_id FROM fx_entity WHERE (status = 'completed' OR is_enriched OR length(coalesce(description, '')) >= 300) AND country_id IS NOT NULL
AND entity_id IN (SELECT entity_id FROM fx_program WHERE contains(lower(category), 'hot'))""",
)
def records_mentioning_course(t):
    courses = t.fx_course.filter(F.col("title").startswith("hot")).withColumn("slug", F.replace("title", F.lit(" "), F.lit("-")))
    r = t.record()
    ok = P.is_eligible(F.col("status"), F.col("is_enriched"), F.col("description"), F.col("country_id"))
    slug = courses.orderBy("course_id").first().slug
    return P.scope(r, ok, "course", slug, courses=courses).select("entity_id")


@query("P5", "SELECT entity_id, status FROM fx_entity WHERE slug = 'customer-000000005'")
def single_record(t):
    return P.scope(t.fx_entity, F.lit(False), "university", "CUSTOMER-000000005").select("entity_id", "status")


_UNPROCESSED = "NOT is_enriched AND website <> '' AND status = 'pending' AND (crawl_attempts IS NULL OR crawl_attempts < 99)"
_FAILED = f"status = 'failed' AND last_enriched_at < TIMESTAMP '{NOW}' - INTERVAL 4 HOUR AND website <> '' AND (crawl_attempts IS NULL OR crawl_attempts < 4) AND NOT coalesce(regexp_matches(failed_reason, '(?i)Domain dead|ENOTFOUND'), false)"
_PARTIAL = f"status = 'partial' AND confidence_score < 0.7 AND last_enriched_at < TIMESTAMP '{NOW}' - INTERVAL 12 HOUR AND website <> '' AND (crawl_attempts IS NULL OR crawl_attempts < 5)"


@query("P6", f"SELECT entity_id, coalesce({_UNPROCESSED}, false) AS fresh, coalesce({_FAILED}, false) AS failed, coalesce({_PARTIAL}, false) AS partial FROM {_STATE}")
def retry_rules(t):
    return with_state(t).select(
        "entity_id", P.is_unprocessed().alias("fresh"), P.is_failed_retry(now()).alias("failed"), P.is_partial_retry(now()).alias("partial")
    )


@query("P7", f"SELECT entity_id FROM {_REC} WHERE website <> '' AND crawl_attempts < 4 AND (status = 'partial' OR (is_enriched AND (coalesce(tuition_fee, '') = '' OR coalesce(total_students, '') = '' OR np < 3)))")
def reenrichment_candidates(t):
    return t.record().filter(P.needs_reenrichment()).select("entity_id")


@query("P8", f"SELECT entity_id FROM (SELECT entity_id, name, CASE entity_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN name || ' – Admission, Fees & Courses | {BRAND}' ELSE 'Own title' END AS mt FROM fx_entity) x WHERE entity_id % 4 < 3")
def generic_titles(t):
    k = F.col("entity_id") % 4
    e = t.fx_entity.withColumn(
        "mt", F.when(k == 1, "  ").when(k == 2, F.concat("name", F.lit(f" – Admission, Fees & Courses | {BRAND}"))).when(k == 3, "Own title")
    )
    return e.filter(seo.needs_title("university", F.col("mt"), F.col("name"), BRAND)).select("entity_id")


@query("W5 U2", f"""SELECT entity_id, tier FROM (SELECT *, CASE WHEN {_UNPROCESSED} THEN 1 WHEN {_FAILED} THEN 2 WHEN {_PARTIAL} THEN 3 END AS tier FROM {_STATE}) x WHERE tier IS NOT NULL
ORDER BY tier, CASE WHEN tier = 1 THEN CASE WHEN featured THEN 0 ELSE 1 END WHEN tier = 2 THEN coalesce(crawl_attempts, -1) ELSE 0 END, CASE WHEN tier = 1 THEN created_at ELSE 0 END, entity_id LIMIT 200""")
def next_work(t):
    return ranking.select_work(with_state(t), now(), 200).select("entity_id", "tier")


@query("T4", f"SELECT entity_id, CASE WHEN status = 'processing' AND (last_enriched_at IS NULL OR last_enriched_at < TIMESTAMP '{NOW}' - INTERVAL 20 MINUTE) THEN 'pending' ELSE status END AS status FROM {_STATE}")
def stuck_work_reset(t):
    return P.reset_stuck(with_state(t), now()).select("entity_id", "status")


# --- record repair --------------------------------------------------------

@query(
    "R1",
    """SELECT id, CASE WHEN id % 2 = 0 AND id % 1600 BETWEEN 1 AND 1500 THEN CAST(id % 1600 AS DOUBLE) WHEN id % 2 = 1 AND id % 2000 BETWEEN 1 AND 1500 THEN CAST(id % 2000 AS DOUBLE) END AS qs_ranking,
  CASE id % 4 WHEN 0 THEN 50.0 WHEN 1 THEN NULL WHEN 2 THEN 12.5 END AS acceptance_rate,
  CASE WHEN id % 3 = 0 THEN 'Town ' || CAST(id AS VARCHAR) END AS city, CASE WHEN id % 5 = 0 THEN 'United Kingdom' ELSE 'Germany' END AS country,
  'Fall|Spring' AS intakes, CASE WHEN id % 2 = 0 THEN 'Law:PhD|Art:Diploma' ELSE 'Law:PhD' END AS programs FROM (SELECT c_custkey AS id FROM customer) x""",
)
def cleaned_responses(t):
    c = F.col("c_custkey")
    raw = F.concat(
        F.lit('```json\n{"qsRanking": '), F.when(c % 2 == 0, (c % 1600).cast("string")).otherwise(F.concat(F.lit('"#'), (c % 2000).cast("string"), F.lit('"'))),
        F.lit(', "acceptanceRate": '), F.when(c % 4 == 0, "0.5").when(c % 4 == 1, '"101%"').when(c % 4 == 2, '"12.5 %"').otherwise('"n/a"'),
        F.lit(', "city": '), F.when(c % 3 == 0, F.concat(F.lit('" Town '), c.cast("string"), F.lit('"'))).when(c % 3 == 1, "7").otherwise('"T"'),
        F.lit(', "country": '), F.when(c % 5 == 0, '"uk"').otherwise('" Germany "'),
        F.lit(', "intakes": ["Fall", "", "Q1", "Spring", "Fall", null],'),
        F.lit('"programs": [{"category": " Law ", "level": "PhD"}, {"category": "Online", "level": "PhD"}, {"category": "Law", "level": "PhD"}, {"category": "Art", "level": '),
        F.when(c % 2 == 0, '"Diploma"').otherwise('"Dipl"'), F.lit("},]}\n```"),
    )
    r = R.clean_response(spread(t.customer.select("c_custkey")).select(c.alias("id"), raw.alias("raw")), "raw")
    return r.select(
        "id", "qs_ranking", "acceptance_rate", "city", "country", F.array_join("intakes", "|").alias("intakes"),
        F.array_join(F.transform("programs", lambda p: F.concat(p["category"], F.lit(":"), p["level"])), "|").alias("programs"),
    )


def _raw_record(t):
    """Records with texts for rank and rate, untidy lists and levels."""
    m, none = t.fx_messy, F.array().cast("array<string>")
    program = lambda c, l: F.struct(F.lit(c).alias("category"), l.alias("level"))
    return m.select(
        F.col("id").alias("entity_id"), F.repeat(F.lit("text "), (F.col("id") % 7).cast("int")).alias("description"),
        F.lit("Town").alias("city"), F.col("raw_country").alias("country"), F.col("raw_rank").alias("qs_ranking"), F.col("raw_rate").alias("acceptance_rate"),
        F.lit("100").alias("total_students"), F.lit("USD 5").alias("tuition_fee"), F.lit(1.0).alias("students_placed"),
        F.array_compact(F.array(F.col("raw_intake"), F.lit(""))).alias("intakes"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("Transcript"), F.lit("transcript "), F.lit("CV"))).otherwise(none).alias("admission_requirements"),
        F.array(program("Law", F.col("raw_level")), program("law", F.col("raw_level")), program(" ", F.col("raw_level"))).alias("programs"),
        F.when(F.col("id") % 11 == 0, F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: i.cast("string"))).otherwise(none).alias("similar_universities"),
        F.array(F.lit("https://x.org/a.png"), F.lit("nothing")).alias("image_urls"),
    )


_LEVEL = """CASE WHEN contains(l, 'under') OR contains(l, 'bsc') OR contains(l, 'ba ') OR l = 'ba' THEN 'Undergraduate' WHEN contains(l, 'master') OR contains(l, 'mba') OR l = 'ma' THEN 'Postgraduate'
 WHEN contains(l, 'phd') OR contains(l, 'd.phil') THEN 'PhD' WHEN contains(l, 'diploma') THEN 'Diploma' WHEN contains(l, 'cert') THEN 'Certificate' END"""


@query(
    "R2 R3 R4 R5",
    f"""SELECT id AS entity_id, id % 11 <> 0 AS success, id % 11 <> 0 AS salvaged,
  CASE WHEN id % 11 <> 0 AND TRY_CAST(nullif(regexp_replace(raw_rank, '[^0-9]', '', 'g'), '') AS INTEGER) BETWEEN 1 AND 1500 THEN TRY_CAST(regexp_replace(raw_rank, '[^0-9]', '', 'g') AS INTEGER) END AS qs_ranking,
  CASE WHEN id % 11 <> 0 THEN CASE WHEN lv IS NULL THEN '' ELSE 'Law:' || lv END ELSE 'Law:' || coalesce(raw_level, '') || '|law:' || coalesce(raw_level, '') || '| :' || coalesce(raw_level, '') END AS programs,
  CASE WHEN id % 2 = 1 THEN '' WHEN id % 11 <> 0 THEN 'Transcript' ELSE 'Transcript|transcript |CV' END AS requirements
FROM (SELECT *, {_LEVEL} AS lv FROM (SELECT *, trim(lower(raw_level)) AS l FROM fx_messy) y) x""",
)
def validated_records(t):
    v = R.validate(_raw_record(t))
    join = lambda a: F.array_join(F.transform(a, lambda p: F.concat(p["category"], F.lit(":"), F.coalesce(p["level"], F.lit("")))), "|")
    return v.select(
        "entity_id", "success", "salvaged", "qs_ranking", join(F.col("programs")).alias("programs"),
        F.array_join("admission_requirements", "|").alias("requirements"),
    )


def _extracted(t):
    r = t.record()
    return r.select(
        "entity_id", F.when(F.col("entity_id") % 3 == 0, F.col("description")).when(F.col("entity_id") % 3 == 1, "short text").alias("description"),
        "city", F.when(F.col("entity_id") % 4 > 0, F.col("country")).alias("country"), "tuition_fee", "total_students",
        F.col("qs_ranking").cast("double").alias("qs_ranking"), F.col("acceptance_rate").cast("double").alias("acceptance_rate"),
        "intakes", "admission_requirements", "similar_universities", "programs",
    )


def _external(t):
    # Not every record has outside data.
    e = t.fx_entity.filter(F.col("entity_id") % 7 != 0)
    return e.select(
        "entity_id", F.repeat(F.lit("outside "), (F.col("entity_id") % 40).cast("int")).alias("description"),
        F.concat(F.lit("Place "), (F.col("entity_id") % 9).cast("string")).alias("city"),
        F.concat(F.lit("NATION_"), (F.col("entity_id") % 25).cast("string")).alias("country"),
        (F.col("entity_id") % 90 + 5).cast("double").alias("acceptance_rate"),
        F.array(F.lit("Fall"), F.lit("Winter")).alias("intakes"),
    )


_XD = "CASE WHEN r.entity_id % 3 = 0 THEN r.description WHEN r.entity_id % 3 = 1 THEN 'short text' END"
_ED = "CASE WHEN r.entity_id % 7 <> 0 THEN repeat('outside ', CAST(r.entity_id % 40 AS INTEGER)) END"
_MERGED = f"""(SELECT r.entity_id, r.name, r.country_id,
  coalesce(CASE WHEN length({_XD}) > 80 AND trim({_XD}) <> '' THEN {_XD} END, CASE WHEN trim({_ED}) <> '' THEN {_ED} END, CASE WHEN trim({_XD}) <> '' THEN {_XD} END) AS description,
  coalesce(nullif(r.city, ''), CASE WHEN r.entity_id % 7 <> 0 THEN 'Place ' || CAST(r.entity_id % 9 AS VARCHAR) END) AS city,
  coalesce(CASE WHEN r.entity_id % 4 > 0 THEN r.country END, CASE WHEN r.entity_id % 7 <> 0 THEN 'NATION_' || CAST(r.entity_id % 25 AS VARCHAR) END) AS country,
  nullif(r.tuition_fee, '') AS tuition_fee, r.total_students, CAST(r.qs_ranking AS DOUBLE) AS qs_ranking,
  coalesce(CAST(r.acceptance_rate AS DOUBLE), CASE WHEN r.entity_id % 7 <> 0 THEN CAST(r.entity_id % 90 + 5 AS DOUBLE) END) AS acceptance_rate,
  list_filter(list_distinct_keep, lambda x: x <> '') AS intakes, np, nq, ns, r.requirements_text, r.similar_text
  FROM (SELECT *, CASE entity_id % 4 WHEN 0 THEN CASE WHEN entity_id % 7 <> 0 THEN ['Fall', 'Winter'] ELSE [''] END
     WHEN 1 THEN CASE WHEN entity_id % 7 <> 0 THEN ['Sept. 2025', 'Jan', 'Fall', 'Winter'] ELSE ['Sept. 2025', 'Jan'] END
     WHEN 2 THEN CASE WHEN entity_id % 7 <> 0 THEN ['Fall', 'Spring', 'Winter'] ELSE ['Fall', 'Spring'] END
     ELSE CASE WHEN entity_id % 7 <> 0 THEN ['Oct', 'Fall', 'Winter'] ELSE ['Oct'] END END AS list_distinct_keep FROM {_REC}) r) m"""


@query("R6", f"SELECT entity_id, description, city, country, tuition_fee, total_students, qs_ranking, acceptance_rate, array_to_string(intakes, '|') AS intakes, np AS n_programs FROM {_MERGED}")
def merged_records(t):
    m = R.merge_extracted(_extracted(t), _external(t))
    return m.select(
        "entity_id", "description", "city", "country", "tuition_fee", "total_students", "qs_ranking", "acceptance_rate",
        F.array_join("intakes", "|").alias("intakes"), F.size("programs").alias("n_programs"),
    )


def _rules(t):
    """Rule rows for the nations of the given tables, some without a list."""
    n = F.col("n_nationkey")
    return t.nation.filter(n % 3 != 2).select(
        F.col("n_name").alias("country"), F.concat(F.lit("FEE "), F.col("n_name")).alias("tuition"),
        F.when(n % 3 == 0, F.array(F.lit("May"), F.lit("June"))).alias("intakes"),
        F.when(n % 2 == 0, F.array(F.lit("Peer A"), F.lit("Peer B"))).alias("similar"),
    )


_RULES = "(SELECT n_name AS rc, 'FEE ' || n_name AS fee, CASE WHEN n_nationkey % 3 = 0 THEN 'May|June' END AS rin, CASE WHEN n_nationkey % 2 = 0 THEN 'Peer A|Peer B' END AS rsim FROM nation WHERE n_nationkey % 3 <> 2) k"


@query(
    "R7 R8 J2",
    f"""SELECT entity_id, country_name, CASE WHEN trim(coalesce(tuition_fee, '')) = '' THEN coalesce(fee, '{rules.TUITION_DEFAULT}') ELSE tuition_fee END AS tuition_fee,
  CASE WHEN trim(coalesce(total_students, '')) = '' THEN '{rules.STUDENTS_BY_TYPE['university']}' ELSE total_students END AS total_students,
  CASE WHEN ns = 0 THEN coalesce(rsim, '{"|".join(rules.SIMILAR_DEFAULT)}') ELSE replace(similar_text, ';', '|') END AS similar,
  CAST(greatest(np, 3) AS INTEGER) AS n_programs, CASE WHEN ni = 0 THEN coalesce(rin, '{"|".join(rules.INTAKES_DEFAULT)}') ELSE replace(intakes_text, ';', '|') END AS intakes,
  CASE WHEN nq < 3 THEN '{rules.REQUIREMENTS_OTHER[0]}' ELSE split_part(requirements_text, ';', 1) END AS first_requirement,
  array_to_string(list_filter([CASE WHEN trim(coalesce(tuition_fee, '')) = '' THEN 'tuition_fee' END, CASE WHEN trim(coalesce(total_students, '')) = '' THEN 'total_students' END, CASE WHEN ns = 0 THEN 'similar_universities' END,
    CASE WHEN np < 3 THEN 'programs' END, CASE WHEN ni = 0 THEN 'intakes' END, CASE WHEN nq < 3 THEN 'admission_requirements' END], lambda x: x IS NOT NULL), ',') AS patched
FROM (SELECT r.*, coalesce(r.country, 'Unknown') AS country_name FROM {_REC}) q LEFT JOIN {_RULES} ON rc = country_name""",
)
def filled_gaps(t):
    f = R.fill_gaps(joins.with_country_name(t.record(), t.fx_country), _rules(t))
    return f.select(
        "entity_id", "country_name", "tuition_fee", "total_students", F.array_join("similar_universities", "|").alias("similar"),
        F.size("programs").alias("n_programs"), F.array_join("intakes", "|").alias("intakes"),
        F.get("admission_requirements", F.lit(0)).alias("first_requirement"), F.array_join("patched_fields", ",").alias("patched"),
    )


@query(
    "R8",
    f"""SELECT entity_id, np, array_to_string(list_concat(own, CASE WHEN np < 3 THEN list_slice(['Business Administration:Undergraduate', 'Computer Science:Undergraduate', 'Engineering:Undergraduate'], 1, 3 - np) ELSE [] END), '|') AS programs
FROM (SELECT r.entity_id, CAST(r.np AS INTEGER) AS np, coalesce(l.own, []) AS own FROM {_REC} LEFT JOIN (SELECT entity_id, list(category || ':' || level ORDER BY category, level) AS own FROM fx_program GROUP BY entity_id) l ON l.entity_id = r.entity_id) x""",
)
def padded_programs(t):
    r = t.record()
    padded = R.pad_programs(F.col("programs"), R.typical_programs(F.lit("university")))
    return r.select(
        "entity_id", F.size("programs").alias("np"),
        F.array_join(F.transform(padded, lambda p: F.concat_ws(":", p["category"], p["level"])), "|").alias("programs"),
    )


@query(
    "R9",
    """SELECT course_id, CASE WHEN course_id % 2 = 0 AND course_id % 7 <> 0 THEN 'new subtitle' WHEN course_id % 2 = 0 THEN '' ELSE 'old' END AS subtitle,
  CASE WHEN course_id % 3 = 0 AND course_id % 7 <> 0 THEN 'n1|n2' WHEN course_id % 3 = 0 THEN '' ELSE 'h' END AS highlights,
  CASE WHEN course_id % 7 = 0 THEN '' ELSE array_to_string(list_filter([CASE WHEN course_id % 2 = 0 THEN 'subtitle' END, CASE WHEN course_id % 3 = 0 THEN 'key_highlights' END], lambda x: x IS NOT NULL), ',') END AS updated
FROM fx_course""",
)
def merged_content(t):
    c = F.col("course_id")
    old = t.fx_course.select(
        c, F.when(c % 2 == 0, "").otherwise("old").alias("subtitle"),
        F.when(c % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("h"))).alias("key_highlights"),
    )
    new = t.fx_course.filter(c % 7 != 0).select(c, F.lit("new subtitle").alias("subtitle"), F.array(F.lit("n1"), F.lit("n2")).alias("key_highlights"))
    m = R.merge_content(old, new, "course_id", ["subtitle", "key_highlights"])
    return m.select(c, "subtitle", F.array_join("key_highlights", "|").alias("highlights"), F.array_join("updated_fields", ",").alias("updated"))


@query("R10", "SELECT country_id, country_id % 2 = 1 AND country_id % 3 = 1 AS complete FROM fx_country")
def content_completeness(t):
    k = F.col("country_id")
    card = lambda a, b: F.struct(F.lit(a).alias("title"), F.lit(b).alias("description"))
    c = t.fx_country.select(
        k, F.when(k % 2 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("a"))).alias("career_opportunities"),
        F.array(F.lit("s")).alias("scholarships"), F.array(F.lit("e")).alias("eligibility_requirements"),
        F.when(k % 3 == 0, F.array(card("t", "d"), card("t", " "))).when(k % 3 == 1, F.array(card("t", "d"))).alias("why_study_cards"),
    )
    return c.select(k, R.country_content_complete().alias("complete"))


@query(
    "R11 R12",
    """SELECT entity_id, nullif(array_to_string(list_slice(list_concat(list_filter(i, lambda x: NOT contains(x, 'is null') AND NOT contains(lower(x), 'missing')), h), 1, 3), '; '), '') AS reason,
  CASE WHEN entity_id % 2 = 0 THEN 'u1|u2|' ELSE '' END || 's' || CAST(entity_id % 5 AS VARCHAR) AS sources
FROM (SELECT entity_id, CASE entity_id % 3 WHEN 0 THEN ['a', 'Missing b', 'c is null', 'd'] WHEN 1 THEN ['missing'] ELSE [] END AS i, CASE WHEN entity_id % 2 = 0 THEN ['h1', 'h2'] ELSE [] END AS h FROM fx_entity) x""",
)
def failure_reasons(t):
    k, none = F.col("entity_id"), F.array().cast("array<string>")
    lits = lambda *v: F.array(*map(F.lit, v))
    issues = F.when(k % 3 == 0, lits("a", "Missing b", "c is null", "d")).when(k % 3 == 1, lits("missing")).otherwise(none)
    hall = F.when(k % 2 == 0, lits("h1", "h2")).otherwise(none)
    src = F.array(F.struct(F.concat(F.lit("s"), (k % 5).cast("string")).alias("source")))
    return t.fx_entity.select(
        k, R.failure_reason(issues, hall).alias("reason"),
        F.array_join(R.provenance(F.when(k % 2 == 0, lits("u1", "u2")), src), "|").alias("sources"),
    )


@query(
    "R13",
    """SELECT entity_id, string_agg(level || '=' || CAST(n AS VARCHAR), ',' ORDER BY level) AS levels FROM (SELECT entity_id, level, COUNT(*) AS n FROM fx_program GROUP BY 1, 2) x GROUP BY entity_id""",
)
def level_counts(t):
    m = B.value_counts(F.transform("programs", lambda p: p["level"]))
    r = t.record().filter(F.size("programs") > 0).select("entity_id", m.alias("m"))
    entries = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return r.select("entity_id", F.array_join(entries, ",").alias("levels"))


@query("U3", f"SELECT entity_id, array_to_string(intakes, '|') AS intakes FROM {_MERGED}")
def united_lists(t):
    j = t.record().join(_external(t).select("entity_id", F.col("intakes").alias("more")), "entity_id", "left")
    return j.select("entity_id", F.array_join(B.union_lists(F.col("intakes"), F.col("more")), "|").alias("intakes"))


# --- quality --------------------------------------------------------------

_MISSING = """list_filter([CASE WHEN coalesce(length(description), 0) < 80 THEN 'description' END, CASE WHEN coalesce(length(city), 0) < 2 THEN 'city' END, CASE WHEN coalesce(length(country), 0) < 2 THEN 'country' END,
 CASE WHEN coalesce(length(tuition_fee), 0) < 4 THEN 'tuition_fee' END, CASE WHEN coalesce(length(total_students), 0) = 0 THEN 'total_students' END, CASE WHEN ni = 0 THEN 'intakes' END,
 CASE WHEN nq < 3 THEN 'admission_requirements' END, CASE WHEN np < 3 THEN 'programs' END, CASE WHEN ns = 0 THEN 'similar_universities' END], lambda x: x IS NOT NULL)"""


@query("Q1", f"SELECT entity_id, array_to_string({_MISSING}, ',') AS missing FROM {_REC}")
def required_fields(t):
    return t.record().select("entity_id", F.array_join(Q.missing_required(), ",").alias("missing"))


_SCORE = """least(0.97, CAST(0.55 AS DOUBLE) + CASE WHEN length(description) >= 150 THEN 0.1 WHEN length(description) >= 80 THEN 0.07 WHEN length(description) >= 40 THEN 0.03 ELSE 0 END
 + CASE WHEN coalesce(city, '') <> '' THEN 0.04 ELSE 0 END + CASE WHEN coalesce(country, '') <> '' THEN 0.05 ELSE 0 END
 + CASE WHEN np >= 5 THEN 0.08 WHEN np >= 3 THEN 0.06 WHEN np >= 1 THEN 0.03 ELSE 0 END + CASE WHEN nq >= 4 THEN 0.05 WHEN nq >= 2 THEN 0.03 WHEN nq >= 1 THEN 0.01 ELSE 0 END
 + CASE WHEN ni >= 2 THEN 0.04 WHEN ni >= 1 THEN 0.02 ELSE 0 END + CASE WHEN coalesce(tuition_fee, '') <> '' THEN 0.04 ELSE 0 END + CASE WHEN coalesce(total_students, '') <> '' THEN 0.02 ELSE 0 END
 + CASE WHEN coalesce(qs_ranking, 0) <> 0 THEN 0.02 ELSE 0 END + CASE WHEN coalesce(acceptance_rate, 0) <> 0 THEN 0.02 ELSE 0 END + CASE WHEN ns >= 1 THEN 0.01 ELSE 0 END)"""


@query("Q2", f"SELECT entity_id, round(CAST({_SCORE} AS DOUBLE), 6) AS score FROM {_REC}")
def structural_scores(t):
    return t.record().select("entity_id", F.round(Q.structural_score(), 6).alias("score"))


_RANK_BAD = "(qs_ranking < 1 OR qs_ranking > 1500)"
_RATE_BAD = "(acceptance_rate < 0.1 OR acceptance_rate > 100)"


@query(
    "Q3",
    f"""SELECT entity_id, array_to_string(list_filter([CASE WHEN {_RANK_BAD} THEN 'CRITICAL: Invalid QS ranking: ' || CAST(qs_ranking AS VARCHAR) END, CASE WHEN {_RATE_BAD} THEN 'CRITICAL: Invalid acceptance rate' END,
  CASE WHEN description <> '' AND length(description) < 20 THEN 'Description too short' END], lambda x: x IS NOT NULL), '; ') AS issues, coalesce({_RANK_BAD}, false) OR coalesce({_RATE_BAD}, false) AS critical FROM {_REC}""",
)
def structural_checks(t):
    i = Q.structural_issues()
    short = F.transform(i, lambda x: F.regexp_replace(x, r"^(CRITICAL: Invalid acceptance rate): .*$", "$1"))
    return t.record().select("entity_id", F.array_join(short, "; ").alias("issues"), Q.is_critical(i).alias("critical"))


def _model(t):
    k = F.col("entity_id")
    return t.fx_entity.filter(k % 6 != 0).select(
        k, ((k % 100) / 100).alias("model_score"), (k % 13 == 0).alias("model_overridden"),
        F.when(k % 10 == 0, F.array(F.lit("h1"), F.lit("h2"))).otherwise(F.array().cast("array<string>")).alias("hallucinations"),
    )


_DECIDED = """(SELECT *, CASE WHEN crit THEN 0.15 WHEN s >= 0.82 THEN s ELSE CAST(printf('%.3f', greatest(0.0, least(0.98, CASE WHEN weak OR v = 0.5 THEN s * 0.85 + v * 0.15 ELSE v * 0.55 + s * 0.45 END
   - CASE WHEN coalesce(length(description), 0) = 0 THEN 0.12 ELSE 0.0 END - CASE WHEN np = 0 THEN 0.06 ELSE 0.0 END - CASE WHEN coalesce(length(country), 0) = 0 THEN 0.05 ELSE 0.0 END - CASE WHEN entity_id % 6 <> 0 AND entity_id % 10 = 0 THEN 0.16 ELSE 0.0 END))) AS DOUBLE) END AS score
 FROM (SELECT *, CASE WHEN m IS NULL OR m = 0 THEN s WHEN weak THEN greatest(s, 0.55) ELSE m END AS v FROM
 (SELECT *, CASE WHEN entity_id % 6 <> 0 THEN (entity_id % 100) / 100.0 END AS m, entity_id % 6 <> 0 AND (entity_id % 13 = 0 OR entity_id % 100 = 50) AS weak, CAST({score} AS DOUBLE) AS s, coalesce({rank}, false) OR coalesce({rate}, false) AS crit FROM {rec}) a) b) d"""
_D = _DECIDED.format(score=_SCORE, rank=_RANK_BAD, rate=_RATE_BAD, rec=_REC)
_DECISION = "CASE WHEN crit THEN 'reject' WHEN score >= 0.8 THEN 'accept' WHEN score >= 0.62 THEN 'partial' ELSE 'reject' END"


@query("Q4 Q5 Q6", f"""SELECT entity_id, round(score, 3) AS score, {_DECISION} AS decision, CASE WHEN len({_MISSING}) = 0 AND ({_DECISION} = 'accept' OR score >= 0.72) THEN 'completed' WHEN {_DECISION} = 'partial' OR score >= 0.55 THEN 'partial' ELSE 'failed' END AS status FROM {_D}""")
def record_decisions(t):
    d = Q.decide(t.record().join(_model(t), "entity_id", "left"))
    status = Q.record_status(Q.missing_required(), F.col("decision"), F.col("confidence_score"))
    return d.select("entity_id", F.round("confidence_score", 3).alias("score"), "decision", status.alias("status"))


@query("Q7", f"SELECT entity_id, CASE WHEN len({_MISSING}) = 0 THEN 0.62 WHEN coalesce(description, '') <> '' THEN 0.58 ELSE 0.5 END AS score FROM {_REC}")
def external_only_scores(t):
    return t.record().select("entity_id", Q.external_only_confidence(Q.missing_required(), F.col("description")).alias("score"))


_FILLED = f"""(SELECT entity_id, name, country_id, description, city, country, coalesce(CASE WHEN length(trim(tuition_fee)) >= 3 THEN tuition_fee END, fee, '{rules.TUITION_DEFAULT}') AS tuition_fee,
  CASE WHEN length(trim(coalesce(total_students, ''))) < 2 THEN '{rules.STUDENTS_BY_TYPE['university']}' ELSE total_students END AS total_students, qs_ranking, acceptance_rate,
  greatest(np, 3) AS np, CASE WHEN nq < 3 THEN 5 ELSE nq END AS nq, CASE WHEN len(intakes) = 0 THEN 2 ELSE len(intakes) END AS ni, CASE WHEN ns = 0 THEN CASE WHEN rsim IS NULL THEN 3 ELSE 2 END ELSE ns END AS ns
  FROM {_MERGED.replace('nq, ns, r.req', 'CASE WHEN r.entity_id % 5 = 1 THEN 3 ELSE nq END AS nq, ns, r.req')} LEFT JOIN {_RULES} ON rc = country) f"""
_VALID = "(qs_ranking IS NULL OR qs_ranking BETWEEN 1 AND 1500) AND (acceptance_rate IS NULL OR acceptance_rate BETWEEN 0.1 AND 100)"
_F = _DECIDED.format(score=_SCORE, rank=_RANK_BAD, rate=_RATE_BAD, rec=_FILLED)


@query(
    "Q8",
    f"""SELECT entity_id, ok AS success, round(score, 3) AS score, CASE WHEN NOT ok THEN 'failed' WHEN len({_MISSING}) = 0 AND ({_DECISION} = 'accept' OR score >= 0.72) THEN 'completed' WHEN {_DECISION} = 'partial' OR score >= 0.55 THEN 'partial' ELSE 'failed' END AS status,
  array_to_string({_MISSING}, ',') AS missing, coalesce(c.country_id, d.country_id) AS resolved_country_id
FROM (SELECT *, {_VALID} AS ok FROM {_D.replace(_REC, _FILLED)}) d LEFT JOIN (SELECT name AS cname, country_id FROM fx_country) c ON lower(c.cname) = lower(d.country)""",
)
def enriched_catalog(t):
    return _enriched(t).records.select(
        "entity_id", "success", F.round("confidence_score", 3).alias("score"), "status",
        F.array_join("missing_fields", ",").alias("missing"), "resolved_country_id",
    )


def _enriched(t):
    return enrich.enrich_catalog(t.fx_entity, _extracted(t), _external(t), _model(t), t.fx_country, t.fx_course, _rules(t))


@query("Q8 J11", f"SELECT DISTINCT l.entity_id, l.course_id FROM {_LINKS} l JOIN (SELECT entity_id FROM (SELECT *, {_VALID} AS ok FROM {_D.replace(_REC, _FILLED)}) x WHERE ok) d ON d.entity_id = l.entity_id")
def enriched_links(t):
    """Courses of the programs of valid records: the second half of the record job."""
    return _enriched(t).links()
