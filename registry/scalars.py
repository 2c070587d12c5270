"""Text, url, number, hash and date functions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusloom import rules
from campusloom.functions import basics as B, hashing, jsonfix, seo, text as X, urls as U
from campusloom.session import spread
from registry.base import query

BRAND = "Good Brand"


def _case(col: str, mapping: dict) -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return f"CASE {col} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items()) + " END"


def _any_like(col: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


def _additive(expr: str, table: list) -> str:
    return " + ".join(f"CASE WHEN {expr.format(p=p)} THEN {w} ELSE 0 END" for p, w in table)


_SLUG = "lower(text)"
_SLUG = f"translate({_SLUG}, '{rules.ACCENTED}', '{rules.UNACCENTED}')"
for _m, _w in rules.SLUG_WORDS.items():
    _SLUG = f"replace({_SLUG}, '{_m}', '{_w}')"
_SLUG = rf"regexp_replace(regexp_replace(trim(regexp_replace({_SLUG}, '[^a-z0-9\s-]', '', 'g')), '[\s-]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query("V1", f"SELECT doc_id, {_SLUG} AS slug FROM documents")
def slugs(t):
    return spread(t.documents.select("doc_id", "text")).select("doc_id", X.slugify(F.col("text")).alias("slug"))


_NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(lower({c}), '\s*\([^)]*\)', '', 'g'), '[''\"‘’“”.,\-–—/&|]', ' ', 'g'), '\s+', ' ', 'g'))"


@query("V2", f"SELECT line_no, {_NORM.format(c='institution_name')} AS norm FROM fx_ranking")
def normalized_names(t):
    return t.fx_ranking.select("line_no", X.normalize_name(F.col("institution_name")).alias("norm"))


@query("V3", r"SELECT p_partkey, trim(regexp_replace(lower(concat('  ', upper(p_name), '   and ', p_type, ' ')), '\s+', ' ', 'g')) AS category FROM part")
def normalized_categories(t):
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("   and "), F.col("p_type"), F.lit(" "))
    return t.part.select("p_partkey", X.normalize_category(raw).alias("category"))


@query("V4", f"SELECT id, CASE WHEN raw_country = '' THEN '' ELSE coalesce({_case('lower(trim(raw_country))', rules.COUNTRY_ALIASES)}, trim(raw_country)) END AS country FROM fx_messy")
def normalized_countries(t):
    return t.fx_messy.select("id", X.normalize_country(F.col("raw_country")).alias("country"))


_HOST = r"nullif(regexp_replace(regexp_replace(lower(regexp_extract(trim(raw_url), '^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]+)', 2)), '^[^@]*@', ''), ':[0-9]+$', ''), '')"


@query("V5", f"SELECT id, {_case(f'string_split({_HOST}, chr(46))[-1]', rules.TLD_COUNTRIES)} AS country FROM fx_messy")
def countries_from_domains(t):
    return t.fx_messy.select("id", U.country_from_url(F.col("raw_url")).alias("country"))


_U = r"'^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]+)([^?#]*)(\?[^#]*)?(#.*)?$'"


@query(
    "V6",
    rf"""
SELECT page_id, regexp_replace(h, '^www\.', '') AS bare_host, regexp_replace(lower(o || p), '/$', '') AS path_key,
       regexp_replace(o || p || CASE WHEN q = '' THEN '' ELSE '?' || q END, '/$', '') AS clean
FROM (SELECT page_id, lower(regexp_extract(url, {_U}, 2)) AS h, lower(regexp_extract(url, {_U}, 1)) || '://' || lower(regexp_extract(url, {_U}, 2)) AS o,
             CASE WHEN regexp_extract(url, {_U}, 3) = '' THEN '/' ELSE regexp_extract(url, {_U}, 3) END AS p,
             array_to_string(list_filter(string_split(regexp_replace(regexp_extract(url, {_U}, 4), '^\?', ''), '&'),
                lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_source|utm_medium|utm_campaign|ref|source)(=|$)')), '&') AS q
      FROM pages) x""",
)
def url_normal_forms(t):
    u = F.col("url")
    return t.pages.select(
        "page_id", U.bare_host(u).alias("bare_host"), U.path_key(u).alias("path_key"), U.clean_url(u).alias("clean")
    )


_CLASS = r"""
SELECT url, run_no, CASE WHEN regexp_matches(p, '^/study-in-[^/]+/?$') THEN 'country' WHEN regexp_matches(p, '^/programs/universities/[^/]+/?$') THEN 'university'
    WHEN regexp_matches(p, '^/courses/[^/]+/?$') THEN 'course' WHEN regexp_matches(p, '^/blog/[^/]+/?$') THEN 'blog'
    WHEN regexp_matches(p, '^/study-.+-in-[^/]+/?$') THEN 'combo' ELSE 'other' END AS entity_type,
  CASE WHEN regexp_matches(p, '^/study-in-[^/]+/?$') THEN regexp_extract(p, '^/study-in-([^/]+)', 1)
    WHEN regexp_matches(p, '^/programs/universities/[^/]+/?$') THEN regexp_extract(p, '^/programs/universities/([^/]+)', 1)
    WHEN regexp_matches(p, '^/courses/[^/]+/?$') THEN regexp_extract(p, '^/courses/([^/]+)', 1)
    WHEN regexp_matches(p, '^/blog/[^/]+/?$') THEN regexp_extract(p, '^/blog/([^/]+)', 1)
    WHEN regexp_matches(p, '^/study-.+-in-[^/]+/?$') THEN regexp_extract(p, '^/study-(.+)-in-([^/]+)', 1) || '::' || regexp_extract(p, '^/study-(.+)-in-([^/]+)', 2) END AS slug
FROM (SELECT url, run_no, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) AS p FROM fx_perf) x
"""


@query("V7", _CLASS)
def url_classes(t):
    c = U.classify(F.col("url"))
    return t.fx_perf.select("url", "run_no", c["entity_type"].alias("entity_type"), c["slug"].alias("slug"))


_HIT = "(regexp_matches(p, '{p}') OR regexp_matches(l, '{p}'))"


@query(
    "V8",
    f"SELECT page_id, link, greatest({_additive(_HIT, rules.LINK_SCORES)}, -999) AS score "
    r"FROM (SELECT page_id, link, lower(link) AS l, lower(regexp_extract(link, '^[a-z]+://[^/?#]+([^?#]*)', 1)) AS p FROM fx_link) x",
)
def link_scores(t):
    return t.fx_link.select("page_id", "link", U.link_score(F.col("link")).alias("score"))


def _first(expr: str, table: list, neutral: int) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expr}, '{p}') THEN {w}" for p, w in table) + f" ELSE {neutral} END"


@query("V9", f"SELECT page_id, link, {_first('lower(link)', rules.SITEMAP_SCORES, 5)} AS score FROM fx_link")
def sitemap_scores(t):
    return t.fx_link.select("page_id", "link", U.sitemap_score(F.col("link")).alias("score"))


def _types(technical: str) -> str:
    n = "lower(raw_name)"
    return (
        f"CASE WHEN {_any_like(n, ['community college', 'technical college'])} THEN 'community' WHEN {technical} THEN 'technical' "
        f"WHEN contains({n}, 'college') AND NOT contains({n}, 'university') THEN 'college' "
        f"WHEN {_any_like(n, ['school of', 'academy'])} THEN 'specialized' ELSE 'university' END"
    )


_PHRASE = (
    "CASE WHEN {a} THEN 'community college' WHEN {b} THEN 'technical institute' "
    "WHEN contains(lower(raw_name), 'college') AND NOT contains(lower(raw_name), 'university') THEN 'college' WHEN contains(lower(raw_name), 'academy') THEN 'academy' "
    "WHEN contains(lower(raw_name), 'school of') THEN 'specialized school' WHEN contains(lower(raw_name), 'seminary') THEN 'seminary' ELSE 'university' END"
).format(a=_any_like("lower(raw_name)", ["community college", "technical college"]), b=_any_like("lower(raw_name)", ["institute of technology", "polytechnic"]))


@query(
    "V10",
    f"SELECT id, {_types(_any_like('lower(raw_name)', ['institute of technology', 'polytechnic', 'technical university']))} AS kind, "
    f"{_types(_any_like('lower(raw_name)', ['institute of technology', 'polytechnic']))} AS live_kind, {_PHRASE} AS phrase FROM fx_messy",
)
def institution_types(t):
    n = F.col("raw_name")
    return t.fx_messy.select(
        "id", X.institution_type(n).alias("kind"), X.institution_type(n, False).alias("live_kind"), X.institution_phrase(n).alias("phrase")
    )


_INTAKE = "trim(raw_intake)"
for _a, _f in rules.MONTHS.items():
    _INTAKE = rf"regexp_replace({_INTAKE}, '(?i)\b{_a}\.?\b', '{_f}')"


@query("V11", f"SELECT id, CASE WHEN length(s) > 2 THEN s END AS intake FROM (SELECT id, {_INTAKE} AS s FROM fx_messy) x")
def normalized_intakes(t):
    return t.fx_messy.select("id", X.normalize_intake(F.col("raw_intake")).alias("intake"))


@query(
    "V12",
    f"""SELECT id, CASE WHEN {_any_like('l', ['under', 'bachelor', 'ug', 'btech', 'bsc', 'ba '])} OR l = 'ba' THEN 'Undergraduate'
  WHEN {_any_like('l', ['post', 'master', 'pg', 'msc', 'mba', 'mtech', 'ma '])} OR l = 'ma' THEN 'Postgraduate'
  WHEN {_any_like('l', ['phd', 'doctoral', 'doctorate', 'd.phil'])} THEN 'PhD' WHEN contains(l, 'diploma') THEN 'Diploma' WHEN contains(l, 'cert') THEN 'Certificate' END AS level
FROM (SELECT id, trim(lower(raw_level)) AS l FROM fx_messy) x""",
)
def normalized_levels(t):
    return t.fx_messy.select("id", X.normalize_level(F.col("raw_level")).alias("level"))


@query("V13", "SELECT id, CASE WHEN n BETWEEN 1 AND 1500 THEN n END AS rank FROM (SELECT id, TRY_CAST(nullif(regexp_replace(raw_rank, '[^0-9]', '', 'g'), '') AS INTEGER) AS n FROM fx_messy) x")
def parsed_ranks(t):
    return t.fx_messy.select("id", B.parse_rank(F.col("raw_rank")).alias("rank"))


@query(
    "V14",
    r"""SELECT id, CASE WHEN a BETWEEN 0.1 AND 100 THEN round(a, 6) END AS repaired, CASE WHEN b BETWEEN 0.5 AND 100 THEN round(b, 6) END AS cleaned
FROM (SELECT id, CASE WHEN n <= 1.0 THEN n * 100 ELSE n END AS a, CASE WHEN n > 0 AND n < 1 THEN n * 100 ELSE n END AS b
FROM (SELECT id, TRY_CAST(nullif(regexp_extract(regexp_replace(raw_rate, '[^0-9.]', '', 'g'), '^([0-9]+\.?[0-9]*|\.[0-9]+)', 1), '') AS DOUBLE) AS n FROM fx_messy) y) x""",
)
def parsed_percentages(t):
    r = F.col("raw_rate")
    return t.fx_messy.select(
        "id", F.round(B.parse_percent(r), 6).alias("repaired"), F.round(B.parse_percent(r, inclusive=False, low=0.5), 6).alias("cleaned")
    )


@query(
    "V15",
    r"""SELECT doc_id, CASE WHEN json_valid(body) THEN json_extract_string(body, '$.title') END AS title, CASE WHEN json_valid(body) THEN CAST(json_array_length(body, '$.tags') AS INTEGER) END AS n_tags
FROM (SELECT doc_id, regexp_replace(nullif(regexp_extract(raw, '(?s)\{.*\}'), ''), ',\s*([}\]])', '\1', 'g') AS body FROM fx_response) x""",
)
def repaired_responses(t):
    v = F.try_parse_json(jsonfix.repair_json(F.col("raw")))
    return t.fx_response.select(
        "doc_id", F.try_variant_get(v, "$.title", "string").alias("title"),
        F.size(F.try_variant_get(v, "$.tags", "array<string>")).alias("n_tags"),
    )


@query(
    "V15",
    r"""SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN 'Doc ' || CAST(doc_id AS VARCHAR) || ' guide | Brand' END AS title FROM documents""",
)
def repaired_responses_short(t):
    v = F.try_parse_json(jsonfix.repair_json_short(F.col("raw")))
    return t.fx_response.select("doc_id", F.try_variant_get(v, "$.title", "string").alias("title"))


@query("V16", "SELECT doc_id, md5(text) AS content_key, left(sha256(concat('https://x.org/', CAST(doc_id AS VARCHAR))), 32) AS url_key FROM documents")
def hash_keys(t):
    return t.documents.select(
        "doc_id", hashing.content_key(F.col("text")).alias("content_key"),
        hashing.url_key(F.concat(F.lit("https://x.org/"), F.col("doc_id").cast("string"))).alias("url_key"),
    )


@query(
    "V17",
    r"""SELECT id, array_to_string(list_filter([raw_name, CASE WHEN p <> raw_name THEN p END, CASE WHEN s <> raw_name AND length(s) > 4 AND s <> p THEN s END], lambda x: x IS NOT NULL), '|') AS variants
FROM (SELECT id, raw_name, trim(regexp_replace(raw_name, '\s*\([^)]+\)', '', 'g')) AS p, trim(regexp_replace(raw_name, '(?i),?\s+(College|University|Institute|School|Academy)$', '')) AS s FROM fx_messy) x""",
)
def name_variants(t):
    return t.fx_messy.select("id", F.array_join(X.name_variants(F.col("raw_name")), "|").alias("variants"))


@query(
    "V18",
    "SELECT entity_id, contains(c, 'customer') AND contains(c, split_part(lower(name), ' ', 2)) AS agrees "
    "FROM (SELECT entity_id, name, lower(concat('The ', upper(name), CASE WHEN entity_id % 2 = 0 THEN '' ELSE ' of Customers' END)) AS c FROM (SELECT entity_id, CASE WHEN entity_id % 3 = 0 THEN name ELSE concat('Customer ', CAST(entity_id AS VARCHAR)) END AS name FROM fx_entity) y) x",
)
def name_agreement(t):
    n = F.when(F.col("entity_id") % 3 == 0, F.col("name")).otherwise(F.concat(F.lit("Customer "), F.col("entity_id").cast("string")))
    e = t.fx_entity.select("entity_id", n.alias("name"))
    c = F.concat(F.lit("The "), F.upper("name"), F.when(F.col("entity_id") % 2 == 0, "").otherwise(" of Customers"))
    return e.select("entity_id", X.name_agrees(F.col("name"), c).alias("agrees"))


@query("V19", r"SELECT doc_id, len(regexp_split_to_array(trim(text), '\s+')) AS words FROM documents")
def word_counts(t):
    return t.documents.select("doc_id", X.word_count(F.col("text")).cast("long").alias("words"))


# Repair of endings; the tail is what stands behind the last bar.
def _repair(v: str) -> str:
    tail = rf"trim(regexp_extract({v}, '(?s)\|([^|]*)$', 1))"
    return (
        rf"CASE WHEN regexp_matches({v}, '[|\-–—:,]$') THEN regexp_replace({v}, '[\s|\-–—:,]+$', '') "
        rf"WHEN contains({v}, '|') AND {tail} <> '' AND {tail} <> '{BRAND}' AND starts_with(lower('{BRAND}'), lower({tail})) "
        rf"THEN trim(regexp_replace({v}, '\|[^|]*$', '')) ELSE {v} END"
    )


_TRIMMED = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


@query("V20", f"SELECT doc_id, {_repair("t")} AS title FROM (SELECT doc_id, {_TRIMMED.format(c='title')} AS t FROM fx_title) x")
def repaired_title_endings(t):
    return t.fx_title.select("doc_id", seo.repair_suffix(F.col("title"), BRAND).alias("title"))


def _limit_sql(col: str, limit: int) -> str:
    piece = f"left(t, {limit})"
    blank = f"({limit} - instr(reverse({piece}), ' '))"
    cut = f"CASE WHEN contains({piece}, ' ') AND {blank} > {limit} * 0.6 THEN left({piece}, {blank}) ELSE {piece} END"
    head = r"trim(regexp_extract(t, '(?s)^(.*) \| ', 1))"
    return f"""SELECT doc_id, name, CASE WHEN n <= {limit} THEN t WHEN k IS NOT NULL THEN k WHEN CAST(n - {limit} AS DOUBLE) / n > 0.25 THEN NULL ELSE {_repair("z")} END AS v FROM
(SELECT doc_id, name, t, length(t) AS n, CASE WHEN contains(t, ' | ') AND length({head}) BETWEEN 1 AND {limit} THEN {head} END AS k, trim({cut}) AS z
 FROM (SELECT doc_id, name, {_repair("t")} AS t FROM (SELECT doc_id, name, {_TRIMMED.format(c=col)} AS t FROM fx_title) a) b) c"""


@query("V21", _limit_sql("title", 60))
def limited_titles(t):
    return t.fx_title.select("doc_id", "name", seo.enforce_length(F.col("title"), 60, BRAND).alias("v"))


@query("V21", _limit_sql("description", 155))
def limited_descriptions(t):
    return t.fx_title.select("doc_id", "name", seo.enforce_length(F.col("description"), 155, BRAND).alias("v"))


@query(
    "V22",
    "SELECT doc_id, CAST(contains(lower(title), lower(name)) AS INTEGER) + CAST(contains(lower(description), lower(name)) AS INTEGER) "
    "+ CAST(regexp_matches(title, '[0-9]') AS INTEGER) + CAST(length(description) > 20 AS INTEGER) AS score FROM fx_title",
)
def meta_scores(t):
    return t.fx_title.select("doc_id", seo.meta_score(F.col("name"), F.col("title"), F.col("description")).alias("score"))


@query(
    "V23",
    """SELECT o_custkey, printf('%.1f%%', round(f * 100.0 / n, 1)) AS pct, '[' || repeat('█', CAST(round(f / n * 20) AS INTEGER)) || repeat('░', 20 - CAST(round(f / n * 20) AS INTEGER)) || ']' AS bar
FROM (SELECT o_custkey, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS f FROM orders GROUP BY o_custkey) x""",
)
def share_labels(t):
    g = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    return g.select("o_custkey", B.percent_label(F.col("f"), F.col("n")).alias("pct"), B.bar(F.col("f"), F.col("n"), 20).alias("bar"))


@query(
    "V24",
    f"""SELECT entity_id, coalesce(nullif(title, ''), name || ' – Admission, Fees & Courses | {BRAND}') AS meta_title,
  CASE WHEN description <> '' THEN left(description, 155) END AS meta_description
FROM (SELECT entity_id, name, description, CASE WHEN entity_id % 3 = 0 THEN name || ' page' WHEN entity_id % 3 = 1 THEN '' END AS title FROM fx_entity) x""",
)
def default_meta(t):
    own = F.when(F.col("entity_id") % 3 == 0, F.concat("name", F.lit(" page"))).when(F.col("entity_id") % 3 == 1, "")
    return t.fx_entity.select(
        "entity_id", seo.default_title("university", own, F.col("name"), BRAND).alias("meta_title"),
        seo.default_description(F.lit(None).cast("string"), F.col("description")).alias("meta_description"),
    )


@query(
    "V24",
    """SELECT item_id, left(text, 30) AS meta_title, left(text, 155) AS meta_description, left(text, 30) AS alt_text, left(text, 30) AS og_title, left(text, 155) AS og_description FROM benchmark""",
)
def default_post_meta(t):
    b = t.benchmark.withColumn("title", F.left("text", F.lit(30)))
    none = F.lit(None).cast("string")
    cols = seo.post_defaults(F.col("title"), F.lit(""), F.col("text"), none, none)
    return b.select("item_id", *[c.alias(n) for n, c in cols.items()])


_IMG = "CASE WHEN " + _any_like("l", rules.IMAGE_SKIP) + " THEN NULL " + " ".join(
    f"WHEN {_any_like('l', w)} THEN '{k}'" for k, w in rules.IMAGE_TYPES.items()
) + r" WHEN regexp_matches(l, '\.(jpg|jpeg|png|webp)') THEN 'campus' END"


@query("V25", f"SELECT entity_id, pos, {_IMG} AS image_type FROM (SELECT entity_id, pos, lower(url) AS l FROM fx_image) x")
def image_types(t):
    return t.fx_image.select("entity_id", "pos", U.image_type(F.col("url")).alias("image_type"))


@query(
    "V26",
    f"""SELECT id, raw_name || ' is a ' || {_PHRASE} || CASE WHEN id % 3 = 0 THEN ', located in Town, Land' WHEN id % 3 = 1 THEN ', located in Land' ELSE '' END
  || CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN ', at the phd level' ELSE ', offering programs in Law, Art, at the undergraduate and phd level' END || '. It is committed to academic excellence and student success.' AS description FROM fx_messy""",
)
def minimal_descriptions(t):
    city = F.when(F.col("id") % 3 == 0, "Town")
    country = F.when(F.col("id") % 3 < 2, "Land").otherwise("")
    law, art, again = (
        F.struct(F.lit(c).alias("category"), F.lit(l).alias("level")) for c, l in (("Law", "PhD"), ("Art", "Undergraduate"), ("Law", "Diploma"))
    )
    one, three = F.array(law), F.array(F.struct(F.lit("Law").alias("category"), F.lit("Undergraduate").alias("level")), F.struct(F.lit("Art").alias("category"), F.lit("PhD").alias("level")), again)
    del art
    programs = F.when(F.col("id") % 4 == 1, one).when(F.col("id") % 4 > 1, three)
    return t.fx_messy.select("id", X.minimal_description(F.col("raw_name"), city, country, programs).alias("description"))


@query(
    "V27",
    """SELECT e.entity_id, '{"record":"university","name":"' || e.name || '"' || coalesce(',"country":"' || c.name || '"', '') || CASE WHEN e.qs_ranking > 0 THEN ',"qs_ranking":' || CAST(e.qs_ranking AS VARCHAR) ELSE '' END || '}' AS context
FROM fx_entity e LEFT JOIN fx_country c ON e.country_id = c.country_id""",
)
def request_contexts(t):
    e = t.fx_entity.alias("e").join(t.fx_country.alias("c"), F.col("e.country_id") == F.col("c.country_id"), "left")
    ctx = seo.entity_context("university", name=F.col("e.name"), city=F.lit(None), country=F.col("c.name"), qs_ranking=F.col("e.qs_ranking"))
    return e.select(F.col("e.entity_id").alias("entity_id"), ctx.alias("context"))


@query(
    "V27",
    """SELECT course_id, '{"record":"course","title":"' || title || '","level":"' || level || '","field":"' || field || '"}' AS context FROM fx_course""",
)
def course_request_contexts(t):
    ctx = seo.entity_context("course", title=F.col("title"), level=F.col("level"), field=F.col("field"))
    return t.fx_course.select("course_id", ctx.alias("context"))


@query("V28", "SELECT entity_id, coalesce(CASE WHEN trim(coalesce(tuition_fee, '')) <> '' THEN tuition_fee END, CASE WHEN trim(website) <> '' THEN website END, total_students) AS v FROM fx_entity")
def first_meaningful(t):
    return t.fx_entity.select("entity_id", B.first_text(F.col("tuition_fee"), F.col("website"), F.col("total_students")).alias("v"))


@query(
    "V29",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS run_label, CAST(CAST(ts AS DATE) - 30 AS DATE) AS window_start, ts < TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 4 HOUR AS older, CAST(year(ts) AS INTEGER) AS yr,
  CASE WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ' ELSE '' END || CAST((s % 3600) // 60 AS VARCHAR) || 'm ' || CAST(s % 60 AS VARCHAR) || 's' AS duration
FROM (SELECT event_id, ts, event_id * 997 // 1000 AS s FROM events) x""",
)
def date_labels(t):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id", B.run_label(F.col("ts")).alias("run_label"), B.days_before(F.to_date("ts"), 30).alias("window_start"),
        B.before(F.col("ts"), now, hours=4).alias("older"), F.year("ts").alias("yr"),
        B.duration_label(F.col("event_id") * 997).alias("duration"),
    )


@query(
    "V30",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(least(greatest(l_quantity / 40, 0.1), 0.98), 3) AS clamped, round(l_extendedprice / nullif(l_discount, 0), 4) AS ratio, l_extendedprice = floor(l_extendedprice) AS whole FROM lineitem""",
)
def clamped_numbers(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(B.clamp(F.col("l_quantity") / 40, 0.1, 0.98), 3).alias("clamped"),
        F.round(B.safe_ratio(F.col("l_extendedprice"), F.col("l_discount")), 4).alias("ratio"),
        B.is_whole(F.col("l_extendedprice")).alias("whole"),
    )
