"""Page texts, links, discovery, sitemaps, landed files."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusloom import rules
from campusloom.functions import hashing, text as X, urls as U
from campusloom.operators import matching as M, pages as H, ranking
from campusloom.plans import discovery, performance
from campusloom.session import spread, work_folder
from campusloom.sources import readers, tables as S
from registry.base import query
from registry.matching import _BY
from registry.reports import _PRIO
from registry.scalars import _HIT, _additive, _first

_STARTS = "|".join([*rules.BOILERPLATE_STARTS, *rules.BOILERPLATE_SITES])


def _kept(text: str, limit: int | None) -> str:
    """Boilerplate filter written out."""
    trimmed = r"regexp_replace(l, '^\s+|\s+$', '', 'g')"
    lines = f"array_to_string(list_filter(string_split({text}, chr(10)), lambda l: NOT (length({trimmed}) < 3 OR regexp_matches({trimmed}, '(?i)^(?:{_STARTS})') OR regexp_matches({trimmed}, '{rules.SEPARATOR_LINE}'))), chr(10))"
    flat = rf"regexp_replace(regexp_replace(replace({lines}, chr(9), ' '), ' {{3,}}', ' ', 'g'), '\n{{4,}}', repeat(chr(10), 3), 'g')"
    out = rf"regexp_replace({flat}, '^\s+|\s+$', '', 'g')"
    return out if limit is None else f"left({out}, {limit})"


@query("P9", f"SELECT doc_id, {_kept('text', None)} AS body FROM documents")
def content_lines(t):
    return spread(t.documents.select("doc_id", "text")).select("doc_id", X.drop_boilerplate(F.col("text")).alias("body"))


_ART = r"""replace(replace(regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&')"""
_AD = r"""replace(replace(regexp_extract(html, '(?s)<div class="ad">(.*?)</div>', 1), '&quot;', '"'), '&amp;', '&')"""


@query("H1 H7", f"SELECT page_id, body AS cleaned_text, length(body) < 400 AS thin FROM (SELECT page_id, {_kept(f'CASE WHEN length({_ART}) > 200 THEN {_ART} ELSE {_AD} || {_ART} END', None)} AS body FROM pages) x")
def page_texts(t):
    c = H.clean_pages(spread(t.pages.select("page_id", "html")))
    return c.select("page_id", "cleaned_text", X.is_thin(F.col("cleaned_text")).alias("thin"))


@query(
    "P10",
    r"""SELECT page_id, CASE WHEN l <> '' AND NOT starts_with(l, 'en') THEN split_part(l, '-', 1) WHEN regexp_matches(b, '[\x{4e00}-\x{9fff}]') THEN 'zh' WHEN regexp_matches(b, '[\x{0600}-\x{06ff}]') THEN 'ar' WHEN regexp_matches(b, '[\x{0400}-\x{04ff}]') THEN 'ru' END AS lang
FROM (SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS l, regexp_replace(html, '<[^>]*>', ' ', 'g') AS b FROM pages) x""",
)
def page_languages(t):
    return t.pages.select("page_id", X.page_language(H.html_lang(F.col("html")), F.regexp_replace("html", "<[^>]*>", " ")).alias("lang"))


@query("P10", r"SELECT doc_id, length(text) >= 100 AND regexp_matches(text, '[\x{4e00}-\x{9fff}\x{0600}-\x{06ff}\x{0400}-\x{04ff}]') AS foreign_script FROM documents")
def foreign_scripts(t):
    return t.documents.select("doc_id", X.is_non_english(F.col("text")).alias("foreign_script"))


_ORIGIN = r"regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
_ENC = "array_to_string(list_transform(regexp_extract_all({p}, '[!#-;=?-_a-z|~]+|[^!#-;=?-_a-z|~]+'), lambda r: CASE WHEN regexp_matches(r, '^[!#-;=?-_a-z|~]') THEN r ELSE replace(url_encode(r), '+', '%20') END), '')"
_HREFS = r"""(SELECT page_id, url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM (SELECT page_id, url, regexp_extract_all({html}, '<a[^>]*?href="([^"]*)"', 1) AS hrefs FROM {src}) h)"""
_RESOLVED = "CASE WHEN regexp_matches(href, '^[a-z]+://') THEN href WHEN starts_with(href, '/') THEN {o} || {e} || regexp_extract(href, '([?#].*)$', 1) END".format(
    o=_ORIGIN, e=_ENC.format(p="regexp_extract(href, '^([^?#]*)', 1)")
)


@query("H2", f"SELECT page_id, pos, href, {_RESOLVED} AS link FROM {_HREFS.format(html='html', src='pages')} x")
def page_links(t):
    return H.links(t.pages, ["page_id"]).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "link")


@query("P11", f"SELECT page_id, pos FROM {_HREFS.format(html='html', src='fx_home')} x WHERE NOT regexp_matches(href, '^(mailto:|tel:|javascript:|#)') AND starts_with(href, '/')")
def followable_links(t):
    l = H.links(t.fx_home, ["page_id"]).filter(U.is_followable(F.col("href")) & U.same_site(F.col("link"), F.col("url")))
    return l.select("page_id", F.col("pos").cast("long").alias("pos"))


@query("H3", """SELECT entity_id AS page_id, pos, url AS image_url FROM (SELECT entity_id, url, MIN(pos) AS pos FROM fx_image GROUP BY 1, 2) x""")
def page_images(t):
    tags = t.fx_image.groupBy("entity_id").agg(F.array_sort(F.collect_list(F.struct("pos", "url"))).alias("i"))
    attrs = ["src", "data-src", "data-lazy-src", "data-original"]
    rows = F.transform("i", lambda x: F.concat(F.lit("<img alt='' "), F.element_at(F.array(*map(F.lit, attrs)), x["pos"] % 4 + 1), F.lit('="'), F.regexp_replace(x["url"], "^https:", ""), F.lit('">')))
    html = F.concat(F.lit('<p><img src="data:image/png;base64,xx"></p>'), F.array_join(rows, " "))
    pages = tags.select(F.col("entity_id").alias("page_id"), F.lit("https://www.x.org/a/b").alias("url"), html.alias("html"))
    out = H.images(pages, ["page_id"])
    # The data image stands first.
    return out.select("page_id", (F.col("pos") - 1).alias("pos"), "image_url")


def _score(url: str) -> str:
    hit = _HIT.replace("(p,", f"(lower(regexp_extract({url}, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1)),").replace("(l,", f"(lower({url}),")
    return f"greatest({_additive(hit, rules.LINK_SCORES)}, -999)"


def _clean(url: str) -> str:
    q = f"array_to_string(list_filter(string_split(regexp_extract({url}, '\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_source|utm_medium|utm_campaign|ref|source)(=|$)')), '&')"
    return f"regexp_replace(regexp_extract({url}, '^([^?#]*)', 1) || CASE WHEN {q} = '' THEN '' ELSE '?' || {q} END, '/$', '')"


def _norm(url: str) -> str:
    return f"regexp_replace(lower(regexp_extract({url}, '^([^?#]*)', 1)), '/$', '')"


_SITE = "(SELECT page_id, regexp_replace(url, '/$', '') AS url, html FROM fx_home) s"
_DISC = f"""
WITH RECURSIVE seen AS MATERIALIZED (SELECT page_id, pos, href, {_RESOLVED} AS link, url FROM {_HREFS.format(html='html', src=_SITE)} x WHERE NOT regexp_matches(href, '^(mailto:|tel:|javascript:|#)')),
cand AS (SELECT page_id, pos, link, {_score('link')} AS score, {_clean('link')} AS page FROM seen WHERE starts_with(link, regexp_extract(url, '^([a-z]+://[^/?#]+)', 1))
  UNION ALL SELECT page_id, -1, url, {_score('url')}, url FROM {_SITE}),
found AS MATERIALIZED (SELECT page_id, pos, page, norm, {_score('page')} AS score FROM (SELECT *, row_number() OVER (PARTITION BY page_id, norm ORDER BY score DESC, pos) AS k FROM (SELECT *, {_norm('link')} AS norm FROM cand WHERE score >= 0 OR pos = -1) a) b WHERE k = 1),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS rank FROM found WHERE score >= 0) a WHERE rank <= 12),
good AS (SELECT * FROM top WHERE page NOT IN (SELECT regexp_replace(url, '/$', '') FROM fx_failed_page)),
extra AS (SELECT page_id, page, score, pos FROM (SELECT *, row_number() OVER (PARTITION BY page_id, norm ORDER BY pos) AS k FROM (SELECT n.page_id, pos, {_clean('link')} AS page, {_score('link')} AS score, {_norm('link')} AS norm FROM
   (SELECT page_id, pos, {_RESOLVED} AS link FROM {_HREFS.format(html="regexp_extract(html, '(?s)^.*?<nav>(.*?)</nav>', 1)", src=_SITE)} y) n WHERE page_id NOT IN (SELECT page_id FROM good GROUP BY page_id HAVING COUNT(*) >= 3)) a
   WHERE score >= 30 AND NOT EXISTS (SELECT 1 FROM found f WHERE f.page_id = a.page_id AND f.norm = a.norm)) b WHERE k = 1),
every AS (SELECT page_id, page, score, 0 AS part, rank AS seq FROM good UNION ALL SELECT page_id, page, score, 1, pos FROM extra)
SELECT page_id, page, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY part, seq, page) AS rank FROM every) z WHERE rank <= 12"""


@query("H4 V8 W1 W2 J5", _DISC)
def discovered_pages(t):
    failed = t.fx_failed_page.select(hashing.url_key(F.regexp_replace("url", "/$", "")).alias("url_hash"))
    return H.discover_pages(spread(t.fx_home), failed)


_HOSTKEY = r"regexp_replace(regexp_extract(url, '://([^/?#:]+)', 1), '^www\.', '')"


@query(
    "H5 S6 V9",
    f"""SELECT site, url, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, url) AS rank FROM
 (SELECT site, url, score, row_number() OVER (PARTITION BY site, {_norm('url')} ORDER BY url) AS k FROM (SELECT DISTINCT CAST(floor(page_id / 20) AS BIGINT) AS site, link AS url, {_first('lower(link)', rules.SITEMAP_SCORES, 5)} AS score FROM fx_link) a WHERE score >= 0) b WHERE k = 1) c
WHERE rank <= 12 AND url NOT IN (SELECT url FROM fx_failed_page)""",
)
def sitemap_selection(t):
    """Sitemap files of up to 20 links each, landed and read back as XML."""
    folder = work_folder(t.spark)
    entry = F.concat(F.lit("<url><loc>"), F.replace("link", F.lit("&"), F.lit("&amp;")), F.lit("</loc></url>"))
    maps = t.fx_link.groupBy(F.floor(F.col("page_id") / 20).alias("site")).agg(
        F.concat(F.lit("<urlset>"), F.array_join(F.sort_array(F.collect_list(entry)), ""), F.lit("</urlset>")).alias("value")
    )
    maps.write.partitionBy("site").text(folder)
    read = readers.read_sitemaps(t.spark, folder).withColumn("site", F.regexp_extract("source", "site=([0-9]+)", 1).cast("long"))
    failed = t.fx_failed_page.select(hashing.url_key(F.col("url")).alias("url_hash"))
    return H.select_sitemap(read, failed, "site", "loc", "loc", 12).select("site", F.col("loc").alias("url"), "score", "rank")


_CHAIN = """(WITH RECURSIVE reach AS (
  SELECT DISTINCT CAST(floor(page_id / 100) AS BIGINT) AS site, 'i' || CAST(CAST(floor(page_id / 100) AS BIGINT) AS VARCHAR) AS source, 0 AS depth FROM pages
  UNION SELECT r.site, s.loc, r.depth + 1 FROM reach r JOIN fx_submap s ON s.source = r.source WHERE r.depth < 2)
SELECT site, source, depth, link AS url FROM (SELECT site, source, MIN(depth) AS depth FROM reach GROUP BY ALL) r
JOIN (SELECT 'p' || CAST(CAST(floor(page_id / 20) AS BIGINT) AS VARCHAR) AS source, link FROM fx_link) e USING (source))"""


def _landed_chain(t):
    """Index files and maps of 20 links each, landed and read back as XML, followed from the index of each site."""
    folder = work_folder(t.spark)
    tagged = lambda tag, loc: F.concat(F.lit(f"<{tag}><loc>"), F.replace(loc, F.lit("&"), F.lit("&amp;")), F.lit(f"</loc></{tag}>"))
    inside = lambda body: F.array_join(F.sort_array(F.collect_list(body)), "")
    named = lambda tag, body: F.concat(F.lit(f"<{tag}>"), body, F.lit(f"</{tag}>")).alias("value")
    maps = t.fx_link.withColumn("map", F.concat(F.lit("p"), F.floor(F.col("page_id") / 20).cast("string")))
    maps.groupBy("map").agg(named("urlset", inside(tagged("url", "link")))).write.partitionBy("map").text(f"{folder}/maps")
    t.fx_submap.groupBy(F.col("source").alias("map")).agg(named("sitemapindex", inside(tagged("sitemap", "loc")))).write.partitionBy("map").text(f"{folder}/index")

    def read(part: str, tag: str):
        return readers.read_sitemaps(t.spark, f"{folder}/{part}", tag).withColumn("source", F.regexp_extract("source", "map=([a-z0-9]+)", 1))

    site = F.floor(F.col("page_id") / 100).cast("long")
    roots = t.pages.select(site.alias("site"), F.concat(F.lit("i"), site.cast("string")).alias("source"))
    return readers.sitemap_chain(read("index", "sitemap"), read("maps", "url"), roots)


@query("S6", f"SELECT site, source, depth, url FROM {_CHAIN} c")
def sitemap_chain(t):
    return _landed_chain(t).select("site", "source", "depth", F.col("loc").alias("url"))


@query(
    "H5 S6",
    f"""SELECT site, url, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY score DESC, url) AS rank FROM
 (SELECT site, url, score, row_number() OVER (PARTITION BY site, {_norm('url')} ORDER BY url) AS k FROM (SELECT DISTINCT site, url, {_first('lower(url)', rules.SITEMAP_SCORES, 5)} AS score FROM {_CHAIN} d) a WHERE score >= 0) b WHERE k = 1) c
WHERE rank <= 30 AND url NOT IN (SELECT url FROM fx_failed_page)""",
)
def sitemap_chain_selection(t):
    """Best links of all maps that the index of a site reaches."""
    failed = t.fx_failed_page.select(hashing.url_key(F.col("url")).alias("url_hash"))
    return H.select_sitemap(_landed_chain(t), failed, "site", "loc", "loc", 30).select("site", F.col("loc").alias("url"), "score", "rank")


@query(
    "H6",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN round(l_tax * 100, 1) END AS acceptance_rate, CAST(l_partkey AS VARCHAR) || ',000' AS total_students, CASE WHEN l_suppkey % 3 = 0 THEN 'USD ' || CAST(l_suppkey AS VARCHAR) || ',500/year' END AS tuition_fee FROM lineitem""",
)
def page_facts(t):
    rate = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit('<td class="acceptance rate">'), F.round(F.col("l_tax") * 100, 1).cast("string"), F.lit("%</td>"))).otherwise("")
    fee = F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("<b>Tuition</b>: <i id='tuition'>$"), F.col("l_suppkey").cast("string"), F.lit(",500</i>"))).otherwise("")
    html = F.concat(F.lit("<table>"), rate, F.lit("<td data-x='Enrollment'>"), F.col("l_partkey").cast("string"), F.lit(",000 students</td>"), fee)
    cols = H.facts(F.col("html"))
    return t.lineitem.withColumn("html", html).select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(n) for n, c in cols.items()])


@query("E1 W6 W9 H1", None)
def site_contents(t):
    """Discovery to content text per site; its parts are checked one by one."""
    homes = t.fx_home.select(F.col("page_id").alias("site"), "url", "html")
    sitemap = t.fx_link.select(F.col("page_id").alias("site"), F.col("link").alias("page"))
    failed = t.fx_failed_page.select(hashing.url_key(F.col("url")).alias("url_hash"))
    chosen = discovery.pages_to_read(homes, sitemap, failed)
    crawled = t.pages.select(F.regexp_replace("url", "/$", "").alias("url"), "html").dropDuplicates(["url"])
    home = homes.select("site", F.regexp_replace("url", "/$", "").alias("page"), F.lit(0).alias("rank"))
    return discovery.site_content(chosen.select("site", "page", "rank").unionByName(home), crawled)


# --- landed files ---------------------------------------------------------

@query("S2", f"SELECT norm, o AS institution_name, r AS rank FROM {_BY} x")
def ranking_file(t):
    """A ranking list written as CSV and read back; the first line of a name wins."""
    folder = work_folder(t.spark)
    t.fx_ranking.orderBy("line_no").select(
        F.concat(F.lit(" "), F.col("institution_name"), F.lit(" ")).alias("Institution Name"), F.col("rank").alias("2025 Rank")
    ).write.option("header", True).csv(folder)
    r = readers.read_ranking(t.spark, folder).withColumn("norm", X.normalize_name(F.col("institution_name")))
    return M.first_per_key(r, ["norm"], ["line_no"]).select("norm", "institution_name", "rank")


@query("S3 V7", "SELECT url, clicks, impressions, round(round(ctr * 100, 1) / 100, 6) AS ctr, 3.5 AS position, 'run-zero' AS run_label FROM fx_perf WHERE run_no = 0")
def click_report_csv(t):
    folder = work_folder(t.spark)
    t.fx_perf.filter("run_no = 0").select(
        F.col("url").alias("Top pages"), F.col("clicks").alias("Clicks"), F.col("impressions").alias("Impressions"),
        F.concat(F.round(F.col("ctr") * 100, 1).cast("string"), F.lit("%")).alias("CTR"), F.lit("3.5").alias("Position"),
    ).write.option("header", True).csv(folder)
    r = readers.read_perf_csv(t.spark, folder)
    return r.select("url", "clicks", "impressions", F.round("ctr", 6).alias("ctr"), "position", "run_label")


@query("S4", "SELECT url, clicks, impressions, round(ctr, 6) AS ctr FROM fx_perf")
def click_report_pages(t):
    """Result pages of a few rows each, landed as JSON."""
    folder = work_folder(t.spark)
    row = F.struct(F.array("url").alias("keys"), F.col("clicks").cast("double").alias("clicks"), F.col("impressions").cast("double").alias("impressions"), "ctr", F.lit(1.0).alias("position"))
    t.fx_perf.groupBy(F.pmod(F.hash("url"), F.lit(16)).alias("b"), "run_no").agg(F.collect_list(row).alias("rows")).select("rows").write.json(folder)
    r = readers.perf_rows(t.spark.read.schema(readers.PERF_PAGE_SCHEMA).json(folder))
    return r.select("url", "clicks", "impressions", F.round("ctr", 6).alias("ctr"))


@query("S7 W3", f"SELECT rank, slug, url FROM {_PRIO} p WHERE rank <= 40")
def stored_priorities(t):
    from pyspark.sql import Window as W

    folder = work_folder(t.spark)
    top = ranking.ctr_priorities(performance.with_page_class(t.fx_perf), "run_no", "run_no", 40)
    order = W.orderBy(F.asc("ctr"), F.desc("impressions"), "url")  # 40 rows
    S.write_priorities(top.withColumn("rank", F.row_number().over(order)), folder)
    return S.read_priorities(t.spark, folder).select("rank", "slug", "url")


@query("S8 A5", "SELECT p_name AS category, COUNT(*) AS n FROM part GROUP BY 1")
def stored_report(t):
    folder = work_folder(t.spark)
    raw = t.part.select(F.col("p_partkey").alias("entity_id"), F.col("p_name").alias("category"))
    S.write_report(raw, raw.groupBy("category").agg(F.count(F.lit(1)).alias("n")), folder)
    return t.spark.read.parquet(f"{folder}/report")


@query("S9 T8", "SELECT url, run_no, clicks + CASE WHEN run_no = 1 THEN 5 ELSE 0 END AS clicks FROM fx_perf")
def stored_upserts(t):
    """Runs 0-2 stored, run 1 upserted: only its partition is rewritten."""
    folder = work_folder(t.spark)
    p = t.fx_perf.select("url", "run_no", "clicks")
    S.write_upsert(p, folder, ["url", "run_no"], "run_no")
    S.write_upsert(p.filter("run_no = 1").withColumn("clicks", F.col("clicks") + 5), folder, ["url", "run_no"], "run_no")
    return t.spark.read.parquet(folder).select("url", "run_no", "clicks")
