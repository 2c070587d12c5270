"""Input views over the given tables; each text runs in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"]

VIEWS: dict[str, str] = {}

VIEWS["fx_country"] = """
SELECT n.n_nationkey AS country_id, n.n_name AS name, r.r_name AS continent,
       lower(replace(n.n_name, '_', '-')) AS slug
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
"""

VIEWS["fx_entity"] = """
SELECT c_custkey AS entity_id, replace(c_name, '#', ' ') AS name, lower(replace(c_name, '#', '-')) AS slug,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_nationkey END AS country_id,
       CASE WHEN c_custkey % 2 = 0 THEN concat('https://www.', lower(replace(c_name, '#', '-')), '.edu/') ELSE '' END AS website,
       CASE c_custkey % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'completed' WHEN 3 THEN 'partial' ELSE 'failed' END AS status,
       c_custkey % 5 IN (2, 3) AS is_enriched,
       CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN '' ELSE c_mktsegment END AS tuition_fee,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey * 100 AS STRING) END AS total_students,
       CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey % 1700 END AS qs_ranking,
       repeat(concat(c_name, ' '), CAST(c_custkey % 30 AS INT)) AS description,
       (c_acctbal + 1000.0) / 11000.0 AS confidence_score,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 6 END AS crawl_attempts,
       c_custkey % 11 = 0 AS featured
FROM customer
"""

VIEWS["fx_program"] = """
SELECT DISTINCT o.o_custkey AS entity_id, p.p_name AS category,
       CASE p.p_type WHEN 'ECONOMY' THEN 'Undergraduate' WHEN 'PROMO' THEN 'Postgraduate' WHEN 'STANDARD' THEN 'PhD' ELSE 'Certificate' END AS level
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
"""

# Every part is a course; those outside twelve names carry a title of their own, so that some programs find none.
VIEWS["fx_course"] = """
SELECT p_partkey AS course_id, p_type AS field,
       CASE WHEN split_part(p_name, ' ', 1) IN ('small', 'hot', 'old') AND split_part(p_name, ' ', 2) IN ('widget', 'gear', 'anvil', 'ring') THEN p_name ELSE concat('Studies ', replace(p_brand, '#', ' ')) END AS title,
       CASE p_type WHEN 'ECONOMY' THEN 'Bachelor' WHEN 'PROMO' THEN 'Master' WHEN 'STANDARD' THEN 'PhD' ELSE 'Diploma' END AS level
FROM part
"""

VIEWS["fx_perf_raw"] = """
SELECT concat('https://site.example.com',
              CASE user_id % 5 WHEN 0 THEN '/study-in-c' WHEN 1 THEN '/courses/c' WHEN 2 THEN '/programs/universities/c' WHEN 3 THEN '/blog/c' ELSE '/study-law-in-c' END,
              CAST(user_id AS STRING)) AS url,
       CAST(floor((day(ts) - 1) / 10) AS INT) AS run_no,
       user_id % 2 = 0 AS meta_rewritten,
       CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
       CAST(SUM(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END) AS BIGINT) AS impressions
FROM events GROUP BY 1, 2, 3
"""

VIEWS["fx_perf"] = """
SELECT url, run_no, meta_rewritten, clicks, impressions,
       CAST(clicks AS DOUBLE) / nullif(CAST(impressions AS DOUBLE), 0) AS ctr
FROM fx_perf_raw
"""

VIEWS["fx_crawl"] = """
SELECT event_id, ts, concat('d', CAST(user_id AS STRING), '.example.org') AS domain,
       CASE WHEN event_type <> 'error' AND event_type <> 'view' THEN 200 WHEN value < 80 THEN 403 WHEN value < 160 THEN NULL ELSE 500 END AS status_code,
       CASE WHEN (event_type = 'error' OR event_type = 'view') AND value >= 80 AND value < 160 THEN 'ETIMEDOUT' ELSE NULL END AS error
FROM events
"""

VIEWS["fx_source"] = """
SELECT entity_id, concat('s', CAST(src_no AS STRING)) AS source, src_no, round(0.95 - src_no * 0.01, 2) AS confidence, country, city, acceptance_rate
FROM (SELECT l_orderkey AS entity_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate, l_extendedprice) AS INT) AS src_no,
       CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS country,
       CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE l_linestatus END AS city,
       CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE l_quantity END AS acceptance_rate
FROM lineitem) x
"""

VIEWS["fx_ranking"] = """
SELECT c_custkey AS line_no,
       CASE WHEN c_custkey % 4 = 0 THEN concat(upper(replace(c_name, '#', '-')), ' (X)') WHEN c_custkey % 4 = 1 THEN concat('The ', replace(c_name, '#', ' ')) ELSE concat('Other ', c_name) END AS institution_name,
       CAST(c_custkey % 1500 + 1 AS STRING) AS rank
FROM customer WHERE c_custkey % 4 < 3
"""

VIEWS["fx_alias"] = """
SELECT replace(c_name, '#', ' ') AS db_name,
       CASE c_custkey % 12 WHEN 1 THEN concat('The ', replace(c_name, '#', ' ')) WHEN 5 THEN concat('the ', replace(c_name, '#', '-'), ' (alias)') ELSE concat('Missing ', c_name) END AS target
FROM customer WHERE c_custkey % 4 = 1
"""

VIEWS["fx_response"] = """
SELECT doc_id, concat(CASE WHEN doc_id % 2 = 0 THEN '```json' ELSE 'Here you go: ' END, chr(10), '{"title": "Doc ', CAST(doc_id AS STRING), ' guide | Brand", "tags": ["', lang, '", "', source, '"', CASE doc_id % 3 WHEN 0 THEN ',]}' WHEN 1 THEN ']}' ELSE '' END, CASE WHEN doc_id % 2 = 0 THEN concat(chr(10), '```') ELSE '' END) AS raw
FROM documents
"""

# A full record with list fields as texts joined by ';' ('' = no member).
VIEWS["fx_record"] = """
SELECT e.entity_id, e.name, e.country_id, e.website, e.status, e.is_enriched, e.crawl_attempts,
       e.description, c.name AS country, e.tuition_fee, e.total_students, e.qs_ranking,
       CASE WHEN e.entity_id % 4 = 1 THEN NULL WHEN e.entity_id % 4 = 2 THEN '' ELSE concat('City ', CAST(e.entity_id % 50 AS STRING)) END AS city,
       CASE WHEN e.entity_id % 5 = 0 THEN NULL WHEN e.entity_id % 5 = 1 THEN 0.05 ELSE (e.entity_id % 130) * 1.0 END AS acceptance_rate,
       CASE e.entity_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Sept. 2025;Jan' WHEN 2 THEN 'Fall;Spring;Fall' ELSE 'Oct' END AS intakes_text,
       CASE e.entity_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'Transcript;transcript ;CV' WHEN 2 THEN 'Form;Passport copy;References;Essay' ELSE 'Transcripts;Statement;Passport' END AS requirements_text,
       CASE WHEN e.entity_id % 3 = 0 THEN '' ELSE concat('Peer ', CAST(e.entity_id % 7 AS STRING), ';Peer X') END AS similar_text
FROM fx_entity e LEFT JOIN fx_country c ON e.country_id = c.country_id
"""

# Programs per record after the level vocabulary check, as counts.
VIEWS["fx_program_count"] = """
SELECT entity_id, CAST(COUNT(*) AS INT) AS n_programs FROM fx_program GROUP BY entity_id
"""

# Links on a site page: page urls of one host, some known to fail.
VIEWS["fx_failed_page"] = """
SELECT url FROM pages WHERE page_id % 4 = 1
"""

# Candidate urls with many kinds of paths and queries.
VIEWS["fx_link"] = """
SELECT page_id, url AS base,
       concat(url, CASE page_id % 20 WHEN 0 THEN '/admissions/apply' WHEN 1 THEN '/courses/mba' WHEN 2 THEN '/news/2024' WHEN 3 THEN '/about-us' WHEN 4 THEN '/fees.pdf'
              WHEN 5 THEN '/international/scholarships' WHEN 6 THEN '/staff/directory' WHEN 7 THEN '/undergraduate/programs' WHEN 8 THEN '/blog/tag/campus' WHEN 9 THEN '/phd'
              WHEN 10 THEN '/faculty/academic' WHEN 11 THEN '/login' WHEN 12 THEN '/postgraduate/master' WHEN 13 THEN '/admissions/news' WHEN 14 THEN '/gallery' WHEN 15 THEN '/tuition-fees/costs'
              WHEN 16 THEN '/category/programs' WHEN 17 THEN '/apply/requirements' WHEN 18 THEN '/events/calendar' ELSE '/contact' END) AS link
FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages) p
"""

VIEWS["fx_image"] = """
SELECT entity_id, pos, concat('https://cdn.example.com/', CASE (entity_id + pos * (entity_id % 3)) % 12 WHEN 0 THEN 'site-logo.png' WHEN 1 THEN 'campus-aerial.jpg' WHEN 2 THEN 'lecture.webp'
         WHEN 3 THEN 'main-building.JPG' WHEN 4 THEN 'favicon.ico' WHEN 5 THEN 'tower.gif' WHEN 6 THEN 'photo.jpeg' WHEN 7 THEN 'crest.svg' WHEN 8 THEN 'image?id=9' WHEN 9 THEN 'hall.svg' WHEN 10 THEN 'thumbnail.png' ELSE 'library.png' END,
         CASE WHEN pos > 2 THEN concat('?v=', CAST(pos AS STRING)) ELSE '' END) AS url,
       CASE WHEN (entity_id + pos) % 9 < 4 THEN 'text/html' ELSE 'image/png' END AS content_type,
       CASE WHEN (entity_id + pos) % 5 < 3 THEN 1200 WHEN (entity_id + pos) % 5 = 3 THEN NULL ELSE 90000 END AS content_length
FROM (SELECT o_custkey AS entity_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS pos FROM orders) x
"""

VIEWS["fx_call"] = """
SELECT event_id, ts, concat('m', CAST(user_id AS STRING)) AS key,
       CASE WHEN event_type = 'purchase' THEN 'ok' WHEN event_type = 'signup' THEN 'limited' ELSE 'failed' END AS result,
       CASE WHEN event_id % 3 = 0 THEN event_id % 90 * 1000 ELSE 0 END AS retry_after_ms
FROM events
"""


# Untidy values of many kinds, one set per customer.
VIEWS["fx_messy"] = """
SELECT c_custkey AS id,
  CASE c_custkey % 9 WHEN 0 THEN 'USA' WHEN 1 THEN 'uk ' WHEN 2 THEN ' England' WHEN 3 THEN 'U.S.' WHEN 4 THEN ' Germany ' WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'Czech Rep' ELSE 'People''s Republic of China' END AS raw_country,
  concat(CASE c_custkey % 11 WHEN 0 THEN 'Springfield Community College' WHEN 1 THEN 'Massachusetts Institute of Technology' WHEN 2 THEN 'Technical University of X' WHEN 3 THEN 'Boston College' WHEN 4 THEN 'School of Arts' WHEN 5 THEN 'Royal Academy' WHEN 6 THEN 'Trinity College, University of Y' WHEN 7 THEN 'Z Seminary' WHEN 8 THEN 'City Polytechnic' WHEN 9 THEN 'Foo (Bar) Institute' ELSE 'Plain University' END,
         CASE WHEN c_custkey % 2 = 0 THEN '' ELSE concat(' ', CAST(c_custkey AS STRING)) END) AS raw_name,
  CASE c_custkey % 13 WHEN 0 THEN 'Under graduate' WHEN 1 THEN 'BSc (Hons)' WHEN 2 THEN 'MBA' WHEN 3 THEN 'Master of Arts' WHEN 4 THEN ' PhD' WHEN 5 THEN 'D.Phil' WHEN 6 THEN 'Diploma' WHEN 7 THEN 'cert III' WHEN 8 THEN 'BA ' WHEN 9 THEN 'ba in X' WHEN 10 THEN 'ma' WHEN 11 THEN 'other' ELSE NULL END AS raw_level,
  CASE c_custkey % 10 WHEN 0 THEN 'Sept. 2025' WHEN 1 THEN 'jan/feb' WHEN 2 THEN 'Fall' WHEN 3 THEN ' 5 ' WHEN 4 THEN 'DEC intake' WHEN 5 THEN 'March' WHEN 6 THEN 'Sep' WHEN 7 THEN NULL WHEN 8 THEN 'mar 1 and mar 2' ELSE 'Oct. or nov.' END AS raw_intake,
  CASE c_custkey % 8 WHEN 0 THEN '#47' WHEN 1 THEN 'Rank 200' WHEN 2 THEN '1501' WHEN 3 THEN '0' WHEN 4 THEN 'abc' WHEN 5 THEN '2,000' WHEN 6 THEN concat('no. ', CAST(c_custkey AS STRING)) ELSE NULL END AS raw_rank,
  CASE c_custkey % 9 WHEN 0 THEN '45%' WHEN 1 THEN '0.45' WHEN 2 THEN '0.0005%' WHEN 3 THEN '101' WHEN 4 THEN 'n/a' WHEN 5 THEN '12.5 percent' WHEN 6 THEN '1' WHEN 7 THEN '1.2.3' ELSE NULL END AS raw_rate,
  CASE c_custkey % 8 WHEN 0 THEN concat('https://www.U', CAST(c_custkey AS STRING), '.ac.UK/path/') WHEN 1 THEN 'http://x.edu' WHEN 2 THEN 'https://uni.de:8443/a?b=1' WHEN 3 THEN 'not a url' WHEN 4 THEN 'https://a.b.xyz/' WHEN 5 THEN 'https://site.in#top' WHEN 6 THEN '' ELSE 'ftp://files.ac.jp/x' END AS raw_url
FROM customer
"""

# Proposed titles of many lengths and endings; the whole text as description.
VIEWS["fx_title"] = """
SELECT doc_id, concat('Doc ', CAST(doc_id AS STRING)) AS name,
       concat(CASE WHEN doc_id % 3 = 0 THEN 'About Doc ' ELSE 'doc ' END, CAST(doc_id AS STRING), ' ', source, ' in ', lang,
              CASE doc_id % 9 WHEN 0 THEN ' | Good Brand' WHEN 1 THEN ' | Good' WHEN 2 THEN ' |' WHEN 3 THEN ' -' WHEN 4 THEN ' | Other' WHEN 5 THEN ' with a rather long tail of words that runs on' WHEN 6 THEN ' and a somewhat longer title | Good Brand' WHEN 7 THEN ' with far too many words to be cut in any sensible way by anyone who cares at all' ELSE '' END) AS title,
       concat('All on Doc ', CAST(doc_id % 50 AS STRING), ': ', replace(text, chr(10), ' ')) AS description
FROM documents
"""


# Home pages with navigation, outside links and links of every kind.
# Index files of five maps a site: one names itself and a further index, that one names the first again.
_INDEX_LINKS = [("i", "i", 0), ("i", "n", 0), ("i", "gone", 0), ("n", "i", 0), ("n", "x", 0), ("x", "n", 1)]
VIEWS["fx_submap"] = "\nUNION ALL ".join([
    """
SELECT DISTINCT concat(CASE WHEN m % 5 = 4 THEN 'n' ELSE 'i' END, CAST(site AS STRING)) AS source, concat('p', CAST(m AS STRING)) AS loc
FROM (SELECT CAST(floor(page_id / 20) AS BIGINT) AS m, CAST(floor(page_id / 100) AS BIGINT) AS site FROM pages) a""",
    *(
        f"SELECT DISTINCT concat('{f}', CAST(site AS STRING)) AS source, concat('{to}', CAST(site + {more} AS STRING)) AS loc FROM (SELECT CAST(floor(page_id / 100) AS BIGINT) AS site FROM pages) b"
        for f, to, more in _INDEX_LINKS
    ),
])

VIEWS["fx_home"] = """
SELECT page_id, url, concat('<html lang="en"><body><nav><a href="/about-us">A</a> <a class="x" href="/Courses/mba/">C</a></nav><p><a href="mailto:x@y.org">M</a> <a href="#top">T</a> <a href="',
  CASE page_id % 6 WHEN 0 THEN '/admissions/apply?utm_source=nav' WHEN 1 THEN '/news/today' WHEN 2 THEN '/tuition-fees/' WHEN 3 THEN '/fees.pdf' WHEN 4 THEN '/phd?page=2&ref=z' ELSE '/contact' END,
  '">x</a> <a href="https://other.example.org/apply">o</a> <a href="/about-us#team">again</a></p>', CASE WHEN page_id % 5 = 0 THEN '' ELSE html END) AS html
FROM pages
"""


def expand(sql: str) -> str:
    """Prefix a query with the views it names, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    body = sql.strip()
    for head in ("WITH RECURSIVE", "WITH"):
        if body.upper().startswith(head):
            return f"{head} {ctes},\n{body[len(head):]}"
    return f"WITH {ctes}\n{body}"


class Tables:
    """The given tables and views of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        if name in VIEWS:
            sql = expand(f"SELECT * FROM {name}")
            for t in BASE:
                if re.search(rf"\b{t}\b", sql):
                    getattr(self, t).createOrReplaceTempView(t)
            return self.spark.sql(sql)
        raise AttributeError(name)

    def record(self) -> DataFrame:
        """``fx_record`` with real list columns and its programs."""
        r = self.fx_record
        cores = self.spark.sparkContext.defaultParallelism
        if self.customer.rdd.getNumPartitions() < cores:
            r = r.repartition(cores, "entity_id")
        for c, src in {"intakes": "intakes_text", "admission_requirements": "requirements_text", "similar_universities": "similar_text"}.items():
            r = r.withColumn(c, F.filter(F.split(src, ";"), lambda x: x != "")).drop(src)
        programs = self.fx_program.groupBy("entity_id").agg(
            F.array_sort(F.collect_list(F.struct("category", "level"))).alias("programs")
        )
        return r.join(programs, "entity_id", "left").withColumn(
            "programs", F.coalesce("programs", F.array().cast("array<struct<category:string,level:string>>"))
        )

