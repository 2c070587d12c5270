"""Crawled pages: text, links, images, facts and the choice of what to read."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from campusloom import rules
from campusloom.functions.basics import bound
from campusloom.functions.hashing import url_key
from campusloom.functions.text import drop_boilerplate
from campusloom.functions.urls import (
    absolute, bare_host, clean_url, is_followable, link_score, normal_url, path_key, sitemap_score,
)
from campusloom.operators.joins import without_failed
from campusloom.operators.ranking import best_per_key, top_per_group
from campusloom.session import durable

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Reader(HTMLParser):
    """Collects body text and main-content text outside noise elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, bool]] = []  # tag, is noise, is main content
        self.noise = self.main = 0
        self.head = False
        self.body_parts: list[str] = []
        self.main_parts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "title"):
            self.head = tag == "head" or self.head
        if tag == "body":
            self.head = False
        if tag in _VOID:
            return
        noise, main = _is_noise(tag, dict(attrs)), tag in ("article", "main")
        self.stack.append((tag, noise, main))
        self.noise += noise
        self.main += main

    def handle_endtag(self, tag):
        if tag == "head":
            self.head = False
        if tag not in (t for t, _, _ in self.stack):
            return
        while self.stack:
            t, noise, main = self.stack.pop()
            self.noise -= noise
            self.main -= main
            if t == tag:
                return

    def handle_data(self, data):
        if self.noise or self.head:
            return
        self.body_parts.append(data)
        if self.main:
            self.main_parts.append(data)


def _is_noise(tag: str, attrs: dict) -> bool:
    if tag in rules.NOISE_TAGS:
        return True
    names = (attrs.get("class") or "").split()
    ident = attrs.get("id") or ""
    return (
        any(n in rules.NOISE_CLASSES for n in names)
        or any(p in (attrs.get("class") or "") for p in rules.NOISE_CLASS_PARTS)
        or ident in rules.NOISE_IDS
        or any(p in ident for p in rules.NOISE_ID_PARTS)
    )


def page_text(html: str | None) -> str:
    """Main-content text if it is over 200 characters, else the body text."""
    if not html:
        return ""
    r = _Reader()
    r.feed(html)
    r.close()
    main = "".join(r.main_parts)
    return main if len(main) > 200 else "".join(r.body_parts)


def clean_pages(pages: DataFrame, html: str = "html", name: str = "cleaned_text", max_chars: int | None = None) -> DataFrame:
    """Add the readable text of each page.

    Only the html parser runs in Python, in Arrow batches; the line filters
    are columns.
    """
    keep = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType([*keep, T.StructField("__raw", T.StringType())])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = pdf[html].map(page_text)
            yield pdf.drop(columns=[html]).assign(__raw=text)

    out = pages.select(*[f.name for f in keep], html).mapInPandas(read, schema)
    return out.withColumn(name, drop_boilerplate(F.col("__raw"), max_chars)).drop("__raw")


def html_lang(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, r'(?is)<html\b[^>]*?\blang\s*=\s*["\']?([A-Za-z\-]+)', 1), F.lit(""))


# Values in either quotes or none; comments, scripts and styles hold no anchors.
_HREF = r"""(?is)<a(?=[\s/])[^>]*?[\s"'/]href\s*=\s*("[^"]*"|'[^']*'|[^\s"'<>]+)"""
_UNREAD = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def _decoded(value: Column) -> Column:
    """An attribute's value without quotes and with its entities decoded."""
    out = F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")
    for entity, char in rules.ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def _links(found: DataFrame, base: str) -> DataFrame:
    # Two steps, so that the full url is computed once per anchor.
    full = found.withColumn("__full", absolute(F.col("href"), F.col(base)))
    return full.withColumn("link", bound(F.col("__full"), normal_url)).drop("__full")


def links(pages: DataFrame, keys: list[str], base: str = "url", html: str = "html") -> DataFrame:
    """(keys, base, pos, href, url): every anchor with its absolute url."""
    hrefs = F.regexp_extract_all(F.regexp_replace(html, _UNREAD, ""), F.lit(_HREF), F.lit(1))
    found = pages.select(*keys, F.col(base), F.posexplode(hrefs).alias("pos", "href"))
    return _links(found.withColumn("href", _decoded(F.col("href"))), base)


class _NavReader(HTMLParser):
    """Collects the hrefs of anchors inside navigation elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool]] = []  # tag, is navigation
        self.inside = 0
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        named = dict(reversed(attrs))  # the first of repeated attributes counts
        if tag == "a" and self.inside and "href" in named:
            self.hrefs.append(named["href"] or "")
        if tag not in _VOID:
            nav = tag == "nav" or not rules.NAV_CLASSES.isdisjoint((named.get("class") or "").split())
            self.stack.append((tag, nav))
            self.inside += nav

    def handle_endtag(self, tag):
        if all(t != tag for t, _ in self.stack):
            return
        while self.stack:
            t, nav = self.stack.pop()
            self.inside -= nav
            if t == tag:
                return


def nav_hrefs(html: str | None) -> list[str]:
    r = _NavReader()
    r.feed(html or "")
    r.close()
    return r.hrefs


def nav_links(pages: DataFrame, keys: list[str], base: str = "url", html: str = "html") -> DataFrame:
    """Anchors inside navigation elements; these nest, so a parser reads them, in Arrow batches."""
    keep = pages.select(*keys, base, html)
    schema = T.StructType([*keep.drop(html).schema.fields, T.StructField("__hrefs", T.ArrayType(T.StringType()))])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.drop(columns=[html]).assign(__hrefs=pdf[html].map(nav_hrefs))

    read_pages = keep.mapInPandas(read, schema)
    return _links(read_pages.select(*keys, F.col(base), F.posexplode("__hrefs").alias("pos", "href")), base)


def images(pages: DataFrame, keys: list[str], base: str = "url", html: str = "html") -> DataFrame:
    """Distinct absolute image urls per page with their first position."""
    tags = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<(?:img|source)\b[^>]*>"), F.lit(0))
    attr = r'(?is)\s(?:src|data-src|data-lazy-src|data-original)\s*=\s*["\']([^"\']+)["\']'
    found = F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(t, F.lit(attr), F.lit(1))))
    return (
        pages.select(*keys, F.col(base), F.posexplode(found).alias("pos", "src"))
        .filter(~F.col("src").startswith("data:"))
        .withColumn("image_url", bound(absolute(F.col("src"), F.col(base)), normal_url))
        .filter(F.col("image_url").isNotNull())
        .groupBy(*keys, "image_url")
        .agg(F.min("pos").alias("pos"))
    )


def facts(html: Column) -> dict[str, Column]:
    """Acceptance rate, enrolment and tuition stated on a profile page."""

    def one(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))

    tuition = one(r"(?i)tuition[^>]*>\$?([\d,]+)")
    return {
        "acceptance_rate": one(r"(?i)acceptance[^>]*>([0-9.]+)%").try_cast("double"),
        "total_students": one(r"(?i)enrollment[^>]*>([\d,]+)"),
        "tuition_fee": F.when(tuition.isNotNull(), F.concat(F.lit("USD "), tuition, F.lit("/year"))),
    }


def discover_pages(homes: DataFrame, failed: DataFrame, key: str = "page_id", base: str = "url", n: int = 12, few: int = 3) -> DataFrame:
    """Best pages of each site found on its home page: (key, page, score, rank).

    Same-site links by additive score, one per normal form, known failures
    removed; a site left with few pages also gets its navigation links.
    """
    site = homes.withColumn(base, F.regexp_replace(base, "/$", ""))
    link = F.col("link")

    def scored(rows: DataFrame) -> DataFrame:
        return rows.select(
            key, "pos", bound(link, link_score).alias("score"), bound(link, clean_url).alias("page"),
            bound(link, path_key).alias("norm"),
        )

    seen = links(site, [key], base).filter(is_followable(F.col("href")))
    inside = seen.filter(F.coalesce(bound(link, bare_host) == bare_host(F.col(base)), F.lit(False)))
    home = site.select(
        key, F.lit(-1).alias("pos"), link_score(F.col(base)).alias("score"), F.col(base).alias("page"),
        path_key(F.col(base)).alias("norm"),
    )
    # Excluded links rank behind everything and go after the window, so that a
    # score is computed once; the home page counts as seen whatever its score.
    usable = (F.col("score") >= 0) | (F.col("pos") == -1)
    found = (
        best_per_key(home.unionByName(scored(inside)), [key, "norm"], [F.when(usable, F.col("score")).desc_nulls_last(), "pos"])
        .filter(usable)
        .withColumn("score", link_score(F.col("page")))
    )
    found = durable(found)  # read twice below; the html is parsed once
    top = top_per_group(found, [key], [F.desc("score"), "pos"], n).filter("score >= 0")
    good = without_failed(top, failed, url_key(F.col("page")))

    enough = good.groupBy(key).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= few).select(key)
    poor = site.join(enough, key, "left_anti")
    extra = best_per_key(
        scored(nav_links(poor, [key], base).filter(F.col("href") != "")),
        [key, "norm"], [F.when(F.col("score") >= 30, F.col("pos")).asc_nulls_last()],
    ).filter("score >= 30 AND page IS NOT NULL")
    extra = extra.join(found.select(key, "norm"), [key, "norm"], "left_anti").select(
        key, "page", "score", F.lit(1).alias("part"), F.col("pos").alias("at")
    )
    every = good.select(key, "page", "score", F.lit(0).alias("part"), F.col("rank").alias("at")).unionByName(extra)
    return top_per_group(every, [key], ["part", "at", "page"], n).select(key, "page", "score", "rank")


def select_sitemap(entries: DataFrame, failed: DataFrame, site: str, url: str, order: str, n: int = 20) -> DataFrame:
    """Best sitemap entries per site; the first of each normal form counts."""
    scored = entries.withColumn("score", sitemap_score(F.col(url))).withColumn("__norm", path_key(F.col(url)))
    # Excluded pages sort last and go after the window: one score per entry.
    once = best_per_key(scored, [site, "__norm"], [F.col("score") < 0, order]).drop("__norm")
    top = top_per_group(once, [site], [F.desc("score"), order], n).filter("score >= 0")
    return without_failed(top, failed, url_key(F.col(url)))


def union_pages(*parts: DataFrame) -> DataFrame:
    """Distinct union of the url lists of several discovery methods."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()
