"""From landed home pages and sitemaps to one content text per site."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from campusloom.operators.pages import clean_pages, discover_pages, union_pages
from campusloom.operators.ranking import adaptive_pages, assemble_content, prioritize_pages


def pages_to_read(homes: DataFrame, sitemap: DataFrame, failed: DataFrame, n: int = 8) -> DataFrame:
    """Both discovery methods united, the best few pages per site.

    ``homes`` has site, url, html; ``sitemap`` has site, page.
    """
    found = discover_pages(homes, failed, key="site").select("site", "page")
    return prioritize_pages(union_pages(sitemap.select("site", "page"), found), "site", "page", n)


def site_content(chosen: DataFrame, crawled: DataFrame) -> DataFrame:
    """Texts of the chosen pages, read until there is enough, as one content.

    ``chosen`` has site, page, rank; ``crawled`` has url, html.
    """
    text = clean_pages(crawled.select("url", "html")).withColumnRenamed("url", "page")
    rows = chosen.join(text, "page", "left")
    enough = adaptive_pages(rows, "site", "rank", F.length("cleaned_text"))
    return assemble_content(enough.filter(F.col("cleaned_text").isNotNull()), "site", "rank", "cleaned_text")
