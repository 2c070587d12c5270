"""Sources: catalog tables, ranking lists, click reports, sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from campusloom import rules
from campusloom.functions.urls import classify
from campusloom.session import durable


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | str | None = None, limit: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Projected, filtered, limited scan; Spark pushes the first two down."""
    df = spark.read.format(fmt).load(path)
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def with_file_order(df: DataFrame, name: str = "line_no") -> DataFrame:
    """Order of the lines of text files: file, split, position in the split."""
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_ranking(spark: SparkSession, path: str, name: str = "Institution Name", rank: str = "2025 Rank") -> DataFrame:
    """Ranking list with line order; lines without name or rank are dropped."""
    raw = (
        spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True).option("escape", '"').option("multiLine", True).csv(path)
    )
    raw = with_file_order(raw)
    for c in raw.columns:  # a quoted header may still carry the byte-order mark
        raw = raw.withColumnRenamed(c, c.lstrip("\ufeff").strip())
    return raw.select(
        "line_no", F.trim(f"`{name}`").alias("institution_name"), F.trim(f"`{rank}`").alias("rank")
    ).filter(F.coalesce("institution_name", F.lit("")) != "").filter(F.coalesce("rank", F.lit("")) != "")


_PERF_HEADERS = {
    "url": ["Page", "Top pages", "page", "url"],
    "clicks": ["Clicks", "clicks"],
    "impressions": ["Impressions", "impressions"],
    "ctr": ["CTR", "ctr"],
    "position": ["Position", "position"],
}


def perf_from_csv_rows(raw: DataFrame, label: str, run_date: Column) -> DataFrame:
    """Click report rows with any of the known headers as one run.

    "3.1%" becomes 0.031; counts take the leading digits, as text import does.
    """

    def first(field: str, default: str | None = None) -> Column:
        have = [h for h in _PERF_HEADERS[field] if h in raw.columns]
        cols = [F.nullif(F.trim(F.col(f"`{h}`").cast("string")), F.lit("")) for h in have]
        return F.coalesce(*cols, F.lit(default).cast("string"))

    def whole(field: str) -> Column:
        return F.nullif(F.regexp_extract(first(field, "0"), r"^([+-]?[0-9]+)", 1), F.lit("")).cast("long")

    def decimal(c: Column) -> Column:
        return F.nullif(F.regexp_extract(c, r"^([+-]?[0-9]*\.?[0-9]+)", 1), F.lit("")).cast("double")

    kind = classify(F.col("url"))
    return (
        raw.select(
            first("url").alias("url"),
            whole("clicks").alias("clicks"),
            whole("impressions").alias("impressions"),
            (decimal(F.replace(first("ctr", "0%"), F.lit("%"), F.lit(""))) / 100).alias("ctr"),
            decimal(first("position", "0")).alias("position"),
        )
        .withColumn("run_label", F.lit(label))
        .withColumn("run_date", run_date)
        .withColumn("entity_type", kind["entity_type"])
        .withColumn("slug", kind["slug"])
        .withColumn("meta_rewritten", F.lit(False))
    )


def read_perf_csv(spark: SparkSession, path: str, label: str = "run-zero", run_date: Column | None = None) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    return perf_from_csv_rows(raw, label, F.current_timestamp() if run_date is None else run_date)


PERF_PAGE_SCHEMA = (
    "rows array<struct<keys:array<string>,clicks:double,impressions:double,ctr:double,position:double>>"
)


def perf_rows(pages: DataFrame) -> DataFrame:
    """One row per page url out of landed result pages."""
    r = F.col("r")
    return pages.select(F.explode("rows").alias("r")).select(
        F.get(r["keys"], F.lit(0)).alias("url"), r["clicks"].cast("long").alias("clicks"),
        r["impressions"].cast("long").alias("impressions"), r["ctr"].alias("ctr"), r["position"].alias("position"),
    )


def read_perf_pages(spark: SparkSession, path: str) -> DataFrame:
    return perf_rows(spark.read.schema(PERF_PAGE_SCHEMA).option("multiLine", True).json(path))


# --- sitemaps -------------------------------------------------------------

def read_sitemaps(spark: SparkSession, path: str, tag: str = "url", limit: int | None = None) -> DataFrame:
    """(source, ord, loc) entries of landed sitemap files, all or the first ``limit`` each.

    ``tag`` is ``url`` for maps and ``sitemap`` for index files.
    """
    raw = spark.read.format("xml").option("rowTag", tag).schema("loc string").load(path)
    rows = raw.select(
        F.col("_metadata.file_path").alias("source"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("at"),
        F.trim("loc").alias("loc"),
    ).filter(F.col("loc") != "")
    numbered = rows.withColumn("ord", F.row_number().over(W.partitionBy("source").orderBy("at")))
    return (numbered if limit is None else numbered.filter(F.col("ord") <= limit)).select("source", "ord", "loc")


def pick_submaps(index: DataFrame, n: int | None = 3) -> DataFrame:
    """Sub-maps of an index to read: relevant names first, then file order; all of them for n None."""
    relevant = F.when(F.col("loc").rlike(rules.SITEMAP_RELEVANT), 0).otherwise(1)
    ranked = index.withColumn("rank", F.row_number().over(W.partitionBy("source").orderBy(relevant, "ord")))
    return ranked if n is None else ranked.filter(F.col("rank") <= n)


def sitemap_chain(index: DataFrame, entries: DataFrame, roots: DataFrame, depth: int = 2, n: int | None = None) -> DataFrame:
    """(site, source, depth, ord, loc): the entries of all maps that a site reaches from its roots.

    ``index`` and ``entries`` are the (source, ord, loc) rows of index files and of maps, source being a
    file's own url; ``roots`` has (site, source). Index files may name further index files down to ``depth``
    steps. A file counts once per site, at its least depth, so cycles and repeated names end; a name without
    a file gives nothing. With ``n`` only so many sub-maps of each index file are followed.
    """
    named = pick_submaps(index, n).select("source", F.col("loc").alias("next")).distinct()
    front = roots.select("site", "source").dropna().distinct().withColumn("depth", F.lit(0))
    reached = front
    for step in range(1, depth + 1):
        found = front.join(named, "source").select("site", F.col("next").alias("source")).distinct()
        new = found.join(reached.select("site", "source"), ["site", "source"], "left_anti")
        front = durable(new.withColumn("depth", F.lit(step)))
        reached = reached.unionByName(front)
    return reached.join(entries, "source").select("site", "source", "depth", "ord", "loc")
