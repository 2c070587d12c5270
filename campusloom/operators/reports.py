"""Coverage, gap, progress and demand reports; each reads its table once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from campusloom.functions.basics import bar, epoch_micros, is_blank, percent
from campusloom.functions.text import normalize_category
from campusloom.operators.predicates import has_website
from campusloom.operators.scan import earlier_row


def _rows(one: DataFrame, labels: list[str], label: str, value: str) -> DataFrame:
    """Turn the columns n0, n1, .. of a one-row frame into labelled rows."""
    items = F.array(*[F.struct(F.lit(l).alias(label), F.col(f"n{i}").alias(value)) for i, l in enumerate(labels)])
    rest = [c for c in one.columns if c not in {f"n{i}" for i in range(len(labels))}]
    return one.select(*rest, F.explode(items).alias("__i")).select(*rest, f"__i.{label}", f"__i.{value}")


def status_coverage(df: DataFrame) -> DataFrame:
    """Total, enriched and the four main states with their share."""
    labels = ["enriched", "completed", "partial", "failed", "pending"]
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_enriched")).alias("n0"),
        *[F.count_if(F.col("status") == s).alias(f"n{i + 1}") for i, s in enumerate(labels[1:])],
    )
    return _rows(one, labels, "measure", "n").withColumn("pct", percent(F.col("n"), F.col("total")))


def field_coverage(df: DataFrame, missing: dict[str, Column], width: int = 20) -> DataFrame:
    """Missing count, filled share and bar per field."""
    labels = list(missing)
    one = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(missing.values())]
    )
    present = F.col("total") - F.col("missing")
    return (
        _rows(one, labels, "field", "missing")
        .withColumn("filled_pct", percent(present, F.col("total")))
        .withColumn("bar", bar(present, F.col("total"), width))
    )


def gap_analysis(df: DataFrame, missing: dict[str, Column]) -> DataFrame:
    """Records per gap, and with any gap at all."""
    any_gap = F.lit(False)
    for c in missing.values():
        any_gap = any_gap | c
    labels = [*missing, "any"]
    one = df.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate([*missing.values(), any_gap])])
    return _rows(one, labels, "field", "missing")


def progress(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Done, open and failed records, and how many are trusted."""
    s, conf = F.col("status"), F.col("confidence_score")
    pending = ~F.coalesce(F.col("is_enriched"), F.lit(False)) & (s.isNull() | (s == "pending"))
    out = df.groupBy(*(by or [])).agg(
        F.count_if(has_website(F.col("website"))).alias("total"),
        F.count_if(s == "completed").alias("completed"),
        F.count_if(s == "partial").alias("partial"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(pending).alias("pending"),
        F.count_if(s == "processing").alias("processing"),
        F.count_if(conf >= 0.8).alias("high_confidence"),
        F.count_if((conf > 0) & (conf < 0.8)).alias("low_confidence"),
    )
    done = F.col("completed") + F.col("partial")
    return out.withColumn("done", done).withColumn("done_pct", percent(done, F.col("total")))


def unmatched_ranking(unmatched: DataFrame, samples: int = 8) -> DataFrame:
    """Demand for subjects without a course, most wanted first.

    ``unmatched`` has entity_id, entity_name, category, level and ``ord``, the
    order rows were met in.  Sets are reduced before they are collected: one
    row per (category, record), per (category, level) and at most ``samples``
    names per category.
    """
    rows = unmatched.withColumn("key", normalize_category(F.col("category"))).filter("key <> ''")
    counts = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("count"), F.min_by("category", "ord").alias("sample_label")
    )
    entities = rows.select("key", "entity_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("entity_count"))
    levels = (
        rows.filter(~is_blank(F.col("level")))
        .groupBy("key", "level")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("level", "n")))).alias("levels"))
    )
    names = rows.groupBy("key", "entity_name").agg(F.min("ord").alias("ord"))
    first = W.partitionBy("key").orderBy("ord", "entity_name")
    sample = (
        names.withColumn("rn", F.row_number().over(first))
        .filter(F.col("rn") <= samples)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "entity_name"))).alias("s"))
        .select("key", F.transform("s", lambda x: x["entity_name"]).alias("sample_entities"))
    )
    return (
        counts.join(entities, "key").join(levels, "key", "left").join(sample, "key")
        .withColumnRenamed("key", "category")
        .withColumn("levels", F.coalesce("levels", F.create_map().cast("map<string,bigint>")))
        .orderBy(F.desc("entity_count"), F.desc("count"), "category")
    )


def matching_counters(scanned: DataFrame, linked: DataFrame) -> DataFrame:
    """Records and programs scanned, matched and unmatched, distinct links, subjects."""
    one = linked.agg(
        F.count(F.lit(1)).alias("programs_scanned"),
        F.count_if(F.col("course_id").isNotNull()).alias("programs_matched"),
        F.count_if(F.col("course_id").isNull()).alias("programs_unmatched"),
    )
    links = linked.filter("course_id IS NOT NULL").select("entity_id", "course_id").distinct().agg(
        F.count(F.lit(1)).alias("course_links")
    )
    subjects = (
        linked.filter("course_id IS NULL").select(normalize_category(F.col("category")).alias("c")).filter("c <> ''")
        .distinct().agg(F.count(F.lit(1)).alias("unmatched_categories"))
    )
    return _beside(scanned.agg(F.count(F.lit(1)).alias("entities_scanned")), one, links, subjects)


def backfill_counters(scope: DataFrame, linked: DataFrame) -> DataFrame:
    """Records processed and skipped (no program and no country), links, unmatched."""
    with_programs = linked.select("entity_id").distinct().withColumn("__has", F.lit(True))
    records = scope.join(with_programs, "entity_id", "left").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("__has").isNull() & F.col("country_id").isNull()).alias("skipped"),
    )
    links = linked.filter("course_id IS NOT NULL").select("entity_id", "course_id").distinct().agg(
        F.count(F.lit(1)).alias("course_links")
    )
    misses = linked.agg(F.count_if(F.col("course_id").isNull()).alias("programs_unmatched"))
    return _beside(records, links, misses)


def _beside(*ones: DataFrame) -> DataFrame:
    """Put one-row aggregates side by side, without a join."""
    out = ones[0]
    for o in ones[1:]:
        out = out.unionByName(o, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def outcome_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def crawl_totals(pages: DataFrame, site: Column, text: Column) -> DataFrame:
    """Pages kept and characters per site."""
    return pages.groupBy(site.alias("site")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum(F.coalesce(F.length(text), F.lit(0)).cast("long")).alias("chars")
    )


def image_totals(images: DataFrame, site: Column, kind: Column) -> DataFrame:
    """Image candidates per site and type."""
    return images.select(site.alias("site"), kind.alias("image_type")).filter("image_type IS NOT NULL").groupBy(
        "site", "image_type"
    ).agg(F.count(F.lit(1)).alias("candidates"))


def distinct_summary(df: DataFrame, key: str, by: list[str], rsd: float | None = None) -> DataFrame:
    """Distinct members per group; with ``rsd`` an approximate count."""
    if rsd is not None:
        return df.groupBy(*by).agg(F.approx_count_distinct(key, rsd).alias("n_distinct"))
    return df.select(*by, key).distinct().groupBy(*by).agg(F.count(key).alias("n_distinct"))


def rate_and_eta(samples: DataFrame, series: list[str] | None = None, window: int = 30) -> DataFrame:
    """Rate per hour over the last ``window`` samples and hours to go.

    ``samples`` has ts (unique in a series), done, pending.
    """
    old = earlier_row(samples, series or [], ["ts"], window - 1, ["ts", "done"], "sample_no")
    ms = (epoch_micros(F.col("ts")) - epoch_micros(F.col("__old.ts"))) / 1000
    grown = F.col("done") - F.col("__old.done")
    rate = F.when((ms > 0) & (grown > 0), F.round(grown / ms * 1000 * 3600)).otherwise(F.lit(0.0))
    eta = F.when((F.col("rate_per_hour") > 0) & (F.col("pending") > 0), F.round(F.col("pending") / F.col("rate_per_hour"), 1))
    return old.withColumn("rate_per_hour", rate).withColumn("eta_hours", eta).select(*samples.columns, "sample_no", "rate_per_hour", "eta_hours")


#: Standard error of a distinct sketch with 2**lg_k registers is 1.04 / sqrt(2**lg_k), before and after merging.
SKETCH_LG_K = 12


def sketch_error(lg_k: int = SKETCH_LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, run: str, by: list[str], value: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(*by, run, sketch): the distinct values of every run and group in at most 2**lg_k bytes.

    Meant to be kept: a run is read once, and any span of runs is counted from its sketches alone. Built on
    the map side, so a hot group costs one sketch a task. Null values do not count; null groups are groups.
    """
    return df.groupBy(*by, run).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def distinct_estimates(sketches: DataFrame, by: list[str]) -> DataFrame:
    """(*by, n_estimated): distinct values over all runs given, from their merged sketches."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_estimated"))
