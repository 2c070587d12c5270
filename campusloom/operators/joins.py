"""Keyed lookups and comparisons.

No side is broadcast by hint: Spark broadcasts by the size it knows or
measures, and shuffles both sides otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def with_country_name(df: DataFrame, countries: DataFrame, key: str = "country_id", default: str = "Unknown") -> DataFrame:
    dim = countries.select(F.col("country_id").alias("__id"), F.col("name").alias("__name"))
    return (
        df.join(dim, F.col(key) == F.col("__id"), "left")
        .withColumn("country_name", F.coalesce("__name", F.lit(default)))
        .drop("__id", "__name")
    )


def populate(df: DataFrame, dim: DataFrame, key: str, dim_key: str, fields: list[str], name: str) -> DataFrame:
    """Replace a reference by a struct of the chosen fields; NULL when dangling."""
    side = dim.select(F.col(dim_key).alias("__id"), F.struct(*fields).alias(name))
    return df.join(side, F.col(key) == F.col("__id"), "left").drop("__id")


def flag_ever(df: DataFrame, history: DataFrame, key: str, flagged: str, name: str) -> DataFrame:
    """True when the key was flagged in any earlier row of ``history``."""
    ever = history.filter(F.col(flagged)).select(F.col(key).alias("__k")).distinct()
    return df.join(ever, F.col(key) == F.col("__k"), "left").withColumn(name, F.col("__k").isNotNull()).drop("__k")


def without_failed(df: DataFrame, failed: DataFrame, key, failed_key: str = "url_hash") -> DataFrame:
    """Drop rows whose key column expression is listed as failed."""
    side = failed.select(F.col(failed_key).alias("__k")).distinct()
    return df.withColumn("__h", key).join(side, F.col("__h") == F.col("__k"), "left_anti").drop("__h")


def run_difference(perf: DataFrame, run: str, before, after) -> DataFrame:
    """Click rate of rewritten pages in two runs, largest gain first."""

    def side(value, tag):
        return perf.filter((F.col(run) == value) & F.col("meta_rewritten")).select(
            "url", F.col("ctr").alias(f"ctr_{tag}"), F.col("impressions").alias(f"impressions_{tag}")
        )

    return (
        side(before, "before")
        .join(side(after, "after"), "url")
        .withColumn("ctr_delta", F.col("ctr_after") - F.col("ctr_before"))
        .orderBy(F.desc("ctr_delta"), "url")
    )


def run_series(perf: DataFrame, run: str) -> DataFrame:
    """Previous click rate and change per url over all runs."""
    w = W.partitionBy("url").orderBy(run)
    return perf.withColumn("previous_ctr", F.lag("ctr").over(w)).withColumn(
        "ctr_change", F.col("ctr") - F.col("previous_ctr")
    )


def in_list_order(keys: DataFrame, rows: DataFrame, key: str, position: str, keep=None, limit: int | None = None) -> DataFrame:
    """Rows in the order of a key list; unknown keys vanish, then filter and limit."""
    out = keys.select(F.col(position), F.col(key)).join(rows, key)
    if keep is not None:
        out = out.filter(keep)
    out = out.orderBy(position, key)
    return out if limit is None else out.limit(limit)


def require_kind(items: DataFrame, kind: str, column: str = "entity_type") -> DataFrame:
    """The entries of one kind; a non-empty list without any is an error."""
    seen = items.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(column) == kind).alias("hits"),
        F.array_sort(F.collect_set(column)).alias("kinds"),
    ).first()
    if seen.n > 0 and seen.hits == 0:
        raise ValueError(f"the list has no entry of kind {kind!r}; it has: {', '.join(seen.kinds) or 'none'}")
    return items.filter(F.col(column) == kind)
