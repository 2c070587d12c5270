"""Keyed upserts, report sinks, priority lists, caches, resumable scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campusloom.functions.hashing import extraction_key
from campusloom.functions.urls import classify
from campusloom.operators.carry import arrival_number
from campusloom.operators.joins import flag_ever
from campusloom.session import durable


# --- upserts --------------------------------------------------------------

def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def set_columns(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str], insert: bool = True) -> DataFrame:
    """Set only the given columns of matching rows; other columns stay.

    A row present in ``new`` sets its value even when that is NULL.  Keys only
    in ``new`` are inserted unless ``insert`` is off.
    """
    side = new.select(*[F.col(k).alias(f"__{k}") for k in keys], *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__hit"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    j = old.join(side, on, "full_outer" if insert else "left")
    hit = F.coalesce("__hit", F.lit(False))
    out = []
    for c in old.columns:
        if c in keys:
            out.append(F.coalesce(c, f"__{c}").alias(c))
        elif c in columns:
            out.append(F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def write_upsert(new: DataFrame, path: str, keys: list[str], partition: str) -> None:
    """Upsert into a partitioned parquet table, touching only its partitions.

    The merged rows are written to the checkpoint folder first, so a partition
    is never read and overwritten in one step.
    """
    spark = new.sparkSession
    try:
        old = spark.read.parquet(path)
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        new.write.partitionBy(partition).parquet(path)
        return
    new = durable(new)
    touched = new.select(partition).distinct()
    merged = durable(upsert(old.join(touched, partition, "left_semi"), new.select(*old.columns), keys))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def pull_snapshot(rows: DataFrame, history: DataFrame, label: str, run_date: Column) -> DataFrame:
    """One run of performance rows: label, page class, rewritten flag carried on."""
    kind = classify(F.col("url"))
    stamped = (
        rows.withColumn("run_label", F.lit(label)).withColumn("run_date", run_date)
        .withColumn("entity_type", kind["entity_type"]).withColumn("slug", kind["slug"])
    )
    return flag_ever(stamped, history, "url", "meta_rewritten", "meta_rewritten")


# --- lists and reports ----------------------------------------------------

def write_priorities(ranked: DataFrame, path: str) -> None:
    """Store a short ordered list; ``rank`` keeps the order."""
    ranked.write.mode("overwrite").json(path)


def read_priorities(spark: SparkSession, path: str) -> DataFrame:
    schema = "rank int, entity_type string, slug string, impressions bigint, ctr double, url string"
    return spark.read.schema(schema).json(path)


def write_report(unmatched: DataFrame, report: DataFrame, path: str) -> None:
    """Raw pairs and the aggregated report as two outputs."""
    unmatched.write.mode("overwrite").json(f"{path}/raw")
    report.write.mode("overwrite").parquet(f"{path}/report")


# --- caches ---------------------------------------------------------------

HOURS = {"page": 24, "extraction": 48, "failed_url": 7 * 24, "external": 14 * 24, "content": 6}


def fresh(cache: DataFrame, now: Column, hours: int, at: str = "cached_at") -> DataFrame:
    """Entries that have not expired."""
    return cache.filter(F.col(at) + F.make_dt_interval(F.lit(0), F.lit(hours), F.lit(0), F.lit(0)) > now)


def split_by_cache(wanted: DataFrame, cache: DataFrame, key: str, now: Column, hours: int) -> tuple[DataFrame, DataFrame]:
    """(hits with the cached columns, misses) for a time-limited cache."""
    live = fresh(cache, now, hours)
    return wanted.join(live, key), wanted.join(live.select(key), key, "left_anti")


def with_cache(wanted: DataFrame, cache: DataFrame, key: str, now: Column, hours: int, compute: Callable[[DataFrame], DataFrame], columns: list[str]) -> DataFrame:
    """Cached values where they are fresh, computed ones elsewhere."""
    hits, misses = split_by_cache(wanted, cache, key, now, hours)
    out = [*wanted.columns, *columns]
    return hits.select(*out, F.lit(True).alias("from_cache")).unionByName(
        compute(misses).select(*out, F.lit(False).alias("from_cache"))
    )


def new_extractions(content: DataFrame, memo: DataFrame, entity: str, text: str) -> DataFrame:
    """Contents whose (record, opening hash) is not in the memo yet."""
    keyed = content.withColumn("content_hash", extraction_key(F.col(text)))
    return keyed.join(memo.select(entity, "content_hash"), [entity, "content_hash"], "left_anti")


# --- resumable scans ------------------------------------------------------

PROGRESS_SCHEMA = (
    "run_key string, last_id bigint, processed bigint, linked bigint, unmatched bigint, skipped bigint, "
    "errors bigint, status string, batch_no int, step bigint"
)


def batch_end(df: DataFrame, key: str, last: int | None, size: int) -> int | None:
    """Largest key of the next batch, NULL at the end of the scan."""
    rest = df.select(key) if last is None else df.select(key).filter(F.col(key) > last)
    return rest.orderBy(key).limit(size).agg(F.max(key)).first()[0]


def batch_ends(df: DataFrame, key: str, last: int | None, size: int) -> list[int]:
    """Largest keys of all batches after ``last``, from one scan of the key column.

    Keys are sorted by range and numbered within their ranges, so no task holds them
    all; the driver gets one number per batch.
    """
    rest = df.select(F.col(key).alias("k")).filter(F.col(key).isNotNull() if last is None else F.col(key) > last)
    ranged = durable(rest.repartitionByRange("k").withColumn("part", F.spark_partition_id()))
    numbered = arrival_number(ranged, [], ["k"], F.col("part"), "n")
    ends = numbered.groupBy(F.ceil(F.col("n") / size).alias("batch")).agg(F.max("k").alias("k"))
    return [r.k for r in ends.select("k").distinct().orderBy("k").collect()]


def key_range(df: DataFrame, key: str, last: int | None, end: int) -> DataFrame:
    out = df.filter(F.col(key) <= end)
    return out if last is None else out.filter(F.col(key) > last)


def load_progress(spark: SparkSession, path: str, run_key: str) -> dict | None:
    """Latest progress row of a run."""
    try:
        rows = spark.read.schema(PROGRESS_SCHEMA).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    row = rows.filter(F.col("run_key") == run_key).orderBy(F.desc("step")).first()
    return None if row is None else row.asDict()


def run_batches(df: DataFrame, key: str, path: str, run_key: str, work: Callable[[DataFrame, int], dict], size: int = 100_000, resume: bool = False, dry_run: bool = False, max_batches: int | None = None) -> dict:
    """Process a table in key order, batch by batch, and remember how far it got.

    ``work(batch, batch_no)`` returns counters to add up.  A batch counts only
    after its work has returned, so an interrupted run repeats at most one.  A
    completed run starts afresh; a dry run neither reads nor writes progress.
    """
    spark = df.sparkSession
    names = ["processed", "linked", "unmatched", "skipped", "errors"]
    known = load_progress(spark, path, run_key) if not dry_run else None
    start = {
        "last_id": None, **{n: 0 for n in names},
        "batch_no": known["batch_no"] + 1 if known else 0, "step": known["step"] if known else 0,
    }
    state = known if known and resume and known["status"] != "completed" else start
    done = 0

    def store(status: str) -> None:
        state["status"], state["run_key"], state["step"] = status, run_key, state["step"] + 1
        if not dry_run:
            row = [tuple(state.get(c.split()[0]) for c in PROGRESS_SCHEMA.split(", "))]
            spark.createDataFrame(row, PROGRESS_SCHEMA).coalesce(1).write.mode("append").json(path)

    for end in batch_ends(df, key, state["last_id"], size):
        if done == max_batches:
            store("paused")
            return state
        counted = work(key_range(df, key, state["last_id"], end), state["batch_no"])
        for n in names:
            state[n] = (state[n] or 0) + counted.get(n, 0)
        state["last_id"], state["batch_no"] = end, state["batch_no"] + 1
        done += 1
        store("running")
    store("completed")
    return state
