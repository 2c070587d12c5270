"""Keyed state over streams: crawl health, breakers, content memory, attempts, stuck work, polling.

Each state also works as a batch over a whole log; both give the same rows.
State is keyed and expires, so it is bounded by the keys seen within the
time-to-live.  A micro-batch is bounded by the source (files per trigger).
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from campusloom.functions.basics import epoch_micros
from campusloom.functions.hashing import content_key, url_key
from campusloom.operators.scan import Blocks, counts_since_reset, resets, scanned

HOUR = 3_600_000_000
HEALTH_TTL = 6 * HOUR
CONTENT_TTL = 6 * HOUR
LIMIT = 3
COOLDOWN = 300_000_000
BACKOFF_STEP, BACKOFF_MAX = 60_000_000, 300_000_000


# --- crawl health ---------------------------------------------------------

def outcome(status_code: Column, error: Column) -> Column:
    """forbidden / unreachable / server / ok of one crawl attempt."""
    msg = F.coalesce(error, F.lit(""))
    return (
        F.when((F.coalesce(status_code, F.lit(0)) == 403) | msg.rlike("403|Forbidden"), "forbidden")
        .when(msg.rlike("ENOTFOUND|ETIMEDOUT|timeout"), "unreachable")
        .when(F.coalesce(status_code, F.lit(0)).isin(0) | (status_code >= 500), "server")
        .otherwise("ok")
    )


def health_status(kind: Column, forbidden: Column, unreachable: Column) -> Column:
    return (
        F.when(kind == "forbidden", F.when(forbidden >= LIMIT, "blocked").otherwise("degraded"))
        .when(kind == "unreachable", F.when(unreachable >= LIMIT, "dead").otherwise("degraded"))
        .when(kind == "server", "degraded")
        .otherwise("healthy")
    )


def crawl_health(log: DataFrame) -> DataFrame:
    """Status of the domain after every event: columns of ``log`` plus
    forbidden_count, unreachable_count and health.

    Needs domain, ts, event_id, status_code, error.
    """
    kind = outcome(F.col("status_code"), F.col("error"))
    counted = counts_since_reset(
        log.withColumns({"kind": kind, "__us": epoch_micros(F.col("ts"))}), ["domain"], ["ts", "event_id"], "__us",
        {"forbidden_count": F.col("kind") == "forbidden", "unreachable_count": F.col("kind") == "unreachable"},
        F.col("kind") == "ok", HEALTH_TTL,
    )
    return counted.drop("__us").withColumn("health", health_status(F.col("kind"), F.col("forbidden_count"), F.col("unreachable_count")))


def latest_health(health: DataFrame) -> DataFrame:
    """Current status per domain."""
    last = F.struct("ts", "event_id")
    return health.groupBy("domain").agg(
        F.max_by("health", last).alias("health"), F.max("ts").alias("last_seen"),
        F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("kind") == "ok").alias("successes"),
    )


def can_crawl(targets: DataFrame, latest: DataFrame, now: Column, domain: str = "domain") -> DataFrame:
    """Whether each target may be fetched; unknown or expired domains may."""
    side = latest.select(F.col("domain").alias("__d"), F.col("health").alias("__h"), F.col("last_seen").alias("__t"))
    live = epoch_micros(F.col("__t")) + HEALTH_TTL > epoch_micros(now)
    h = F.when(F.col(domain).isNull(), "dead").when(F.coalesce(live, F.lit(False)), F.col("__h")).otherwise("healthy")
    return (
        targets.join(side, F.col(domain) == F.col("__d"), "left").withColumn("health", h)
        .withColumn("can_crawl", ~F.col("health").isin("blocked", "dead")).drop("__d", "__h", "__t")
    )


class _Ordered(StatefulProcessor):
    """Feeds the rows of a key in time order to ``one(state, row)``.

    With ``ttl`` an event-time timer clears the state once the watermark has
    passed the last renewal by that long; rows older than the watermark are
    gone by then, so clearing never changes a result.
    """

    state_schema = ""
    ttl = 0
    columns: list[str] = []

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("state", self.state_schema)
        self.row = None

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Every call of the state is a message to the JVM, and many keys have few rows: one call reads, and a key without
        # state has no timers. Sorting row numbers costs less than sorting frames.
        found = self.value.get()
        before = tuple(found) if found is not None else None
        state = before
        frames = list(rows)
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        order = np.lexsort((pdf["event_id"].to_numpy(), pdf["us"].to_numpy()))
        if self.row is None:
            self.row = namedtuple("Row", pdf.columns, rename=True)
        out = []
        for row in map(self.row, *(pdf[c].to_numpy()[order].tolist() for c in pdf.columns)):
            state, result = self.one(state, row)
            if result is not None:
                out.append((*key, row.event_id, row.us, *result))
        if state != before:
            self.value.update(state)
            if self.ttl:
                for t in list(self.handle.listTimers()) if before is not None else ():
                    self.handle.deleteTimer(t)
                self.handle.registerTimer((state[-1] + self.ttl) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.value.clear()
        return iter(())

    def one(self, state, row):
        raise NotImplementedError

    def close(self) -> None:
        pass


def _by_key(rows: DataFrame, key: str, processor: _Ordered, output: str, lateness: str) -> DataFrame:
    """Run a processor per key; ``rows`` has the key, event_id and us."""
    if processor.ttl:
        rows = rows.withColumn("at", F.timestamp_micros("us")).withWatermark("at", lateness)
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append",
        timeMode="EventTime" if processor.ttl else "None",
    )


class _Health(_Ordered):
    state_schema = "forbidden bigint, unreachable bigint, us bigint"
    ttl = HEALTH_TTL
    columns = ["domain", "event_id", "us", "forbidden_count", "unreachable_count", "health"]

    def one(self, state, row):
        f, u, at = state or (0, 0, None)
        if row.kind == "ok" or (at is not None and row.us - at >= HEALTH_TTL):
            f = u = 0
        f, u = f + (row.kind == "forbidden"), u + (row.kind == "unreachable")
        bad = {"forbidden": "blocked" if f >= LIMIT else "degraded", "unreachable": "dead" if u >= LIMIT else "degraded", "server": "degraded"}
        return (f, u, row.us), (f, u, bad.get(row.kind, "healthy"))


def crawl_health_stream(log: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Same rows as :func:`crawl_health` over a stream in time order."""
    rows = log.select(
        "domain", "event_id", epoch_micros(F.col("ts")).alias("us"), outcome(F.col("status_code"), F.col("error")).alias("kind")
    )
    output = "domain string, event_id bigint, us bigint, forbidden_count bigint, unreachable_count bigint, health string"
    return _by_key(rows, "domain", _Health(), output, lateness)


# --- breaker per key ------------------------------------------------------

def breaker(calls: DataFrame, idle: int | None = None) -> DataFrame:
    """State of the breaker after every call: failures, open_until, limited_until
    (microseconds, 0 when never) and whether the key is available right then.

    Needs key, ts, event_id, result (ok / failed / limited) and retry_after_ms.
    With ``idle`` (microseconds) a silence of that long makes a key start afresh;
    waits that reach beyond it end with it.
    """
    ok, failed, limited = (F.col("result") == r for r in ("ok", "failed", "limited"))
    within, across, count, silent = resets("__us", ok, {"n": ~ok}, idle)
    at = [F.col("__us").alias("us"), F.col("event_id").alias("id")]
    hint = F.coalesce(F.col("retry_after_ms"), F.lit(0)) * 1000
    zero = F.lit(0).cast("long")
    goes_on = ~F.col("__own") & ~F.col("__gap")

    def events(b: Blocks) -> dict[str, Column]:
        # The last failure, clearing and limit of the block; counts are those of the block until the key's own are known.
        limit = F.struct(*at, F.lit(True).alias("is_limit"), F.col("__s_n").alias("n"), hint.alias("hint"), F.col("__own").alias("own"))
        fresh = F.struct(*at, F.lit(False).alias("is_limit"), zero.alias("n"), zero.alias("hint"), F.lit(True).alias("own"))
        return {
            "__failed": F.max(F.when(failed, F.struct(*at, F.col("__s_n").alias("n")))).over(b.row),
            "__cleared": F.max(F.when(F.col("__clear"), F.struct(*at))).over(b.row),
            "__limit": F.max(F.when(limited, limit).when(F.col("__quiet"), fresh)).over(b.row),
        }

    brought = F.when(~F.col("__gap"), F.col("__i_n")).otherwise(0)
    here = F.col("__failed").isNotNull() & (F.col("__cleared").isNull() | (F.struct("__failed.us", "__failed.id") >= F.col("__cleared")))
    last_count = F.col("__failed.n") + F.when(F.col("__cleared").isNull(), brought).otherwise(0)
    open_here = F.when(last_count >= LIMIT, F.col("__failed.us") + COOLDOWN).otherwise(zero)
    waited = F.col("__limit.n") + F.when(F.col("__limit.own"), 0).otherwise(brought)
    wait = F.when(F.col("__limit.hint") > 0, F.col("__limit.hint")).otherwise(F.least(F.lit(BACKOFF_STEP) * waited, F.lit(BACKOFF_MAX)))
    limit_here = F.when(F.col("__limit.is_limit"), F.col("__limit.us") + wait).otherwise(zero)

    def left(b: Blocks) -> dict[str, Column]:
        """What a block leaves behind, null where it goes on with what it found."""
        return {
            "__open_out": F.when(here, open_here).when(~goes_on, zero),
            "__limit_out": F.when(F.col("__limit").isNotNull(), limit_here).when(F.col("__gap"), zero),
        }

    def found(b: Blocks) -> dict[str, Column]:
        last = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(b.before), zero)
        return {"__open_in": last("__open_out"), "__limit_in": last("__limit_out")}

    rows = scanned(calls.withColumn("__us", epoch_micros(F.col("ts"))), ["key"], ["ts", "event_id"], [*within, events], [*across, left, found])
    out = rows.withColumns({
        "failures": count("n"),
        "open_until": F.when(here, open_here).when(goes_on, F.col("__open_in")).otherwise(zero),
        "limited_until": F.when(F.col("__limit").isNotNull(), limit_here).when(F.col("__gap"), zero).otherwise(F.col("__limit_in")),
    })
    available = (F.col("open_until") <= F.col("__us")) & (F.col("limited_until") <= F.col("__us"))
    return out.select(*calls.columns, "failures", "open_until", "limited_until", available.alias("available"))


#: A key without a call for 30 days is forgotten by the stream.
BREAKER_IDLE = 30 * 24 * HOUR


class _Breaker(_Ordered):
    def __init__(self, idle: int) -> None:
        self.ttl = idle

    state_schema = "failures bigint, open_until bigint, limited_until bigint, us bigint"
    columns = ["key", "event_id", "us", "failures", "open_until", "limited_until"]

    def one(self, state, row):
        n, opened, limited, at = state or (0, 0, 0, None)
        if at is not None and row.us - at >= self.ttl:
            n, opened, limited = 0, 0, 0
        if row.result == "ok":
            n, opened = 0, 0
        elif row.result == "limited":
            wait = row.retry_us if row.retry_us > 0 else min(BACKOFF_STEP * (n + 1), BACKOFF_MAX)
            n, limited = n + 1, row.us + wait
        else:
            n += 1
            opened = row.us + COOLDOWN if n >= LIMIT else opened
        return (n, opened, limited, row.us), (n, opened, limited)


def breaker_stream(calls: DataFrame, idle: int = BREAKER_IDLE, lateness: str = "1 hour") -> DataFrame:
    """Same state as :func:`breaker` with the same ``idle`` over a stream in time order."""
    rows = calls.select(
        "key", "event_id", epoch_micros(F.col("ts")).alias("us"), "result",
        (F.coalesce("retry_after_ms", F.lit(0)) * 1000).cast("long").alias("retry_us"),
    )
    output = "key string, event_id bigint, us bigint, failures bigint, open_until bigint, limited_until bigint"
    return _by_key(rows, "key", _Breaker(idle), output, lateness)


# --- content memory -------------------------------------------------------

class _FirstSeen(_Ordered):
    state_schema = "us bigint"
    ttl = CONTENT_TTL
    columns = ["content_hash", "event_id", "us"]

    def one(self, state, row):
        if state is not None and row.us - state[0] < CONTENT_TTL:
            return state, None
        return (row.us,), ()


def new_content_stream(texts: DataFrame, text: str = "text", minimum: int = 200, lateness: str = "1 hour") -> DataFrame:
    """Texts not seen within the last six hours; a repeat does not renew them.

    Short texts are never duplicates and are not part of this stream.
    """
    rows = texts.filter(F.length(text) >= minimum).select(
        content_key(F.col(text)).alias("content_hash"), "event_id", epoch_micros(F.col("ts")).alias("us")
    )
    return _by_key(rows, "content_hash", _FirstSeen(), "content_hash string, event_id bigint, us bigint", lateness)


def new_content_within_watermark(texts: DataFrame, text: str = "text", minimum: int = 200) -> DataFrame:
    """Built-in form: at least six hours of memory, late texts are dropped."""
    return (
        texts.filter(F.length(text) >= minimum).withColumn("content_hash", content_key(F.col(text)))
        .withWatermark("ts", "6 hours").dropDuplicatesWithinWatermark(["content_hash"])
    )


# --- failed urls, attempts -----------------------------------------------

def failed_marks(log: DataFrame, url: str = "url") -> DataFrame:
    """Marks of permanently failed urls: not found, or host not found."""
    reason = F.coalesce(F.col("error"), F.lit(""))
    gone = (F.coalesce(F.col("status_code"), F.lit(0)) == 404) | reason.rlike("ENOTFOUND|Not Found")
    return log.filter(gone).select(url_key(F.col(url)).alias("url_hash"), F.col("ts").alias("failed_at"))


def failed_urls(marks: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Urls whose latest mark is still remembered."""
    return marks.groupBy("url_hash").agg(F.max("failed_at").alias("failed_at")).filter(
        epoch_micros(F.col("failed_at")) + days * 24 * HOUR > epoch_micros(now)
    )


def attempts(log: DataFrame, key: str, terminal: Column, value: int = 99) -> DataFrame:
    """Attempts per key; a terminal event sets the counter to its end value."""
    return log.groupBy(key).agg(
        F.when(F.max(F.coalesce(terminal, F.lit(False))), F.lit(value)).otherwise(F.count(F.lit(1))).cast("long").alias("attempts")
    )


class _Attempts(_Ordered):
    """State: attempts so far, whether a terminal event was among them, time of the last one."""

    state_schema = "n bigint, ended bigint, us bigint"

    def __init__(self, key: str, value: int, idle: int) -> None:
        self.columns, self.value_at_end, self.ttl = [key, "event_id", "us", "attempts"], value, idle

    def one(self, state, row):
        n, ended, at = state or (0, 0, None)
        if at is not None and row.us - at >= self.ttl:
            n, ended = 0, 0
        n, ended = n + 1, max(ended, int(row.terminal))
        return (n, ended, row.us), (self.value_at_end if ended else n,)


def attempts_stream(log: DataFrame, key: str, terminal: Column, value: int = 99, idle: int = BREAKER_IDLE, lateness: str = "1 hour") -> DataFrame:
    """The counter of :func:`attempts` after every event of a stream in time order.

    The last row of a key equals the batch form. A key without an event for ``idle`` starts afresh.
    """
    rows = log.select(F.col(key).cast("string").alias(key), "event_id", epoch_micros(F.col("ts")).alias("us"), F.coalesce(terminal, F.lit(False)).alias("terminal"))
    return _by_key(rows, key, _Attempts(key, value, idle), f"{key} string, event_id bigint, us bigint, attempts bigint", lateness)


# --- stuck work -----------------------------------------------------------

class _Stuck(_Ordered):
    """Holds the processing event a key is in; a timer or a late successor reports it as stuck."""

    state_schema = "event_id bigint, us bigint"

    def __init__(self, key: str, limit: int) -> None:
        self.columns, self.ttl = [key, "event_id", "us", "reset_us"], limit

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        held = tuple(self.value.get()) if self.value.exists() else None
        out = []
        for row in pd.concat(list(rows), ignore_index=True).sort_values(["us", "event_id"], kind="stable").itertuples(index=False):
            if held is not None and row.us - held[1] > self.ttl:
                out.append((*key, *held, held[1] + self.ttl))
            held = (row.event_id, row.us) if row.processing else None
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if held is None:
            self.value.clear()
        else:
            self.value.update(held)
            self.handle.registerTimer((held[1] + self.ttl) // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        held = tuple(self.value.get()) if self.value.exists() else None
        self.value.clear()
        if held is not None:
            yield pd.DataFrame([(*key, *held, held[1] + self.ttl)], columns=self.columns)


def stuck_work_stream(log: DataFrame, key: str, processing: Column, minutes: int = 20, lateness: str = "1 hour") -> DataFrame:
    """Processing events with no event of their key in the minutes after them, and when they were to be reset.

    ``log`` has the key, event_id and ts, in time order; ties in time go by event_id. An event is reported
    when the watermark has passed its limit or when a later event of its key shows that it was passed.
    One without a timestamp is reported at once, with no time. State: the open event of a key, if any.
    """
    rows = log.select(
        F.col(key).cast("string").alias(key), F.col("event_id").cast("long").alias("event_id"),
        epoch_micros(F.col("ts")).alias("us"), F.coalesce(processing, F.lit(False)).alias("processing"),
    )
    output = f"{key} string, event_id bigint, us bigint, reset_us bigint"
    timed = _by_key(rows.filter("us IS NOT NULL"), key, _Stuck(key, minutes * HOUR // 60), output, lateness)
    untimed = rows.filter("us IS NULL AND processing").select(key, "event_id", "us", F.lit(None).cast("bigint").alias("reset_us"))
    return timed.unionByName(untimed)


# --- polling --------------------------------------------------------------

def poll(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "90 seconds"):
    """Run ``work`` on every micro-batch; ``every=None`` drains what is there."""
    w = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)
    return w.start()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def drain(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream over all that is there now and return what it wrote.

    ``folder`` keeps output and progress: a later call goes on from there.
    Keyed state needs the RocksDB store, set for the start of the query only.
    """
    spark = stream.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        q = (
            stream.writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
        )
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")
