"""Streams over several files give the same rows as the batch forms."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from campusloom.session import work_folder
from campusloom.streaming import states as T


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """Crawl events of 12 domains, one of them hot, in four files by time."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    domain = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.concat(F.lit("d"), (F.col("user_id") % 11).cast("string")))
    k = F.col("event_id") % 5
    bad = F.col("event_id") % 6 != 0
    rows = e.select(
        "event_id", "ts", domain.alias("domain"),
        F.when(~bad, 200).when(k < 2, 403).when(k < 4, None).otherwise(500).alias("status_code"),
        F.when(bad & ((k == 2) | (k == 3)), "ETIMEDOUT").alias("error"),
        F.when(F.col("event_id") % 4 == 0, "ok").when(F.col("event_id") % 7 == 0, "limited").otherwise("failed").alias("result"),
        F.when(F.col("event_id") % 14 == 0, 90_000).otherwise(0).alias("retry_after_ms"),
        F.repeat(F.concat("event_type", (F.col("user_id") % 3).cast("string")), 60).alias("text"),
    )
    folder = str(tmp_path_factory.mktemp("log") / "files")
    for i, (a, b) in enumerate([(1, 8), (8, 15), (15, 23), (23, 32)]):
        rows.filter((F.dayofmonth("ts") >= a) & (F.dayofmonth("ts") < b)).coalesce(1).write.mode("append").parquet(folder)
    return spark.read.parquet(folder), spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_crawl_health(spark, log):
    batch, stream = log
    cols = ("event_id", "domain", "forbidden_count", "unreachable_count", "health")
    want = rows(T.crawl_health(batch), *cols)
    assert rows(T.drain(T.crawl_health_stream(stream), work_folder(spark)), *cols) == want
    assert {r[4] for r in want} == {"healthy", "degraded", "blocked", "dead"}


def test_breaker(spark, log):
    batch, stream = log
    key = lambda df: df.withColumnRenamed("domain", "key")
    cols = ("event_id", "key", "failures", "open_until", "limited_until")
    assert rows(T.drain(T.breaker_stream(key(stream)), work_folder(spark)), *cols) == rows(T.breaker(key(batch)), *cols)


def test_idle_breaker_starts_afresh(spark, log):
    """With a short memory stream and batch agree too, and differ from those that never forget."""
    batch, stream = log
    key = lambda df: df.withColumnRenamed("domain", "key").filter("event_id % 3 != 0")
    cols = ("event_id", "key", "failures", "open_until", "limited_until")
    want = rows(T.breaker(key(batch), idle=6 * T.HOUR), *cols)
    assert rows(T.drain(T.breaker_stream(key(stream), idle=6 * T.HOUR), work_folder(spark)), *cols) == want
    assert want != rows(T.breaker(key(batch)), *cols)


def test_new_content(spark, log):
    batch, stream = log
    last, want = {}, []
    for r in batch.select(F.md5("text").alias("h"), "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).orderBy("us").collect():
        if r.h not in last or r.us - last[r.h] >= T.CONTENT_TTL:
            last[r.h] = r.us
            want.append((r.event_id,))
    got = rows(T.drain(T.new_content_stream(stream), work_folder(spark)), "event_id")
    assert got == sorted(want) and len(got) < batch.count()


def test_new_content_within_watermark(spark, log):
    """The built-in form never repeats a text within six hours."""
    _, stream = log
    out = T.drain(T.new_content_within_watermark(stream.withColumn("ts", F.col("ts").cast("timestamp"))), work_folder(spark))
    seen = {}
    for r in out.select("content_hash", F.unix_micros("ts").alias("us")).orderBy("us").collect():
        assert r.us - seen.get(r.content_hash, -T.CONTENT_TTL) >= T.CONTENT_TTL
        seen[r.content_hash] = r.us


def test_expiry_clears_counters(spark):
    """Two refusals, six hours of silence, two more: never blocked."""
    times = ["00:00:00", "01:00:00", "07:00:00", "08:00:00"]
    df = spark.createDataFrame([(i, f"2024-01-01 {t}", "d", 403, None) for i, t in enumerate(times)], "event_id long, t string, domain string, status_code int, error string")
    got = T.crawl_health(df.withColumn("ts", F.col("t").cast("timestamp_ntz"))).orderBy("event_id").collect()
    assert [r.forbidden_count for r in got] == [1, 2, 1, 2] and {r.health for r in got} == {"degraded"}


def test_attempts(spark, log):
    """The last row of a key is the batch counter; the state expires with the idle time."""
    batch, stream = log
    end = F.col("event_id") % 40 == 0
    got = {}
    for r in T.drain(T.attempts_stream(stream, "domain", end), work_folder(spark)).orderBy("us", "event_id").collect():
        got[r.domain] = r.attempts
    want = {r.domain: r.attempts for r in T.attempts(batch, "domain", end).collect()}
    assert got == want and 99 in want.values() and min(want.values()) < 99
    n, last = {}, {}
    short = {r.event_id: r.attempts for r in T.drain(T.attempts_stream(stream, "domain", F.lit(False), idle=6 * T.HOUR), work_folder(spark)).collect()}
    for r in batch.select("domain", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).orderBy("us", "event_id").collect():
        n[r.domain] = 1 if r.us - last.get(r.domain, r.us) >= 6 * T.HOUR else n.get(r.domain, 0) + 1
        last[r.domain] = r.us
        assert short[r.event_id] == n[r.domain]


def test_stuck_work(spark, log):
    batch, stream = log
    limit, lateness = 120, T.HOUR
    ordered = batch.select("domain", "event_id", "result", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).orderBy("us", "event_id").collect()
    latest, open_at, want = ordered[-1].us - lateness, {}, []
    for r in ordered:
        e = open_at.pop(r.domain, None)
        if e and r.us - e[1] > limit * T.HOUR // 60:
            want.append((r.domain, *e, e[1] + limit * T.HOUR // 60))
        if r.result != "ok":
            open_at[r.domain] = (r.event_id, r.us)
    want += [(d, *e, e[1] + limit * T.HOUR // 60) for d, e in open_at.items() if e[1] + limit * T.HOUR // 60 < latest]
    found = T.stuck_work_stream(stream, "domain", F.col("result") != "ok", minutes=limit)
    assert rows(T.drain(found, work_folder(spark)), "domain", "event_id", "us", "reset_us") == sorted(want)
    assert 0 < len(want) < batch.filter("result <> 'ok'").count()


def test_work_without_a_time_is_stuck_at_once(spark, log, tmp_path):
    batch, _ = log
    late = batch.withColumn("ts", F.when(F.col("event_id") % 9 != 0, F.col("ts")))
    late.write.parquet(str(tmp_path / "f"))
    stream = spark.readStream.schema(late.schema).parquet(str(tmp_path / "f"))
    out = T.drain(T.stuck_work_stream(stream, "domain", F.col("result") == "failed"), work_folder(spark))
    assert rows(out.filter("us IS NULL"), "event_id") == rows(late.filter("ts IS NULL AND result = 'failed'"), "event_id")


def test_poll_goes_on_where_it_stopped(spark, log, tmp_path):
    _, stream = log
    seen = []
    work = lambda df, i: seen.append(df.count())
    T.poll(stream, work, str(tmp_path / "p"), every=None).awaitTermination()
    first = sum(seen)
    T.poll(stream, work, str(tmp_path / "p"), every=None).awaitTermination()
    assert first == sum(seen) == 1000 and len(seen) == 4


def test_a_new_key_costs_few_state_calls():
    """Each call is a message to the JVM; a key's first rows read once, write once and set one timer."""
    calls = []

    class Value:
        held = None

        def exists(self):
            calls.append("exists")
            return self.held is not None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, new):
            calls.append("update")
            self.held = new

    class Handle:
        value = Value()

        def getValueState(self, *_):
            return self.value

        def listTimers(self):
            calls.append("list")
            return iter([7])

        def deleteTimer(self, at):
            calls.append(f"delete {at}")

        def registerTimer(self, at):
            calls.append("register")

    b = T._Breaker(T.BREAKER_IDLE)
    b.init(Handle())
    rows = pd.DataFrame({"key": "a", "event_id": [3, 1, 2], "us": [20, 10, 20], "result": ["failed", "failed", "limited"], "retry_us": [0, 0, 5]})
    first = next(b.handleInputRows(("a",), iter([rows.iloc[:1], rows.iloc[1:]]), None))
    assert calls == ["get", "update", "register"]
    assert first[["event_id", "failures", "open_until", "limited_until"]].values.tolist() == [[1, 1, 0, 0], [2, 2, 0, 25], [3, 3, 20 + T.COOLDOWN, 25]]
    calls.clear()
    next(b.handleInputRows(("a",), iter([rows.assign(us=rows.us + 100)]), None))
    assert calls == ["get", "update", "list", "delete 7", "register"]
