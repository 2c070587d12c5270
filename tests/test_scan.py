"""Running state in one scan: against plain loops over skewed keys cut into many blocks, and the number of scans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from campusloom.operators import ranking, reports, scan
from campusloom.streaming import states as T

MINUTE = 60_000_000


def crawl_log(seed, n):
    """A third of all rows under one domain; silences around six hours; some null domains."""
    rng = random.Random(seed)
    rows, now = [], 1_700_000_000_000_000
    for k in range(n):
        now += rng.choice([1, 5, 60, 359, 360, 400]) * MINUTE
        code, error = rng.choice([(403, None), (403, None), (None, "ETIMEDOUT"), (500, None), (200, None), (404, None)])
        rows.append((rng.choice(["a", "a", "b", "c", None]), k, now, code, error))
    return rows


def log_frame(spark, rows):
    df = spark.createDataFrame(rows, "domain string, event_id long, us long, status_code int, error string")
    return df.withColumn("ts", F.timestamp_micros("us")).drop("us").repartition(5)


def health_by_hand(rows):
    state, out = {}, {}
    for domain, k, us, code, error in sorted(rows, key=lambda r: (r[2], r[1])):
        f, u, at = state.get(domain, (0, 0, None))
        kind = "forbidden" if code == 403 else "unreachable" if error else "server" if code == 500 else "ok"
        if kind == "ok" or (at is not None and us - at >= T.HEALTH_TTL):
            f = u = 0
        f, u = f + (kind == "forbidden"), u + (kind == "unreachable")
        state[domain], out[k] = (f, u, us), (f, u)
    return out


@pytest.mark.parametrize(("seed", "blocks"), [(1, 4), (2, 40), (3, 150)])
def test_crawl_health_over_many_blocks(spark, seed, blocks):
    rows = crawl_log(seed, 400)
    with_blocks(spark, blocks)
    try:
        got = {r.event_id: (r.forbidden_count, r.unreachable_count) for r in T.crawl_health(log_frame(spark, rows)).collect()}
    finally:
        with_blocks(spark, None)
    assert got == health_by_hand(rows)


def with_blocks(spark, n):
    """So many range partitions, none of them merged; None for the settings before."""
    for k, v in {"spark.sql.shuffle.partitions": n or 4, "spark.sql.adaptive.coalescePartitions.enabled": "false" if n else "true"}.items():
        spark.conf.set(k, v)


def breaker_by_hand(calls, idle):
    state, out = {}, {}
    for key, k, us, result, retry in sorted(calls, key=lambda r: (r[2], r[1])):
        n, opened, limited, at = state.get(key, (0, 0, 0, None))
        if idle and at is not None and us - at >= idle:
            n = opened = limited = 0
        if result == "ok":
            n = opened = 0
        elif result == "limited":
            n, limited = n + 1, us + (retry * 1000 if retry else min(T.BACKOFF_STEP * (n + 1), T.BACKOFF_MAX))
        else:
            n += 1
            opened = us + T.COOLDOWN if n >= T.LIMIT else opened
        state[key], out[k] = (n, opened, limited, us), (n, opened, limited, opened <= us and limited <= us)
    return out


@pytest.mark.parametrize(("seed", "blocks", "idle"), [(1, 4, None), (2, 60, None), (3, 60, 30 * MINUTE), (4, 200, 6 * MINUTE)])
def test_breaker_over_many_blocks(spark, seed, blocks, idle):
    rng = random.Random(seed)
    calls, now = [], 1_700_000_000_000_000
    for k in range(400):
        now += rng.choice([1, 1, 2, 6, 30]) * MINUTE
        calls.append((rng.choice(["x", "x", "x", "y", "z"]), k, now, rng.choices(["ok", "failed", "limited"], [1, 4, 2])[0], rng.choice([None, 0, 90_000])))
    df = spark.createDataFrame(calls, "key string, event_id long, us long, result string, retry_after_ms long").withColumn("ts", F.timestamp_micros("us")).drop("us")
    with_blocks(spark, blocks)
    try:
        got = {r.event_id: (r.failures, r.open_until, r.limited_until, r.available) for r in T.breaker(df, idle).collect()}
    finally:
        with_blocks(spark, None)
    assert got == breaker_by_hand(calls, idle)


@pytest.mark.parametrize("blocks", [3, 90])
def test_earlier_row_and_sums_over_many_blocks(spark, blocks):
    rows = [(k % 3 if k % 2 else 0, k, k * 7 % 50) for k in range(300)]
    df = spark.createDataFrame(rows, "g int, k long, v long").repartition(4)
    with_blocks(spark, blocks)
    try:
        old = scan.earlier_row(df, ["g"], ["k"], 29, ["k", "v"], "no").collect()
        sums = scan.running_sums(df, ["g"], ["k"], {"s": F.col("v")}).collect()
        whole = scan.earlier_row(df, [], ["k"], 29, ["k"], "no").collect()
    finally:
        with_blocks(spark, None)
    for g in (0, 1, 2):
        own = [r for r in rows if r[0] == g]
        want = {r[1]: (n + 1, own[max(n - 29, 0)][1:], sum(x[2] for x in own[: n + 1])) for n, r in enumerate(own)}
        assert {r.k: (r.no, tuple(r["__old"])) for r in old if r.g == g} == {k: v[:2] for k, v in want.items()}
        assert {r.k: r.s for r in sums if r.g == g} == {k: v[2] for k, v in want.items()}
    assert {r.k: (r.no, r["__old"].k) for r in whole} == {k: (k + 1, max(k - 29, 0)) for k in range(300)}


def test_empty_tables(spark):
    assert T.crawl_health(log_frame(spark, crawl_log(1, 5)).limit(0)).collect() == []
    empty = spark.createDataFrame([], "ts timestamp, done long, pending long")
    assert reports.rate_and_eta(empty).collect() == []


def test_input_is_scanned_once(spark, tmp_path):
    """The four operators read their input in one scan of one job plan; what they return reads only the written blocks."""
    path = f"file://{tmp_path}/log"
    log_frame(spark, crawl_log(5, 50)).write.parquet(path)
    log = spark.read.parquet(path)
    calls = log.select(F.col("domain").alias("key"), "event_id", "ts", F.lit("failed").alias("result"), F.lit(0).cast("long").alias("retry_after_ms"))
    samples = log.select("ts", F.col("event_id").alias("done"), F.col("event_id").alias("pending"))
    made = {
        "crawl_health": lambda: T.crawl_health(log),
        "breaker_states": lambda: T.breaker(calls),
        "adaptive_reading": lambda: ranking.adaptive_pages(log, "domain", "event_id", F.col("status_code")),
        "processing_rate": lambda: reports.rate_and_eta(samples),
    }
    written: list[str] = []
    kept = scan.durable

    def durable(df):
        written.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    scan.durable = durable
    try:
        for name, build in made.items():
            written.clear()
            returned = build()._jdf.queryExecution().executedPlan().toString()
            assert len(written) == 1 and len(re.findall("FileScan parquet", written[0])) == 1, name
            assert written[0].count("Exchange rangepartitioning") == 1 and written[0].count("Exchange hashpartitioning") == 1, name
            assert path.removeprefix("file://") not in returned, name
    finally:
        scan.durable = kept
