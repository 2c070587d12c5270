"""State over event logs, as batch and as stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from campusloom.plans import backfill
from campusloom.session import work_folder
from campusloom.streaming import states as T
from registry.base import query
from registry.matching import _PICK
from registry.views import VIEWS

_KIND = "CASE WHEN status_code = 403 THEN 'forbidden' WHEN error = 'ETIMEDOUT' THEN 'unreachable' WHEN status_code IS NULL OR status_code >= 500 THEN 'server' ELSE 'ok' END"
_HEALTH = f"""(SELECT *, CASE kind WHEN 'forbidden' THEN CASE WHEN forbidden_count >= 3 THEN 'blocked' ELSE 'degraded' END WHEN 'unreachable' THEN CASE WHEN unreachable_count >= 3 THEN 'dead' ELSE 'degraded' END WHEN 'server' THEN 'degraded' ELSE 'healthy' END AS health FROM
 (SELECT *, CAST(SUM(CASE WHEN kind = 'forbidden' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS forbidden_count, CAST(SUM(CASE WHEN kind = 'unreachable' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS unreachable_count FROM
  (SELECT *, SUM(CASE WHEN kind = 'ok' OR ts - prev >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY domain ORDER BY ts, event_id) AS seg FROM
   (SELECT *, {_KIND} AS kind, lag(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) AS prev FROM fx_crawl) a) b WINDOW w AS (PARTITION BY domain, seg ORDER BY ts, event_id)) c)"""


def _stream(t, view: str):
    """A view over the event files as a stream."""
    raw = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{t.dir}/events*.parquet")
    raw.createOrReplaceTempView("events_stream")
    return t.spark.sql(VIEWS[view].replace("FROM events", "FROM events_stream"))


@query("T1", f"SELECT event_id, domain, forbidden_count, unreachable_count, health FROM {_HEALTH} h")
def crawl_health(t):
    return T.crawl_health(t.fx_crawl).select("event_id", "domain", "forbidden_count", "unreachable_count", "health")


@query("T1", f"SELECT event_id, domain, forbidden_count, unreachable_count, health FROM {_HEALTH} h")
def crawl_health_stream(t):
    s = T.crawl_health_stream(_stream(t, "fx_crawl"))
    return T.drain(s, work_folder(t.spark)).select("event_id", "domain", "forbidden_count", "unreachable_count", "health")


@query(
    "T1",
    f"""SELECT domain, CASE WHEN last_seen + INTERVAL 6 HOUR > TIMESTAMP '2024-01-30 22:00:00' THEN h ELSE 'healthy' END AS health, NOT (last_seen + INTERVAL 6 HOUR > TIMESTAMP '2024-01-30 22:00:00' AND h IN ('blocked', 'dead')) AS can_crawl
FROM (SELECT domain, arg_max(health, ts) AS h, MAX(ts) AS last_seen FROM {_HEALTH} x GROUP BY domain) y""",
)
def crawlable_domains(t):
    latest = T.latest_health(T.crawl_health(t.fx_crawl))
    now = F.lit("2024-01-30 22:00:00").cast("timestamp_ntz")
    return T.can_crawl(t.fx_crawl.select("domain").distinct(), latest, now).select("domain", "health", "can_crawl")


_CALLS = """(SELECT *, MAX(CASE WHEN result = 'failed' AND failures >= 3 THEN us + 300000000 ELSE 0 END) OVER (PARTITION BY key, seg ORDER BY ts, event_id) AS open_until,
 coalesce(last_value(CASE WHEN result = 'limited' THEN us + CASE WHEN retry_after_ms > 0 THEN retry_after_ms * 1000 ELSE least(60000000 * failures, 300000000) END END IGNORE NULLS) OVER (PARTITION BY key ORDER BY ts, event_id), 0) AS limited_until FROM
 (SELECT *, CAST(SUM(CASE WHEN result <> 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY key, seg ORDER BY ts, event_id) AS BIGINT) AS failures FROM
  (SELECT *, epoch_us(ts) AS us, SUM(CASE WHEN result = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts, event_id) AS seg FROM fx_call) a) b)"""


@query("T5", f"SELECT event_id, key, failures, CAST(open_until AS BIGINT) AS open_until, CAST(limited_until AS BIGINT) AS limited_until, open_until <= us AND limited_until <= us AS available FROM {_CALLS} c")
def breaker_states(t):
    return T.breaker(t.fx_call).select("event_id", "key", "failures", "open_until", "limited_until", "available")


@query("T5", f"SELECT event_id, key, failures, CAST(open_until AS BIGINT) AS open_until, CAST(limited_until AS BIGINT) AS limited_until FROM {_CALLS} c")
def breaker_states_stream(t):
    s = T.breaker_stream(_stream(t, "fx_call"))
    return T.drain(s, work_folder(t.spark)).select("event_id", "key", "failures", "open_until", "limited_until")


@query(
    "T2 V16",
    """WITH RECURSIVE x AS (SELECT md5(repeat(event_type || CAST(user_id % 10 AS VARCHAR) || '-', 40)) AS h, event_id, epoch_us(ts) AS us FROM events),
kept AS (SELECT h, MIN(us) AS us FROM x GROUP BY h UNION ALL SELECT x.h, MIN(x.us) FROM kept k JOIN x ON x.h = k.h AND x.us >= k.us + 21600000000 GROUP BY x.h, k.us)
SELECT x.h AS content_hash, x.event_id FROM kept k JOIN x ON x.h = k.h AND x.us = k.us""",
)
def new_contents_stream(t):
    raw = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{t.dir}/events*.parquet")
    text = F.repeat(F.concat("event_type", (F.col("user_id") % 10).cast("string"), F.lit("-")), 40)
    s = T.new_content_stream(raw.withColumn("text", text))
    return T.drain(s, work_folder(t.spark)).select("content_hash", "event_id")


_LOG = "(SELECT 'https://' || domain || '/' || CAST(event_id % 50 AS VARCHAR) AS url, ts, CASE WHEN event_id % 10 = 0 THEN 404 ELSE status_code END AS status_code, CASE WHEN event_id % 17 = 0 THEN 'getaddrinfo ENOTFOUND' ELSE error END AS error FROM fx_crawl) l"


@query("T3 S11", f"SELECT left(sha256(url), 32) AS url_hash, MAX(ts) AS failed_at FROM {_LOG} WHERE status_code = 404 OR contains(error, 'ENOTFOUND') GROUP BY 1 HAVING MAX(ts) + INTERVAL 168 HOUR > TIMESTAMP '2024-01-30 12:00:00'")
def failed_urls(t):
    c = t.fx_crawl
    log = c.select(
        F.concat(F.lit("https://"), c.domain, F.lit("/"), (c.event_id % 50).cast("string")).alias("url"), "ts",
        F.when(c.event_id % 10 == 0, 404).otherwise(c.status_code).alias("status_code"),
        F.when(c.event_id % 17 == 0, "getaddrinfo ENOTFOUND").otherwise(c.error).alias("error"),
    )
    return T.failed_urls(T.failed_marks(log), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))


@query("T7", "SELECT domain, CASE WHEN bool_or(event_id % 500 = 0) THEN 99 ELSE COUNT(*) END AS attempts FROM fx_crawl GROUP BY domain")
def crawl_attempts(t):
    return T.attempts(t.fx_crawl, "domain", F.col("event_id") % 500 == 0)


@query(
    "T7",
    """SELECT event_id, domain, CASE WHEN bool_or(event_id % 500 = 0) OVER w THEN 99 ELSE COUNT(*) OVER w END AS attempts
FROM fx_crawl WINDOW w AS (PARTITION BY domain ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def crawl_attempts_stream(t):
    s = T.attempts_stream(_stream(t, "fx_crawl"), "domain", F.col("event_id") % 500 == 0)
    return T.drain(s, work_folder(t.spark)).select("event_id", "domain", "attempts")


@query(
    "T4",
    """SELECT domain, event_id, epoch_us(ts) AS us, epoch_us(ts) + 1200000000 AS reset_us
FROM (SELECT *, lead(ts) OVER (PARTITION BY domain ORDER BY ts, event_id) AS following, MAX(ts) OVER () AS latest FROM fx_crawl) x
WHERE status_code = 200 AND coalesce(following, latest - INTERVAL 60 MINUTE) > ts + INTERVAL 20 MINUTE""",
)
def stuck_work_stream(t):
    """Successful crawls start the processing of a domain; the next crawl of it ends that."""
    s = T.stuck_work_stream(_stream(t, "fx_crawl"), "domain", F.col("status_code") == 200)
    return T.drain(s, work_folder(t.spark)).select("domain", "event_id", "us", "reset_us")


@query("T6", "SELECT event_id, user_id FROM events WHERE event_type = 'error'")
def polled_records(t):
    """Micro-batches of open records, each written by its own job."""
    folder = work_folder(t.spark)
    raw = t.spark.readStream.schema(t.events.schema).parquet(f"{t.dir}/events*.parquet").filter("event_type = 'error'")

    def work(batch, batch_id):
        batch.select("event_id", "user_id").write.mode("overwrite").parquet(f"{folder}/out/batch={batch_id}")

    T.poll(raw, work, f"{folder}/progress", every=None).awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").select("event_id", "user_id")


@query("S10 A7", f"SELECT DISTINCT f.entity_id, p.course_id FROM fx_program f JOIN {_PICK} p ON p.category = f.category AND p.level = f.level WHERE p.course_id IS NOT NULL")
def resumed_backfill(t):
    """A backfill stopped after its first batch and then resumed."""
    folder = work_folder(t.spark)
    args = (t.fx_entity, t.fx_program, t.fx_course, folder, "all")
    size = t.fx_entity.count() // 2 + 1
    backfill.resumable_backfill(*args, size=size, max_batches=1)
    backfill.resumable_backfill(*args, size=size, resume=True)
    return t.spark.read.parquet(f"{folder}/entity_course").select("entity_id", "course_id")
