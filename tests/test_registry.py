"""Every registered query against its SQL, and without cross joins."""

import re

import duckdb
import pytest

from registry import QUERIES
from registry.views import BASE
from tools.check_sql import norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in BASE:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    q = QUERIES[name]
    df = q(spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    if q.sql is None:
        assert got
        return
    rel = duck.execute(q.sql)
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in rel.fetchall())


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = QUERIES["filtered_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_orderkey", "o_orderstatus", "o_totalprice"}


def test_contract(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns == ["entity_type", "slug", "impressions", "ctr", "url"]


def test_responses_of_a_small_file_are_cleaned_on_all_cores(spark):
    """The customers are one split of their file: cleaning them ran in one task."""
    df = QUERIES["cleaned_responses"](spark, SF)
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_entity_search_asks_for_every_record(spark, tmp_path):
    """It asked for the names of every hundredth record only. Expected: itself, then the records with the most and smallest keys."""
    rows = [(k, f"Customer#{k:09d}", k % 25, "BUILDING", 10.0 * k) for k in (1, 2, 3, 30, 37, 150)] + [(7, None, None, None, None)]
    made = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double")
    made.write.parquet(f"{tmp_path}/customer.parquet")
    got = {}
    for r in QUERIES["entity_search"](spark, str(tmp_path)).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append((r.entity_id, r.score))
    full, short = {k: 12.0 if k % 30 else 10.0 for k, *_ in rows if k != 7}, {k: 24.0 if k % 30 else 20.0 for k, *_ in rows if k != 7}
    want = {f"customer {k:09d}": sorted({**full, k: short[k]}.items(), key=lambda e: (-e[1], e[0]))[:3] for k in full}
    assert got == want
