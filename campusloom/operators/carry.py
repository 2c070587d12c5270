"""Running sums and maxima per key that stay parallel when one key is huge.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one
task.  Here a key is cut into buckets that are monotone in the order column
(an hour of ``ts``, a block of ``position``): only one summary row per bucket
takes part in the per-key window, and what it yields opens the bucket as an
extra row, so that the rows themselves are shuffled once, by (key, bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

_BUCKET, _MARK = "__bucket", "__mark"


def running(
    df: DataFrame,
    keys: list[str],
    order: list,
    bucket: Column,
    sums: dict[str, Column] | None = None,
    maxes: dict[str, Column] | None = None,
    maxes_before: dict[str, Column] | None = None,
) -> DataFrame:
    """Add inclusive running sums / maxima and exclusive running maxima.

    ``bucket`` must not decrease along ``order`` within a key.  An empty
    ``keys`` means one global series.  Sums count NULL as 0; maxima ignore it.
    """
    sums, maxes, maxes_before = sums or {}, maxes or {}, maxes_before or {}
    values = {**sums, **maxes, **maxes_before}
    base = df.select(
        "*", bucket.alias(_BUCKET), F.lit(1).alias(_MARK), *[c.alias(f"__v_{n}") for n, c in values.items()]
    )
    part = [*keys, _BUCKET]
    totals = base.groupBy(*part).agg(
        *[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in sums],
        *[F.max(f"__v_{n}").alias(f"__v_{n}") for n in (*maxes, *maxes_before)],
    )
    earlier = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy(_BUCKET).rowsBetween(
        W.unboundedPreceding, -1
    )
    # One extra row opens each bucket with what came before it, so the window
    # inside the bucket already yields the values of the whole key: the rows
    # are shuffled once and nothing is joined back.
    opening = totals.select(
        *part, F.lit(0).alias(_MARK),
        *[F.sum(f"__v_{n}").over(earlier).alias(f"__v_{n}") for n in sums],
        *[F.max(f"__v_{n}").over(earlier).alias(f"__v_{n}") for n in (*maxes, *maxes_before)],
    )
    local = W.partitionBy(*part).orderBy(F.col(_MARK), *order)
    upto = local.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = local.rowsBetween(W.unboundedPreceding, -1)
    added = [
        *[F.sum(F.coalesce(F.col(f"__v_{n}"), F.lit(0))).over(upto).alias(n) for n in sums],
        *[F.max(f"__v_{n}").over(upto).alias(n) for n in maxes],
        *[F.max(f"__v_{n}").over(before).alias(n) for n in maxes_before],
    ]
    both = base.unionByName(opening, allowMissingColumns=True)
    return both.select(*[F.col(c) for c in df.columns], _MARK, *added).filter(F.col(_MARK) == 1).drop(_MARK)


def arrival_number(df: DataFrame, keys: list[str], order: list, bucket: Column, name: str = "arrival_no") -> DataFrame:
    """``row_number()`` per key (1-based) without a whole key in one task."""
    return running(df, keys, order, bucket, sums={name: F.lit(1).cast("long")})
