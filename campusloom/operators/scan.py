"""Running state per key in one scan: blocks of a range partitioning, each with one composable summary.

Rows are dealt by range over (keys, order), so a block is a stretch of about equal numbers of rows,
whatever a key holds and however time runs.  Inside a block, windows give every row what it would have
if the key began there.  The result is written once.  The last row of each (block, key) is the
block's summary; a window over these few rows per key gives what comes before each block, and a row's
final value is a formula of its own columns and of those.  The input is read once, its rows are
shuffled by range and by (block, key), and summaries meet them by (block, key).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F

from campusloom.session import durable

BLOCK, NO = "__block", "__no"
Columns = dict[str, Column]


class Blocks:
    """Windows of one scan: ``row`` up to the current row of a block, ``place`` for offsets in it,
    ``upto`` and ``before`` over the summaries of a key."""

    def __init__(self, keys: list[str], order: list[str]) -> None:
        self.place: WindowSpec = W.partitionBy(BLOCK, *keys).orderBy(*order)
        self.row = self.place.rowsBetween(W.unboundedPreceding, W.currentRow)
        # Without keys there is one series: its summaries, one per block, meet in one window.
        by_key = (W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))).orderBy(BLOCK)
        self.by_key = by_key
        self.upto = by_key.rowsBetween(W.unboundedPreceding, W.currentRow)
        self.before = by_key.rowsBetween(W.unboundedPreceding, -1)


def scanned(
    df: DataFrame, keys: list[str], order: list[str],
    within: list[Callable[[Blocks], Columns]], across: list[Callable[[Blocks], Columns]],
) -> DataFrame:
    """df with the columns of ``within`` (inside the block) and of ``across`` (from earlier blocks of the key).

    Both are lists of steps; a step may read the columns of those before it.  ``across`` runs over one row
    per (block, key), the last one.  ``order`` must be unique within a key for a defined result.  A
    row's number in its block is in NO.  NULL keys are a key.
    """
    blocks = Blocks(keys, order)
    local = df.repartitionByRange(*keys, *order).withColumn(BLOCK, F.spark_partition_id())
    local = local.withColumn(NO, F.row_number().over(blocks.place))
    local = local.withColumn("__more", F.lead(F.lit(True)).over(blocks.place))
    for step in within:
        local = local.withColumns(step(blocks))
    local = durable(local)
    tails = local.filter(F.col("__more").isNull())
    made: list[str] = []
    for step in across:
        new = step(blocks)
        tails, made = tails.withColumns(new), [*made, *new]
    names = {c: f"__k_{c}" for c in (BLOCK, *keys)}
    carry = tails.select(*[F.col(c).alias(n) for c, n in names.items()], *made)
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    return local.join(carry, on).drop(*names.values(), "__more")


def running_sums(df: DataFrame, keys: list[str], order: list[str], sums: Columns) -> DataFrame:
    """Inclusive running sums per key; NULL counts as 0."""
    zero = F.lit(0)
    out = scanned(
        df, keys, order,
        [lambda b: {f"__l_{n}": F.sum(F.coalesce(c, zero)).over(b.row) for n, c in sums.items()}],
        [lambda b: {f"__c_{n}": F.coalesce(F.sum(f"__l_{n}").over(b.before), zero) for n in sums}],
    )
    return out.select(*df.columns, *[(F.col(f"__l_{n}") + F.col(f"__c_{n}")).alias(n) for n in sums])


def earlier_row(df: DataFrame, keys: list[str], order: list[str], back: int, columns: list[str], number: str) -> DataFrame:
    """df with ``number`` (1-based per key) and, as ``__old``, a struct of the columns ``back`` rows earlier, of the first row where there are fewer.

    A block's summary holds its last ``back`` rows, of which the next blocks need no more.
    """
    row = F.struct(*columns)

    def within(b: Blocks) -> Columns:
        return {
            "__lag": F.lag(row, back).over(b.place), "__first": F.first(row).over(b.row),
            "__late": F.when(F.lead(F.lit(1), back).over(b.place).isNull(), row),
        }

    def tail(b: Blocks) -> Columns:
        return {"__tail": F.collect_list("__late").over(b.row)}

    def across(b: Blocks) -> Columns:
        # Each earlier block holds one row at least, so so many blocks hold all that is needed.
        held = F.flatten(F.collect_list("__tail").over(b.by_key.rowsBetween(-back, -1)))
        return {
            "__before": F.coalesce(F.sum(NO).over(b.before), F.lit(0)),
            "__held": F.slice(held, F.greatest(F.size(held) - (back - 1), F.lit(1)), F.lit(back)),
            "__start": F.first("__first").over(b.upto),
        }

    out = scanned(df, keys, order, [within, tail], [across])
    # The row wanted is number - back: among those held, in the block, or the key's first.
    at = F.size("__held") + F.col(NO) - back
    old = F.when(F.col("__lag").isNotNull(), F.col("__lag")).when(at >= 1, F.try_element_at("__held", at)).otherwise(F.col("__start"))
    return out.select(*df.columns, (F.col("__before") + F.col(NO)).alias(number), old.alias("__old"))


def resets(micros: str, is_reset: Column, fires: Columns, ttl: int | None) -> tuple[list, list, Callable[[str], Column], Column]:
    """Steps that count since the last reset: (within, across, count of a counter, whether a silence of ttl came before the row).

    A reset row clears the counters, and so does a silence of at least ttl before a row.  Counters must
    not fire on a reset row.  A row without an earlier clearing in its block (``__own`` is false) goes on
    with what the key brought there, unless the silence lay between the blocks.
    """
    never = F.lit(False)

    def silent(b: Blocks) -> Columns:
        gap = F.col(micros) - F.lag(micros).over(b.place)
        quiet = never if ttl is None else F.coalesce(gap >= F.lit(ttl), never)
        return {"__quiet": quiet, "__clear": quiet | F.coalesce(is_reset, never), "__from": F.first(micros).over(b.row)} | {
            f"__f_{n}": F.coalesce(c, never).cast("long") for n, c in fires.items()
        }

    def sums(b: Blocks) -> Columns:
        return {f"__r_{n}": F.sum(f"__f_{n}").over(b.row) for n in fires} | {"__own": F.max("__clear").over(b.row)}

    def since(b: Blocks) -> Columns:
        # Running counts never fall, so the count at the last clearing is a running maximum.
        at = {n: F.max(F.when(F.col("__clear"), F.col(f"__r_{n}") - F.col(f"__f_{n}"))).over(b.row) for n in fires}
        return {f"__s_{n}": F.col(f"__r_{n}") - F.coalesce(c, F.lit(0)) for n, c in at.items()}

    def gap(b: Blocks) -> Columns:
        quiet = never if ttl is None else F.coalesce(F.col("__from") - F.lag(micros).over(b.by_key) >= F.lit(ttl), never)
        return {"__gap": quiet} | {f"__t_{n}": F.sum(f"__r_{n}").over(b.upto) for n in fires}

    def base(b: Blocks) -> Columns:
        # The total before the last clearing, of this block or between it and the one before.
        cleared = lambda n: F.when(F.col("__own"), F.col(f"__t_{n}") - F.col(f"__s_{n}")).when(F.col("__gap"), F.col(f"__t_{n}") - F.col(f"__r_{n}"))
        return {f"__o_{n}": F.col(f"__t_{n}") - F.coalesce(F.max(cleared(n)).over(b.upto), F.lit(0)) for n in fires}

    def brought(b: Blocks) -> Columns:
        return {f"__i_{n}": F.coalesce(F.lag(f"__o_{n}").over(b.by_key), F.lit(0)) for n in fires}

    goes_on = ~F.col("__own") & ~F.col("__gap")
    count = lambda n: F.col(f"__s_{n}") + F.when(goes_on, F.col(f"__i_{n}")).otherwise(0)
    return [silent, sums, since], [gap, base, brought], count, F.when(F.col(NO) == 1, F.col("__gap")).otherwise(F.col("__quiet"))


def counts_since_reset(df: DataFrame, keys: list[str], order: list[str], micros: str, counters: Columns, is_reset: Column, ttl: int | None = None) -> DataFrame:
    """Per event how many times each counter fired since the last reset or silence of ``ttl``."""
    within, across, count, _ = resets(micros, is_reset, counters, ttl)
    out = scanned(df, keys, order, within, across)
    return out.select(*df.columns, *[count(n).alias(n) for n in counters])
