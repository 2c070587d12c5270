"""Groups of any size as pairs of bounded blocks, and look-ups by keys that many rows share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def looked_up(rows: DataFrame, keys: list[str], table: DataFrame, by: str, how: str = "left") -> DataFrame:
    """rows with the other columns of table, which holds each combination of keys once.

    A row's key gets one of SALTS salts from a hash of `by`. The distinct (key, salt) meet the table
    first, at most SALTS of them per key; the rows then meet these. So no task reads more than
    a share of a frequent key, and nothing is copied for the rare ones. Names starting with
    `_salt` are taken.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by, F.lit(17)), F.lit(SALTS)).cast("int"))
    asked = salted.select(*keys, "_salt").distinct().join(table, keys, how)
    return salted.join(asked, [*keys, "_salt"], how).drop("_salt")


def block_pairs(rows: DataFrame, keys: list[str], by: str, block_rows: int) -> DataFrame:
    """rows with bi, bj, own: each group of keys as pairs of blocks (bi <= bj), `own` the row's block.

    Blocks hold about block_rows rows. Groups of one row are left out.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    sized = looked_up(rows, keys, sizes, by, "inner").withColumn("_blocks", F.ceil(F.col("_n") / block_rows).cast("int"))
    own = sized.withColumn("own", F.pmod(F.xxhash64(by, F.lit(3)), F.col("_blocks")).cast("int"))
    pairs = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return pairs.withColumns({"bi": F.least("own", "_other"), "bj": F.greatest("own", "_other")}).drop("_n", "_blocks", "_other")


def _numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(0, int)
    new = np.zeros(table.num_rows - 1, bool)
    for name in keys:
        column = table.column(name).combine_chunks()
        new |= np.asarray(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)))
    return np.concatenate([[0], np.cumsum(new)])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of sorted rows, some at a time, with a number for each row's group."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = [pa.Table.from_batches([b.slice(b.num_rows - 1)]) for b in (*rest[-1:], batch)]
        more = bool(rest) and _numbers(pa.concat_tables(ends), keys)[-1] == 0
        rest.append(batch)
        if more:  # one group so far, or the last one goes on to the end of this batch
            continue
        table = pa.Table.from_batches(rest)
        group = _numbers(table, keys)
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield table.slice(0, last), group[:last]
        rest = table.slice(last).to_batches()
    if rest:
        table = pa.Table.from_batches(rest)
        yield table, _numbers(table, keys)


def spans(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal group numbers."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, int)
    return starts, np.diff(np.append(starts, len(group)))


def short_pairs(group: np.ndarray, own: np.ndarray, single: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows within groups of at most `most` rows, one distance at a time.

    Where a group is two different blocks (not single), only pairs between them count.
    """
    starts, sizes = spans(group)
    left = np.flatnonzero(np.repeat(sizes <= most, sizes))
    for distance in range(1, most):
        left = left[left + distance < len(group)]
        left = left[group[left] == group[left + distance]]
        if not len(left):
            return
        ok = single[left] | (own[left] != own[left + distance])
        yield left[ok], left[ok] + distance


def tiles(group: np.ndarray, own: np.ndarray, single: np.ndarray, least: int, side: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (a, b) of tiles that together hold every pair of the groups above `least` rows once.

    Within a block, a tile on the diagonal has a and b the same: of it only pairs above the diagonal count.
    """
    for start, size in zip(*spans(group)):
        if size <= least:
            continue
        rows = np.arange(start, start + size)
        if single[start]:
            parts = [rows[k : k + side] for k in range(0, size, side)]
            yield from ((a, b) for i, a in enumerate(parts) for b in parts[i:])
        else:
            first, second = rows[own[rows] == own[start]], rows[own[rows] != own[start]]
            yield from ((first[i : i + side], second[j : j + side]) for i in range(0, len(first), side) for j in range(0, len(second), side))
