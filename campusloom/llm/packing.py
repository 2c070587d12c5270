"""Best-fit packing of token sequences by minimum bin slack.

Documents become pieces of at most `capacity` tokens. The plan works on the histogram of piece
lengths, which has at most `capacity` rows however large the corpus is: per bin, the longest
length left is taken and a bitset subset-sum over all lengths left finds the fullest feasible
rest. That combination stays the fullest one as long as its lengths last, because taking pieces
away never makes a fuller one possible, so it is used as often as they last. Every step at
least halves what one length has left of its need, so the plan has at most
capacity * log2(capacity) combinations. Pieces then find their place from their rank
within their length: ranks run in salted groups, so that one frequent length is no hot task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut
from .tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int | None = 0) -> DataFrame:
    """Pieces of every row of (doc_id, text). Null text is empty; an empty document is its end id.

    Only documents longer than capacity are cut: all their pieces but the first are full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for first, last in enc.slices(batch.column("text")):
                part = batch.slice(first, last - first)
                rows: list[tuple[int, ...]] = []
                for row, ids in enumerate(enc.encode(part.column("text"))):
                    ids += end
                    n = len(ids) // 4
                    cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)] if n else []
                    rows += [(row, piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for piece, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                columns = list(zip(*rows)) if rows else [()] * 5
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                ids_of = part.column("doc_id").take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids_of, *map(pa.array, columns[1:], types)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths left with the largest sum up to room; long lengths are preferred."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, n in left.items() if n and x <= room), reverse=True):
        most, part = min(left[length], room // length), 1
        while most:  # binary splitting of the number of copies
            part = min(part, most)
            steps.append((length, part, reach))
            reach |= (reach << length * part) & mask
            most, part = most - part, part * 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            total -= length * part
            out[length] = out.get(length, 0) + part
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: copies}) in the order of their bins; every piece of the histogram is in one."""
    left, out = {x: n for x, n in histogram.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest(left, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[x] // n for x, n in chosen.items())
        out.append((times, chosen))
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return out


def _places(combinations: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first bin, copies per bin, offset in the bin), ascending in rank."""
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    firsts = accumulate((t for t, _ in combinations), initial=0)
    for (times, chosen), first in zip(combinations, firsts):
        offset = 0
        for x in sorted(chosen, reverse=True):
            places.setdefault(x, []).append((ranks.get(x, 0), first, chosen[x], offset))
            ranks[x] = ranks.get(x, 0) + times * chosen[x]
            offset += x * chosen[x]
    return {x: np.array(rows, np.int64) for x, rows in places.items()}


def pack(cut_pieces: DataFrame, capacity: int, group_rows: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` up to capacity; extra columns stay.

    The pieces are read three times (histogram, ranks, offsets of ranks), so hand in a table, not
    a computation. Repeated rows are pieces of their own. No rows give no rows.
    """
    groups = F.pmod(F.xxhash64("doc_id", "piece", "start", F.monotonically_increasing_id()), F.lit(_salts(cut_pieces, group_rows))).cast("int")
    salted = cut(cut_pieces.withColumn("_salt", groups), "packing")
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}  # at most `capacity` rows
    places = _places(plan(histogram, capacity))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    inside = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start")
    ranked = salted.withColumn("_rank", F.row_number().over(inside)).join(before, ["length", "_salt"])
    ranked = ranked.select(*cut_pieces.columns, (F.col("_before") + F.col("_rank") - 1).alias("_rank"))
    schema = ranked.drop("_rank").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            lengths, at = np.unique(length[order], return_index=True)
            for x, rows in zip(lengths, np.split(order, at[1:])):
                table = places[int(x)]
                first, bin_, copies, start = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1].T
                own = rank[rows] - first
                sequence[rows], offset[rows] = bin_ + own // copies, start + own % copies * x
            kept = batch.drop_columns(["_rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], [*kept.schema.names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def _salts(rows: DataFrame, group_rows: int) -> int:
    return max(64, -(-rows.count() // group_rows))
