"""Mixing sources to target weights by balanced sampling with the cube method.

Every source gets a target number of words. A document of a source is taken
floor(target / size of the source) times, and once more with the remaining fraction as its
probability. The cube method decides these extra copies: the vector of probabilities moves
through the null space of the constraints (number of documents, number of words), up or down
at random so that each probability keeps its expectation, until a document's value is 0 or 1.
Per block at most two documents stay undecided; they meet in further rounds of blocks, and a
landing without the word constraint settles the last two of a source. The longest undecided
document leads each move, so that short documents are left for the landing.

Blocks are hashed parts of a source of bounded size, so a source of any size is spread out.
The random numbers come from the source's place, round and block: reruns agree.

Null and empty texts have size 0 and are taken 0 times. A null source is a source of its own.
Repeated rows are documents of their own. Extra columns stay, but those named like a result are
replaced; other names used here start with `_mix_`. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
RESULT = ("place", "n_docs", "source_size", "target", "copies", "taken")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = 3.0) -> DataFrame:
    """Per source of (source, size): place, n_docs, source_size, target.

    Sources in code point order, nulls last, get the weights in turn and share `share` of all
    sizes. A target stops at `most` times its source's size and the others take the excess by
    weight: with sources sorted by limit / weight, those at their limit come first. The windows
    run over one row per source.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    placed = sums.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    placed = placed.withColumns({"_mix_weight": weight, "_mix_limit": F.col("source_size") * F.lit(float(most)), "_mix_total": total})
    by_ratio = Window.orderBy(F.col("_mix_limit") / F.col("_mix_weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.col("_mix_total") - F.coalesce(F.sum("_mix_limit").over(before), F.lit(0.0))) / F.sum("_mix_weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    placed = placed.withColumn("_mix_rate", rate)
    below = F.col("_mix_rate") * F.col("_mix_weight") < F.col("_mix_limit")
    first = F.min_by(F.when(below, F.col("_mix_rate")), F.when(below, F.col("_mix_limit") / F.col("_mix_weight"))).over(Window.partitionBy())
    target = F.least(F.col("_mix_limit"), F.coalesce(first * F.col("_mix_weight"), F.col("_mix_limit")))
    return placed.select("source", "place", "n_docs", "source_size", target.alias("target"))


def flight(p: np.ndarray, x: np.ndarray, draw: Callable[[], float]) -> np.ndarray:
    """Moves probabilities p of documents with sizes x until at most two are not 0 or 1.

    sum(p) and sum(p * x) stay as they are. The direction is the projection of the longest
    undecided document's unit vector on the null space of both constraints.
    """
    p = p.copy()
    active = np.flatnonzero((p > 0) & (p < 1))
    active = active[np.argsort(-x[active], kind="stable")]
    while len(active) > 1:
        q, c = p[active], x[active] - x[active].mean()
        spread = c @ c
        u = -(c * (c[0] / spread if spread > 0 else 0.0) + 1 / len(active))
        u[0] += 1
        if len(active) == 2 and spread > 0 or abs(u).max() < 1e-12:
            break
        u[abs(u) < 1e-15] = 0
        p[active], done = _moved(q, u, draw())
        active = active[~done]
    return p


def _moved(q: np.ndarray, u: np.ndarray, chance: float) -> tuple[np.ndarray, np.ndarray]:
    """q moved along u or against it to the first bound, and which values are 0 or 1 then."""
    up, down = u > 0, u < 0
    ahead = min(((1 - q[up]) / u[up]).min(initial=np.inf), (q[down] / -u[down]).min(initial=np.inf))
    back = min((q[up] / u[up]).min(initial=np.inf), ((1 - q[down]) / -u[down]).min(initial=np.inf))
    q = q + (ahead if chance * (ahead + back) < back else -back) * u
    q[q < 1e-9], q[q > 1 - 1e-9] = 0.0, 1.0
    return q, (q == 0) | (q == 1)


def landing(p: np.ndarray, draw: Callable[[], float]) -> np.ndarray:
    """Settles what a flight left: pairs keep their sum, the last one is drawn by its probability."""
    p = p.copy()
    while len(left := np.flatnonzero((p > 0) & (p < 1))) > 1:
        p[left[:2]], _ = _moved(p[left[:2]], np.array([1.0, -1.0]), draw())
    for k in left:
        p[k] = float(draw() < p[k])
    return p


def _round(number: int, last: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_mix_size", "_mix_row"], kind="stable")
        draw = np.random.default_rng([number, *map(int, key)]).random
        p = flight(rows["_mix_p"].to_numpy(float), rows["_mix_size"].to_numpy(float), draw)
        return rows.assign(_mix_p=landing(p, draw) if last else p)

    return run


def mix_sources(docs: DataFrame, size: Column | None = None, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: float = 3.0, block_rows: int = 2048) -> DataFrame:
    """docs with place, size, source_size, target, copies and taken (= copies * size).

    The size is the number of words of `text` unless given; docs are read three times.
    """
    sized = docs.withColumn("size", n_words(F.col("text")) if size is None else size).drop(*RESULT)
    docs = docs.drop("size", *RESULT)
    goals = cut(targets(sized, weights, share, most), "mix-goals")
    # Each document meets its source's goal in one of many copies of it, so that a hot source is no hot key.
    salts = 64
    salted = goals.select(F.col("source").alias("_mix_source"), "place", "n_docs", "source_size", "target", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_mix_salt"))
    row = F.xxhash64("doc_id", "size", "source")
    slim = sized.withColumns({"_mix_row": row, "_mix_key": F.pmod(row, F.lit(salts)).cast("int")})
    on = slim["source"].eqNullSafe(salted["_mix_source"]) & (slim["_mix_key"] == salted["_mix_salt"])
    goal = slim.join(salted, on).drop("_mix_source", "_mix_salt", "_mix_key")
    ratio = F.least(F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0), F.lit(float(most)))
    goal = goal.withColumns({"_mix_base": F.floor(ratio + 1e-12), "_mix_p": ratio - F.floor(ratio + 1e-12)})
    goal = goal.withColumn("_mix_p", F.when(F.col("_mix_p") > 1e-9, F.col("_mix_p")).otherwise(0.0))

    open_ = goal.filter(F.col("_mix_p") > 0).select("place", "n_docs", "_mix_row", F.col("size").alias("_mix_size"), "_mix_p")
    largest, decided, number = goals.agg(F.max("n_docs")).first()[0] or 0, [], 0
    blocks = F.ceil(F.col("n_docs") / block_rows)
    while True:
        last = largest <= block_rows
        keyed = open_.withColumn("_mix_block", F.pmod(F.xxhash64("_mix_row", F.lit(number)), F.greatest(blocks, F.lit(1))).cast("long"))
        moved = cut(keyed.groupBy("place", "_mix_block").applyInPandas(_round(number, last), keyed.schema), "mix-round")
        settled = F.col("_mix_p").isin(0.0, 1.0)
        decided.append(moved.filter(settled))
        if last:
            break
        # Each block leaves two documents at most.
        n_blocks, largest, number = blocks, 2 * -(-largest // block_rows), number + 1
        open_ = moved.filter(~settled).withColumn("n_docs", 2 * F.greatest(n_blocks, F.lit(1))).drop("_mix_block")
    extra = decided[0]
    for more in decided[1:]:
        extra = extra.unionByName(more)
    # Documents that share all of doc_id, size and source share the extra copies by number.
    extra = extra.groupBy("place", "_mix_row").agg(F.sum("_mix_p").alias("_mix_extra"))
    out = goal.join(extra, ["place", "_mix_row"], "left")
    same = Window.partitionBy("place", "_mix_row").orderBy("doc_id")
    gets = F.row_number().over(same) <= F.coalesce("_mix_extra", F.lit(0.0))
    out = out.withColumn("copies", (F.col("_mix_base") + gets.cast("long")).cast("long"))
    return out.select(*docs.columns, "place", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
