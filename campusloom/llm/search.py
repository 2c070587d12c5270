"""Exact top-k search by inner product, term at a time over blocks of postings.

A vector's components are its terms. Candidates are dealt into blocks by a hash of vec_id;
within a block each dimension has a posting list (row, weight) of the non-zero weights. A query
adds weight * postings of each of its non-zero dimensions into a dense score array, from which
a partition selects the block's best k; these meet in a final selection. Queries are dealt into
blocks too and every pair of blocks is one group of bounded size, so neither side is broadcast.

Vectors that are null or hold null or non-finite components take no part. Ties go to the
smaller vec_id. A query never meets rows with its own vec_id. Repeated candidate rows are rows
of their own; repeated query rows count once. Rows with a null vec_id are no queries and no
candidates. Vectors shorter than others count as filled with zeros. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null where a component is null or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores [query, candidate]: every query's terms scatter their weighted postings."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(candidates.shape[1]):
        rows = np.flatnonzero(candidates[:, term])
        weights = candidates[rows, term]
        full = len(rows) == len(candidates)
        for q in np.flatnonzero(queries[:, term]):
            if full:
                scores[q] += queries[q, term] * weights
            else:
                scores[q, rows] += queries[q, term] * weights
    return scores


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest allowed scores; among equals those that come first."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        s = scores[at]
        limit = np.partition(s, len(s) - k)[len(s) - k]
        above = at[s > limit]
        at = np.concatenate([above, at[s == limit][: k - len(above)]])
    return at


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, candidate_rows: int = 4096, query_rows: int = 2048) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of vectors (vec_id, embedding)."""
    usable = vectors.select(F.col("vec_id").cast("long"), integers(F.col("embedding"), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    usable = usable.filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    n, n_queries = usable.agg(F.count(F.lit(1)), F.count_if("q")).first()
    n_blocks, n_query_blocks = max(1, -(-n // candidate_rows)), max(1, -(-n_queries // query_rows))
    candidates = usable.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).alias("cb"), F.explode(F.sequence(F.lit(0), F.lit(n_query_blocks - 1))).alias("qb"))
    asked = usable.filter("q").select("vec_id", "v").distinct()
    queries = asked.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_query_blocks)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("cb"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("vec_id", kind="stable")
        rows: list[tuple] = []
        if len(left) and len(right):
            width = max(left["v"].map(len).max(), right["v"].map(len).max())
            candidates, ids = _matrix(left["v"], width), left["vec_id"].to_numpy()
            for a in range(0, len(right), 256):
                asked = right.iloc[a : a + 256]
                scores = accumulate(_matrix(asked["v"], width), candidates)
                for q, own in zip(asked["vec_id"], scores, strict=True):
                    at = best(own, ids != q, k)
                    rows.extend(zip([q] * len(at), ids[at], own[at], strict=True))
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = candidates.groupBy("cb", "qb").cogroup(queries.groupBy("cb", "qb")).applyInPandas(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
