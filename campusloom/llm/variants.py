"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling of code-point matrices.

Two different words are one inserted, deleted or replaced code point apart exactly when their
common prefix and common suffix together reach the longer length minus one. One of both then
holds at least half of it, so that words need to be compared only with those that share the first
or the last m // 2 code points, m the longer length. A word of length l is dealt to sections for
m = l and m = l + 1, by its beginning and by its end. A section's words are padded code-point
matrices, aligned left and right; tile by tile, whole blocks are compared column by column. A
pair that the prefix section finds is not counted again in the suffix section. No pair is written:
a task returns per word how many are near and the best of them. Sections above `block_rows` words are
pairs of blocks, each a group of its own, so a frequent beginning is spread over many tasks.

Runs of letters are counted over whole texts. In an occurrence's run, one code point is left out where
crc32 of `<doc_id>:<run>` is divisible by `every`. Null and empty texts hold no words; a null doc_id
counts as the empty text; repeated rows count again. Ties for a form go to the smaller word in
code-point order. Other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import block_pairs, short_pairs, tiles, whole_groups
from .shared import cut

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_KEPT = 1 << 18
_KEYS = ["m", "side", "part", "bi", "bj"]
_SHORT, _TILE = 48, 512


def _in_text(doc_id: int | None, text: str, every: int) -> Counter:
    """Words of one text with their counts, after the planted deletions."""
    seed = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    raw, out = Counter(_RUN.findall(text)), Counter()
    for word, n in raw.items():
        word = word.lower() if word.isascii() else word.translate(_LOWER)
        h = zlib.crc32(word.encode(), seed)
        if h % every == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1 :]
        out[word] += n
    return out


def word_counts(docs: DataFrame, least: int = 6, every: int = 199) -> DataFrame:
    """(word, n) of all words of at least `least` code points. Tasks add up before the shuffle, in bounded tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                for word, n in _in_text(doc_id.as_py(), text.as_py(), every).items():
                    if len(word) >= least:
                        total[word] += n
                if len(total) >= _KEPT:
                    yield out()
        yield out()

    full = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return full.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _matrices(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, padded to width: aligned left, and aligned right and read backwards."""
    left = np.zeros((len(words), width), np.uint8)
    right = np.zeros((len(words), width), np.uint8)
    size = np.array([len(w) for w in words])
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        block = np.frombuffer(b"".join(words[r] for r in rows), np.uint8).reshape(-1, n)
        left[rows, :n], right[rows, :n] = block, block[:, ::-1]
    return left, right


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of every row of a with every row of b."""
    alive = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.int32)
    for k in range(a.shape[1]):
        alive &= a[:, k, None] == b[None, :, k]
        if not alive.any():
            break
        total += alive
    return total


def _common_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of row i of a with row i of b; the rows differ somewhere."""
    return (a != b).argmax(1)


def near_pairs(words: list[bytes], m: int, group: np.ndarray, own: np.ndarray, single: np.ndarray, suffix: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of words one edit apart whose longer length is m; in suffix sections only those that no prefix section holds."""
    left, right = _matrices(words, m)
    full = np.array([len(w) == m for w in words])
    for i, j in short_pairs(group, own, single, _SHORT):
        i, j = (x[full[i] | full[j]] for x in (i, j))
        front = _common_rows(left[i], left[j])
        ok = (front + _common_rows(right[i], right[j]) >= m - 1) & ((front >= m // 2) != suffix[i])
        yield i[ok], j[ok]
    for a, b in tiles(group, own, single, _SHORT, _TILE):
        front, back = _common(left[a], left[b]), _common(right[a], right[b])
        ok = (front + back >= m - 1) & ((front >= m // 2) != suffix[a[0]]) & (full[a][:, None] | full[b][None, :])
        if a[0] == b[0]:
            ok = np.triu(ok, 1)
        i, j = np.nonzero(ok)
        yield a[i], b[j]


def near_words(words: DataFrame, block_rows: int = 2048) -> DataFrame:
    """(word, n_near, best_n, best): per word with near words their number, and of those with largest n the smallest."""
    size = F.length("word")
    both = words.withColumn("m", F.explode(F.array(size, size + 1)))
    dealt = both.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    part = F.when(F.col("side") == 0, F.expr("left(word, cast(floor(m / 2) as int))")).otherwise(F.expr("right(word, cast(floor(m / 2) as int))"))
    sections = block_pairs(dealt.withColumn("part", part), ["m", "side", "part"], "word", block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, _KEYS):
            order = np.asarray(pc.sort_indices(table, [("n", "descending"), ("word", "ascending")]))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
            length, own, bi, bj, side = (np.asarray(table.column(c)) for c in ("m", "own", "bi", "bj", "side"))
            count, best = np.zeros(len(rank), np.int64), np.full(len(rank), len(rank))
            starts = np.flatnonzero(np.append(True, length[1:] != length[:-1]))
            for a, b in zip(starts, np.append(starts[1:], len(length))):
                for i, j in near_pairs(words[a:b], int(length[a]), group[a:b], own[a:b], (bi == bj)[a:b], side[a:b] == 1):
                    i, j = i + a, j + a
                    np.add.at(count, i, 1)
                    np.add.at(count, j, 1)
                    np.minimum.at(best, i, rank[j])
                    np.minimum.at(best, j, rank[i])
            found = np.flatnonzero(count)
            top = pa.array(order[best[found]])
            named = [table.column("word").combine_chunks().take(pa.array(found)), pa.array(count[found]), table.column("n").combine_chunks().take(top), table.column("word").combine_chunks().take(top)]
            yield pa.RecordBatch.from_arrays(named, ["word", "near", "best_n", "best"])

    sorted_ = sections.repartition(*_KEYS).sortWithinPartitions(*_KEYS).select("word", "n", "own", *_KEYS)
    found = sorted_.mapInArrow(run, "word string, near long, best_n long, best string")
    top = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    merged = found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top"))
    return merged.select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def group_variants(words: DataFrame, factor: int = 5, block_rows: int = 2048) -> DataFrame:
    """word, form, root, n, n_near, form_n of words (word, n).

    n grows at least by `factor` from a word to its form, so that chains are short: following roots of
    roots doubles the steps each round, and the largest n bounds the rounds.
    """
    near = words.join(near_words(words, block_rows), "word", "left")
    strong = F.col("best_n") >= F.col("n") * factor
    formed = cut(near.select("word", F.when(strong, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best_n")).alias("form_n")), "forms")
    roots = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    most = formed.agg(F.max("form_n")).first()[0] or 1
    steps = int(log(most, factor)) + 1
    for _ in range(ceil(log(steps, 2)) if steps > 1 else 0):
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("_up"))
        roots = cut(roots.join(up, "root", "left").select("word", F.coalesce("_up", "root").alias("root")), "roots")
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, least: int = 6, most_rare: int = 5, factor: int = 5, every: int = 199) -> DataFrame:
    """Words of docs (doc_id, text) with their forms; see group_variants."""
    words = word_counts(docs, least, every).filter(F.col("n") >= most_rare)
    return group_variants(cut(words, "words"), factor)
