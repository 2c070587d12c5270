"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with the same words are one class and are compared once. Classes meet where the MinHash
values of a band agree. Inside such a meeting their MinHash values are compared step by step, and a
pair is dropped as soon as the posterior probability (uniform prior) that its similarity reaches the
threshold is below `tolerance`. Surviving pairs are not written: a task only keeps which
classes hang together, so that n near copies give n rows and not n * n. In the clusters found so,
every pair is compared again in the same way and the rest is verified exactly on the sets of
shingles; links are counted per class, weighted with the number of documents of the other class.

Meetings and clusters above `block_rows` are cut into blocks, and each pair of blocks is a group of
its own: no group grows beyond two blocks and no pair is left out. With 20 bands of 3 values, a
pair at similarity 0.8 fails to meet with probability 6e-7, at 0.85 with 1e-8.

Shingles are five words (runs of characters other than white space); texts of one to four words
have one shingle of all their words. Null texts and texts without words have no shingles: each
is its own class without links. Rows that share a doc_id are one document; of differing texts the
smallest stands for it. Rows with a null doc_id cannot be named and are left out. Extra columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .groups import components, labels_of
from .shared import cut
from .words import Words, chunks, mix, powers, shingles

BANDS, ROWS = 20, 3
_VALUES = BANDS * ROWS
_rng = np.random.default_rng(818)
_FACTORS = _rng.integers(1, 1 << 63, _VALUES, dtype=np.uint64) | np.uint64(1)
_ADDENDS = _rng.integers(1, 1 << 63, _VALUES, dtype=np.uint64)
_CHUNK = 1 << 20
_TEXTS = 2000
_SMALL = 64


@lru_cache
def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """The fewest agreeing values of n with which P(similarity >= threshold) is not below tolerance.

    After m of n, the posterior of a uniform prior is Beta(m + 1, n - m + 1), and its tail above t is
    the probability of at most m successes of n + 1 at rate t.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n + 1


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, words (two hashes of all words and their number), signature (bytes), bands, of texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(first, _TEXTS)
                texts = [t.encode("utf-8", "replace") for t in part.column("text").to_pylist()]
                for a, b in chunks([len(t) for t in texts], _CHUNK):
                    yield _signed(part.column("doc_id").slice(a, b - a), texts[a:b], k)

    full = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return full.mapInArrow(run, "doc_id long, words binary, signature binary, bands array<long>")


def _signed(ids: pa.Array, texts: list[bytes], k: int) -> pa.RecordBatch:
    words = Words(texts)
    n, starts = words.counts, words.bounds[:-1]
    full = np.flatnonzero(n)
    place = np.arange(len(words.hashes)) - np.repeat(starts, n)
    most = int(n.max(initial=1))
    sums = [np.add.reduceat(words.hashes * powers(base, most)[place], starts[full]) if len(full) else np.zeros(0, np.uint64) for base in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)]
    whole = np.column_stack([*sums, n[full].astype(np.uint64)]).astype("<u8")
    windows, bounds = shingles(words.hashes, words.bounds, k)
    values = np.empty((len(full), _VALUES), np.uint32)
    for j in range(_VALUES if len(full) else 0):
        values[:, j] = np.minimum.reduceat((windows * _FACTORS[j] + _ADDENDS[j]) >> np.uint64(32), bounds[:-1][full])
    bands = np.zeros((len(full), BANDS), np.uint64)
    for r in range(ROWS):
        bands = mix(bands * np.uint64(31) + values[:, r::ROWS][:, :BANDS] + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    lists = pa.ListArray.from_arrays(np.arange(len(full) + 1, dtype=np.int32) * BANDS, pa.array(bands.view(np.int64).ravel()))
    binary = lambda rows: pa.array([r.tobytes() for r in rows], pa.binary())
    return pa.RecordBatch.from_arrays([ids.take(pa.array(full)), binary(whole), binary(values), lists], ["doc_id", "words", "signature", "bands"])


def in_blocks(rows: DataFrame, key: str, id_: str, block_rows: int) -> DataFrame:
    """rows with bi, bj, own: each group of `key` as pairs of blocks (bi <= bj), `own` the row's block.

    Groups of one row are left out. Sizes come from an aggregation and meet the rows in a join.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    sized = rows.join(sizes, key).withColumn("_blocks", F.ceil(F.col("_n") / block_rows).cast("int"))
    own = sized.withColumn("own", F.pmod(F.xxhash64(id_, F.lit(3)), F.col("_blocks")).cast("int"))
    pairs = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return pairs.withColumns({"bi": F.least("own", "_other"), "bj": F.greatest("own", "_other")}).drop("_n", "_blocks", "_other")


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of sorted rows (key, bi, bj), some at a time, with a number for each row's group."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        group = _numbers(table)
        last = int(np.searchsorted(group, group[-1])) if len(group) else 0
        if last:
            yield table.slice(0, last), group[:last]
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest, _numbers(rest)


def _numbers(table: pa.Table) -> np.ndarray:
    keys = np.column_stack([np.asarray(table.column(c), np.int64) for c in ("key", "bi", "bj")])
    return np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(1))]) if len(keys) else np.zeros(0, int)


def survivors(group: np.ndarray, own: np.ndarray, single: np.ndarray, values: np.ndarray, threshold: float, tolerance: float, same: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of one group that the posterior does not rule out, some at a time.

    Where the group is two different blocks (not single), only pairs between them count. Pairs
    with an equal `same` are one and the same class and are skipped.
    """
    steps = [(0, 10), (10, 20), (20, 40), (40, _VALUES)]
    left = np.arange(len(group))
    for distance in range(1, len(group)):
        left = left[left + distance < len(group)]
        left = left[group[left] == group[left + distance]]
        if not len(left):
            return
        i, j = left, left + distance
        ok = single[i] | (own[i] != own[j])
        if same is not None:
            ok &= same[i] != same[j]
        i, j = i[ok], j[ok]
        agree = np.zeros(len(i), np.int64)
        for a, b in steps:
            agree += (values[i, a:b] == values[j, a:b]).sum(1)
            ok = agree >= least_matches(b, threshold, tolerance)
            i, j, agree = i[ok], j[ok], agree[ok]
        if len(i):
            yield i, j


def _values(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, _VALUES)


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "id")


def clusters(classes: DataFrame, threshold: float, tolerance: float, block_rows: int) -> DataFrame:
    """(node, label) of classes (id, signature, bands) that hang together by pairs not ruled out."""
    bands = classes.select("id", F.explode("bands").alias("key"))
    met = in_blocks(bands, "key", "id", block_rows).join(classes.select("id", "signature"), "id").select("key", "bi", "bj", "own", "id", "signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _by_group(batches):
            ids, back = np.unique(np.asarray(table.column("id")), return_inverse=True)
            own, bi, bj = (np.asarray(table.column(c)) for c in ("own", "bi", "bj"))
            label = np.arange(len(ids))
            for i, j in survivors(group, own, bi == bj, _values(table.column("signature")), threshold, tolerance, back):
                low = labels_of(len(ids), label[back[i]], label[back[j]])
                label = low[label]
            moved = np.flatnonzero(label != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[label[moved]]), pa.array(ids[moved])], ["a", "b"])

    return components(_grouped(met).mapInArrow(run, "a long, b long"))


def shingle_sets(docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """members (node, ...) with `shingles`, the sorted distinct hashes of the text of doc_id = node, as bytes."""
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("node"), "text")
    joined = texts.join(members, "node")
    schema = joined.drop("text").withColumn("shingles", F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(first, _TEXTS)
                texts = [t.encode("utf-8", "replace") for t in part.column("text").to_pylist()]
                sets: list[bytes] = []
                for a, b in chunks([len(t) for t in texts], _CHUNK):
                    words = Words(texts[a:b])
                    windows, bounds = shingles(words.hashes, words.bounds, k)
                    sets += [np.unique(windows[x:y]).tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sets, pa.binary())], [*kept.schema.names, "shingles"])

    return joined.mapInArrow(run, schema)


def _intersections(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets i and j (arrays of distinct values), pair by pair."""
    return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())], np.int64)


def shared_counts(sets: list[np.ndarray], rows: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all pairs of `rows`: matrix products over the values that two of them share."""
    values, inverse, count = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])[count[inverse] > 1]
    column = (np.cumsum(count > 1) - 1)[inverse[count[inverse] > 1]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(rows), len(rows)), np.float32)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        hit = np.zeros((len(rows), width), np.float32)
        hit[row[a:b], column[a:b] - first] = 1
        out += hit @ hit.T
    return out.astype(np.int64)


def _parts(group: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers: each group above _SMALL rows by itself, all others together."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(group)))
    for start, size in zip(starts[sizes > _SMALL], sizes[sizes > _SMALL]):
        yield np.arange(start, start + size)
    rest = np.flatnonzero(np.repeat(sizes <= _SMALL, sizes))
    if len(rest):
        yield rest


def verified(rows: DataFrame, threshold: float, tolerance: float, block_rows: int) -> DataFrame:
    """(id, other, links): links of a class within a pair of blocks, and the smallest class it hangs together with there.

    rows: key, id, copies, signature, shingles.
    """
    blocks = in_blocks(rows, "key", "id", block_rows).select("key", "bi", "bj", "own", "id", "copies", "signature", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _by_group(batches):
            ids, copies, own, bi, bj = (np.asarray(table.column(c)) for c in ("id", "copies", "own", "bi", "bj"))
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            size, values = np.array([len(s) for s in sets]), _values(table.column("signature"))
            links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
            for rows in _parts(group):
                counts = shared_counts(sets, rows) if group[rows[0]] == group[rows[-1]] and len(rows) > _SMALL else None
                for i, j in survivors(group[rows], own[rows], (bi == bj)[rows], values[rows], threshold, tolerance):
                    shared = _intersections(sets, rows[i], rows[j]) if counts is None else counts[i, j]
                    i, j = rows[i], rows[j]
                    near = shared >= threshold * (size[i] + size[j] - shared) - 1e-9
                    i, j = i[near], j[near]
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    label = labels_of(len(ids), label[i], label[j])[label]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[label]), pa.array(links)], ["id", "other", "links"])

    return _grouped(blocks).mapInArrow(run, "id long, other long, links long")


def join(docs: DataFrame, threshold: float = 0.8, k: int = 5, tolerance: float = 1e-6, block_rows: int = 512) -> DataFrame:
    """One row per document: doc_id, text_id (smallest id with the same words), class_id (smallest id of the linked group), n_links.

    n_links: other documents at or above the threshold, those with the same words included.
    """
    docs = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    if not docs.groupBy("doc_id").count().filter(F.col("count") > 1).isEmpty():
        docs = docs.groupBy("doc_id").agg(F.min("text").alias("text"))
    signed = cut(signatures(docs, k), "signed")
    first = F.min_by(F.struct("signature", "bands"), "doc_id").alias("s")
    classes = signed.groupBy("words").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"), first)
    classes = cut(classes.select("words", "id", "copies", "s.signature", "s.bands"), "classes")
    members = clusters(classes.select("id", "signature", "bands"), threshold, tolerance, block_rows)
    slim = classes.select("id", "copies", "signature").join(members, F.col("id") == F.col("node")).drop("id")
    rows = shingle_sets(docs, slim, k)
    rows = rows.select(F.col("label").alias("key"), F.col("node").alias("id"), "copies", "signature", "shingles")
    found = cut(verified(cut(rows, "sets"), threshold, tolerance, block_rows), "links")
    groups = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.select("words", "id", "copies").join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    named = named.select("words", F.col("id").alias("text_id"), F.coalesce("label", "id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = signed.select("doc_id", "words").join(named, "words").drop("words")
    alone = docs.select("doc_id").join(signed.select("doc_id"), "doc_id", "left_anti")
    return found.unionByName(alone.select("doc_id", F.col("doc_id").alias("text_id"), F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")))
