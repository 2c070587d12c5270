"""Near-duplicate embeddings by randomised-rotation binary codes.

Every vector is scaled to length one, turned by a fixed random rotation and stored as the signs of its
components (its code) with a correction factor: the inner product of the turned vector with its
own code. The inner product of the code with another turned vector, divided by the factor, is an
unbiased estimate of the cosine. Given a true cosine of `threshold` or more, its error is that of a
coordinate of a random direction in dim - 1 dimensions times sqrt(1 - threshold**2) * sqrt(1 - f**2) / f;
a pair whose estimate plus `sigmas` such deviations stays below the threshold is dropped, all others
are computed exactly in double precision. A coordinate of a direction never exceeds 1, so six
deviations are certain up to 37 dimensions and miss less than 2e-9 of the links beyond.

Vectors of a label meet where `bits` code bits of a band agree; further rotations give enough bits for
all bands. Their number makes a pair at the threshold meet in no band with a probability of
`miss` at most. In a meeting, linked vectors are joined to components; no pair is written. All pairs
of a component are then compared once more in the same way and links are counted. Meetings and
components above `block_rows` vectors are pairs of blocks, each a group of its own.

Equal vectors of a label are one class and compared once. Vectors link only with vectors of the same
non-null label and the same number of components. Null, empty and zero vectors and those with null
or non-finite components link with nothing. Rows that share a vec_id are one vector: one without
nulls goes first, then the smallest label and embedding. Rows with a null vec_id cannot be named and
are left out. Other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import acos, ceil, log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.blocks import block_pairs, looked_up, short_pairs, tiles, whole_groups
from .groups import components, labels_of
from .shared import cut

_SEED = 1202
_SHORT, _TILE = 32, 1024
_KEYS = ["key", "bi", "bj"]


@lru_cache(8)
def rotation(dim: int, number: int) -> np.ndarray:
    """A random rotation of dim dimensions, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([_SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def bands_for(n: int, threshold: float, miss: float, meeting: int = 256) -> tuple[int, int]:
    """(bits, bands): about `meeting` of n vectors agree in the bits; a pair at the threshold misses all bands with probability `miss`."""
    bits = max(3, ceil(log(max(n, 1) / meeting, 2))) if n > meeting else 3
    same = (1 - acos(threshold) / pi) ** bits
    return bits, ceil(log(miss) / log(1 - same))


def usable(vector: Column) -> Column:
    """The vector as doubles; null unless all components are finite and one is not zero."""
    v = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.when(fine, v)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    v = vectors / np.abs(vectors).max(1, keepdims=True)
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def encoded(unit: np.ndarray, bits: int, bands: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (packed signs of the first rotation), correction factors and band keys of unit vectors."""
    dim = unit.shape[1]
    turned = unit @ rotation(dim, 0).T
    factor = np.abs(turned).sum(1) / np.sqrt(dim)
    signs = [turned >= 0]
    signs += [unit @ rotation(dim, r).T >= 0 for r in range(1, ceil(bits * bands / dim))]
    order = np.random.default_rng([_SEED, dim]).permutation(len(signs) * dim)[: bits * bands]
    drawn = np.concatenate(signs, 1)[:, order].reshape(len(unit), bands, bits)
    keys = (drawn * (1 << np.arange(bits, dtype=np.int64))).sum(2)
    return np.packbits(signs[0], axis=1), factor, keys


def classes_of(vectors: DataFrame) -> DataFrame:
    """(label, v, id, copies) of equal usable vectors (vec_id, label, v) of a label."""
    return vectors.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))


def with_codes(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    """id, label, dim, copies, unit (doubles as bytes), code, factor, bands of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            dims = np.asarray(lists.value_lengths())
            for dim in np.unique(dims):
                rows = pa.array(np.flatnonzero(dims == dim))
                part = batch.take(rows)
                unit = scaled(np.asarray(part.column("v").flatten(), float).reshape(-1, dim))
                code, factor, keys = encoded(unit, bits, bands)
                offsets = pa.array(np.arange(len(unit) + 1, dtype=np.int32) * bands)
                columns = [part.column("id"), part.column("label"), pa.array(np.full(len(unit), dim, np.int32)), part.column("copies"), pa.array([u.tobytes() for u in unit], pa.binary())]
                columns += [pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "dim", "copies", "unit", "code", "factor", "bands"])

    label = classes.schema["label"].dataType.simpleString()
    return classes.mapInArrow(run, f"id long, label {label}, dim int, copies long, unit binary, code binary, factor double, bands array<long>")


class Coded:
    """Vectors of one dimension with their codes, for comparisons of pairs."""

    def __init__(self, table: pa.Table, threshold: float, sigmas: float):
        self.dim = dim = int(table.column("dim")[0].as_py())
        self.unit = np.frombuffer(b"".join(table.column("unit").to_pylist()), float).reshape(-1, dim)
        packed = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(self.unit), -1)
        self.code = (np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
        self.turned = (self.unit @ rotation(dim, 0).T).astype(np.float32)
        self.factor = np.asarray(table.column("factor"), float)
        rest = np.sqrt(np.maximum(0, 1 - self.factor**2)) / self.factor
        self.margin = sigmas * np.sqrt(1 - threshold**2) * rest / np.sqrt(max(dim - 1, 1)) + 1e-5
        self.threshold = threshold

    def near_rows(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs (i, j) those at the threshold."""
        for _ in range(2):  # the code of i with j, then the code of j with i
            estimate = np.einsum("ij,ij->i", self.code[i], self.turned[j]) / self.factor[i]
            ok = estimate + self.margin[i] >= self.threshold
            i, j = j[ok], i[ok]
        return self.exact(i, j)

    def exact(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = np.empty(len(i), bool)
        for k in range(0, len(i), 1 << 16):
            part = slice(k, k + (1 << 16))
            ok[part] = np.einsum("ij,ij->i", self.unit[i[part]], self.unit[j[part]]) >= self.threshold
        return i[ok], j[ok]

    def near_tile(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows a with rows b at the threshold; above the diagonal where a is b."""
        lead = (self.threshold - self.margin) * self.factor  # estimate + margin >= threshold, both sides times the factor
        ok = self.code[a] @ self.turned[b].T >= lead[a][:, None]
        ok &= self.turned[a] @ self.code[b].T >= lead[b][None, :]
        if a[0] == b[0]:
            ok = np.triu(ok, 1)
        i, j = np.nonzero(ok)
        return self.exact(a[i], b[j])


def linked(rows: DataFrame, threshold: float, sigmas: float, block_rows: int) -> DataFrame:
    """(id, other, links) per pair of blocks: links of a class there, and the smallest class it hangs together with.

    rows: key (string), id, dim, copies, unit, code, factor; the rows of a key share their dim.
    """
    slim = rows.select("key", "id", "dim", "copies", "unit", "code", "factor")
    dealt = block_pairs(slim, ["key"], "id", block_rows).repartition(*_KEYS).sortWithinPartitions(*_KEYS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, numbers in whole_groups(batches, _KEYS):
            dims = np.asarray(whole.column("dim"))
            starts = np.flatnonzero(np.append(True, dims[1:] != dims[:-1]))
            for start, end in zip(starts, np.append(starts[1:], len(dims))):
                table, group = whole.slice(start, end - start), numbers[start:end]
                ids, copies, own, bi, bj = (np.asarray(table.column(c)) for c in ("id", "copies", "own", "bi", "bj"))
                coded, single = Coded(table, threshold, sigmas), bi == bj
                links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
                found = [coded.near_rows(i, j) for i, j in short_pairs(group, own, single, _SHORT)]
                for i, j in _all(found, (coded.near_tile(a, b) for a, b in tiles(group, own, single, _SHORT, _TILE))):
                    np.add.at(links, i, copies[j])
                    np.add.at(links, j, copies[i])
                    label = labels_of(len(ids), label[i], label[j])[label]
                hit = links > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(ids[label[hit]]), pa.array(links[hit])], ["id", "other", "links"])

    return dealt.mapInArrow(run, "id long, other long, links long")


def _all(first: list[tuple[np.ndarray, np.ndarray]], rest: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if first:
        yield np.concatenate([i for i, _ in first]), np.concatenate([j for _, j in first])
    yield from (pair for pair in rest if len(pair[0]))


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, sigmas: float = 6.0, miss: float = 1e-7, block_rows: int = 2048) -> DataFrame:
    """vec_id, n_links, component_id and kept of vectors (vec_id, label, embedding)."""
    named = vectors.filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), "label", "embedding")
    if not named.groupBy("vec_id").count().filter(F.col("count") > 1).isEmpty():
        first = F.min(F.struct(F.col("embedding").isNull().alias("n"), F.col("label").isNull().alias("m"), "label", "embedding"))
        named = named.groupBy("vec_id").agg(first.alias("s")).select("vec_id", "s.label", "s.embedding")
    full = named.select("vec_id", "label", usable(F.col("embedding")).alias("v"))
    full = cut(full, "vectors")
    classes = cut(classes_of(full.filter(F.col("label").isNotNull() & F.col("v").isNotNull())), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    coded = cut(with_codes(classes, *bands_for(most, threshold, miss)), "codes")
    met = coded.select("*", F.posexplode("bands").alias("band", "bits"))
    met = met.withColumn("key", F.concat_ws(":", F.col("label").cast("string"), "dim", "band", "bits"))
    edges = linked(met, threshold, sigmas, block_rows).filter(F.col("id") != F.col("other"))
    groups = components(edges.select(F.col("id").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("id"), F.col("label").alias("low"))
    groups = cut(groups, "groups")
    inside = coded.join(groups, "id").withColumn("key", F.col("low").cast("string"))
    return _named(full, classes, groups, linked(inside, threshold, sigmas, block_rows))


def _named(full: DataFrame, classes: DataFrame, groups: DataFrame, links: DataFrame) -> DataFrame:
    """The result per vector from classes, their components and their links."""
    links = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.join(links, "id", "left").join(groups, "id", "left")
    known = known.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("low", "id").alias("low"))
    found = looked_up(full, ["label", "v"], known, "vec_id")
    low = F.coalesce("low", "vec_id")
    return found.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), low.alias("component_id"), (F.col("vec_id") == low).alias("kept"))
