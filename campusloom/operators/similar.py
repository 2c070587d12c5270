"""Near-duplicate sections across documents: set-similarity join with prefix filter.

The overlap of two sections is the number of shared words over the larger set of distinct words.
Words are ordered by rising frequency, and ``n - floor(t * n)`` first words of a set of n are
its prefix: two sets above the overlap t share a word of both prefixes.  So sets meet
by their prefix words only, which are rare where the text has rare words at all.  Any order that all
tasks share gives the same result, so frequencies are taken from a table of SLOTS counts of hashed words:
they are at least the true ones, and no word has to be joined with its count.  The same counts over prefix words
tell which words are in one prefix only and how many blocks a meeting needs.

Within a meeting rows lie by size, so that only sizes that fit are paired; the place of the word and a bit
signature bound what two sets can share; what is left is verified
exactly and counted at the first word that both share, so that every pair counts once.  No pair is
written: a meeting returns the number of partners and the first of them per set.

A word in many prefixes does not decide the cost: its meeting is cut into pairs of blocks.  Equal sets
are one class and compared once.  Words are compared by 64-bit hashes, whole sets by two hashes of these.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from campusloom.operators.blocks import looked_up, whole_groups
from campusloom.session import durable

_KEYS = ["word", "bi", "bj"]
MOST_BITS = 4096
#: Counts of hashed words, a power of two, and the parts in which tasks hand them on.
SLOTS, _PARTS = 1 << 22, 256
#: Pairs of rows, and words of pairs, that are looked at in one go.
_PAIRS, _LOOKED = 1 << 18, 1 << 20


def sections_of(docs: DataFrame, key: str, text: str, mark: str = "\n", minimum: int = 40) -> DataFrame:
    """(key, section, words) of the trimmed parts of a text with at least ``minimum`` characters; NULL has none.

    Words stand as often as they are written.
    """
    parts = F.transform(F.split(text, mark), lambda s: F.btrim(s, F.lit(" \t\n\x0b\f\r")))
    each = docs.select(F.col(key), F.posexplode(parts).alias("section", "__t")).filter(F.length("__t") >= minimum)
    return each.select(key, "section", F.split(F.lower("__t"), r"\s+").alias("words"))


def _slots(words: np.ndarray) -> np.ndarray:
    return (words.view(np.uint64) >> np.uint64(64 - (SLOTS.bit_length() - 1))).astype(np.int64)


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all lists and the length of each."""
    return np.asarray(lists.flatten(), np.int64), np.asarray(lists.value_lengths(), np.int64)


def _places(size: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _need(size: np.ndarray, overlap: float) -> np.ndarray:
    """The least number of words that a set of a size shares with a similar one that is not larger."""
    return np.floor(size * overlap + 1e-9).astype(np.int64) + 1


def _prefix(size: np.ndarray, overlap: float) -> np.ndarray:
    return size - _need(size, overlap) + 1


def _counts(rows: DataFrame, column: str, overlap: float | None = None) -> np.ndarray:
    """By slot the number of words in all lists of a column, or in their prefixes; never less than the number of one word."""
    width = SLOTS // _PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            words, size = _flat(batch.column(column))
            if overlap is not None:
                words = words[_places(size) < np.repeat(_prefix(size, overlap), size)]
            np.add.at(total, _slots(words), 1)
        parts = [total[k * width : (k + 1) * width] for k in range(_PARTS)]
        used = [k for k, p in enumerate(parts) if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_py(), np.int64) for c in table.column("counts"))
        small = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
        return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([small.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    out = np.zeros(SLOTS, np.uint32)
    for r in rows.select(column).mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect():
        out[r.part * width : (r.part + 1) * width] = np.frombuffer(r.counts, np.uint32)
    return out


def _ordered_words(classes: DataFrame) -> DataFrame:
    """classes (id, copies, words in order) as (id, copies, ranked, size): the words by rising frequency."""
    counts = _counts(classes, "words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, size = _flat(batch.column("words"))
            # Equally frequent words keep the order that they have in every set.
            order = np.argsort(np.repeat(np.arange(len(size)) << 32, size) | counts[_slots(words)], kind="stable")
            bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            ranked = pa.ListArray.from_arrays(pa.array(bounds), pa.array(words[order]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("copies"), ranked, pa.array(size, pa.int32())], ["id", "copies", "ranked", "size"])

    return classes.select("id", "copies", "words").mapInArrow(run, "id long, copies long, ranked array<long>, size int")


def _bits(size: np.ndarray) -> np.ndarray:
    """Bits in the signature of a set: a power of two, four a word or more, from 64 to 4,096."""
    return np.clip(2 ** np.ceil(np.log2(np.maximum(4 * size, 1))), 64, MOST_BITS).astype(np.int64)


def _signatures(words: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """Signatures of sets as rows of 64-bit numbers."""
    out = np.zeros((len(bounds) - 1, bits // 64), np.uint64)
    place = (words.view(np.uint64) >> np.uint64(7)) % np.uint64(bits)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    np.bitwise_or.at(out, (row, (place // np.uint64(64)).astype(int)), np.uint64(1) << (place % np.uint64(64)))
    return out


def _signed(ranked: DataFrame) -> DataFrame:
    """ranked (id, copies, ranked, size) with ``signature``: a bit for each word, as many as :func:`_bits` says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, size = _flat(batch.column("ranked"))
            ends, bits, signature = np.cumsum(size), _bits(size), np.empty(len(size), object)
            for n in np.unique(bits):
                at = np.flatnonzero(bits == n)
                own = np.repeat(ends[at] - np.cumsum(size[at]), size[at]) + np.arange(size[at].sum())
                signature[at] = [r.tobytes() for r in _signatures(words[own], np.append(0, np.cumsum(size[at])), int(n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signature, pa.binary())], [*batch.schema.names, "signature"])

    return ranked.mapInArrow(run, "id long, copies long, ranked array<long>, size int, signature binary")


class Bounds:
    """Rows that meet in groups, with what bounds the words two of them share."""

    def __init__(self, table: pa.Table, overlap: float):
        self.size, self.place = (np.asarray(table.column(c), np.int64) for c in ("size", "place"))
        self.overlap = overlap
        own = table.column("signature").combine_chunks()
        own = own.cast(pa.binary())
        starts = np.frombuffer(own.buffers()[1] or bytes(4), np.int32)[own.offset : own.offset + len(own) + 1].astype(np.int64)
        self.bits = 8 * np.diff(starts)
        parts = np.frombuffer(own.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]].view(np.uint64)
        starts = (starts - starts[0]) // 8
        #: By number of bits: the 64-bit columns of all signatures of as many bits or more, halved down to them, and where a row's is.
        self.signatures: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows, above = np.zeros(0, np.int64), None
        for n in range(MOST_BITS.bit_length() - 1, 5, -1):
            at = np.flatnonzero(self.bits == 1 << n)
            width = (1 << n) // 64
            here = parts[starts[at][:, None] + np.arange(width)]
            above = here if above is None else np.concatenate([above[:, :width] | above[:, width:], here])
            columns = np.ascontiguousarray(above.T)
            rows = np.concatenate([rows, at])
            where = np.full(len(own), -1)
            where[rows] = np.arange(len(rows))
            self.signatures[1 << n] = columns, where

    def signed(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs those whose signatures do not show too many words that only one of both has."""
        need = _need(np.maximum(self.size[i], self.size[j]), self.overlap)
        ok, bits = np.ones(len(i), bool), np.minimum(self.bits[i], self.bits[j])
        for n in np.flatnonzero(np.bincount(bits)):
            at = np.flatnonzero(bits == n)
            columns, where = self.signatures[int(n)]
            a, b = where[i[at]], where[j[at]]
            alone = np.zeros((2, len(at)), np.uint16)
            for column in columns:
                x, y = column[a], column[b]
                alone[0] += np.bitwise_count(x & ~y)
                alone[1] += np.bitwise_count(y & ~x)
            ok[at] = np.minimum(self.size[i[at]] - alone[0], self.size[j[at]] - alone[1]) >= need[at]
        return i[ok], j[ok]

    def possible(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs those that lengths, places and signatures do not rule out."""
        # Counted at the first shared word, so nothing before it is shared.
        most = np.minimum(self.size[i] - self.place[i], self.size[j] - self.place[j])
        ok = most >= _need(np.maximum(self.size[i], self.size[j]), self.overlap)
        return self.signed(i[ok], j[ok])


class Sets(Bounds):
    """The same with the words, for exact counts of pairs."""

    def __init__(self, table: pa.Table, overlap: float):
        super().__init__(table, overlap)
        words = np.asarray(table.column("ranked").combine_chunks().flatten(), np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.size)])
        known, self.codes = np.unique(words, return_inverse=True)
        self.n_words = len(known)
        self.held = np.sort(np.repeat(np.arange(len(self.size)), self.size) * self.n_words + self.codes)

    def _shared(self, i: np.ndarray, j: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """How many of the words of i from place start up to place stop j has."""
        n, out = stop - start, np.zeros(len(i), np.int64)
        for a, b in _runs(n, _LOOKED):
            pair = np.repeat(np.arange(a, b), n[a:b])
            asked = j[pair] * self.n_words + self.codes[np.repeat(self.bounds[i[a:b]] + start[a:b], n[a:b]) + _places(n[a:b])]
            hit = self.held[np.minimum(np.searchsorted(self.held, asked), len(self.held) - 1)] == asked
            out[a:b] = np.bincount(pair[hit] - a, minlength=b - a)
        return out

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs above the overlap whose first shared word is that of their group."""
        ok = self._shared(i, j, np.zeros(len(i), np.int64), self.place[i]) == 0
        i, j = i[ok], j[ok]
        both = self._shared(i, j, self.place[i], self.size[i])
        ok = both > self.overlap * np.maximum(self.size[i], self.size[j]) + 1e-9
        return i[ok], j[ok]


def _runs(n: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges that cover all of n, each with a sum of about `most` or a single entry."""
    total, a = np.cumsum(n), 0
    while a < len(n):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _pairs(bounds: Bounds, group: np.ndarray, own: np.ndarray, single: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The possible pairs of rows of each group, some at a time.

    Rows of a group lie by size: each meets those after it up to the largest size of which it can still hold enough,
    its words before the shared one left out; a larger set always has enough words from a place of its prefix on.
    Where a group is two different blocks (not single), only pairs between them count.
    """
    if not len(group):
        return
    order = np.lexsort((bounds.size, group))
    size, group = bounds.size[order], group[order].astype(np.int64)
    largest = np.searchsorted(_need(np.arange(size.max() + 1), bounds.overlap), size - bounds.place[order], "right") - 1
    wide = size.max() + 1
    end = np.searchsorted(group * wide + size, group * wide + largest, "right")
    n = np.maximum(end - np.arange(len(size)) - 1, 0)
    for a, b in _runs(n, _PAIRS):
        i = np.repeat(np.arange(a, b), n[a:b])
        i, j = order[i], order[i + 1 + _places(n[a:b])]
        ok = single[i] | (own[i] != own[j])
        yield bounds.signed(i[ok], j[ok])


def _met(ranked: DataFrame, overlap: float, block_rows: int) -> DataFrame:
    """(word, bi, bj, id, place, own, size, signature): the prefix words that may be in two prefixes, by pairs of blocks.

    A word's blocks follow from its count, so that all tasks deal it alike; `own` is the set's block.
    """
    counts = _counts(ranked, "ranked", overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, size = _flat(batch.column("ranked"))
            place, row, n = _places(size), np.repeat(np.arange(len(size)), size), counts[_slots(words)].astype(np.int64)
            keep = (place < np.repeat(_prefix(size, overlap), size)) & (n > 1)
            place, row, words, blocks = place[keep], row[keep], words[keep], -(-n[keep] // block_rows)
            ids = np.asarray(batch.column("id"), np.int64)
            mixed = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            own = ((mixed >> np.uint64(32))[row] % blocks.astype(np.uint64)).astype(np.int64)
            for a, b in _runs(blocks, _PAIRS):
                at = np.repeat(np.arange(a, b), blocks[a:b])
                other, of = _places(blocks[a:b]), pa.array(row[at])
                yield pa.RecordBatch.from_arrays([
                    pa.array(words[at]), pa.array(np.minimum(own[at], other), pa.int32()), pa.array(np.maximum(own[at], other), pa.int32()), batch.column("id").take(of),
                    pa.array(place[at], pa.int32()), pa.array(own[at], pa.int32()), batch.column("size").take(of), batch.column("signature").take(of),
                ], ["word", "bi", "bj", "id", "place", "own", "size", "signature"])

    schema = "word long, bi int, bj int, id long, place int, own int, size int, signature binary"
    return ranked.select("id", "size", "ranked", "signature").mapInArrow(run, schema)


def _with_partner(rows: DataFrame, overlap: float) -> DataFrame:
    """Of the rows of meetings, known by bounds only, those that have a possible partner there."""
    columns = [*_KEYS, "id", "place", "own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, _KEYS):
            own, bi, bj = (np.asarray(table.column(c)) for c in ("own", "bi", "bj"))
            hit = np.zeros(table.num_rows, bool)
            for i, j in _pairs(Bounds(table, overlap), group, own, bi == bj):
                hit[i] = hit[j] = True
            yield from table.select(columns).filter(pa.array(hit)).to_batches()

    return rows.mapInArrow(run, rows.select(columns).schema)


def _meetings(rows: DataFrame, overlap: float) -> DataFrame:
    """(id, links, first): per class and meeting the copies of its partners and the smallest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, _KEYS):
            sets = Sets(table, overlap)
            ids, copies, own, bi, bj = (np.asarray(table.column(c)) for c in ("id", "copies", "own", "bi", "bj"))
            links, first = np.zeros(len(ids), np.int64), ids.copy()
            for i, j in _pairs(sets, group, own, bi == bj):
                i, j = sets.near(i, j)
                for a, b in ((i, j), (j, i)):
                    np.add.at(links, a, copies[b])
                    np.minimum.at(first, a, ids[b])
            hit = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit]), pa.array(first[hit])], ["id", "links", "first"])

    return rows.mapInArrow(run, "id long, links long, first long")


def similar_sets(sets: DataFrame, key: list[str], words: str, overlap: float = 0.65, block_rows: int = 1024) -> DataFrame:
    """One row per set: key columns, ``n_similar`` (other sets above the overlap, equal ones included) and ``first``, the
    key (a struct) of the smallest among itself and these.

    ``words`` is an array of words, repeats count once; empty sets are similar to nothing.  Rows with equal keys are
    sets of their own, others named like the result or starting with ``__`` are not carried.
    """
    hashed = F.sort_array(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))
    named = sets.select(F.struct(*key).alias("__key"), hashed.alias("words"))
    named = durable(named.withColumns({"__h": F.xxhash64("words"), "__g": F.xxhash64(F.lit(1), "words")}))
    classes = named.filter(F.size("words") > 0).groupBy("__h", "__g").agg(
        F.first("words").alias("words"), F.count(F.lit(1)).alias("copies"), F.min("__key").alias("__low")
    )
    # Ids that grow with the smallest key, so that the smallest partner is known by its id.
    ordered = classes.repartitionByRange(F.col("__low"), F.col("__h")).sortWithinPartitions("__low", "__h")
    classes = durable(ordered.withColumn("id", F.monotonically_increasing_id()))
    ranked = durable(_signed(_ordered_words(classes)))

    def dealt(rows: DataFrame) -> DataFrame:
        """Whole meetings in a task."""
        return rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS)

    near = durable(_with_partner(dealt(_met(ranked, overlap, block_rows)), overlap))
    found = _meetings(dealt(near.join(ranked, "id")), overlap).groupBy("id").agg(F.sum("links").alias("links"), F.min("first").alias("first"))
    found = durable(found)
    slim = classes.select("id", "__h", "__g", "copies", "__low")
    lows = slim.select(F.col("id").alias("first"), F.col("__low").alias("__first"))
    linked = looked_up(found, ["first"], lows, "id").select("id", "links", "__first")
    known = slim.join(linked, "id", "left").select(
        "__h", "__g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_similar"),
        F.least(F.col("__low"), F.coalesce("__first", "__low")).alias("first"),
    )
    out = looked_up(named.select("__key", "__h", "__g"), ["__h", "__g"], known, "__key")
    return out.select("__key.*", F.coalesce("n_similar", F.lit(0)).cast("long").alias("n_similar"), F.coalesce("first", "__key").alias("first"))


def similar_sections(docs: DataFrame, key: str, text: str, overlap: float = 0.65, mark: str = "\n", minimum: int = 40) -> DataFrame:
    """Sections of all documents with the number of similar ones and the first of these: key, section, n_similar,
    first_<key>, first_section."""
    found = similar_sets(sections_of(docs, key, text, mark, minimum), [key, "section"], "words", overlap)
    return found.select(key, "section", "n_similar", F.col(f"first.{key}").alias(f"first_{key}"), F.col("first.section").alias("first_section"))
