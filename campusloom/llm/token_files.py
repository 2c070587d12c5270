"""Token ids as ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Documents are dealt into ranges of doc_id, one ORC file each, rows in ascending doc_id order. A row
holds the number of its file and its own number in it, so that places follow the rows as they lie.
ORC writes the ids of a stripe with its integer run-length encoding, keeps minimum and maximum
of doc_id for stripes and for every 10,000 rows, and a Bloom filter on doc_id, so that readers
run one task per group of stripes and look-ups skip stripes that cannot hold an id.

Null and empty texts have no ids but the end id. Rows with a null doc_id come first. Rows that share
a doc_id are written as often as they occur, ordered by a hash of the text; any number of them is spread over
ranges. Columns other than doc_id and text are
ignored. An empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import cut
from .tokens import encoder

FORMAT = "doc_id long, chunk int, row long, ids array<int>"


def encode(docs: DataFrame, vocabulary: str, end_id: int | None = None) -> DataFrame:
    """(doc_id, chunk, row, ids) for every row of (doc_id, chunk, row, text): ids of the whole text, then end_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for a, b in enc.slices(batch.column("text")):
                part = batch.slice(a, b - a)
                ids, bounds = enc.ids(part.column("text"))
                if end_id is not None:
                    ids, bounds = np.insert(ids, bounds[1:], end_id), bounds + np.arange(len(bounds))
                lists = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.view("<i4")))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "chunk", "row")), lists], ["doc_id", "chunk", "row", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("chunk").cast("int"), "row", "text").mapInArrow(run, FORMAT)


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int | None = None, stripe_bytes: int = 64 << 20) -> None:
    """Write the ids of all documents to `path` in ascending doc_id order.

    The range exchange moves texts before they are encoded, so that its sampling does not encode
    them a second time. `chunk` is the number of the range.
    """
    # Of rows that share doc_id and text, the place in the input decides, so that they need not share a range.
    order = [F.col("doc_id"), F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place")]
    ranged = docs.select(*order, "text").repartitionByRange("doc_id", "_hash", "_place").sortWithinPartitions("doc_id", "_hash", "_place")
    # Numbers rise along a partition, from the partition's number in the upper bits.
    numbered = ranged.withColumns({"chunk": F.spark_partition_id(), "row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    (
        encode(numbered, vocabulary, end_id)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("compression", "snappy")
        .orc(path)
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, chunk, row, ids) of the files; filters on doc_id reach stripes, row groups and Bloom filters."""
    return spark.read.schema(FORMAT).orc(path)


def digests(files: DataFrame) -> DataFrame:
    """doc_id, chunk, row, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, bounds = np.asarray(lists.values).astype("<i4", copy=False), np.asarray(lists.offsets)
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [*(batch.column(c) for c in ("doc_id", "chunk", "row")), pa.array(np.diff(bounds), pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "chunk", "row", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, chunk int, row long, n_tokens long, ids_crc32 long")


def positions(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The files are read once, into a table of five numbers a document. One row per file meets in a
    small window; a second window runs within a file.
    """
    sized = cut(digests(files), "digests")
    totals = sized.groupBy("chunk").agg(F.sum("n_tokens").alias("total"))
    before = totals.select("chunk", (F.sum("total").over(Window.orderBy("chunk")) - F.col("total")).alias("before"))
    inside = Window.partitionBy("chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sized.join(before, "chunk")
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens"))
        .select("doc_id", "start", "n_tokens", "ids_crc32")
    )
