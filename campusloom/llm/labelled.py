"""Labelled rows for the classifiers: which ids are held out, and a bounded sample of the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text, divisible by 5. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """(doc_id, text, label) of at most `most` labelled documents, chosen by a hash of their ids.

    The chosen ids are `most` at most and therefore broadcast; all texts are scanned once, none
    are shuffled. An id with several labels counts as 1 if one of them is.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    chosen = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
