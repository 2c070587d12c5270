"""From raw documents to packed training sequences, in stages that each write a table.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and returns the
columns of documents; the last returns packed pieces. Columns beside doc_id, text, lang, source and
n_chars pass through unless they carry a name that starts with `_corpus_`. An empty table passes
through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campusloom.llm import jaccard, mixing, packing, pii, quality
from campusloom.llm.queries import CAPACITY, table, vocabulary
from campusloom.llm.shared import cut

#: SQL has no boosted trees, sequence tagger, cube method or tokenizer.
ORACLE_SQL = None


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects. Null and empty texts are scored like others."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    names = ("_corpus_score", "_corpus_good")
    return quality.score(docs, model, names=names).filter(F.col(names[1]) == 1).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each linked group.

    Rows that share an id are one document: the row with the smallest text stays. Rows without an id
    cannot be compared and stay.
    """
    kept = jaccard.join(docs).filter(F.col("doc_id") == F.col("class_id")).select(F.col("doc_id").alias("_corpus_id"))
    named = docs.join(kept, docs["doc_id"] == kept["_corpus_id"], "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), *(F.col(c) for c in ("lang", "source") if c in docs.columns))
    named = named.withColumn("_corpus_row", F.row_number().over(first)).filter(F.col("_corpus_row") == 1).drop("_corpus_row")
    return named.unionByName(docs.filter(F.col("doc_id").isNull()))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in angle brackets and counts the characters anew. Null texts stay null."""
    return pii.redact(docs, pii.train(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that every source comes near its target number of words."""
    plain = docs.withColumns({"_corpus_row": F.struct(*docs.columns)}).select("_corpus_row", "doc_id", "source", mixing.n_words(F.col("text")).alias("_corpus_size"))
    mixed = mixing.mix_sources(plain, F.col("_corpus_size"))
    return mixed.filter(F.col("copies") > 0).select("_corpus_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_corpus_copy")).select("_corpus_row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most CAPACITY tokens with their sequence and their place in it."""
    return packing.pack(cut(packing.pieces(docs, vocabulary(), CAPACITY), "pieces"), CAPACITY)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", mask_personal_data),
    ("mixing sources", mix_by_source),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = cut(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
