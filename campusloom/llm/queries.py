"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard, licenses, mixing, near_vectors, packing, pii, prefix_trie, quality, quality_rules, search, token_files, toxicity, variants
from .shared import cut, new_path
from .sql import SQL

Query = Callable[[SparkSession, str], DataFrame]
CAPACITY = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def license_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "license", "dice", F.array_join("licenses", ",").alias("licenses"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_matches", "license", "dice", F.array_join("licenses", ",").alias("licenses"))


def license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_matches", "license", "dice", F.array_join("licenses", ",").alias("licenses"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = cut(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size")), "sizes")
    return mixing.mix_sources(sizes, F.col("size")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")).drop("lang", "source")


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = cut(packing.pieces(table(spark, sf_dir, "documents"), vocabulary(), CAPACITY), "pieces")
    return packing.pack(pieces, CAPACITY)


def toxic_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    token_files.write_ids(table(spark, sf_dir, "documents"), path, vocabulary(), end_id=2)
    return token_files.positions(token_files.read_ids(spark, path))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_license_scan": license_scan,
    "op1_license_texts": license_texts,
    "op1_license_lines": license_lines,
    "op2_source_mix": source_mix,
    "op3_quality_rules": rules,
    "op4_exact_top_k": exact_top_k,
    "op5_best_fit_packing": best_fit_packing,
    "op6_toxicity": toxic_terms,
    "op7_ngram_jaccard": ngram_jaccard,
    "op8_quality_classifier": quality_classifier,
    "op9_token_id_files": token_id_files,
    "op10_personal_data": personal_data,
    "op11_spelling_variants": spelling_variants,
    "op12_embedding_near_dedup": embedding_near_dedup,
    "op13_conversation_trie": conversation_trie,
}

__all__ = ["QUERIES", "SQL"]
