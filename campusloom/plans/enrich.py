"""End-to-end record job and its variant for unreachable sites."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from campusloom import rules
from campusloom.operators.joins import with_country_name
from campusloom.operators.matching import link_programs, match_programs, matched_courses, resolve_country
from campusloom.operators.quality import (
    decide, external_only_confidence, missing_required, record_status,
)
from campusloom.operators.records import failure_reason, fill_gaps, merge_extracted, validate
from campusloom.session import durable


def score_records(
    extracted: DataFrame, external: DataFrame, names: DataFrame, model: DataFrame, by_country: DataFrame
) -> DataFrame:
    """Merge, fill, validate and score: one row per record.

    ``names`` has entity_id, name; ``model`` has entity_id, model_score,
    model_overridden, hallucinations (no row = no model answered).  Rows stay
    partitioned by entity_id throughout; rule tables are small.
    """
    merged = merge_extracted(extracted, external).join(names.select("entity_id", "name"), "entity_id")
    filled = fill_gaps(merged, by_country, country="country", live=True)
    for f in ("students_placed",):
        if f not in filled.columns:
            filled = filled.withColumn(f, F.lit(None).cast("double"))
    if "image_urls" not in filled.columns:
        filled = filled.withColumn("image_urls", F.array().cast("array<string>"))
    checked = validate(filled)
    with_model = checked.join(
        model.select("entity_id", "model_score", "model_overridden", "hallucinations"), "entity_id", "left"
    )
    scored = decide(with_model).withColumn("missing_fields", missing_required())
    status = record_status(F.col("missing_fields"), F.col("decision"), F.col("confidence_score"))
    out = scored.withColumn("status", F.when(F.col("success"), status).otherwise("failed"))
    reason = (
        F.when(~F.col("success"), F.concat(F.lit("Schema validation failed: "), F.array_join(F.slice("errors", 1, 3), ", ")))
        .when(F.col("status") == "failed", failure_reason(F.col("structural_issues"), F.col("hallucinations")))
        .when(
            (F.col("status") == "partial") & (F.size("missing_fields") > 0),
            F.concat(F.lit("Missing fields: "), F.array_join("missing_fields", ", ")),
        )
    )
    return out.withColumn("is_enriched", F.col("status").isin("completed", "partial")).withColumn("reason", reason)


@dataclass(frozen=True)
class Enriched:
    """Records with status and resolved country; their course links are computed when asked for."""

    records: DataFrame
    courses: DataFrame

    def programs(self) -> DataFrame:
        """(entity_id, category, level, course_id) of the valid records, course_id NULL without a match."""
        programs = self.records.filter("success").select("entity_id", F.explode("programs").alias("p")).select(
            "entity_id", "p.category", "p.level"
        )
        return link_programs(programs, match_programs(programs, self.courses))

    def links(self) -> DataFrame:
        """Distinct (entity_id, course_id)."""
        return matched_courses(self.programs())


def enrich_catalog(
    entities: DataFrame, extracted: DataFrame, external: DataFrame, model: DataFrame,
    countries: DataFrame, courses: DataFrame, by_country: DataFrame,
) -> Enriched:
    """The whole record job.  Records are scored once and kept durably, for placing and for linking."""
    scored = durable(score_records(extracted, external, entities, model, by_country))
    placed = resolve_country(
        scored.join(entities.select("entity_id", "country_id"), "entity_id"), countries, "country", "country_id"
    )
    return Enriched(placed, courses)


def enrich_external_only(external: DataFrame, names: DataFrame, by_country: DataFrame) -> DataFrame:
    """Records of unreachable sites from outside sources alone; attempts become terminal."""
    base = external.join(names.select("entity_id", "name"), "entity_id")
    for f, kind in {
        "description": "string", "city": "string", "country": "string", "tuition_fee": "string",
        "total_students": "string", "intakes": "array<string>", "admission_requirements": "array<string>",
        "similar_universities": "array<string>", "programs": "array<struct<category:string,level:string>>",
    }.items():
        if f not in base.columns:
            base = base.withColumn(f, F.lit(None).cast(kind))
    filled = fill_gaps(base, by_country, country="country", live=True)
    scored = filled.withColumn("missing_fields", missing_required())
    scored = scored.withColumn("confidence_score", external_only_confidence(F.col("missing_fields"), F.col("description")))
    return (
        scored.withColumn("status", F.lit("partial"))
        .withColumn("is_enriched", F.col("confidence_score") >= rules.ENRICHED_AT)
        .withColumn("crawl_attempts", F.lit(rules.TERMINAL_ATTEMPTS))
    )


def patch_gaps(entities: DataFrame, countries: DataFrame, by_country: DataFrame) -> DataFrame:
    """Batch gap patch of a catalog: only records that got at least one field."""
    return fill_gaps(with_country_name(entities, countries), by_country).filter(F.size("patched_fields") > 0)
