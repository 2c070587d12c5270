"""Relationship backfill and the report of programs without a course."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from campusloom.operators.graph import add_edges, build_edges
from campusloom.operators.matching import link_programs, match_one_course, match_programs, matched_courses, unmatched_programs
from campusloom.operators.reports import backfill_counters, matching_counters, unmatched_ranking
from campusloom.sources.tables import run_batches
from campusloom.session import durable


def link_scope(scope: DataFrame, programs: DataFrame, courses: DataFrame, course: tuple[object, str] | None = None) -> DataFrame:
    """Programs of the records in scope with their course, matched once per text.

    With ``course`` (id, title) the run is restricted to it: programs relevant to its
    title get its id and no others are part of the run.
    """
    mine = programs.join(scope.select("entity_id"), "entity_id", "left_semi")
    if course is not None:
        key, title = course
        return match_one_course(mine, title).withColumn("course_id", F.lit(key).cast(courses.schema["course_id"].dataType))
    return link_programs(mine, match_programs(mine, courses))


def backfill(scope: DataFrame, programs: DataFrame, courses: DataFrame, known: dict[str, DataFrame], course: tuple[object, str] | None = None) -> dict[str, DataFrame]:
    """Updated edge tables and counters of a run over a scope, restricted to one course if given."""
    linked = durable(link_scope(scope, programs, courses, course))  # read by edges and counters
    new = build_edges(scope, matched_courses(linked))
    out = {n: add_edges(known[n], e) if n in known else e for n, e in new.items()}
    return {**out, "counters": backfill_counters(scope, linked)}


def unmatched_report(scope: DataFrame, programs: DataFrame, courses: DataFrame) -> dict[str, DataFrame]:
    """Raw unmatched pairs, their ranking and the counters; read-only."""
    linked = durable(link_scope(scope, programs, courses))
    named = scope.select("entity_id", F.col("name").alias("entity_name"), "country_id")
    raw = durable(unmatched_programs(linked).join(named, "entity_id"))
    ordered = raw.withColumn("ord", F.struct("entity_id", F.coalesce("category", F.lit("")), F.coalesce("level", F.lit(""))))
    return {"raw": raw, "ranking": unmatched_ranking(ordered), "counters": matching_counters(scope, linked)}


def resumable_backfill(scope: DataFrame, programs: DataFrame, courses: DataFrame, out: str, run_key: str, size: int = 100_000, resume: bool = False, dry_run: bool = False, max_batches: int | None = None) -> dict:
    """Backfill in key order; each batch writes its own edge folder, then counts.

    The programs in scope are read and their texts matched to courses once, before the first batch.
    """
    mine = durable(programs.join(scope.select("entity_id"), "entity_id", "left_semi"))
    matches = match_programs(mine, courses)

    def work(batch: DataFrame, batch_no: int) -> dict:
        linked = durable(link_programs(mine.join(batch.select("entity_id"), "entity_id", "left_semi"), matches))
        if not dry_run:
            for name, e in build_edges(batch, matched_courses(linked)).items():
                e.write.mode("overwrite").parquet(f"{out}/{name}/run_key={run_key}/batch={batch_no}")
        c = backfill_counters(batch, linked).first()
        return {"processed": c.processed, "linked": c.course_links, "unmatched": c.programs_unmatched, "skipped": c.skipped}

    return run_batches(scope, "entity_id", f"{out}/progress", run_key, work, size, resume, dry_run, max_batches)
