"""Relationship graph of records, countries and courses as edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def build_edges(entities: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """Edges implied by a matching run.

    ``entities`` has entity_id, country_id; ``links`` has entity_id, course_id.
    Each table serves both directions: country_course is the popular courses of
    a country as well as the countries of a course.
    """
    placed = entities.filter(F.col("country_id").isNotNull()).select("entity_id", "country_id")
    return {
        "entity_course": links.select("entity_id", "course_id").distinct(),
        "country_entity": placed.select("country_id", "entity_id").distinct(),
        "country_course": placed.join(links, "entity_id").select("country_id", "course_id").distinct(),
    }


def add_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add-to-set: known edges stay, each new one is added once."""
    return old.select(*new.columns).unionByName(new).distinct()


def edges_of_lists(df: DataFrame, owner: str, members: str, member: str) -> DataFrame:
    """Edge table of a stored reference list."""
    return df.select(F.col(owner), F.explode(members).alias(member)).distinct()


def degrees(edges: DataFrame, owner: str) -> DataFrame:
    return edges.groupBy(owner).agg(F.count(F.lit(1)).alias("n_members"))


def edge_lists(edges: DataFrame, owner: str, member: str, part_size: int = 50_000) -> DataFrame:
    """Reference lists (owner, part_no, members), each near ``part_size`` at most.

    An owner with more members gets several parts chosen by a hash of the
    member, so that no list and no task grows with the largest owner.
    """
    big = degrees(edges, owner).filter(F.col("n_members") > part_size).select(
        F.col(owner).alias("__o"), F.ceil(F.col("n_members") / part_size).cast("int").alias("__parts")
    )
    part = F.when(F.col("__parts").isNotNull(), F.pmod(F.xxhash64(member), F.col("__parts")).cast("int")).otherwise(0)
    return (
        edges.join(big, F.col(owner) == F.col("__o"), "left")
        .withColumn("part_no", part)
        .groupBy(owner, "part_no")
        .agg(F.array_sort(F.collect_list(member)).alias("members"))
    )
