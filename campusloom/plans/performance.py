"""Search-performance loop: snapshot, priorities, candidates, gates, difference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campusloom import rules
from campusloom.functions.jsonfix import repair_json_short
from campusloom.functions.seo import enforce_length, meta_score, needs_title
from campusloom.functions.urls import classify
from campusloom.operators.joins import in_list_order, require_kind


def with_page_class(perf: DataFrame) -> DataFrame:
    kind = classify(F.col("url"))
    return perf.withColumn("entity_type", kind["entity_type"]).withColumn("slug", kind["slug"])


def rewrite_candidates(priorities: DataFrame, rows: DataFrame, kind: str, name: str, brand: str, limit: int) -> DataFrame:
    """Records of a priority list, in its order, whose title is still generic."""
    wanted = require_kind(priorities, kind).select(F.col("rank").alias("position"), "slug")
    keep = needs_title(kind, F.col("meta_title"), F.col(name), brand)
    return in_list_order(wanted, rows, "slug", "position", keep, limit)


def gate_meta(responses: DataFrame, name: Column, brand: str, raw: str = "raw") -> DataFrame:
    """Parse, repair, shorten and score proposed titles and descriptions."""
    v = F.try_parse_json(repair_json_short(F.col(raw)))

    def text(path: str) -> Column:
        is_text = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
        return F.when(is_text, F.try_variant_get(v, path, "string"))

    out = (
        responses.withColumn("__t", text("$.title")).withColumn("__d", text("$.description"))
        .withColumn("title", enforce_length(F.col("__t"), rules.TITLE_LIMIT, brand))
        .withColumn("description", enforce_length(F.col("__d"), rules.DESCRIPTION_LIMIT, brand))
    )
    given = F.col("__t").isNotNull() & F.col("__d").isNotNull()
    filled = (F.coalesce("title", F.lit("")) != "") & (F.coalesce("description", F.lit("")) != "")
    score = F.when(given & filled, meta_score(name, F.col("title"), F.col("description"))).otherwise(0)
    return (
        out.withColumn("meta_score", score)
        .withColumn("publish", F.col("meta_score") >= rules.META_THRESHOLD)
        .drop("__t", "__d")
    )
