"""Quality of a record: completeness, structural score, decision, status."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from campusloom import rules
from campusloom.functions.basics import bound, clamp, list_size


def _text(c: str) -> Column:
    return F.coalesce(F.length(c), F.lit(0))


def missing_required() -> Column:
    """Names of the required fields a record does not have."""
    checks = {
        "description": _text("description") >= 80,
        "city": _text("city") > 1,
        "country": _text("country") > 1,
        "tuition_fee": _text("tuition_fee") > 3,
        "total_students": _text("total_students") > 0,
        "intakes": list_size(F.col("intakes")) >= 1,
        "admission_requirements": list_size(F.col("admission_requirements")) >= 3,
        "programs": list_size(F.col("programs")) >= 3,
        "similar_universities": list_size(F.col("similar_universities")) >= 1,
    }
    return F.array_compact(F.array(*[F.when(~ok, F.lit(f)) for f, ok in checks.items()]))


def _band(value: Column, bands: list[tuple[float, float]]) -> Column:
    out = F.lit(0.0)
    for low, points in reversed(bands):
        out = F.when(value >= low, F.lit(points)).otherwise(out)
    return out


def structural_score() -> Column:
    """Presence and size of the fields, 0.55 .. 0.97."""
    parts = [
        _band(_text("description"), [(150, 0.1), (80, 0.07), (40, 0.03)]),
        _band(_text("city"), [(1, 0.04)]),
        _band(_text("country"), [(1, 0.05)]),
        _band(list_size(F.col("programs")), [(5, 0.08), (3, 0.06), (1, 0.03)]),
        _band(list_size(F.col("admission_requirements")), [(4, 0.05), (2, 0.03), (1, 0.01)]),
        _band(list_size(F.col("intakes")), [(2, 0.04), (1, 0.02)]),
        _band(_text("tuition_fee"), [(1, 0.04)]),
        _band(_text("total_students"), [(1, 0.02)]),
        F.when(F.coalesce(F.col("qs_ranking").cast("double"), F.lit(0.0)) != 0, 0.02).otherwise(0.0),
        F.when(F.coalesce(F.col("acceptance_rate").cast("double"), F.lit(0.0)) != 0, 0.02).otherwise(0.0),
        _band(list_size(F.col("similar_universities")), [(1, 0.01)]),
    ]
    total = F.lit(0.55)
    for p in parts:
        total = total + p
    return F.least(F.lit(0.97), total)


def structural_issues() -> Column:
    """Texts of obvious problems; the grave ones start with CRITICAL:."""
    rank, rate, text = F.col("qs_ranking").cast("double"), F.col("acceptance_rate").cast("double"), F.col("description")
    bad_level = F.transform(
        F.coalesce("programs", F.array().cast("array<struct<category:string,level:string>>")),
        lambda p, i: F.when(
            ~F.coalesce(p["level"].isin(rules.PROGRAM_LEVELS), F.lit(False)),
            F.format_string('Program[%d] invalid level: "%s"', i, p["level"]),
        ),
    )
    openings = "|".join(rules.NAVIGATION_OPENINGS)
    has_text = F.coalesce(text, F.lit("")) != ""
    singles = F.array(
        F.when((rank != F.floor(rank)) | (rank < 1) | (rank > 1500), F.concat(F.lit("CRITICAL: Invalid QS ranking: "), F.col("qs_ranking").cast("string"))),
        F.when((rate < 0.1) | (rate > 100), F.concat(F.lit("CRITICAL: Invalid acceptance rate: "), F.col("acceptance_rate").cast("string"))),
    )
    texts = F.array(
        F.when(has_text & (F.length(text) < 20), F.lit("Description too short")),
        F.when(has_text & F.trim(text).rlike(f"(?i)^(?:{openings})"), F.lit("CRITICAL: Description looks like navigation/boilerplate text")),
    )
    return F.array_compact(F.concat(singles, bad_level, texts))


def is_critical(issues: Column) -> Column:
    return F.exists(issues, lambda i: i.startswith("CRITICAL:"))


#: By k, whether the double nearest to k + 1/2 thousandths is not below it: such midpoints round up.
_MIDPOINTS_UP = "".join(str(int(Fraction((2 * k + 1) / 2000) >= Fraction(2 * k + 1, 2000))) for k in range(1000))


def three_digits(score: Column) -> Column:
    """A score from 0 to 1 with three digits, rounded by its exact binary value; true ties go up."""

    def rounded(x: Column) -> Column:
        k = F.floor(x * 1000)
        middle = (2 * k + 1) / F.lit(2000.0)
        tie_up = F.substring(F.lit(_MIDPOINTS_UP), k.cast("int") + 1, F.lit(1)) == "1"
        return (k + F.when((x > middle) | ((x == middle) & tie_up), 1).otherwise(0)) / 1000

    return bound(score, rounded)


def blended_score(structural: Column, model: Column, trusted_model: Column, n_hallucinations: Column) -> Column:
    """Model and structure weighted, minus penalties, 0 .. 0.98."""
    m = F.coalesce(F.nullif(model, F.lit(0.0)), structural)
    real = F.coalesce(trusted_model, F.lit(False)) & (m != 0.5)
    mixed = F.when(real, m * 0.55 + structural * 0.45).otherwise(structural * 0.85 + m * 0.15)
    score = (
        mixed
        - F.when(_text("description") == 0, 0.12).otherwise(0.0)
        - F.when(list_size(F.col("programs")) == 0, 0.06).otherwise(0.0)
        - F.when(_text("country") == 0, 0.05).otherwise(0.0)
        - F.coalesce(n_hallucinations, F.lit(0)) * 0.08
    )
    return three_digits(clamp(score, 0.0, 0.98))


def decide(df: DataFrame) -> DataFrame:
    """Accept, partial or reject.

    Needs the record columns plus model_score (NULL when no model answered),
    model_overridden and hallucinations (array).  A model score of 0.5 or an
    unreadable one counts as overridden by the structural score.
    """
    base = df.withColumn("structural_issues", structural_issues()).withColumn("structural_score", structural_score())
    crit = is_critical(F.col("structural_issues"))
    s, m = F.col("structural_score"), F.col("model_score").cast("double")
    skipped = ~crit & (s >= rules.SKIP_MODEL_AT)
    weak = F.coalesce(F.col("model_overridden"), F.lit(False)) | F.coalesce(m == 0.5, F.lit(False))
    value = F.when(m.isNull(), s).when(weak, F.greatest(s, F.lit(0.55))).otherwise(m)
    # Without any answer the structural score itself takes the model's place.
    blended = blended_score(s, value, ~weak, F.coalesce(F.size("hallucinations"), F.lit(0)))
    score = F.when(crit, 0.15).when(skipped, s).otherwise(blended)
    decision = (
        F.when(crit, "reject")
        .when(F.col("confidence_score") >= rules.CONFIDENCE_TRUSTED, "accept")
        .when(F.col("confidence_score") >= rules.CONFIDENCE_PARTIAL, "partial")
        .otherwise("reject")
    )
    return (
        base.withColumn("model_skipped", skipped)
        .withColumn("confidence_score", score)
        .withColumn("decision", decision)
        .withColumn("is_valid", ~crit & (F.col("confidence_score") >= rules.CONFIDENCE_PARTIAL))
    )


def fallback_decision(issues: Column, structural: Column) -> Column:
    """Decision when no model answered at all."""
    return (
        F.when(is_critical(issues), "reject")
        .when(structural >= rules.CONFIDENCE_TRUSTED, "accept")
        .otherwise("partial")
    )


def record_status(missing: Column, decision: Column, score: Column) -> Column:
    complete = F.size(missing) == 0
    return (
        F.when(complete & ((decision == "accept") | (score >= rules.COMPLETED_AT)), "completed")
        .when((decision == "partial") | (score >= rules.ENRICHED_AT), "partial")
        .otherwise("failed")
    )


def external_only_confidence(missing: Column, description: Column) -> Column:
    return (
        F.when(F.size(missing) == 0, 0.62)
        .when(F.coalesce(description, F.lit("")) != "", 0.58)
        .otherwise(0.5)
    )
