"""Filters over catalog records: eligibility, gaps, scope, retry rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from campusloom import rules
from campusloom.functions.basics import any_of, before, is_blank, is_empty_list, list_shorter_than, list_size


def is_eligible(status: Column, is_enriched: Column, description: Column, country: Column) -> Column:
    """Completed, enriched or well described, and with a country."""
    good = (
        F.coalesce(status == "completed", F.lit(False))
        | F.coalesce(is_enriched, F.lit(False))
        | (F.length(F.coalesce(description, F.lit(""))) >= 300)
    )
    return good & country.isNotNull()


def gap(kind: str, c: Column, k: int = 3) -> Column:
    """One missing-field test: blank, null, empty_list, empty_or_null_list, short_list."""
    tests = {
        "blank": lambda: is_blank(c),
        "null": lambda: c.isNull(),
        "empty_list": lambda: is_empty_list(c),
        "empty_or_null_list": lambda: list_size(c) == 0,
        "short_list": lambda: list_shorter_than(c, k),
    }
    return tests[kind]()


def gaps(spec: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """``{label: (kind, column)}`` -> ``{label: condition}``."""
    return {label: gap(kind, F.col(name)) for label, (kind, name) in spec.items()}


PATCHABLE = {
    "tuition_fee": ("blank", "tuition_fee"),
    "total_students": ("blank", "total_students"),
    "similar_universities": ("empty_or_null_list", "similar_universities"),
    "programs": ("short_list", "programs"),
    "intakes": ("empty_list", "intakes"),
    "admission_requirements": ("short_list", "admission_requirements"),
}

COUNTRY_CONTENT = ["career_opportunities", "scholarships", "eligibility_requirements", "why_study_cards"]
COURSE_TEXTS = ["subtitle", "overview_title", "overview_description", "career_prospects", "salary_expectations"]
COURSE_LISTS = ["key_highlights", "entry_requirements", "popular_job_roles", "faqs"]


def incomplete_country() -> Column:
    return any_of([is_empty_list(F.col(c)) for c in COUNTRY_CONTENT])


def incomplete_course() -> Column:
    return any_of([is_blank(F.col(c)) for c in COURSE_TEXTS] + [is_empty_list(F.col(c)) for c in COURSE_LISTS])


def has_demand(n_links: Column, minimum: int = 3) -> Column:
    """Whether a course has enough linked records; takes their number, so no list has to be gathered."""
    return n_links >= minimum


def worth_enriching_course(n_links: Column, minimum: int = 3) -> Column:
    return has_demand(n_links, minimum) & incomplete_course()


def scope(
    entities: DataFrame,
    eligible: Column,
    mode: str = "all",
    value: str | None = None,
    countries: DataFrame | None = None,
    courses: DataFrame | None = None,
) -> DataFrame:
    """Records of a run: all, one country, one course keyword or one record.

    A single record bypasses eligibility.  An unknown slug is an error.
    """
    if mode == "university":
        out = entities.filter(F.lower("slug") == value.lower())
        if out.isEmpty():
            raise ValueError(f"no record with slug {value!r}")
        return out
    out = entities.filter(eligible)
    if mode == "all":
        return out
    if mode == "country":
        hit = countries.filter(F.lower("slug") == value.lower()).select("country_id").orderBy("country_id").first()
        if hit is None:
            raise ValueError(f"no country with slug {value!r}")
        return out.filter(F.col("country_id") == hit.country_id)
    if mode == "course":
        hit = courses.filter(F.lower("slug") == value.lower()).select("title", "course_id").orderBy("course_id").first()
        if hit is None:
            raise ValueError(f"no course with slug {value!r}")
        word = (hit.title or "").split()[:1]
        return out.filter(mentions(F.col("programs"), word[0] if word else ""))
    raise ValueError(f"unknown scope {mode!r}")


def mentions(programs: Column, word: str) -> Column:
    """Some program subject contains the word, ignoring case."""
    w = F.lit(word.lower())
    return F.coalesce(F.exists(programs, lambda p: F.lower(p["category"]).contains(w)), F.lit(False))


def attempts_below(attempts: Column, limit: int) -> Column:
    """Fewer attempts than the limit; a missing counter passes."""
    return attempts.isNull() | (attempts < limit)


def has_website(website: Column) -> Column:
    """Anything but an empty text; NULL passes, as for a stored null."""
    return F.coalesce(website != "", F.lit(True))


def is_unprocessed() -> Column:
    return (
        ~F.coalesce(F.col("is_enriched"), F.lit(False))
        & has_website(F.col("website"))
        & (F.col("status").isNull() | (F.col("status") == "pending"))
        & attempts_below(F.col("crawl_attempts"), rules.TERMINAL_ATTEMPTS)
    )


def is_failed_retry(now: Column, hours: int = 4) -> Column:
    dead = F.coalesce(F.col("failed_reason").rlike(rules.DEAD_REASON), F.lit(False))
    return (
        F.coalesce(F.col("status") == "failed", F.lit(False))
        & F.coalesce(before(F.col("last_enriched_at"), now, hours=hours), F.lit(False))
        & has_website(F.col("website"))
        & attempts_below(F.col("crawl_attempts"), 4)
        & ~dead
    )


def is_partial_retry(now: Column, hours: int = 12) -> Column:
    return (
        F.coalesce(F.col("status") == "partial", F.lit(False))
        & F.coalesce(F.col("confidence_score") < 0.7, F.lit(False))
        & F.coalesce(before(F.col("last_enriched_at"), now, hours=hours), F.lit(False))
        & has_website(F.col("website"))
        & attempts_below(F.col("crawl_attempts"), 5)
    )


def needs_reenrichment() -> Column:
    """Few known attempts, and partial or enriched with gaps."""
    enriched = F.coalesce(F.col("is_enriched"), F.lit(False))
    with_gap = any_of(
        [is_blank(F.col("tuition_fee")), is_blank(F.col("total_students")), list_shorter_than(F.col("programs"), 3)]
    )
    return (
        has_website(F.col("website"))
        & F.coalesce(F.col("crawl_attempts") < 4, F.lit(False))
        & (F.coalesce(F.col("status") == "partial", F.lit(False)) | (enriched & with_gap))
    )


def reset_stuck(df: DataFrame, now: Column, minutes: int = 20) -> DataFrame:
    """Processing for too long, or without a timestamp, becomes pending again."""
    last = F.col("last_enriched_at")
    stuck = (F.col("status") == "processing") & (last.isNull() | before(last, now, minutes=minutes))
    return df.withColumn("status", F.when(F.coalesce(stuck, F.lit(False)), "pending").otherwise(F.col("status")))
