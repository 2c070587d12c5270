"""Record repair: cleaning, validation, salvage, merging and gap filling."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from campusloom import rules
from campusloom.functions.basics import (
    first_list, first_of_each, first_text, is_blank_trimmed, leading_number, list_size, parse_percent,
    parse_rank, scale_percent, union_lists,
)
from campusloom.functions.jsonfix import repair_json
from campusloom.functions.text import (
    institution_type, is_non_english, lookup, normalize_country, normalize_intake, normalize_level,
    upgraded_description,
)
from campusloom.functions.urls import country_from_url, is_url, scheme

TEXTS = ["description", "city", "country", "total_students", "tuition_fee"]
NUMBERS = ["qs_ranking", "acceptance_rate", "students_placed"]
LISTS = ["intakes", "admission_requirements", "similar_universities", "image_urls"]
PROGRAM = "array<struct<category:string,level:string>>"

# Field -> key in a model response.
RESPONSE_KEYS = {
    "description": "description", "city": "city", "country": "country", "qs_ranking": "qsRanking",
    "acceptance_rate": "acceptanceRate", "total_students": "totalStudents", "tuition_fee": "tuitionFee",
    "students_placed": "studentsPlaced", "intakes": "intakes", "admission_requirements": "admissionRequirements",
    "programs": "programs", "similar_universities": "similarUniversities", "image_urls": "imageUrls",
}


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


# --- cleaning of a raw response -------------------------------------------

def _typed(v: Column, path: str) -> tuple[Column, Column, Column]:
    """Text, number and list reading of a JSON member, NULL for another type."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    text = F.when(kind == "STRING", F.try_variant_get(v, path, "string"))
    number = F.when(kind.rlike("^(?:BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(v, path, "double"))
    return text, number, F.try_variant_get(v, path, "array<variant>")


def _strings(items: Column, longer_than: int) -> Column:
    texts = F.transform(items, lambda x: F.try_variant_get(x, "$", "string"))
    return F.array_distinct(F.filter(texts, lambda t: t.isNotNull() & (F.length(t) > longer_than)))


def clean_response(df: DataFrame, raw: str, limits: dict[str, int] | None = None) -> DataFrame:
    """Typed record columns out of a raw model response (repaired JSON).

    Texts and lists are whole; ``limits`` bounds those of some fields: the characters
    of a text (for ``programs``, of a subject) or the members of a list.
    """
    limits = limits or {}
    base = df.withColumn("__v", F.try_parse_json(repair_json(F.col(raw))))
    v = F.col("__v")
    field = {f: _typed(v, f"$.{k}") for f, k in RESPONSE_KEYS.items()}
    none = F.array().cast("array<string>")

    def first(f: str, t: Column) -> Column:
        return F.left(t, F.lit(limits[f])) if f in limits else t

    def text(f: str, longer_than: int) -> Column:
        t = F.trim(field[f][0])
        return F.when(F.length(t) > longer_than, first(f, t))

    def members(f: str, items: Column) -> Column:
        return F.coalesce(F.slice(items, 1, limits[f]) if f in limits else items, none)

    rank_number = field["qs_ranking"][1]
    rate = F.coalesce(field["acceptance_rate"][1], leading_number(field["acceptance_rate"][0]))
    programs = F.filter(
        F.transform(
            field["programs"][2],
            lambda p: F.struct(
                F.try_variant_get(p, "$.category", "string").alias("category"),
                F.try_variant_get(p, "$.level", "string").alias("level"),
            ),
        ),
        lambda p: p["level"].isin(rules.PROGRAM_LEVELS)
        & ~F.lower(F.trim(p["category"])).isin(rules.NON_SUBJECTS)
        & (F.length(F.trim(p["category"])) >= 3),
    )
    programs = F.array_distinct(
        F.transform(
            programs,
            lambda p: F.struct(first("programs", F.trim(p["category"])).alias("category"), p["level"].alias("level")),
        )
    )
    images = F.filter(_strings(field["image_urls"][2], 0), lambda u: is_url(u) & u.startswith("http"))
    cols = {
        "description": text("description", 30),
        "city": text("city", 1),
        "country": normalize_country(field["country"][0]),
        "qs_ranking": F.coalesce(
            F.when(rank_number.between(1, 1500), rank_number), parse_rank(field["qs_ranking"][0]).cast("double")
        ),
        "acceptance_rate": scale_percent(rate, inclusive=False, low=0.5),
        "total_students": first("total_students", F.trim(field["total_students"][0])),
        "tuition_fee": text("tuition_fee", 3),
        "students_placed": F.when(field["students_placed"][1] >= 0, field["students_placed"][1]),
        "intakes": members("intakes", _strings(field["intakes"][2], 2)),
        "admission_requirements": members("admission_requirements", _strings(field["admission_requirements"][2], 5)),
        "programs": F.coalesce(programs, F.array().cast(PROGRAM)),
        "similar_universities": members("similar_universities", _strings(field["similar_universities"][2], 0)),
        "image_urls": members("image_urls", images),
    }
    return base.select(*df.columns, v.isNotNull().alias("parsed"), *[c.alias(n) for n, c in cols.items()])


# --- list helpers ---------------------------------------------------------

def distinct_ignoring_case(items: Column, minimum: int = 5) -> Column:
    """First of each text, case ignored; short ones go afterwards."""
    full = F.filter(items, lambda x: x.isNotNull() & (x != ""))
    first = first_of_each(full, lambda x: F.trim(F.lower(x)))
    return F.filter(first, lambda x: F.length(x) >= minimum)


def distinct_programs(programs: Column, ignore_case: bool = True) -> Column:
    """First of each (category, level), with or without regard to case."""
    if not ignore_case:
        return F.array_distinct(programs)

    def key(p: Column) -> Column:
        return F.concat(F.lower(p["category"]), F.lit("::"), p["level"])

    return first_of_each(programs, key)


def repair_programs(programs: Column, limit: int | None = 150) -> Column:
    """Known levels only, subjects trimmed, of 2 characters or more and cut at ``limit`` (None: whole), no repeats."""
    def subject(p: Column) -> Column:
        t = F.trim(F.coalesce(p["category"], F.lit("")))
        return t if limit is None else F.left(t, F.lit(limit))

    fixed = F.transform(
        programs,
        lambda p: F.struct(
            subject(p).alias("category"),
            normalize_level(p["level"]).alias("level"),
        ),
    )
    return distinct_programs(F.filter(fixed, lambda p: p["level"].isNotNull() & (F.length(p["category"]) >= 2)))


# --- validation -----------------------------------------------------------

def violations(types: dict[str, str], description: int | None = 5000, subject: int | None = 150) -> Column:
    """Array of "field: problem" texts for the columns of a record; None: any length."""

    def text(f: str, limit: int, trim: bool = False):
        c = F.trim(F.col(f)) if trim else F.col(f)
        return F.length(c) > limit, f"{f}: longer than {limit}"

    def number(f: str, bad: Column):
        if types.get(f) == "string":
            return F.col(f).isNotNull(), f"{f}: not a number"
        return bad, f"{f}: out of range"

    def members(f: str, limit: int):
        return F.exists(F.col(f), lambda x: F.length(F.trim(x)) > limit), f"{f}: member longer than {limit}"

    def subject_size(p: Column) -> Column:
        n = F.length(F.trim(F.coalesce(p["category"], F.lit(""))))
        return n >= 2 if subject is None else n.between(2, subject)

    rank, rate, placed = F.col("qs_ranking"), F.col("acceptance_rate"), F.col("students_placed")
    checks = [
        *([] if description is None else [text("description", description)]),
        text("city", 100, True),
        text("country", 100, True),
        number("qs_ranking", (rank != F.floor(rank.try_cast("double"))) | (rank < 1) | (rank > 1500)),
        number("acceptance_rate", (rate < 0.1) | (rate > 100)),
        text("total_students", 50),
        text("tuition_fee", 200),
        number("students_placed", (placed != F.floor(placed.try_cast("double"))) | (placed < 0)),
        members("intakes", 50),
        members("admission_requirements", 300),
        (
            F.exists("programs", lambda p: ~subject_size(p)),
            "programs: category length",
        ),
        (
            F.exists("programs", lambda p: ~F.coalesce(p["level"].isin(rules.PROGRAM_LEVELS), F.lit(False))),
            "programs: unknown level",
        ),
        members("similar_universities", 200),
        (F.size("similar_universities") > 10, "similar_universities: more than 10"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(msg)) for bad, msg in checks]))


def salvage(df: DataFrame, description: int | None = None, subject: int | None = None) -> DataFrame:
    """Repair rank, rate, lists, levels, image links and description; with bounds, descriptions and subjects are cut there."""
    types = dict(df.dtypes)
    none = F.array().cast("array<string>")
    out = df
    if types["qs_ranking"] == "string":
        out = out.withColumn("qs_ranking", parse_rank(F.col("qs_ranking")))
    if types["acceptance_rate"] == "string":
        out = out.withColumn("acceptance_rate", parse_percent(F.col("acceptance_rate")))
    intakes = F.transform(
        F.filter("intakes", lambda x: x.isNotNull() & (x != "")), lambda x: normalize_intake(x)
    )
    images = F.filter("image_urls", lambda u: F.coalesce(scheme(u).startswith("http"), F.lit(False)))
    text = _trim(F.col("description"))
    text = text if description is None else F.left(text, F.lit(description))
    return out.withColumns(
        {
            "intakes": F.coalesce(F.array_compact(intakes), none),
            "admission_requirements": F.coalesce(distinct_ignoring_case(F.col("admission_requirements")), none),
            "programs": F.coalesce(repair_programs(F.col("programs"), subject), F.array().cast(PROGRAM)),
            "similar_universities": F.coalesce("similar_universities", none),
            "image_urls": F.coalesce(images, none),
            "description": F.when(F.length(text) >= 20, text),
        }
    )


def validate(df: DataFrame, description: int | None = None, subject: int | None = None) -> DataFrame:
    """Check a record, repair and check again: adds success, errors, salvaged.

    Records that pass keep their own values, salvaged ones get the repaired
    ones; a record that fails twice keeps its input and its errors.  With bounds,
    longer descriptions and subjects are errors that the repair cuts.
    """
    fields = [f for f in RESPONSE_KEYS if f in df.columns]
    keys = [c for c in df.columns if c not in fields]
    before = df.withColumn("errors", violations(dict(df.dtypes), description, subject))
    before = before.withColumn("__in", F.struct(*[F.col(f) for f in fields]))
    after = salvage(before, description, subject)
    after = after.withColumn("__left", violations(dict(after.dtypes), description, subject))
    clean = F.size("errors") == 0
    fixed = F.size("__left") == 0
    types = dict(df.dtypes)

    def value(f: str) -> Column:
        raw = F.col(f"__in.{f}")
        if f in ("qs_ranking", "acceptance_rate") and types[f] == "string":
            return F.when(clean | fixed, F.col(f)).alias(f)
        return F.when(clean, raw).when(fixed, F.col(f)).otherwise(raw).alias(f)

    return after.select(
        *keys,
        *[value(f) for f in fields],
        (clean | fixed).alias("success"),
        F.col("errors"),
        (~clean & fixed).alias("salvaged"),
    )


# --- merging --------------------------------------------------------------

def merge_extracted(extracted: DataFrame, external: DataFrame, key: str = "entity_id") -> DataFrame:
    """Extracted values first, external ones where they are missing.

    ``extracted`` may carry ``is_multilingual``: then a description in a
    foreign script gives way to the external one.
    """
    x, e = extracted.alias("x"), external.alias("e")
    has = set(external.columns)

    def ext(f: str, kind: str) -> Column:
        return F.col(f"e.{f}") if f in has else F.lit(None).cast(kind)

    own = F.col("x.description")
    text = first_text(F.when(F.length(own) > 80, own), ext("description", "string"), own)
    if "is_multilingual" in extracted.columns:
        foreign = F.coalesce(F.col("x.is_multilingual"), F.lit(False)) & is_non_english(text)
        text = F.when(foreign, F.nullif(ext("description", "string"), F.lit(""))).otherwise(text)
    cols = {"description": text}
    for f in ("city", "country", "tuition_fee", "total_students"):
        cols[f] = first_text(F.col(f"x.{f}"), ext(f, "string"))
    for f in NUMBERS:
        if f in extracted.columns:
            cols[f] = F.coalesce(F.col(f"x.{f}"), ext(f, "double"))
    for f in ("intakes", "admission_requirements", "similar_universities"):
        cols[f] = union_lists(F.col(f"x.{f}"), ext(f, "array<string>"))
    cols["programs"] = F.coalesce(
        first_list(F.col("x.programs")), ext("programs", PROGRAM), F.array().cast(PROGRAM)
    )
    return x.join(e, F.col(f"x.{key}") == F.col(f"e.{key}"), "left").select(
        F.col(f"x.{key}").alias(key), *[c.alias(n) for n, c in cols.items()]
    )


def merge_by_confidence(sources: DataFrame, key: str, fields: list[str], lists: list[str] | None = None) -> DataFrame:
    """Per attribute the value of the most trusted source that has one.

    List attributes are united in trust order; ``sources`` lists who
    contributed.  Everything is pre-aggregated on distinct members, so the
    number of source rows of one key does not matter.
    """
    conf = F.coalesce(F.col("confidence").cast("double"), F.lit(0.0))
    order = F.struct(conf.alias("c"), F.negative(F.col("src_no")).alias("n"))
    best = sources.groupBy(key).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in fields]
    )
    contributors = (
        sources.groupBy(key, "source").agg(F.max(order).alias("o"))
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct(F.col("o"), F.col("source"))), asc=False).alias("s"))
        .select(
            key,
            F.transform("s", lambda s: F.struct(s["source"].alias("source"), s["o"]["c"].alias("confidence"))).alias("sources"),
        )
    )
    out = best.join(contributors, key)
    for f in lists or []:
        out = out.join(_united(sources, key, f, order), key, "left").withColumn(
            f, F.coalesce(f, F.array().cast(dict(sources.dtypes)[f]))
        )
    return out


def _united(rows: DataFrame, key: str, f: str, order: Column) -> DataFrame:
    """Distinct members of a list column per key, best row and position first."""
    items = (
        rows.select(F.col(key), order.alias("o"), F.posexplode(f).alias("pos", "item"))
        .filter(F.col("item").isNotNull() & (F.col("item").cast("string") != ""))
        .groupBy(key, "item")
        .agg(F.max(F.struct(F.col("o"), F.negative(F.col("pos")).alias("p"))).alias("rank"))
    )
    return items.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "item")), asc=False), lambda s: s["item"]).alias(f)
    )


def merge_partial_results(parts: DataFrame, key: str, order: str, scalars: list[str], lists: list[str] | None = None, description: str | None = "description") -> DataFrame:
    """Longest description over 60 characters, first scalars, united lists."""
    aggs = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in scalars]
    if description:
        n = F.length(description)
        longest = F.struct(n.alias("n"), F.negative(F.col(order)).alias("o"))
        aggs.insert(0, F.max_by(description, F.when(n > 60, longest)).alias(description))
    out = parts.groupBy(key).agg(*aggs)
    for f in lists or []:
        out = out.join(_united(parts, key, f, F.negative(F.col(order))), key, "left").withColumn(
            f, F.coalesce(f, F.array().cast(dict(parts.dtypes)[f]))
        )
    return out


def is_empty(c: Column, kind: str) -> Column:
    """Empty list or blank text, by the type of the column."""
    return list_size(c) == 0 if kind.startswith("array") else is_blank_trimmed(c)


def merge_content(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fill only empty fields from new content; lists what was updated."""
    types = dict(old.dtypes)
    side = new.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    j = old.join(side, F.col(key) == F.col("__k"), "left")
    use = {f: is_empty(F.col(f), types[f]) & F.col("__k").isNotNull() for f in fields}
    rest = [c for c in old.columns if c not in fields]
    return j.select(
        *rest,
        *[F.when(use[f], F.col(f"__{f}")).otherwise(F.col(f)).alias(f) for f in fields],
        F.array_compact(F.array(*[F.when(use[f], F.lit(f)) for f in fields])).alias("updated_fields"),
    )


# --- gap filling ----------------------------------------------------------

def country_rules(spark: SparkSession) -> DataFrame:
    """Fees, intakes and similar institutions by country (about 50 rows)."""
    names = sorted({*rules.TUITION_BY_COUNTRY, *rules.INTAKES_BY_COUNTRY, *rules.SIMILAR_BY_COUNTRY})
    by_column = (rules.TUITION_BY_COUNTRY, rules.INTAKES_BY_COUNTRY, rules.SIMILAR_BY_COUNTRY)
    columns = dict(zip(("country", "tuition", "intakes", "similar"), (names, *([d.get(n) for n in names] for d in by_column))))
    # Arrow data becomes a relation of known size, so that a join with it needs no shuffle.
    return spark.createDataFrame(pa.table(columns))


def _list(items: list[str]) -> Column:
    return F.array(*[F.lit(i) for i in items])


def typical_programs(kind: Column) -> Column:
    """Usual programs of an institution type."""
    out = None
    for t, ps in rules.PROGRAMS_BY_TYPE.items():
        value = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(l).alias("level")) for c, l in ps])
        out = F.when(kind == t, value) if out is None else out.when(kind == t, value)
    return out


def pad_programs(programs: Column, usual: Column, minimum: int = 3, skip_known: bool = True) -> Column:
    """Existing programs plus usual ones up to the minimum."""
    own = F.coalesce(programs, F.array().cast(PROGRAM))
    fresh = F.filter(usual, lambda u: ~F.exists(own, lambda p: p == u)) if skip_known else usual
    return F.concat(own, F.slice(fresh, 1, F.greatest(F.lit(0), minimum - F.size(own))))


def fill_gaps(df: DataFrame, by_country: DataFrame, country: str = "country_name", name: str = "name", live: bool = False) -> DataFrame:
    """Fill missing fields by country and type; never overwrites a value.

    ``live`` is the variant used right after extraction: very short fees and
    counts are missing too, and padding may repeat a known program.
    """
    side = by_country.select(
        F.col("country").alias("__c"), F.col("tuition").alias("__fee"),
        F.col("intakes").alias("__in"), F.col("similar").alias("__sim"),
    )
    j = df.join(side, F.col(country) == F.col("__c"), "left")
    kind = institution_type(F.col(name), technical_university=not live)
    fee, students = (F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "") for c in ("tuition_fee", "total_students"))
    english = F.coalesce(F.col(country).isin(rules.ENGLISH_COUNTRIES), F.lit(False))
    padded = pad_programs(F.col("programs"), typical_programs(kind), skip_known=not live)
    missing = {
        "tuition_fee": (F.length(fee) < 3) if live else (fee == ""),
        "total_students": (F.length(students) < 2) if live else (students == ""),
        "similar_universities": list_size(F.col("similar_universities")) == 0,
        "programs": (list_size(F.col("programs")) < 3) & (F.size(padded) > list_size(F.col("programs"))),
        "intakes": list_size(F.col("intakes")) == 0,
        "admission_requirements": list_size(F.col("admission_requirements")) < 3,
    }
    value = {
        "tuition_fee": F.coalesce("__fee", F.lit(rules.TUITION_DEFAULT)),
        "total_students": lookup(rules.STUDENTS_BY_TYPE, kind),
        "similar_universities": F.coalesce("__sim", _list(rules.SIMILAR_DEFAULT)),
        "programs": padded,
        "intakes": F.coalesce("__in", _list(rules.INTAKES_DEFAULT)),
        "admission_requirements": F.when(english, _list(rules.REQUIREMENTS_ENGLISH)).otherwise(_list(rules.REQUIREMENTS_OTHER)),
    }
    rest = [c for c in df.columns if c not in value]
    # The list of patched fields stands before the new values: a name inside a
    # lambda would otherwise mean the alias defined earlier in the same select.
    patched = F.array_compact(F.array(*[F.when(missing[f], F.lit(f)) for f in value])).alias("patched_fields")
    filled = j.select(
        *rest, patched, *[F.when(missing[f], value[f]).otherwise(F.col(f)).alias(f) for f in value]
    )
    return filled.select(*rest, *value, "patched_fields")


def fill_after_extraction(df: DataFrame, name: str = "name", website: str = "website") -> DataFrame:
    """Lighter fill: country by name or domain, description, requirements, intakes."""
    own = F.when(~is_blank_trimmed(F.col("country")), normalize_country(F.col("country")))
    d = df.withColumn("country", F.coalesce(own, country_from_url(F.col(website))))
    english = F.coalesce(F.col("country").isin(rules.ENGLISH_COUNTRIES), F.lit(False))
    usual = F.create_map(*[x for c, i in rules.EXTRACTION_INTAKES.items() for x in (F.lit(c), _list(i))])
    return d.withColumns(
        {
            "description": upgraded_description(
                F.col("description"), F.col(name), F.col("city"), F.col("country"), F.col("programs")
            ),
            "admission_requirements": F.when(
                list_size(F.col("admission_requirements")) < 2,
                F.when(english, _list(rules.EXTRACTION_REQUIREMENTS_ENGLISH)).otherwise(_list(rules.EXTRACTION_REQUIREMENTS_OTHER)),
            ).otherwise(F.col("admission_requirements")),
            "intakes": F.when(
                list_size(F.col("intakes")) == 0,
                F.coalesce(F.try_element_at(usual, F.col("country")), _list(rules.INTAKES_DEFAULT)),
            ).otherwise(F.col("intakes")),
        }
    )


# --- content checks and reasons -------------------------------------------

def has_text(c: Column) -> Column:
    return ~is_blank_trimmed(c)


def all_filled(items: Column, *parts: str) -> Column:
    """A non-empty list whose every member has text in all named parts."""

    def ok(x: Column) -> Column:
        out = has_text(x[parts[0]])
        for p in parts[1:]:
            out = out & has_text(x[p])
        return out

    return (list_size(items) > 0) & F.coalesce(F.forall(items, ok), F.lit(False))


def country_content_complete() -> Column:
    lists = [list_size(F.col(c)) > 0 for c in ("career_opportunities", "scholarships", "eligibility_requirements")]
    return lists[0] & lists[1] & lists[2] & all_filled(F.col("why_study_cards"), "title", "description")


def course_content_complete() -> Column:
    out = all_filled(F.col("entry_requirements"), "title", "description") & all_filled(F.col("faqs"), "question", "answer")
    for c in ("subtitle", "overview_title", "overview_description", "career_prospects", "salary_expectations"):
        out = out & has_text(F.col(c))
    for c in ("key_highlights", "popular_job_roles"):
        out = out & (list_size(F.col(c)) > 0)
    return out


def failure_reason(issues: Column, hallucinations: Column) -> Column:
    """First three problems that are not about missing values, NULL if none."""
    none = F.array().cast("array<string>")
    real = F.filter(F.coalesce(issues, none), lambda i: ~i.contains("is null") & ~F.lower(i).contains("missing"))
    every = F.concat(real, F.coalesce(hallucinations, none))
    return F.when(F.size(every) > 0, F.array_join(F.slice(every, 1, 3), "; "))


def provenance(urls: Column, sources: Column, limit: int | None = None) -> Column:
    none = F.array().cast("array<string>")
    names = F.transform(sources, lambda s: s["source"])
    every = F.concat(F.coalesce(urls, none), F.coalesce(names, none))
    return every if limit is None else F.slice(every, 1, limit)
