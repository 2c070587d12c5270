"""Text columns: slugs, name and level normalising, language, word counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from campusloom import rules
from campusloom.functions.basics import text_or_null


def lookup(mapping: dict, key: Column) -> Column:
    """Value of a fixed table held in the code, NULL when the key is unknown."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def contains_any(text: Column, words: list[str]) -> Column:
    """Substring test for a list of literal words, one pass over the text."""
    escaped = "|".join("".join("\\" + ch if not ch.isalnum() and ch not in " _" else ch for ch in w) for w in words)
    return text.rlike(f"(?:{escaped})")


def slugify(c: Column) -> Column:
    """Lower-case ASCII slug with single hyphens."""
    plain = F.translate(F.lower(c), rules.ACCENTED, rules.UNACCENTED)
    for mark, word in rules.SLUG_WORDS.items():
        plain = F.replace(plain, F.lit(mark), F.lit(word))
    kept = F.regexp_replace(plain, r"[^a-z0-9\s-]", "")
    return F.regexp_replace(F.regexp_replace(F.trim(kept), r"[\s-]+", "-"), r"^-+|-+$", "")


def normalize_name(c: Column) -> Column:
    """Institution name for matching: no parentheticals, no punctuation."""
    t = F.regexp_replace(F.lower(c), r"\s*\([^)]*\)", "")
    t = F.regexp_replace(t, rules.NAME_PUNCTUATION, " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def normalize_category(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))


def normalize_country(c: Column) -> Column:
    return F.when(c == "", c).otherwise(
        F.coalesce(lookup(rules.COUNTRY_ALIASES, F.lower(F.trim(c))), F.trim(c))
    )


def institution_type(name: Column, technical_university: bool = True) -> Column:
    """Five classes from the name; the live variant has no "technical university"."""
    n = F.lower(F.coalesce(name, F.lit("")))
    technical = ["institute of technology", "polytechnic"] + (["technical university"] if technical_university else [])
    return (
        F.when(contains_any(n, ["community college", "technical college"]), "community")
        .when(contains_any(n, technical), "technical")
        .when(n.contains("college") & ~n.contains("university"), "college")
        .when(contains_any(n, ["school of", "academy"]), "specialized")
        .otherwise("university")
    )


def institution_phrase(name: Column) -> Column:
    """Seven wordings used in a synthesised description."""
    n = F.lower(name)
    return (
        F.when(contains_any(n, ["community college", "technical college"]), "community college")
        .when(contains_any(n, ["institute of technology", "polytechnic"]), "technical institute")
        .when(n.contains("college") & ~n.contains("university"), "college")
        .when(n.contains("academy"), "academy")
        .when(n.contains("school of"), "specialized school")
        .when(n.contains("seminary"), "seminary")
        .otherwise("university")
    )


def normalize_intake(c: Column) -> Column:
    """Spell out abbreviated months; NULL for texts of two characters or fewer."""
    out = F.trim(c)
    for short, full in rules.MONTHS.items():
        # Only the first occurrence of each month changes.
        out = F.regexp_replace(out, rf"(?i)\A((?s:.*?))\b{short}\.?\b", f"$1{full}")
    return F.when(F.length(out) > 2, out)


def normalize_level(c: Column) -> Column:
    l = F.trim(F.lower(c))
    return (
        F.when(contains_any(l, ["under", "bachelor", "ug", "btech", "bsc", "ba "]) | (l == "ba"), "Undergraduate")
        .when(contains_any(l, ["post", "master", "pg", "msc", "mba", "mtech", "ma "]) | (l == "ma"), "Postgraduate")
        .when(contains_any(l, ["phd", "doctoral", "doctorate", "d.phil"]), "PhD")
        .when(l.contains("diploma"), "Diploma")
        .when(l.contains("cert"), "Certificate")
    )


def course_level(level: Column) -> Column:
    """Program level in the vocabulary of the course catalog."""
    return lookup(rules.COURSE_LEVELS, level)


def name_variants(name: Column) -> Column:
    plain = F.trim(F.regexp_replace(name, r"\s*\([^)]+\)", ""))
    short = F.trim(F.regexp_replace(name, r"(?i),?\s+(College|University|Institute|School|Academy)$", ""))
    return F.array_distinct(
        F.array_compact(
            F.array(name, F.when(plain != name, plain), F.when((short != name) & (F.length(short) > 4), short))
        )
    )


def name_agrees(name: Column, candidate: Column) -> Column:
    """The first two words of a name all occur in the candidate name."""
    words = F.slice(F.split(F.lower(name), r"\s+"), 1, 2)
    other = F.lower(F.coalesce(candidate, F.lit("")))
    return F.forall(words, lambda w: other.contains(w))


def word_count(text: Column) -> Column:
    return F.size(F.split(F.trim(text), r"\s+"))


def script_language(sample: Column) -> Column:
    """zh / ar / ru by the first script found in the sample, else NULL."""
    return (
        F.when(sample.rlike(rules.SCRIPT_HAN), "zh")
        .when(sample.rlike(rules.SCRIPT_ARABIC), "ar")
        .when(sample.rlike(rules.SCRIPT_CYRILLIC), "ru")
    )


def is_non_english(text: Column) -> Column:
    """Foreign script anywhere in a text of 100 characters or more."""
    return F.coalesce((F.length(text) >= 100) & script_language(text).isNotNull(), F.lit(False))


def page_language(lang_attr: Column, body_text: Column) -> Column:
    declared = F.coalesce(lang_attr, F.lit(""))
    return F.when(
        (declared != "") & ~declared.startswith("en"), F.split_part(declared, F.lit("-"), F.lit(1))
    ).otherwise(script_language(body_text))


def boilerplate_line(line: Column) -> Column:
    t = F.regexp_replace(line, r"^\s+|\s+$", "")
    starts = "|".join([*rules.BOILERPLATE_STARTS, *rules.BOILERPLATE_SITES])
    return (F.length(t) < 3) | t.rlike(f"(?i)^(?:{starts})") | t.rlike(rules.SEPARATOR_LINE)


def drop_boilerplate(text: Column, max_chars: int | None = None) -> Column:
    """Keep content lines, collapse white space, optional length limit."""
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda l: ~boilerplate_line(l)), "\n")
    flat = F.regexp_replace(F.regexp_replace(F.replace(kept, F.lit("\t"), F.lit(" ")), r" {3,}", " "), r"\n{4,}", "\n\n\n")
    out = F.regexp_replace(flat, r"^\s+|\s+$", "")
    return out if max_chars is None else F.left(out, F.lit(max_chars))


def is_thin(text: Column, minimum: int = 400) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) < minimum


def minimal_description(name: Column, city: Column, country: Column, programs: Column) -> Column:
    """Short description from name, place, program subjects and levels."""
    city_, country_ = text_or_null(city), text_or_null(country)
    place = F.when(
        city_.isNotNull() & country_.isNotNull(), F.format_string("located in %s, %s", city_, country_)
    ).when(country_.isNotNull(), F.format_string("located in %s", country_))
    n = F.coalesce(F.size(programs), F.lit(0))
    subjects = F.array_join(F.array_distinct(F.transform(F.slice(programs, 1, 3), lambda p: p["category"])), ", ")
    levels = F.array_join(
        F.slice(F.array_distinct(F.transform(programs, lambda p: F.lower(p["level"]))), 1, 2), " and "
    )
    head = F.concat_ws(
        ", ",
        F.concat(name, F.lit(" is a "), institution_phrase(name)),
        place,
        F.when(n >= 2, F.concat(F.lit("offering programs in "), subjects)),
        F.when(n >= 1, F.concat(F.lit("at the "), levels, F.lit(" level"))),
    )
    return F.concat(head, F.lit(". It is committed to academic excellence and student success."))


def upgraded_description(description: Column, name: Column, city: Column, country: Column, programs: Column) -> Column:
    """The description when it is long enough and names the record, else a minimal one."""
    d = F.trim(F.coalesce(description, F.lit("")))
    opening = F.array_join(F.slice(F.split(F.lower(name), r"\s+"), 1, 2), " ")
    good = (F.length(d) >= 80) & F.lower(d).contains(opening)
    return F.when(good, F.left(d, F.lit(800))).otherwise(minimal_description(name, city, country, programs))
