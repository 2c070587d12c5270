"""Repair of JSON texts written by a language model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_json(text: Column) -> Column:
    """Strict test: exactly one JSON value and nothing behind it.

    Wrapping into an array makes trailing text an error or a second member.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce(
        F.try_variant_get(wrapped, "$[0]", "variant").isNotNull()
        & F.try_variant_get(wrapped, "$[1]", "variant").isNull(),
        F.lit(False),
    )


def strip_fences(raw: Column) -> Column:
    """Remove the first opening and the first closing code fence."""
    t = F.regexp_replace(raw, r"^\s+|\s+$", "")
    t = F.regexp_replace(t, r"(?im)\A((?s:.*?))^```(?:json)?\s*", "$1")
    return F.regexp_replace(t, r"(?m)\A((?s:.*?))\s*```\s*$", "$1")


def outer_object(text: Column) -> Column:
    """From the first opening to the last closing brace, NULL without both."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def drop_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, r",\s*([}\]])", "$1")


def close_open(text: Column) -> Column:
    """Append the missing closing brackets, then the missing braces."""

    def missing(opening: str, closing: str) -> Column:
        return F.greatest(
            F.lit(0),
            F.regexp_count(text, F.lit(opening)) - F.regexp_count(text, F.lit(closing)),
        )

    return F.concat(text, F.repeat(F.lit("]"), missing(r"\[", r"\]")), F.repeat(F.lit("}"), missing(r"\{", r"\}")))


def repair_json(raw: Column) -> Column:
    """Valid JSON text out of a dirty response, NULL when nothing helps."""
    text = strip_fences(raw)
    body = drop_trailing_commas(outer_object(text))
    closed = close_open(body)
    return F.when(is_json(text), text).when(is_json(body), body).when(is_json(closed), closed)


def repair_json_short(raw: Column) -> Column:
    """Variant without comma and bracket repair: fences anywhere are removed."""
    text = F.regexp_replace(F.regexp_replace(raw, r"(?i)```json|```", ""), r"^\s+|\s+$", "")
    body = outer_object(text)
    return F.when(is_json(text), text).when(is_json(body), body)
