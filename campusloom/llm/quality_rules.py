"""Quality rules with thresholds that adapt to each language and source.

Every document gets fixed base rules and four measures in thousandths. A mergeable sketch of
each measure holds counts by bucket: values below 64 are their own bucket, larger ones keep six
significant bits (an error below 1/32). Sketches merge by adding counts, so they are one
aggregation with partial sums, give the same thresholds in any order, and those of a language or
of everything come from adding up those of its sources. A measure is out of bounds beyond
q75 + max(3 * (q75 - q25), least margin) and, where it has a lower side, below the mirrored bound.
Groups below `least_docs` take the bounds of their language, or else of all documents. Bounds then
meet the documents in a join.

Null texts have no words and fail the base rules. Null languages and sources are groups of
their own. Repeated rows count as often as they occur; extra columns stay. No rows give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basics import bound
from .shared import cut

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Least margin by measure in thousandths, and whether small values are out of bounds too.
MEASURES: dict[str, tuple[int, bool]] = {"symbols": (60, False), "marks": (60, False), "repeats": (400, False), "word_length": (2500, True)}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def repeated_words(words: Column, size: int = 3) -> Column:
    """Words covered by windows of `size` words that occur more than once in the list; linear but for a sort."""

    def covered(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            same = lambda i, j: F.get(s, i)["h"] == F.get(s, j)["h"]
            twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
            return F.sort_array(F.transform(twice, lambda i: F.get(s, i)["i"]))

        def total(p: Column) -> Column:
            return F.aggregate(p, F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")), lambda acc, x: F.struct((acc["n"] + F.least(F.lit(size), x - acc["last"])).alias("n"), x.alias("last")), lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bound(bound(ordered, places), total))

    hashed = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))
    return F.when(F.size(words) < size, F.lit(0)).otherwise(bound(hashed(words), covered))


def base_measures(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_marks of the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    measured = bound(words_of(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r")))
    out = docs.withColumns({"_m": measured, "word_chars": F.length(F.translate(text, SPACE, "")), "n_symbols": without(SYMBOLS), "n_marks": without("!?"), "n_dup_lines": bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))})
    out = out.withColumns({"n_words": F.col("_m.n"), "n_repeat_words": F.col("_m.r")}).drop("_m")
    return out.withColumns({c: F.col(c).cast("long") for c in (*BASE, "n_marks")})


def measure_values() -> dict[str, Column]:
    share = lambda a, b: F.when(F.col(b) > 0, F.expr(f"(1000 * {a}) div {b}")).otherwise(F.lit(0)).cast("long")
    return {"symbols": share("n_symbols", "word_chars"), "marks": share("n_marks", "word_chars"), "repeats": share("n_repeat_words", "n_words"), "word_length": share("word_chars", "n_words")}


def bucket(value: Column) -> Column:
    """The sketch's bucket of a value from 0: its six leading bits."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(value - value % F.pow(F.lit(2.0), shift).cast("long"))


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: counts with partial sums before the shuffle."""
    rows = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(f"_{m}")).alias("bucket")) for m in MEASURES))).alias("r")
    return measured.select("lang", "source", rows).groupBy("lang", "source", "r.measure", "r.bucket").agg(F.count(F.lit(1)).alias("n"))


def bounds_of(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Merged sketches of each group of `by`: docs, low and high by measure."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    ranked = merged.withColumns({"docs": F.sum("n").over(group), "upto": F.sum("n").over(group.orderBy("bucket"))})
    q = lambda quarters: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * quarters, F.col("bucket")))
    found = ranked.groupBy(*by, "measure").agg(F.max("docs").alias("docs"), q(1).alias("q25"), q(3).alias("q75"))
    margin = F.greatest(3 * (F.col("q75") - F.col("q25")), reduce(lambda rest, m: F.when(F.col("measure") == m, F.lit(MEASURES[m][0])).otherwise(rest), MEASURES, F.lit(0)))
    two_sided = F.col("measure").isin(*(m for m, (_, both) in MEASURES.items() if both))
    return found.select(*by, "measure", "docs", F.when(two_sided, F.col("q25") - margin).otherwise(F.lit(-1)).alias("low"), (F.col("q75") + margin).alias("high"))


def thresholds(sketch: DataFrame, least_docs: int = 100) -> DataFrame:
    """One row per language and source: low_<measure>, high_<measure>, from the narrowest group with enough documents."""
    own = bounds_of(sketch, ["lang", "source"])
    lang = bounds_of(sketch, ["lang"]).select(F.col("lang").alias("_lang"), F.col("measure").alias("_m1"), F.col("docs").alias("_d1"), F.col("low").alias("_l1"), F.col("high").alias("_h1"))
    every = bounds_of(sketch, []).select(F.col("measure").alias("_m2"), F.col("low").alias("_l2"), F.col("high").alias("_h2"))
    joined = own.join(lang, own["lang"].eqNullSafe(lang["_lang"]) & (own["measure"] == lang["_m1"])).join(every, own["measure"] == every["_m2"])
    pick = lambda a, b, c: F.when(F.col("docs") >= least_docs, F.col(a)).when(F.col("_d1") >= least_docs, F.col(b)).otherwise(F.col(c))
    rows = joined.select("lang", "source", "measure", pick("low", "_l1", "_l2").alias("low"), pick("high", "_h1", "_h2").alias("high"))
    return rows.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(*(F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{side}_{m}") for m in MEASURES for side in ("low", "high")))


def apply_rules(docs: DataFrame, least_words: int = 50, most_repeats: int = 50, least_docs: int = 100) -> DataFrame:
    """docs (without text) with the base counts, base_failed and kept. Measured once, into a table.

    Null texts have no words and fail. Null languages and sources are groups like others. Extra columns stay,
    whatever their names; those named like a column of the result are replaced by it.
    """
    kept_columns = [c for c in docs.columns if c.lower() not in {"text", *BASE, "n_marks", "base_failed", "kept"}]
    row = F.struct(*(F.col(f"`{c}`") for c in kept_columns)).alias("_row")
    measured = base_measures(docs.select(row, "lang", "source", "text")).drop("text")
    measured = cut(measured.withColumns({f"_{m}": v for m, v in measure_values().items()}), "quality")
    limits = thresholds(sketches(measured), least_docs)
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"]))
    within = reduce(lambda a, b: a & b, (F.col(f"_{m}").between(F.col(f"low_{m}"), F.col(f"high_{m}")) for m in MEASURES))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return joined.select(*(F.col("_row")[c].alias(c) for c in kept_columns), *BASE, failed.alias("base_failed"), (~failed & within).alias("kept"))
