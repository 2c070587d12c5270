"""Column builders for missing values, numbers, labels and dates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def bound(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often fn reads it.

    For long derived values: projections that refer to each other are merged by
    the optimizer, which would otherwise repeat the value at every reference.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


# --- missing values -------------------------------------------------------

def is_blank(c: Column) -> Column:
    """NULL or the empty string."""
    return F.coalesce(c, F.lit("")) == ""


def is_blank_trimmed(c: Column) -> Column:
    """NULL, empty or only white space."""
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def list_size(c: Column) -> Column:
    """Array length, an absent array counting as 0."""
    return F.coalesce(F.size(c), F.lit(0))


def list_shorter_than(c: Column, k: int) -> Column:
    return list_size(c) < k


def is_empty_list(c: Column) -> Column:
    """A present array without members; an absent array is not empty."""
    return F.coalesce(F.size(c) == 0, F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def text_or_null(c: Column) -> Column:
    """The text itself, or NULL when it is blank after trimming."""
    return F.when(~is_blank_trimmed(c), c)


def list_or_null(c: Column) -> Column:
    return F.when(list_size(c) > 0, c)


def first_text(*cols: Column) -> Column:
    """First value that is neither NULL nor blank."""
    return F.coalesce(*[text_or_null(c) for c in cols])


def first_list(*cols: Column) -> Column:
    """First array that is neither NULL nor empty."""
    return F.coalesce(*[list_or_null(c) for c in cols])


def union_lists(*cols: Column) -> Column:
    """Distinct union in first-seen order without NULL or empty members."""
    parts = [F.coalesce(c, F.array().cast("array<string>")) for c in cols]
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: x.isNotNull() & (x != "")))


def first_of_each(items: Column, key) -> Column:
    """First member of each ``key(member)`` in list order; members without a key are dropped.

    Members are sorted by (key, place) and compared with the one before, so a long list costs no
    comparison of all with all, and list and keys are computed once.
    """
    placed = F.transform(items, lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")))

    def firsts(rows: Column) -> Column:
        return F.filter(rows, lambda r, n: (n == 0) | (F.get(rows, n - 1)["k"] != r["k"]))

    kept = bound(F.sort_array(F.filter(placed, lambda r: r["k"].isNotNull())), firsts)
    back = F.sort_array(F.transform(kept, lambda r: F.struct(r["i"].alias("i"), r["x"].alias("x"))))
    return F.transform(back, lambda r: r["x"])


def add_to_set(old: Column, new: Column) -> Column:
    return F.array_union(F.coalesce(old, F.filter(new, lambda _: F.lit(False))), new)


def value_counts(values: Column) -> Column:
    """Map of value -> how often it occurs in an array column."""
    kept = F.filter(values, lambda v: v.isNotNull() & (v != ""))
    return F.map_from_entries(
        F.transform(
            F.array_distinct(kept),
            lambda v: F.struct(v.alias("key"), F.size(F.filter(kept, lambda w: w == v)).cast("long").alias("value")),
        )
    )


# --- numbers --------------------------------------------------------------

def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def safe_ratio(num: Column, den: Column) -> Column:
    return F.when(den != 0, num / den)


def is_whole(c: Column) -> Column:
    return c == F.floor(c)


def percent(n: Column, total: Column) -> Column:
    """Percent with one decimal, 0 for an empty total."""
    return F.when(total > 0, F.round(n * 100.0 / total, 1)).otherwise(F.lit(0.0))


def percent_label(n: Column, total: Column) -> Column:
    return F.when(total > 0, F.format_string("%.1f%%", F.round(n * 100.0 / total, 1))).otherwise(F.lit("0%"))


def bar(n: Column, total: Column, width: int) -> Column:
    filled = F.when(total > 0, F.round(n / total * F.lit(width))).otherwise(F.lit(0.0)).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(width) - filled), F.lit("]"))


def progress_label(n: Column, total: Column, width: int = 24) -> Column:
    share = F.when(total > 0, F.round(n * 100.0 / total, 1)).otherwise(F.lit(0.0))
    return F.concat(bar(n, total, width), F.format_string(" %.1f%%", share))


def _digits(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


def parse_rank(text: Column, low: int = 1, high: int = 1500) -> Column:
    """Digits of a text such as "#47" as a rank, NULL outside the range."""
    n = _digits(text).try_cast("long")
    return F.when(n.between(low, high), n.cast("int"))


def leading_number(text: Column) -> Column:
    """The number a text starts with once all but digits and dots is dropped."""
    kept = F.regexp_replace(text, "[^0-9.]", "")
    return F.nullif(F.regexp_extract(kept, r"^([0-9]+\.?[0-9]*|\.[0-9]+)", 1), F.lit("")).try_cast("double")


def parse_percent(text: Column, fraction_max: float = 1.0, inclusive: bool = True, low: float = 0.1) -> Column:
    """Percentage of a text; a fraction is scaled by 100, out of range is NULL.

    The record repair uses the defaults; record cleaning uses
    ``inclusive=False, low=0.5``.
    """
    return scale_percent(leading_number(text), fraction_max, inclusive, low)


def scale_percent(n: Column, fraction_max: float = 1.0, inclusive: bool = True, low: float = 0.1) -> Column:
    small = (n <= fraction_max) if inclusive else ((n > 0) & (n < fraction_max))
    scaled = F.when(small, n * 100).otherwise(n)
    return F.when((scaled >= low) & (scaled <= 100), scaled)


# --- dates and durations --------------------------------------------------

def run_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def days_before(day: Column, n: int) -> Column:
    return F.date_sub(day, n)


def before(ts: Column, now: Column, hours: float = 0, minutes: float = 0) -> Column:
    """True when ``ts`` lies more than the given time before ``now``."""
    return ts < now - F.make_dt_interval(F.lit(0), F.lit(int(hours)), F.lit(int(minutes)), F.lit(0))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970, the same for zoned and zone-less timestamps."""
    return F.expr("0L") + F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def duration_label(ms: Column) -> Column:
    """Milliseconds as "1h 2m 3s"; the hour part only when it is not 0."""
    s = F.floor(ms / 1000)
    h, m, sec = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    tail = F.format_string("%dm %ds", m, sec)
    return F.when(h > 0, F.concat(F.format_string("%dh ", h), tail)).otherwise(tail)
