"""Top lists, budgeted selection, adaptive stop, sections, chunks, slugs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from campusloom import rules
from campusloom.functions.text import slugify
from campusloom.functions.urls import crawl_score
from campusloom.operators.carry import arrival_number, running
from campusloom.operators.scan import running_sums
from campusloom.session import durable
from campusloom.operators.predicates import is_failed_retry, is_partial_retry, is_unprocessed


def top_per_group(df: DataFrame, by: list[str], order: list, n: int, rank: str = "rank") -> DataFrame:
    """First n rows per group; Spark limits each map task before the shuffle."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col(rank) <= n)


def best_per_key(df: DataFrame, by: list[str], order: list) -> DataFrame:
    return top_per_group(df, by, order, 1, "__rn").drop("__rn")


def latest_run(perf: DataFrame, label: str, date: str) -> DataFrame:
    """Rows of the newest run; a one-row aggregate joined on its label."""
    newest = perf.agg(F.max(F.struct(F.col(date).alias("d"), F.col(label).alias("l"))).alias("m")).select(
        F.col("m.l").alias("__l")
    )
    return perf.join(newest, F.col(label) == F.col("__l"), "left_semi")


def ctr_priorities(perf: DataFrame, label: str, date: str, limit: int | None = 200, entity_type: str | None = None) -> DataFrame:
    """Pages of the newest run with the lowest click rate, most shown first; all of them, in no order, for limit None."""
    rows = latest_run(perf, label, date).filter(F.col("slug").isNotNull())
    if entity_type:
        rows = rows.filter(F.col("entity_type") == entity_type)
    if limit is not None:
        rows = rows.orderBy(F.asc("ctr"), F.desc("impressions"), F.asc("url")).limit(limit)
    return rows.select("entity_type", "slug", "impressions", "ctr", "url")


def select_work(entities: DataFrame, now: Column, budget: int) -> DataFrame:
    """Next records within a budget: unprocessed, then failed, then partial."""
    tier = F.when(is_unprocessed(), 1).when(is_failed_retry(now), 2).when(is_partial_retry(now), 3)
    first = F.when(F.col("tier") == 1, F.when(F.coalesce("featured", F.lit(False)), 0).otherwise(1)).when(
        F.col("tier") == 2, F.coalesce("crawl_attempts", F.lit(-1))
    )
    age = F.when(F.col("tier") == 1, F.col("created_at"))
    return (
        entities.withColumn("tier", tier)
        .filter(F.col("tier").isNotNull())
        .withColumn("__a", first)
        .withColumn("__b", age)
        .orderBy("tier", "__a", "__b", "entity_id")
        .limit(budget)
        .drop("__a", "__b")
    )


def adaptive_pages(pages: DataFrame, site: str, position: str, chars: Column, enough_chars: int = 4000, enough_pages: int = 3) -> DataFrame:
    """Pages in order until enough characters and enough pages are there.

    A page that failed (NULL length) is tried but counts for neither.
    """
    got = pages.withColumns({"__n": F.coalesce(chars.cast("long"), F.lit(0)), "__ok": chars.isNotNull().cast("long")})
    r = running_sums(got, [site], [position], {"__sum": F.col("__n"), "__cnt": F.col("__ok")})
    done = (F.col("__sum") - F.col("__n") >= enough_chars) & (F.col("__cnt") - F.col("__ok") >= enough_pages)
    return r.filter(~done).drop("__n", "__ok", "__sum", "__cnt")


def prioritize_pages(urls: DataFrame, site: str, url: str = "url", n: int = 8) -> DataFrame:
    """Distinct urls per site by the first matching keyword, positive scores only."""
    scored = urls.select(site, url).distinct().withColumn("score", crawl_score(F.col(url)))
    # Unwanted pages rank last, so dropping them afterwards changes no rank.
    return top_per_group(scored, [site], [F.desc("score"), F.asc(url)], n).filter("score > 0")


# --- sections of one text -------------------------------------------------

def section_score(text: Column) -> Column:
    parts = [F.when(text.rlike(f"(?i){p}"), w).otherwise(0) for p, w in rules.SECTION_SCORES]
    return reduce(lambda a, b: a + b, parts)


def _words(text: Column, n: int | None) -> Column:
    split = F.split(F.lower(text), r"\s+")
    return F.array_distinct(split if n is None else F.slice(split, 1, n))


def word_overlap(a: Column, b: Column) -> Column:
    """Shared words over the larger set, for arrays of distinct words."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.size(b), F.lit(1))


def ranked_sections(text: Column, minimum: int = 40) -> Column:
    """Sections of a marked-up text by keyword score, ties in text order."""
    trimmed = F.transform(
        F.split(text, rules.SECTION_MARK),
        lambda s, i: F.struct(F.regexp_replace(s, r"^\s+|\s+$", "").alias("text"), i.alias("pos")),
    )
    kept = F.filter(trimmed, lambda s: F.length(s["text"]) >= minimum)
    return F.array_sort(
        F.transform(
            kept, lambda s: F.struct((-section_score(s["text"])).alias("neg"), s["pos"].alias("pos"), s["text"].alias("text"))
        )
    )


def distinct_sections(sections: Column, words: int | None = None, overlap: float = 0.65, keep: int | None = None) -> Column:
    """Greedy pass: drop a section too similar to one already kept.

    All words of all sections count; ``words`` compares the first ones only and
    ``keep`` stops at so many sections.
    """
    start = F.array().cast("array<struct<text:string,words:array<string>>>")
    # The words of a section are taken once, not at every comparison.
    split = F.transform(
        sections, lambda s: F.struct(s["text"].alias("text"), _words(s["text"], words).alias("words"))
    )

    def step(acc: Column, s: Column) -> Column:
        def close(k: Column) -> Column:
            # The smaller set bounds what is shared, so most pairs need no intersection.
            a, b = F.size(k["words"]), F.size(s["words"])
            return (F.least(a, b) / F.greatest(a, b, F.lit(1)) > overlap) & (word_overlap(k["words"], s["words"]) > overlap)

        similar = F.exists(acc, close)
        full = similar if keep is None else (F.size(acc) >= keep) | similar
        return F.when(full, acc).otherwise(F.concat(acc, F.array(s)))

    return F.transform(F.aggregate(split, start, step), lambda s: s["text"])


def preprocess_content(text: Column, words: int | None = 80, keep: int | None = 8) -> Column:
    """The distinct sections of a text, best first, relabelled and joined; None for all words and all sections."""
    best = distinct_sections(ranked_sections(text), words=words, keep=keep)
    labelled = F.transform(best, lambda t, i: F.concat(F.format_string("[SECTION %d]\n", i + 1), t))
    return F.when(F.length(F.coalesce(text, F.lit(""))) < 50, F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(labelled, "\n\n---\n\n")
    )


PIECE_RULE = "\n\n---\n\n"


def _distinct_pages(pages: DataFrame, entity: str, position: str, text: str, minimum: int) -> DataFrame:
    """Trimmed page texts above the minimum, each once per record, with priority and hash."""
    clean = pages.select(
        F.col(entity), F.col(position).alias("__pos"), F.regexp_replace(text, r"^\s+|\s+$", "").alias("__t")
    ).filter(F.length("__t") > minimum)
    once = best_per_key(clean.withColumn("__h", F.sha2("__t", 256)), [entity, "__h"], ["__pos"])
    return once.withColumn("__prio", F.when(F.col("__t").rlike(rules.PRIORITY_TEXT), 0).otherwise(1))


def content_pieces(pages: DataFrame, entity: str, position: str, text: str, minimum: int = 80) -> DataFrame:
    """(entity, page_no, start, piece): the content of :func:`assemble_content` as ordered pieces.

    ``start`` is the piece's offset in that text (code points, from 0); between two pieces stands PIECE_RULE.
    No list and no text of a whole record is built: numbers and offsets are running sums over blocks of
    equal row counts, so a record may hold any share of the rows. Pages of equal position go by the hash of
    their text, a null position comes first; null and short texts are not part of it.
    """
    once = _distinct_pages(pages, entity, position, text, minimum)
    summed = running_sums(once, [entity], ["__prio", "__pos", "__h"], {"page_no": F.lit(1), "__chars": F.length("__t")})
    n, before = F.col("page_no"), F.col("page_no") - 1
    digits = sum((F.greatest(before - (10**k - 1), F.lit(0)) for k in range(18)), F.lit(0))  # of all page numbers before
    label = len("[PAGE ]\n") + len(PIECE_RULE)
    return summed.select(
        entity, n.cast("long").alias("page_no"),
        (F.col("__chars") - F.length("__t") + before * label + digits).cast("long").alias("start"),
        F.concat(F.lit("[PAGE "), n.cast("string"), F.lit("]\n"), F.col("__t")).alias("piece"),
    )


def assemble_content(pages: DataFrame, entity: str, position: str, text: str, minimum: int = 80, limit: int | None = None) -> DataFrame:
    """One text per record: all distinct page texts, keyword pages first.

    With a limit the text is cut there.  Every kept text takes more than ``minimum``
    characters, so no page beyond the first limit/minimum can then reach the result
    and groups stay bounded.  Without one a record's content has to fit one row;
    :func:`content_pieces` has no such bound.
    """
    once = _distinct_pages(pages, entity, position, text, minimum)
    if limit is None:
        near = once.withColumn("__n", F.row_number().over(W.partitionBy(entity).orderBy("__prio", "__pos")))
    else:
        near = top_per_group(once, [entity], ["__prio", "__pos"], limit // minimum + 1, "__n")
    parts = F.transform("__l", lambda s: F.concat(F.format_string("[PAGE %d]\n", s["__n"]), s["__t"]))
    whole = F.array_join(parts, PIECE_RULE)
    return (
        near.groupBy(entity)
        .agg(F.array_sort(F.collect_list(F.struct("__n", "__t"))).alias("__l"))
        .select(entity, (whole if limit is None else F.left(whole, F.lit(limit))).alias("content"))
    )


def chunks(text: Column, size: int = 16_000, minimum: int = 100, keep: int | None = None) -> Column:
    """Array of (chunk_no, chunk): fixed size, blank ends not counted; all of them, or the first ``keep``."""
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.floor((F.length(text) - 1) / size).cast("int")))
    cut = F.transform(starts, lambda i: F.substring(text, i * size + 1, F.lit(size)))
    kept = F.filter(cut, lambda c: F.length(F.regexp_replace(c, r"^\s+|\s+$", "")) > minimum)
    kept = kept if keep is None else F.slice(kept, 1, keep)
    return F.transform(kept, lambda c, i: F.struct((i + 1).alias("chunk_no"), c.alias("chunk")))


# --- images ---------------------------------------------------------------

def pick_images(candidates: DataFrame, valid: Column) -> DataFrame:
    """First valid candidate per (entity_id, image_type) among the first few."""
    cap = F.when(F.col("image_type") == "logo", rules.LOGO_CANDIDATES).otherwise(rules.PHOTO_CANDIDATES)
    w = W.partitionBy("entity_id", "image_type").orderBy("pos", "url")
    most = max(rules.LOGO_CANDIDATES, rules.PHOTO_CANDIDATES)
    return (
        candidates.withColumn("__rn", F.row_number().over(w))
        .filter(F.col("__rn") <= most)
        .filter((F.col("__rn") <= cap) & valid)
        .groupBy("entity_id", "image_type")
        .agg(F.min_by("url", "__rn").alias("url"))
    )


def last_errors(errors: DataFrame, order: str, tie: str, n: int = 20) -> DataFrame:
    return errors.orderBy(F.desc(order), F.desc(tie)).limit(n)


# --- slugs ----------------------------------------------------------------

def _free_suffix(rows: DataFrame, taken: DataFrame, block: int) -> DataFrame:
    """The (arrival_no)-th free suffix per base, given taken suffix numbers.

    With taken suffixes t0 < t1 < .. the k-th free one (0-based) is k plus the
    number of i with t_i - i <= k; that number is a running count over both
    sorted together.
    """
    types = dict(rows.dtypes)
    gaps = (
        arrival_number(taken, ["base"], ["suffix"], F.floor(F.col("suffix") / block), "i")
        .select(
            "base", (F.col("suffix") - F.col("i") + 1).alias("at"), F.lit(0).alias("kind"),
            F.lit(None).cast(types["id"]).alias("id"), F.lit(None).cast(types["__ord"]).alias("__ord"),
        )
    )
    wanted = rows.select("base", (F.col("arrival_no") - 1).alias("at"), F.lit(1).alias("kind"), "id", "__ord")
    both = running(
        gaps.unionByName(wanted), ["base"], ["at", "kind"], F.floor(F.col("at") / block),
        sums={"skipped": 1 - F.col("kind")},
    )
    return both.filter("kind = 1").select("id", "__ord", "base", (F.col("at") + F.col("skipped")).alias("suffix"))


_CHILD = r"^(.+)-([1-9][0-9]{0,17})$"


def _parent(slug: str) -> Column:
    return F.regexp_extract(slug, _CHILD, 1).alias("base")


def _number(slug: str) -> Column:
    return F.regexp_extract(slug, _CHILD, 2).cast("long").alias("suffix")


def _claims(rows: DataFrame) -> DataFrame:
    """(base, suffix, child, before): new bases that are numbered slugs of another new base.

    ``before`` counts the records of ``base`` that arrive before the first one of ``child``.
    """
    firsts = rows.filter("arrival_no = 1").filter(F.col("base").rlike(_CHILD))
    children = firsts.select(_parent("base"), _number("base"), F.col("base").alias("child"), "__ord", "id", "__b")
    # Most bases are nobody's parent: only those with children are compared by arrival.
    met = durable(children.join(rows.select("base").distinct(), "base", "left_semi"))
    arrivals = rows.join(met.select("base").distinct(), "base", "left_semi").select("base", "__ord", "id", "__b")
    both = met.unionByName(arrivals, allowMissingColumns=True)
    counted = running(both, ["base"], ["__ord", "id"], F.col("__b"), sums={"before": F.col("child").isNull().cast("long")})
    return counted.filter(F.col("child").isNotNull()).select("base", "suffix", "child", "before")


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds ``won``, whether a blocked suffix or a child keeps its number, to rows sorted by base and suffix.

    The record that would take suffix s is the (s - blocked suffixes below s)-th of its base
    (from 0); a child that arrives before that record wins, one that arrives later loses.
    """
    base, blocked = None, 0
    for rows in batches:
        won = []
        for b, s, before in zip(rows["base"], rows["suffix"], rows["before"], strict=True):
            if b != base:
                base, blocked = b, 0
            won.append(bool(before < 0 or s - blocked >= before))
            blocked += won[-1]
        yield rows[["base", "suffix", "child"]].assign(won=won)


def assign_slugs(new: DataFrame, existing: DataFrame, key: str, name: str, order: str, bucket: Column, block: int = 100_000) -> DataFrame:
    """Unique slug per new record in arrival order: base, base-1, base-2, ...

    Existing slugs are skipped.  When the numbered slug of one base is the base
    of another new record, the earlier arrival keeps it.  All such clashes at
    one depth of numbering (x, x-1, x-1-1) are settled in one pass over the
    clashing bases, so the passes depend on that depth alone.
    """
    named = new.select(
        F.col(key).alias("id"), F.col(order).alias("__ord"), slugify(F.col(name)).alias("base"), bucket.alias("__b")
    )
    rows = durable(arrival_number(named, ["base"], ["__ord", "id"], F.col("__b")))
    known = existing.select("slug").filter(F.col("slug").isNotNull()).distinct()
    # A slug blocks suffix 0 of itself and its number of the base before it.
    taken = known.select(F.col("slug").alias("base"), F.lit(0).cast("long").alias("suffix")).unionByName(
        known.filter(F.col("slug").rlike(_CHILD)).select(_parent("slug"), _number("slug"))
    )
    blocked = durable(taken.join(rows.select("base").distinct(), "base", "left_semi"))
    chain = F.regexp_extract("base", r"((?:-[1-9][0-9]{0,17})*)$", 1)
    claims = durable(_claims(rows).withColumn("depth", F.length(chain) - F.length(F.replace(chain, F.lit("-")))))
    for (depth,) in claims.select("depth").distinct().orderBy("depth").collect():  # as many as a slug has numbers
        here = claims.filter(F.col("depth") == depth)
        fixed = blocked.join(here.select("base").distinct(), "base", "left_semi").withColumns({"before": F.lit(-1).cast("long"), "child": F.lit(None).cast("string")})
        open_ = here.drop("depth").join(blocked, ["base", "suffix"], "left_anti")
        ordered = open_.unionByName(fixed).repartition("base").sortWithinPartitions("base", "suffix")
        settled = durable(ordered.mapInPandas(_settle, "base string, suffix long, child string, won boolean"))
        fresh = settled.filter(F.col("child").isNotNull())
        winners = fresh.filter("won").select("base", "suffix")
        losers = fresh.filter("NOT won").select(F.col("child").alias("base"), F.lit(0).cast("long").alias("suffix"))
        blocked = durable(blocked.unionByName(winners).unionByName(losers).distinct())
    slug = F.when(F.col("suffix") == 0, F.col("base")).otherwise(F.concat_ws("-", F.col("base"), F.col("suffix").cast("string")))
    return _free_suffix(rows.drop("__b"), blocked, block).select(F.col("id").alias(key), slug.alias("slug"))
