"""Name reconciliation, country resolution, text matching of programs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from campusloom import rules
from campusloom.functions.text import course_level, normalize_name
from campusloom.operators.blocks import looked_up
from campusloom.operators.scan import running_sums
from campusloom.session import durable


# --- names ----------------------------------------------------------------

def first_per_key(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """First row per key; the window limit keeps one row per map task."""
    return (
        df.withColumn("__rn", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("__rn = 1").drop("__rn")
    )


def match_ranking(names: DataFrame, ranking: DataFrame, aliases: DataFrame, name: str = "name") -> DataFrame:
    """Match names to a ranking list: normalised name, alias, normalised alias.

    ``ranking`` has line_no, institution_name, rank; ``aliases`` has db_name,
    target.  Adds matched_name, matched_rank and confidence (exact / alias).
    """
    rows = ranking.filter(
        (F.trim(F.coalesce("institution_name", F.lit(""))) != "") & (F.trim(F.coalesce("rank", F.lit(""))) != "")
    ).select(
        "line_no",
        F.trim("institution_name").alias("original"),
        F.trim("rank").alias("r"),
        normalize_name(F.trim("institution_name")).alias("norm"),
    )
    by_norm = first_per_key(rows, ["norm"], ["line_no"])
    by_name = first_per_key(rows, ["original"], ["line_no"])
    first_alias = aliases.groupBy("db_name").agg(F.min("target").alias("target"))

    base = names.withColumn("__name", F.trim(F.coalesce(name, F.lit("")))).withColumn(
        "__norm", normalize_name(F.col("__name"))
    )

    def side(df: DataFrame, key: str, tag: str) -> DataFrame:
        return df.select(F.col(key).alias(f"__{tag}"), F.col("original").alias(f"__{tag}_o"), F.col("r").alias(f"__{tag}_r"))

    # Targets are resolved on the small alias table, not on the records.
    resolved = (
        first_alias.withColumn("__tn", normalize_name(F.col("target")))
        .join(side(by_name, "original", "a"), F.col("target") == F.col("__a"), "left")
        .join(side(by_norm, "norm", "b"), F.col("__tn") == F.col("__b"), "left")
        .select(
            F.col("db_name").alias("__db"),
            F.coalesce("__a_o", "__b_o").alias("__al_o"),
            F.coalesce("__a_r", "__b_r").alias("__al_r"),
        )
    )
    out = base.join(side(by_norm, "norm", "e"), F.col("__norm") == F.col("__e"), "left").join(
        resolved, F.col("__name") == F.col("__db"), "left"
    )
    exact = F.col("__e").isNotNull()
    return out.select(
        *[F.col(c) for c in names.columns],
        F.when(exact, F.col("__e_o")).otherwise(F.col("__al_o")).alias("matched_name"),
        F.when(exact, F.col("__e_r")).otherwise(F.col("__al_r")).alias("matched_rank"),
        F.when(exact, "exact").when(F.col("__al_r").isNotNull(), "alias").alias("confidence"),
    )


def ranking_outcome(current: Column, matched_rank: Column) -> Column:
    cur = F.coalesce(current.cast("string"), F.lit(""))
    return (
        F.when(matched_rank.isNull() & (cur == ""), "already_null")
        .when(matched_rank.isNull(), "fake_rank")
        .when(cur == matched_rank, "already_correct")
        .otherwise("updated")
    )


def reconcile_ranking(entities: DataFrame, ranking: DataFrame, aliases: DataFrame, rank: str = "qs_ranking") -> DataFrame:
    """Old and new rank per record with the outcome."""
    m = match_ranking(entities, ranking, aliases)
    return m.withColumn("outcome", ranking_outcome(F.col(rank), F.col("matched_rank"))).withColumn(
        "new_rank", F.col("matched_rank")
    )


# --- countries ------------------------------------------------------------

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of one size; none of a shorter text."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(places, lambda s: F.substring(text, s, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def smallest_containing(words: DataFrame, dim: DataFrame, word: str, key: str, text: str) -> DataFrame:
    """(word, key): for each distinct word the smallest key of a dimension text that holds it, case ignored.

    A text of n characters gives at most 3 * n index rows. Words of up to three characters are index
    entries themselves. A longer word meets only the texts that hold its rarest three characters (ties: the
    first in order), and each is then checked. Words without a text, null and empty words give no row.
    """
    lower = dim.select(F.col(key).alias("__k"), F.lower(text).alias("__t")).filter(F.length("__t") > 0)
    asked = words.select(F.col(word).alias("__w")).filter("__w <> ''").distinct()
    sizes = F.concat(*(_grams(F.col("__t"), n) for n in range(1, GRAM + 1)))
    index = lower.select("__k", F.explode(sizes).alias("__g"))
    entries = index.groupBy("__g").agg(F.min("__k").alias("__least"), F.count(F.lit(1)).alias("__n"))
    short = asked.filter(F.length("__w") <= GRAM).join(entries, F.col("__w") == F.col("__g")).select("__w", F.col("__least").alias("__k"))

    # A word one of whose parts is in no text has no match; the others go on with the part of fewest texts.
    parts = asked.filter(F.length("__w") > GRAM).select("__w", F.explode(_grams(F.col("__w"), GRAM)).alias("__g"))
    rarest = (
        parts.join(entries, "__g", "left").groupBy("__w")
        .agg(F.min(F.struct("__n", "__g")).alias("__r"), F.count_if(F.col("__n").isNull()).alias("__gone"))
        .filter("__gone = 0").select("__w", F.col("__r.__g").alias("__g"))
    )
    texts = lower.select("__k", "__t").distinct()
    long = (
        rarest.join(index, "__g").join(texts, "__k").filter(F.contains("__t", "__w"))
        .groupBy("__w").agg(F.min("__k").alias("__k"))
    )
    return short.unionByName(long).select(F.col("__w").alias(word), F.col("__k").alias(key))


def resolve_country(records: DataFrame, countries: DataFrame, text: str = "country", key: str = "country_id") -> DataFrame:
    """New country key: equal name, else a name containing the first word, else the old key."""
    wanted = (
        records.select(F.lower(F.trim(text)).alias("__c"))
        .filter("__c <> ''")
        .distinct()
        .withColumn("__w", F.split_part("__c", F.lit(" "), F.lit(1)))
    )
    equal = countries.groupBy(F.lower("name").alias("__n")).agg(F.min("country_id").alias("__eq"))
    part = smallest_containing(wanted, countries, "__w", "country_id", "name").select(F.col("__w").alias("__piece"), F.col("country_id").alias("__part"))
    resolved = (
        wanted.join(equal, F.col("__c") == F.col("__n"), "left")
        .join(part, F.col("__w") == F.col("__piece"), "left")
        .select(
            F.col("__c").alias("__ck"),
            F.coalesce("__eq", "__part").alias("__id"),
            F.when(F.col("__eq").isNotNull(), "equal").when(F.col("__part").isNotNull(), "contains").alias("__how"),
        )
    )
    return (
        records.join(resolved, F.lower(F.trim(text)) == F.col("__ck"), "left")
        .withColumn("resolved_country_id", F.coalesce("__id", F.col(key)))
        .withColumn("resolved_by", F.coalesce("__how", F.lit("kept")))
        .drop("__ck", "__id", "__how")
    )


# --- token search ---------------------------------------------------------

def tokens(c: Column) -> Column:
    """Distinct lower-case words without stop words."""
    return F.array_distinct(
        F.filter(
            F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"),
            lambda t: (t != "") & ~t.isin(rules.STOP_WORDS),
        )
    )


def token_index(docs: DataFrame, key: str, weights: dict[str, float]) -> DataFrame:
    """(token, key, weight): the summed weight of the fields holding a token."""
    def postings_of(field: str, weight: float) -> Column:
        return F.transform(
            tokens(F.col(field)), lambda t: F.struct(t.alias("token"), F.lit(float(weight)).alias("weight"))
        )

    postings = F.flatten(F.array(*[postings_of(f, w) for f, w in weights.items()]))
    return (
        docs.select(F.col(key), F.explode(postings).alias("p"))
        .groupBy(F.col("p.token").alias("token"), F.col(key))
        .agg(F.sum("p.weight").alias("weight"))
    )


def _top(scored: DataFrame, by: list[str], key: str, k: int) -> DataFrame:
    w = W.partitionBy(*by).orderBy(F.desc("score"), F.asc(key))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


#: Postings of a token in its first block, and how much larger each next block is.
FIRST_BLOCK, GROWTH = 128, 8


def _in_blocks(index: DataFrame, key: str, first_block: int) -> DataFrame:
    """(token, key, weight, less, block): postings of a token by falling weight, then key, in blocks that grow by GROWTH."""
    ranked = running_sums(index.withColumn("less", -F.col("weight")), ["token"], ["less", key], {"__rank": F.lit(1).cast("long")})
    place = F.ceil(F.log(F.col("__rank") / first_block) / F.log(F.lit(float(GROWTH))))
    return ranked.withColumn("block", F.when(F.col("__rank") <= first_block, 0).otherwise(F.greatest(place, F.lit(1))).cast("int")).drop("__rank")


def _next_blocks(at: DataFrame, heads: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """at (set_id, token, df, block) with ``go``: whether the token's next block can still change the set's top k.

    A document in none of a set's joined blocks scores at most the sum of the largest weights of the next
    blocks; at that sum exactly, its key is not below the first key of any of them.  Where that cannot
    pass the k-th score, the set is done.  Else the tokens in most documents that together stay below
    the k-th score need no further block: a document without another token of the set cannot enter.
    """
    bar = best.filter(F.col("rank") == k).select("set_id", F.col("score").alias("theta"), F.col("key").alias("kappa"))
    bounds = looked_up(at, ["token", "block"], heads, "set_id").join(bar, "set_id", "left")
    own = W.partitionBy("set_id")
    hottest = own.orderBy(F.desc("df"), "token").rowsBetween(W.unboundedPreceding, W.currentRow)
    weight = F.coalesce("most", F.lit(0.0))
    bounds = bounds.withColumns({"sum": F.sum(weight).over(own), "low": F.max("first").over(own), "upto": F.sum(weight).over(hottest)})
    full = F.col("theta").isNotNull()
    done = full & ((F.col("sum") < F.col("theta")) | ((F.col("sum") == F.col("theta")) & (F.col("low") > F.col("kappa"))))
    go = F.col("most").isNotNull() & ~done & ~(full & (F.col("upto") < F.col("theta")))
    return bounds.select("set_id", "token", "df", "block", F.coalesce(go, F.lit(False)).alias("go"))


def search(queries: DataFrame, text: str, index: DataFrame, key: str, k: int = 5, first_block: int = FIRST_BLOCK) -> DataFrame:
    """Top k documents per distinct query text: (text, key, score, rank).

    The score is the sum of the weights of the matching tokens, ties go to the smaller key.  Queries are
    reduced to the distinct sets of tokens the index knows, and the index to the tokens they ask for.
    Each token's postings lie in blocks by falling weight; round by round, sets meet only blocks that can
    still change their top k (see :func:`_next_blocks`).  The result is exact.
    """
    asked = queries.select(F.col(text)).distinct().select(F.col(text), F.explode(tokens(F.col(text))).alias("token"))
    asked = durable(asked)
    pruned = looked_up(index, ["token"], asked.select("token").distinct(), key, "inner")
    postings = durable(_in_blocks(pruned, key, first_block).withColumnRenamed(key, "key"))
    heads = postings.groupBy("token", "block").agg(
        F.max("weight").alias("most"), F.min(F.struct("less", "key")).alias("f"), F.count(F.lit(1)).alias("n")
    )
    heads = durable(heads.select("token", "block", "most", F.col("f.key").alias("first"), "n"))
    documents = durable(postings.groupBy("key").agg(F.collect_list(F.struct("token", "weight")).alias("p")))
    frequency = heads.groupBy("token").agg(F.sum("n").alias("df"))
    known = looked_up(asked, ["token"], frequency, text, "inner").groupBy(text).agg(F.array_sort(F.collect_list("token")).alias("set"))
    known = durable(known.withColumn("set_id", F.array_join("set", " ")))
    sets = known.select("set_id", "set").distinct().select("set_id", F.explode("set").alias("token"))
    at = looked_up(sets, ["token"], frequency, "set_id").select("set_id", "token", "df", F.lit(0).alias("block"), F.lit(True).alias("go"))
    best, at = None, durable(at)
    while best is None or not at.filter("go").isEmpty():
        met = looked_up(at.filter("go"), ["token", "block"], postings.select("token", "block", "key"), "set_id", "inner").select("set_id", "key").distinct()
        full = looked_up(met, ["key"], documents, "set_id", "inner")
        own = F.split("set_id", " ")
        score = F.aggregate(F.filter("p", lambda p: F.array_contains(own, p["token"])), F.lit(0.0), lambda s, p: s + p["weight"])
        scored = full.select("set_id", "key", score.alias("score"))
        if best is not None:
            scored = scored.unionByName(best.drop("rank")).distinct()
        best = durable(_top(scored, ["set_id"], "key", k))
        moved = at.select("set_id", "token", "df", (F.col("block") + F.col("go").cast("int")).alias("block"))
        at = durable(_next_blocks(moved, heads, best, k))
    return known.select(text, "set_id").join(best.withColumnRenamed("key", key), "set_id").select(text, key, "score", "rank")


def match_programs(programs: DataFrame, courses: DataFrame, weights: dict[str, float] | None = None, k: int = 5, floor: float = rules.MATCH_FLOOR, first_block: int = FIRST_BLOCK) -> DataFrame:
    """Best course per distinct (category, level): adds course_id, NULL without a match.

    Among the k most relevant courses a course of the program's level is
    preferred; otherwise the best one is taken if it reaches the floor.
    """
    wanted = durable(programs.select("category", "level").distinct().withColumn("__q", F.trim("category")))
    index = token_index(courses, "course_id", weights or {c: w for c, w in rules.COURSE_WEIGHTS.items() if c in courses.columns})
    found = search(wanted.filter("__q <> ''"), "__q", index, "course_id", k, first_block)
    levels = courses.select("course_id", F.col("level").alias("course_level"))
    listed = (
        found.join(levels, "course_id")
        .groupBy("__q")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "course_id", "score", "course_level"))).alias("hits"))
    )
    strong = F.filter("hits", lambda h: h["score"] >= floor)
    pool = F.when(F.size(strong) > 0, strong).otherwise(F.col("hits"))
    mapped = course_level(F.col("level"))
    same_level = F.filter(pool, lambda h: h["course_level"] == mapped)
    pick = F.coalesce(F.get(same_level, F.lit(0)), F.get(strong, F.lit(0)))
    return durable(
        wanted.join(listed, "__q", "left").select(
            "category", "level", pick["course_id"].alias("course_id"), pick["score"].alias("score")
        )
    )


def match_one_course(programs: DataFrame, title: str) -> DataFrame:
    """Programs relevant to a single course: a title word of over 3 letters occurs."""
    long_words = [w for w in title.lower().split() if len(w) > 3]
    words = F.split(F.trim(F.lower("category")), r"\s+")
    hit = F.arrays_overlap(words, F.array(*map(F.lit, long_words)).cast("array<string>")) if long_words else F.lit(False)
    return programs.filter((F.trim(F.coalesce("category", F.lit(""))) != "") & hit)


def link_programs(programs: DataFrame, matches: DataFrame) -> DataFrame:
    """Attach the course (or NULL) to every program of every record."""
    m = matches.select(F.col("category").alias("__c"), F.col("level").alias("__l"), "course_id")
    on = F.col("category").eqNullSafe(F.col("__c")) & F.col("level").eqNullSafe(F.col("__l"))
    return programs.join(m, on, "left").drop("__c", "__l")


def matched_courses(linked: DataFrame) -> DataFrame:
    """Distinct (entity_id, course_id) links."""
    return linked.filter(F.col("course_id").isNotNull()).select("entity_id", "course_id").distinct()


def unmatched_programs(linked: DataFrame) -> DataFrame:
    return linked.filter(F.col("course_id").isNull()).drop("course_id")


def combo_slugs(pairs: DataFrame) -> DataFrame:
    """Landing-page slugs of distinct (course_slug, country_slug) pairs."""
    return (
        pairs.select("course_slug", "country_slug")
        .distinct()
        .withColumn("combo_slug", F.format_string("study-%s-in-%s", "course_slug", "country_slug"))
    )
