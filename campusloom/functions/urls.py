"""Url columns: parts, normal forms, classification, scores, resolution.

Parts are read with patterns rather than ``try_parse_url`` because crawled urls
hold blanks and other characters which java.net.URI rejects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from campusloom import rules
from campusloom.functions.text import contains_any, lookup

_HEAD = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]+"


# Each part is one chain over a single reading of the url, so that nested uses
# stay small expressions.

def is_url(url: Column) -> Column:
    return F.coalesce(F.trim(url).rlike(_HEAD), F.lit(False))


def scheme(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.trim(url), r"^([A-Za-z][A-Za-z0-9+.\-]*)://[^/?#\\]+", 1)), F.lit(""))


def origin(url: Column) -> Column:
    """Scheme, host and port in lower case, without user info or default port."""
    head = F.lower(F.regexp_extract(F.trim(url), f"({_HEAD})", 1))
    no_user = F.regexp_replace(head, "//[^@/]*@", "//")
    return F.nullif(F.regexp_replace(no_user, "^(https://.*):443$|^(http://.*):80$", "$1$2"), F.lit(""))


def host(url: Column) -> Column:
    return F.regexp_replace(origin(url), "^[^:]+://|:[0-9]+$", "")


def bare_host(url: Column) -> Column:
    """Host without a leading ``www.``; NULL for a text that is no url."""
    return F.regexp_replace(host(url), r"^www\.", "")


def path(url: Column) -> Column:
    """Path with at least a slash; dot segments stay as written."""
    tail = F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/?#\\]+[^?#]*)", 1)
    return F.nullif(F.regexp_replace(tail, "^//[^/]+/?", "/"), F.lit(""))


def query_part(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)


def fragment_part(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^#]*(#.*)$", 1)


def path_key(url: Column) -> Column:
    """Origin and path in lower case without the final slash; else the input."""
    key = F.regexp_replace(F.lower(F.concat(origin(url), path(url))), "/$", "")
    return F.coalesce(key, url)


def clean_url(url: Column) -> Column:
    """Drop tracking parameters, the fragment and a final slash."""
    query = F.regexp_replace(query_part(F.trim(url)), r"^\?", "")
    names = "|".join(rules.TRACKING_PARAMETERS)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?:{names})(?:=|$)")), "&")
    rebuilt = F.concat(origin(url), path(url), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))
    return F.coalesce(F.regexp_replace(rebuilt, "/$", ""), url)


def percent_encode(p: Column) -> Column:
    """Escape what may not stand in a path; existing escapes are kept."""
    runs = F.regexp_extract_all(p, F.lit(r"[!#-;=?-_a-z|~]+|[^!#-;=?-_a-z|~]+"), F.lit(0))
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.when(r.rlike(r"^[!#-;=?-_a-z|~]"), r).otherwise(F.replace(F.url_encode(r), F.lit("+"), F.lit("%20"))),
        ),
        "",
    )


def _without_dots(p: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute path."""
    folded = F.aggregate(
        F.split(p, "/"),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    closed = F.when(p.rlike(r"/\.\.?$"), F.concat(F.array_join(folded, "/"), F.lit("/"))).otherwise(F.array_join(folded, "/"))
    return F.when(p.contains("/."), closed).otherwise(p)


def absolute(href: Column, base: Column) -> Column:
    """Full url of a link on the page ``base``, before normalising its path."""
    h = F.trim(href)
    site = origin(base)
    return F.when(
        is_url(base),
        F.when(is_url(h), h)
        .when(h.startswith("//"), F.concat(scheme(base), F.lit(":"), h))
        .when(h.rlike(r"^(?i)[a-z][a-z0-9+.\-]*:"), F.lit(None).cast("string"))
        .when(h.startswith("/"), F.concat(site, h))
        .when(h.startswith("?"), F.concat(site, path(base), h))
        .when((h == "") | h.startswith("#"), F.concat(site, path(base), query_part(base), h))
        .otherwise(F.concat(site, F.regexp_replace(path(base), r"[^/]*$", ""), h)),
    )


def normal_url(url: Column) -> Column:
    """Origin in lower case, dot segments resolved, path escaped."""
    return F.concat(origin(url), percent_encode(_without_dots(path(url))), query_part(url), fragment_part(url))


def resolve(href: Column, base: Column) -> Column:
    """Absolute url of a link found on the page ``base``; NULL if impossible."""
    return normal_url(absolute(href, base))


def country_from_url(url: Column) -> Column:
    return lookup(rules.TLD_COUNTRIES, F.element_at(F.split(host(url), r"\."), -1))


def classify(url: Column) -> Column:
    """Struct (entity_type, slug) of a site page; the country rule comes first."""
    p = path(url)

    def one(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(p, pattern, 1), F.lit(""))

    combo = r"^/study-(.+)-in-([^/]+)/?$"
    found = [
        ("country", one(r"^/study-in-([^/]+)/?$")),
        ("university", one(r"^/programs/universities/([^/]+)/?$")),
        ("course", one(r"^/courses/([^/]+)/?$")),
        ("blog", one(r"^/blog/([^/]+)/?$")),
        ("combo", F.when(p.rlike(combo), F.concat(one(combo), F.lit("::"), F.regexp_extract(p, combo, 2)))),
    ]
    kind, slug = F.lit("other"), F.lit(None).cast("string")
    for name, value in reversed(found):
        kind = F.when(value.isNotNull(), name).otherwise(kind)
        slug = F.coalesce(value, slug)
    return F.struct(kind.alias("entity_type"), slug.alias("slug"))


def link_score(url: Column) -> Column:
    """Additive score of a link, -999 for excluded pages and non-urls.

    The path is part of the url, so one test of the url per rule is enough; a
    file ending counts at the end of the path or of the url.
    """
    full = F.lower(url)

    def hit(rule: str) -> Column:
        return full.rlike(f"^[^?#]*{rule[:-1]}(?:[?#]|$)|{rule}" if rule.endswith("$") else rule)

    total = reduce(lambda a, b: a + b, [F.when(hit(r), s).otherwise(0) for r, s in rules.LINK_SCORES])
    # Bans stand last in the table, so a floor at the end equals stopping there.
    return F.when(is_url(url), F.greatest(total, F.lit(-999))).otherwise(-999)


def _first_match(text: Column, table: list[tuple[str, int]], neutral: int) -> Column:
    out = F.lit(neutral)
    for pattern, score in reversed(table):
        out = F.when(text.rlike(pattern), score).otherwise(out)
    return out


def sitemap_score(url: Column) -> Column:
    return _first_match(F.lower(url), rules.SITEMAP_SCORES, rules.SITEMAP_NEUTRAL)


def crawl_score(url: Column) -> Column:
    return _first_match(F.lower(url), rules.CRAWL_SCORES, rules.CRAWL_NEUTRAL)


def is_followable(href: Column) -> Column:
    """Not a mail, phone or script link and not a bare fragment."""
    h = F.coalesce(href, F.lit(""))
    return (h != "") & ~h.rlike(r"^(?:mailto:|tel:|javascript:|#)")


def same_site(url: Column, base: Column) -> Column:
    return F.coalesce(bare_host(url) == bare_host(base), F.lit(False))


# --- images ---------------------------------------------------------------

def image_type(url: Column) -> Column:
    """logo / campus / classroom / building, NULL for icons and unknown files."""
    l = F.lower(url)
    out = F.when(contains_any(l, rules.IMAGE_SKIP), F.lit(None).cast("string"))
    for kind, words in rules.IMAGE_TYPES.items():
        out = out.when(contains_any(l, words), kind)
    return out.when(l.rlike(r"\.(?:jpg|jpeg|png|webp)"), "campus")


def is_image_link(url: Column) -> Column:
    l = F.lower(F.coalesce(url, F.lit("")))
    return (l.rlike(r"\.(?:jpg|jpeg|png|webp|gif|svg)") | l.contains("image")) & ~l.startswith("data:")


def is_svg(url: Column) -> Column:
    return F.lower(url).endswith(".svg")


def image_response_ok(url: Column, content_type: Column, content_length: Column, kind: Column) -> Column:
    """Usable response: an image that is not tiny; SVG for logos only."""
    size = F.coalesce(content_length, F.lit(0))
    is_image = F.coalesce(content_type, F.lit("")).startswith("image/")
    return F.when(is_svg(url), kind == "logo").otherwise(is_image & ((size == 0) | (size >= rules.IMAGE_MIN_BYTES)))
