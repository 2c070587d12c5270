"""Column functions on inline rows; expected values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from campusloom.functions import basics as B, jsonfix, seo, text as X, urls as U
from campusloom.operators import pages as H, records as R


def apply(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_resolve_links(spark):
    base = F.lit("https://www.X.edu/a/b/c.html?q=1#f")
    hrefs = ["/p", "d.html", "../up/./e", "?z=2", "#top", "//cdn.x.org/i.png", "http://y.org", "mailto:a@b.c", "/für x", "", "/../../r"]
    assert apply(spark, lambda c: U.resolve(c, base), hrefs) == [
        "https://www.x.edu/p", "https://www.x.edu/a/b/d.html", "https://www.x.edu/a/up/e", "https://www.x.edu/a/b/c.html?z=2",
        "https://www.x.edu/a/b/c.html?q=1#top", "https://cdn.x.org/i.png", "http://y.org/", None, "https://www.x.edu/f%C3%BCr%20x",
        "https://www.x.edu/a/b/c.html?q=1", "https://www.x.edu/r",
    ]


def test_url_parts(spark):
    urls = ["https://user:pw@WWW.A.com:443/X/", "http://a.com:8080?x=1", "no url", None]
    assert apply(spark, U.bare_host, urls) == ["a.com", "a.com", None, None]
    assert apply(spark, U.path, urls) == ["/X/", "/", None, None]
    assert apply(spark, U.path_key, urls) == ["https://www.a.com/x", "http://a.com:8080", "no url", None]
    assert apply(spark, U.clean_url, ["https://a.com/x/?utm_source=1&b=2&ref=#t", "https://a.com/?ref=1"]) == ["https://a.com/x/?b=2", "https://a.com"]


def test_classify(spark):
    paths = ["study-in-x-in-y", "study-law-in-the-in-uk", "courses/a/", "courses/a/b", "", "blog/p", "programs/universities/u"]
    got = apply(spark, U.classify, [f"https://s.com/{p}" for p in paths] + ["bad"])
    assert [(g.entity_type, g.slug) for g in got] == [
        ("country", "x-in-y"), ("combo", "law-in-the::uk"), ("course", "a"), ("other", None), ("other", None),
        ("blog", "p"), ("university", "u"), ("other", None),
    ]


def test_link_score(spark):
    urls = ["https://a.edu/fees.pdf", "https://a.edu/x?f=fees.pdf#z", "https://a.edu/ug", "https://a.edu/debug2", "bad", "https://a.edu/?p=12", "https://a.edu/x"]
    assert apply(spark, U.link_score, urls) == [-909, 90, 75, 0, -999, -999, 0]


def test_json_repair(spark):
    raw = [
        '```json\n{"a": [1, 2,],}\n```', 'Sure: {"a": {"b": [1} done', '{"a": 1} tail', "no json", '{"a": 1', '{"a": [{"b": 1}', None, '{"a": 1} x {b}',
    ]
    assert apply(spark, jsonfix.repair_json, raw) == [
        '{"a": [1, 2]}', None, '{"a": 1}', None, None, '{"a": [{"b": 1}]}', None, None,
    ]
    assert apply(spark, jsonfix.repair_json_short, ['x ```{"a": 1}``` y', '{"a": 1,}']) == ['{"a": 1}', None]


def test_intakes_and_levels(spark):
    assert apply(spark, X.normalize_intake, ["Sept. 2025", "sep", "May", "ab", "Mar, mar"]) == ["September. 2025", "September", "May", None, "March, mar"]
    assert apply(spark, X.normalize_level, ["UG", "ba", "Bar exam", "Post-doc", "doctoral", ""]) == ["Undergraduate", "Undergraduate", None, "Postgraduate", "PhD", None]


def test_numbers(spark):
    assert apply(spark, B.parse_rank, ["#47", "1,501", "x", "9999999999999999999999"]) == [47, None, None, None]
    assert apply(spark, B.parse_percent, ["0.45", "1", "0.05", "101"]) == [45.0, 100.0, 5.0, None]
    assert apply(spark, lambda c: B.parse_percent(c, inclusive=False, low=0.5), ["0.45", "1", "0.004", "0"]) == [45.0, 1.0, None, None]
    assert apply(spark, B.duration_label, [3_725_000, 59_999], "long") == ["1h 2m 5s", "0m 59s"]


def test_titles(spark):
    brand = "Khaki Brand"
    assert apply(spark, lambda c: seo.repair_suffix(c, brand), ["A |", "A | Khaki", "A | Khaki Brand", "A | B", "A - :"]) == ["A", "A", "A | Khaki Brand", "A | B", "A"]
    long = "word " * 13 + "end"
    got = apply(spark, lambda c: seo.enforce_length(c, 60, brand), ["x" * 50 + " | Khaki Brand", long, "y" * 81, "z" * 70])
    assert got == ["x" * 50, ("word " * 12).strip(), None, "z" * 60]


def test_text_helpers(spark):
    assert apply(spark, X.slugify, ["Élan & Co. (UK)", "--a  b--", "x_y"]) == ["elan-and-co-uk", "a-b", "xy"]
    assert apply(spark, X.normalize_name, ["The A-B (C) Univ., X"]) == ["the a b univ x"]
    assert apply(spark, X.name_variants, ["Foo (Bar) College"]) == [["Foo (Bar) College", "Foo College", "Foo (Bar)"]]
    assert apply(spark, X.is_non_english, ["ж" * 100, "ж" * 99, "a" * 600 + "ж"]) == [True, False, True]
    assert apply(spark, X.drop_boilerplate, ["Home\nab\nReal  text\there\n|\nFacebook page\n\n\nlast line"]) == ["Real  text here\nlast line"]


def test_page_text():
    html = """<html><head><title>T</title></head><body><nav>n</nav><div class="cookie-bar">c</div><div id="sidebar">s</div>
<header>h</header><p>Body &amp; more<br>x</p><script>var a="</p>";</script></body></html>"""
    assert H.page_text(html).split() == ["Body", "&", "morex"]
    main = "m" * 201
    assert H.page_text(f"<body><p>out</p><main><p>{main}</p></main></body>") == main
    assert H.page_text(None) == ""


def test_nested_lists(spark):
    df = spark.createDataFrame(
        [([("Law", "UG"), ("law", "bachelor"), ("Art", "x"), (" ", "PhD"), ("M" * 160, "cert")],)], "p array<struct<category:string,level:string>>"
    )
    got = df.select(R.repair_programs(F.col("p"))).first()[0]
    assert [(p.category, p.level) for p in got] == [("Law", "Undergraduate"), ("M" * 150, "Certificate")]
    assert apply(spark, R.distinct_ignoring_case, [["CV here", "cv here ", None, "abc", ""]], "array<string>") == [["CV here"]]


@pytest.mark.parametrize("kind", ["country", "course", "university"])
def test_generic_title(spark, kind):
    title = apply(spark, lambda c: seo.generic_title(kind, c, "B"), ["N"])[0]
    assert "N" in title and title.endswith("| B")
    assert apply(spark, lambda c: seo.needs_title(kind, c, F.lit("N"), "B"), [title, " ", None, "own"]) == [True, True, True, False]


def test_three_digits_follow_the_binary_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from campusloom.operators.quality import three_digits

    values = [0.95 * 0.55 + 0.56 * 0.45, 0.0625, 0.1875, 0.0, 0.98, 1.0]
    values += [round(s * 0.01, 2) * 0.45 + round(m * 0.01, 2) * 0.55 for s in range(0, 82, 3) for m in range(0, 100)]
    values += [(2 * k + 1) / 2000 for k in range(990)]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(three_digits(F.col("v"))).collect()]
    assert got == [float(Decimal(v).quantize(Decimal("0.001"), ROUND_HALF_UP)) for v in values]
    assert got[0] == 0.774


def test_boilerplate_lines_after_tabs(spark):
    from campusloom.functions.text import drop_boilerplate

    text = "\tMenu\nReal content of the page\n\t\tHome\n" + "long line " * 3000
    out = spark.createDataFrame([(text,)], "t string").select(drop_boilerplate(F.col("t"))).first()[0]
    assert out.startswith("Real content") and "Home" not in out and len(out) > 25_000


def test_shared_folder_or_error():
    import pytest

    from campusloom.session import checkpoint_folder

    class Context:
        master = "spark://far:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        checkpoint_folder(Session())
