"""Whole-text license scan on odd rows, repeated and long texts, clashing names and empty tables."""

import time

import duckdb

from campusloom.llm import licenses
from campusloom.llm.sql import LICENSES

MIT = "Released under the MIT License"
BODY = dict(licenses.FULL_TEXTS)["BSD-3-Clause"]


def wrapped(text, n=7):
    words = text.split()
    return "\n".join(" * " + " ".join(words[i : i + n]) for i in range(0, len(words), n))


def test_odd_rows(spark):
    texts = [None, "", " \n", "license", MIT, MIT, f"über {MIT.upper()}!", "the license " * 9_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_texts(df).collect()}
    assert len(got) == len(texts)
    assert all((got[k].n_matches, got[k].license, got[k].dice, got[k].licenses) == (0, None, None, []) for k in (0, 1, 2, 3, 7))
    assert all((got[k].license, got[k].dice, got[k].licenses) == ("MIT", 1.0, ["MIT"]) for k in (4, 5, 6))


def test_clashing_names_and_empty_table(spark):
    schema = "doc_id long, text string, license string, dice int, licenses int, n_matches int, _found int, _grams int, _row int, `a.b` int"
    one = spark.createDataFrame([(1, MIT, "x", 1, 1, 1, 2, 3, 4, 5)], schema)
    for fn in (licenses.scan_texts, licenses.scan):
        out = fn(one)
        assert sorted(out.columns) == sorted(one.columns)
        r = out.first()
        assert (r["license"], r["n_matches"], r["_found"], r["_grams"], r["_row"], r["a.b"]) == ("MIT", r["n_matches"], 2, 3, 4, 5)
        assert fn(spark.createDataFrame([], schema)).count() == 0


def test_ties_go_to_the_first_template(spark):
    two = (("B", "one two three four"), ("A", "one two three four"))
    r = licenses.scan_texts(spark.createDataFrame([("zero one two three four",)], "text string"), two).first()
    assert (r.license, r.n_matches, r.licenses) == ("B", 2, ["A", "B"])


def test_every_template_is_found_when_wrapped_and_edited(spark):
    """Line breaks, comment marks, other words around and two words changed do not hide a passage."""
    rows = []
    for k, (name, text) in enumerate(licenses.FULL_TEXTS):
        words = text.split()
        words[len(words) // 2] = "changed"
        rows.append((k, name, "Some words before it, see the license.\n" + wrapped(" ".join(words)) + "\nand words after"))
    for r in licenses.scan_texts(spark.createDataFrame(rows, "k int, name string, text string")).collect():
        assert r["name"] in r["licenses"] and 0.9 < r["dice"] <= 1.0


def test_mixed_texts_equal_sql(spark, tmp_path):
    """Passages cut, doubled and interleaved, against the windows of the SQL."""
    rows = []
    for k, (_, text) in enumerate(licenses.TEMPLATES + licenses.FULL_TEXTS):
        words = text.split()
        rows += [" ".join(words[len(words) // 5 :]), " ".join(words + words[: len(words) // 2]), " ".join(w for j, w in enumerate(words) if j % 9 != k % 9)]
        rows.append(" ".join(x for w in zip(words, words[3:]) for x in w))
    df = spark.createDataFrame(list(enumerate(rows + [None, ""])), "doc_id long, text string").coalesce(1)
    df.write.parquet(str(tmp_path / "d"))
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = sorted(duck.execute(f"select doc_id, n_matches, license, round(dice, 9), licenses from ({LICENSES})").fetchall())
    got = licenses.scan_texts(df).collect()
    assert sorted((r.doc_id, r.n_matches, r.license, None if r.dice is None else round(r.dice, 9), ",".join(r.licenses)) for r in got) == want
    assert sum(r[2] is not None for r in want) > 40


def test_work_is_linear_in_the_text(spark):
    """A text of 135,000 characters that is all license passages is done in seconds."""
    text = (BODY + "\n") * (135_000 // len(BODY))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    out = licenses.scan_texts(df)
    start = time.time()
    assert out.first()["dice"] == 1.0
    assert time.time() - start < 20
