import hashlib

from pyspark.sql import functions as F

from tidewatch.functions import (char_wb_ngrams, counter_or_zero, is_relevant, item_id, not_blank, parse_counter,
                                 py_strip, summary_from_parts, words)
from tidewatch.functions.ngrams import explode_ngrams
from tidewatch.sources.harvest import html_text


def test_item_id_matches_hashlib(spark):
    rows = [("https://x.org/a", "Title"), ("", "Only title"), (None, "t")]
    df = spark.createDataFrame(rows, "url string, title string")
    got = [r[0] for r in df.select(item_id("url", "title")).collect()]
    want = [hashlib.sha256(f"{u or ''}|{t}".encode()).hexdigest()[:16] for u, t in rows]
    assert got == want


def test_counter_text(spark):
    texts = ["1.2k stars today", "1,077 stars today", "1.2.3 stars", ", stars", "12 K Stars", ""]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select(parse_counter("s").alias("p"), counter_or_zero("s").alias("z")).collect()
    assert [r.p for r in rows] == [1200, 1077, None, None, 12000, None]
    assert [r.z for r in rows] == [1200, 1077, 0, 0, 12000, 0]


def test_char_wb_ngrams_of_ai(spark):
    df = spark.createDataFrame([("AI",)], "w string").select(F.lower("w").alias("w"))
    got = df.select(char_wb_ngrams("w")).first()[0]
    assert sorted(got) == sorted([" a", "ai", "i ", " ai", "ai ", " ai "])
    rows = explode_ngrams(df, "w").collect()
    assert sorted(r.term for r in rows) == sorted(got)


def test_ngrams_never_cross_words_and_short_words(spark):
    df = spark.createDataFrame([("a",), ("hello",)], "w string")
    got = {r.w: sorted(r.g) for r in df.select("w", char_wb_ngrams("w").alias("g")).collect()}
    assert got["a"] == sorted([" a", "a ", " a "])
    assert len(got["hello"]) == 6 + 5 + 4


def test_words_use_unicode_whitespace(spark):
    text = "Hello World foo\tbar\n\nBAZ "
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(words("t")).first()[0] == text.lower().split()


def test_blank_and_strip(spark):
    df = spark.createDataFrame([("  　\n",), (" x ",), (None,), ("",)], "t string")
    rows = df.select(not_blank("t").alias("b"), py_strip("t").alias("s")).collect()
    assert [r.b for r in rows] == [False, True, False, False]
    assert rows[1].s == "x"


def test_relevance_is_unanchored_with_word_end(spark):
    cases = {"cloud storage": True, "constraint solver": True, "openai sdk": True, "aim high": False,
             "html parser": True, "mlops": False, "plain text": False, "Machine-Learning": True}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.m for r in df.select("t", is_relevant("t").alias("m")).collect()}
    assert got == cases


def test_summary_parts(spark):
    df = spark.createDataFrame([("text-generation", 1234567, 89), ("", 5, 0)], "p string, d long, l long")
    got = [r[0] for r in df.select(summary_from_parts("p", "d", "l")).collect()]
    assert got == ["Pipeline: text-generation  |  Downloads: 1,234,567  |  Likes: 89",
                   "Downloads: 5  |  Likes: 0"]


def test_html_text_strips_each_node(spark):
    df = spark.createDataFrame([("  Hello <b> big </b> World &amp; co ",)], "h string")
    assert df.select(html_text("h")).first()[0] == "HellobigWorld & co"


def test_parse_published(spark):
    import datetime as dt
    from tidewatch.functions import parse_published
    df = spark.createDataFrame([("Fri, 27 Feb 2026 03:16:00 GMT",), ("27 Feb 2026 03:16:00 +0000",),
                                ("2026-02-27T03:16:00",), ("yesterday",), ("",)], "p string")
    got = [r[0] for r in df.select(parse_published("p")).collect()]
    assert got[:3] == [dt.datetime(2026, 2, 27, 3, 16)] * 3 and got[3:] == [None, None]
