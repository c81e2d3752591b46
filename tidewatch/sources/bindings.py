"""Bind the driver's test tables to the entities of the data model.

* items       <- ``documents``: source, category = lang, pos = doc_id, url = '',
                 title = text (id over ``'' | text``)
* seen_items  <- ids of the ``documents`` rows with ``doc_id % 7 = 0``
* day_texts   <- ``documents``: day = 2024-01-01 + doc_id % 31, scope = lang,
                 whole text; query day 2024-01-31
* counters    <- ``events``: date = to_date(ts), key = user_id, value = round(sum(value), 2);
                 query day 2024-01-30
* keywords    <- ``events``: kw = user_id:event_type per date
* counter text<- ``events``: '1,077 stars today' / '1.2k stars' forms built from value
* pages       <- ``pages`` as landed HTML
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from tidewatch.functions.ids import item_id

TEXT_EPOCH = _dt.date(2024, 1, 1)
TEXT_DAYS = 31
TEXT_DAY = _dt.date(2024, 1, 31)      # query day for day_texts
COUNTER_DAY = _dt.date(2024, 1, 30)   # query day for the events facts
SEEN_MODULUS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source with ``src_rank`` (0-based, by name)."""
    docs = table(spark, sf_dir, "documents").select("source").distinct()
    return docs.select(
        "source",
        (F.row_number().over(Window.orderBy("source")) - 1).alias("src_rank"),
        F.lit("scrape").alias("method"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items as landed, one row per document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "source",
        F.col("lang").alias("category"),
        F.col("text").alias("title"),
        F.lit("").alias("url"),
        F.lit("").alias("summary"),
        F.lit("").alias("published"),
        F.col("doc_id").alias("pos"),
    )


def seen_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (docs.filter(F.col("doc_id") % SEEN_MODULUS == 0)
            .select(item_id(F.lit(""), F.col("text")).alias("aid"),
                    F.lit(_dt.datetime(2024, 1, 1)).cast("timestamp").alias("first_seen"))
            .dropDuplicates(["aid"]))


def events_by_day(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """``events`` with a ``date`` column."""
    return _events(spark, sf_dir, since, until).withColumn("date", F.to_date("ts"))


def day_texts(spark: SparkSession, sf_dir: str, combined: bool = False) -> DataFrame:
    """``(date, scope, text)``; one row per document, whole text.

    With ``combined`` every document is also placed in scope ``_combined``.
    """
    docs = table(spark, sf_dir, "documents")
    date = F.date_add(F.lit(TEXT_EPOCH), (F.col("doc_id") % TEXT_DAYS).cast("int"))
    base = docs.select(date.alias("date"), F.col("lang").alias("scope"), F.col("text"))
    if not combined:
        return base
    scopes = F.array(F.col("scope"), F.lit("_combined"))
    return base.select("date", F.explode(scopes).alias("scope"), "text")


def _events(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """``events`` with an optional ``[since, until]`` day range written on ``ts``
    itself, so it reaches the parquet scan as a pushed filter."""
    ev = table(spark, sf_dir, "events")
    if since is not None:
        ev = ev.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        ev = ev.filter(F.col("ts") < F.date_add(F.lit(until), 1).cast("timestamp_ntz"))
    return ev


def counter_fact(spark: SparkSession, sf_dir: str, key: str = "user_id", since=None, until=None) -> DataFrame:
    """``(date, key, value, pos)`` with one row per day and key."""
    ev = _events(spark, sf_dir, since, until)
    return (ev.groupBy(F.to_date("ts").alias("date"), F.col(key).cast("string").alias("key"))
            .agg(F.round(F.sum("value"), 2).alias("value"), F.min("event_id").alias("pos")))


def day_keywords(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    ev = _events(spark, sf_dir, since, until)
    return ev.select(F.to_date("ts").alias("date"),
                     F.concat_ws(":", F.col("user_id").cast("string"), F.col("event_type")).alias("kw"))


def star_texts(spark: SparkSession, sf_dir: str, since=None, until=None) -> DataFrame:
    """Counter texts: ``(date, repo, stars, pos)``.

    cents = round(value * 100); >= 100000 gives ``'<k>.<d>k stars'``, otherwise
    ``'<n with commas> stars today'``; ``error`` events give ``', stars'`` (unparsable).
    """
    ev = _events(spark, sf_dir, since, until)
    cents = F.round(F.col("value") * 100).cast("bigint")
    k_form = F.concat((cents / 1000).cast("bigint").cast("string"), F.lit("."),
                      ((cents % 1000) / 100).cast("bigint").cast("string"), F.lit("k stars"))
    plain = F.concat(F.format_number(cents, 0), F.lit(" stars today"))
    text = (F.when(F.col("event_type") == "error", F.lit(", stars"))
            .when(cents >= 100000, k_form).otherwise(plain))
    return ev.select(F.to_date("ts").alias("date"),
                     F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/"),
                              F.col("event_type")).alias("repo"),
                     text.alias("stars"), F.col("event_id").alias("pos"))


# ---- digest and reference-list bindings ----
# The digest lists these categories (languages) in this order.
DIGEST_ORDER = ["en", "fr", "de", "es"]
DIGEST_LABELS = {"en": "English", "fr": "Français", "de": "Deutsch", "es": "Español"}
# Second case: a category outside the order counts in the header but isn't listed.
DIGEST_PARTIAL_ORDER = DIGEST_ORDER[:3]
# Evidence of a day is filed under a dimension by language.
LANG_DIMENSION = {"en": 0, "de": 1, "fr": 2, "es": 3}


def digest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewatch.functions.text import clip, py_strip
    docs = table(spark, sf_dir, "documents")
    return docs.select("source", F.col("lang").alias("category"), F.col("doc_id").alias("pos"),
                       py_strip("text").alias("title"), F.lit("").alias("url"),
                       clip("text", 1000).alias("summary"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence rows: every document of a day, filed under a dimension by language."""
    from tidewatch.functions.text import py_strip
    docs = table(spark, sf_dir, "documents")
    dim = F.create_map(*[x for k, v in LANG_DIMENSION.items() for x in (F.lit(k), F.lit(v))])
    return docs.select(F.date_add(F.lit(TEXT_EPOCH), (F.col("doc_id") % TEXT_DAYS).cast("int")).alias("date"),
                       F.coalesce(dim[F.col("lang")], F.lit(4)).alias("dim_rank"),
                       F.col("doc_id").alias("pos"), py_strip("text").alias("title"), "source",
                       F.lit("").alias("url"))


def source_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog with a category per source: the four item categories in turn, by source rank."""
    cats = F.array(F.lit("papers"), F.lit("company"), F.lit("opensource"), F.lit("industry"))
    return source_catalog(spark, sf_dir).withColumn("category", F.element_at(cats, (F.col("src_rank") % 4 + 1).cast("int")))


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token usage per call, bound to ``conversations``: assistant turns are calls of
    stage2, other turns calls of stage1; prompt = turn number + 1, completion = characters."""
    c = table(spark, sf_dir, "conversations")
    prompt, completion = (F.col("turn") + 1).cast("bigint"), F.length(F.coalesce("text", F.lit(""))).cast("bigint")
    return c.select(F.when(F.col("role") == "assistant", "stage2").otherwise("stage1").alias("stage"), F.lit("bound").alias("model"),
                    prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), (prompt + completion).alias("total_tokens"))


# ---- second counter fact: orders by month ----
ORDER_MONTH = _dt.date(2001, 7, 1)   # last complete month of the orders table
ORDER_LOOKBACK_DAYS = 365


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(date, key, value, pos)``: month, customer, total price of the month, first order key."""
    o = table(spark, sf_dir, "orders")
    # the lookback as a range on the stored column, so it reaches the scan
    first = (ORDER_MONTH - _dt.timedelta(days=ORDER_LOOKBACK_DAYS)).replace(day=1)
    after = (ORDER_MONTH + _dt.timedelta(days=31)).replace(day=1)
    o = o.filter((F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
                 & (F.col("o_orderdate") < F.lit(after).cast("timestamp_ntz")))
    return (o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
                      F.col("o_custkey").cast("string").alias("key"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("value"), F.min("o_orderkey").alias("pos")))


# ---- payloads built from documents: one model-written analysis, feed and model list per document ----

def analysis_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pos, raw)``: JSON documents with text keys that no schema knows and values that are no texts; a document
    in Spanish has no date, one without a language is no object."""
    d = table(spark, sf_dir, "documents")
    text, source, lang = [F.coalesce(c, F.lit("")) for c in ("text", "source", "lang")]
    named = lambda **c: F.struct(*[v.alias(k) for k, v in c.items()])
    evidence = F.parse_json(F.concat(F.lit('[{"title": '), F.to_json(F.array(lang)).substr(F.lit(2), F.length(F.to_json(F.array(lang))) - 2),
                                     F.lit(', "url": "u"}, {"url": "v", "title": null}, "plain", 7]')))
    dimensions = named(
        risk=named(zz_note=source, intensity=F.lit("high"), count=F.lit(3), aa_note=lang),
        weather=named(sky=text, evidence=F.lit("none")),
        technology=named(has_change=F.lit(True), own_words=text, n=F.col("n_chars"), nested=named(a=F.lit("b")), empty=F.lit(""),
                         model_capability=source, evidence=evidence))
    date = F.when(F.col("lang") != "es", F.date_format(F.date_add(F.lit(TEXT_EPOCH), (F.col("doc_id") % TEXT_DAYS).cast("int")), "yyyy-MM-dd"))
    body = F.to_json(named(date=date, title=lang, core_insight=source, keywords=F.array(lang), dimensions=dimensions))
    return d.select(F.col("doc_id").alias("pos"), F.when(F.col("lang").isNull(), F.concat(F.lit("["), body)).otherwise(body).alias("raw"))


def feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, category, xml)``: a feed with an untitled entry and the document as the second one."""
    d = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    xml = F.concat(F.lit("<rss><channel><title>f</title><item><title></title><link>https://feed.example/none</link></item><item><title>"), text,
                   F.lit("</title><link> https://feed.example/"), F.col("doc_id").cast("string"), F.lit(" </link><description>"), text,
                   F.lit("</description><pubDate>2024-01-01</pubDate></item></channel></rss>"))
    return d.select("source", F.lit("papers").alias("category"), xml.alias("xml"))


def list_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(source, category, body)``: a model list with an entry without id."""
    d = table(spark, sf_dir, "documents")
    entry = F.struct(F.concat(F.lit("org/"), F.col("doc_id").cast("string")).alias("id"), F.col("lang").alias("pipeline_tag"),
                     F.col("n_chars").alias("downloads"), F.col("doc_id").alias("likes"))
    empty = F.struct(F.lit("").alias("id"), F.lit(None).cast("string").alias("pipeline_tag"), F.lit(1).cast("bigint").alias("downloads"),
                     F.lit(1).cast("bigint").alias("likes"))
    return d.select("source", F.lit("opensource").alias("category"), F.to_json(F.array(empty, entry)).alias("body"))
