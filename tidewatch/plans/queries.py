"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The tables are bound to the entities by :mod:`tidewatch.sources.bindings`;
every query reads whole tables.  Column names match the DuckDB oracle in
:mod:`tidewatch.plans.oracle_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch import constants as C
from tidewatch.functions.counters import parse_counter, counter_or_zero
from tidewatch.functions.text import clip, is_relevant, py_strip, repo_name, repo_path
from tidewatch.operators import analysis as AN
from tidewatch.operators import backfill as BF
from tidewatch.operators import counters as CT
from tidewatch.operators import detectors as DT
from tidewatch.operators import ingest as IG
from tidewatch.operators import keywords as KW
from tidewatch.operators import reports as RP
from tidewatch.operators import rolling as RL
from tidewatch.operators import shift as SH
from tidewatch.operators import vectors as V
from tidewatch.operators._util import window_filter
from tidewatch.plans import reports as PR
from tidewatch.sources import bindings as B
from tidewatch.sources import harvest as HV
from tidewatch.streaming import capped as CP
from tidewatch.streaming import streams as ST
from tidewatch.streaming import trends as TR

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- counters (M2/M3, K1-K3)

def _growth(spark, sf_dir, days=30):
    return CT.counter_growth(B.counter_fact(spark, sf_dir), B.COUNTER_DAY, days=days)


@register("counter_growth")
def q_counter_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _growth(spark, sf_dir)


@register("top_growth")
def q_top_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CT.top_growth(_growth(spark, sf_dir))


@register("new_entities")
def q_new_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CT.new_entities(_growth(spark, sf_dir, days=1))


@register("top_values")
def q_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CT.top_values(_growth(spark, sf_dir))


@register("counter_totals")
def q_counter_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = CT.counter_totals(B.counter_fact(spark, sf_dir), B.COUNTER_DAY)
    return t.select(F.round("total", 2).alias("total"), "key_count", "history_days")


def _since(day, days):
    import datetime as _dt
    return day - _dt.timedelta(days=days)


# ---------------------------------------------------------------- keyword trends (T4, K4)


def _kw_trends(spark, sf_dir, days):
    kwd = B.day_keywords(spark, sf_dir, since=_since(B.COUNTER_DAY, days), until=B.COUNTER_DAY)
    return KW.keyword_trends(kwd, B.COUNTER_DAY, days=days)


@register("keyword_trends")
def q_keyword_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kw_trends(spark, sf_dir, 30)


@register("keyword_trends_7")
def q_keyword_trends_7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kw_trends(spark, sf_dir, 7)


@register("keyword_lists")
def q_keyword_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = KW.keyword_lists(_kw_trends(spark, sf_dir, 30))
    return lists.withColumn("rank", F.col("rank").cast("bigint"))


@register("keyword_lists_5")
def q_keyword_lists_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = KW.keyword_lists(_kw_trends(spark, sf_dir, 5))
    return lists.withColumn("rank", F.col("rank").cast("bigint"))


# ---------------------------------------------------------------- counter text, series, windows


@register("star_parse")
def q_star_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = B.star_texts(spark, sf_dir)
    return st.select("pos", "stars", parse_counter("stars").alias("parsed"),
                     counter_or_zero("stars").alias("parsed_or_zero"))


def _novelty_points(spark, sf_dir):
    """Novelty curve of all texts together (scope ``_combined``)."""
    texts = B.day_texts(spark, sf_dir)
    tf = V.merge_scopes(_text_tf(spark, sf_dir))
    scope = spark.createDataFrame([(C.COMBINED_SCOPE,)], "scope string")
    s = SH.novelty_series(tf, texts.select("date"), scope, B.TEXT_DAY)
    return s.select(F.lit("novelty").alias("metric"), "date", F.col("novelty").alias("value"))


def _series(spark, sf_dir):
    since = _since(B.COUNTER_DAY, 29)
    stars = B.star_texts(spark, sf_dir, since=since, until=B.COUNTER_DAY)
    ev = B.events_by_day(spark, sf_dir, since=since, until=B.COUNTER_DAY)
    s1 = CT.daily_series(stars, B.COUNTER_DAY, counter_or_zero("stars"), metric="stars")
    s2 = CT.daily_series(ev, B.COUNTER_DAY, F.col("value"), metric="downloads")
    s2 = s2.withColumn("value", F.round("value", 2))
    s1 = s1.withColumn("value", F.col("value").cast("double"))
    return s1.unionByName(s2).unionByName(_novelty_points(spark, sf_dir))


@register("daily_series")
def q_daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir)


@register("chart_table")
def q_chart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CT.chart_table(_series(spark, sf_dir))


@register("history_window")
def q_history_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = window_filter(B.day_texts(spark, sf_dir), B.TEXT_DAY, 30)
    return texts.groupBy("date").agg(F.count("*").alias("texts"),
                                     F.sum(F.length("text")).cast("bigint").alias("chars"))


@register("chart_window")
def q_chart_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = window_filter(B.events_by_day(spark, sf_dir), B.COUNTER_DAY, 30, inclusive=True)
    return ev.groupBy("date").agg(F.count("*").alias("events"))


# ---------------------------------------------------------------- text vectors and detectors (V, T, M1, M5)


def _texts(spark, sf_dir, day=None, days=30):
    day = day or B.TEXT_DAY
    texts = B.day_texts(spark, sf_dir)
    return window_filter(texts, day, days + 1, inclusive=True)


_DERIVED: dict[tuple, tuple[tuple, DataFrame]] = {}


def _kept(spark, sf_dir, key: tuple, make) -> DataFrame:
    """A derived table of ``documents``, made once per application and again when the table's files change."""
    from tidewatch.operators._util import cut_lineage
    from tidewatch.sources.store import file_state
    key, state = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), *key), file_state(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    if _DERIVED.get(key, (None,))[0] != state:
        _DERIVED[key] = (state, cut_lineage(make()))
    return _DERIVED[key][1]




#: The days that text queries ask about: one term table covers their windows.
TEXT_QUERY_DAYS = (B.TEXT_DAY, B.COUNTER_DAY)


def _text_tf(spark, sf_dir, day=None, days=30):
    """The day-text term table of the window: its days of one table, which holds the windows of all query days, is
    materialised once per application (checkpoint in the shared folder) and shared by every text analytic, like
    the derived term table a daily job keeps next to its history."""
    day = day or B.TEXT_DAY
    first, last = min(day, *TEXT_QUERY_DAYS), max(day, *TEXT_QUERY_DAYS)
    width = days + (last - first).days
    terms = _kept(spark, sf_dir, ("terms", str(last), width), lambda: V.term_counts(_texts(spark, sf_dir, last, width)))
    return window_filter(terms, day, days + 1, inclusive=True)


def _members(spark, sf_dir, day=None, days=30, scopes=None):
    """Corpus membership of the day texts (record days x scopes); the default
    form is materialised once per application, like the term table."""
    day = day or B.TEXT_DAY
    texts = B.day_texts(spark, sf_dir)
    if scopes is not None:
        return V.day_members(texts.select("date"), scopes, day, days)
    return _kept(spark, sf_dir, ("members", str(day), days),
                 lambda: V.day_members(texts.select("date"), texts.select("scope").distinct(), day, days))


def _lang_sims(spark, sf_dir):
    tf = _text_tf(spark, sf_dir)
    return V.tfidf_similarity(tf, _members(spark, sf_dir))


@register("char_ngrams")
def q_char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text_tf(spark, sf_dir).withColumn("tf", F.col("tf").cast("bigint"))


@register("vocabulary")
def q_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    voc = V.vocabulary(_text_tf(spark, sf_dir), _members(spark, sf_dir))
    return voc.select("scope", "term", F.col("ctf").cast("bigint").alias("ctf"),
                      F.col("df").cast("bigint").alias("df"), F.round("idf", 9).alias("idf"),
                      F.col("rank").cast("bigint").alias("rank"))


@register("tfidf_weights")
def q_tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = V.tfidf_weights(_text_tf(spark, sf_dir), _members(spark, sf_dir))
    return w.select("scope", "date", "term", F.round("weight", 9).alias("weight"))


@register("day_similarity")
def q_day_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lang_sims(spark, sf_dir).select("scope", "date", F.round("sim", 9).alias("sim"))


@register("trend_measures")
def q_trend_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DT.trend_measures(_lang_sims(spark, sf_dir).select("scope", "date", "sim"))


# Lowered thresholds: the synthetic days are all alike (similarities near 1),
# so the default thresholds never fire; these make every detector fire somewhere.
LOW_THRESHOLDS = DT.TrendParams(spike_delta=-1.0, spike_min_recent=0.0, continuous_min_ratio=0.5,
                                emerging_max=1.01, emerging_mean=1.01)


@register("trend_signals")
def q_trend_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = DT.trend_measures(_lang_sims(spark, sf_dir).select("scope", "date", "sim"),
                          params=LOW_THRESHOLDS, keep_raw=True)
    return DT.trend_signals(m)


@register("signal_order")
def q_signal_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DT.signal_ranks(q_trend_signals(spark, sf_dir)).select("rank", "type", "dimension", "confidence")


@register("overall_novelty")
def q_overall_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    tf = V.merge_scopes(_text_tf(spark, sf_dir))
    scope = spark.createDataFrame([(C.COMBINED_SCOPE,)], "scope string")
    sims = V.tfidf_similarity(tf, _members(spark, sf_dir, scopes=scope))
    return DT.overall_novelty(sims.select("scope", "date", "sim"))


def _all_days_tf(spark, sf_dir):
    """Term counts of all record days (the days of the binding are one window)."""
    return _text_tf(spark, sf_dir)


def _backfill(spark, sf_dir):
    texts = B.day_texts(spark, sf_dir)
    return BF.similarity_backfill(_all_days_tf(spark, sf_dir), texts.select("date"), texts.select("scope").distinct())


@register("similarity_backfill")
def q_similarity_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backfill(spark, sf_dir).select("scope", "day", "date", F.round("sim", 9).alias("sim"))


@register("trend_backfill")
def q_trend_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector measures of every day."""
    return DT.trend_measures(_backfill(spark, sf_dir).select("scope", "day", "date", "sim"), ("scope", "day"))


@register("rolling_vocabulary")
def q_rolling_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary, count and document frequency of the corpus of every day."""
    return BF.sliding_vocabulary(_all_days_tf(spark, sf_dir), B.day_texts(spark, sf_dir).select("date")).select(
        "scope", "day", "term", F.col("ctf").cast("bigint").alias("ctf"), F.col("df").cast("bigint").alias("df"))


@register("vocabulary_by_state")
def q_vocabulary_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query day's vocabulary from the state of the day before and the two days that come in and go out."""
    import datetime as _dt
    tf, day, one = _text_tf(spark, sf_dir), B.TEXT_DAY, _dt.timedelta(days=1)
    empty = tf.limit(0)
    yesterday = RL.advance(spark.createDataFrame([], RL.STATE), tf.filter(F.col("date") < F.lit(day)), empty)
    gone = day - (C.LOOKBACK_DAYS + 1) * one
    state = RL.advance(yesterday, tf.filter(F.col("date") == F.lit(day)), tf.filter(F.col("date") == F.lit(gone)))
    sizes = _members(spark, sf_dir).groupBy("scope").agg(F.count("*").alias("n_docs"))
    return RL.state_vocabulary(state, sizes).select("scope", "term", "ctf", "df", F.round("idf", 9).alias("idf"), F.col("rank").cast("bigint").alias("rank"))


FLAGSHIP = "trend_measures"


# ---------------------------------------------------------------- ingest


def _items(spark, sf_dir):
    return IG.with_item_id(B.items(spark, sf_dir))


@register("item_ids")
def q_item_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    it = _items(spark, sf_dir)
    return it.select("source", "pos", "aid", py_strip("title").alias("title"),
                     clip("title", C.SUMMARY_CHARS).alias("summary1000"))


@register("relevance_filter")
def q_relevance_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    it = B.items(spark, sf_dir)
    return it.filter(is_relevant("source", "title")).select("source", "pos", "category")


def _dedup(spark, sf_dir, mode):
    acc = IG.dedup_capped(_items(spark, sf_dir), B.source_catalog(spark, sf_dir),
                          B.seen_items(spark, sf_dir), cap=C.ITEMS_PER_SOURCE, mode=mode)
    return acc.select("source", F.col("src_rank").cast("bigint").alias("src_rank"), "pos", "aid",
                      F.col("rank").cast("bigint").alias("rank"))


@register("dedup_global_first")
def q_dedup_global_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup(spark, sf_dir, "global_first")


@register("dedup_capped_exact")
def q_dedup_capped_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup(spark, sf_dir, "exact")


def _stats(spark, sf_dir):
    items = _items(spark, sf_dir)
    cat = B.source_catalog(spark, sf_dir)
    acc = IG.dedup_capped(items, cat, B.seen_items(spark, sf_dir), cap=C.ITEMS_PER_SOURCE)
    return IG.ingest_stats(items, acc, cat)


@register("ingest_stats")
def q_ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir).drop("src_rank")


@register("run_totals")
def q_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return IG.run_totals(_stats(spark, sf_dir))


# ---------------------------------------------------------------- harvest


# Binding: every link of the test pages is site-relative ('/word') and titles
# are short, so the prefix is '/' and the title minimum is 3.
LINK_MIN_TITLE_TEST = 3


@register("link_harvest_before")
def q_link_harvest_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.table(spark, sf_dir, "pages")
    return HV.harvest_links(pages, "prefix", "/", min_title=LINK_MIN_TITLE_TEST, dedup="before")


@register("link_harvest_after")
def q_link_harvest_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.table(spark, sf_dir, "pages")
    return HV.harvest_links(pages, "contains", "/", min_title=LINK_MIN_TITLE_TEST, dedup="after")


@register("block_harvest")
def q_block_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.table(spark, sf_dir, "pages")
    return HV.harvest_blocks(pages, relevance=False).select("page_id", "pos", "title", "description", "summary")


@register("block_harvest_relevant")
def q_block_harvest_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = B.table(spark, sf_dir, "pages")
    return HV.harvest_blocks(pages, relevance=True).select("page_id", "pos", "title")


# ---------------------------------------------------------------- text shift (M1) and novelty series (M5)


@register("text_shift")
def q_text_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = B.day_texts(spark, sf_dir)
    today = (texts.filter((F.col("date") == F.lit(B.TEXT_DAY)) & (F.length("text") > 0))
             .groupBy("scope").agg(F.count("*").alias("text_count")))
    return SH.text_shift(_text_tf(spark, sf_dir), today, texts.select("date"), B.TEXT_DAY)


@register("novelty_series")
def q_novelty_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = B.day_texts(spark, sf_dir)
    return SH.novelty_series(_text_tf(spark, sf_dir), texts.select("date"),
                             texts.select("scope").distinct(), B.TEXT_DAY)


# ---------------------------------------------------------------- reports


@register("digest_lines")
def q_digest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.digest_lines(B.digest_items(spark, sf_dir), B.TEXT_DAY, B.DIGEST_ORDER, B.DIGEST_LABELS)


@register("digest_lines_partial")
def q_digest_lines_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.digest_lines(B.digest_items(spark, sf_dir), B.TEXT_DAY, B.DIGEST_PARTIAL_ORDER, B.DIGEST_LABELS)


@register("reference_list")
def q_reference_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.reference_list(B.evidence(spark, sf_dir), B.source_categories(spark, sf_dir))


# ---------------------------------------------------------------- streaming


@register("stream_dedup")
def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = ST.scratch_dirs(spark, "stream-dedup")
    ST.run_available_now(ST.stream_dedup(ST.document_stream(spark, sf_dir)), out, state)
    return spark.read.parquet(out).select("aid")


@register("stream_dedup_capped")
def q_stream_dedup_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over the document stream: the accepted items after its last epoch."""
    out, state = ST.scratch_dirs(spark, "stream-dedup-capped")
    CP.run_capped_stream(ST.document_stream(spark, sf_dir), out, state, B.source_catalog(spark, sf_dir), B.seen_items(spark, sf_dir))
    return CP.accepted(spark, out).select("source", F.col("src_rank").cast("bigint").alias("src_rank"), "pos", "aid",
                                          F.col("rank").cast("bigint").alias("rank"))


@register("stream_keyword_trends")
def q_stream_keyword_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 of every day from the masks that the event stream leaves."""
    out, state = ST.scratch_dirs(spark, "stream_keywords")
    rows = ST.event_stream(spark, sf_dir).select(F.to_date("ts").alias("date"), "kw")
    TR.run_keyword_stream(rows, out, state)
    return TR.keyword_trends_by_day(TR.read_masks(spark, out))


@register("stream_daily")
def q_stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state = ST.scratch_dirs(spark, "stream-daily")
    ST.run_daily_upserts(ST.stream_daily_keywords(ST.event_stream(spark, sf_dir)), out, state)
    return ST.read_daily(spark, out).select("date", "kw", "n", F.round("value", 2).alias("value"))


# ---------------------------------------------------------------- composite reports


REPORT_DAY = B.COUNTER_DAY  # texts, keywords and counters all exist on this day


def _report_tf(spark, sf_dir):
    return V.with_combined(_text_tf(spark, sf_dir, day=REPORT_DAY))


def _trend_report(spark, sf_dir):
    texts = B.day_texts(spark, sf_dir)
    kwd = B.day_keywords(spark, sf_dir, since=_since(REPORT_DAY, 30), until=REPORT_DAY)
    return PR.trend_report(_report_tf(spark, sf_dir), texts.select("date"), kwd, REPORT_DAY)


@register("trend_report")
def q_trend_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trend_report(spark, sf_dir)


@register("trend_report_flat")
def q_trend_report_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.flat_trend_report(_trend_report(spark, sf_dir))


def _metrics_report(spark, sf_dir):
    texts = B.day_texts(spark, sf_dir)
    tf = V.merge_scopes(_text_tf(spark, sf_dir, day=REPORT_DAY))
    counts = (texts.filter((F.col("date") == F.lit(REPORT_DAY)) & (F.length("text") > 0))
              .select(F.explode(F.array(F.col("scope"), F.lit(C.COMBINED_SCOPE))).alias("scope"))
              .groupBy("scope").agg(F.count("*").alias("text_count"))
              .filter(F.col("scope") == C.COMBINED_SCOPE))
    since = _since(REPORT_DAY, 30)
    stars = B.star_texts(spark, sf_dir, since=since, until=REPORT_DAY)
    downloads = B.counter_fact(spark, sf_dir, since=since, until=REPORT_DAY)
    return PR.metrics_report(REPORT_DAY, tf, texts.select("date"), counts, stars, downloads)


@register("metrics_report")
def q_metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metrics_report(spark, sf_dir)


@register("metrics_report_flat")
def q_metrics_report_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PR.flat_metrics_report(_metrics_report(spark, sf_dir))


@register("report_bundle")
def q_report_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    analysis = AN.default_analysis(spark, str(REPORT_DAY))
    return PR.bundle(REPORT_DAY, analysis, _trend_report(spark, sf_dir), _metrics_report(spark, sf_dir),
                     q_chart_table(spark, sf_dir))


@register("run_summary")
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.run_summary(_stats(spark, sf_dir), B.usage(spark, sf_dir))


@register("token_totals")
def q_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.token_totals(B.usage(spark, sf_dir))


# ---------------------------------------------------------------- documents, feeds and lists

@register("document_texts")
def q_document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = AN.parse_documents(B.analysis_payloads(spark, sf_dir), keep=("pos",))
    texts = AN.day_texts(good, keep=("pos",), extra=True)
    return texts.select("pos", "scope", F.length("text").cast("bigint").alias("chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


@register("document_keywords")
def q_document_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = AN.parse_documents(B.analysis_payloads(spark, sf_dir), keep=("pos",))
    return AN.day_keywords(good, keep=("pos", "date"))


@register("repo_names")
def q_repo_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = B.table(spark, sf_dir, "documents")
    href = F.concat(F.lit("//"), F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"))
    return docs.select(F.col("doc_id").alias("pos"), repo_path(href).alias("path"), repo_name(repo_path(href)).alias("name"))


@register("document_rejects")
def q_document_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = AN.parse_documents(B.analysis_payloads(spark, sf_dir), keep=("pos",))
    return bad.select("pos", "reason")


@register("feed_harvest")
def q_feed_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HV.harvest_feed(B.feed_payloads(spark, sf_dir))


@register("list_harvest")
def q_list_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return HV.harvest_api(B.list_payloads(spark, sf_dir)).select("source", "title", "url", "summary", "downloads", "likes")


# ---------------------------------------------------------------- second counter fact: orders by month

def _order_growth(spark, sf_dir):
    return CT.counter_growth(B.order_fact(spark, sf_dir), B.ORDER_MONTH, days=B.ORDER_LOOKBACK_DAYS)


@register("order_growth")
def q_order_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_growth(spark, sf_dir)


@register("order_top_growth")
def q_order_top_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CT.top_growth(_order_growth(spark, sf_dir))
