"""Composite day reports: trend report (T6), metrics report (M4), bundle (R2),
run summary (R4).

Each report is one row per query day built from the operators; every
per-day piece is a bounded aggregate (signals <= 3 x scopes, keyword lists <= 10
each, top lists <= 10), attached through scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import constants as C
from tidewatch.functions.counters import parse_counter
from tidewatch.operators import counters as CT
from tidewatch.operators import detectors as DT
from tidewatch.operators import keywords as KW
from tidewatch.operators import reports as RP
from tidewatch.operators import shift as SH
from tidewatch.operators import vectors as V
from tidewatch.operators._util import cut_lineage, day_lit, window_filter

_SIGNAL_FIELDS = ["type", "dimension", "description", "confidence", "recent_similarity", "older_similarity",
                  "trend_days", "monotonic_ratio", "max_historical_similarity", "mean_historical_similarity",
                  "novelty_score"]


def trend_report(tf: DataFrame, records: DataFrame, day_keywords: DataFrame, day,
                 days: int = C.LOOKBACK_DAYS, params: DT.TrendParams = DT.TrendParams(),
                 scopes: DataFrame | None = None, label: Column | None = None, state: DataFrame | None = None) -> DataFrame:
    """Trend report of ``day`` (T6): ``date, has_enough_history, history_days,
    overall_novelty, signals, keyword_trends, message``.

    ``tf``: term counts by ``(scope, date)`` including the ``_combined`` scope;
    ``records``: existing record days (``date``).  Fewer than ``min_history``
    history days give the default report (no signals, empty keyword lists,
    novelty 1.0, a message).  Must run before the day itself is stored.  ``state``: the stored corpus
    statistics of the day (``operators.rolling``), if they are kept.
    """
    d = day_lit(day)
    spark = tf.sparkSession
    recs = cut_lineage(window_filter(records.select("date").distinct(), day, days + 1, inclusive=True))
    records = recs
    n_hist = window_filter(recs, day, days).select(F.count("*")).scalar()
    if scopes is None:
        scopes = tf.select("scope").distinct()
    members = V.day_members(records.select("date"), scopes, day, days)
    # per-day similarities are tiny (scopes x days) and feed three branches
    sims = cut_lineage(V.tfidf_similarity(tf, members, state=state).select("scope", "date", "sim"))
    measures = DT.trend_measures(sims.filter(F.col("scope") != C.COMBINED_SCOPE), params=params, keep_raw=True)
    signals = DT.trend_signals(measures, label)
    sig = signals.agg(F.transform(
        F.array_sort(F.collect_list(F.struct(
            (-F.coalesce(F.col("confidence"), F.lit(0.0))).alias("k"), "dim_rank", "type_rank", "dimension",
            F.struct(*_SIGNAL_FIELDS).alias("s")))),
        lambda x: x["s"]).alias("signals")).scalar()
    novelty = DT.overall_novelty(sims.filter(F.col("scope") == C.COMBINED_SCOPE)).select("novelty").scalar()
    # records with an empty keyword list still count as records: use the record spine
    kw = cut_lineage(KW.keyword_report(KW.keyword_trends(day_keywords, day, days, spine=records)))  # one row
    empty = F.array().cast("array<string>")
    enough = n_hist >= params.min_history
    message = F.format_string(C.NOT_ENOUGH_HISTORY.replace("{need}", "%d").replace("{have}", "%d"),
                              F.lit(params.min_history), n_hist)
    kw_struct = F.struct(*[F.when(enough, F.coalesce(kw.select(f"{k}_keywords").scalar(), empty)).otherwise(empty)
                           .alias(f"{k}_keywords") for k in ("new", "rising", "fading")])
    return spark.range(1).select(
        d.alias("date"),
        enough.alias("has_enough_history"),
        n_hist.cast("bigint").alias("history_days"),
        F.when(enough, F.coalesce(novelty, F.lit(1.0))).otherwise(F.lit(1.0)).alias("overall_novelty"),
        F.when(enough, sig).alias("signals"),
        kw_struct.alias("keyword_trends"),
        F.when(~enough, message).alias("message"),
    ).withColumn("signals", F.coalesce("signals", F.array().cast(
        "array<struct<type:string,dimension:string,description:string,confidence:double,"
        "recent_similarity:double,older_similarity:double,trend_days:bigint,monotonic_ratio:double,"
        "max_historical_similarity:double,mean_historical_similarity:double,novelty_score:double>>")))


def flat_trend_report(report: DataFrame) -> DataFrame:
    """Scalar form of the trend report (lists joined by commas)."""
    return report.select(
        "date", "has_enough_history", "history_days", "overall_novelty",
        F.size("signals").cast("bigint").alias("signal_count"),
        *[F.array_join(F.col("keyword_trends")[f"{k}_keywords"], ",").alias(f"{k}_keywords")
          for k in ("new", "rising", "fading")])


def _top(df: DataFrame, cols: list[str], order: list[Column], field: str | None = None) -> Column:
    """A top-k frame (at most k rows) as an array of structs sorted by ``order``
    (ascending keys; negate a key for descending); with ``field`` an array of
    that field only.  No window: the order travels in the sorted structs."""
    keys = [o.alias(f"_k{i}") for i, o in enumerate(order)]
    pick = (lambda x: x["v"][field]) if field else (lambda x: x["v"])
    return df.agg(F.transform(F.array_sort(F.collect_list(F.struct(*keys, F.struct(*cols).alias("v")))),
                              pick).alias("a")).scalar()


def metrics_report(day, text_tf: DataFrame, text_records: DataFrame, text_counts: DataFrame,
                   stars: DataFrame, downloads: DataFrame, days: int = C.LOOKBACK_DAYS,
                   snapshot_days: DataFrame | None = None) -> DataFrame:
    """Metrics report of ``day`` (M4): ``date, arxiv_capability, github_stars,
    huggingface_downloads`` structs.

    ``text_tf`` / ``text_counts``: term counts and today's text count of the
    paper corpus (one scope); ``stars``: ``(date, repo, stars, pos)``
    counter texts; ``downloads``: ``(date, key, value, pos)``, a missing count is 0.
    ``snapshot_days`` are the days with a snapshot, whatever its lists hold (default: days
    with any fact); their number before ``day`` is the report's ``history_days``.  A part without
    rows today has ``has_data = false``, a message and empty lists.
    """
    spark = stars.sparkSession
    d = day_lit(day)
    if snapshot_days is None:
        snapshot_days = stars.select("date").union(downloads.select("date")).union(text_records.select("date"))
    hist_days = window_filter(snapshot_days.select("date").distinct(), day, days).select(F.count("*")).scalar()
    shift = SH.text_shift(text_tf, text_counts, snapshot_days, day, days)
    arxiv = shift.agg(F.first(F.struct(
        "has_data", "message", "capability_score", "mean_similarity", "trend", "history_days",
        F.col("text_count").alias("paper_count"))).alias("a")).scalar()
    no_text = F.struct(F.lit(False).alias("has_data"), F.lit(C.NO_TEXT_TODAY).alias("message"),
                       F.lit(None).cast("double").alias("capability_score"), F.lit(None).cast("double").alias("mean_similarity"),
                       F.lit("unknown").alias("trend"), F.lit(None).cast("bigint").alias("history_days"), F.lit(0).cast("bigint").alias("paper_count"))

    # one conditional aggregate per fact; everything below reads its few rows
    sfact = stars.select("date", F.col("repo").alias("key"), parse_counter("stars").alias("value"), "pos")
    s_state = CT.counter_state(sfact, day, days)
    s_growth = CT.growth_of(s_state)
    s_tot = s_state.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("t"), F.count("*").alias("n"))
    n_repos = s_tot.select("n").scalar()
    github = F.struct(
        (n_repos > 0).alias("has_data"),
        F.when(n_repos == 0, C.NO_REPOS_TODAY).alias("message"),
        s_tot.select("t").scalar().alias("total_stars_today"),
        n_repos.alias("repo_count"),
        _top(CT.top_growth(s_growth).select(
            F.col("key").alias("repo"), F.col("value").alias("stars"), F.col("prev_max").alias("prev_stars"),
            "growth_pct", "pos"), ["repo", "stars", "prev_stars", "growth_pct"],
            [-F.col("growth_pct"), F.col("pos"), F.col("repo")]).alias("top_growth"),
        _top(CT.new_entities(s_growth).select(F.col("key").alias("repo"), "pos"), ["repo"],
             [F.col("pos"), F.col("repo")], "repo").alias("new_repos"),
        F.when(n_repos > 0, hist_days).alias("history_days"))

    d_state = CT.counter_state(downloads.withColumn("value", F.coalesce(F.col("value"), F.lit(0))), day, days)
    d_growth = CT.growth_of(d_state)
    d_tot = d_growth.agg(F.coalesce(F.sum("value"), F.lit(0)).alias("t"), F.count("*").alias("n"))
    n_models = d_tot.select("n").scalar()
    hf = F.struct(
        (n_models > 0).alias("has_data"),
        F.when(n_models == 0, C.NO_MODELS_TODAY).alias("message"),
        d_tot.select("t").scalar().alias("total_downloads"),
        n_models.alias("model_count"),
        _top(CT.top_values(d_growth).select(F.col("key").alias("model_id"), F.col("value").alias("downloads"), "pos"),
             ["model_id", "downloads"], [-F.col("downloads"), F.col("pos"), F.col("model_id")]).alias("top_downloads"),
        _top(CT.top_growth(d_growth).select(
            F.col("key").alias("model_id"), F.col("value").alias("downloads"),
            F.col("prev_max").alias("prev_downloads"), "growth_pct", "pos"),
            ["model_id", "downloads", "prev_downloads", "growth_pct"],
            [-F.col("growth_pct"), F.col("pos"), F.col("model_id")]).alias("top_growth"),
        F.when(n_models > 0, hist_days).alias("history_days"))
    return spark.range(1).select(d.alias("date"), F.coalesce(arxiv, no_text).alias("arxiv_capability"),
                                 github.alias("github_stars"), hf.alias("huggingface_downloads"))


def flat_metrics_report(report: DataFrame) -> DataFrame:
    """Scalar form of the metrics report (lists joined by commas)."""
    a, g, h = F.col("arxiv_capability"), F.col("github_stars"), F.col("huggingface_downloads")

    def joined(rows, *fields):
        return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])), ",")

    return report.select(
        "date", a["has_data"].alias("papers_has_data"), a["message"].alias("papers_message"), a["trend"].alias("papers_trend"),
        a["capability_score"].alias("capability_score"), a["history_days"].alias("papers_history_days"), a["paper_count"].alias("paper_count"),
        g["has_data"].alias("repos_has_data"), g["total_stars_today"].alias("total_stars_today"), g["repo_count"].alias("repo_count"),
        joined(g["top_growth"], "repo", "stars", "prev_stars").alias("repo_growth"), F.array_join(g["new_repos"], ",").alias("new_repos"),
        g["history_days"].alias("repos_history_days"),
        h["has_data"].alias("models_has_data"), F.round(h["total_downloads"], 2).alias("total_downloads"), h["model_count"].alias("model_count"),
        joined(h["top_downloads"], "model_id").alias("top_models"), joined(h["top_growth"], "model_id").alias("model_growth"),
        h["history_days"].alias("models_history_days"))


def bundle(day, analysis: DataFrame, trend: DataFrame | None = None, metrics: DataFrame | None = None,
           charts: DataFrame | None = None) -> DataFrame:
    """Report bundle (R2): ``date, text`` for one day."""
    spark = analysis.sparkSession
    # the reports are one row each but are built from scalar subqueries:
    # materialise them so their fields attach as plain scans (no nested subqueries)
    trend = cut_lineage(trend) if trend is not None else None
    metrics = cut_lineage(metrics) if metrics is not None else None
    base = spark.range(1).select(day_lit(day).alias("date"),
                                 analysis.select(F.to_json(F.struct("*"))).scalar().alias("analysis_json"))
    if trend is not None:
        # one row per day on both sides: attached as scalar subqueries, not joined
        tj = trend.select(F.to_json(F.struct("has_enough_history", "history_days", "overall_novelty", "signals",
                                             "keyword_trends"))).scalar()
        base = base.select("date", "analysis_json",
                           trend.select("has_enough_history").scalar().alias("has_enough_history"),
                           trend.select("message").scalar().alias("message"), tj.alias("trend_json"))
    mj = metrics.select(F.to_json(F.struct(*[c for c in metrics.columns]))).scalar() if metrics is not None else None
    cj = None
    if charts is not None:
        cj = charts.agg(F.to_json(F.array_sort(F.collect_set("metric")))).scalar()
    return RP.report_bundle(F.col("analysis_json"), trend is not None, mj, cj, base=base)
