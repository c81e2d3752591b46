"""Trend detectors over a day's similarities to its history records.

Input ``sims``: ``(corpus..., date, sim)`` for the history records of each
corpus (at most the lookback length per corpus), as produced by
:func:`tidewatch.operators.vectors.tfidf_similarity`.  All measures come from
one windowed pass and one aggregation per corpus.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.functions.rounding import py_round


@dataclass(frozen=True)
class TrendParams:
    min_history: int = C.MIN_HISTORY_DAYS
    spike_recent_n: int = C.SPIKE_RECENT_N
    spike_delta: float = C.SPIKE_DELTA
    spike_min_recent: float = C.SPIKE_MIN_RECENT
    spike_scale: float = C.SPIKE_SCALE
    continuous_min_history: int = C.CONTINUOUS_MIN_HISTORY
    continuous_window: int = C.CONTINUOUS_WINDOW
    continuous_min_ratio: float = C.CONTINUOUS_MIN_RATIO
    emerging_max: float = C.EMERGING_MAX_SIM
    emerging_mean: float = C.EMERGING_MEAN_SIM


def trend_measures(sims: DataFrame, corpus_keys: Sequence[str] = ("scope",),
                   params: TrendParams = TrendParams(), keep_raw: bool = False) -> DataFrame:
    """One row per corpus with every detector measure and flag.

    Columns: ``history_days, recent_sim, older_sim, max_sim, mean_sim,
    up_steps, trend_days, monotonic_ratio, spike, continuous, emerging,
    spike_confidence, novelty_score`` (rounded as reported; flags are decided on
    unrounded values; ``keep_raw`` adds the unrounded ``*_raw`` columns used
    by :func:`trend_signals`).  "Last N" means the last N records.  In the step count
    the appended final value 1.0 is compared with ``least(sim, 1.0)``.
    """
    ck = list(corpus_keys)
    p = params
    by_desc = Window.partitionBy(*ck).orderBy(F.col("date").desc())
    by_asc = Window.partitionBy(*ck).orderBy("date")
    s = F.least(F.col("sim"), F.lit(1.0))
    x = (sims.withColumn("rn", F.row_number().over(by_desc))
         .withColumn("prev", F.lag(s).over(by_asc))
         .withColumn("s", s))
    w = p.continuous_window
    agg = x.groupBy(*ck).agg(
        F.count("*").alias("history_days"),
        F.avg(F.when(F.col("rn") <= p.spike_recent_n, F.col("sim"))).alias("recent"),
        F.avg(F.when(F.col("rn") > p.spike_recent_n, F.col("sim"))).alias("older"),
        F.max("sim").alias("max_sim_raw"),
        F.avg("sim").alias("mean_sim_raw"),
        F.count_if((F.col("rn") <= w - 1) & F.col("prev").isNotNull() & (F.col("s") >= F.col("prev"))).alias("inner_up"),
    )
    n = F.col("history_days")
    steps = F.least(n, F.lit(w))
    up = F.col("inner_up") + 1
    ratio = up / steps
    recent, older = F.col("recent"), F.col("older")
    spike = ((n >= p.min_history) & older.isNotNull()
             & (recent > older + p.spike_delta) & (recent > p.spike_min_recent))
    continuous = (n >= p.continuous_min_history) & (ratio >= p.continuous_min_ratio)
    emerging = ((n >= p.min_history) & (F.col("max_sim_raw") < p.emerging_max)
                & (F.col("mean_sim_raw") < p.emerging_mean))
    raw = ([F.col("recent").alias("recent_sim_raw"), F.col("older").alias("older_sim_raw"),
            F.col("max_sim_raw"), F.col("mean_sim_raw")] if keep_raw else [])
    return agg.select(
        *ck,
        n.cast("bigint").alias("history_days"),
        py_round(recent, 3).alias("recent_sim"),
        py_round(older, 3).alias("older_sim"),
        py_round("max_sim_raw", 3).alias("max_sim"),
        py_round("mean_sim_raw", 3).alias("mean_sim"),
        up.cast("bigint").alias("up_steps"),
        (steps + 1).cast("bigint").alias("trend_days"),
        py_round(ratio, 2).alias("monotonic_ratio"),
        F.coalesce(spike, F.lit(False)).alias("spike"),
        F.coalesce(continuous, F.lit(False)).alias("continuous"),
        F.coalesce(emerging, F.lit(False)).alias("emerging"),
        py_round(F.least((recent - older) / p.spike_scale, F.lit(1.0)), 2).alias("spike_confidence"),
        py_round(1.0 - F.col("max_sim_raw"), 2).alias("novelty_score"),
        *raw,
    )


def _fmt2(c: Column) -> Column:
    return F.format_string("%.2f", c)


def trend_signals(measures: DataFrame, label: Column | None = None) -> DataFrame:
    """``measures`` from :func:`trend_measures` with ``keep_raw=True``.

    One row per fired signal, ordered by confidence (missing = 0) descending (K5).

    Columns: ``type, dimension, description, confidence, recent_similarity,
    older_similarity, trend_days, monotonic_ratio, max_historical_similarity,
    mean_historical_similarity, novelty_score``.  ``label`` names the dimension
    (defaults to the fixed label of a known dimension, else the scope).
    """
    if label is None:
        m = F.create_map(*[x for k, v in C.DIMENSION_LABELS.items() for x in (F.lit(k), F.lit(v))])
        label = F.coalesce(m[F.col("scope")], F.col("scope"))
    ranks = F.create_map(*[x for i, d in enumerate(C.DIMENSIONS) for x in (F.lit(d), F.lit(i))])
    base = (measures.withColumn("dimension", label)
            .withColumn("dim_rank", F.coalesce(ranks[F.col("scope")], F.lit(len(C.DIMENSIONS)))))
    null_d, null_l = F.lit(None).cast("double"), F.lit(None).cast("bigint")
    spike = base.filter("spike").select(
        F.lit("sudden_spike").alias("type"), F.lit(0).alias("type_rank"), "dim_rank", "dimension",
        F.format_string(C.SPIKE_DESCRIPTION.replace("{label}", "%s").replace("{recent}", "%s")
                        .replace("{older}", "%s"), F.col("dimension"), _fmt2(F.col("recent_sim_raw")),
                        _fmt2(F.col("older_sim_raw"))).alias("description"),
        F.col("spike_confidence").alias("confidence"),
        F.col("recent_sim").alias("recent_similarity"), F.col("older_sim").alias("older_similarity"),
        null_l.alias("trend_days"), null_d.alias("monotonic_ratio"),
        null_d.alias("max_historical_similarity"), null_d.alias("mean_historical_similarity"),
        null_d.alias("novelty_score"))
    cont = base.filter("continuous").select(
        F.lit("continuous_trend").alias("type"), F.lit(1).alias("type_rank"), "dim_rank", "dimension",
        F.format_string(C.CONTINUOUS_DESCRIPTION.replace("{label}", "%s").replace("{days}", "%d")
                        .replace("{up}", "%d").replace("{steps}", "%d"),
                        F.col("dimension"), F.col("trend_days"), F.col("up_steps"),
                        F.col("trend_days") - 1).alias("description"),
        F.col("monotonic_ratio").alias("confidence"),
        null_d.alias("recent_similarity"), null_d.alias("older_similarity"),
        F.col("trend_days"), F.col("monotonic_ratio"),
        null_d.alias("max_historical_similarity"), null_d.alias("mean_historical_similarity"),
        null_d.alias("novelty_score"))
    emer = base.filter("emerging").select(
        F.lit("emerging_topic").alias("type"), F.lit(2).alias("type_rank"), "dim_rank", "dimension",
        F.format_string(C.EMERGING_DESCRIPTION.replace("{label}", "%s").replace("{max}", "%s"),
                        F.col("dimension"), _fmt2(F.col("max_sim_raw"))).alias("description"),
        null_d.alias("confidence"),
        null_d.alias("recent_similarity"), null_d.alias("older_similarity"),
        null_l.alias("trend_days"), null_d.alias("monotonic_ratio"),
        F.col("max_sim").alias("max_historical_similarity"),
        F.col("mean_sim").alias("mean_historical_similarity"),
        F.col("novelty_score"))
    return spike.unionByName(cont).unionByName(emer)


def signal_order(signals: DataFrame) -> DataFrame:
    """Sort signals: confidence (missing = 0) descending; ties keep the order in
    which they are produced (dimension order, then spike, continuous, emerging)."""
    return signals.orderBy(*_signal_keys())


def _signal_keys() -> list[Column]:
    return [F.coalesce(F.col("confidence"), F.lit(0.0)).desc(), F.col("dim_rank"), F.col("type_rank"), F.col("dimension")]


def signal_ranks(signals: DataFrame) -> DataFrame:
    """Signals with their 1-based ``rank`` in the report (K5): at most three rows a scope, so one window over all of them."""
    return signals.withColumn("rank", F.row_number().over(Window.orderBy(*_signal_keys())).cast("bigint"))


def overall_novelty(sims: DataFrame, corpus_keys: Sequence[str] = ("scope",)) -> DataFrame:
    """``round(1 - mean(sim), 3)`` per corpus (T5).

    Corpora without similarities (no history, fewer than two non-blank texts)
    are absent here; the report fills them with 1.0.
    """
    ck = list(corpus_keys)
    return sims.groupBy(*ck).agg(py_round(1.0 - F.avg("sim"), 3).alias("novelty"),
                                 F.count("*").cast("bigint").alias("history_days"))


def shift_label(novelty: Column, mean_sim: Column) -> Column:
    """Text-shift label (P17).  With novelty = 1 - mean the last branch cannot
    be reached (novelty <= 0.4 means mean >= 0.6); the rule is kept as stated."""
    return (F.when(novelty > C.SHIFT_LEAP_NOVELTY, F.lit(C.SHIFT_LEAP))
            .when(mean_sim > C.SHIFT_CONTINUATION_MEAN, F.lit(C.SHIFT_CONTINUATION))
            .otherwise(F.lit(C.SHIFT_GRADUAL)))
