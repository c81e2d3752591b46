"""Counter analytics: growth against history, top-k, new entities, daily series (M2, M3, M6-M8).

A fact is ``(date, key, value[, pos])``.  Everything is one conditional
aggregation per key over the pruned window ``[d-days, d]``: one shuffle on
``key`` (after map-side partial aggregation), no self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.functions.rounding import py_round
from tidewatch.functions.counters import counter_or_zero
from tidewatch.operators._util import day_lit, window_filter


def counter_state(fact: DataFrame, day, days: int = C.LOOKBACK_DAYS, key: str = "key",
                  value: str = "value", date_col: str = "date", pos: str | None = "pos") -> DataFrame:
    """Per key seen on ``day``: today's value, historical maximum, first position.

    * today's value is the value of the *last* row of the key on ``day``
      (by ``pos``), null when that value is null (unparsed);
    * ``prev_max`` is the maximum over ``[d-days, d-1]`` of non-null values;
    * ``pos`` is the first position of the key on ``day`` (input order).
    """
    d = day_lit(day)
    win = window_filter(fact, day, days + 1, date_col=date_col, inclusive=True)
    win = win.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    today = F.col(date_col) == d
    hist = F.col(date_col) < d
    if pos is not None:
        today_value = F.max_by(F.when(today, F.col(value)), F.when(today, F.col(pos)))
        first_pos = F.min(F.when(today, F.col(pos)))
    else:
        today_value = F.max(F.when(today, F.col(value)))
        first_pos = F.lit(None).cast("bigint")
    return (win.groupBy(key)
            .agg(today_value.alias("value"),
                 F.max(F.when(hist, F.col(value))).alias("prev_max"),
                 F.count_if(today).alias("today_rows"),
                 first_pos.alias("pos"))
            .filter(F.col("today_rows") > 0)
            .drop("today_rows"))


def counter_growth(fact: DataFrame, day, days: int = C.LOOKBACK_DAYS, key: str = "key",
                   value: str = "value", date_col: str = "date", pos: str | None = "pos") -> DataFrame:
    """Growth of each key of ``day`` against its historical maximum (M2/M3).

    Result: ``key, value, prev_max, growth_pct, is_new, pos``.
    ``growth_pct = round((value - prev_max) / prev_max, 3)`` only when
    ``prev_max > 0``; ``is_new`` when no history value exists.  Keys whose value
    today is null (unparsed) are dropped; history maximum 0 gives neither.
    """
    return growth_of(counter_state(fact, day, days, key, value, date_col, pos), key)


def growth_of(state: DataFrame, key: str = "key") -> DataFrame:
    """Growth rows from the per-key state of :func:`counter_state`."""
    st = state.filter(F.col("value").isNotNull())
    growth = F.when(F.col("prev_max") > 0,
                    py_round((F.col("value") - F.col("prev_max")) / F.col("prev_max"), 3))
    return st.select(
        F.col(key).alias("key"), "value", "prev_max",
        growth.alias("growth_pct"),
        F.col("prev_max").isNull().alias("is_new"),
        "pos",
    )


def top_growth(growth: DataFrame, k: int = C.TOP_K) -> DataFrame:
    """First ``k`` keys by growth, descending; ties in input order (K2)."""
    return (growth.filter(F.col("growth_pct").isNotNull())
            .orderBy(F.col("growth_pct").desc(), F.col("pos"), F.col("key"))
            .limit(k))


def new_entities(growth: DataFrame, k: int = C.TOP_K) -> DataFrame:
    """First ``k`` keys without history, in input order (K3)."""
    return growth.filter("is_new").orderBy("pos", "key").limit(k)


def top_values(growth: DataFrame, k: int = C.TOP_K) -> DataFrame:
    """First ``k`` keys by today's value, descending; ties in input order (K1)."""
    return growth.orderBy(F.col("value").desc(), F.col("pos"), F.col("key")).limit(k)


def counter_totals(fact: DataFrame, day, days: int = C.LOOKBACK_DAYS, key: str = "key",
                   value: str = "value", date_col: str = "date", pos: str | None = "pos") -> DataFrame:
    """Run totals of a counter on ``day``: total value, key count, history days."""
    st = counter_state(fact, day, days, key, value, date_col, pos)
    hist_days = window_filter(fact, day, days, date_col=date_col).select(date_col).distinct()
    return (st.agg(F.sum("value").alias("total"), F.count("*").alias("key_count"))
            .withColumn("history_days", hist_days.select(F.count("*")).scalar()))


def daily_series(fact: DataFrame, day, value, days: int = C.LOOKBACK_DAYS, date_col: str = "date",
                 metric: str = "value", spine: DataFrame | None = None) -> DataFrame:
    """Daily total over the chart window ``[d-days+1, d]``.

    ``value`` is a Column evaluated per row (e.g. ``counter_or_zero('stars')``).
    Days come from ``spine`` (existing days) when given, else from the fact;
    a day without rows gives 0.
    """
    win = window_filter(fact, day, days, date_col=date_col, inclusive=True)
    totals = win.groupBy(F.col(date_col).alias("date")).agg(F.sum(value).alias("value"))
    if spine is None:
        return totals.select(F.lit(metric).alias("metric"), "date", "value")
    days_df = window_filter(spine.select(F.col(date_col).alias("date")).distinct(), day, days,
                            inclusive=True)
    return (days_df.join(totals, "date", "left")
            .select(F.lit(metric).alias("metric"), "date",
                    F.coalesce(F.col("value"), F.lit(0)).alias("value")))


def star_series(stars: DataFrame, day, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """Daily total of parsed counter texts, unparsed as 0 (M6)."""
    return daily_series(stars, day, counter_or_zero("stars"), days, metric="stars")


def chart_table(series: DataFrame, min_days: int = 2) -> DataFrame:
    """Chart-ready rows (M8): ``metric, date, value, label, show_tick``.

    A metric needs at least ``min_days`` points; a tick every
    ``max(1, n // 7)`` points, label ``MM-dd``.  The per-metric window holds at
    most the window length (30) rows.
    """
    w = Window.partitionBy("metric").orderBy("date")
    wn = Window.partitionBy("metric")
    out = (series.withColumn("rn", F.row_number().over(w))
           .withColumn("n", F.count("*").over(wn)))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 7))
    return (out.filter(F.col("n") >= min_days)
            .select("metric", "date", F.col("value").cast("double").alias("value"),
                    F.date_format("date", "MM-dd").alias("label"),
                    (((F.col("rn") - 1) % step) == 0).alias("show_tick")))
