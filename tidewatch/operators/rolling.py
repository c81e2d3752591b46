"""Sliding corpus statistics as a stored state (K6, V3, V4).

The state of a day holds, per (scope, term), the total count and the document frequency in the corpus of
the day and the ``days`` days before it.  A new day adds its own term counts and takes back those that leave
the window; nothing else of the history is read.  A state is one partition of a store; it is made from
the newest earlier state, so days may be missing, and a rerun replaces its day.  Rerunning an older day drops the
states after it: the next run starts from the older day again.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch import constants as C
from tidewatch.operators.vectors import top_terms
from tidewatch.sources import store as S

STATE = "scope string, term string, ctf bigint, df bigint"


def advance(state: DataFrame, arriving: DataFrame, leaving: DataFrame) -> DataFrame:
    """``scope, term, ctf, df`` after documents came and went (``scope, date, term, tf`` rows): one partially
    aggregated shuffle of the state and the two ends of the window."""
    def part(tf: DataFrame, sign: int) -> DataFrame:
        return tf.select("scope", "term", (F.col("tf") * sign).cast("bigint").alias("ctf"), F.lit(sign).cast("bigint").alias("df"))

    moved = state.select("scope", "term", "ctf", "df").unionByName(part(arriving, 1)).unionByName(part(leaving, -1))
    return moved.groupBy("scope", "term").agg(F.sum("ctf").alias("ctf"), F.sum("df").alias("df")).filter("df > 0")


def _day(day) -> _dt.date:
    return day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))


def newest_state(spark: SparkSession, path: str, day) -> _dt.date | None:
    """Day of the newest state before ``day`` (partition names only)."""
    earlier = [d for d in S.stored_days(spark, path) if d < _day(day)]
    return max(earlier, default=None)


def update_state(terms: DataFrame, today: DataFrame, path: str, day, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """Make, store and return the state of ``day``.

    ``terms``: the term store (``scope, date, term, tf``), read only where days come in or go out since the newest earlier
    state (all of the window for a first state); ``today``: the day's own counts."""
    spark, d = today.sparkSession, _day(day)
    before = newest_state(spark, path, d)
    own = today.select("scope", F.lit(d).alias("date"), "term", "tf")
    columns = ["scope", "date", "term", "tf"]
    first = d - _dt.timedelta(days=days)
    if before is None:
        state = spark.createDataFrame([], STATE)
        arriving = terms.filter((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(d)))
        leaving = terms.limit(0)
    else:
        state = S.read_store(spark, path, STATE).filter(F.col("date") == F.lit(before)).drop("date")
        arriving = terms.filter((F.col("date") > F.lit(before)) & (F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(d)))
        leaving = terms.filter((F.col("date") >= F.lit(before - _dt.timedelta(days=days))) & (F.col("date") < F.lit(first)) & (F.col("date") <= F.lit(before)))
    S.drop_days_after(spark, path, d)
    S.replace_day(advance(state, arriving.select(*columns).unionByName(own), leaving.select(*columns)), path, d)
    return S.read_store(spark, path, STATE).filter(F.col("date") == F.lit(d)).drop("date")


def state_vocabulary(state: DataFrame, n_docs: DataFrame, max_features: int = C.MAX_FEATURES) -> DataFrame:
    """``scope, term, ctf, df, idf, rank`` of the corpora of a state; ``n_docs``: ``scope, n_docs``, blank documents included."""
    idf = F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0
    return (top_terms(state, ["scope"], max_features).join(n_docs.select("scope", "n_docs"), "scope")
            .select("scope", "term", "ctf", "df", idf.alias("idf"), "rank"))
