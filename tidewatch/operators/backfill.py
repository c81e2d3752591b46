"""Every day against its own history, all days at once.

A corpus is (scope, day): the documents of the ``days`` days before it and its own, with a vocabulary
and idf of its own.  The corpora overlap, so instead of one copy of the term counts a corpus, the
corpus statistics of a term are running sums over its *events*: a document's count arrives on its day and leaves
``days + 1`` days later.  Between two events they are constant (an *interval*).

1. :func:`sliding_statistics`: one shuffle by (scope, term); two rows a term count, whatever the number of days.
2. :func:`vocabulary_cuts`: per corpus the count of its last vocabulary term, from a histogram of
   the intervals (how many terms have which count, again by running sums): no sorting of terms.
3. :func:`sliding_vocabulary`: only intervals above their corpora's cuts are unfolded into days; only
   terms that tie with the cut are ranked.
4. :func:`similarity_backfill`: the kept terms (``max_features`` a corpus) meet the counts of their
   scope and term once; dot products and norms are partial sums.

The number of jobs doesn't depend on the number of days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.operators._util import materialized
from tidewatch.operators.vectors import above_cut, histogram_cuts

KEY = ["scope", "term"]


def sliding_statistics(tf: DataFrame, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """``scope, term, start, until, ctf, df, arrived``: total count and document frequency of the
    term in the corpus of every day in ``[start, until)``; ``arrived`` is the term's count on the day ``start``.

    ``tf``: ``(scope, date, term, tf)``, one row per key."""
    comes = tf.select(*KEY, F.col("date").alias("at"), F.col("tf").alias("tf"), F.lit(1).alias("n"), F.col("tf").alias("arrived"))
    goes = tf.select(*KEY, F.date_add("date", days + 1).alias("at"), (-F.col("tf")).alias("tf"), F.lit(-1).alias("n"), F.lit(0).alias("arrived"))
    # one exchange serves the grouping and the windows
    events = comes.unionByName(goes).repartition(*KEY).groupBy(*KEY, "at").agg(
        F.sum("tf").alias("tf"), F.sum("n").alias("n"), F.sum("arrived").alias("arrived"))
    by = Window.partitionBy(*KEY).orderBy("at")
    sofar = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.select(*KEY, F.col("at").alias("start"), F.lead("at").over(by).alias("until"),
                         F.sum("tf").over(sofar).alias("ctf"), F.sum("n").over(sofar).alias("df"), "arrived").filter("df > 0")


def record_days(records: DataFrame) -> DataFrame:
    """The existing days as ``day``."""
    return records.select(F.col("date").alias("day")).distinct().filter(F.col("day").isNotNull())


def vocabulary_cuts(intervals: DataFrame, records: DataFrame, max_features: int = C.MAX_FEATURES) -> DataFrame:
    """``scope, day, cut, above``: the count of the last term of each corpus' vocabulary and the number of terms with a
    larger count (``cut`` 0, if all terms fit)."""
    level = ["scope", "ctf"]
    ends = F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("until").alias("at"), F.lit(-1).alias("d"))))
    steps = (intervals.select(*level, ends.alias("e")).groupBy(*level, "e.at").agg(F.sum("e.d").alias("d")).filter("d <> 0"))
    by = Window.partitionBy(*level).orderBy("at")
    counts = steps.select(*level, F.col("at").alias("start"), F.lead("at").over(by).alias("until"),
                          F.sum("d").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("terms")).filter("terms > 0")
    daily = counts.select(*level, "terms", F.explode(F.sequence("start", F.date_sub("until", 1))).alias("day")).join(record_days(records), "day", "left_semi")
    return histogram_cuts(daily, ["scope", "day"], max_features)


def sliding_vocabulary(tf: DataFrame, records: DataFrame, days: int = C.LOOKBACK_DAYS, max_features: int = C.MAX_FEATURES) -> DataFrame:
    """``scope, day, term, ctf, df, qtf``: the kept terms of the corpus of every record day (K6, V3): the
    ``max_features`` most frequent, ties by term; ``qtf`` is the count on the day itself."""
    intervals = materialized(sliding_statistics(tf, days))
    cuts = materialized(vocabulary_cuts(intervals, records, max_features))
    least = cuts.groupBy("scope").agg(F.min("cut").alias("least"), F.max("day").alias("last"))
    open_ = intervals.join(least, "scope").filter((F.col("ctf") >= F.col("least")) & (F.col("start") <= F.col("last")))
    until = F.least(F.date_sub("until", 1), F.col("last"))
    daily = (open_.select(*KEY, "ctf", "df", "arrived", "start", F.explode(F.sequence("start", until)).alias("day"))
             .join(cuts, ["scope", "day"]).filter(F.col("ctf") >= F.col("cut"))
             .select("scope", "day", "term", "ctf", "df", F.when(F.col("day") == F.col("start"), F.col("arrived")).otherwise(0).alias("qtf"),
                     "cut", "above"))
    return above_cut(daily, ["scope", "day"], max_features)


def corpus_days(tf: DataFrame, records: DataFrame, scopes: DataFrame, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """``scope, day, date, is_query, nonblank``: the documents of the corpus of every record day, blank ones too.
    At most (days + 1) rows a corpus."""
    day = record_days(records)
    own = scopes.select("scope").distinct().join(tf.select("scope", "date").distinct().withColumn("nonblank", F.lit(True)), "scope", "left")
    # every scope has every record day: unfold the calendar between a scope's first and last possible day
    span = day.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    spine = (scopes.select("scope").distinct().withColumns({"lo": lo, "hi": hi}).filter("lo is not null")
             .select("scope", F.explode(F.sequence("lo", "hi")).alias("date")).join(day.withColumnRenamed("day", "date"), "date", "left_semi"))
    docs = spine.join(own.filter("date is not null"), ["scope", "date"], "left").withColumn("nonblank", F.coalesce("nonblank", F.lit(False)))
    members = docs.select("scope", "date", "nonblank", F.explode(F.sequence("date", F.date_add("date", days))).alias("day"))
    return members.join(day, "day", "left_semi").withColumn("is_query", F.col("day") == F.col("date"))


def similarity_backfill(tf: DataFrame, records: DataFrame, scopes: DataFrame, days: int = C.LOOKBACK_DAYS,
                        max_features: int = C.MAX_FEATURES, min_nonblank: int = 2) -> DataFrame:
    """``scope, day, date, sim, n_docs, n_nonblank`` for every record day and each of its history days: what
    ``tfidf_similarity`` gives for one day (V6), for all days in one plan.

    ``records``: the existing days (``date``); ``scopes``: the scopes (``scope``).  Corpora with fewer than
    ``min_nonblank`` non-blank documents have no rows (V7)."""
    tf = materialized(tf)
    members = materialized(corpus_days(tf, records, scopes, days))
    corpus = ["scope", "day"]
    sizes = members.groupBy(*corpus).agg(F.count("*").alias("n_docs"), F.count_if("nonblank").alias("n_nonblank")).filter(F.col("n_nonblank") >= min_nonblank)
    idf = F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0
    vocabulary = (sliding_vocabulary(tf, records, days, max_features).join(sizes, corpus)
                  .select(*corpus, "term", idf.alias("idf"), (F.col("qtf") * idf).alias("wq")))
    w = F.col("tf") * F.col("idf")
    near = (F.col("date") <= F.col("day")) & (F.col("date") >= F.date_sub("day", days))
    sums = (tf.select("scope", "date", "term", "tf").join(vocabulary, KEY).filter(near)
            .groupBy(*corpus, "date").agg(F.sum(w * w).alias("nn"), F.sum(w * F.col("wq")).alias("dot")))
    own = F.max(F.when(F.col("is_query"), F.col("nn"))).over(Window.partitionBy(*corpus))
    rows = members.join(sizes, corpus).join(sums, [*corpus, "date"], "left").withColumn("qnn", own)
    sim = F.when((F.col("nn") > 0) & (F.col("qnn") > 0), F.col("dot") / F.sqrt(F.col("nn") * F.col("qnn"))).otherwise(0.0)
    return rows.filter("not is_query").select(*corpus, "date", sim.alias("sim"), "n_docs", "n_nonblank")
