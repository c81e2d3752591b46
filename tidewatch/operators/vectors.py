"""Character n-gram TF-IDF and cosine similarity of a day against its history (V1-V7).

Long form throughout: a "document" is one ``(corpus, date)``; a corpus is a
scope (dimension, language, ...) or any other key such as a day pair.

Plan (one job graph):

1. texts dealt out by ``(scope, date)``, so a task has few documents and counts the longest n-gram of every place
   in integers (``functions.ngrams.window_counts``): what leaves it grows with distinct n-grams, not with words;
2. the shorter n-grams are their prefixes, summed per ``(scope, date, term)`` -> ``tf``;
3. corpus statistics per ``(corpus, term)``: total count and document frequency;
4. vocabulary = top ``max_features`` terms per corpus (``WindowGroupLimit`` keeps
   only that many per partition before the shuffle);
5. weights ``tf * idf`` joined with the query day's weights (at most
   ``max_features`` per corpus) and reduced to ``dot`` and ``norm`` per document.

Semantics follow a char_wb vectorizer with n = 2..4, smoothed idf
``ln((1+n)/(1+df)) + 1``, L2 normalisation and cosine; blank texts are zero
vectors (similarity 0) but count in ``n``.  Ties at the vocabulary cut are
broken by term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.functions.ngrams import explode_prefixes, window_counts
from tidewatch.operators._util import broadcast_if_bounded, day_lit, materialized


def term_counts(texts: DataFrame, keys: Sequence[str] = ("scope",), date_col: str = "date",
                text_col: str = "text", lo: int = C.NGRAM_MIN, hi: int = C.NGRAM_MAX) -> DataFrame:
    """``(keys..., date, term, tf)``: n-gram counts of every text, whole text (V1, V2).

    Several rows with the same key and date form one document (their texts
    joined by blanks): n-grams never cross words, so counts just add up.
    """
    keys = list(keys)
    # by document, in even partitions (sized and split by AQE)
    texts = (texts.select(*keys, F.col(date_col).alias("date"), F.col(text_col).alias("text"))
             .hint("rebalance", *[F.col(k) for k in (*keys, "date")]))
    windows = window_counts(texts, [*keys, "date"], "text", lo, hi)
    grams = explode_prefixes(windows, "window", lo, hi, keep=[*keys, "date", "n"])
    return grams.groupBy(*keys, "date", "term").agg(F.sum("n").alias("tf"))


def with_combined(tf: DataFrame, scope: str = C.COMBINED_SCOPE) -> DataFrame:
    """``tf`` plus the counts of a concatenation of all scopes of a day (scope
    ``_combined``), derived from ``tf`` without re-reading the texts.

    The scope comes out of an ``explode`` of ``[scope, '_combined']``, never as
    a bare literal: a literal corpus key would let the optimizer fold the
    corpus join condition to ``true`` and plan a keyless join.
    """
    x = tf.select(F.explode(F.array(F.col("scope"), F.lit(scope))).alias("scope"), "date", "term", "tf")
    return x.groupBy("scope", "date", "term").agg(F.sum("tf").alias("tf"))


def merge_scopes(tf: DataFrame, scope: str = C.COMBINED_SCOPE) -> DataFrame:
    """Only the ``_combined`` counts of :func:`with_combined`: summed per
    ``(date, term)`` first, the scope attached after the aggregation (through a
    one-element explode, for the same reason as above)."""
    merged = tf.groupBy("date", "term").agg(F.sum("tf").alias("tf"))
    return merged.select(F.explode(F.array(F.lit(scope))).alias("scope"), "date", "term", "tf")


def day_members(texts_dates: DataFrame, scopes: DataFrame, day, days: int = C.LOOKBACK_DAYS) -> DataFrame:
    """Corpus membership for "day against its history": every scope gets every
    record day of ``[d-days, d]`` (blank or not); ``is_query`` marks ``d``.

    ``texts_dates`` holds the record days (``date``), ``scopes`` the scopes.
    Dates come from a bounded ``sequence`` per scope and a semi-join with the
    record days (at most ``days + 1`` rows), so no cross product is formed.
    """
    d = day_lit(day)
    recs = (texts_dates.select("date").distinct()
            .filter((F.col("date") >= F.date_sub(d, days)) & (F.col("date") <= d)))
    recs = F.broadcast(recs)  # bounded: at most days + 1 rows
    cand = scopes.select("scope", F.explode(F.sequence(F.date_sub(d, days), d)).alias("date"))
    return (cand.join(recs, "date", "left_semi")
            .withColumn("is_query", F.col("date") == d))


def corpus_terms(tf: DataFrame, members: DataFrame, text_keys: Sequence[str] = ("scope",),
                 corpus_keys: Sequence[str] = ("scope",)) -> DataFrame:
    """``(corpus..., date, is_query, term, tf)``: term counts of every member document."""
    ck, tk = list(corpus_keys), list(text_keys)
    mem = members.select(*list(dict.fromkeys(ck + tk + ["date", "is_query"])))
    return tf.join(mem, tk + ["date"], "inner").select(*ck, "date", "is_query", "term", "tf")


def corpus_sizes(ct: DataFrame, members: DataFrame, corpus_keys: Sequence[str] = ("scope",),
                 min_nonblank: int = 2) -> DataFrame:
    """``(corpus..., n_docs, n_nonblank)`` of corpora passing the guard."""
    ck = list(corpus_keys)
    n_docs = members.groupBy(*ck).agg(F.count("*").alias("n_docs"))
    n_nonblank = ct.select(*ck, "date").distinct().groupBy(*ck).agg(F.count("*").alias("n_nonblank"))
    return (n_docs.join(n_nonblank, ck, "left")
            .withColumn("n_nonblank", F.coalesce("n_nonblank", F.lit(0)))
            .filter(F.col("n_nonblank") >= min_nonblank))


def term_pieces(term: str, slices: int = 64) -> Column:
    """Hash slice of a term: large corpora are ranked slice by slice first."""
    return F.pmod(F.xxhash64(term), F.lit(slices))


def top_terms(stats: DataFrame, ck: list[str], max_features: int, slices: int = 64) -> DataFrame:
    """The first ``max_features`` terms of each corpus by count, with their ``rank``.

    Two levels: within hash slices of a corpus, then over what is left, so the task of a
    corpus sorts at most ``slices * max_features`` rows, however many partitions there are.
    """
    order = [F.col("ctf").desc(), F.col("term")]
    cut = (stats.withColumn("_piece", term_pieces("term", slices))
           .withColumn("rank", F.row_number().over(Window.partitionBy(*ck, "_piece").orderBy(*order)))
           .filter(F.col("rank") <= max_features).drop("_piece"))
    return (cut.withColumn("rank", F.row_number().over(Window.partitionBy(*ck).orderBy(*order)))
            .filter(F.col("rank") <= max_features))


def histogram_cuts(counts: DataFrame, ck: list[str], max_features: int) -> DataFrame:
    """``ck..., cut, above`` from ``(ck..., ctf, terms)``, the number of terms of each count: the count of the last of the
    ``max_features`` most frequent terms and how many terms have a larger one (``cut`` 0: all terms fit)."""
    down = Window.partitionBy(*ck).orderBy(F.col("ctf").desc())
    ranked = counts.withColumn("upto", F.sum("terms").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.col("upto") >= max_features
    return ranked.groupBy(*ck).agg(
        F.coalesce(F.max(F.when(last, F.col("ctf"))), F.lit(0)).alias("cut"),
        F.coalesce(F.max_by(F.when(last, F.col("upto") - F.col("terms")), F.when(last, F.col("ctf"))), F.lit(0)).alias("above"))


def above_cut(terms: DataFrame, ck: list[str], max_features: int) -> DataFrame:
    """Of ``terms`` with their corpus' ``cut`` and ``above`` joined, the ``max_features`` most frequent, ties by term.  Only
    ties are ranked, in two levels, so a corpus with very many of them is no single task."""
    columns = [c for c in terms.columns if c not in ("cut", "above")]
    first = Window.partitionBy(*ck, "_piece").orderBy("term")
    ties = (terms.filter("ctf = cut").withColumn("_piece", term_pieces("term"))
            .withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= max_features)
            .withColumn("_rank", F.row_number().over(Window.partitionBy(*ck).orderBy("term")))
            .filter((F.col("_rank") <= max_features) & (F.col("_rank") <= max_features - F.col("above"))))
    return terms.filter("ctf > cut").select(*columns).unionByName(ties.select(*columns))


def _vocab(ct: DataFrame, sizes: DataFrame, ck: list[str], max_features: int) -> DataFrame:
    """Kept terms per corpus with ``idf``, corpus statistics and the query day's count."""
    stats = ct.groupBy(*ck, "term").agg(
        F.sum("tf").alias("ctf"), F.count("*").alias("df"),
        F.max(F.when(F.col("is_query"), F.col("tf"))).alias("qtf"))
    idf = F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0
    return (top_terms(stats, ck, max_features)
            .join(sizes.select(*ck, "n_docs"), ck, "inner")
            .select(*ck, "term", "ctf", "df", "rank", idf.alias("idf"),
                    (F.coalesce(F.col("qtf"), F.lit(0)) * idf).alias("wq")))


def _sizes(members: DataFrame, ck: list[str]) -> tuple[int, int]:
    """``(rows, corpora)`` of the materialised membership table: one small
    action giving the exact size bounds for the broadcasts below."""
    r = members.agg(F.count("*").alias("n"), F.count_distinct(*ck).alias("c")).first()
    return int(r["n"]), int(r["c"])


def tfidf_similarity(tf: DataFrame, members: DataFrame, text_keys: Sequence[str] = ("scope",),
                     corpus_keys: Sequence[str] = ("scope",), max_features: int = C.MAX_FEATURES,
                     min_nonblank: int = 2, state: DataFrame | None = None) -> DataFrame:
    """Cosine similarity of the query document of each corpus with every other member (V6).

    ``members``: ``(corpus_keys..., text_keys..., date, is_query)``, one query row
    per corpus.  Returns ``(corpus_keys..., date, sim, n_docs, n_nonblank)`` for the
    non-query members of corpora with at least ``min_nonblank`` non-blank
    documents; a blank or vocabulary-less member has ``sim = 0``.  ``state`` gives the corpora's
    ``(corpus_keys..., term, ctf, df)`` where they are kept (``operators.rolling``): then only the query
    documents are added to it, and the window's counts are not aggregated again.

    Plan: ``tf`` (materialise it when it comes from a long lineage) is read by
    two aggregations only: corpus statistics (which also carry the query day's
    count, so no self-join for the query vector) and per-document ``dot``/``norm``
    sums.  Membership and vocabulary are broadcast behind a proven row bound
    (corpora x days, corpora x ``max_features``); the per-corpus query norm and
    non-blank count come from a window over the tiny per-document table.
    """
    ck = list(corpus_keys)
    tk = list(text_keys)
    # the membership table is tiny (corpora x days) but read by four branches:
    # materialise it once instead of re-deriving it from the source tables
    mem = materialized(members).select(*list(dict.fromkeys(ck + tk + ["date", "is_query"])))
    n_rows, n_corpora = _sizes(mem, ck)
    mem_b = broadcast_if_bounded(mem, n_rows, 64)
    ct = tf.join(mem_b, tk + ["date"], "inner").select(*ck, "date", "is_query", "term", "tf")
    n_docs = mem.groupBy(*ck).agg(F.count("*").alias("n_docs"))

    if state is None:
        stats = ct.groupBy(*ck, "term").agg(
            F.sum("tf").alias("ctf"), F.count("*").alias("df"),
            F.max(F.when(F.col("is_query"), F.col("tf"))).alias("qtf"))
    else:
        query = ct.filter("is_query").select(*ck, "term", F.lit(0).alias("ctf"), F.lit(0).alias("df"), F.col("tf").alias("qtf"))
        kept = state.select(*ck, "term", "ctf", "df", F.lit(None).cast("bigint").alias("qtf"))
        stats = kept.unionByName(query).groupBy(*ck, "term").agg(*[F.sum(c).alias(c) for c in ("ctf", "df", "qtf")])
    idf = F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0
    vocab = (top_terms(stats, ck, max_features)
             .join(n_docs, ck, "inner")
             .select(*ck, "term", idf.alias("idf"), (F.coalesce(F.col("qtf"), F.lit(0)) * idf).alias("wq")))
    vocab = broadcast_if_bounded(vocab, n_corpora * max_features, 64)

    # every non-blank member document keeps a row (left join), even without kept terms
    w = F.col("tf") * F.col("idf")
    docs = (ct.join(vocab, ck + ["term"], "left")
            .groupBy(*ck, "date")
            .agg(F.coalesce(F.sum(w * w), F.lit(0.0)).alias("nn"),
                 F.coalesce(F.sum(w * F.col("wq")), F.lit(0.0)).alias("dot"),
                 F.lit(True).alias("nonblank")))
    per_corpus = Window.partitionBy(*ck)
    out = (mem.select(*ck, "date", "is_query").distinct()
           .join(docs, ck + ["date"], "left")
           .join(n_docs, ck, "inner")
           .withColumn("qnn", F.max(F.when(F.col("is_query"), F.col("nn"))).over(per_corpus))
           .withColumn("n_nonblank", F.count("nonblank").over(per_corpus)))
    sim = F.when((F.col("nn") > 0) & (F.col("qnn") > 0),
                 F.col("dot") / F.sqrt(F.col("nn") * F.col("qnn"))).otherwise(F.lit(0.0))
    return (out.filter(~F.col("is_query") & (F.col("n_nonblank") >= min_nonblank))
            .select(*ck, "date", sim.alias("sim"), "n_docs", "n_nonblank"))


def vocabulary(tf: DataFrame, members: DataFrame, text_keys: Sequence[str] = ("scope",),
               corpus_keys: Sequence[str] = ("scope",), max_features: int = C.MAX_FEATURES,
               min_nonblank: int = 2) -> DataFrame:
    """``(corpus..., term, ctf, df, idf, rank)``: the kept terms of each corpus (V3, V4)."""
    ck = list(corpus_keys)
    members = materialized(members)
    ct = corpus_terms(tf, members, text_keys, corpus_keys)
    sizes = corpus_sizes(ct, members, ck, min_nonblank)
    return _vocab(ct, sizes, ck, max_features).select(*ck, "term", "ctf", "df", "idf", "rank")


def tfidf_weights(tf: DataFrame, members: DataFrame, text_keys: Sequence[str] = ("scope",),
                  corpus_keys: Sequence[str] = ("scope",), max_features: int = C.MAX_FEATURES,
                  min_nonblank: int = 2) -> DataFrame:
    """``(corpus..., date, term, weight)``: L2-normalised weights per document (V5)."""
    ck = list(corpus_keys)
    members = materialized(members)
    ct = corpus_terms(tf, members, text_keys, corpus_keys)
    sizes = corpus_sizes(ct, members, ck, min_nonblank)
    vocab = _vocab(ct, sizes, ck, max_features).select(*ck, "term", "idf")
    w = ct.join(vocab, ck + ["term"], "inner").withColumn("w", F.col("tf") * F.col("idf"))
    norms = w.groupBy(*ck, "date").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return (w.join(norms, ck + ["date"], "inner")
            .select(*ck, "date", "term", (F.col("w") / F.col("norm")).alias("weight")))
