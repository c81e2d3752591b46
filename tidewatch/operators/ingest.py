"""Item ingest: ids, first-wins dedup against a seen registry with a per-source
cap, and ingest statistics (P1, J1, W1-W3, D1, A2, A3, P15).

Exact rule (``mode='exact'``): sources are processed in catalog order; each
source walks its items in position order, skips ids already seen or already
accepted, and accepts up to ``cap`` ids.  Items beyond the cap are *not*
marked as seen, so a later source may still take them.

Scalable form of the exact rule: the sequential result is the unique matching in
which every id prefers the earlier source, so it can be found in rounds:

1. first position per ``(source, aid)`` by a partial aggregate (a hot group of
   copies collapses map-side), then anti-join with the registry;
2. a source with ``r`` sources before it keeps its first ``cap * (r + 1)`` ids, as those accept at most ``cap * r``
   (:func:`within_reach`: a constant limit, so ``WindowGroupLimit`` cuts a source of a third of all rows map-side);
3. every source proposes its first ``cap`` ids that no earlier source has taken from it;
4. every id keeps the earliest proposing source, the other proposals are rejected; repeat from 3
   until nothing is rejected.

A round is one per-source top-``cap`` and one aggregate by id over ``cap`` rows a source; what the rounds read is
bounded by the catalog, not by the items.  In the worst case (all sources carry one list) each round settles one source.
No step holds a run or a source in one task.

``mode='global_first'`` is the plain window form (W1 then W2): first source of
each id by ``(src_rank, pos)``, then the first ``cap`` per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.functions.ids import item_id
from tidewatch.operators._util import broadcast_if_bounded, cut_lineage


def with_item_id(items: DataFrame, url: str = "url", title: str = "title") -> DataFrame:
    """Add ``aid``."""
    return items.withColumn("aid", item_id(url, title))


def first_per_source(items: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """First position of each id in each source, minus the ids already seen.

    ``items`` needs ``source, aid, pos``; other columns ride along with the
    first row (``min`` of a struct led by ``pos``: a partial aggregate).
    """
    others = [c for c in items.columns if c not in ("source", "aid", "pos")]
    first = (items.groupBy("source", "aid")
             .agg(F.min(F.struct("pos", *others)).alias("_r"))
             .select("source", "aid", "_r.*"))
    if seen is not None:
        first = first.join(seen.select("aid"), "aid", "left_anti")
    return first


def within_reach(fresh: DataFrame, cap: int, n_sources: int) -> DataFrame:
    """The ids that the exact rule can accept: of one row per ``(source, aid)`` with ``src_rank`` (0-based) and ``pos``, the first
    ``cap * (src_rank + 1)`` of each source.  The earlier sources accept at most ``cap * src_rank`` of them, so
    ``cap`` are left.  Nothing that the rule would take is lost; ``rank`` of the kept ids doesn't change either."""
    n = F.row_number().over(Window.partitionBy("source").orderBy("pos", "aid"))
    return (fresh.withColumn("_n", n).filter(F.col("_n") <= cap * max(n_sources, 1))
            .filter(F.col("_n") <= cap * (F.col("src_rank").cast("bigint") + 1)).drop("_n"))


def matching(fresh: DataFrame, cap: int) -> DataFrame:
    """Accepted ``(source, src_rank, aid, pos, ..., rank)`` by rounds of proposals; ``rank`` is the
    in-source rank by position (everything before an accepted item was proposed once)."""
    w = Window.partitionBy("source").orderBy("pos", "aid")
    rejected = None
    while True:
        open_ids = fresh
        if rejected is not None:
            gone = rejected.select(F.col("source").alias("_source"), F.col("aid").alias("_aid"))
            open_ids = fresh.join(gone, (F.col("source") == F.col("_source")) & F.col("aid").eqNullSafe(F.col("_aid")), "left_anti")
        proposed = open_ids.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= cap).drop("_n")
        winner = F.min("src_rank").over(Window.partitionBy("aid"))  # at most one row per source
        decided = cut_lineage(proposed.withColumn("_kept", winner == F.col("src_rank")))
        lost = decided.filter(~F.col("_kept")).drop("_kept")
        if lost.isEmpty():
            break
        rejected = cut_lineage(lost if rejected is None else rejected.unionByName(lost))
    accepted = decided.withColumn("_kept", F.lit(True))
    if rejected is not None:
        accepted = accepted.unionByName(rejected.withColumn("_kept", F.lit(False)))
    return accepted.withColumn("rank", F.row_number().over(w)).filter("_kept").drop("_kept")


def dedup_capped(items: DataFrame, catalog: DataFrame, seen: DataFrame | None = None,
                 cap: int = C.ITEMS_PER_SOURCE, mode: str = "exact") -> DataFrame:
    """Accepted items of one run.

    ``items``: ``source, aid, pos, ...``; ``catalog``: ``source, src_rank`` (0-based
    order); ``seen``: ``aid``.  Returns the accepted item rows with ``src_rank``
    and in-source ``rank``.

    The dedup itself runs on the narrow keys ``(source, aid, pos)``; the
    accepted rows (at most ``cap`` per source, so bounded by the catalog) are
    fetched back from ``items`` in one pass with a broadcast semi-join.
    """
    keys = items.select("source", "aid", "pos")
    fresh = first_per_source(keys, seen)
    n_sources = catalog.count()  # size of a small dimension: bounds every limit below
    cat = broadcast_if_bounded(catalog.select("source", "src_rank"), n_sources, 64)
    if mode == "global_first":
        g = fresh.join(cat, "source", "inner")
        firsts = (g.groupBy("aid").agg(F.min(F.struct("src_rank", "pos", "source")).alias("_r"))
                  .select("aid", "_r.*"))
        w = Window.partitionBy("source").orderBy("pos", "aid")
        acc = firsts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= cap)
    elif mode == "exact":
        acc = matching(cut_lineage(within_reach(fresh.join(cat, "source", "inner"), cap, n_sources)), cap)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    acc = broadcast_if_bounded(acc.select("source", "pos", "aid", "src_rank", "rank"), cap * max(n_sources, 1), 96)
    # (source, pos) identifies an item; the id comes from the accepted side so the
    # hash over the whole row is not computed again
    return items.drop("aid").join(acc, ["source", "pos"], "inner")


def ingest_stats(raw: DataFrame, accepted: DataFrame, catalog: DataFrame,
                 timings: DataFrame | None = None) -> DataFrame:
    """Per source of the catalog: ``source, method, status, fetched, new, elapsed_s``.

    ``status`` is ``ok`` iff at least one raw row came; a source missing from
    ``raw`` shows up with ``fetched = 0`` and ``fail`` (left join from the catalog).
    """
    fetched = raw.groupBy("source").agg(F.count("*").alias("fetched"))
    new = accepted.groupBy("source").agg(F.count("*").alias("new"))
    cat = catalog.select("source", "method", "src_rank")
    out = (cat.join(fetched, "source", "left").join(new, "source", "left")
           .withColumn("fetched", F.coalesce("fetched", F.lit(0)).cast("bigint"))
           .withColumn("new", F.coalesce("new", F.lit(0)).cast("bigint"))
           .withColumn("status", F.when(F.col("fetched") > 0, F.lit("ok")).otherwise(F.lit("fail"))))
    if timings is not None:
        out = out.join(timings.select("source", "elapsed_s"), "source", "left")
    else:
        out = out.withColumn("elapsed_s", F.lit(None).cast("double"))
    return out.select("source", "method", "status", "fetched", "new",
                      F.round("elapsed_s", 2).alias("elapsed_s"), "src_rank")


def run_totals(stats: DataFrame) -> DataFrame:
    """Per-source rows and the run total (``source`` null) in one pass (A3)."""
    return (stats.rollup("source")
            .agg(F.sum("fetched").cast("bigint").alias("fetched"),
                 F.sum("new").cast("bigint").alias("new"),
                 F.round(F.sum("elapsed_s"), 1).alias("elapsed_s"),
                 F.count_if(F.col("status") == "ok").alias("ok_count"),
                 F.count_if(F.col("status") == "fail").alias("fail_count")))
