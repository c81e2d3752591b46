"""Capped first-wins dedup of a stream (D1 over micro-batches).

The accepted items of a run depend on all its items: a late item of an early source can take an id
from a later one, whose place then goes to an item that was beyond its cap.  So proposals beyond the cap stay
open, but not all of them: the sources before one of rank ``r`` accept at most ``cap * r`` ids, so it never needs more
than its first ``cap * (r + 1)`` ids (``ingest.within_reach``).  An id beyond these stays beyond when more rows come, as
ids only join a source or move forward in it.  The state therefore has a proven bound that doesn't grow with the stream,
and after every micro-batch :func:`accepted` equals the sequential rule over all rows so far.

Layout below ``path``, by epoch: ``state`` has the open keys after an epoch, ``rows`` the whole items whose
key came into reach in it.  An epoch counts when its ``rows`` are there.  A replayed epoch starts from the state of the one before
and replaces both, so replays and restarts change nothing.  A path belongs to one checkpoint and one run: register the accepted
ids at its end (``registry.append_ids``) and take a new path.

Defined cases: rows of sources outside the catalog are left out; a null position comes first, a null id is an id; of rows with equal source, id
and position the one with the least other columns stays; an empty epoch keeps the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch import constants as C
from tidewatch.operators._util import broadcast_if_bounded
from tidewatch.operators.ingest import first_per_source, matching, within_reach
from tidewatch.sources import store as S

STATE = "source string, src_rank int, aid string, pos bigint, epoch bigint"


def _epochs(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(value) for value, _ in S.partitions(spark, path, "epoch"))


def write_candidates(path: str, catalog: DataFrame, seen: DataFrame | None = None, cap: int = C.ITEMS_PER_SOURCE):
    """``foreachBatch`` function for ``(source, aid, pos, ...)`` rows.  ``seen``: ids of earlier runs, the
    same during a run."""
    n_sources = catalog.count()
    cat = broadcast_if_bounded(catalog.select("source", F.col("src_rank").cast("int").alias("src_rank")), n_sources, 64)

    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        items = batch.withColumn("pos", F.col("pos").cast("bigint"))
        known = (first_per_source(items.select("source", "aid", "pos"), seen).join(cat, "source")
                 .withColumn("epoch", F.lit(epoch_id).cast("bigint")))
        before = [e for e in _epochs(spark, f"{path}/rows") if e < epoch_id]
        if before:
            known = known.unionByName(spark.read.schema(STATE).parquet(f"{path}/state/version={before[-1]}"))
        first = (known.groupBy("source", "src_rank", "aid").agg(F.min(F.struct("pos", "epoch")).alias("_r"))
                 .select("source", "src_rank", "aid", "_r.*"))
        S.replace_day(within_reach(first, cap, n_sources), f"{path}/state", epoch_id, date_col="version")
        new = (spark.read.schema(STATE).parquet(f"{path}/state/version={epoch_id}").filter(F.col("epoch") == epoch_id)
               .select(*(F.col(c).alias(f"_{c}") for c in ("source", "aid", "pos"))))
        entered = items.join(new, (F.col("source") == F.col("_source")) & F.col("aid").eqNullSafe(F.col("_aid"))
                             & F.col("pos").eqNullSafe(F.col("_pos")), "left_semi")
        S.replace_day(first_per_source(entered), f"{path}/rows", epoch_id, date_col="epoch")
        S.drop_partitions(spark, f"{path}/state", "version", [str(e) for e in before[:-1]])

    return run


def run_capped_stream(stream: DataFrame, path: str, checkpoint_dir: str, catalog: DataFrame,
                      seen: DataFrame | None = None, cap: int = C.ITEMS_PER_SOURCE) -> None:
    """Drain a stream of items (trigger ``availableNow``)."""
    (stream.writeStream.foreachBatch(write_candidates(path, catalog, seen, cap))
     .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start().awaitTermination())


def accepted(spark: SparkSession, path: str, cap: int = C.ITEMS_PER_SOURCE) -> DataFrame:
    """The accepted items after the newest complete epoch, with ``src_rank`` and in-source ``rank``
    (what ``ingest.dedup_capped`` gives for all rows so far)."""
    epochs = _epochs(spark, f"{path}/rows")
    if not epochs:
        raise FileNotFoundError(f"no complete epoch below {path}")
    keys = matching(spark.read.schema(STATE).parquet(f"{path}/state/version={epochs[-1]}"), cap)
    rows = spark.read.parquet(f"{path}/rows").withColumn("epoch", F.col("epoch").cast("bigint"))
    keys = keys.select(*(F.col(c).alias(f"_{c}") for c in ("source", "aid", "epoch")), "src_rank", "rank")
    return (rows.join(keys, (F.col("source") == F.col("_source")) & F.col("aid").eqNullSafe(F.col("_aid"))
                      & (F.col("epoch") == F.col("_epoch")))
            .drop("_source", "_aid", "_epoch", "epoch"))
