"""Capped dedup of a stream against the sequential rule, over random batch cuts."""
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import ingest as IG
from tidewatch.sources import store as S
from tidewatch.streaming import capped as CP
from tidewatch.streaming import streams as ST
from twins import capped_first_wins

ROW = "source string, aid string, pos long, title string"


def _catalog(spark, n):
    return spark.createDataFrame([(f"s{s}", s, "RSS") for s in range(n)], "source string, src_rank int, method string")


def _sequential(rows, n, seen, cap):
    lists = [[aid for _, aid in sorted((pos, aid) for s, aid, pos, _ in rows if s == f"s{k}")] for k in range(n)]
    return sorted(capped_first_wins(lists, seen, cap))


def _got(spark, path, cap):
    return sorted((r.src_rank, r.aid) for r in CP.accepted(spark, path, cap).collect())


@pytest.mark.parametrize("seed", [3, 8])
def test_random_batch_cuts_equal_the_sequential_rule(spark, seed):
    rng = random.Random(seed)
    n, cap, seen = 4, 2, {"i1", "i5"}
    rows = [(f"s{s}", f"i{rng.randrange(14)}", p, f"t{s}-{p}") for s in range(n) for p in range(12)]
    rng.shuffle(rows)  # positions arrive in any order
    path = tempfile.mkdtemp(prefix="tw-capped-")
    write = CP.write_candidates(path, _catalog(spark, n), spark.createDataFrame([(a,) for a in seen], "aid string"), cap)
    cuts = sorted(rng.sample(range(1, len(rows)), 3))
    done = []
    for epoch, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        batch = spark.createDataFrame(rows[a:b], ROW)
        write(batch, epoch)
        if rng.random() < 0.5:
            write(batch, epoch)  # a replay
        done += rows[a:b]
        assert _got(spark, path, cap) == _sequential(done, n, seen, cap)
    titles = {(s, aid, p): t for s, aid, p, t in rows}
    out = CP.accepted(spark, path, cap).collect()
    assert all(r.title == titles[r.source, r.aid, r.pos] for r in out)
    batch_rank = {(r.source, r.aid): r["rank"] for r in IG.dedup_capped(
        spark.createDataFrame(rows, ROW), _catalog(spark, n), spark.createDataFrame([(a,) for a in seen], "aid string"), cap).collect()}
    assert {(r.source, r.aid): r["rank"] for r in out} == batch_rank


def test_late_item_hands_a_place_to_one_beyond_the_cap(spark):
    path = tempfile.mkdtemp(prefix="tw-capped-")
    write = CP.write_candidates(path, _catalog(spark, 2), cap=1)
    write(spark.createDataFrame([("s1", "a", 0, "x"), ("s1", "b", 1, "y")], ROW), 0)
    assert _got(spark, path, 1) == [(1, "a")]
    write(spark.createDataFrame([("s0", "a", 0, "z")], ROW), 1)
    assert _got(spark, path, 1) == [(0, "a"), (1, "b")]


def test_failed_epoch_and_odd_rows(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="tw-capped-")
    write = CP.write_candidates(path, _catalog(spark, 2), cap=1)
    write(spark.createDataFrame([("s0", "a", 3, "x"), ("s0", None, 4, "n"), (None, "q", 0, "n"), ("other", "q", 0, "n")], ROW), 0)
    assert _got(spark, path, 1) == [(0, "a")]
    late = spark.createDataFrame([("s0", "b", None, "first"), ("s1", "b", 0, "y"), ("s1", None, 1, "n")], ROW)
    replace, calls = S.replace_day, []

    def failing(df, at, day, date_col="date"):
        calls.append(at)
        if at.endswith("/rows"):
            raise OSError("lost")
        replace(df, at, day, date_col)

    monkeypatch.setattr(S, "replace_day", failing)
    with pytest.raises(OSError):
        write(late, 1)
    assert _got(spark, path, 1) == [(0, "a")]  # the epoch doesn't count
    monkeypatch.setattr(S, "replace_day", replace)
    write(late, 1)
    write(late.limit(0), 2)
    assert sorted(((r.src_rank, r.aid, r.title) for r in CP.accepted(spark, path, 1).collect()), key=str) == [(0, "b", "first"), (1, None, "n")]
    assert len(S.partitions(spark, f"{path}/state", "version")) == 2


def test_state_is_bounded_by_the_catalog(spark):
    path = tempfile.mkdtemp(prefix="tw-capped-")
    write = CP.write_candidates(path, _catalog(spark, 3), cap=2)
    for epoch in range(3):
        write(spark.range(3000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.concat(F.lit(f"{epoch}-"), F.col("id")).alias("aid"),
                                       (F.col("id") + 3000 * epoch).alias("pos"), F.lit("t").alias("title")), epoch)
    state = spark.read.schema(CP.STATE).parquet(f"{path}/state/version=2")
    assert state.count() == 2 * (1 + 2 + 3)
    assert spark.read.parquet(f"{path}/rows").count() == 12
    with pytest.raises(FileNotFoundError):
        CP.accepted(spark, f"{path}/none")


def test_stream_goes_on_after_a_restart(spark):
    src = tempfile.mkdtemp(prefix="tw-capped-src-")
    out, state = ST.scratch_dirs(spark, "t-capped")
    rows = [(f"s{i % 2}", f"i{(i * 7) % 9}", i, "t") for i in range(24)]
    for k in range(3):
        spark.createDataFrame(rows[8 * k:8 * k + 8], ROW).coalesce(1).write.parquet(f"{src}/{k}")
        stream = spark.readStream.schema(ROW).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(src)
        CP.run_capped_stream(stream, out, state, _catalog(spark, 2), cap=3)
        assert _got(spark, out, 3) == _sequential(rows[:8 * k + 8], 2, set(), 3)
