"""The bucketed registry: contents, plan of the anti-join, merging, failures."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import ingest as IG
from tidewatch.sources import registry as RG
from tidewatch.sources import store as S


def _path():
    return os.path.join(tempfile.mkdtemp(prefix="tw-registry-"), "seen")


def _ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "aid string")


def _all(spark, path):
    return sorted(r.aid for r in RG.read_ids(spark, path).collect())


def test_runs_merges_and_times(spark):
    path, rng, seen = _path(), random.Random(1), {}
    assert RG.read_ids(spark, path).count() == 0 and RG.files(spark, path) == 0
    RG.merge(spark, path)
    for k in range(4):
        names = [f"id{rng.randrange(40)}" for _ in range(12)] + [None]
        ts = dt.datetime(2024, 1, 1 + k)
        RG.append_ids(_ids(spark, names), path, str(ts), buckets=4)
        for n in set(names) - {None}:
            seen.setdefault(n, ts)
        assert set(_all(spark, path)) == set(seen)
    RG.append_ids(_ids(spark, []), path, "2024-02-01")  # nothing accepted: the run still counts
    assert S.last_run(spark, path).first().last_run == dt.datetime(2024, 2, 1)
    before = RG.files(spark, path)
    RG.merge(spark, path)
    assert {r.aid: r.first_seen for r in RG.read_ids(spark, path).collect()} == seen and _all(spark, path) == sorted(seen)
    assert RG.files(spark, path) <= 4 < before
    RG.append_ids(_ids(spark, ["id0", "later"]), path)
    RG.merge(spark, path, buckets=8)
    assert _all(spark, path) == sorted({*seen, "id0", "later"}) and RG._versions(spark, path)[-1][1] == 8
    assert len(RG._versions(spark, path)) == 2  # the one in use and the one before


def test_anti_join_has_no_exchange_of_the_registry(spark):
    path = _path()
    RG.append_ids(_ids(spark, [f"a{i}" for i in range(0, 200, 2)]), path, buckets=8)
    RG.append_ids(_ids(spark, [f"a{i}" for i in range(0, 30, 3)]), path)
    items = spark.createDataFrame([("s", f"a{i}", i) for i in range(200)], "source string, aid string, pos long")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        fresh = IG.first_per_source(items, RG.read_ids(spark, path))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        registry_side = plan[plan.index("tw_registry") - 400:]
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        # one exchange for the first row of each id, one of the items by id; none above the registry's scan
        assert plan.count("Exchange") == 2 and "Exchange" not in registry_side
        assert sorted(r.aid for r in fresh.collect()) == sorted({f"a{i}" for i in range(200)} - {f"a{i}" for i in range(0, 200, 2)} - {f"a{i}" for i in range(0, 30, 3)})
        merged = RG.read_ids(spark, path).groupBy("aid").agg(F.min("first_seen"))
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_failed_merge_leaves_the_registry(spark, monkeypatch):
    path = _path()
    RG.append_ids(_ids(spark, ["a", "b"]), path, buckets=2)
    # a merge that died: files of a new version, no mark that it is complete
    half = f"{path}/v000002-b2"
    spark.createDataFrame([("zzz", None)], "aid string, first_seen timestamp").write.parquet(half)
    os.remove(f"{half}/_SUCCESS")
    assert _all(spark, path) == ["a", "b"]
    RG.append_ids(_ids(spark, ["c"]), path)
    RG.merge(spark, path)
    assert _all(spark, path) == ["a", "b", "c"] and not os.path.exists(half)


def test_merge_when_files_pile_up(spark):
    path = _path()
    for k in range(4):
        RG.append_ids(_ids(spark, [f"x{k}", f"y{k}", "always"]), path, buckets=1)
        RG.merge_if_needed(spark, path, merge_after=2)
    assert RG.files(spark, path) <= 2 and set(_all(spark, path)) == {"always", *(f"{c}{k}" for c in "xy" for k in range(4))}


@pytest.mark.parametrize("again", [False, True])
def test_repeated_run_changes_no_result(spark, again):
    path = _path()
    for _ in range(2 if again else 1):
        RG.append_ids(_ids(spark, ["a", "b"]), path, buckets=2)
    items = spark.createDataFrame([("s", x, i) for i, x in enumerate("abc")], "source string, aid string, pos long")
    assert [r.aid for r in IG.first_per_source(items, RG.read_ids(spark, path)).collect()] == ["c"]
