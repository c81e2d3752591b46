"""Schema-free analysis documents against plain Python, the run log's numbers, and Python-equal rounding."""

import datetime as dt
import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch import constants as C
from tidewatch.functions.rounding import py_round
from tidewatch.operators import analysis as AN
from tidewatch.operators import reports as RP
from tidewatch.plans import reports as PR
from tidewatch.operators import vectors as V


def _flat(dim):
    if not isinstance(dim, dict):
        return ""
    parts = [v for k, v in dim.items() if k not in ("has_change", "intensity", "evidence") and isinstance(v, str) and v]
    evidence = dim.get("evidence")
    for e in evidence if isinstance(evidence, list) else []:
        if isinstance(e, dict):
            parts.append(e["title"] if isinstance(e.get("title"), str) else "")
    return " ".join(parts)


def _random_value(rng, depth=0):
    kind = rng.randrange(9)
    if kind < 4:
        return rng.choice(["", "a text", "Ünïcode \"quoted\" \\ / \n line", "5", "null", "{}", " "])
    if kind < 6 or depth > 1:
        return rng.choice([None, True, 0, -1.5, 10 ** 20])
    if kind == 6:
        return [_random_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {f"k{i}": _random_value(rng, depth + 1) for i in range(rng.randint(0, 3))}


def _random_dimension(rng):
    if rng.random() < 0.1:
        return rng.choice([None, "words", 3, ["x"]])
    keys = ["zeta", "alpha", "model_capability", "has_change", "intensity", "evidence", "with space", "dot.ted", "题目"]
    out = {k: _random_value(rng) for k in rng.sample(keys, rng.randint(0, len(keys)))}
    if rng.random() < 0.6:
        out["evidence"] = [rng.choice([{"title": "T1", "source": "S", "url": "u"}, {"url": "v"}, {"title": None}, {"title": 7}, "plain", 3, None])
                           for _ in range(rng.randint(0, 4))]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_flatten_in_document_order(spark, seed):
    rng = random.Random(seed)
    docs = []
    for i in range(150):
        names = C.DIMENSIONS + ["weather", "sports"]
        doc = {"keywords": rng.sample(["a", "b", "c"], 2), "dimensions": {d: _random_dimension(rng) for d in rng.sample(names, rng.randint(0, 7))}}
        for key in ("title", "core_insight"):
            if rng.random() < 0.8:
                doc[key] = rng.choice(["", "Some title", "x y"])
        doc["date"] = str(dt.date(2024, 1, 1) + dt.timedelta(days=i))
        docs.append(doc)
    raw = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=bool(i % 2))) for i, d in enumerate(docs)], "id long, raw string")
    good, bad = AN.parse_documents(raw, keep=("id",))
    assert bad.count() == 0
    got = {(r.id, r.scope): r.text for r in AN.day_texts(good, keep=("id",), extra=True).collect()}
    want = {}
    for i, doc in enumerate(docs):
        texts = {d: _flat(doc["dimensions"].get(d)) for d in C.DIMENSIONS}
        texts[C.COMBINED_SCOPE] = " ".join([doc.get("core_insight", ""), doc.get("title", ""), *texts.values()])
        texts |= {d: _flat(v) for d, v in doc["dimensions"].items() if d not in C.DIMENSIONS}
        want |= {(i, s): t for s, t in texts.items()}
    assert got == want
    records = AN.history_records(good).orderBy("date").collect()
    assert len(records) == len(docs)
    assert all(r.dimension_texts == {s: want[i, s] for s in [*C.DIMENSIONS, C.COMBINED_SCOPE]} for i, r in enumerate(records))
    assert [r.keywords for r in records] == [d["keywords"] for d in docs]


def test_two_documents_of_a_day_stay_two_records(spark):
    raw = spark.createDataFrame([('{"date": "2024-01-01", "title": "a"}',), ('{"date": "2024-01-01", "title": "b", "dimensions": null}',)], "raw string")
    good, _ = AN.parse_documents(raw)
    assert sorted(r.title for r in AN.history_records(good).collect()) == ["a", "b"]


def test_rejected_documents_have_a_reason(spark):
    cases = {"": "empty payload", " \n": None, "{broken": "not a JSON object", "[1]": "not a JSON object", '"text"': "not a JSON object",
             '{"title": "x"}': "no date", '{"date": "some day"}': "no date", '{"date": "2024-02-30"}': "no date", '{"date": "2024-02-28"}': ""}
    raw = spark.createDataFrame([(k,) for k in cases] + [(None,)], "body string")
    good, bad = AN.parse_documents(raw, "body")
    got = {r.body: r.reason for r in bad.collect()}
    assert got.pop(None) == "empty payload" and got.pop(" \n") in ("empty payload", "not a JSON object")
    assert got == {k: v for k, v in cases.items() if v}
    assert [str(r.date) for r in good.collect()] == ["2024-02-28"]


def test_evidence_and_report_of_free_documents(spark):
    dims = {"capital": {"own": "Money moves fast.", "evidence": [{"title": "T", "source": "S", "url": "U"}, "x", {"title": "only"}]}}
    raw = spark.createDataFrame([(json.dumps({"date": f"2024-03-{d:02d}", "keywords": ["k"], "dimensions": dims}),) for d in range(1, 8)], "raw string")
    good, _ = AN.parse_documents(raw)
    rows = RP.evidence_rows(good.filter("date = '2024-03-01'")).collect()
    assert [(r.dimension, r.pos, r.title, r.source, r.url) for r in rows] == [("capital", 1, "T", "S", "U"), ("capital", 2, "only", None, None)]
    texts = AN.day_texts(good)
    report = PR.trend_report(V.term_counts(texts), texts.select("date"), AN.day_keywords(good), "2024-03-07").first()
    assert report.has_enough_history and report.overall_novelty == 0.0


def test_run_summary_of_a_known_run(spark):
    # per-source fetched and new counts of a real run with 13 sources, three of them failing
    fetched = [0, 0, 0, 15, 15, 15, 15, 7, 10, 11, 13, 12, 15]
    new = [0, 0, 0, 1, 0, 10, 3, 0, 0, 2, 0, 7, 0]
    time = [0.1, 0.1, 0.1, 0.6, 0.5, 0.4, 0.1, 0.3, 0.3, 3.9, 2.2, 1.3, 0.1]
    stats = spark.createDataFrame([(s[0], s[2], "ok" if f else "fail", f, n, t) for s, f, n, t in zip(C.SOURCE_CATALOG, fetched, new, time)],
                                  "source string, method string, status string, fetched long, new long, elapsed_s double")
    usage = spark.createDataFrame([("stage1", "m", 2876, 1024, 3900), ("stage2", "m", 3866, 1407, 5273)],
                                  "stage string, model string, prompt_tokens long, completion_tokens long, total_tokens long")
    r = RP.run_summary(stats, usage).first()
    assert (r.sources, r.ok_count, r.fail_count, r.fetched, r.new, r.fetch_time_s) == (13, 10, 3, 128, 23, 10.0)
    assert (r.stage1_prompt_tokens, r.stage1_completion_tokens, r.stage1_tokens) == (2876, 1024, 3900)
    assert (r.stage2_prompt_tokens, r.stage2_completion_tokens, r.stage2_tokens, r.total_tokens, r.model) == (3866, 1407, 5273, 9173, "m")


def test_rounding_equals_python(spark):
    rng, n = np.random.default_rng(0), 20_000
    ties = (rng.integers(-10 ** 6, 10 ** 6, n) + 0.5) / 1000
    x = np.concatenate([rng.random(n), rng.random(n) * 1e6 - 5e5, np.round(rng.random(n), 4), ties, np.nextafter(ties, 1e9), np.nextafter(ties, -1e9),
                        (rng.integers(-10 ** 6, 10 ** 6, n) + 0.5) / 100, rng.integers(-10 ** 5, 10 ** 5, n) / 2.0 ** rng.integers(0, 12, n),
                        [0.0, -0.0, 0.0005, 2.675, 2.5, -0.5, 1e300, -1e12, 1e-320, float("inf"), 4503599627370497.5, 2251799813685.2475]])
    frame = spark.createDataFrame(pd.DataFrame({"x": x}))
    for digits in (0, 2, 3, 6):
        got = frame.select("x", py_round("x", digits).alias("r")).toPandas()
        assert [r for r in got.r] == [round(v, digits) if math.isfinite(v) else v for v in got.x], digits
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(py_round("x", 3).alias("r")).collect()
    assert odd[0].r is None and math.isnan(odd[1].r)
