import datetime as dt
import json

from pyspark.sql import functions as F

from tidewatch import constants as C
from tidewatch.operators import analysis as AN
from tidewatch.operators import reports as RP
from tidewatch.operators import vectors as V
from tidewatch.plans import reports as PR

# an invented analysis document; only the key names belong to the schema
def _dimension(intensity="弱信号", evidence=(), **texts):
    return {"has_change": bool(evidence), "intensity": intensity, **texts, "evidence": list(evidence)}


SAMPLE = {
    "date": "2026-02-26", "title": "Harbour day", "core_insight": "Two ferries left early.",
    "keywords": ["ferry", "tide", "harbour"],
    "dimensions": {
        "technology": _dimension("strong", [{"title": "Log of the day", "source": "Pier 3", "url": "https://pier.example"}],
                                 model_capability="New engines run quietly.", new_paradigm="Crews share one chart."),
        "infrastructure": _dimension("无显著变化", inference_cost="", compute_trend=""),
        "application": _dimension("无显著变化", new_industries="", displacement=""),
        "capital": _dimension(funding_trend="", valuation="", strategic_moves=""),
        "risk": _dimension(regulation="", ethics_safety="", supply_chain=""),
    },
}


def _analysis(spark, docs):
    raw = spark.createDataFrame([(json.dumps(d, ensure_ascii=False),) for d in docs] + [("{broken",)], "raw string")
    good, bad = AN.parse_analysis(raw)
    return good, bad


def test_parse_and_flatten(spark):
    good, bad = _analysis(spark, [SAMPLE])
    assert good.count() == 1 and bad.count() == 1
    texts = {r.scope: r.text for r in AN.day_texts(good).collect()}
    assert texts["technology"] == "New engines run quietly. Crews share one chart. Log of the day"
    assert texts["risk"] == ""
    assert texts["_combined"] == ("Two ferries left early. Harbour day "
                                  "New engines run quietly. Crews share one chart. Log of the day    ")
    assert sorted(r.kw for r in AN.day_keywords(good).collect()) == sorted(SAMPLE["keywords"])
    keys = AN.history_records(good).select(F.map_keys("dimension_texts")).first()[0]
    assert keys == C.DIMENSIONS + ["_combined"]


def test_default_analysis_fills_missing_days(spark):
    good, _ = _analysis(spark, [SAMPLE])
    days = spark.createDataFrame([(dt.date(2026, 2, 26),), (dt.date(2026, 2, 27),)], "date date")
    full = AN.with_default(good, days).orderBy("date").collect()
    assert full[1].title == "AI产业结构日报 – 2026-02-27" and full[1].keywords == []
    assert full[1].dimensions.capital.intensity == "无显著变化"


def test_short_history_gives_default_report(spark):
    docs = [dict(SAMPLE, date=f"2026-02-{d}") for d in (26, 27, 28)]
    good, _ = _analysis(spark, docs)
    texts = AN.day_texts(good)
    rep = PR.trend_report(V.term_counts(texts), texts.select("date"), AN.day_keywords(good), "2026-02-28").first()
    assert not rep.has_enough_history and rep.history_days == 2 and rep.overall_novelty == 1.0
    assert rep.signals == [] and rep.message == "趋势分析需要至少3天历史数据，当前仅2天。"


def test_report_with_history(spark):
    docs = [dict(SAMPLE, date=f"2026-02-{d:02d}") for d in range(20, 29)]
    good, _ = _analysis(spark, docs)
    texts = AN.day_texts(good)
    rep = PR.trend_report(V.term_counts(texts), texts.select("date"), AN.day_keywords(good), "2026-02-28").first()
    assert rep.has_enough_history and rep.history_days == 8
    assert rep.overall_novelty == 0.0            # identical days
    assert any(s.type == "continuous_trend" for s in rep.signals)


def test_digest_lines(spark):
    rows = [("arXiv cs.AI", "papers", 1, "Paper A", "https://a", "sum a"),
            ("TechCrunch AI", "industry", 1, "News B", "https://b", ""),
            ("Odd", "", 1, "Hidden", "https://c", "x"),
            ("arXiv cs.LG", "papers", 2, "Paper C", "https://d", "y" * 500)]
    items = spark.createDataFrame(rows, "source string, category string, pos long, title string, url string, summary string")
    lines = RP.digest_lines(items, "2026-02-28")
    text = RP.render(lines).first().text.split("\n")
    assert text[:2] == ["今日日期: 2026-02-28", "信息条目数: 4"]
    assert "### 论文（2 条）" in text and "### 资本与行业（1 条）" in text
    assert "1. [arXiv cs.AI] Paper A" in text and "2. [arXiv cs.LG] Paper C" in text and "3. [TechCrunch AI] News B" in text
    assert not any("Hidden" in t for t in text)
    assert "   摘要: " + "y" * 400 in text


def test_reference_list(spark):
    good, _ = _analysis(spark, [SAMPLE])
    ev = RP.evidence_rows(good)
    cat = spark.createDataFrame([("Pier 3", "papers")], "source string, category string")
    lines = RP.reference_list(ev, cat).orderBy("section", "item").collect()
    assert [r.text for r in lines] == ["### 论文", "- [Log of the day](https://pier.example) — Pier 3"]
