from tidewatch.operators import vectors as V
from tidewatch.plans import queries as Q


def test_text_queries_of_both_days_share_one_term_table(spark, monkeypatch, tmp_path):
    rows = [(i, f"Text {i} of day {i % 31}", "en", "s", 10) for i in range(-40, 70)]  # days before the first as well
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    calls = []
    real = V.term_counts
    monkeypatch.setattr(V, "term_counts", lambda texts, *a, **k: (calls.append(1), real(texts, *a, **k))[1])
    for day in (Q.B.TEXT_DAY, Q.REPORT_DAY):
        got = Q._text_tf(spark, str(tmp_path), day=day)
        want = real(Q._texts(spark, str(tmp_path), day, 30))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not want.isEmpty()
    assert len(calls) == 1
