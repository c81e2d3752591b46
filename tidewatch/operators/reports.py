"""Reports: digest lines, reference list, report bundle, run summary.

Reports are tables of lines with a total sort key ``(section, item, line)``;
the rendered text is these lines in key order joined by newlines.  Nothing is
gathered into one row unless the caller asks for the rendered single string
(:func:`render`), which is meant for a run-sized report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch import constants as C
from tidewatch.operators.analysis import is_schema_free
from tidewatch.operators._util import consecutive_index


def _category_dim(spark, order: list[str], labels: dict[str, str]) -> DataFrame:
    rows = [(c, i, labels.get(c, c)) for i, c in enumerate(order)]
    return spark.createDataFrame(rows, "category string, cat_rank int, label string")


def digest_lines(items: DataFrame, day, order: list[str] | None = None,
                 labels: dict[str, str] | None = None, summary_chars: int = C.DIGEST_SUMMARY_CHARS) -> DataFrame:
    """Digest of the day's items (R1, A1, W7, J8): ``section, item, line, text``.

    Header: date, item count (all items, also those outside the category
    list), blank, intro, blank.  Then each category of ``order`` that has items:
    ``### label（n 条）``, blank, and per item ``idx. [source] title``,
    ``   URL: url``, ``   摘要: summary[:400]`` (if any summary) and a blank line.
    ``idx`` runs through the groups in order (category rank, position).
    Items with a missing category count as ``other``; categories outside
    ``order`` are not listed.
    """
    spark = items.sparkSession
    order = C.CATEGORY_ORDER if order is None else order
    labels = C.CATEGORY_LABELS if labels is None else labels
    cats = F.broadcast(_category_dim(spark, order, labels))  # the fixed category list
    it = items.withColumn("category", F.coalesce(F.col("category"), F.lit("other")))
    total = it.select(F.count("*")).scalar()
    listed = it.join(cats, "category", "inner")
    numbered = consecutive_index(listed, [F.col("cat_rank"), F.col("pos"), F.col("source"), F.col("title")], "idx")
    day_s = F.date_format(F.lit(day).cast("date"), "yyyy-MM-dd")

    header = spark.range(5).select(
        F.lit(-1).alias("section"), F.lit(0).cast("bigint").alias("item"), F.col("id").cast("int").alias("line"))
    header = header.select("section", "item", "line", F.element_at(F.array(
        F.concat(F.lit(C.DIGEST_DATE), day_s),
        F.concat(F.lit(C.DIGEST_COUNT), total.cast("string")),
        F.lit(""), F.lit(C.DIGEST_INTRO), F.lit("")), F.col("line") + 1).alias("text"))

    groups = listed.groupBy("cat_rank", "label").agg(F.count("*").alias("n"))
    group_lines = groups.select(
        F.col("cat_rank").alias("section"), F.lit(0).cast("bigint").alias("item"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("line"), F.concat(F.lit("### "), F.col("label"), F.lit(C.DIGEST_GROUP[0]),
                                                       F.col("n").cast("string"), F.lit(C.DIGEST_GROUP[1])).alias("text")),
            F.struct(F.lit(1).alias("line"), F.lit("").alias("text")))).alias("l")
    ).select("section", "item", "l.line", "l.text")

    summary = F.coalesce(F.col("summary"), F.lit(""))
    item_lines = numbered.select(
        F.col("cat_rank").alias("section"), F.col("idx").alias("item"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("line"), F.concat(F.col("idx").cast("string"), F.lit(". ["), F.col("source"),
                                                       F.lit("] "), F.col("title")).alias("text")),
            F.struct(F.lit(1).alias("line"), F.concat(F.lit(C.DIGEST_URL), F.coalesce("url", F.lit(""))).alias("text")),
            F.struct(F.lit(2).alias("line"),
                     F.when(summary != "", F.concat(F.lit(C.DIGEST_SUMMARY), F.substring(summary, 1, summary_chars)))
                     .alias("text")),
            F.struct(F.lit(3).alias("line"), F.lit("").alias("text")))).alias("l")
    ).select("section", "item", "l.line", "l.text").filter(F.col("text").isNotNull())
    return header.unionByName(group_lines).unionByName(item_lines)


def render(lines: DataFrame, keys: tuple[str, ...] = ("section", "item", "line")) -> DataFrame:
    """One row with the lines joined by newlines, in key order (run-sized reports only)."""
    return lines.agg(F.concat_ws("\n", F.transform(
        F.array_sort(F.collect_list(F.struct(*keys, "text"))), lambda s: s["text"])).alias("text"))


def evidence_of(analysis: DataFrame, dimension: str) -> Column:
    """Evidence entries of a dimension; of schema-free documents those that are objects."""
    dim = F.col("dimensions")[dimension]
    if not is_schema_free(analysis):
        return dim["evidence"]
    listed = F.from_json(dim, "evidence ARRAY<VARIANT>")["evidence"]
    text = lambda v, k: F.try_variant_get(v, f"$.{k}", "string").alias(k)
    return F.transform(F.filter(listed, lambda v: F.schema_of_variant(v).startswith("OBJECT")),
                       lambda v: F.struct(text(v, "title"), text(v, "source"), text(v, "url")))


def evidence_rows(analysis: DataFrame) -> DataFrame:
    """Long form of the evidence of every dimension of analysis documents (either form):
    ``date, dim_rank, dimension, pos, title, source, url``."""
    dims = F.array(*[F.struct(F.lit(i).alias("dim_rank"), F.lit(d).alias("dimension"), evidence_of(analysis, d).alias("ev"))
                     for i, d in enumerate(C.DIMENSIONS)])
    x = analysis.select("date", F.explode(dims).alias("d"))
    return (x.select("date", "d.dim_rank", "d.dimension", F.posexplode(F.coalesce("d.ev", F.array())).alias("pos", "e"))
            .select("date", "dim_rank", "dimension", (F.col("pos") + 1).alias("pos"),
                    F.col("e.title").alias("title"), F.col("e.source").alias("source"), F.col("e.url").alias("url")))


def reference_list(evidence: DataFrame, catalog: DataFrame, order: list[str] | None = None,
                   labels: dict[str, str] | None = None) -> DataFrame:
    """Reference list (R3): ``section, item, line, text`` — per source category
    (fixed order, empty groups skipped) a heading and one
    ``- [title](url) — source`` line per distinct reference, in order of
    first appearance.

    ``evidence``: ``date, dim_rank, pos, title, source, url``; ``catalog``:
    ``source, category`` (a small dimension).  Sources outside the catalog go
    to ``other``.
    """
    spark = evidence.sparkSession
    order = [c for c in (C.CATEGORY_ORDER if order is None else order)]
    labels = C.CATEGORY_LABELS if labels is None else labels
    cats = F.broadcast(_category_dim(spark, order, labels))
    ev = (evidence.join(catalog.select("source", "category"), "source", "left")
          .withColumn("category", F.coalesce("category", F.lit("other")))
          .join(cats, "category", "inner"))
    first = (ev.groupBy("cat_rank", "label", "title", "url", "source")
             .agg(F.min(F.struct("date", "dim_rank", "pos")).alias("k")))
    numbered = consecutive_index(first, [F.col("cat_rank"), F.col("k"), F.col("title"), F.col("url"), F.col("source")], "item")
    heads = first.groupBy("cat_rank", "label").agg(F.count("*").alias("n")).select(
        F.col("cat_rank").alias("section"), F.lit(0).cast("bigint").alias("item"), F.lit(0).alias("line"),
        F.concat(F.lit("### "), F.col("label")).alias("text"))
    lines = numbered.select(
        F.col("cat_rank").alias("section"), "item", F.lit(0).alias("line"),
        F.concat(F.lit("- ["), F.coalesce("title", F.lit("")), F.lit("]("), F.coalesce("url", F.lit("")),
                 F.lit(") — "), F.coalesce("source", F.lit(""))).alias("text"))
    return heads.unionByName(lines)


def report_bundle(analysis_json: Column, with_trend: bool = False, metrics_json: Column | None = None,
                  charts_json: Column | None = None, base: DataFrame | None = None) -> DataFrame:
    """Report bundle (R2) per day: ``date, text`` with the analysis, the trend
    report (or its "not enough history" message), the metrics report and the
    chart list as JSON blocks; absent parts are skipped (``concat_ws`` drops nulls).

    ``base`` holds one row per day with ``date`` and the JSON columns; with
    ``with_trend`` it also carries ``has_enough_history, message, trend_json``.
    """
    df = base
    if with_trend:
        trend_part = F.when(F.col("has_enough_history"), F.concat(F.lit(C.BUNDLE_TREND), F.col("trend_json"))) \
            .when(F.col("message").isNotNull(), F.concat(F.lit(C.BUNDLE_NO_TREND), F.col("message")))
    else:
        trend_part = F.lit(None).cast("string")
    parts = [F.concat(F.lit(C.BUNDLE_ANALYSIS), analysis_json), trend_part]
    if metrics_json is not None:
        parts.append(F.concat(F.lit(C.BUNDLE_METRICS), metrics_json))
    if charts_json is not None:
        parts.append(F.when(F.coalesce(F.size(F.from_json(charts_json, "array<string>")), F.lit(0)) > 0,
                            F.concat(F.lit(C.BUNDLE_CHARTS), charts_json)))
    return df.select("date", F.concat_ws("\n", *parts).alias("text"))


def run_summary(stats: DataFrame, usage: DataFrame, trend: DataFrame | None = None) -> DataFrame:
    """Run summary (R4): one row of totals from the per-source statistics and
    the token usage (A3, A4), plus trend counts when given."""
    totals = stats.agg(
        F.count("*").alias("sources"),
        F.count_if(F.col("status") == "ok").alias("ok_count"),
        F.count_if(F.col("status") == "fail").alias("fail_count"),
        F.coalesce(F.sum("fetched"), F.lit(0)).cast("bigint").alias("fetched"),
        F.coalesce(F.sum("new"), F.lit(0)).cast("bigint").alias("new"),
        F.round(F.coalesce(F.sum("elapsed_s"), F.lit(0.0)), 1).alias("fetch_time_s"))
    def stage(name: str, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage") == name, F.col(column))), F.lit(0)).cast("bigint")

    tok = usage.agg(*[stage(f"stage{i}", f"{kind}_tokens").alias(f"stage{i}_{kind}_tokens") for i in (1, 2) for kind in ("prompt", "completion")],
                    *[stage(f"stage{i}", "total_tokens").alias(f"stage{i}_tokens") for i in (1, 2)],
                    F.coalesce(F.sum("total_tokens"), F.lit(0)).cast("bigint").alias("total_tokens"), F.min("model").alias("model"))
    for part in (tok,) if trend is None else (tok, trend):  # one row each, one subquery each
        row = part.select(F.struct(*part.columns)).scalar()
        totals = totals.withColumn("_row", row).select("*", "_row.*").drop("_row")
    return totals


def token_totals(usage: DataFrame) -> DataFrame:
    """Token totals per stage and overall (A4): ``rollup(stage)``."""
    return (usage.rollup("stage")
            .agg(F.sum("prompt_tokens").cast("bigint").alias("prompt_tokens"),
                 F.sum("completion_tokens").cast("bigint").alias("completion_tokens"),
                 F.sum("total_tokens").cast("bigint").alias("total_tokens")))
