"""Analysis documents: validation, flattening to day texts / keywords, history
records, default document (P8-P14, S10).

An analysis document is one row per day: ``date, title, core_insight,
keywords, dimensions``.  The dimensions come in two forms, and every function here takes either:

* schema-free (:func:`parse_documents`): a map from each dimension's name to its JSON text, as a model wrote
  it.  Every text key counts, in document order, whatever its name; other values are skipped;
* structs with the fixed keys (:func:`parse_analysis`: own text keys, ``has_change``, ``intensity``, ``evidence``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewatch import constants as C

EVIDENCE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "source", "url")]))


def analysis_schema() -> T.StructType:
    """Schema of the analysis JSON (dimension text keys in their fixed order)."""
    dims = []
    for d in C.DIMENSIONS:
        fields = [T.StructField("has_change", T.BooleanType()), T.StructField("intensity", T.StringType())]
        fields += [T.StructField(k, T.StringType()) for k in C.DIMENSION_TEXT_KEYS[d]]
        fields.append(T.StructField("evidence", EVIDENCE))
        dims.append(T.StructField(d, T.StructType(fields)))
    return T.StructType([
        T.StructField("date", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("core_insight", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("dimensions", T.StructType(dims)),
    ])


def parse_analysis(raw: DataFrame, col: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Validate raw JSON documents against the schema.

    Returns ``(parsed, rejected)``: parsed documents (``date`` as DATE) and the
    raw rows that are not JSON objects or lack a parsable date.
    """
    parsed = raw.withColumn("_doc", F.from_json(F.col(col), analysis_schema(), {"mode": "PERMISSIVE"}))
    ok = (F.get_json_object(F.col(col), "$").isNotNull() & F.col("_doc").isNotNull()
          & F.to_date(F.col("_doc.date")).isNotNull())
    good = parsed.filter(ok).select("_doc.*").withColumn("date", F.to_date("date"))
    bad = parsed.filter(~ok).drop("_doc")
    return good, bad


DOCUMENT = "date STRING, title STRING, core_insight STRING, keywords ARRAY<STRING>, dimensions MAP<STRING, STRING>"
NO_TEXT_KEYS = ("has_change", "intensity", "evidence")


def parse_documents(raw: DataFrame, col: str = "raw", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Schema-free documents (P13): ``(documents, rejected)``.

    ``documents``: ``keep..., date, title, core_insight, keywords, dimensions`` (map of JSON texts, in document
    order).  ``rejected``: ``keep..., <col>, reason`` of payloads that are empty, no JSON object, or without a date."""
    body = F.col(f"`{col}`").cast("string")
    parsed = raw.select(*[F.col(f"`{c}`") for c in keep], body.alias(col), F.from_json(body, DOCUMENT, {"mode": "PERMISSIVE"}).alias("_doc"))
    text = F.col(f"`{col}`")
    reason = (F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty payload")
              .when(F.json_object_keys(text).isNull(), "not a JSON object")
              .when(F.try_to_date("_doc.date").isNull(), "no date"))
    names = [f"`{c}`" for c in keep]
    good = parsed.filter(reason.isNull()).select(*names, F.try_to_date("_doc.date").alias("date"), "_doc.title", "_doc.core_insight",
                                                 "_doc.keywords", "_doc.dimensions")
    return good, parsed.select(*names, f"`{col}`", reason.alias("reason")).filter("reason is not null")


def free_dimension_text(dim: Column) -> Column:
    """Flatten one dimension's JSON text (P8): its non-empty text values in document order, then the evidence
    titles (missing or not a text: ''), joined by a blank; '' if it is missing or no object."""
    entries = F.map_entries(F.from_json(dim, "map<string, variant>"))
    is_text = lambda v: F.schema_of_variant(v) == "STRING"
    texts = F.transform(F.filter(entries, lambda e: ~e["key"].isin(*NO_TEXT_KEYS) & is_text(e["value"])), lambda e: e["value"].cast("string"))
    listed = F.filter(entries, lambda e: e["key"] == "evidence")
    evidence = F.coalesce(F.try_variant_get(F.get(listed, 0)["value"], "$", "array<variant>"), F.array().cast("array<variant>"))
    title = lambda v: F.try_variant_get(v, "$.title", "variant")
    titles = F.transform(F.filter(evidence, lambda v: F.schema_of_variant(v).startswith("OBJECT")),
                         lambda v: F.when(is_text(title(v)), title(v).cast("string")).otherwise(""))
    return F.coalesce(F.concat_ws(" ", F.filter(texts, lambda t: t != ""), titles), F.lit(""))


def is_schema_free(analysis: DataFrame) -> bool:
    return isinstance(analysis.schema["dimensions"].dataType, T.MapType)


def dimension_text(dim: Column, dimension: str) -> Column:
    """Flatten one dimension (P8): non-empty text values in key order, then the
    evidence titles (missing title as ''), joined by a blank."""
    keys = C.DIMENSION_TEXT_KEYS[dimension]
    texts = F.filter(F.array(*[dim[k] for k in keys]), lambda x: x.isNotNull() & (x != ""))
    titles = F.transform(F.coalesce(dim["evidence"], F.array().cast(EVIDENCE)),
                         lambda e: F.coalesce(e["title"], F.lit("")))
    return F.when(dim.isNull(), F.lit("")).otherwise(F.concat_ws(" ", texts, titles))


def text_columns(analysis: DataFrame) -> dict[str, Column]:
    """The text of each dimension and ``_combined`` (P9), as columns over ``analysis``."""
    free = is_schema_free(analysis)
    cols = {d: free_dimension_text(F.col("dimensions")[d]) if free
            else dimension_text(F.col("dimensions")[d], d) for d in C.DIMENSIONS}
    combined = F.concat_ws(" ", F.coalesce("core_insight", F.lit("")), F.coalesce("title", F.lit("")), *cols.values())
    return cols | {C.COMBINED_SCOPE: combined}


def dimension_texts(analysis: DataFrame) -> DataFrame:
    """``date`` plus one text column per dimension and ``_combined``."""
    return analysis.select("date", *[c.alias(d) for d, c in text_columns(analysis).items()])


def day_texts(analysis: DataFrame, keep: tuple[str, ...] = ("date",), extra: bool = False) -> DataFrame:
    """Long form ``(date, scope, text)`` of the five dimensions and ``_combined``; with ``extra`` also of the
    further dimensions of schema-free documents (they are no part of ``_combined``)."""
    pairs = F.array(*[F.struct(F.lit(s).alias("scope"), c.alias("text")) for s, c in text_columns(analysis).items()])
    if extra and is_schema_free(analysis):
        more = F.filter(F.map_entries(F.coalesce("dimensions", F.create_map().cast("map<string,string>"))),
                        lambda e: ~e["key"].isin(*C.DIMENSIONS, C.COMBINED_SCOPE))
        pairs = F.concat(pairs, F.transform(more, lambda e: F.struct(e["key"].alias("scope"), free_dimension_text(e["value"]).alias("text"))))
    return analysis.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.scope", "p.text")


def day_keywords(analysis: DataFrame, keep: tuple[str, ...] = ("date",)) -> DataFrame:
    """``(keep..., kw)``; a document without keywords has none (P10)."""
    return analysis.select(*keep, F.explode(F.coalesce("keywords", F.array().cast("array<string>"))).alias("kw"))


def history_records(analysis: DataFrame) -> DataFrame:
    """History record per document (S10): ``date, title, core_insight, dimension_texts, keywords``; one pass."""
    cols = text_columns(analysis)
    texts = F.map_from_arrays(F.array(*[F.lit(s) for s in cols]), F.array(*cols.values()))
    return analysis.select("date", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("core_insight", F.lit("")).alias("core_insight"),
                           texts.alias("dimension_texts"), F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"))


def dimension_map(analysis: DataFrame) -> DataFrame:
    """``dimensions`` as ``MAP<STRING, STRUCT<has_change, intensity, texts MAP, evidence>>``."""
    def entry(d: str) -> Column:
        dim = F.col("dimensions")[d]
        keys = C.DIMENSION_TEXT_KEYS[d]
        texts = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.coalesce(dim[k], F.lit("")) for k in keys]))
        return F.struct(dim["has_change"].alias("has_change"), dim["intensity"].alias("intensity"),
                        texts.alias("texts"), dim["evidence"].alias("evidence"))
    m = F.map_from_arrays(F.array(*[F.lit(d) for d in C.DIMENSIONS]), F.array(*[entry(d) for d in C.DIMENSIONS]))
    return analysis.withColumn("dimensions", m)


# ---- fixed values: the empty analysis of a day without items ----
EMPTY_TITLE = "AI产业结构日报 – {date}"
EMPTY_INSIGHT = "今日未采集到新信息，无法进行结构性分析。"
EMPTY_INTENSITY = "无显著变化"


def default_analysis(spark: SparkSession, day: str) -> DataFrame:
    """The empty analysis document of ``day``."""
    dims = {d: dict(has_change=False, intensity=EMPTY_INTENSITY, evidence=[],
                    **{k: "" for k in C.DIMENSION_TEXT_KEYS[d]}) for d in C.DIMENSIONS}
    row = dict(date=day, title=EMPTY_TITLE.format(date=day), core_insight=EMPTY_INSIGHT, keywords=[],
               dimensions=dims)
    return spark.createDataFrame([row], analysis_schema()).withColumn("date", F.to_date("date"))


def with_default(analysis: DataFrame, days: DataFrame) -> DataFrame:
    """Every day of ``days`` gets a document: its own, else the empty one."""
    missing = days.select("date").distinct().join(analysis.select("date"), "date", "left_anti")
    empty_dim = {d: F.struct(F.lit(False).alias("has_change"), F.lit(EMPTY_INTENSITY).alias("intensity"),
                             *[F.lit("").alias(k) for k in C.DIMENSION_TEXT_KEYS[d]],
                             F.array().cast(EVIDENCE).alias("evidence")) for d in C.DIMENSIONS}
    dims = F.struct(*[c.alias(d) for d, c in empty_dim.items()])
    title = F.concat(F.lit(EMPTY_TITLE.split("{date}")[0]), F.date_format("date", "yyyy-MM-dd"))
    filled = missing.select("date", title.alias("title"), F.lit(EMPTY_INSIGHT).alias("core_insight"),
                            F.array().cast("array<string>").alias("keywords"), dims.alias("dimensions"))
    return analysis.unionByName(filled)
