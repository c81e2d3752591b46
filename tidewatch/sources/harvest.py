"""Harvest jobs: landed payload tables to item rows.

Payloads arrive as tables (one row per fetched page / feed / API response);
every job is a row-local expression plus explode, so it scales with the number
of payloads.  Pages are scanned once by the linear scanner of ``functions.markup``;
rules, orders and limits are Spark expressions over its elements.  A payload that
gives nothing usable gives no rows, the source shows up as ``fail`` in the ingest
statistics, and ``rejected_*`` list it with the reason (P20).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from tidewatch import constants as C
from tidewatch.functions.markup import Selector, joined_text, scanned
from tidewatch.functions.text import PY_WHITESPACE_CLASS, clip, is_relevant, py_strip, repo_name, repo_path, summary_from_parts
from tidewatch.session import ship_package

# ---- fixed values: named entities decoded in text ----
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
            ("&nbsp;", " "), ("&amp;", "&")]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


ENTITY = r"&(?:#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7})|[a-z]{2,4});"


def _character(entity: Column) -> Column:
    """The character of one entity: by name, or by number through its UTF-32 bytes."""
    n = F.when(entity.rlike("^&#[xX]"), F.conv(F.regexp_extract(entity, "([0-9a-fA-F]+);", 1), 16, 10)) \
        .otherwise(F.regexp_extract(entity, "([0-9]+);", 1)).cast("int")
    utf32 = F.unhex(F.lpad(F.hex(n.cast("bigint")), 8, "0"))
    # outside the Unicode range or a surrogate: the replacement character
    good = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    named = F.coalesce(F.create_map(*[F.lit(x) for pair in ENTITIES for x in pair])[entity], entity)
    return (F.when(entity.isNull(), "").when(~entity.startswith("&#"), named)
            .when(good, F.decode(utf32, "UTF-32")).otherwise("\ufffd"))


def decode_entities(c: str | Column) -> Column:
    """Named (ENTITIES) and numeric entities of a text, each decoded once."""
    x = _col(c)
    gaps, found = F.split(x, ENTITY, -1), F.regexp_extract_all(x, F.lit(ENTITY), F.lit(0))
    decoded = F.transform(gaps, lambda g, i: F.concat(g, _character(F.get(found, i))))
    return F.when(F.contains(x, F.lit("&")), F.array_join(decoded, "")).otherwise(x)


def html_text(c: str | Column) -> Column:
    """Text of an HTML fragment: tags removed, every text node stripped, nodes
    joined without separator, entities decoded (``get_text(strip=True)``)."""
    ws = PY_WHITESPACE_CLASS
    no_tags = F.regexp_replace(_col(c), f"{ws}*<[^>]*>{ws}*", "")
    return py_strip(decode_entities(no_tags))


ANCHOR = Selector("a", "a")


def anchors(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url"), title_chars: int | None = None) -> DataFrame:
    """Every ``<a href>`` element of every page: ``keep..., pos, href, title`` (the first ``title_chars`` characters)."""
    ship_package(pages.sparkSession)
    page = pages.select(*keep, scanned(html, [ANCHOR]).alias("_page"))
    linked = F.filter("_page.elements", lambda e: e["href"].isNotNull())
    z = page.select(*keep, F.col("_page.texts").alias("_texts"), F.posexplode(linked).alias("pos", "a"))
    return z.select(*keep, (F.col("pos") + 1).alias("pos"), F.col("a.href").alias("href"),
                    joined_text(F.col("_texts"), F.col("a"), title_chars).alias("title"))


def page_origin(url: str | Column = "url") -> Column:
    """``scheme://host`` of a page URL."""
    return F.regexp_extract(_col(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def harvest_links(pages: DataFrame, rule: str, value: str, base: str | Column | None = None,
                  root: str | Column | None = None, min_title: int = C.LINK_MIN_TITLE,
                  dedup: str = "before", cap: int = C.LINK_CAP, title_chars: int = C.TITLE_CHARS) -> DataFrame:
    """Link harvest (S5, S6): ``page_id, pos, title, url`` per page, document order.

    * ``rule='prefix'``: href starts with ``value`` and differs from it;
      ``rule='contains'``: ``value`` occurs in href and ``rtrim(href, '/')`` differs
      from ``root``;
    * ``dedup='before'``: the first anchor of each href is the only candidate,
      decided *before* the title test (a short-titled first hit uses the href up);
      ``dedup='after'``: title test first, then the first of each absolute url;
    * titles shorter than ``min_title`` drop; titles are cut to ``title_chars``;
      url = ``base + href`` (``'after'`` keeps hrefs starting with ``http``);
      at most ``cap`` links per page.

    Anchors of one page stay together: the dedup is a partial aggregate on
    ``(page, href)`` and the cap a per-page ``WindowGroupLimit``.
    """
    base_c = page_origin("url") if base is None else (F.lit(base) if isinstance(base, str) else base)
    a = anchors(pages, title_chars=max(title_chars, min_title)).withColumn("_base", base_c)
    if rule == "prefix":
        a = a.filter(F.col("href").startswith(value) & (F.col("href") != value))
    elif rule == "contains":
        root_c = F.lit(root) if isinstance(root, str) else (root if root is not None else F.col("_base"))
        a = a.filter(F.col("href").contains(value)
                     & (F.regexp_replace(F.col("href"), "/+$", "") != root_c))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    long_enough = F.length("title") >= min_title
    if dedup == "before":
        a = a.withColumn("url", F.concat(F.col("_base"), F.col("href")))
        first = (a.groupBy("page_id", "href").agg(F.min(F.struct("pos", "title", "url")).alias("_r"))
                 .select("page_id", "_r.*"))
        cand = first.filter(long_enough)
    elif dedup == "after":
        url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.col("_base"), F.col("href")))
        a = a.filter(long_enough).withColumn("url", url)
        cand = (a.groupBy("page_id", "url").agg(F.min(F.struct("pos", "title")).alias("_r"))
                .select("page_id", "url", "_r.*"))
    else:
        raise ValueError(f"unknown dedup {dedup!r}")
    w = Window.partitionBy("page_id").orderBy("pos")
    return (cand.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= cap)
            .select("page_id", F.col("pos").cast("bigint").alias("pos"),
                    F.substring("title", 1, title_chars).alias("title"), "url"))


def _blocks(pages: DataFrame, keep: tuple[str, ...], wanted: list[Selector], block: Selector, closed_by_next: list[str]) -> DataFrame:
    """Block elements with the text of the first element of each selector inside them (null: none):
    ``keep..., pos`` and per label its text and ``<label>_href``."""
    ship_package(pages.sparkSession)
    page = pages.select(*keep, scanned("html", wanted, block, closed_by_next).alias("_page"))
    b = page.select(*keep, F.col("_page.texts").alias("_texts"), F.col("_page.elements").alias("_elements"),
                    F.posexplode("_page.blocks").alias("bpos", "_found"))
    columns = []
    for i, selector in enumerate(wanted):
        element = F.get("_elements", F.col("_found")[i])  # null for -1
        columns += [F.when(F.col("_found")[i] >= 0, joined_text(F.col("_texts"), element)).alias(selector.label),
                    element["href"].alias(f"{selector.label}_href")]
    return b.select(*keep, (F.col("bpos") + 1).cast("bigint").alias("pos"), *columns)


def harvest_blocks(pages: DataFrame, block_tag: str = "article", title_tag: str = "h1",
                   desc_tag: str = "p", counter_tag: str | None = None, relevance: bool = True,
                   desc_chars: int = C.SUMMARY_CHARS) -> DataFrame:
    """Block harvest (S3): one item per ``<block_tag>`` element that has a title.

    Title = text of the first ``<title_tag>``; description = text of the first
    ``<desc_tag>`` (the next ``<desc_tag>`` closes an open one); counter text =
    text of the first ``<counter_tag>`` (optional).  Blocks without a title are
    skipped; with ``relevance`` the P2 filter runs on ``title + ' ' + desc``.
    Summary = ``desc + '  ⭐ ' + counter`` when a counter is present.
    """
    wanted = [Selector("title", title_tag), Selector("description", desc_tag)]
    if counter_tag:
        wanted.append(Selector("counter", counter_tag))
    out = _blocks(pages, ("page_id", "url"), wanted, Selector("block", block_tag), [desc_tag])
    out = out.filter(F.col("title").isNotNull()).select(
        "page_id", "pos", "url", "title", F.coalesce("description", F.lit("")).alias("description"),
        (F.coalesce("counter", F.lit("")) if counter_tag else F.lit("")).alias("counter"))
    if relevance:
        out = out.filter(is_relevant("title", "description"))
    summary = F.when(F.col("counter") != "", F.concat(F.col("description"), F.lit("  ⭐ "), F.col("counter"))) \
        .otherwise(F.col("description"))
    return out.withColumn("summary", F.substring(summary, 1, desc_chars))


# ---------------------------------------------------------------- feeds and APIs (in-test payloads)

ATOM_SCHEMA = ("entry ARRAY<STRUCT<title: STRUCT<_VALUE: STRING, _type: STRING>, link: ARRAY<STRUCT<_VALUE: STRING, _href: STRING, _rel: STRING>>, "
               "summary: STRUCT<_VALUE: STRING, _type: STRING>, content: STRUCT<_VALUE: STRING, _type: STRING>, published: STRING, updated: STRING>>")
RSS_SCHEMA = ("channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, description: STRING, "
              "pubDate: STRING>>>")


def _parsed_feeds(payloads: DataFrame) -> DataFrame:
    parsed = payloads.withColumn("_doc", F.from_xml("xml", RSS_SCHEMA, {"rowTag": "rss", "mode": "PERMISSIVE"}))
    return parsed.withColumn("_atom", F.from_xml("xml", ATOM_SCHEMA, {"rowTag": "feed", "mode": "PERMISSIVE"}))


def harvest_feed(payloads: DataFrame, max_items: int = C.FEED_ENTRIES,
                 summary_chars: int = C.SUMMARY_CHARS) -> DataFrame:
    """RSS and Atom payloads ``(source, category, xml)`` to items.

    Takes the first ``max_items`` entries, *then* drops entries without a title;
    trims title, url, summary; summary cut to 1000 characters.  ``pos`` is the
    entry's place in the feed.
    """
    parsed = _parsed_feeds(payloads)

    def entry(e: Column) -> Column:
        links = F.coalesce(e["link"], F.array())
        page = F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
        return F.struct(e["title"]["_VALUE"].alias("title"), F.coalesce(F.get(page, 0), F.get(links, 0))["_href"].alias("link"),
                        F.coalesce(e["summary"]["_VALUE"], e["content"]["_VALUE"]).alias("description"),
                        F.coalesce(e["published"], e["updated"]).alias("pubDate"))

    listed = F.coalesce(F.col("_doc.channel.item"), F.transform("_atom.entry", entry), F.array())
    entries = parsed.select("source", "category", F.posexplode(F.slice(listed, 1, max_items)).alias("pos", "e"))
    return (entries.filter(F.coalesce(F.col("e.title"), F.lit("")) != "")
            .select("source", "category",
                    py_strip("e.title").alias("title"),
                    py_strip(F.coalesce(F.col("e.link"), F.lit(""))).alias("url"),
                    clip(F.coalesce(F.col("e.description"), F.lit("")), summary_chars).alias("summary"),
                    F.coalesce(F.col("e.pubDate"), F.lit("")).alias("published"),
                    (F.col("pos") + 1).cast("bigint").alias("pos")))


MODEL_SCHEMA = "ARRAY<STRUCT<id: STRING, pipeline_tag: STRING, downloads: BIGINT, likes: BIGINT>>"


def harvest_api(payloads: DataFrame, limit: int = C.FEED_ENTRIES, published: str | Column | None = None) -> DataFrame:
    """Model-list API payloads ``(source, category, body)`` to items.

    First ``limit`` entries of the array; entries without id dropped; summary
    from optional parts joined by ``'  |  '`` with thousands separators.
    """
    parsed = payloads.withColumn("_m", F.from_json("body", MODEL_SCHEMA, {"mode": "PERMISSIVE"}))
    pub = F.lit("") if published is None else (F.lit(published) if isinstance(published, str) else published)
    m = parsed.select("source", "category", F.posexplode(F.slice(F.coalesce("_m", F.array()), 1, limit)).alias("pos", "m"))
    return (m.filter(F.coalesce(F.col("m.id"), F.lit("")) != "")
            .select("source", "category", F.col("m.id").alias("title"),
                    F.concat(F.lit("https://huggingface.co/"), F.col("m.id")).alias("url"),
                    summary_from_parts("m.pipeline_tag", "m.downloads", "m.likes").alias("summary"),
                    pub.alias("published"), (F.col("pos") + 1).cast("bigint").alias("pos"),
                    F.col("m.downloads").alias("downloads"), F.col("m.likes").alias("likes"),
                    F.col("m.pipeline_tag").alias("pipeline_tag")))


REPO_BLOCK = Selector("block", "article", ("Box-row",))
REPO_PARTS = [Selector("link", "a", within="h2"), Selector("description", "p"),
              Selector("stars", "span", ("d-inline-block", "float-sm-right"))]


def _repo_rows(pages: DataFrame, host: str) -> DataFrame:
    """``page_id, pos, repo, title, url, description, stars`` of every repository block."""
    b = _blocks(pages, ("page_id",), REPO_PARTS, REPO_BLOCK, [])
    path = repo_path(F.coalesce("link_href", F.lit("")))
    return (b.filter(F.col("link").isNotNull())
           .select("page_id", "pos", path.alias("repo"),
                   repo_name(path).alias("title"), F.concat(F.lit(host + "/"), path).alias("url"),
                   F.coalesce("description", F.lit("")).alias("description"), F.coalesce("stars", F.lit("")).alias("stars")))


def harvest_repo_blocks(pages: DataFrame, host: str = "https://github.com") -> DataFrame:
    """Repository blocks (S3 with the original's markup): ``article`` blocks whose
    ``h2 a[href]`` gives the path, first ``p`` the description, the counter
    ``span`` the star text; relevance on ``name + ' ' + desc``."""
    out = _repo_rows(pages, host).filter(is_relevant("title", "description"))
    summary = F.when(F.col("stars") != "", F.concat(F.col("description"), F.lit("  ⭐ "), F.col("stars"))) \
        .otherwise(F.col("description"))
    return out.withColumn("summary", F.substring(summary, 1, C.SUMMARY_CHARS))


# ---------------------------------------------------------------- rejected payloads (P20)

def rejected_pages(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Pages of which the scanner makes nothing: ``keep..., reason``."""
    ship_package(pages.sparkSession)
    page = pages.select(*keep, scanned(html, []).getField("reject").alias("reason"))
    return page.filter(F.col("reason").isNotNull())


def rejected_feeds(payloads: DataFrame, keep: tuple[str, ...] = ("source",)) -> DataFrame:
    """Feed payloads that give no entries: ``keep..., reason``."""
    blank = F.coalesce(py_strip("xml"), F.lit("")) == ""
    parsed = _parsed_feeds(payloads).select(*keep, "xml", "_doc", "_atom")
    root = F.regexp_extract("xml", r"<([A-Za-z][\w:.-]*)", 1)
    reason = (F.when(blank, "empty payload").when(F.col("_doc.channel").isNull() & F.col("_atom.entry").isNull(),
              F.when(root.isin("rss", "feed"), "not well-formed, or without a channel or entries").otherwise(F.concat(F.lit("not a feed: "), root))))
    return parsed.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())


def rejected_lists(payloads: DataFrame, keep: tuple[str, ...] = ("source",)) -> DataFrame:
    """Model-list payloads that are no JSON array of objects: ``keep..., reason``."""
    blank = F.coalesce(py_strip("body"), F.lit("")) == ""
    listed = F.from_json("body", MODEL_SCHEMA, {"mode": "PERMISSIVE"})
    reason = (F.when(blank, "empty payload").when(~py_strip("body").startswith("["), "not a list")
              .when(listed.isNull(), "not well-formed JSON"))
    return payloads.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())


# ---------------------------------------------------------------- metrics snapshot

def catalog_frame(spark) -> DataFrame:
    """The fixed source catalog (S1): ``source, category, method, src_rank``."""
    rows = [(name, cat, method, i) for i, (name, cat, method) in enumerate(C.SOURCE_CATALOG)]
    return spark.createDataFrame(rows, "source string, category string, method string, src_rank int")


def papers_from_feeds(payloads: DataFrame, name_part: str = "arXiv", max_items: int = C.FEED_ENTRIES) -> DataFrame:
    """Paper facts of the snapshot from feed payloads ``(source, category, xml)``:
    feeds whose name contains ``name_part``, first ``max_items`` entries, entries
    with a title, abstract cut to 2000 characters, no dedup."""
    items = harvest_feed(payloads.filter(F.col("source").contains(name_part)), max_items, C.ABSTRACT_CHARS)
    return items.select("title", F.col("summary").alias("abstract"), "url", "source", "pos")


def paper_texts(papers: DataFrame) -> DataFrame:
    """``title + ' ' + abstract`` of papers with a non-empty title or abstract."""
    t, a = F.coalesce(F.col("title"), F.lit("")), F.coalesce(F.col("abstract"), F.lit(""))
    return papers.filter((t != "") | (a != "")).withColumn("text", F.concat(t, F.lit(" "), a))


def snapshot_repos(pages: DataFrame, host: str = "https://github.com") -> DataFrame:
    """Repository facts of the snapshot: relevance on ``path + ' ' + description``, description
    cut to 500 characters (the item harvest tests the name instead)."""
    r = _repo_rows(pages, host).filter(is_relevant("repo", "description"))
    return r.select("repo", "stars", "url", F.substring("description", 1, C.DESCRIPTION_CHARS).alias("description"), "pos")


def snapshot(day, papers: DataFrame, repos: DataFrame, models: DataFrame, model_limit: int = 20) -> DataFrame:
    """Nested daily snapshot (S7): ``date, arxiv_papers, github_repos, hf_models``.

    Each list is bounded by the harvest limits (15 entries per paper feed, the
    repository blocks of one page, ``model_limit`` models), so the per-day
    arrays stay small; order follows ``pos``.
    """
    spark = papers.sparkSession

    def listed(df: DataFrame, cols: list[str]) -> Column:
        return df.agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.struct(*cols).alias("v")))),
                                  lambda x: x["v"]).alias("a")).scalar()

    m = models.filter(F.col("pos") <= model_limit)
    return spark.range(1).select(
        F.lit(day).cast("date").alias("date"),
        listed(papers, ["title", "abstract", "url", "source"]).alias("arxiv_papers"),
        listed(repos, ["repo", "stars", "url", "description"]).alias("github_repos"),
        listed(m, ["model_id", "downloads", "likes", "pipeline_tag", "url"]).alias("hf_models"))


def as_items(harvested: DataFrame, source: str, category: str, published: str | Column = "",
             summary: str | None = "summary") -> DataFrame:
    """Shape a harvest result as item rows: ``source, category, title, url,
    summary, published, pos`` (links carry an empty summary and date, blocks
    and API entries their summary and the run's date)."""
    pub = F.lit(published) if isinstance(published, str) else published
    summ = F.col(summary) if summary and summary in harvested.columns else F.lit("")
    return harvested.select(F.lit(source).alias("source"), F.lit(category).alias("category"), "title", "url",
                            summ.alias("summary"), pub.alias("published"), F.col("pos").cast("bigint").alias("pos"))
