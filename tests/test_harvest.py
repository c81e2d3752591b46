from tidewatch.sources import harvest as HV


def _pages(spark, html, url="https://site.example/news"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_link_order_rule(spark):
    html = ('<a href="/news/x">short</a><a href="/news/x">A long enough title</a>'
            '<a href="/news/">root</a><a href="/news/y">Another good title</a>')
    before = [r.title for r in HV.harvest_links(_pages(spark, html), "prefix", "/news/", dedup="before").orderBy("pos").collect()]
    after = [r.title for r in HV.harvest_links(_pages(spark, html), "contains", "/news/", dedup="after").orderBy("pos").collect()]
    assert before == ["Another good title"]
    assert after == ["A long enough title", "Another good title"]


def test_link_cap_and_absolute_url(spark):
    html = "".join(f'<a class="c" href="/blog/p{i}">Blog post number {i}</a>' for i in range(20))
    out = HV.harvest_links(_pages(spark, html, "https://ai.example/blog/"), "contains", "/blog/",
                           root="https://ai.example/blog", dedup="after").orderBy("pos").collect()
    assert len(out) == 15 and out[0].url == "https://ai.example/blog/p0"


def test_feed_first_entries_then_title_filter(spark):
    items = "".join(f"<item><title>{'' if i == 0 else f' T{i} '}</title><link> https://f/{i} </link>"
                    f"<description>d{i}</description></item>" for i in range(20))
    xml = f"<rss><channel><title>F</title>{items}</channel></rss>"
    df = spark.createDataFrame([("Feed", "papers", xml), ("Bad", "papers", "<rss><chan")],
                               "source string, category string, xml string")
    out = HV.harvest_feed(df).orderBy("pos").collect()
    assert len(out) == 14 and out[0].title == "T1" and out[0].url == "https://f/1" and out[0].pos == 2


def test_api_payload(spark):
    body = '[{"id": "org/m1", "pipeline_tag": "text-generation", "downloads": 12345, "likes": 7}, {"id": ""}]'
    df = spark.createDataFrame([("HF", "opensource", body), ("HF", "opensource", "not json")],
                               "source string, category string, body string")
    out = HV.harvest_api(df).collect()
    assert len(out) == 1 and out[0].summary == "Pipeline: text-generation  |  Downloads: 12,345  |  Likes: 7"


def test_repo_blocks(spark):
    html = ('<article class="Box-row"><h2><a href="/org/llm-kit/">x</a></h2><p> Fast inference </p>'
            '<span class="d-inline-block float-sm-right">1,077 stars today</span></article>'
            '<article class="Box-row"><p>no link</p></article>'
            '<article class="Box-row"><h2><a href="/org/cooking">x</a></h2><p>Recipes</p></article>')
    out = HV.harvest_repo_blocks(_pages(spark, html)).collect()
    assert [r.title for r in out] == ["org / llm-kit"]
    assert out[0].summary == "Fast inference  ⭐ 1,077 stars today" and out[0].url == "https://github.com/org/llm-kit"


def test_snapshot_and_paper_texts(spark):
    from pyspark.sql import functions as F
    items = "".join(f"<item><title>P{i}</title><link>https://arxiv/{i}</link><description>{'x' * 3000}</description></item>"
                    for i in range(3))
    feeds = spark.createDataFrame([("arXiv cs.AI", "papers", f"<rss><channel>{items}</channel></rss>"),
                                   ("OpenAI Blog", "company", f"<rss><channel>{items}</channel></rss>")],
                                  "source string, category string, xml string")
    papers = HV.papers_from_feeds(feeds)
    assert papers.count() == 3 and papers.select(F.max(F.length("abstract"))).first()[0] == 2000
    assert HV.harvest_feed(feeds).select(F.max(F.length("summary"))).first()[0] == 1000
    texts = HV.paper_texts(papers.unionByName(spark.createDataFrame([("", "", "u", "s", 9)], papers.schema)))
    assert texts.count() == 3
    repos = spark.createDataFrame([("o/a", "10 stars", "u", "d", 1)], "repo string, stars string, url string, description string, pos long")
    models = spark.createDataFrame([(f"m{i}", i, 0, "t", "u", i) for i in range(1, 25)],
                                   "model_id string, downloads long, likes long, pipeline_tag string, url string, pos long")
    snap = HV.snapshot("2026-02-28", papers, repos, models).first()
    assert len(snap.arxiv_papers) == 3 and len(snap.hf_models) == 20 and snap.github_repos[0].repo == "o/a"
    cat = HV.catalog_frame(spark).collect()
    assert len(cat) == 13 and cat[0].source == "arXiv cs.AI" and cat[-1].method == "API"


def test_harvest_results_as_items(spark):
    html = '<a href="/news/a">A long enough title</a>'
    links = HV.harvest_links(_pages(spark, html), "prefix", "/news/")
    items = HV.as_items(links, "Anthropic Blog", "company").collect()
    assert items[0].source == "Anthropic Blog" and items[0].summary == "" and items[0].url == "https://site.example/news/a"


def test_link_forms_by_hand(spark):
    html = ("<a class='c' href='/news/one'>Single quoted title</a>"
            "<a href=/news/two data-x=\"a>b\">Unquoted address title</a>"
            '<A title="x > y" HREF = "/news/three">It&#8217;s &#x2014; caf&eacute; &amp; tea</A>'
            '<a name="anchor">No address at all here</a>')
    out = HV.harvest_links(_pages(spark, html), "prefix", "/news/", dedup="before").orderBy("pos").collect()
    assert [(r.url, r.title) for r in out] == [
        ("https://site.example/news/one", "Single quoted title"),
        ("https://site.example/news/two", "Unquoted address title"),
        ("https://site.example/news/three", "It’s — café & tea")]


def test_numeric_entities_by_hand(spark):
    cases = {"&#65;&#x42;C": "ABC", "&#128512;!": "\U0001F600!", "&#0;": "�", "&#xD800;": "�",
             "a &lt; b &#38; c": "a < b & c", "&#38;lt; &amp;#65;": "&lt; &#65;", "no entity; &# 65;": "no entity; &# 65;", "": ""}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.d for r in df.select("t", HV.decode_entities("t").alias("d")).collect()}
    assert got == cases


def test_repo_blocks_class_order_and_quotes(spark):
    html = ("<article data-a=1 class='x Box-row y'><h2 class=\"h3\"><a data-b='1' href='/org/agent-kit'>x</a></h2><p>Tools</p>"
            '<span class="float-sm-right d-inline-block">12 stars today</span></article>'
            '<article class="Box-rowless"><h2><a href="/org/llm">x</a></h2></article>')
    out = HV.harvest_repo_blocks(_pages(spark, html)).collect()
    assert [(r.repo, r.stars) for r in out] == [("org/agent-kit", "12 stars today")]


def test_snapshot_repo_rule(spark):
    # the path counts for the snapshot, and the description is cut to 500 characters
    html = f'<article class="Box-row"><h2><a href="/org/llm-kit">x</a></h2><p>{"d" * 800}</p></article>'
    out = HV.snapshot_repos(_pages(spark, html)).collect()
    assert [(r.repo, len(r.description)) for r in out] == [("org/llm-kit", 500)]


def test_atom_feed(spark):
    xml = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>F</title>'
           '<entry><title type="html">First</title><link rel="self" href="https://f/self"/><link href="https://f/1"/>'
           '<summary>s1</summary><published>2024-01-01</published></entry>'
           '<entry><title>Second</title><link rel="alternate" href="https://f/2"/><content type="html">c2</content><updated>2024-01-02</updated></entry>'
           '<entry><link href="https://f/3"/></entry></feed>')
    df = spark.createDataFrame([("F", "papers", xml)], "source string, category string, xml string")
    out = HV.harvest_feed(df).orderBy("pos").collect()
    assert [(r.title, r.url, r.summary, r.published, r.pos) for r in out] == [
        ("First", "https://f/1", "s1", "2024-01-01", 1), ("Second", "https://f/2", "c2", "2024-01-02", 2)]
