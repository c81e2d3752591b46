"""The page scanner against Python's html.parser on random pages, damaged and huge pages, and the harvests over them."""

import html as H
import random
import time
from html.parser import HTMLParser

import pytest

from tidewatch.functions.markup import RAW, VOID, Selector, scan
from tidewatch.sources import harvest as HV


class _Tree(HTMLParser):
    """Elements with all text nodes below them, from parser events: another way than ranges over one list."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.done, self.nodes = [], [], []
        self.data = []

    def node(self):
        text = "".join(self.data).strip()
        self.data = []
        if text and not any(t == "template" for t, *_ in self.open) and not (self.open and self.open[-1][0] in RAW):
            self.nodes.append(text)
            for element in self.open:
                element[3].append(text)

    def handle_starttag(self, tag, attrs):
        self.node()
        attrs = {k: v or "" for k, v in attrs}
        element = (tag, attrs.get("href"), attrs.get("class", "").split(), [], [t for t, *_ in self.open])
        self.done.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        self.node()
        if any(t == tag for t, *_ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.data.append(data)

    def handle_comment(self, data):
        self.node()

    handle_decl = handle_pi = handle_comment


def _random_page(rng):
    tags = ["a", "p", "b", "div", "article", "h1", "template", "span", "A", "br", "img"]
    out = []
    for _ in range(rng.randint(1, 60)):
        kind = rng.random()
        if kind < 0.35:
            attrs = []
            for name in rng.sample(["href", "class", "data-x", "HREF2", "checked"], rng.randint(0, 3)):
                value = rng.choice(["/x", "a b", "x>y", "it's", "&amp;&lt;", "é", "1/2/"])
                form = rng.choice(["d", "d", "s", "u", "n"])
                if form == "d":
                    attrs.append(f'{name}="{value}"')
                elif form == "s":
                    attrs.append(f"{name} = '" + value.replace("'", "") + "'")
                elif form == "u":
                    attrs.append(f"{name}=" + "".join(c for c in value if c not in " >'"))
                else:
                    attrs.append(name)
            out.append("<" + " ".join([rng.choice(tags), *attrs]) + rng.choice([">", ">", ">", " >", " />"]))
        elif kind < 0.6:
            out.append(f"</{rng.choice(tags)}" + rng.choice([">", " >"]))
        elif kind < 0.65:
            out.append("<!-- a <b> > comment -->")
        elif kind < 0.7:
            out.append("<script>if (a < b) { t = '</p>' }</script>")
        elif kind < 0.73:
            out.append("<!DOCTYPE html>")
        else:
            out.append(rng.choice([" ", "\n", "text ", "&amp;", "&eacute;", "&#8217;", "a < b", "1 <2", "x\xa0", "　", "&nbsp;y"]))
    return "".join(out)


@pytest.mark.parametrize("seed", range(8))
def test_scan_equals_html_parser_on_random_pages(seed):
    rng = random.Random(seed)
    names = ["a", "p", "article", "h1", "span", "div"]
    for _ in range(60):
        page = _random_page(rng)
        tree = _Tree()
        tree.feed(page)
        tree.close()
        tree.node()
        texts, elements, _ = scan(page, [Selector(n, n) for n in names])
        assert texts == tree.nodes, page
        got = [(e["label"], e["href"], texts[e["first"]:e["until"]]) for e in elements]
        assert got == [(t, h, x) for t, h, _, x, _ in tree.done if t in names], page
        inside = scan(page, [Selector("link", "a", within="div"), Selector("c", "span", ("a", "b"))])[1]
        want = [("link" if t == "a" else "c") for t, _, c, _, up in tree.done if t == "a" and "div" in up or t == "span" and {"a", "b"} <= set(c)]
        assert [e["label"] for e in inside] == want, page


@pytest.mark.parametrize("seed", range(4))
def test_first_elements_of_nested_blocks(seed):
    rng = random.Random(100 + seed)
    wanted = [Selector("title", "h1"), Selector("text", "p"), Selector("inner", "article")]
    for _ in range(60):
        page = _random_page(rng)
        _, elements, blocks = scan(page, wanted, Selector("block", "article"))
        tree = _Tree()
        numbered = []  # (tag, numbers of the open articles) of each element in order

        def start(tag, attrs, original=tree.handle_starttag, tree=tree, numbered=numbered):
            numbered.append((tag, [e[5] for e in tree.open if e[0] == "article"]))
            original(tag, attrs)
            if tag == "article":
                tree.done[-1] = (*tree.done[-1], sum(t == "article" for t, _ in numbered) - 1)
                tree.open[-1] = tree.done[-1]

        tree.handle_starttag = start
        tree.feed(page)
        tree.close()
        count = sum(t == "article" for t, _ in numbered)
        want = [[any(t == s.tag and b in up for t, up in numbered) for s in wanted] for b in range(count)]
        assert [[f >= 0 for f in found] for found in blocks] == want, page
        assert all(elements[f]["label"] == s.label for found in blocks for f, s in zip(found, wanted) if f >= 0)


DAMAGED = {
    "tag of 4 kB": "<a " + "x " * 2000,
    "tag of 1 MB": "<a " + "x " * 500_000 + ">late",
    "no close at all": "<a href='/news/one" * 5_000,
    "lone quotes": "\"<a href=\"/news/x" * 5_000 + "'",
    "open blocks": "<article><h1>t" * 2_000,
    "only ends": "</article></a>" * 10_000,
    "only signs": "<" * 50_000,
    "open comment": "<a href=/news/1>A title of a link</a><!-- " + "<a href=/news/2>" * 5_000,
    "open script": "<script>" + "<a href=/news/2>x</a>" * 5_000,
    "open links": "<a href=/news/a>word " * 5_000,
}


@pytest.mark.parametrize("name", DAMAGED)
def test_damaged_pages_scan_in_linear_time(name):
    def took(page):
        start = time.process_time()
        scan(page, [Selector("a", "a"), Selector("h", "h1")], Selector("b", "article"))
        scan(page, [Selector("a", "a")])
        return time.process_time() - start

    page = DAMAGED[name]
    assert took(page * 3) < 8 * took(page) + 1  # three times the page; a square would be 9 times, and minutes


def test_no_page_stops_the_others(spark):
    good = '<a href="/news/good">A good and long title</a><article class="Box-row"><h2><a href="/o/llm">x</a></h2><h1>LLM</h1></article>'
    pages = [(i, "https://s.example/", page) for i, page in enumerate([*DAMAGED.values(), None, "", " \n", good])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    last = len(pages) - 1
    for rule, dedup in (("prefix", "before"), ("contains", "after")):
        rows = HV.harvest_links(df, rule, "/news/", dedup=dedup).collect()
        assert [r.title for r in rows if r.page_id == last] == ["A good and long title"]
        assert max(r.pos for r in rows) and {r.page_id for r in rows} >= {last, 7}
    assert [r.repo for r in HV.harvest_repo_blocks(df).collect()] == ["o/llm"]
    assert {r.title for r in HV.harvest_blocks(df, relevance=False).collect() if r.page_id == last} == {"LLM"}
    assert sorted((r.page_id, r.reason) for r in HV.rejected_pages(df).collect()) == [(i, "empty page") for i in (last - 3, last - 2, last - 1)]


def test_nested_blocks_and_paragraphs(spark):
    page = ("<article><h1>Outer</h1><p>one<article><p>inner text</p><h1>Inner</h1></article><p>two</article>"
            "<article><p>no title</p></article><article><h1></h1></article>")
    df = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    got = [(r.pos, r.title, r.description) for r in HV.harvest_blocks(df, relevance=False).orderBy("pos").collect()]
    assert got == [(1, "Outer", "oneinner textInner"), (2, "Inner", "inner text"), (4, "", "")]


def test_unclosed_links_share_the_rest_of_the_page(spark):
    df = spark.createDataFrame([(1, "https://s.example/", "<a href=/news/a>first part <a href=/news/b>second part")], "page_id long, url string, html string")
    got = [(r.url, r.title) for r in HV.harvest_links(df, "prefix", "/news/").orderBy("pos").collect()]
    assert got == [("https://s.example/news/a", "first partsecond part"), ("https://s.example/news/b", "second part")]


def test_rejected_feeds_and_lists(spark):
    item = "<item><title>T</title></item>"
    feeds = [("ok", f"<rss><channel>{item}</channel></rss>"), ("cut", f"<rss><channel>{item}"), ("page", "<html><body>503</body></html>"),
             ("none", None), ("blank", "  "), ("empty", "<rss></rss>")]
    df = spark.createDataFrame([(s, "papers", x) for s, x in feeds], "source string, category string, xml string")
    got = {r.source: r.reason for r in HV.rejected_feeds(df).collect()}
    assert got == {"cut": "not well-formed, or without a channel or entries", "page": "not a feed: html", "none": "empty payload",
                   "blank": "empty payload", "empty": "not well-formed, or without a channel or entries"}
    assert {r.source for r in HV.harvest_feed(df).collect()} == {"ok"}
    lists = [("ok", '[{"id": "a"}]'), ("none", None), ("object", '{"error": "x"}'), ("cut", '[{"id": "a"'), ("empty", "[]")]
    df = spark.createDataFrame([(s, "opensource", x) for s, x in lists], "source string, category string, body string")
    got = {r.source: r.reason for r in HV.rejected_lists(df).collect()}
    assert got == {"none": "empty payload", "object": "not a list", "cut": "not well-formed JSON"}


def test_entities_as_python_decodes_them():
    page = "".join(f"<a href='{H.escape(c)}'>{H.escape(c)}&eacute;&#x2014;</a>" for c in ("a&b", '"q"', "<x>"))
    texts, elements, _ = scan(page, [Selector("a", "a")])
    assert [e["href"] for e in elements] == ["a&b", '"q"', "<x>"]
    assert texts == ["a&bé—", '"q"é—', "<x>é—"]
