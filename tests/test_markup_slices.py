from tidewatch.functions.markup import SLICE, Selector, covered, scan, scanned
from tidewatch.session import ship_package
from tidewatch.sources import harvest as HV


def test_only_texts_inside_elements_leave_the_scan(spark):
    ship_package(spark)
    html = "<p>out</p>" * 50 + "<a href='/x'>one<b>two</b><a href='/y'>three</a></a>between<a href='/z'></a><p>after</p>"
    page = spark.createDataFrame([(1, "https://e.example/", html)], "page_id int, url string, html string")
    got = page.select(scanned("html", [Selector("a", "a")]).alias("s")).select("s.texts").first()[0]
    assert got == ["one", "two", "three"]
    links = [(r.href, r.title) for r in HV.anchors(page).orderBy("pos").collect()]
    assert links == [("/x", "onetwothree"), ("/y", "three"), ("/z", "")]


def test_elements_keep_their_texts():
    texts, elements, _ = scan("a<a href=1>b<a href=2>c</a>d</a>e<a href=3></a>f<a href=4>g", [Selector("a", "a")])
    before = [texts[e["first"]:e["until"]] for e in elements]
    kept = covered(texts, elements)
    assert [kept[e["first"]:e["until"]] for e in elements] == before and kept == ["b", "c", "d", "g"]


def test_a_batch_of_several_slices_keeps_its_rows(spark):
    fill = "x" * (SLICE // 2)
    rows = [(i, "https://e.example/", None if i == 2 else f"<p>{fill}</p><a href='/p{i}'>title {i}</a>") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").coalesce(1)
    got = sorted((r.page_id, r.url, r.title) for r in HV.harvest_links(pages, "prefix", "/", min_title=3).collect())
    assert got == [(i, f"https://e.example/p{i}", f"title {i}") for i in range(6) if i != 2]
    assert HV.rejected_pages(pages).select("page_id", "reason").collect() == [(2, "empty page")]
