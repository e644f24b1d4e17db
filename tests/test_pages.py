"""DOM pass and record rules on small pages."""

import pytest
from pyspark.sql import functions as F

from tallyfield import catalogue_queries
from tallyfield.functions import dom
from tallyfield.operators import extract, onboard


def test_links():
    html = '<a href="/a">1</a><a href="#x"></a><a href="tel:1"></a><a href="/a"></a><a href="https://b.vn/c#d"></a>'
    assert dom.links(dom.parse(html), "https://s.vn/l", "a") == ["https://s.vn/a", "https://b.vn/c#d"]


def test_repair_and_text():
    root = dom.parse("<p><b>one<br><p>two</p><ul><li>a<li>b</ul><script>var t='</p>'</script>")
    assert dom.text_of(root) == "one two a b"
    assert len(dom.select(root, "ul li")) == 2


def test_selectors():
    root = dom.parse('<div class="c d" id="i"><a href="/products/1" x="v"></a></div>')
    for css in ("div.c.d a", "#i a", "a[href]", "a[href*='/products/']", "a[x='v']", "*", "p, a"):
        assert dom.select(root, css), css
    assert not dom.select(root, "div.e a") and not dom.select(root, "a div")


def records(spark, html, selectors=None):
    rows = spark.createDataFrame([("https://s.vn/x", "s", html)], "url string, source string, html string")
    return extract.products(extract.page_facts(rows, {"s": {"name": "h1", **(selectors or {})}})).collect()


def test_sections_and_specs(spark):
    html = (
        '<h1>NPK 16-16-8</h1><div class="rte"><h3>Công dụng</h3><p>Tăng năng suất</p><h3>Khác</h3><p>abc</p></div><div class="rte">x</div>'
        "<table><tr><td>Quy cách</td><td>bao 25kg</td></tr><tr><td>Quy cách</td><td>khác</td></tr><tr><td>a</td><td>b</td><td>c</td></tr></table>"
        "<dl><dt>Xuất xứ</dt><dd>VN</dd><dt>thừa</dt></dl>"
    )
    (r,) = records(spark, html)
    assert r.sections == {"cong_dung": "Tăng năng suất Khác abc"}
    assert r.specs == {"quy_cach": "bao 25kg", "xuat_xu": "VN"}
    assert (r.npk, r.unit, r.brand, r.pack_kg) == ("16-16-8", "bao 25kg", "VN", None)
    assert records(spark, "<h1> </h1>") == [] and records(spark, None) == []


def test_images(spark):
    html = (
        '<meta property="og:image" content="/i/a-300x300.jpg"><h1>n</h1><div class="g"><img data-src="/i/a.jpg" src="/spin.gif">'
        '<img src="/i/logo.png"><img src="data:x"><img src="/i/b.webp?x=1"></div><img src="/i/c.jpg">'
    )
    (r,) = records(spark, html, {"gallery": ".g"})
    assert r.images == ["https://s.vn/i/a-300x300.jpg", "https://s.vn/i/b.webp?x=1"]
    (r,) = records(spark, html + '<img src="/product/d.jpg">')
    assert r.images == ["https://s.vn/product/d.jpg"]


def test_videos(spark):
    (r,) = records(spark, '<h1>n</h1><iframe src="https://youtu.be/abcdefghijk"></iframe><iframe src="https://player.vimeo.com/1"></iframe>')
    assert r.videos == ["https://www.youtube.com/watch?v=abcdefghijk", "https://player.vimeo.com/1"]


def site_of(spark, categories, details):
    pages = spark.createDataFrame(categories, "host string, url string, html string")
    links = onboard.best_link_selector(onboard.selector_links(onboard.page_facts(pages)))
    fetched = spark.createDataFrame(details, "url string, html string")
    candidates = onboard.category_candidates(pages)
    found = onboard.product_selectors(onboard.sampled_pages(candidates, links, fetched))
    none = spark.createDataFrame([], "host string"), spark.createDataFrame([], "name string")
    return links, found, onboard.site_entries(candidates, links, found, *none)


def test_site_found_from_samples(spark):
    cards = "".join(f'<div class="card"><a class="n" href="/san/{k}">p</a><span>1{k}.000 đ</span></div>' for k in range(9))
    # from the fifth on all have one name, and the second can't be fetched
    details = [(f"https://a-b.vn/san/{k}", f"<h1>name {min(k, 4)}</h1><p class='price'>1{k}.000 đ</p>") for k in range(9) if k != 1]
    links, found, sites = site_of(spark, [("a-b.vn", "https://a-b.vn/phan", cards)], details)
    assert [(r.selector, r.n_links) for r in links.collect()] == [("a.n", 9)]
    (row,) = found.collect()
    assert (row["name"], row.price, row.description, row.priced_ratio, row.n_pages) == ("h1", "p.price", None, 1.0, 3)
    site = sites.first()
    assert (site["name"], site.list_urls, site.product_link) == ("ab", ["https://a-b.vn/phan"], "a.n")


def test_site_takes_the_first_category_that_can_be_read(spark):
    page = lambda c: "".join(f'<a href="/products/{c}{k}">p</a>' for k in range(4))
    categories = [("s.vn", f"https://s.vn/phan{x}", page(c)) for x, c in (("", "a"), ("-b", "b"), ("-cc", "c"))] + [("s.vn", "https://s.vn/phan-long", '<a href="/products/x">x</a>')]
    prices = {"a": "liên hệ", "b": "12.000 đ", "c": "15.000 đ"}
    details = [(f"https://s.vn/products/{c}{k}", f"<h1>name {c}{k}</h1><p class='price'>{p}</p>") for c, p in prices.items() for k in range(4)]
    _, found, sites = site_of(spark, categories, details)
    assert sorted(r.category for r in found.collect()) == ["https://s.vn/phan-b", "https://s.vn/phan-cc"]
    assert sites.first().list_urls == ["https://s.vn/phan-b", "https://s.vn/phan", "https://s.vn/phan-cc"]


def test_all_onboarding_facts_of_one_parse(spark):
    html = '<div class="card"><a class="n" href="/phan">NPK</a> <b>Thành phần</b><img src="x.jpg"><p class="price">10.000 đ</p></div><a href="#x">y</a>'
    pages = spark.createDataFrame([("h", "https://h/l", html), ("h", "https://h/m", None)], "host string, url string, html string")
    facts = onboard.page_facts(pages, links=("a",), texts=("b", "i"), census=("p", "a", "i"))
    assert [(r.url, r.selector, r.n, r.links) for r in onboard.selector_links(facts).collect()][:2] == [("https://h/l", "a", 1, ["https://h/phan"]), ("https://h/l", "a.n", 1, ["https://h/phan"])]
    assert [tuple(r) for r in onboard.selector_texts(facts).collect()] == [("h", "https://h/l", "b", "Thành phần")]
    assert {(r.selector, r.n_hits, r["sample"]) for r in onboard.selector_census(facts).collect()} == {("p", 1, "10.000 đ"), ("a", 2, "NPK")}
    assert [tuple(r) for r in onboard.card_census(facts).collect()] == [(".card", "a.n", "a.n", 1)]
    assert [tuple(r) for r in onboard.money_paths(facts).collect()] == [("h", "p.price < div.card", 1)]
    assert {tuple(r) for r in onboard.rich_survey(facts).collect()} == {("image", ".card", 1, 1), ("heading", "Thành phần", 1, 10)}
    assert [tuple(r) for r in onboard.page_links(facts).collect()] == [("h", "https://h/l", 0, "https://h/phan")]


def test_misnested_sections(spark):
    html = "<h1>n</h1><div class=rte><b>Công dụng<p>tăng</b> năng suất</p><table>lề<tr><td>Quy cách<td><i>bao<p>50kg</i></table></div>"
    (r,) = records(spark, html)
    assert r.sections == {"cong_dung": "tăng năng suất lề Quy cách bao 50kg"} and r.specs == {"quy_cach": "bao 50kg"}


def test_bad_addresses_and_deep_pages(spark):
    html = "<h1>n</h1><img src='http://[x/a.jpg'><img src='/product/b.jpg'><a href='http://[x'>x</a><div class=rte><h3>Công dụng</h3>" + "<b><i>" * 3000 + "deep text" + "</b>" * 9000
    (r,) = records(spark, html)
    assert r.images == ["https://s.vn/product/b.jpg"] and r.sections == {"cong_dung": "deep text"}
    assert dom.links(dom.parse(html), "https://s.vn", "a") == []
    broken = dom.parse('<p class="x>one</p><p title=it\'s>two')
    assert dom.text_of(broken) == "one two" and len(dom.select(broken, "p")) == 2


def test_addresses_with_dots(spark):
    from tallyfield.operators.payload import absolute_url

    cases = {"../i/a.jpg": "https://s.vn/i/a.jpg", "./b.jpg?x=../y": "https://s.vn/p/b.jpg?x=../y", "/c/../../d.jpg": "https://s.vn/d.jpg", "e/..": "https://s.vn/p/", "//h/x": "https://h/x", "f.jpg": "https://s.vn/p/f.jpg"}
    rows = spark.createDataFrame([("https://s.vn/p/q", u) for u in cases], "base string, u string")
    assert {r.u: r.x for r in rows.select("u", absolute_url(F.col("base"), F.col("u")).alias("x")).collect()} == cases


def test_enabled_sites(spark, tmp_path):
    import json

    from tallyfield.sources import products as tables

    sites = [{"name": "a", "enabled": True, "list_urls": ["u"], "selectors": {"name": "h1", "brand": None}}, {"name": "b", "enabled": False}, {"name": "c"}]
    (tmp_path / "sites.json").write_text(json.dumps(sites, indent=1))
    rows = {r["name"]: r for r in tables.read_sites(spark, f"{tmp_path}/sites.json").collect()}
    assert set(rows) == {"a", "c"} and rows["a"].selectors == {"name": "h1", "brand": None} and rows["c"].list_urls is None


def test_robots_sitemap_lines(spark):
    rows = spark.createDataFrame([("h", "User-agent: *\nSitemap: https://h/s.xml\nsitemap: https://h/t.xml")], "host string, robots_txt string")
    assert [r.url for r in onboard.robots_sitemaps(rows).orderBy("pos").collect()] == ["https://h/s.xml", "https://h/t.xml"]


def test_image_and_link_functions_are_columns(spark):
    assert spark.range(1).select(extract.product_images(F.array().cast("array<string>"))).first()[0] is None


def two_pages_of_one_address(spark, tmp_path):
    """A folder whose pages 1 and 2 have one address; page 1 repeats links and ends its title in an open character reference."""
    one = '<h1>cut &amp;&amp</h1><article>a &lt;b&gt; &amp</article><nav><a href="#x">x</a><a href="/a">1</a><a href="/a">2</a><a href="/b">3</a></nav>'
    rows = [(1, "https://h.vn/l", one), (2, "https://h.vn/l", '<h1>n</h1><article>b</article><nav><a href="/a">1</a><a href="/c">2</a></nav>')]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.mode("overwrite").parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_links_of_pages_with_one_address(spark, tmp_path):
    rows = catalogue_queries.QUERIES["ex1_links"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted((r.page_url, r.n_links) for r in rows) == [("https://h.vn/l", 2), ("https://h.vn/l", 2)] and len({r.links_md5 for r in rows}) == 2


def test_link_selectors_of_pages_with_one_address(spark, tmp_path):
    rows = catalogue_queries.QUERIES["ob5_link_selectors"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted((r.host, r.url, r.selector, r.n_links) for r in rows) == [("h.vn", "https://h.vn/l", "nav a", 2)] * 2


def test_frontier_of_pages_with_one_address(spark, tmp_path):
    rows = catalogue_queries.QUERIES["fr1_frontier"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted((r.final_url, r.listing) for r in rows) == [("https://h.vn/a", 1), ("https://h.vn/b", 1), ("https://h.vn/c", 2)]


def test_places_of_links_count_repeated_ones(spark, tmp_path):
    rows = catalogue_queries.QUERIES["fr1_frontier_limited"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted((r.listing, r.pos, r.url) for r in rows) == [(1, 1, "https://h.vn/a"), (1, 3, "https://h.vn/b"), (2, 1, "https://h.vn/c")]


def test_fresh_links_of_pages_with_one_address(spark, tmp_path):
    rows = catalogue_queries.QUERIES["fr4_fresh_links"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted((r.listing, r.page, r.n_links, r.n_fresh) for r in rows) == [("h.vn", 1, 2, 2), ("h.vn", 2, 2, 1)]


def test_references_that_end_or_not():
    html = "<p title='?a&copy=1&amp;b'>x&amp;lt; &amp &ampx; &#65; &#66 &lt;</p>"
    as_browsers, ended = dom.parse(html), dom.parse(html, ended=True)
    assert dom.text_of(as_browsers) == "x&lt; & &x; A B <" and dom.text_of(ended) == "x&lt; &amp &ampx; A &#66 <"
    assert dom.first(ended, "p").attrs["title"] == "?a&copy=1&b"


def test_pick_keeps_a_reference_cut_short(spark, tmp_path):
    rows = catalogue_queries.QUERIES["ex2_pick"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted(r.h1 for r in rows) == ["cut &&amp", "n"]


def test_content_keeps_a_reference_cut_short(spark, tmp_path):
    rows = catalogue_queries.QUERIES["ex4_content"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted(r.n_chars for r in rows) == [1, len("a <b> &amp")]


def test_products_keep_a_reference_cut_short(spark, tmp_path):
    rows = catalogue_queries.QUERIES["ex10_products"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert sorted(r["name"] for r in rows) == ["cut &&amp", "n"]


def test_titles_keep_a_reference_cut_short(spark, tmp_path):
    rows = catalogue_queries.QUERIES["ob13_facts"](spark, two_pages_of_one_address(spark, tmp_path)).collect()
    assert {(r.kind, r.what, r.n) for r in rows} == {("selector", "h1", 2), ("host", "h.vn", 4), ("title", "cut &&amp", 1), ("title", "n", 1)}


def test_one_walk_a_page(monkeypatch):
    """Selectors that were looked for once aren't sought again."""
    walks, walk = [], dom.hits
    monkeypatch.setattr(dom, "hits", lambda top, selectors: walks.append(top) or walk(top, selectors))
    extract._facts("https://s.vn/x", "s", "<h1>n</h1><div class=rte>a</div><img src=a.jpg><table><tr><td>a<td>b</table><dl><dt>a<dd>b</dl>", {"name": "h1"})
    assert len(walks) == 1


@pytest.mark.parametrize("name", ["ex9_misnested", "ex3_ex9_rich"])
def test_small_files_are_parsed_on_all_cores(spark, sf, name):
    assert catalogue_queries.QUERIES[name](spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_photos_are_keyed_once(spark):
    """Forty photos, each in two sizes: twelve are left, the first of each key."""
    urls = [f"https://s.vn/product/{k // 2}{'-30x30' if k % 2 else ''}.jpg" for k in range(80)]
    found = spark.createDataFrame([(urls,)], "u array<string>").select(extract.product_images(F.col("u")).alias("x"))
    assert found.first().x == urls[:24:2]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("2,4}x") == 1
