"""Onboarding of shops: sitemaps, category candidates, and selectors scored over sampled pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions import dom
from tallyfield.functions import text as T
from tallyfield.plans.ship import ship

# Hints and selectors of agricultural shops, and the limits of a survey.
HINTS = ("phan", "npk", "huu-co", "vi-sinh", "vo-co", "dinh-duong", "hat-giong", "giong", "thuoc", "bvtv", "vat-tu", "gia-the", "dat-trong", "che-pham", "nong", "trun-que", "kali", "dam", "lan")
BLOCKED = ("blog", "tin-tuc", "news", "gioi-thieu", "lien-he", "chinh-sach")
KEYWORDS = ("phan", "npk", "huu-co", "vi-sinh", "bon", "dam", "lan", "kali")
LINK_SELECTORS = ("a[href*='/products/']", "a[href*='/san-pham/']", "a[href*='/product/']", "a.product-name", "a.woocommerce-loop-product__link", "a.product-item__link")
NAME_SELECTORS = ("h1.product_title", "h1.product-title", "h1", ".product-title")
PRICE_SELECTORS = (".product-price", ".price-box", "p.price", ".woocommerce-Price-amount", ".product__price", ".product-single__price", ".summary .price", ".price")
DESCRIPTION_SELECTORS = (".product-summary", ".woocommerce-product-details__short-description", ".product-description", ".short-description", ".rte", ".product-detail")
TOPICS = (
    "thành phần|thanh phan|hàm lượng|công dụng|cong dung|cách dùng|cach dung|hướng dẫn|huong dan|liều lượng|lieu luong|công nghệ|cong nghe|"
    "quy cách|quy cach|xuất xứ|xuat xu|nhà sản xuất|bảo quản|lưu ý"
)
BLOCK_SELECTORS = (".rte", ".product-description", ".tab-content", ".product-summary", ".woocommerce-product-details__short-description", "#tab-description", ".product-content", ".entry-content")
MIN_LINKS, MIN_PRICED, MAX_CATEGORIES, MAX_CONFIRMED = 4, 0.6, 12, 6
TRIED_CATEGORIES, SAMPLED_PAGES = 4, 4


def sitemap_locations(sitemaps: DataFrame) -> DataFrame:
    """(host, pos, url) of the <loc> values of (host, xml)."""
    return sitemaps.select("host", F.posexplode(F.regexp_extract_all("xml", F.lit("(?s)<loc>(.*?)</loc>"), F.lit(1))).alias("pos", "url"))


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """(host, pos, url) of the Sitemap lines of (host, robots_txt)."""
    return robots.select("host", F.posexplode(F.regexp_extract_all("robots_txt", F.lit(r"(?im)^\s*sitemap:[ \t]*(\S+)"), F.lit(1))).alias("pos", "url"))


def _any_of(x: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | x.contains(w)
    return out


def category_candidates(urls: DataFrame, hints=HINTS, blocked=BLOCKED, k: int = MAX_CATEGORIES) -> DataFrame:
    """(host, url, rank): listing-like addresses with a hint word, shortest path first."""
    path = F.btrim(F.lower(T.path_of(F.col("url"))), F.lit("/"))
    rows = urls.select("host", "url").distinct().withColumn("path", path)
    like = F.col("url").contains("/collections/") | F.col("url").contains("/danh-muc/") | ~F.col("path").contains("/")
    rows = rows.filter((F.col("path") != "") & ~_any_of(F.col("path"), blocked) & like & _any_of(F.col("path"), hints))
    order = Window.partitionBy("host").orderBy(F.length(T.path_of(F.col("url"))), "url")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("host", "url", "rank")


def collections(urls: DataFrame, keywords=KEYWORDS, part: str = "/collections/") -> DataFrame:
    return urls.select("url").distinct().filter(F.col("url").contains(part) & _any_of(F.lower("url"), keywords)).orderBy("url")


def prefix_census(urls: DataFrame, k: int = 12) -> DataFrame:
    """(host, prefix, n): the most frequent first path segments of each host."""
    parts = F.filter(F.split(T.path_of(F.col("url")), "/"), lambda p: p != "")
    rows = urls.select("host", "url").distinct().select("host", F.concat(F.lit("/"), F.get(parts, 0)).alias("prefix")).filter("prefix is not null")
    counts = rows.groupBy("host", "prefix").agg(F.count("*").alias("n"))
    order = Window.partitionBy("host").orderBy(F.desc("n"), "prefix")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def _with_path(url: str) -> bool:
    return bool(dom.urlparse(url).path.strip("/"))


def _links_by_selector(root: dom.Node, url: str, selectors: tuple[str, ...]) -> list[tuple]:
    some = [(k, s, list(filter(_with_path, dom.links(root, url, s)))) for k, s in enumerate(selectors)]
    if max((len(x) for *_, x in some), default=0) < MIN_LINKS:
        cards: dict[str, int] = {}
        for _, _, selector in dom.card_selectors(root):
            cards[selector] = cards.get(selector, 0) + 1
        best = sorted(cards, key=lambda s: -cards[s])[:3]
        dom.prepare(root, best)
        some += [(len(selectors) + k, s, list(filter(_with_path, dom.links(root, url, s)))) for k, s in enumerate(best)]
    return [(k, s, len(x), x) for k, s, x in some]


def _marks(root: dom.Node) -> Iterator[tuple]:
    for holder in dom.image_holders(root):
        yield "image", holder, 1
    for node in dom.select(root, _TITLES):
        text = dom.text_of(node)
        if text and len(text) < 90:
            yield "heading", text, len(text)
    for s in BLOCK_SELECTORS:
        if (node := dom.first(root, s)) is not None:
            yield "block", s, len(dom.text_of(node))


_TITLES = "h2, h3, h4, strong, b"
#: Of a page: links by selector, first texts and hits of selectors, cards around prices, paths of prices, what a rich survey counts.
FACTS = (
    "host string, url string, links array<struct<place: int, selector: string, n: long, links: array<string>>>, texts array<struct<selector: string, text: string>>, "
    "hits array<struct<selector: string, n: long, text: string>>, cards array<struct<container: string, link: string, selector: string>>, "
    "money array<string>, marks array<struct<kind: string, what: string, size: long>>, hrefs array<struct<pos: int, link: string>>"
)


def _page(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c == "page_id"]


def page_facts(pages: DataFrame, links=LINK_SELECTORS, texts=NAME_SELECTORS + PRICE_SELECTORS + DESCRIPTION_SELECTORS, census=(), ended: bool = False) -> DataFrame:
    """FACTS of each page of (host, url, html): one parse, and one walk for all selectors, whatever is asked of them later.

    A page_id goes with them where there is one: pages of one address are told by it.  With `ended`
    only character references that end in ";" are read."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(pages.sparkSession)
    ident = _page(pages)
    kinds = StructType([*(pages.schema[c] for c in ident), *StructType.fromDDL(FACTS)])
    schema = to_arrow_schema(kinds)
    links, texts, census = tuple(links), tuple(dict.fromkeys(texts)), tuple(dict.fromkeys(census))
    every = (*links, *texts, *census, *BLOCK_SELECTORS, _TITLES, "img", "a[href]", "a")

    def of_page(*page) -> tuple:
        *ids, host, url, html = page
        root = dom.parse(html, ended)
        dom.prepare(root, every)
        some = [(s, dom.text_of(n)) for s in texts if (n := dom.first(root, s)) is not None]
        counts = [(s, len(found), dom.text_of(found[0])[:80]) for s in census if (found := dom.select(root, s))]
        hrefs = [(at, link) for link, at in dom.addresses(dom.select(root, "a"), url).items()]
        return *ids, host, url, _links_by_selector(root, url, links), some, counts, dom.card_selectors(root), dom.money_paths(root), list(_marks(root)), hrefs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = [of_page(*x) for x in zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True)]
                columns = []
                for values, kind in zip(zip(*rows, strict=True), schema.types, strict=True):
                    if pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
                        names = [kind.value_type.field(i).name for i in range(kind.value_type.num_fields)]
                        values = [[dict(zip(names, x, strict=True)) for x in cell] for cell in values]
                    columns.append(pa.array(values, kind))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return pages.select(*ident, "host", "url", "html").mapInArrow(run, kinds)


def page_links(facts: DataFrame) -> DataFrame:
    """(page_id if the facts have it, host, page_url, pos, link): the distinct web addresses of a page's links, each where it comes first among all its links."""
    return facts.select(*_page(facts), "host", F.col("url").alias("page_url"), F.inline("hrefs"))


def selector_links(facts: DataFrame) -> DataFrame:
    """(page_id if the facts have it, host, url, place, selector, n, links): links with a path that each selector finds on each listing page, in page order."""
    return facts.select(*_page(facts), "host", "url", F.inline("links"))


def best_link_selector(counts: DataFrame) -> DataFrame:
    """(host, url, selector, n_links, links) of each page: the selector with most links, the earlier of equals; none without links."""
    best = F.max_by(F.struct("n", "selector", "links"), F.struct("n", -F.col("place"))).alias("b")
    return counts.groupBy(*_page(counts), "host", "url").agg(best).filter("b.n > 0").select("host", "url", F.col("b.selector").alias("selector"), F.col("b.n").alias("n_links"), "b.links")


def sampled_pages(candidates: DataFrame, links: DataFrame, pages: DataFrame, tried: int = TRIED_CATEGORIES, k: int = SAMPLED_PAGES) -> DataFrame:
    """(host, category, rank, url, html): the first k product pages of each of a host's first categories.

    candidates: host, url, rank; links: of best_link_selector; pages: url, html (what could be fetched)."""
    listed = candidates.filter(F.col("rank") <= tried).join(links.filter(F.col("n_links") >= MIN_LINKS), ["host", "url"])
    chosen = listed.select("host", F.col("url").alias("category"), "rank", F.explode(F.slice("links", 1, k)).alias("url"))
    return chosen.join(pages.select("url", "html"), "url").select("host", "category", "rank", "url", "html")


def card_census(facts: DataFrame) -> DataFrame:
    """(container, link, selector, n) over all pages, most common first."""
    rows = facts.select(F.inline("cards"))
    return rows.groupBy("container", "link", "selector").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "container", "link")


def selector_texts(facts: DataFrame) -> DataFrame:
    """(host, url, selector, text) of the first element of each selector that a page has."""
    return facts.select("host", "url", F.inline("texts"))


def product_selectors(samples: DataFrame) -> DataFrame:
    """(host, category, rank, n_pages, name, price, description, priced_ratio) of the categories whose sampled pages can be read.

    samples: of sampled_pages.  The name differs on every page; the price with most hits covers 60 %; two pages at least."""
    key = ["host", "category", "rank"]
    n_pages = samples.groupBy(*key).agg(F.count_distinct("url").alias("n_pages")).filter("n_pages >= 2")
    texts = selector_texts(page_facts(samples.select("host", "url", "html").dropDuplicates(["host", "url"]), links=()))
    rows = samples.select(*key, "url").join(texts, ["host", "url"]).groupBy(*key, "selector").agg(
        F.count_distinct("text").alias("n_texts"),
        F.count_if((F.length("text") > 2) & (F.length("text") < 200)).alias("n_fit"),
        F.count_if(T.parse_price(F.col("text")).isNotNull()).alias("n_priced"),
        F.count_if(F.length("text") > 25).alias("n_long"),
    )
    rows = rows.join(n_pages, key)
    place = lambda selectors: F.array_position(F.array(*map(F.lit, selectors)), F.col("selector"))
    among = lambda selectors: F.col("selector").isin(*selectors)
    first = lambda ok, selectors: F.min(F.when(ok & among(selectors), F.struct(place(selectors).alias("k"), "selector")))["selector"]
    price = F.max(F.when(among(PRICE_SELECTORS) & (F.col("n_priced") > 0), F.struct("n_priced", (-place(PRICE_SELECTORS)).alias("k"), "selector")))
    out = rows.groupBy(*key, "n_pages").agg(
        first((F.col("n_texts") == F.col("n_pages")) & (F.col("n_fit") == F.col("n_pages")), NAME_SELECTORS).alias("name"),
        price.alias("p"),
        first(F.col("n_long") >= 2, DESCRIPTION_SELECTORS).alias("description"),
    )
    out = out.select(*key, "n_pages", "name", F.col("p.selector").alias("price"), "description", (F.col("p.n_priced") / F.col("n_pages")).alias("priced_ratio"))
    return out.filter(F.col("name").isNotNull() & (F.col("priced_ratio") >= MIN_PRICED))


def site_entries(candidates: DataFrame, links: DataFrame, selectors: DataFrame, known_hosts: DataFrame, known_names: DataFrame) -> DataFrame:
    """New sites: name, host, list_urls (the first category that can be read, then confirmed ones), selectors.

    candidates: host, url, rank; links: of best_link_selector; selectors: of product_selectors."""
    chosen = selectors.groupBy("host").agg(F.min_by(F.struct("category", "name", "price", "description"), "rank").alias("f"))
    listed = candidates.join(links.filter(F.col("n_links") >= MIN_LINKS), ["host", "url"]).select("host", "url", "rank", "selector")
    is_first = F.col("url") == F.col("f.category")
    rows = listed.join(chosen, "host").groupBy("host", "f").agg(
        F.max(F.when(is_first, F.col("selector"))).alias("product_link"),
        F.array_sort(F.collect_list(F.when(~is_first, F.struct("rank", "url")))).alias("others"),
    )
    urls = F.slice(F.concat(F.array("f.category"), F.col("others.url")), 1, MAX_CONFIRMED)  # at most MAX_CATEGORIES rows of a host
    named = rows.withColumn("name", F.replace(F.split_part("host", F.lit("."), F.lit(1)), F.lit("-"), F.lit("")))
    new = named.join(known_hosts.select("host"), "host", "left_anti").join(known_names.select("name"), "name", "left_anti")
    return new.select("name", "host", urls.alias("list_urls"), "product_link", F.col("f.name").alias("name_selector"), F.col("f.price").alias("price_selector"), F.col("f.description").alias("description"))


def priced_ratio(samples: DataFrame, price_text: str = "price_text", k: int = 8) -> DataFrame:
    """(listing, n, n_priced, ratio) over the first k products of each listing (listing, pos, price_text)."""
    order = Window.partitionBy("listing").orderBy("pos")
    some = samples.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    ok = T.parse_price(F.col(price_text)).isNotNull()
    return some.groupBy("listing").agg(F.count("*").alias("n"), F.count_if(ok).alias("n_priced"), F.avg(ok.cast("double")).alias("ratio"))


def selector_census(facts: DataFrame) -> DataFrame:
    """(selector, n_hits, n_pages, sample): over all pages, with the text of the first by address."""
    rows = facts.select("url", F.inline("hits"))
    return rows.groupBy("selector").agg(F.sum("n").alias("n_hits"), F.count("*").alias("n_pages"), F.min_by("text", "url").alias("sample"))


def money_paths(facts: DataFrame) -> DataFrame:
    rows = facts.select("host", F.explode("money").alias("path"))
    return rows.groupBy("host", "path").agg(F.count("*").alias("n_pages"))


def rich_survey(facts: DataFrame) -> DataFrame:
    """(kind, what, n, most): image holders, headings on a topic, and lengths of content blocks."""
    rows = facts.select(F.inline("marks"))
    rows = rows.filter((F.col("kind") != "heading") | F.col("what").rlike(f"(?iu){TOPICS}"))
    return rows.groupBy("kind", "what").agg(F.count("*").alias("n"), F.max("size").alias("most"))
