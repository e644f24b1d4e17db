"""Pages to product records: one DOM pass a page, then rules as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import dom
from tallyfield.functions import text as T
from tallyfield.plans.ship import ship

# Limits of a record and what is no merchandise photo.
MAX_CONTENT, MAX_DESCRIPTION, MAX_SECTION, MAX_SPEC, MAX_HEADING, MAX_IMAGES = 20_000, 2_000, 4_000, 600, 120, 12
IMAGE_NOISE = (
    r"(?i)facebook\.com/tr|//theme[s.]|/themes?/|logo|icon|banner|placeholder|avatar|zalo|shopee|lazada|tiktok|youtube|spinner|loading|blank|pixel|payment|bocongthuong|"
    "dmca|certificate|badge|flag|policy|bao[-_]gia|gia[-_]si|khuyen[-_]mai|freeship"
)
IMAGE_KINDS = r"(?i)\.(jpe?g|png|webp|gif)(\?|$)"
YOUTUBE = r"(?:youtube\.com/(?:embed/|watch\?v=|v/)|youtu\.be/)([\w-]{11})"
FACTS = (
    "url string, source string, name string, price_text string, description string, brand string, category string, content string, image_urls array<string>, "
    "frames array<string>, ids array<string>, spec_rows array<struct<label:string,value:string>>, parts array<struct<heading:string,body:string>>"
)
_PICKED = ("name", "price", "description", "brand", "category")


def _facts(url: str, source: str, html: str | None, selectors: dict[str, str], ended: bool = False) -> tuple:
    root = dom.parse(html, ended)
    dom.prepare(root, (*selectors.values(), *dom.FACT_SELECTORS))
    picked = [dom.text_of(dom.first(root, selectors.get(k))) for k in _PICKED]
    block = dom.content_block(root, selectors.get("content"))
    ids = list(dict.fromkeys(re.findall(YOUTUBE, html or "")))
    specs = [{"label": a, "value": b} for a, b in dom.spec_rows(root)]
    parts = [{"heading": a, "body": b} for a, b in dom.section_parts(block)]
    return url, source, *picked, dom.text_of(block), dom.image_candidates(root, url, selectors.get("gallery")), dom.video_frames(root), ids, specs, parts


def page_facts(pages: DataFrame, selectors: dict[str, dict[str, str]], ended: bool = False) -> DataFrame:
    """FACTS of each page (url, source, html); selectors are the sites' by source, from the site configuration.

    With `ended` only character references that end in ";" are read."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(pages.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(FACTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = zip(*(c.to_pylist() for c in batch.slice(k, 256).columns), strict=True)
                found = [_facts(url, source, html, selectors.get(source, {}), ended) for url, source, html in rows]
                columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return pages.select("url", "source", "html").mapInArrow(run, FACTS)


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, with x worked out once, however often f names it: in a lambda function it would be again for each element."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def product_images(urls: Column) -> Column:
    """Photos of merchandise, one for each key, those on a product path if any is, twelve at most."""
    fit = F.filter(urls, lambda u: u.startswith("http") & ~u.rlike(IMAGE_NOISE) & u.rlike(IMAGE_KINDS))
    firsts = lambda fit, keys: F.filter(fit, lambda u, i: F.array_position(keys, F.get(keys, i)) == i + 1)
    one = _let(fit, lambda fit: _let(F.transform(fit, T.image_key), lambda keys: firsts(fit, keys)))
    own = lambda one: F.filter(one, lambda u: T.path_of(u).contains("/product") | T.host_of(u).startswith("product"))
    chosen = _let(one, lambda one: _let(own(one), lambda own: F.when(F.size(own) > 0, own).otherwise(one)))
    return _let(chosen, lambda chosen: F.when(F.size(chosen) > 0, F.slice(chosen, 1, MAX_IMAGES)))


def product_videos(ids: Column, frames: Column) -> Column:
    watched = F.transform(ids, lambda i: F.concat(F.lit("https://www.youtube.com/watch?v="), i))
    return _let(F.array_distinct(F.concat(watched, frames)), lambda both: F.when(F.size(both) > 0, both))


def _first_of_keys(pairs: Column) -> Column:
    """A map of (key, value) pairs in order of arrival, the first value of a key; null if empty."""

    def first(pairs: Column, keys: Column) -> Column:
        values = F.transform(keys, lambda k: F.get(F.filter(pairs, lambda p: p["key"] == k), 0)["value"])
        return F.when(F.size(keys) > 0, F.map_from_arrays(keys, values))

    return _let(pairs, lambda pairs: _let(F.array_distinct(F.transform(pairs, lambda p: p["key"])), lambda keys: first(pairs, keys)))


def product_specs(rows: Column) -> Column:
    fit = F.filter(rows, lambda r: (r["label"] != "") & (r["value"] != "") & (F.length(r["value"]) <= MAX_SPEC))
    keyed = F.transform(fit, lambda r: F.struct(T.spec_key(r["label"]).alias("key"), r["value"].alias("value")))
    return _first_of_keys(F.filter(keyed, lambda p: p["key"].isNotNull()))


def product_sections(parts: Column, labels=T.SECTION_LABELS) -> Column:
    """Text under each labelled heading, up to the next labelled one; texts of one key joined."""
    key = lambda p: F.when((p["heading"] != "") & (F.length(p["heading"]) <= MAX_HEADING), T.label_key(p["heading"], labels))
    keyed = F.transform(parts, lambda p: F.struct(key(p).alias("key"), p["heading"].alias("heading"), p["body"].alias("body")))
    kind = "array<struct<key:string,body:string>>"

    def add(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        more = F.concat_ws(" ", last["body"], F.nullif(p["heading"], F.lit("")), F.nullif(p["body"], F.lit("")))
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["key"].alias("key"), more.alias("body"))))
        new = F.concat(done, F.array(F.struct(p["key"].alias("key"), p["body"].alias("body"))))
        return F.when(p["key"].isNotNull(), new).when(F.size(done) > 0, longer).otherwise(done)

    cut = F.aggregate(keyed, F.array().cast(kind), add)
    cut = F.transform(cut, lambda s: F.struct(s["key"].alias("key"), F.btrim(s["body"], F.lit(" :.-–—")).alias("body")))
    cut = F.filter(cut, lambda s: F.length(s["body"]) > 8)

    def joined(cut: Column, keys: Column) -> Column:
        bodies = F.transform(keys, lambda k: F.substring(F.array_join(F.transform(F.filter(cut, lambda s: s["key"] == k), lambda s: s["body"]), " "), 1, MAX_SECTION))
        return F.when(F.size(keys) > 0, F.map_from_arrays(keys, bodies))

    return _let(cut, lambda cut: _let(F.array_distinct(F.transform(cut, lambda s: s["key"])), lambda keys: joined(cut, keys)))


def products(facts: DataFrame) -> DataFrame:
    """Product records of the pages that have a name."""
    rows = facts.filter("name <> ''").withColumns({"specs": product_specs(F.col("spec_rows")), "sections": product_sections(F.col("parts"))})
    spec = lambda k: F.nullif(F.element_at("specs", k), F.lit(""))
    said = F.nullif("description", F.lit(""))
    text = F.concat_ws(" ", "name", said, spec("quy_cach"))
    return rows.select(
        "source",
        "url",
        "name",
        T.parse_price(F.nullif("price_text", F.lit(""))).alias("price"),
        F.lit("VND").alias("currency"),
        T.parse_unit(text).alias("unit"),
        T.parse_pack_kg(F.col("name"), said).alias("pack_kg"),
        F.coalesce(F.nullif("brand", F.lit("")), spec("xuat_xu")).alias("brand"),
        F.nullif("category", F.lit("")).alias("category"),
        F.coalesce(T.parse_npk(text), T.parse_npk(spec("thanh_phan"))).alias("npk"),
        F.substring(said, 1, MAX_DESCRIPTION).alias("description"),
        product_images(F.col("image_urls")).alias("images"),
        product_videos(F.col("ids"), F.col("frames")).alias("videos"),
        "specs",
        "sections",
        F.nullif(F.substring("content", 1, MAX_CONTENT), F.lit("")).alias("content"),
    )
