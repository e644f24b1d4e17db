"""Shop payloads (JSON text) to one structured record, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tallyfield.functions.text import clean_markup, host_of, money
from tallyfield.sources.products import REVIEW, STRUCTURED

# Shop payload fields, minor units of the shop scripts, marks of embedded data.
HARAVAN = (
    "title string, price string, price_min string, price_max string, vendor string, type string, available boolean, tags array<string>, images array<string>, content string, "
    "description string, variants array<struct<title:string,sku:string,price:string,compare_at_price:string,available:boolean,inventory_quantity:bigint>>"
)
HARAVAN_MINOR = 100
WOO = (
    "array<struct<id:bigint,name:string,sku:string,is_in_stock:boolean,low_stock_remaining:int,average_rating:string,review_count:int,description:string,short_description:string,"
    "prices:struct<price:string,currency_minor_unit:int,price_range:struct<min_amount:string,max_amount:string>>,categories:array<struct<name:string>>,brands:array<struct<name:string>>,"
    "tags:array<struct<name:string>>,images:array<struct<src:string>>,variations:array<struct<id:bigint,attributes:array<struct<value:string>>>>>>"
)
WOO_REVIEWS = "array<struct<reviewer:string,rating:double,date_created:string,review:string>>"
EMBEDDED = (
    ("json_ld_product", r'"@type"\s*:\s*"Product"'), ("next_data", "__NEXT_DATA__"), ("nuxt", "__NUXT__"), ("window_product", r"window\.product\s*="),
    ("var_product", r"var\s+product\s*="), ("itemprop_price", r"itemprop=[\"']price"), ("variants_array", r'"variants"\s*:\s*\['),
    ("inventory_quantity", "inventory_quantity"), ("available", r'"available"\s*:'),
)
_LD = r"(?si)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"


def _without_dots(url: Column) -> Column:
    """url with the . and .. segments of its path resolved."""
    site, path, rest = (F.regexp_extract(url, r"^([A-Za-z][\w+.-]*://[^/?#]*)([^?#]*)(.*)$", k) for k in (1, 2, 3))
    parts = F.split(F.substr(path, F.lit(2), F.length(path)), "/")
    none = F.array().cast("array<string>")
    fold = F.aggregate(parts, none, lambda s, p: F.when(p == "..", F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))).when(p == ".", s).otherwise(F.concat(s, F.array(p))))
    end = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.rlike(r"/\.{1,2}(/|$)"), F.concat(site, F.lit("/"), F.array_join(fold, "/"), end, rest)).otherwise(url)


def absolute_url(base: Column, url: Column) -> Column:
    """url as seen from base."""
    site = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][\w+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(url.rlike(r"^[A-Za-z][\w+.-]*:"), url)
        .when(url.startswith("//"), F.concat(F.regexp_extract(base, "^([^:]+:)", 1), url))
        .when(url.startswith("/"), _without_dots(F.concat(site, url)))
        .otherwise(_without_dots(F.concat(folder, url)))
    )


def _record(ok: Column, **fields: Column) -> Column:
    """A struct of STRUCTURED, with nulls for what isn't given; null unless ok."""
    columns = [fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in STRUCTURED.fields]
    return F.when(ok, F.struct(*columns))


def _once(value: Column, body) -> Column:
    """body(value), with value computed once for all its fields."""
    return F.get(F.transform(F.array(value), body), 0)


def _variant(title: Column, sku: Column, price: Column, compare_at: Column, available: Column, stock: Column, number: Column) -> Column:
    return F.struct(
        title.alias("title"), sku.alias("sku"), price.cast("double").alias("price"), compare_at.cast("double").alias("compare_at"),
        available.cast("boolean").alias("available"), stock.cast("bigint").alias("stock"), number.cast("bigint").alias("id"),
    )



def parse_haravan(body: Column, base: Column) -> Column:
    """Accepted only with a list of variants.  Stock is the sum of whole quantities, below zero as zero."""
    return _once(F.from_json(body, HARAVAN), lambda d: _haravan_record(d, base))


def _haravan_record(d: Column, base: Column) -> Column:
    v = d["variants"]
    quantities = F.filter(F.transform(v, lambda x: x["inventory_quantity"]), lambda q: q.isNotNull())
    skus = F.filter(F.transform(v, lambda x: F.nullif(x["sku"], F.lit(""))), lambda s: s.isNotNull())
    in_major = lambda x: money(x, HARAVAN_MINOR)
    return _record(
        v.isNotNull(),
        name=clean_markup(d["title"]),
        price=in_major(d["price"]),
        price_min=in_major(d["price_min"]),
        price_max=in_major(d["price_max"]),
        sku=F.get(skus, 0),
        vendor=clean_markup(d["vendor"]),
        product_type=clean_markup(d["type"]),
        tags=F.coalesce(d["tags"], F.array().cast("array<string>")),
        in_stock=d["available"],
        stock_qty=F.when(F.size(quantities) > 0, F.aggregate(quantities, F.lit(0).cast("bigint"), lambda s, q: s + F.greatest(q, F.lit(0)))),
        variants=F.transform(v, lambda x: _variant(x["title"], F.nullif(x["sku"], F.lit("")), in_major(x["price"]), in_major(x["compare_at_price"]), x["available"], x["inventory_quantity"], F.lit(None))),
        images=F.transform(F.coalesce(d["images"], F.array().cast("array<string>")), lambda i: absolute_url(base, i)),
        content_html=F.coalesce(F.nullif(d["content"], F.lit("")), d["description"]),
    )


def _names(x: Column) -> Column:
    return F.coalesce(F.transform(x, lambda e: e["name"]), F.array().cast("array<string>"))


def woo_first(body: Column) -> Column:
    return F.get(F.from_json(body, WOO), 0)


def parse_woo(body: Column) -> Column:
    return _once(woo_first(body), _woo_record)


def _woo_record(d: Column) -> Column:
    prices = d["prices"]
    minor = F.pow(F.lit(10.0), F.coalesce(prices["currency_minor_unit"], F.lit(0)))
    none = F.lit(None)
    title = lambda x: F.nullif(F.array_join(F.transform(x["attributes"], lambda a: F.coalesce(a["value"], F.lit("None"))), " / "), F.lit(""))
    return _record(
        d.isNotNull(),
        name=clean_markup(d["name"]),
        price=money(prices["price"], minor),
        price_min=money(prices["price_range"]["min_amount"], minor),
        price_max=money(prices["price_range"]["max_amount"], minor),
        sku=F.nullif(d["sku"], F.lit("")),
        vendor=clean_markup(F.get(d["brands"], 0)["name"]),
        product_type=clean_markup(F.get(d["categories"], 0)["name"]),
        tags=_names(d["tags"]),
        in_stock=d["is_in_stock"],
        stock_qty=d["low_stock_remaining"],
        rating=d["average_rating"].try_cast("double"),
        review_count=F.coalesce(d["review_count"], F.lit(0)),
        variants=F.transform(F.coalesce(d["variations"], F.from_json(F.lit("[]"), "array<struct<id:bigint,attributes:array<struct<value:string>>>>")), lambda x: _variant(title(x), none, none, none, none, none, x["id"])),
        images=F.filter(F.transform(d["images"], lambda i: i["src"]), lambda s: F.coalesce(s != "", F.lit(False))),
        content_html=F.coalesce(F.nullif(d["description"], F.lit("")), d["short_description"]),
    )


def parse_woo_reviews(reviews: Column, product: Column) -> Column:
    """Reviews, only where the product (first of its list) has an id and a review count."""
    d = woo_first(product)
    rows = F.transform(
        F.from_json(reviews, WOO_REVIEWS),
        lambda r: F.struct(clean_markup(r["reviewer"]).alias("author"), r["rating"].alias("rating"), r["date_created"].alias("date"), clean_markup(r["review"]).alias("text")),
    )
    return F.when((d["review_count"] > 0) & (d["id"] != 0), rows).cast(ArrayType(REVIEW))


def parse_jsonld(html: Column) -> Column:
    """The first JSON-LD product of a page: blocks in order, bad JSON skipped, @graph and lists opened."""
    blocks = F.transform(F.regexp_extract_all(html, F.lit(_LD), F.lit(1)), F.try_parse_json)
    get = F.try_variant_get

    def items(v: Column) -> Column:
        one = F.when(F.schema_of_variant(v).startswith("OBJECT"), F.array(v))
        return F.coalesce(get(v, '$["@graph"]', "array<variant>"), get(v, "$", "array<variant>"), one)

    found = F.flatten(F.filter(F.transform(F.filter(blocks, lambda b: b.isNotNull()), items), lambda a: a.isNotNull()))
    item = F.get(F.filter(found, lambda x: F.coalesce(get(x, '$["@type"]', "string") == "Product", F.lit(False))), 0)
    return _once(item, _jsonld_record)


def _jsonld_record(item: Column) -> Column:
    get = F.try_variant_get

    def text(path: str) -> Column:
        return F.nullif(get(item, path, "string"), F.lit(""))

    def offer(name: str) -> Column:
        return F.coalesce(get(item, f"$.offers.{name}", "string"), get(item, f"$.offers[0].{name}", "string"))

    there = F.nullif(offer("availability"), F.lit(""))
    is_text = lambda path: F.schema_of_variant(F.coalesce(get(item, path, "variant"), F.parse_json(F.lit("null")))) == "STRING"
    listed = F.transform(F.filter(get(item, "$.image", "array<variant>"), lambda x: F.schema_of_variant(x) == "STRING"), lambda x: get(x, "$", "string"))
    images = F.when(is_text("$.image"), F.array(get(item, "$.image", "string"))).otherwise(F.coalesce(listed, F.array().cast("array<string>")))
    brand = F.when(is_text("$.brand"), get(item, "$.brand", "string")).otherwise(get(item, "$.brand.name", "string"))
    return _record(
        item.isNotNull(),
        name=clean_markup(text("$.name")),
        price=money(offer("price")),
        sku=text("$.sku"),
        vendor=clean_markup(brand),
        product_type=clean_markup(text("$.category")),
        tags=F.array().cast("array<string>"),
        in_stock=F.when(there.isNotNull(), there.contains("InStock")),
        rating=money(get(item, "$.aggregateRating.ratingValue", "string")),
        review_count=F.nullif(get(item, "$.aggregateRating.reviewCount", "string").try_cast("int"), F.lit(0)),
        variants=F.array().cast(STRUCTURED["variants"].dataType),
        images=images,
        content_html=text("$.description"),
    )


def embedded_census(pages: DataFrame) -> DataFrame:
    """(url, marker, n): how often each mark of embedded data occurs on a page; zeros left out."""
    counts = F.array(*(F.struct(F.lit(name).alias("marker"), F.regexp_count("html", F.lit(mark)).cast("long").alias("n")) for name, mark in EMBEDDED))
    return pages.select("url", F.inline(counts)).filter("n > 0")


def hosts(pages: DataFrame) -> DataFrame:
    return pages.select("*", host_of(F.col("url")).alias("host"))
