"""Merging payloads over page records, platform choice, and re-derivation of parsed fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.functions.text import parse_npk, parse_pack_kg, parse_unit, platform_of

MAX_IMAGES = 12


def _filled(x: Column) -> Column:
    return F.when(F.size(x) > 0, x)


def choose_payload(haravan: Column, woo: Column, jsonld: Column, use_jsonld: bool = True) -> Column:
    """The first source that has a payload."""
    return F.coalesce(haravan, woo, jsonld) if use_jsonld else F.coalesce(haravan, woo)


def merge_structured(pages: DataFrame, payloads: DataFrame, key: str = "url") -> DataFrame:
    """Page records with their shop's payload laid over them.

    payloads: key, platform, d (the structured payload, may be null), reviews.  The payload
    wins on price if it has one, and on sku, price range, stock and ratings even with null;
    vendor and type win unless empty; a payload's images replace the page's; formula and
    weight are only filled from its name.  Without a payload only the platform is set.
    """
    over = payloads.select(key, F.col("platform").alias("_platform"), F.col("d").alias("_d"), F.col("reviews").alias("_reviews"))
    rows = pages.join(over, key, "left")
    d, has = F.col("_d"), F.col("_d").isNotNull()

    def taken(name: str, value: Column) -> Column:
        kind = pages.schema[name].dataType
        return F.when(has, value.cast(kind)).otherwise(F.col(name))

    name = F.nullif(d["name"], F.lit(""))
    api_images = F.filter(d["images"], lambda x: x != "")
    changed = {
        "price": F.coalesce(F.when(d["price"] != 0, d["price"]), F.col("price")),
        "price_min": d["price_min"],
        "price_max": d["price_max"],
        "sku": d["sku"],
        "brand": F.coalesce(F.nullif(d["vendor"], F.lit("")), F.col("brand")),
        "category": F.coalesce(F.nullif(d["product_type"], F.lit("")), F.col("category")),
        "in_stock": d["in_stock"].cast("int"),
        "stock_qty": d["stock_qty"],
        "rating": d["rating"],
        "review_count": d["review_count"],
        "tags": _filled(d["tags"]),
        "variants": _filled(d["variants"]),
        "reviews": _filled(F.col("_reviews")),
        "images": F.when(F.size(api_images) > 0, F.slice(api_images, 1, MAX_IMAGES)).otherwise(F.col("images")),
        "npk": F.coalesce(F.nullif(F.col("npk"), F.lit("")), parse_npk(name), F.col("npk")),
        "pack_kg": F.coalesce(F.col("pack_kg"), parse_pack_kg(name)),
    }
    out = [taken(c, changed[c]).alias(c) if c in changed else F.coalesce("_platform", c).alias(c) if c == "platform" else F.col(c) for c in pages.columns]
    return rows.select(*out)


def site_platforms(pages: DataFrame, configured: DataFrame | None = None) -> DataFrame:
    """(source, platform): the configured one, else the guess from the source's first page with a product.

    pages: source, seq, html, is_product."""
    guess = pages.filter("is_product").groupBy("source").agg(F.min_by(platform_of(F.col("html")), "seq").alias("guess"))
    if configured is None:
        return guess.withColumnRenamed("guess", "platform")
    both = configured.select("source", "platform").join(guess, "source", "full")
    return both.select("source", F.coalesce("platform", "guess").alias("platform"))


def reparse(products: DataFrame) -> DataFrame:
    """Formula, weight and unit recomputed from name and description; `changed` if formula or weight differ.

    Rows that don't change keep what they have, their unit too."""
    text = F.concat_ws(" ", F.nullif("name", F.lit("")), F.nullif("description", F.lit("")))
    new = products.withColumns({"new_npk": parse_npk(text), "new_kg": parse_pack_kg(F.col("name"), F.col("description")), "new_unit": parse_unit(text)})
    changed = ~(F.col("npk").eqNullSafe(F.col("new_npk")) & F.col("pack_kg").eqNullSafe(F.col("new_kg")))
    new = new.withColumns({"changed": changed, "newly_parsed": F.col("pack_kg").isNull() & F.col("new_kg").isNotNull()})
    pick = {"npk": "new_npk", "pack_kg": "new_kg", "unit": "new_unit"}
    return new.withColumns({c: F.when(F.col("changed"), F.col(n)).otherwise(F.col(c)) for c, n in pick.items()}).drop(*pick.values())


def reparse_counts(reparsed: DataFrame) -> DataFrame:
    return reparsed.agg(F.count("*").alias("total"), F.count_if("changed").alias("updated"), F.count_if("newly_parsed").alias("newly_parsed"))
