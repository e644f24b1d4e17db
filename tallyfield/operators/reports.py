"""Catalogue reports: filters, conditional aggregates, sorts and small top-k lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The section keys that coverage counts.
SECTIONS = ("thanh_phan", "cong_dung", "huong_dan", "lieu_luong", "doi_tuong", "bao_quan", "luu_y", "quy_cach")


def _any(c: str) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def rows_per_source(products: DataFrame) -> DataFrame:
    return products.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def listing(products: DataFrame) -> DataFrame:
    """Dearest first, unpriced last."""
    return products.select("item_id", "source", "name", "price", "unit", "npk").orderBy(F.desc_nulls_last("price"), "item_id")


def listing_counts(products: DataFrame) -> DataFrame:
    return products.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("price") != 0, F.lit(False))).alias("n_priced"), F.count_if(_text("npk")).alias("n_npk"))


def coverage(products: DataFrame) -> DataFrame:
    """By source, with a total row (source null)."""
    return products.rollup("source").agg(
        F.count("*").alias("n"), F.count_if(_any("images")).alias("n_images"), F.count_if(_any("videos")).alias("n_videos"),
        F.count_if(_any("specs")).alias("n_specs"), F.count_if(_text("content")).alias("n_content"),
    )


def section_coverage(products: DataFrame, sections=SECTIONS) -> DataFrame:
    counts = products.agg(*(F.count_if(F.coalesce(F.map_contains_key("sections", s), F.lit(False))).alias(s) for s in sections))
    return counts.unpivot([], list(sections), "section", "n")


def with_photo(products: DataFrame) -> DataFrame:
    return products.agg(F.count_if(_any("images")).alias("n"))


def freshness(products: DataFrame) -> DataFrame:
    return products.groupBy("source").agg(F.count("*").alias("n"), F.min("crawled_at").alias("oldest"), F.max("crawled_at").alias("newest")).orderBy(F.desc("newest"), "source")


def stock_yield(products: DataFrame) -> DataFrame:
    known = lambda c: F.count_if(F.col(c).isNotNull())
    return products.groupBy(F.coalesce("platform", F.lit("-")).alias("platform"), "source").agg(
        F.count("*").alias("n"), F.count_if(_text("sku")).alias("n_sku"), known("in_stock").alias("n_stock_known"), known("stock_qty").alias("n_qty"),
        F.count_if(_any("variants")).alias("n_variants"), F.count_if(F.coalesce(F.col("review_count") > 0, F.lit(False))).alias("n_reviewed"), known("price_max").alias("n_ranged"),
    )


def sanity(products: DataFrame) -> DataFrame:
    priced, npk, unit = F.count_if(F.col("price") > 0), F.count_if(_text("npk")), F.count_if(_text("unit"))
    share = lambda n: F.round(F.try_divide(n * 100.0, F.count("*")), 6)
    return products.agg(
        F.count("*").alias("n"), priced.alias("n_priced"), npk.alias("n_npk"), unit.alias("n_unit"),
        share(priced).alias("priced_pct"), share(npk).alias("npk_pct"), share(unit).alias("unit_pct"),
    )


def duplicate_names(products: DataFrame, k: int = 5) -> DataFrame:
    return products.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "name").limit(k)


def price_range(products: DataFrame) -> DataFrame:
    return products.filter("price > 0").agg(F.min("price").alias("lowest"), F.max("price").alias("highest"), F.round(F.avg("price"), 4).alias("mean"))


def top_formulas(products: DataFrame, k: int = 8) -> DataFrame:
    return products.filter("npk <> ''").groupBy("npk").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "npk").limit(k)


def reviews(products: DataFrame) -> DataFrame:
    """Reviewed products, most reviews first, a row for each review."""
    rows = products.filter("review_count > 0").select("item_id", "source", "name", "rating", "review_count", F.explode_outer("reviews").alias("r"))
    stars = F.coalesce(F.col("r.rating").cast("int"), F.lit(0)).alias("stars")
    return rows.select("item_id", "source", "name", "review_count", F.col("r.author").alias("author"), stars, F.substring("r.date", 1, 10).alias("day"), F.substring("r.text", 1, 100).alias("text")).orderBy(
        F.desc("review_count"), "item_id"
    )


def first_per_source(products: DataFrame, source: str | None = None) -> DataFrame:
    rows = products if source is None else products.filter(F.col("source") == source)
    return rows.groupBy("source").agg(F.min("item_id").alias("item_id"), F.min_by("url", "item_id").alias("url"))


def latest(products: DataFrame, term: str | None = None, order: str = "crawled_at") -> DataFrame:
    rows = products if term is None else products.filter(F.lower("name").contains(term.lower()))
    return rows.orderBy(F.desc(order), F.desc("item_id")).limit(1)


def search(products: DataFrame, term: str, k: int = 5) -> DataFrame:
    """Products whose name holds a term, with the stored and the re-parsed weight."""
    from tallyfield.functions.text import parse_pack_kg

    again = parse_pack_kg(F.col("name"), F.col("description")).alias("reparsed_kg")
    return products.filter(F.col("name").contains(term)).orderBy("item_id").limit(k).select("item_id", "source", "name", "price", "pack_kg", again)


def richness(products: DataFrame) -> DataFrame:
    """What the first product of each source holds; flagged if neither image nor content."""
    take = ["item_id", "images", "videos", "specs", "sections", "content"]
    one = products.groupBy("source").agg(F.min_by(F.struct(*take), "item_id").alias("p"))
    n = lambda c: F.coalesce(F.size(f"p.{c}"), F.lit(0)).cast("long")
    chars = F.coalesce(F.length("p.content"), F.lit(0)).cast("long")
    keys = F.coalesce(F.array_join(F.array_sort(F.map_keys("p.sections")), ","), F.lit(""))
    return one.select(
        "source", F.col("p.item_id").alias("item_id"), n("images").alias("n_images"), n("videos").alias("n_videos"), n("specs").alias("n_specs"),
        keys.alias("sections"), chars.alias("n_chars"), ((n("images") == 0) & (chars == 0)).alias("poor"),
    )


def run_summary(sites: DataFrame, saved: DataFrame, failed: DataFrame) -> DataFrame:
    """For each site the rows saved, whether it failed and whether it gave none."""
    counts = saved.groupBy("source").agg(F.count("*").alias("n_saved"))
    bad = failed.select("source").distinct().withColumn("bad", F.lit(True))
    rows = sites.join(counts, "source", "left").join(bad, "source", "left").select("source", F.coalesce("n_saved", F.lit(0)).alias("n_saved"), F.coalesce("bad", F.lit(False)).alias("failed"))
    return rows.withColumn("empty", F.col("n_saved") == 0)


def run_is_empty(summary: DataFrame) -> DataFrame:
    """One row: whether the whole run saved nothing, which is an error."""
    return summary.agg((F.coalesce(F.sum("n_saved"), F.lit(0)) == 0).alias("run_empty"))


class NothingSaved(RuntimeError):
    """A run that saves nothing is broken, not up to date."""


def save_run(products: DataFrame, path: str, sites: DataFrame, failed: DataFrame) -> DataFrame:
    """Write a run's rows and give its `run_summary`, counted by the writing job itself.

    The counts are metrics of the written frame, one for each configured site, so nothing is
    read again; a row of no such site counts in the total only.  A run without a row raises."""
    spark = products.sparkSession
    names = [r.source for r in sites.select("source").distinct().collect()]  # the site configuration
    bad = {r.source for r in failed.select("source").distinct().collect()}
    seen = Observation()
    counts = [F.count_if(F.col("source").eqNullSafe(F.lit(name))).alias(f"n{k}") for k, name in enumerate(names)]
    products.observe(seen, F.count("*").alias("n"), *counts).write.mode("overwrite").parquet(path)
    found = seen.get
    if not found["n"]:
        raise NothingSaved("no products were saved: selectors are out of date, or the shops refuse this network")
    rows = [(name, found[f"n{k}"], name in bad, found[f"n{k}"] == 0) for k, name in enumerate(names)]
    return spark.createDataFrame(rows, "source string, n_saved long, failed boolean, empty boolean")
