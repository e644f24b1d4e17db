"""Sitemaps of hosts: from robots.txt and sitemap indexes to page addresses, level by level.

A level is one join of the maps that it asks for with what could be fetched; limits are ranks
within a list, and the stop rule is a running total over a host's few maps, so hosts and
levels are worked on together whatever their number.  Addresses are exploded last.

Fetched maps are (url, xml), one row a url; a map that isn't among them could not be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.plans.scratch import stage

# How many maps of a host and maps of an index are read, and the addresses after which no further map is.
MAPS, SUB_MAPS, ENOUGH = 2, 8, 6000
#: Maps read of an index that names no collections.
FIRST_MAPS = 4


def _locations(xml: Column) -> Column:
    return F.regexp_extract_all(xml, F.lit(r"<loc>([^\n]*?)</loc>"), F.lit(1))


def root_maps(robots: DataFrame, most: int = MAPS) -> DataFrame:
    """(host, map_no, url): the first maps that (host, robots_txt) names, or the usual two places."""
    named = F.regexp_extract_all(F.coalesce("robots_txt", F.lit("")), F.lit(r"(?i)sitemap:\s*(\S+)"), F.lit(1))
    usual = F.array(*(F.concat(F.lit("https://"), "host", F.lit(f"/{file}")) for file in ("sitemap.xml", "sitemap_index.xml")))
    rows = robots.select("host", F.when(F.size(named) > 0, named).otherwise(usual).alias("maps"))
    return rows.select("host", F.posexplode(F.slice("maps", 1, most)).alias("map_no", "url"))


def expand(robots: DataFrame, fetched: DataFrame, maps: int = MAPS, sub_maps: int = SUB_MAPS, enough: int = ENOUGH, levels: int = 1) -> DataFrame:
    """(host, map_no, path, pos, url) of every address that a host's maps lead to, in order of these.

    A map that lists .xml files is an index: its first `sub_maps` files are read instead of its
    addresses, down to `levels` below the first; what the last level lists are addresses, whatever
    they end in.  path holds the place of each index on the way.  A host's map is left out if the
    maps before it have more than `enough` addresses."""
    read = F.col("url").alias("file"), _locations(F.col("xml")).alias("found")
    files = fetched.select(*read)
    now = root_maps(robots, maps).withColumn("path", F.array().cast("array<int>"))
    leaves = []
    for level in range(levels + 1):
        rows = now.join(files, now["url"] == files["file"]).select("host", "map_no", "path", "found")
        if level == levels:
            leaves.append(rows)
            break
        rows = stage(rows.withColumn("below", F.filter("found", lambda x: x.endswith(".xml"))), "maps")
        leaves.append(rows.filter("size(below) = 0").drop("below"))
        now = rows.select("host", "map_no", "path", F.posexplode(F.slice("below", 1, sub_maps)).alias("nth", "url"))
        now = now.select("host", "map_no", F.array_append("path", F.col("nth")).alias("path"), "url")
    every = leaves[0]
    for more in leaves[1:]:
        every = every.unionByName(more)
    every = stage(every, "leaves")
    before = Window.partitionBy("host").orderBy("map_no").rowsBetween(Window.unboundedPreceding, -1)  # `maps` rows at most
    totals = every.groupBy("host", "map_no").agg(F.sum(F.size("found")).alias("n"))
    kept = totals.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).filter(F.col("before") <= enough).select("host", "map_no")
    return every.join(kept, ["host", "map_no"]).select("host", "map_no", "path", F.posexplode("found").alias("pos", "url"))


def collection_addresses(hosts: DataFrame, fetched: DataFrame, keywords, part: str = "/collections/", first: int = FIRST_MAPS) -> DataFrame:
    """(host, url): distinct addresses of collections with a keyword.

    Of a host's sitemap.xml the files that name collections are read, or its first ones if none does."""
    files = fetched.select(F.col("url").alias("file"), _locations(F.col("xml")).alias("found"))
    index = hosts.select("host", F.concat(F.lit("https://"), "host", F.lit("/sitemap.xml")).alias("file")).join(files, "file")
    named = F.filter("found", lambda x: x.contains("collection"))
    chosen = index.select("host", F.explode(F.when(F.size(named) > 0, named).otherwise(F.slice("found", 1, first))).alias("file"))
    urls = chosen.join(files, "file").select("host", F.explode("found").alias("url")).filter(F.col("url").contains(part))
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.lower("url").contains(word)
    return urls.filter(hit).distinct()
