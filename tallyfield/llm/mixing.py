"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources share ``total`` times all words by weight; no target exceeds
``most`` times its source, and what that cuts off is shared again by weight among the
rest.  In closed form, with sources in ascending order of cap over weight, a target is
least(cap, level * weight), where level is the first at which no cap binds any more.

Sampling: a source is due target / source_size copies.  The whole copies are certain.  For
the words still missing, a document's inclusion odds come from its size: the probability is
proportional to it (in steps of two leading digits), one at most, and such that the expected
words are those missing; documents that reach one are certain.  Documents are ranked by the
odds of a random number divided by their inclusion odds (Pareto order sampling, Rosen 1997)
and taken in that order up to the words missing: a sample of fixed size, counted in words,
with the last document taken if that ends nearer the target.  Random numbers come from doc_id
and seed, so reruns agree.

Where a source's sample ends is found by slots of rank: sums by SLOTS coarse slots, then by
SLOTS fine ones within the coarse one that the target falls in, then a window over the few
documents of one fine slot.  No window sees more than SLOTS rows of a source before that.

Defined cases: null text has size 0; null is the last source; a source without words has
target 0; documents without words are in the whole copies only; a null doc_id is one more
id; rows that repeat a doc_id are documents of their own (alike ones tie, and which of two
equal rows is taken doesn't matter), other ties of rank go by doc_id and size; long texts
are counted whole; extra columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared as S

WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2
SEED = "mix"
SLOTS = 1 << 10


def n_words(text: str = "text") -> Column:
    """Words of a text, as the length of a text with one letter for each; regexp_count would hold them all."""
    ahead = F.ltrim(F.col(text), F.lit(" \t\n\x0b\x0c\r"))
    return F.coalesce(F.length(F.regexp_replace(ahead, S.WORD + r"[\x20\x09-\x0D]*", "w")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size); one row per source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    capped = by_source.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    goal = F.sum("source_size").over(everything) * F.lit(float(total))
    level = (goal - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    leveled = capped.withColumn("level", level).withColumn("nth", F.row_number().over(order))
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("nth", "level"))).over(everything)
    return leveled.select("source", "source_size", F.least("cap", F.coalesce(free["level"] * F.col("weight"), F.col("cap"))).alias("target"))


def scale(size: Column) -> Column:
    """A size to its two leading digits."""
    step = F.pow(F.lit(10.0), F.greatest(F.length(size.cast("string")) - 2, F.lit(0)))
    return (F.floor(size / step) * step).cast("long")


def inclusion(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with `factor`: a document of scale s is in the sample with probability least(1, factor * s)."""
    classes = sized.filter("size > 0").groupBy("source", scale(F.col("size")).alias("scale")).agg(F.sum("size").alias("words"))
    rows = classes.join(goals.select(F.col("source").alias("of"), "missing"), F.col("source").eqNullSafe(F.col("of")))
    down = Window.partitionBy("source").orderBy(F.desc("scale"))  # two digits: some hundred rows
    certain = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weighed = F.sum(F.col("scale").cast("decimal(19,0)") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("factor", (F.col("missing") - certain) / weighed.cast("double"))
    first = rows.filter(F.col("factor") * F.col("scale") <= 1).groupBy("of").agg(F.max_by("factor", "scale").alias("factor"))
    return goals.join(first, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")


def _edge(rows: DataFrame, slot: str) -> DataFrame:
    """(of, edge, before) of each source: the slot in which its missing words are passed, and the words before it."""
    sums = rows.groupBy("source", slot, "missing").agg(F.sum("size").alias("words"))
    so_far = F.sum("words").over(Window.partitionBy("source").orderBy(slot).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    passed = sums.withColumn("after", so_far).filter("after > missing")
    edge = F.min(F.struct(slot, (F.col("after") - F.col("words")).alias("before"))).alias("e")
    return passed.groupBy("source").agg(edge).select(F.col("source").alias("of"), F.col(f"e.{slot}").alias("edge"), "e.before")


def mix(documents: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken for every row."""
    sized = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words().alias("size"))
    sized = S.stage(sized, "sizes")
    goals = targets(sized, weights, total, most)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goals = goals.withColumn("whole", F.floor(share)).withColumn("part", share - F.floor(share))
    goals = S.stage(goals.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    goals = S.stage(inclusion(sized, goals).withColumnRenamed("source", "of"), "odds")

    digits = F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    p = F.least(F.coalesce(F.col("factor") * scale(F.col("size")), F.lit(1.0)), F.lit(1.0))
    odds = F.when(F.col("p") < 1, (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))).otherwise(0.0)
    docs = sized.join(goals, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("p", p)
    docs = docs.withColumn("rank", F.when((F.col("part") > 0) & (F.col("size") > 0), odds))
    place = F.floor(F.col("rank") / (1 + F.col("rank")) * SLOTS * SLOTS)
    docs = docs.withColumns({"coarse": F.floor(place / SLOTS), "fine": place})
    ranked = docs.filter("rank is not null")
    coarse = S.stage(_edge(ranked, "coarse"), "coarse")
    near = ranked.join(coarse, F.col("source").eqNullSafe(F.col("of"))).filter("coarse = edge")
    # what lies before the coarse slot is no longer missing
    near = near.withColumn("missing", F.col("missing") - F.col("before")).select("source", "fine", "missing", "size")
    fine = S.stage(_edge(near, "fine").withColumnRenamed("edge", "cut").withColumnRenamed("before", "within"), "fine")
    ends = coarse.join(fine.withColumnRenamed("of", "too"), F.col("of").eqNullSafe(F.col("too"))).select("of", "cut", (F.col("before") + F.col("within")).alias("before"))
    ends = S.stage(ends, "ends")  # of known size: the documents aren't shuffled to meet it
    docs = docs.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    at_cut = F.coalesce(F.col("fine") == F.col("cut"), F.lit(False))
    clear = docs.filter(~at_cut).withColumn("extra", (F.col("rank").isNotNull() & (F.col("cut").isNull() | (F.col("fine") < F.col("cut")))).cast("long"))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    close = docs.filter(at_cut).withColumn("extra", (ahead + F.col("size") / 2 < F.col("missing")).cast("long"))
    out = clear.unionByName(close).withColumn("copies", F.col("whole") + F.col("extra"))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST(list_extract([3, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)) AS DOUBLE) AS weight,
        CAST(source_size * 2 AS DOUBLE) AS cap FROM s),
l AS (SELECT *, ((SELECT CAST(sum(source_size) AS DOUBLE) FROM s) * CAST(1.5 AS DOUBLE)
        - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
        row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS nth FROM w),
t AS (SELECT source, source_size, least(cap, (SELECT level FROM l WHERE level * weight <= cap ORDER BY nth LIMIT 1) * weight) AS target FROM l),
f AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS share FROM t),
g AS (SELECT *, CAST(floor(share) AS BIGINT) AS whole, share - floor(share) AS part, target - floor(share) * source_size AS missing FROM f),
z AS (SELECT *, CAST(floor(size / power(10, greatest(length(CAST(size AS VARCHAR)) - 2, 0))) * power(10, greatest(length(CAST(size AS VARCHAR)) - 2, 0)) AS BIGINT) AS scale FROM d),
k AS (SELECT z.source, scale, missing, sum(size) AS words FROM z JOIN g ON z.source IS NOT DISTINCT FROM g.source WHERE size > 0 GROUP BY z.source, scale, missing),
o AS (SELECT source, scale, (missing - coalesce(CAST(sum(words) OVER (PARTITION BY source ORDER BY scale DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
        / CAST(sum(CAST(scale AS HUGEINT) * words) OVER (PARTITION BY source ORDER BY scale DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS factor FROM k),
b AS (SELECT source, arg_max(factor, scale) AS factor FROM o WHERE factor * scale <= 1 GROUP BY source),
u AS (SELECT *, (CAST(CAST(concat('0x', substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':mix')), 1, 13)) AS BIGINT) AS DOUBLE) + 0.5)
        / 4503599627370496.0::DOUBLE AS u FROM z),
p AS (SELECT u.doc_id, u.source, u.size, u.u, g.source_size, g.target, g.whole, g.missing, g.part, least(coalesce(b.factor * u.scale, 1.0::DOUBLE), 1.0::DOUBLE) AS p
        FROM u JOIN g ON u.source IS NOT DISTINCT FROM g.source LEFT JOIN b ON u.source IS NOT DISTINCT FROM b.source),
r AS (SELECT *, CASE WHEN part > 0 AND size > 0 THEN CASE WHEN p < 1 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 0 END END AS rank FROM p),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM r)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN rank IS NOT NULL AND ahead + size / 2 < missing THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
"""
