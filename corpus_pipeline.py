"""Corpus pipeline over `documents`: quality rules, near duplicates, decontamination, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, with the columns it
was given; the last one returns the token index.  `run` writes what each stage returns and
reads it again, so a later failure never costs an earlier stage.

Defined cases, beyond those of the operators: a row with null doc_id is in no group, so
the near-duplicate stage keeps it; of rows that repeat a doc_id and are their groups' first it
keeps one, the least by hash of text and row, so reruns agree; the mix
repeats a row as often as the copies it takes, and leaves rows out that it takes none of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfield.llm import _shared, decontamination, mixing, ngram_jaccard, quality, token_output


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = [f"c{k}" for k in range(len(docs.columns))]
    of = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names).withColumns({"key": F.col(of["doc_id"]).cast("long"), "print": F.xxhash64(F.col(of["text"]).cast("string"))})
    first = ngram_jaccard.jaccard_groups(docs).filter("doc_id = component_id").select(F.col("doc_id").alias("key"), "print").distinct()
    kept = rows.filter("key is not null").join(first, ["key", "print"], "left_semi")
    if not kept.groupBy("key").count().filter("count > 1").isEmpty():
        # of rows that share a doc_id and a component the least stays
        kept = kept.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("print", F.xxhash64(*names)))).filter("nth = 1")
    return kept.unionByName(rows.filter("key is null"), allowMissingColumns=True).select(*names).toDF(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    key = ["doc_id", "source", "size"]
    taken = _shared.stage(mixing.mix(docs).select(*key, "copies"), "copies")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("of"), mixing.n_words().alias("words"))
    on = rows["id"].eqNullSafe(taken["doc_id"]) & rows["of"].eqNullSafe(taken["source"]) & (rows["words"] == taken["size"])
    if not taken.groupBy(*key).count().filter("count > 1").isEmpty():
        # rows with one key meet one to one
        taken = taken.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("copies")))
        rows = rows.withColumn("nth_row", F.row_number().over(Window.partitionBy("id", "of", "words").orderBy("row.text")))
        on = rows["id"].eqNullSafe(taken["doc_id"]) & rows["of"].eqNullSafe(taken["source"])
        on &= (rows["words"] == taken["size"]) & (rows["nth_row"] == taken["nth"])
    chosen = rows.join(taken.filter("copies > 0"), on).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return chosen.select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.token_output(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("token-ID output", tokens),
]
#: SQL has no zstandard, no edit-distance bands and no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = _shared.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
