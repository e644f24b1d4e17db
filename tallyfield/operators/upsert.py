"""Upserts by url into a written catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_of_each(batch: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """The last row of each key; map-side aggregation, so a key's rows never meet in one task."""
    rest = [c for c in batch.columns if c != key]
    last = batch.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("last"))
    return last.select(key, "last.*").select(*batch.columns)


def upsert(existing: DataFrame, batch: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """existing with every column of the batch's rows in place of its own, nulls too."""
    new = last_of_each(batch, key, order)
    return existing.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def copy_counts(source: DataFrame, target: DataFrame, key: str = "url", order: str = "seq") -> DataFrame:
    """before, pushed and after counts of upserting source into target; one row."""
    pushed = source.groupBy(key).agg(F.lit(1).alias("new"))
    have = target.groupBy(key).agg(F.lit(1).alias("old"))
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return have.join(pushed, key, "full").agg(n("old").alias("before"), n("new").alias("pushed"), F.count("*").alias("after"))


def first_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("first")).select(key, "first.*").select(*df.columns)


def ranked(df: DataFrame, key: str, *order) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
