"""A catalogue on disk that changes by whole batches.

A batch is written aside, as one part of its own size; then a manifest that names the parts
is put in place under the next version's number, which fails if that number is taken.  So a
reader sees whole batches, a job that dies leaves the table as it was, of two writers from
one version one is refused, and a batch that is run again has no effect.  Readers take each
key's last row over all parts.  Parts are merged when later ones have grown to half of an
earlier one, so there are as many as the table has doublings at most, and a row is rewritten
as often: what a batch writes follows the batch.  Merged parts stay for readers of the
version before.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.plans.scratch import exists, names_in, remove, write_once

NUMBER = "commit_"
EMPTY = {"version": 0, "parts": [], "done": {}, "rows": 0, "dropped": [], "before": 0, "pushed": 0, "after": 0}


class StaleBase(RuntimeError):
    """The table has changed since the version that a batch builds on."""


def state(spark: SparkSession, path: str) -> dict:
    """The manifest of the last version; EMPTY before the first."""
    versions = [int(x.removesuffix(".json")) for x in names_in(spark, f"{path}/commits") if x.endswith(".json")]
    if not versions:
        return EMPTY
    return json.loads(spark.read.text(f"{path}/commits/{max(versions):012d}.json", wholetext=True).first()[0])


def last_by(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that is last in order; map-side aggregation, so a key's rows never meet in one task."""
    rest = [c for c in rows.columns if c != key]
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return picked.select(key, "r.*").select(*rows.columns)


def _rows_of(spark: SparkSession, parts: list[dict], key: str, over: list[str]) -> DataFrame:
    """The last row of each key over some parts, with the number of its commit."""
    rows = spark.read.parquet(*(p["folder"] for p in parts))
    return rows if len(parts) == 1 else last_by(rows, key, [*over, NUMBER])


def _merged(parts: list[dict]) -> int:
    """How many of the last parts become one."""
    n, size = 1, parts[-1]["rows"]
    while n < len(parts) and parts[-n - 1]["rows"] <= 2 * size:
        n += 1
        size += parts[-n]["rows"]
    return n


def commit(rows: DataFrame, path: str, key: str = "url", order: tuple[str, ...] = ("seq",), newest: bool = False, base: int | None = None, batch: tuple[str, int] | None = None, counts: bool = True) -> dict:
    """Put the last row of each key of a batch into the table; returns the new manifest.

    Every column of a later batch's row takes the place of an earlier one's, nulls too; with newest,
    the row that is last in order stays instead, whichever batch it came with.  base: the version that
    the batch was made from; another one is refused.  batch: (writer, number); a writer's number that is
    done already has no effect.  counts: rows before, pushed and after, which reads the table's keys."""
    spark, now = rows.sparkSession, state(rows.sparkSession, path)
    if batch and now["done"].get(batch[0], -1) >= batch[1]:
        return now
    if base is not None and base != now["version"]:
        raise StaleBase(f"made from version {base}, the table is at {now['version']}")
    version, over = now["version"] + 1, list(order) if newest else []
    put = lambda df: (df.write.parquet(folder := f"{path}/parts/{version}-{uuid.uuid4().hex}"), folder)[1]
    folder = put(last_by(rows, key, list(order)).withColumn(NUMBER, F.lit(version)))
    pushed = spark.read.parquet(folder).count()  # from the files' footers
    after = now["rows"]
    if counts:
        known = spark.read.parquet(*(p["folder"] for p in now["parts"])).select(key) if now["parts"] else None
        mine = spark.read.parquet(folder).select(key)
        after += pushed if known is None else mine.join(known, key, "left_anti").count()
    parts = [*now["parts"], {"folder": folder, "rows": pushed}] if pushed else now["parts"]
    dropped: list[str] = []
    if pushed and (n := _merged(parts)) > 1:
        merged = put(_rows_of(spark, parts[-n:], key, over))
        dropped = [p["folder"] for p in parts[-n:]]
        parts = [*parts[:-n], {"folder": merged, "rows": spark.read.parquet(merged).count()}]
    done = now["done"] | ({batch[0]: batch[1]} if batch else {})
    new = {"version": version, "parts": parts, "done": done, "rows": after, "dropped": dropped, "before": now["rows"], "pushed": pushed, "after": after, "key": key, "over": over}
    if not write_once(spark, f"{path}/commits/{version:012d}.json", json.dumps(new)):
        raise StaleBase(f"another batch has become version {version}")
    for old in now["dropped"]:
        remove(spark, old)
    if exists(spark, earlier := f"{path}/commits/{version - 2:012d}.json"):
        remove(spark, earlier)
    return new


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table after the last commit."""
    now = state(spark, path)
    if not now["parts"]:
        raise ValueError(f"nothing has been committed to {path}")
    return _rows_of(spark, now["parts"], now["key"], now["over"]).drop(NUMBER)
