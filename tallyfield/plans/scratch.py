"""Written tables in the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names.

    Where that is unset, a temporary folder of this session if it runs on one machine, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        app, master = spark.sparkContext.applicationId, spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _own[app] = _own.get(app) or tempfile.mkdtemp(prefix="tallyfield-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: the lineage ends there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt out over all cores by these columns, where each is much work though few bytes."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *by)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing will read again."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def unstage(staged: DataFrame) -> None:
    """Delete what `stage` wrote for a table that nothing will read again."""
    for folder in {x.rsplit("/", 1)[0] for x in staged.inputFiles()}:
        remove(staged.sparkSession, folder)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it doesn't exist."""
    files, at = _file_system(spark, path)
    return [x.getPath().getName() for x in files.listStatus(at)] if files.exists(at) else []


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place as a whole; False if there is one already."""
    files, at = _file_system(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = files.create(aside)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    never = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, at, never)  # refuses to replace
    except Py4JJavaError as error:
        files.delete(aside, False)
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    return True
