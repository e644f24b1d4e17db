"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches, in ascending doc_id order.  The lines seen so far are kept as
runs: tables of 128-bit line hashes, bucketed and sorted by hash, each hash in one run only.
A batch is reduced to its distinct line hashes, which are merge-joined with each run in turn
to tell old from new (runs need no shuffle and no sort, as their buckets are those of the
join), and what is new becomes a run of level 0.  When a level holds FANOUT runs they are
merged, bucket by bucket, into one of the next level.

The first batch has one of FIRST_SHARE lines of the table (FIRST_LINES at least), each further
one as many as came before it: the work grows with the table, whatever its size.
`LineRuns.open` keeps runs under a path: what a job commits there, the next job's batches
are held against, so new documents lose the lines of earlier jobs.

A line of a batch is dropped if its hash is in a run, or occurs in a smaller doc_id of the
batch.  All of this is DataFrame work.  Hashes are aggregated before any shuffle, and lines
so frequent that HOT at most can be are joined by broadcast, so a line that every document
has is one row per task.

Defined cases: null or empty text is one empty line; a line's key is the line without
[\\x20\\x09-\\x0D] at both ends and with A-Z lower-cased; keys shorter than ``min_chars``
code points are never dropped; a null doc_id keeps all lines and counts for nobody; rows
that share a doc_id are one document where they have equal texts, and otherwise each is
judged by its own lines, none of which counts as earlier than the other's; equal lines of
one document stay (ties); long texts are split whole; extra columns are ignored, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as S

MIN_CHARS = 10
FIRST_LINES, FIRST_SHARE = 1 << 10, 8
FANOUT = 2
#: Lines of a bucket, about, and most lines of a batch that are joined by broadcast.
BUCKET_LINES, HOT = 1 << 18, 10_000
KEY = ["h", "h2"]
_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@contextmanager
def _settings(spark: SparkSession, **wanted: str):
    """Session settings for the plans that are run within."""
    names = {k: f"spark.sql.{k.replace('__', '.')}" for k in wanted}
    before = {name: spark.conf.get(name, None) for name in names.values()}
    for k, value in wanted.items():
        spark.conf.set(names[k], value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class LineRuns:
    """The levelled runs of (h, h2) seen so far, under a path."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 8, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout is 2 at least")
        self.spark, self.path = spark, path or S.scratch_path(spark, "runs")
        self.buckets, self.fanout, self.version = buckets, fanout, 0
        self.levels: list[list[str]] = []
        self.tables: dict[str, str] = {}  # catalogue names of the bucketed folders in use

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int = 64, fanout: int = FANOUT) -> LineRuns:
        """The runs that were last committed under path; none if path is new."""
        runs = cls(spark, path, buckets, fanout)
        if S.exists(spark, f"{path}/manifest"):
            rows = spark.read.schema("version int, buckets int, level int, place int, run string").json(f"{path}/manifest")
            last = rows.join(rows.agg(F.max("version").alias("version")), "version").collect()  # a row for each run
            runs.version, runs.buckets = last[0].version, last[0].buckets
            for r in sorted(last, key=lambda r: (r.level, r.place)):
                runs.levels += [[] for _ in range(r.level + 1 - len(runs.levels))]
                if r.run:
                    runs.levels[r.level].append(r.run)
        return runs

    def commit(self) -> None:
        """Make what was added last: call it when the job's output is written, as a job that is run again before that must not meet its own lines."""
        self.version += 1
        rows = [(self.version, self.buckets, n, k, run) for n, level in enumerate(self.levels) for k, run in enumerate(level)] or [(self.version, self.buckets, 0, 0, "")]
        self.spark.createDataFrame(rows, "version int, buckets int, level int, place int, run string").coalesce(1).write.mode("append").json(f"{self.path}/manifest")

    def settings(self):
        """Let joins use the runs' buckets and order, with as many partitions."""
        return _settings(
            self.spark, shuffle__partitions=str(self.buckets), legacy__bucketedTableScan__outputOrdering="true", sources__bucketing__autoBucketedScan__enabled="false",
            sources__bucketing__enabled="true",
        )

    def bucketed(self, df: DataFrame, name: str) -> str:
        """Write df under the path, bucketed and sorted by the key; returns the folder's name."""
        folder, table = f"{name}-{uuid.uuid4().hex}", f"lines_{uuid.uuid4().hex}"
        df.write.format("parquet").option("path", f"{self.path}/{folder}").bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(table)
        self.tables[folder] = table
        return folder

    def read(self, folder: str) -> DataFrame:
        if folder not in self.tables:
            table = f"lines_{uuid.uuid4().hex}"
            self.spark.sql(f"CREATE TABLE {table} (h BIGINT, h2 BIGINT) USING parquet CLUSTERED BY (h, h2) SORTED BY (h, h2) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{folder}'")
            self.tables[folder] = table
        return self.spark.table(self.tables[folder])

    def close(self) -> None:
        """Take the folders out of the catalogue; their files stay."""
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def marked(self, hashes: DataFrame) -> DataFrame:
        """Distinct hashes with `old`: whether any run has them.  One merge join a run."""
        old = F.lit(False)
        for k, run in enumerate(self.runs()):
            hashes = hashes.join(self.read(run).withColumn(f"in{k}", F.lit(True)).hint("merge"), KEY, "left")
            old = old | F.col(f"in{k}").isNotNull()
        return hashes.withColumn("old", old).drop(*(f"in{k}" for k in range(len(self.runs()))))

    def add(self, hashes: DataFrame) -> None:
        """Add a run of hashes that no run has, then compact full levels."""
        run, level = self.bucketed(hashes.select(*KEY), "run"), 0
        while True:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < self.fanout:
                return
            merged = self.read(self.levels[level][0])
            for more in self.levels[level][1:]:
                merged = merged.join(self.read(more).hint("merge"), KEY, "full")
            self.levels[level] = []
            run, level = self.bucketed(merged.select(*KEY), "run"), level + 1


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACE)), _UPPER, _UPPER.lower())


def line_hashes(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, print of the text, at, h, h2) of the lines that are long enough."""
    lines = documents.filter("doc_id is not null").select("doc_id", "print", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    keys = lines.select("doc_id", "print", "at", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keys.select("doc_id", "print", "at", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeated_lines(batch: DataFrame, runs: LineRuns) -> DataFrame:
    """(doc_id, print, at) of a batch's lines that came before; the runs then hold the batch too."""
    with runs.settings():
        own = batch.groupBy(*KEY).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
        marked = runs.read(runs.bucketed(runs.marked(own), "batch"))
        runs.add(marked.filter("not old"))
        again = marked.filter("old or lo < hi").select(*KEY, F.when(~F.col("old"), F.col("lo")).alias("keep"), "n")
        n_lines = marked.agg(F.sum("n")).first()[0] or 0
        often = n_lines // HOT  # fewer than HOT hashes are more frequent
        hot = F.broadcast(again.filter(F.col("n") > often).drop("n"))
        rare = batch.join(F.broadcast(marked.filter(F.col("n") > often).select(*KEY)), KEY, "left_anti").join(again.filter(F.col("n") <= often).drop("n"), KEY)
        out = [x.filter("keep is null or doc_id > keep").select("doc_id", "print", "at") for x in (batch.join(hot, KEY), rare)]
        return S.stage(out[0].union(out[1]), "repeats")


def _cuts(lines: DataFrame, first: int) -> tuple[list, int]:
    """(doc_ids that end a batch, lines in all): each batch as large as what came before, the first one `first` lines at least."""
    total = lines.count()
    shares, done = [], max(first, total // FIRST_SHARE)
    while done < total:
        shares.append(done / total)
        done *= 2
    cuts = lines.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    return sorted(set(cuts)), total


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS, first_lines: int = FIRST_LINES, fanout: int = FANOUT, runs: LineRuns | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text).  With `runs`, lines that they hold are dropped too, and they then hold these; commit them when the output is written."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("print", F.xxhash64("text"))
    lines = S.stage(line_hashes(docs, min_chars), "lines")
    cuts, total = _cuts(lines, first_lines)
    edges = [None, *cuts, None]
    own = runs is None
    runs = runs or LineRuns(documents.sparkSession, buckets=max(1, -(-total // BUCKET_LINES)), fanout=fanout)
    found = None
    try:
        for low, high in zip(edges, edges[1:], strict=False):
            batch = lines
            if low is not None:
                batch = batch.filter(F.col("doc_id") > low)
            if high is not None:
                batch = batch.filter(F.col("doc_id") <= high)
            some = repeated_lines(batch, runs)
            found = some if found is None else found.union(some)
    finally:
        if own:
            runs.close()
    gone = found.groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("at")).alias("gone"))
    whole = docs.join(gone.hint("shuffle_hash"), ["doc_id", "print"], "left")
    whole = whole.select("doc_id", F.split("text", "\n", -1).alias("lines"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    # what lies between dropped lines, piece by piece
    after, before = F.concat(F.array(F.lit(-1)), "gone"), F.concat("gone", F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(after, before, lambda a, b: F.slice("lines", a + 2, b - a - 1)))
    return whole.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.when(F.size("gone") == 0, F.col("lines")).otherwise(kept), "\n").alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone FROM k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""
