"""Helpers that several corpus operators share: scratch tables, hashing, sorted runs.

Text work inside tasks is numpy over Arrow batches; Spark does the partitioning,
sorting and shuffling.  A word is ``[^\\x20\\x09-\\x0D]+``, which is what
``bytes.split()`` without arguments yields on UTF-8.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfield.plans.scratch import exists, remove, scratch_path, stage, unstage  # noqa: F401
from tallyfield.plans.ship import ship

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are hashed at once.
CHUNK = 1 << 20
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SPACES = tuple(bytes([c]) for c in b" \t\n\x0b\x0c\r")
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing steps of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: What is kept of eight bytes of which so many belong to the word.
_KEPT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the first byte of each word, and of the byte after it."""
    b = np.frombuffer(data, np.uint8)
    space = np.ones(len(b) + 2, bool)
    space[1:-1] = (b == 32) | (b - np.uint8(9) < 5)
    return np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])


def word_lanes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the words, eight at a time as integers, a word's last ones padded by zeros; how many of these each word has)."""
    n = (ends - starts + 7) >> 3
    at = np.repeat(starts - 8 * (np.cumsum(n) - n), n) + 8 * np.arange(int(n.sum()))
    eights = np.ndarray((len(data) + 1,), "<u8", data + bytes(8), strides=(1,))
    return eights[at] & _KEPT[np.minimum(np.repeat(ends, n) - at, 8)], n


def hash_lanes(lanes: np.ndarray, n: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A word's hash: the sum of its lanes, each mixed by itself and again with its place, mixed with the word's size.

    No sum of powers: those are alike, whatever the base, for long words of two letters in some orders."""
    if not len(n):
        return np.empty(0, np.uint64)
    first = np.cumsum(n) - n
    place = np.arange(len(lanes)) - np.repeat(first, n)
    parts = mix(mix(lanes + _GOLDEN) ^ (place.astype(np.uint64) * _MULTIPLIER))
    return mix(np.add.reduceat(parts, first) + sizes.astype(np.uint64) * _GOLDEN)


def hash_words(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words that lie between starts and ends."""
    lanes, n = word_lanes(data, starts, ends)
    return hash_lanes(lanes, n, ends - starts)


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hash of each word of a text.

    A long text is hashed in pieces cut at white space, so memory follows CHUNK."""
    out, at = [], 0
    while at < len(data):
        end = len(data)
        if end - at > CHUNK:
            cut = max(data.rfind(c, at, at + CHUNK) for c in _SPACES)
            if cut < 0:  # one word longer than a piece
                cut = min((x for c in _SPACES if (x := data.find(c, at)) >= 0), default=end - 1)
            end = cut + 1
        piece = data[at:end]
        out.append(hash_words(piece, *word_bounds(piece)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def hashed_texts(ids: list, texts: list[bytes]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, word hashes, where each text's words start and the last ends), some texts at a time."""
    k = 0
    while k < len(texts):
        j, size = k + 1, len(texts[k])
        while j < len(texts) and size + len(texts[j]) < CHUNK:
            size += len(texts[j]) + 1
            j += 1
        if j == k + 1:
            h = word_hashes(texts[k])
            yield ids[k:j], h, np.array([0, len(h)])
        else:
            data = b" ".join(texts[k:j])
            starts, ends = word_bounds(data)
            offsets = np.cumsum([0, *(len(x) + 1 for x in texts[k:j])])
            yield ids[k:j], hash_words(data, starts, ends), np.searchsorted(starts, offsets)
        k = j


def window_hashes(words: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (empty if there are fewer), by doubling."""
    if len(words) < k or k < 1:
        return np.empty(0, np.uint64)
    m = int(_MULTIPLIER) + 2 * salt  # odd

    def joined(left: np.ndarray, right: np.ndarray, n_left: int, n_right: int) -> np.ndarray:
        right = right[n_left:]
        return left[: len(right)] * np.uint64(pow(m, n_right, 1 << 64)) + right

    done, have, part, width, rest = None, 0, words, 1, k
    while True:
        if rest & 1:
            done = part if done is None else joined(done, part, have, width)
            have += width
        rest >>= 1
        if not rest:
            return mix(done[: len(words) - k + 1] + np.uint64(k * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        part = joined(part, part, width, width)
        width *= 2


def whole_windows(starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: (first word of each run of k words within one text, its text, its place there)."""
    lengths = np.maximum(np.diff(starts) - k + 1, 0)
    text = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return starts[:-1][text] + place, text, place


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def batches_of(schema: pa.Schema, pieces: Iterator[tuple[np.ndarray, ...]], rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Gather tuples of equally long arrays into record batches of about so many rows."""
    held, n = [], 0

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, schema.types, strict=True)], schema=schema)

    for piece in pieces:
        held.append(piece)
        n += len(piece[0])
        if n >= rows:
            yield flush()
            held, n = [], 0
    if n:
        yield flush()


def sized_batches(rows: Iterator[tuple[int, tuple]], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of (bytes, row), cut where the bytes reach `most`."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for n, row in rows:
        held.append(row)
        size += n
        if size >= most:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def run_lengths(batches: Iterator[pa.RecordBatch], keys: int, cap: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Over rows sorted by their first `keys` columns: (columns, length of each row's run, cap at most).

    Fewer than `cap` rows of a run are ever held, so one run may span any number of batches.
    """
    held: list[np.ndarray] | None = None
    over: list | None = None  # the key of an open run that has reached cap
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if over is not None and len(columns[0]):
            same = np.logical_and.reduce([c == k for c, k in zip(columns, over, strict=False)])
            n = len(same) if same.all() else int(np.argmin(same))
            yield [c[:n] for c in columns], np.full(n, cap)
            columns = [c[n:] for c in columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        starts = _run_starts(columns, keys)
        over, last = None, int(starts[-1])
        if len(columns[0]) - last >= cap:
            over, held = [c[last] for c in columns[:keys]], None
        else:
            held = [c[last:] for c in columns]
            columns, starts = [c[:last] for c in columns], starts[:-1]
        if len(starts):
            lengths = np.diff(np.append(starts, len(columns[0])))
            yield columns, np.minimum(np.repeat(lengths, lengths), cap)
    if held is not None:
        yield held, np.full(len(held[0]), min(len(held[0]), cap))


def _run_starts(columns: list[np.ndarray], keys: int) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
    for c in columns[:keys]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def repeats(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]]:
    """Over rows sorted by their first `keys` columns, hold one row of a run at a time.

    Yields (columns, rank within the run capped at 1: 0 for its first row, columns of the run's first row).
    """
    first: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        starts = _run_starts(columns, keys)
        head = np.zeros(len(columns[0]), np.int64)
        head[starts] = starts
        head = np.maximum.accumulate(head)
        heads = [c[head] for c in columns]
        later = np.arange(len(head)) != head
        if first is not None and all(c[0] == f for c, f in zip(columns[:keys], first[:keys], strict=True)):
            end = starts[1] if len(starts) > 1 else len(head)
            later[0] = True
            for h, f in zip(heads, first, strict=True):
                h[:end] = f
        first = [h[-1] for h in heads]
        yield columns, later, heads


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files behind tables that are written.

    It does so when the driver collects the plans that made them, which a driver with free memory puts off.
    Some plans are let go by what the first collection cleans up, so there is a second."""
    for pause in (0.3, 0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(pause)


def map_arrow(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """mapInArrow with f(batches, arrow schema); the schema is DDL.

    Where the session leaves Arrow's batches at 10,000 rows, it gets BATCH_ROWS: a batch is
    held several times over in a task, as columns, as texts and as results."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    arrow = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(lambda batches: f(batches, arrow), schema)


def apart(documents: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, text) of every row, and a factor, 1 unless rows share a doc_id and differ in text.

    Such rows become documents of their own, in order of their texts' hashes: their doc_ids are
    multiplied by the factor and numbered within it, which keeps the order of doc_ids."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    mark = F.xxhash64("text")
    several = docs.filter("doc_id is not null").select("doc_id", mark.alias("mark")).groupBy("doc_id").agg(F.min("mark").alias("x"), F.max("mark").alias("y")).filter("x <> y").select("doc_id")
    if several.isEmpty():
        return docs, 1
    kinds = docs.join(several, "doc_id").select("doc_id", mark.alias("mark")).distinct()
    kinds = stage(kinds.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id").orderBy("mark")) - 1), "kinds")
    factor = kinds.agg(F.max("nth")).first()[0] + 1
    rows = docs.withColumn("mark", mark).join(kinds, ["doc_id", "mark"], "left")
    return rows.select((F.col("doc_id") * factor + F.coalesce("nth", F.lit(0))).alias("doc_id"), "text"), factor


def join_hot(rows: DataFrame, few: DataFrame, key: str, apart_by: str, salts: int = 16) -> DataFrame:
    """rows left-joined to few, which has a row for a key at most; rows of one key are dealt over so many tasks, by a column."""
    salted = rows.withColumn("salt_", F.pmod(F.xxhash64(apart_by), F.lit(salts).cast("long")))
    return salted.join(few.withColumn("salt_", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), [key, "salt_"], "left").drop("salt_")
