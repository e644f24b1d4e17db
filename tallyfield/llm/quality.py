"""Quality rules: base counts of words, and compression bands.

A text is compressed with zstandard as a whole and in fixed chunks; each ratio
(compressed over plain bytes) must lie within a band: for the whole text one that depends on
its length, because short texts compress less.  Below the band text repeats itself, above it
is noise.  Chunks are all of CHUNK_BYTES, the last one ends with the text (and overlaps the
one before), so every byte of a text that long is in a chunk; a shorter text is judged as a
whole only.  The whole text's band meets what is alike throughout, the chunks' band what is
bad in places and passes on the average.

Defined cases: null or empty text has no words, fails the base and isn't kept; ratios that
lie on a limit are within it (ties); long texts are read whole, hashed in pieces and
compressed as one; ids are passed through, null or repeated; extra columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as S

LEVEL = 3
CHUNK_BYTES = 1024
#: log2 of the bytes, lowest and highest ratio there; between two rows the limits are interpolated.
#: From 2^8 to 2^16 bytes they are the closest lines under and over the good documents with even
#: doc_id of check_s/labels (8,493 that pass the base), two an octave, limits never rising with
#: the length (at 2^8, with 68 documents, the line through the next two), moved outwards by 1 %;
#: shorter and longer texts had no labels and have wider bands.
BANDS = (
    (0, 0.4, 3), (7.5, 0.48, 0.95), (8, 0.553, 0.756), (8.5, 0.528, 0.754), (9, 0.503, 0.729),
    (9.5, 0.503, 0.663), (10, 0.489, 0.623), (10.5, 0.472, 0.583), (11, 0.451, 0.557), (11.5, 0.451, 0.542),
    (12, 0.439, 0.518), (12.5, 0.427, 0.484), (13, 0.418, 0.477), (13.5, 0.41, 0.461), (14, 0.409, 0.452),
    (14.5, 0.402, 0.445), (15, 0.395, 0.437), (15.5, 0.387, 0.427), (16, 0.387, 0.427), (20, 0.33, 0.427),
)
#: Lowest and highest ratio of a chunk, and the share of chunks that may lie outside: the share is
#: given, the limits are the closest that keep the same good documents, moved outwards by 1 %.
CHUNK_BAND = (0.495, 0.641)
CHUNKS_OUTSIDE = 0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_AT, _LOW, _HIGH = np.array(BANDS).T
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, chunks_outside double, kept boolean"
)


def repeated_words(words: np.ndarray, starts: np.ndarray, k: int = 3) -> np.ndarray:
    """For texts laid end to end: how many words of each lie in k-word windows that it has twice or more."""
    first, text, _ = S.whole_windows(starts, k)
    h = S.window_hashes(words, k)[first] if len(first) else np.empty(0, np.uint64)
    order = np.argsort(h, kind="stable")
    same = (h[order][1:] == h[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(h) + 1, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    at = first[twice[:-1]]
    np.add.at(edges, at, 1)
    np.add.at(edges, at + k, -1)
    sums = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    return sums[starts[1:]] - sums[starts[:-1]]


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(_SPACES)]
    return len(lines) - len(set(lines))


def compression(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float, float]:
    """(ratio of the whole, share of chunks outside CHUNK_BAND)."""
    if not text:
        return 1.0, 0.0
    at = list(range(0, len(text) - CHUNK_BYTES + 1, CHUNK_BYTES))
    if len(text) > CHUNK_BYTES and len(text) % CHUNK_BYTES:
        at.append(len(text) - CHUNK_BYTES)
    ratios = [len(packer.compress(text[k : k + CHUNK_BYTES])) / CHUNK_BYTES for k in at]
    outside = sum(not CHUNK_BAND[0] <= x <= CHUNK_BAND[1] for x in ratios)
    return len(packer.compress(text)) / len(text), outside / max(1, len(at))


def in_band(n_bytes: int, ratio: float) -> bool:
    x = np.log2(max(1, n_bytes))
    low, high = (np.interp(x, _AT, limits) for limits in (_LOW, _HIGH))
    return bool(low <= ratio <= high)


def _judge(batches, schema):
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        rows = []
        texts = [x or b"" for x in S.texts_of(batch)]
        for some, words, starts in S.hashed_texts(texts, texts):
            n_repeat = repeated_words(words, starts)
            for text, n, again in zip(some, np.diff(starts).tolist(), n_repeat.tolist(), strict=True):
                b = np.frombuffer(text, np.uint8)
                points = int(np.count_nonzero((b & 0xC0) != 0x80))
                spaces = int(np.count_nonzero((b == 32) | (b - np.uint8(9) < 5)))
                failed = n < MIN_WORDS or 100 * again > MAX_REPEAT_PERCENT * n
                ratio, outside = compression(text, packer)
                kept = not failed and in_band(len(text), ratio) and outside <= CHUNKS_OUTSIDE
                symbols = sum(text.count(_SYMBOLS[k : k + 1]) for k in range(len(_SYMBOLS)))
                rows.append((n, points - spaces, symbols, dup_lines(text), again, failed, ratio, outside, kept))
        found = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types[len(batch.columns) :], strict=True)] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], schema=schema)


def judge(documents: DataFrame) -> DataFrame:
    """doc_id, text and the columns of COLUMNS, for every row."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return S.map_arrow(docs, _judge, f"doc_id long, text string, {COLUMNS}")


def passing(documents: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    names = [f"c{k}" for k in range(len(documents.columns))]
    plain = documents.toDF(*names)
    text = names[documents.columns.index("text")]
    rows = plain.select(F.struct(*names).alias("row"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    judged = S.map_arrow(rows, _judge, f"row {kind}, text string, {COLUMNS}")
    return judged.filter("kept").select("row.*").toDF(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text")
