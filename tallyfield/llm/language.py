"""Language ID by rank-order profiles (Cavnar and Trenkle 1994).

A profile is the list of the most frequent letter n-grams (n 1 to 3, with word ends),
most frequent first.  A document goes to the language whose profile its own is least out
of place with.  Profiles are counted over all labelled training documents: each task adds
up its own counts before the shuffle, and only the top of each language's list, PROFILE
rows, reaches the driver.

Defined cases: null text, or text without a letter, is ``und`` with score 0, and so is
everything if nothing could be learnt; rows with null lang aren't learnt from; a null
doc_id counts as the empty string in the hold-out rule; ids are passed through, null or
repeated; ties between languages go to the first by code point, between n-grams to the lower
code; long texts are counted whole, in pieces; extra columns are ignored, whatever their
names; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared as S

PROFILE = 400
MAX_LANGUAGES = 10_000
HELD = 1 << 20  # n-grams that a task holds before it hands on its counts
CHUNK_CHARS = 1 << 19
_END = 1  # stands for a word's end; no letter
_BITS = np.uint64(21)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> np.ndarray:
    """Codes of the n-grams of one text, unsorted."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    c = np.where(letter, c, np.uint32(_END))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one end after each word
    c = np.concatenate([[_END], c[keep], [_END]]).astype(np.uint64)
    end = c == _END
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate([c[~end], two[~(end[1:] & end[:-1])], three[~end[1:-1]]])


def counted(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order, and the sum of their counts (1 each)."""
    if counts is None:
        codes = np.sort(codes)
        starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
        return codes[starts], np.diff(np.append(starts, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.empty(0, np.int64)
    return codes[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    if len(codes) > size:
        least = np.partition(counts, -size)[-size]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:size]


def _pieces(text: str):
    """A long text in pieces cut at spaces, so memory follows CHUNK_CHARS."""
    at = 0
    while len(text) - at > CHUNK_CHARS:
        cut = text.rfind(" ", at + 1, at + CHUNK_CHARS)
        cut = at + CHUNK_CHARS if cut < 0 else cut
        yield text[at:cut]
        at = cut
    yield text[at:]


def profile_of(text: str, size: int) -> np.ndarray:
    parts = [counted(ngrams(x)) for x in _pieces(text)]
    codes, counts = parts[0] if len(parts) == 1 else counted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    return ranked(codes, counts, size)


def _count(batches, schema):
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[str]] = {}
    chars = 0

    def add():
        for lang, texts in waiting.items():
            for piece in _pieces("\n".join(texts)):
                more = counted(ngrams(piece))
                old = held.get(lang)
                held[lang] = more if old is None else counted(np.concatenate([old[0], more[0]]), np.concatenate([old[1], more[1]]))
        waiting.clear()

    def flush():
        for lang, (codes, counts) in held.items():
            if len(codes):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(S.signed(codes)), pa.array(counts)], schema=schema)
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            waiting.setdefault(lang, []).append(text)
            chars += len(text)
            if chars > 8 * CHUNK_CHARS:
                add()
                chars = 0
        if sum(len(x[0]) for x in held.values()) > HELD:
            yield from flush()
    add()
    yield from flush()


def learn(labelled: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, code, rank) of the profiles, learnt from rows (text, lang) without nulls."""
    rows = labelled.filter("text is not null and lang is not null").select("lang", "text")
    counts = S.map_arrow(rows, _count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return counts.withColumn("rank", place - 1).filter(F.col("rank") < size).select("lang", "code", "rank")


def _predict(langs: list[str], codes: np.ndarray, ranks: np.ndarray, size: int):
    def run(batches, schema):
        for batch in batches:
            named, scores = [], []
            for text in batch.column("text").to_pylist():
                own = profile_of(text, size) if text and langs else codes[:0]
                if not len(own):
                    named.append("und")
                    scores.append(0.0)
                    continue
                at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
                found = codes[at] == own
                apart = np.where(found, np.abs(ranks[:, at] - np.arange(len(own))), size).sum(axis=1)
                best = int(np.argmin(apart))
                named.append(langs[best])
                scores.append(1.0 - float(apart[best]) / (size * len(own)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(named, pa.string()), pa.array(scores, pa.float64())], schema=schema)

    return run


def predict(documents: DataFrame, profiles: DataFrame, size: int = PROFILE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of (doc_id, held_out, text)."""
    rows = profiles.limit(MAX_LANGUAGES * size + 1).collect()  # bounded by the number of languages
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted({r.lang for r in rows})
    codes = np.unique(np.array([r.code for r in rows], np.int64).view(np.uint64))
    ranks = np.full((len(langs), len(codes)), size, np.int64)
    place = {x: k for k, x in enumerate(langs)}
    for r in rows:
        ranks[place[r.lang], np.searchsorted(codes, np.int64(r.code).view(np.uint64))] = r.rank
    return S.map_arrow(documents.select("doc_id", "held_out", "text"), _predict(langs, codes, ranks, size), "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    return predict(docs, learn(docs.filter(~F.col("held_out"))))
