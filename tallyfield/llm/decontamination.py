"""Benchmark decontamination by the q-gram lemma (Jokinen and Ukkonen 1991; Rasmussen et al. 2006).

Benchmark texts are normalised (lower case, each run of other than letters and digits one
blank) and cut into segments of SEGMENT characters, one begun every STEP, equal ones taken once.  A stretch of a document
within k edits of a segment of m characters shares m + 1 - q * (k + 1) q-grams with it, whose
diagonals lie in a band.  Shared q-grams are counted in overlapping diagonal bands; the
regions of bands that reach the bound are verified by banded alignment, so each hit is exact.
Texts too short for that, under SHORT characters when normalised, are sought as they are,
from word to word.

What is sure to be found: an excerpt of SEGMENT + STEP - 1 = 63 normalised characters holds a
whole segment, wherever it begins, and so has a stretch of so many with two edits at most (5 % of
a segment).  Shorter excerpts of longer texts are found where they hold a segment; texts under a
segment's length are sought whole.  A copy with edits is found if any segment of it has two at most.

Memory follows constants, not the data: the benchmark is indexed in blocks of BLOCK_CHARS,
long texts of either side go in overlapping pieces, and hits are counted HITS at a time,
split by segments and then by place.  With one block, documents pass it in one narrow step.
Further blocks pass one after another, each broadcast for its own pass only; what they find
is written and joined to the documents by their texts' hashes.

Defined cases: null or empty text is clean; null benchmark texts, and those without a letter
or digit, are not sought; equal benchmark texts are all found (ties: items ascending); long
texts are sought whole; an empty benchmark leaves everything clean, and an empty table stays
empty; ids are passed through, null or repeated; extra columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as S

Q = 12
SEGMENT, STEP = 48, 16
EDITS_PERCENT = 5
#: Shorter texts are sought exactly.
SHORT = 24
BAND = 8
#: Characters of the benchmark in one index, of a piece of a benchmark text, and q-gram hits counted at once.
BLOCK_CHARS, PIECE_CHARS, HITS = 1_000_000, 1 << 16, 2_000_000
#: No stretch within the edits allowed, and no band, spans more characters.
_SPAN = 2 * SEGMENT + 2 * BAND
_BITS = np.uint64(42)


@lru_cache(maxsize=1)
def _alnum() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all normalised texts laid end to end, where each starts and the last ends)."""
    texts = [f"{x.lower()} " for x in texts]
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum([0, *map(len, texts)])
    word = _alnum()[codes]
    keep = word.copy()
    keep[1:] |= word[:-1]  # one blank after each word
    at = np.concatenate([[0], np.cumsum(keep)])
    return np.where(word, codes, np.uint32(32))[keep], at[offsets]


def pieces_of(text: str, size: int, overlap: int) -> Iterator[np.ndarray]:
    """The normalised text in pieces of about `size`, each with the last `overlap` characters of the one before."""
    at, tail = 0, np.empty(0, np.uint32)
    while at < len(text):
        cut = len(text)
        if cut - at > size:
            cut = next((k for k in range(at + size, at + size // 2, -1) if text[k].isspace()), at + size)
        codes = np.concatenate([tail, normalised([text[at:cut]])[0]])
        if cut < len(text) and text[cut - 1].isalnum() and text[cut].isalnum():
            codes = codes[:-1]  # no blank within a word
        yield codes
        at, tail = cut, codes[max(0, len(codes) - overlap) :]


def edits_of(m):
    return m * EDITS_PERCENT // 100


class Index:
    """q-grams of the segments of some normalised benchmark texts, and the short texts among them."""

    def __init__(self, items: list[tuple[int, str]]):
        owners: dict[bytes, set[int]] = {}
        short: dict[int, dict[bytes, set[int]]] = {}
        for item, text in items:
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            n = len(codes)
            if n < SHORT:
                if n:
                    short.setdefault(n, {}).setdefault(codes.tobytes(), set()).add(item)
                continue
            m = min(SEGMENT, n)
            for at in {*range(0, n - m + 1, STEP), n - m}:
                owners.setdefault(codes[at : at + m].tobytes(), set()).add(item)
        self.items = [sorted(x) for x in owners.values()]
        self.segments = [np.frombuffer(x, np.uint32) for x in owners]
        self.m = np.array([len(x) for x in self.segments], np.int64)
        self.short = [(n, self._hashed(n, texts), texts) for n, texts in sorted(short.items())]
        grams = [S.window_hashes(x.astype(np.uint64), Q) for x in self.segments]
        h = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        self.hashes, which = np.unique(h, return_inverse=True)
        # entries in order of hash and segment
        key = which.astype(np.int64) * len(self.m) + np.repeat(np.arange(len(grams)), [len(x) for x in grams])
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        self.place = (np.concatenate([np.arange(len(x), dtype=np.int16) for x in grams]) if grams else np.empty(0, np.int16))[order]
        self.known = np.zeros(1 << (64 - int(_BITS)), bool)
        self.known[(self.hashes >> _BITS).astype(np.int64)] = True

    @staticmethod
    def _hashed(n: int, texts: dict[bytes, set[int]]) -> np.ndarray:
        codes = np.concatenate([np.frombuffer(x, np.uint32) for x in texts]).astype(np.uint64)
        return np.unique(S.window_hashes(codes, n)[::n])

    def hits(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place among the codes, number of the hash, text) of the q-grams that the index has."""
        h = S.window_hashes(codes.astype(np.uint64), Q)
        at = np.flatnonzero(self.known[(h >> _BITS).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        same = self.hashes[k] == h[at]
        at, k = at[same], k[same]
        text = np.searchsorted(starts, at, side="right") - 1
        inside = at + Q <= starts[text + 1]
        return at[inside], k[inside], text[inside]

    def candidates(self, at, k, text, low: int, high: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(segment, text, first diagonal of the band) of regions of the segments from low to high that
        reach the bound, some at a time; some come twice."""
        first, last = (np.searchsorted(self.key, k * len(self.m) + x) for x in (low, high))
        n = last - first
        if n.sum() > HITS:
            met = n > 0
            at, k, text = at[met], k[met], text[met]
            if high - low > 1:
                middle = (low + high) // 2
                yield from self.candidates(at, k, text, low, middle)
                yield from self.candidates(at, k, text, middle, high)
                return
            middle = (at[0] + at[-1]) // 2
            if at[-1] - at[0] > 2 * _SPAN:
                for half in (at < middle + _SPAN, at >= middle):
                    yield from self.candidates(at[half], k[half], text[half], low, high)
                return
            n, first = n[met], first[met]
        entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        segment = self.key[entry] % max(1, len(self.m))
        band = (np.repeat(at, n) - self.place[entry]) // BAND
        text = np.repeat(text, n)
        rows = np.stack([np.tile(segment, 2), np.tile(text, 2), np.concatenate([band, band - 1])])
        if not rows.shape[1]:
            return
        rows = rows[:, np.lexsort(rows)]
        new = np.flatnonzero(np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)]))
        counts = np.diff(np.append(new, rows.shape[1]))
        segment, text, band = rows[:, new]
        m = self.m[segment]
        enough = counts >= m + 1 - Q * (edits_of(m) + 1)
        yield segment[enough], text[enough], band[enough] * BAND

    def verified(self, codes, starts, segment, text, diagonal, some: int = 2000) -> np.ndarray:
        """Which candidates hold an alignment within the edits allowed."""
        out = [self._aligned(codes, starts, *(x[k : k + some] for x in (segment, text, diagonal))) for k in range(0, len(segment), some)]
        return np.concatenate(out) if out else np.empty(0, bool)

    def _aligned(self, codes, starts, segment, text, diagonal):
        m = self.m[segment]
        k = edits_of(m)
        most = int(k.max())
        width = 2 * BAND + 2 * most + 1
        wanted = np.zeros((len(segment), int(m.max())), np.uint32)
        for row, s in enumerate(segment):
            wanted[row, : m[row]] = self.segments[s]
        low, high = starts[text][:, None], starts[text + 1][:, None]
        column = np.arange(width)
        place = (diagonal - most)[:, None] + column  # in the text, of row 0
        cost = np.zeros((len(segment), width), np.int32)
        best = np.full(len(segment), 1 << 20)
        for i in range(wanted.shape[1]):
            at = place + i
            there = (at >= low) & (at < high)
            same = there & (codes[np.clip(at, 0, len(codes) - 1)] == wanted[:, i : i + 1])
            step = cost + np.where(same, 0, 1)
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = (np.minimum.accumulate(step - column, axis=1) + column).astype(np.int32)
            ends = m == i + 1
            best[ends] = cost[ends].min(axis=1)
        return best <= k

    def found_in(self, codes: np.ndarray, starts: np.ndarray, cut: bool = False) -> list[set[int]]:
        """The items found in each of some normalised texts laid end to end (cut: the first may begin within a word)."""
        found: list[set[int]] = [set() for _ in starts[1:]]
        if len(self.hashes) and len(codes):
            for segment, text, diagonal in self.candidates(*self.hits(codes, starts), 0, len(self.m)):
                ok = self.verified(codes, starts, segment, text, diagonal)
                for t, s in set(zip(text[ok].tolist(), segment[ok].tolist(), strict=True)):
                    found[t].update(self.items[s])
        for n, hashes, texts in self.short:
            h = S.window_hashes(codes.astype(np.uint64), n)[: max(0, len(codes) - n)]
            begins = np.concatenate([[not cut], codes[:-1] == 32])[: len(h)]
            at = np.flatnonzero(begins & (codes[n : n + len(h)] == 32))
            at = at[np.isin(h[at], hashes)]
            for a, t in zip(at.tolist(), (np.searchsorted(starts, at, side="right") - 1).tolist(), strict=True):
                found[t].update(texts.get(codes[a : a + n].tobytes(), ()))
        return found

    def items_in(self, texts: list[str]) -> list[list[int]]:
        """For each text, the ids of the benchmark texts that it holds a segment of."""
        found: list[set[int]] = [set() for _ in texts]
        k = 0
        while k < len(texts):
            j, size = k + 1, len(texts[k])
            if size > S.CHUNK:
                for nth, codes in enumerate(pieces_of(texts[k], S.CHUNK, _SPAN)):
                    found[k] |= self.found_in(codes, np.array([0, len(codes)]), nth > 0)[0]
            else:
                while j < len(texts) and size + len(texts[j]) < S.CHUNK:
                    size += len(texts[j])
                    j += 1
                for t, items in enumerate(self.found_in(*normalised(texts[k:j]))):
                    found[k + t] |= items
            k = j
        return [sorted(x) for x in found]


def _cut_items(batches, schema):
    for batch in batches:
        rows = [(item, codes.tobytes().decode("utf-32-le", "surrogatepass").strip(" ")) for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True) for codes in pieces_of(text or "", PIECE_CHARS, 2 * SEGMENT)]
        columns = list(zip(*rows, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def blocks(benchmark: DataFrame, size: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of the benchmark, each of texts of `size` characters (and one piece more) at most."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null and text is not null")
    held, chars = [], 0
    for row in S.map_arrow(items, _cut_items, "item_id long, text string").distinct().toLocalIterator():  # one partition at a time
        held.append((row.item_id, row.text))
        chars += len(row.text)
        if chars >= size:
            yield Index(held)
            held, chars = [], 0
    if held:
        yield Index(held)


def _seek(index):
    """Every row, with its items."""

    def run(batches, schema):
        for batch in batches:
            items = index.value.items_in([x or "" for x in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(items, pa.list_(pa.int64()))], schema=schema)

    return run


def _seek_hashed(index):
    """(h1, h2, item) of the texts that hold an item."""

    def run(batches, schema):
        for batch in batches:
            items = index.value.items_in(batch.column("text").to_pylist())
            rows = [(a, b, item) for a, b, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), items, strict=True) for item in some]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def with_items(rows: DataFrame, benchmark: DataFrame, size: int = BLOCK_CHARS) -> DataFrame:
    """Rows (first column any, text) with items, the ids of the benchmark texts found in the text."""
    first, context = rows.columns[0], rows.sparkSession.sparkContext
    some = blocks(benchmark, size)
    one, two = next(some, None), next(some, None)
    if one is None:
        return rows.withColumn("items", F.array().cast("array<bigint>"))
    if two is None:
        kind = rows.schema[0].dataType.simpleString()
        return S.map_arrow(rows, _seek(context.broadcast(one)), f"{first} {kind}, text string, items array<bigint>")
    key = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")}
    texts = rows.filter("text is not null").select(*(c.alias(k) for k, c in key.items()), "text")
    found = None
    for index in chain((one, two), some):
        held = context.broadcast(index)
        more = S.stage(S.map_arrow(texts, _seek_hashed(held), "h1 long, h2 long, item long"), "leaks")
        held.destroy()
        found = more if found is None else found.union(more)
    found = found.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return rows.withColumns(key).join(found, list(key), "left").select(first, "text", F.coalesce("items", F.array().cast("array<bigint>")).alias("items"))


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, items for every row."""
    found = with_items(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark)
    return found.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items")


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark text, with all their columns."""
    names = [f"c{k}" for k in range(len(documents.columns))]
    text = names[documents.columns.index("text")]
    rows = documents.toDF(*names).select(F.struct(*names).alias("row"), F.col(text).cast("string").alias("text"))
    return with_items(rows, benchmark).filter(F.size("items") == 0).select("row.*").toDF(*documents.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
