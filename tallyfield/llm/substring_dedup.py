"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the corpus itself, indexed in blocks: each shuffle partition is one block
of the phrase index and holds, for every phrase of ``window`` words hashed to it, the
phrase's first place.  Every phrase of every document is sought in the block that would hold
it, so each document is factored against every indexed block.

1. Seeds.  Of every window's seeds (``seed_words`` consecutive words) the one with the
   least hash stands for the window.  Equal windows have equal seeds, so a window can
   only recur if its seed does.  This leaves about 1/6 of the positions to shuffle.
2. Phrases.  Only windows with a recurring seed are hashed as a whole (96 bits) and
   sought in the index, which answers with an earlier place of the same phrase.
3. Parsing.  Phrases that continue each other in one source are one match.  The parse goes
   from left to right: a factor is the match that reaches farthest, and words without a match
   are literals.  At a factor's end, the matches that cross it are checked, and the one that
   reaches farthest gives the next factor, so a repeat that the parse would cut is found.
   Every match has ``window`` words at least, and the factors are the duplicate spans.

What recurs within some megabytes of texts that a task holds is settled there: of a seed or
phrase that many of them share, one row only is sought in the index, the first, and the
others take its place as their source.  So a passage that a third of the corpus shares sends
one row for each of these portions of texts to its block, not one for each document.  Rows
of a phrase are streamed in sorted order, one row held at a time.

Defined cases: null or empty text has no words and loses none; a null doc_id has no
place in the order, so such a row loses nothing and removes nothing; rows that repeat
a doc_id with equal text share one place, so neither is earlier than the other; rows that
share a doc_id and differ in text are documents of their own, in order of their texts'
hashes; of equal phrases the first start wins (ties); long texts are hashed in pieces and
parsed whole; extra columns are ignored, whatever their names; an empty table gives an
empty table.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as S

WINDOW = 20
SEED_WORDS = 8


_PLACE = np.uint64((1 << 22) - 1)


def _seeds(words: np.ndarray, starts: np.ndarray, window: int, seed_words: int):
    """Of texts laid end to end: (hash, text, ordinal in its text) of each chosen seed, and for
    each window its first word, text, place in its text, and its seed's index among the chosen."""
    hashes = S.window_hashes(words, seed_words)
    # the place in the low bits: the least value is then the first least hash
    low = (hashes & ~_PLACE) | (np.arange(len(hashes), dtype=np.uint64) & _PLACE)
    width, have = window - seed_words + 1, 1
    while have < width and len(low):
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    first, text, place = S.whole_windows(starts, window)
    at = first + (((low[first] & _PLACE).astype(np.int64) - first) & int(_PLACE))
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    seed_text = text[new]
    before = np.searchsorted(seed_text, seed_text)
    return (hashes[at[new]], seed_text, np.arange(len(before)) - before), (first, text, place, np.cumsum(new) - 1)


def _alike(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings a text's equal hashes together, and where in it each group begins."""
    order = np.argsort(h, kind="stable")  # texts stay in order among equal hashes
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])
    return order, new


def _emit_seeds(window, seed_words):
    """(h, doc, ordinal of the first of a text's equal seeds): of the seeds that texts at hand share one is
    sought and known to recur; the others, known too, have keys of their own.  Known ones have ordinals below zero."""

    def run(batches, schema):
        def pieces():
            for batch in batches:
                rows = [x for x in zip(batch.column(0).to_pylist(), S.texts_of(batch), strict=True) if None not in x]
                for ids, words, starts in S.hashed_texts([x[0] for x in rows], [x[1] for x in rows]):
                    (h, text, ordinal), _ = _seeds(words, starts, window, seed_words)
                    order, new = _alike(h, text)
                    once = order[new]  # by hash, then text
                    h, ordinal, doc = h[once], ordinal[once].astype(np.int32), np.asarray(ids, np.int64)[text[once]]
                    again = np.zeros(len(h), bool)
                    again[1:] = h[1:] == h[:-1]
                    other = np.zeros(len(h), bool)  # than the document before it
                    other[1:] = doc[1:] != doc[:-1]
                    again &= other
                    sure = again.copy()
                    sure[:-1] |= again[1:]
                    key = np.where(again, S.mix(h + doc.astype(np.uint64)), h)
                    yield S.signed(key), doc, np.where(sure, -1 - ordinal, ordinal)

        yield from S.batches_of(schema, pieces())

    return run


def _recurring(batches, schema):
    """(doc_id, ordinal) of rows whose hash has another row."""
    found = S.run_lengths(batches, 1, 2)
    yield from S.batches_of(schema, ((doc[k], np.maximum(ordinal, -1 - ordinal)[k]) for (_, doc, ordinal), n in found for k in [(n > 1) | (ordinal < 0)]))


def _emit_phrases(window, seed_words):
    """(h, second hash and n, doc, place and source place, src): n = 0 for a phrase that no text at hand has earlier,
    to be sought in the index; n > 0 for n windows on end that the document src, at hand too, has from the source place on."""

    def run(batches, schema):
        def pieces():
            for batch in batches:
                rows = zip(batch.column("doc_id").to_pylist(), batch.column("ordinals").to_pylist(), S.texts_of(batch), strict=True)
                rows = [x for x in rows if x[0] is not None and x[2]]
                for known, words, starts in S.hashed_texts([x[:2] for x in rows], [x[2] for x in rows]):
                    (chosen, seed_text, _), (first, text, place, seed) = _seeds(words, starts, window, seed_words)
                    base = np.searchsorted(seed_text, np.arange(len(known)))
                    recurs = np.zeros(len(chosen), bool)
                    recurs[np.concatenate([b + np.asarray(x[1] or [], np.int64) for b, x in zip(base, known, strict=True)])] = True
                    order, new = _alike(chosen, seed_text)
                    group = np.cumsum(new) - 1
                    some = (np.bincount(group, recurs[order]) > 0) | (np.bincount(group) > 1)
                    recurs[order] = some[group]
                    ok = recurs[seed]
                    first, text, at = first[ok], text[ok], place[ok].astype(np.int64)
                    one, two = (S.window_hashes(words, window, salt)[first] for salt in (0, 1))
                    doc = np.array([x[0] for x in known], np.int64)[text]
                    # of each phrase's places, in order of document and place, the one before
                    order = np.lexsort((at, doc, two, one))
                    new = np.ones(len(order), bool)
                    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
                    before = order[np.arange(len(order)) - ~new]
                    src, src_at = np.empty_like(doc), np.empty_like(at)
                    src[order], src_at[order] = doc[before], at[before]
                    free = np.flatnonzero((src == doc) & (src_at == at))
                    zero = np.zeros(len(free), np.int64)
                    yield S.signed(one[free]), _packed(two[free] & np.uint64(0x7FFFFFFF), zero), doc[free], _packed(at[free], zero), zero
                    again = np.flatnonzero((src != doc) | (src_at != at))
                    t, d, a, b, c = text[again], doc[again], at[again], src_at[again], src[again]
                    new = np.ones(len(again), bool)
                    new[1:] = (t[1:] != t[:-1]) | (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1) | (c[1:] != c[:-1])
                    runs = np.flatnonzero(new)
                    n = np.diff(np.append(runs, len(new)))
                    d, a, b, c = d[runs], a[runs], b[runs], c[runs]
                    yield S.signed(S.mix(d.astype(np.uint64) + a.astype(np.uint64))), n.astype(np.int64), d, _packed(a, b), c

        yield from S.batches_of(schema, pieces())

    return run


def _packed(at: np.ndarray, src_at: np.ndarray) -> np.ndarray:
    return (at.astype(np.int64) << 32) | src_at.astype(np.int64)


def _earlier_places(batches, schema):
    """(doc, place and source place, source, n windows) of the windows that have come before."""

    def sought():
        for batch in batches:
            n = batch.column("h2n").to_numpy() & 0xFFFFFFFF
            known = n > 0
            done.append((*(batch.column(k).to_numpy()[known] for k in ("doc_id", "place", "src")), n[known].astype(np.int32)))
            yield batch.select(["h", "h2n", "doc_id", "place"]).filter(pa.array(~known))

    done: list[tuple] = []

    def pieces():
        for (_, _, doc, at), later, (_, _, src, src_at) in S.repeats(sought(), 2):
            later &= (doc != src) | (at != src_at)  # a row that repeats a doc_id
            yield doc[later], (at | src_at >> 32)[later], src[later], np.ones(int(later.sum()), np.int32)
            yield from done
            done.clear()
        yield from done

    yield from S.batches_of(schema, pieces())


def matches(at: np.ndarray, src: np.ndarray, src_at: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(start, end, source, source start), in words, of the windows that continue each other in one source; by start."""
    order = np.argsort(at, kind="stable")
    at, src, src_at, n = at[order], src[order], src_at[order], n[order]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + n[:-1]) | (src[1:] != src[:-1]) | (src_at[1:] != src_at[:-1] + n[:-1])
    starts = np.flatnonzero(new)
    last = np.append(starts[1:], len(at)) - 1
    return at[starts], at[last] + n[last] - 1 + window, src[starts], src_at[starts]


def factors(at: np.ndarray, src: np.ndarray, src_at: np.ndarray, n: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """The greedy parse of a document: (start, end, source doc, source start) of its factors, in words.

    A factor may begin before the one before it ends, by less than a window: there its match
    crossed the boundary."""
    out, done = [], 0
    found = list(zip(*(x.tolist() for x in matches(at, src, src_at, n, window)), strict=True))
    k = 0
    while k < len(found):
        best, k = found[k], k + 1
        if best[1] <= done:
            continue
        # from the boundary, or after literals from the next match on
        boundary = max(done, best[0])
        while k < len(found) and found[k][0] <= boundary:
            best, k = max(best, found[k], key=lambda x: x[1]), k + 1
        out.append(best)
        done = best[1]
    return out


def _cut(window):
    def run(batches, schema):
        for batch in batches:
            out = []
            columns = (batch.column(k).to_pylist() for k in ("doc_id", "places", "src", "n"))
            for doc, places, src, n, text in zip(*columns, S.texts_of(batch), strict=True):
                words = (text or b"").split()
                edges, spans = np.zeros(len(words) + 1, np.int64), []
                if places:
                    both = np.asarray(places, np.int64)
                    found = factors(both >> 32, np.asarray(src, np.int64), both & 0xFFFFFFFF, np.asarray(n, np.int64), window)
                    np.add.at(edges, [x[0] for x in found], 1)
                    np.add.at(edges, [x[1] for x in found], -1)
                    spans = [dict(zip(("start", "end", "src_doc", "src_start"), x, strict=True)) for x in found]
                kept = list(compress(words, (np.cumsum(edges)[:-1] == 0).tolist())) if places else words
                out.append((doc, len(words), len(words) - len(kept), b" ".join(kept), spans))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()).cast(pa.string()) if pa.types.is_string(t) else pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def substring_dedup(documents: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text), spans (array of start, end, src_doc, src_start)."""
    if not 1 <= seed_words <= window:
        raise ValueError("seed_words lies between 1 and window")
    docs, factor = S.apart(documents)
    seeds = S.map_arrow(docs, _emit_seeds(window, seed_words), "h long, doc_id long, ordinal int")
    again = S.map_arrow(seeds.repartition("h").sortWithinPartitions("h"), _recurring, "doc_id long, ordinal int")
    again = again.groupBy("doc_id").agg(F.collect_set("ordinal").alias("ordinals"))
    sought = docs.join(again.hint("shuffle_hash"), "doc_id", "left")
    phrases = S.map_arrow(sought, _emit_phrases(window, seed_words), "h long, h2n long, doc_id long, place long, src long")
    in_order = phrases.repartition("h").sortWithinPartitions("h", "h2n", "doc_id", "place")
    known = S.map_arrow(in_order, _earlier_places, "doc_id long, place long, src long, n int")
    # lists of one aggregation have one order
    known = known.groupBy("doc_id").agg(F.collect_list("place").alias("places"), F.collect_list("src").alias("src"), F.collect_list("n").alias("n"))
    spans = "array<struct<start:long,end:long,src_doc:long,src_start:long>>"
    out = S.map_arrow(docs.join(known.hint("shuffle_hash"), "doc_id", "left"), _cut(window), f"doc_id long, n_words long, n_removed long, kept string, spans {spans}")
    if factor == 1:
        return out
    whole = lambda c: F.floor(c / factor)
    back = F.transform("spans", lambda x: x.withField("src_doc", whole(x["src_doc"])))
    return out.withColumns({"doc_id": whole(F.col("doc_id")), "spans": back})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM d),
s AS (SELECT doc_id, word, i, n, CASE WHEN i + 20 <= n THEN array_to_string(
        list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), ' ') END AS phrase FROM w),
f AS (SELECT doc_id, word, i, phrase IS NOT NULL AND row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) > 1 AS later FROM s),
c AS (SELECT doc_id, word, i, bool_or(later) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM f),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
