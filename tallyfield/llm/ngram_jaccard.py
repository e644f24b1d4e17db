"""N-gram Jaccard join: documents whose sets of word n-grams are alike, and their groups.

Prefix filtering (Chaudhuri 2006; PPJoin+, Xiao 2008): with the n-grams of each set in
one global order, rarest first, two sets that reach the threshold share an n-gram of
both prefixes.

1. Play.  N-grams that occur in one set only come first in that order.  A document
   with more of them than its prefix holds meets nobody, so it leaves the play; to
   see that, a third of the n-grams (by hash) is counted.  Most documents end here.
2. Classes.  Equal sets are one class, represented by its smallest doc_id.
3. Prefixes.  Among representatives left in play, document frequencies are counted
   exactly (up to FREQUENCY_CAP, where ties go by hash) and prefixes taken.
4. Candidates.  Prefix rows meet on their n-gram; length and positional filters apply.
   N-grams in more than SMALL_GROUP sets pair each set with one pivot of the group only:
   sets that link to it are in one component and need no pairs among them.  Pairs across
   components are then sought with new pivots, and after PIVOT_ROUNDS by a join of those
   that are left on n-gram and size class, so no link between components is lost.
5. Verification.  Each distinct pair once: suffix filter, then the exact overlap.
6. Components of the verified links.

Of a frequent n-gram, what texts at hand share in step 1 is settled there, and very large
groups of step 4 are dealt in blocks, other ones in each round, each with a pivot of its own.
In step 3 the rows of one n-gram (16 bytes a class) are counted by one task.

Defined cases: without words (or text) a set is empty and links with nothing; with fewer
than n words the whole sequence is the one n-gram; a null doc_id links with nothing and
has a null component; rows that share a doc_id are one node if their texts are equal and
otherwise documents of their own; equal frequencies (ties) go by hash; long texts are taken
whole, hashed in pieces; extra columns are ignored, whatever their names; an empty table
gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as S
from .components import components

WORDS = 5
THRESHOLD = 75  # per cent
SAMPLED = 3  # one of so many n-grams is counted to see who is in play
SMALL_GROUP = 32
FREQUENCY_CAP = 100_000
PIVOT_ROUNDS = 3
#: Groups of more sets are dealt in so many blocks.
LARGE_GROUP, BLOCKS = 1 << 16, 64


def shingles(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts laid end to end: hash and text of each n-gram (a shorter text is one n-gram), repeats included."""
    first, text, _ = S.whole_windows(starts, n)
    h = S.window_hashes(words, n)[first] if len(first) else np.empty(0, np.uint64)
    short = np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < n))
    if len(short):
        whole = [S.window_hashes(words[starts[k] : starts[k + 1]], int(starts[k + 1] - starts[k])) for k in short]
        h, text = np.concatenate([h, *whole]), np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        h, text = h[order], text[order]
    return h, text


def spare(n, t: int):
    """How many n-grams of a set of n may be missing from a partner: its prefix is one longer."""
    return n - (t * n + 99) // 100


def needed(a, b, t: int):
    """Least overlap of sets of sizes a and b at the threshold."""
    return (t * (a + b) + 99 + t) // (100 + t)


def _emit_sampled(n):
    """(h, 2 * doc + known): n-grams to be counted; of those that texts at hand share one is counted, known
    to recur, and the others, known too, have keys of their own."""

    def run(batches, schema):
        def pieces():
            for batch in batches:
                rows = [x for x in zip(batch.column(0).to_pylist(), S.texts_of(batch), strict=True) if None not in x]
                for ids, words, starts in S.hashed_texts([x[0] for x in rows], [x[1].lower() for x in rows]):
                    h, text = shingles(words, starts, n)
                    some = h % np.uint64(SAMPLED) == 0
                    h, text = h[some], text[some]
                    order = np.argsort(h, kind="stable")  # texts stay in order among equal hashes
                    h, text = h[order], text[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                    h, doc = h[new], np.asarray(ids, np.int64)[text[new]]
                    again = np.zeros(len(h), bool)
                    again[1:] = (h[1:] == h[:-1]) & (doc[1:] != doc[:-1])
                    known = again.copy()
                    known[:-1] |= again[1:]
                    yield S.signed(np.where(again, S.mix(h + doc.astype(np.uint64)), h)), 2 * doc + known

        yield from S.batches_of(schema, pieces())

    return run


def _count_recurring(batches, schema):
    def pieces():
        for (_, doc), n in S.run_lengths(batches, 1, 2):
            yield np.unique((doc >> 1)[(n > 1) | (doc & 1 > 0)], return_counts=True)

    yield from S.batches_of(schema, pieces())


def _emit_sets(n, t):
    """Every document's set size and signature; the set itself only if it is in play."""

    def run(batches, schema):
        for batch in batches:
            out = []
            rows = list(zip(*(batch.column(k).to_pylist() for k in ("doc_id", "again", "print")), strict=True))
            for known, words, starts in S.hashed_texts(rows, [(x or b"").lower() for x in S.texts_of(batch)]):
                all_h, text = shingles(words, starts, n)
                edges = np.searchsorted(text, np.arange(len(known) + 1))
                for (doc, again, mark), low, high in zip(known, edges, edges[1:], strict=False):
                    h = np.unique(all_h[low:high])
                    one, two = (int(S.mix(h ^ np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) if len(h) else 0 for k in (1, 2))
                    alone = int(np.count_nonzero(h % np.uint64(SAMPLED) == 0)) - (again or 0)
                    play = doc is not None and len(h) > 0 and alone <= spare(len(h), t)
                    out.append((doc, mark, len(h), one, two, h.tobytes() if play else None))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def _emit_grams(batches, schema):
    def pieces():
        for batch in batches:
            for doc, grams in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h = np.frombuffer(grams, np.int64)
                yield h, np.full(len(h), doc, np.int64), np.arange(len(h), dtype=np.int32)

    yield from S.batches_of(schema, pieces())


def _frequencies(batches, schema):
    def pieces():
        for (_, doc, ordinal), n in S.run_lengths(batches, 1, FREQUENCY_CAP):
            keep = n > 1
            yield doc[keep], ordinal[keep], n[keep].astype(np.int32)

    yield from S.batches_of(schema, pieces())


def _emit_prefixes(t):
    """(n-gram, doc, size, place in the order, frequency) of prefix n-grams that others have too."""

    def run(batches, schema):
        def pieces():
            for batch in batches:
                known = (batch.column(k).to_pylist() for k in ("doc_id", "grams", "ordinals", "df"))
                for doc, grams, ordinals, df in zip(*known, strict=True):
                    h = np.frombuffer(grams, np.int64)
                    often = np.ones(len(h), np.int64)
                    often[np.asarray(ordinals)] = df
                    order = np.lexsort((h, often))[: spare(len(h), t) + 1]
                    at = np.flatnonzero(often[order] > 1)
                    order = order[at]
                    yield h[order], np.full(len(at), len(h), np.int32), np.full(len(at), doc, np.int64), at.astype(np.int32), often[order].astype(np.int32)

        yield from S.batches_of(schema, pieces())

    return run


def _may_link(n1, at1, n2, at2, t):
    """Length and positional filters, for the first n-gram that two sets share."""
    need = needed(n1, n2, t)
    return (np.minimum(n1, n2) * 100 >= t * np.maximum(n1, n2)) & (1 + np.minimum(n1 - at1, n2 - at2) - 1 >= need)


def _pairs_of_small(t):
    """All pairs within each group of SMALL_GROUP sets at most."""

    def run(batches, schema):
        def pieces():
            held = None
            for batch in batches:
                columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
                if held is not None:
                    columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
                yield from pairs(columns)
                start = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0
                held = [c[start:] for c in columns]  # the open group; its pairs among these rows come twice at most

        def pairs(columns):
            h, n, doc, at = columns[:4]
            for step in range(1, min(2 * SMALL_GROUP, len(h))):
                same = np.flatnonzero(h[step:] == h[:-step])
                if not len(same):
                    break
                i, j = same, same + step
                ok = (doc[i] != doc[j]) & _may_link(n[i], at[i], n[j], at[j], t)
                i, j = i[ok], j[ok]
                yield np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])

        yield from S.batches_of(schema, pieces())

    return run


def _pairs_with_pivot(t):
    """Each row of a group with the group's first row."""

    def run(batches, schema):
        def pieces():
            for (_, _, label, n, doc, at), later, (_, _, plabel, pn, pdoc, pat) in S.repeats(batches, 2):
                ok = later & (doc != pdoc) & (label != plabel) & _may_link(n, at, pn, pat, t)
                yield np.minimum(doc, pdoc)[ok], np.maximum(doc, pdoc)[ok]

        yield from S.batches_of(schema, pieces())

    return run


def _suffixes_differ(a: np.ndarray, b: np.ndarray, allowed: int, depth: int = 3) -> int:
    """Lower bound of the size of the symmetric difference of two sorted sets, by splitting both."""
    if depth == 0 or not len(a) or not len(b) or abs(len(a) - len(b)) > allowed:
        return abs(len(a) - len(b))
    split = a[len(a) // 2]
    i, j = len(a) // 2, int(np.searchsorted(b, split))
    rest = abs((len(a) - i) - (len(b) - j))
    left = _suffixes_differ(a[:i], b[:j], allowed - rest, depth - 1)
    return left + _suffixes_differ(a[i:], b[j:], allowed - left, depth - 1)


def _verify(t):
    def run(batches, schema):
        for batch in batches:
            out = []
            for a, b, ga, gb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = np.frombuffer(ga, np.uint64), np.frombuffer(gb, np.uint64)
                need = needed(len(x), len(y), t)
                allowed = len(x) + len(y) - 2 * need
                if _suffixes_differ(x, y, allowed) <= allowed and len(np.intersect1d(x, y, assume_unique=True)) >= need:
                    out.append((a, b))
            columns = list(zip(*out, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, schema.types, strict=True)], schema=schema)

    return run


def _links(pairs: DataFrame, sets: DataFrame, t: int, name: str) -> DataFrame:
    """The pairs (a, b) that reach the threshold, as a written table."""
    of = {k: sets.select(F.col("doc_id").alias(k), F.col("grams").alias(f"grams_{k}")) for k in "ab"}
    both = pairs.distinct().join(of["a"], "a").join(of["b"], "b").select("a", "b", "grams_a", "grams_b")
    return S.stage(S.map_arrow(both, _verify(t), "a long, b long"), name)


def _labelled(hot: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the groups that still hold several components, with their component."""
    rows = hot.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("component", "doc_id")).drop("component")
    mixed = rows.groupBy("h").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x != y").select("h")
    mixed = S.stage(mixed, "mixed")  # of known size: rows aren't dealt by n-gram to meet it, if it is small
    out = S.stage(rows.join(mixed, "h"), "groups")
    S.unstage(mixed)
    return out


def similar_components(sets: DataFrame, t: int) -> DataFrame:
    """(node, component) of the sets (doc_id, grams) that have a link."""
    pair = "a long, b long"
    grams = S.map_arrow(sets.select("doc_id", "grams"), _emit_grams, "h long, doc_id long, ordinal int")
    often = S.map_arrow(grams.repartition("h").sortWithinPartitions("h"), _frequencies, "doc_id long, ordinal int, df int")
    often = often.groupBy("doc_id").agg(F.collect_list(F.struct("ordinal", "df")).alias("p"))
    often = often.select("doc_id", F.col("p.ordinal").alias("ordinals"), F.col("p.df").alias("df"))
    prefixes = S.map_arrow(sets.select("doc_id", "grams").join(often, "doc_id"), _emit_prefixes(t), "h long, n int, doc_id long, at int, df int")
    prefixes = S.stage(prefixes, "prefixes")
    S.release(prefixes.sparkSession)
    small = prefixes.filter(F.col("df") <= SMALL_GROUP).repartition("h").sortWithinPartitions("h", "n", "doc_id")
    pairs = S.map_arrow(small, _pairs_of_small(t), pair)
    hot = prefixes.filter(F.col("df") > SMALL_GROUP).select("h", "n", "doc_id", "at", "df").distinct()

    def with_pivot(rows: DataFrame, k: int, *order) -> DataFrame:
        block = F.when(F.col("df") > LARGE_GROUP, F.pmod(F.xxhash64("doc_id", F.lit(k)), F.lit(BLOCKS))).otherwise(0).cast("int")
        dealt = rows.select("h", block.alias("block"), "label", "n", "doc_id", "at").repartition("h", "block").sortWithinPartitions("h", "block", *order)
        return S.map_arrow(dealt, _pairs_with_pivot(t), pair)

    links = _links(pairs.union(with_pivot(hot.withColumn("label", F.col("doc_id")), -1, "doc_id")), sets, t, "links")
    found = S.stage(components(links, "a", "b"), "components")
    S.release(found.sparkSession)
    done = [prefixes, links]  # written tables that nothing reads again after this
    for k in range(0 if hot.isEmpty() else PIVOT_ROUNDS + 1):
        hot = _labelled(hot.drop("label"), found)
        done.append(hot)
        if hot.isEmpty():
            break
        if k < PIVOT_ROUNDS:  # another component of each group gives the pivot in each round
            pairs = with_pivot(hot, k, F.xxhash64("label", F.lit(k)), "doc_id")
        else:
            # sets that link are of one size class or of two that adjoin
            classed = hot.withColumn("class", F.floor(F.log("n") / -math.log(t / 100)))
            x, y = classed.alias("x"), classed.withColumn("near", F.explode(F.array(*(F.col("class") + d for d in (-1, 0, 1))))).alias("y")
            small_n, large_n = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
            left = F.least(F.expr("x.n - x.at"), F.expr("y.n - y.at"))
            need = F.floor((t * (F.col("x.n") + F.col("y.n")) + 99 + t) / (100 + t))
            meet = (F.col("x.h") == F.col("y.h")) & (F.col("x.class") == F.col("y.near")) & (F.col("x.doc_id") < F.col("y.doc_id")) & (F.col("x.label") != F.col("y.label"))
            meet &= (small_n * 100 >= t * large_n) & (left >= need)
            pairs = x.join(y, meet).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
        more = _links(pairs, sets, t, "links")
        done.append(more)
        if not more.isEmpty():  # each component is a star by now
            known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
            done.append(found)
            found = S.stage(components(known.union(more), "a", "b"), "components")
    for table in done:
        S.unstage(table)
    return found


def jaccard_groups(documents: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, print (hash of the text), n_shingles, component_id (smallest doc_id reachable by links), for every row."""
    docs, factor = S.apart(documents)
    sampled = S.map_arrow(docs, _emit_sampled(words), "h long, doc_id long")
    again = S.map_arrow(sampled.repartition("h").sortWithinPartitions("h"), _count_recurring, "doc_id long, again long")
    again = again.groupBy("doc_id").agg(F.sum("again").alias("again"))
    joined = docs.join(again.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "again", "text", F.xxhash64("text").alias("print"))
    sets = S.map_arrow(joined, _emit_sets(words, threshold), "doc_id long, print long, n long, s1 long, s2 long, grams binary")
    sets = S.stage(sets, "sets")
    S.release(sets.sparkSession)
    print_of = ["n", "s1", "s2"]
    classes = sets.filter("n > 0").groupBy(*print_of).agg(F.min("doc_id").alias("class_id"))
    chosen = sets.filter("grams is not null").join(classes.filter("class_id is not null"), print_of).filter("doc_id = class_id")
    chosen = S.stage(chosen.select("doc_id", "grams").dropDuplicates(["doc_id"]), "classes")  # rows of one id are alike here
    found = similar_components(chosen, threshold).withColumnRenamed("node", "class_id")
    S.unstage(chosen)
    of_class = classes.join(found, "class_id", "left").select(*print_of, F.coalesce("component", "class_id").alias("component_id"))
    out = sets.select("doc_id", "print", *print_of).join(of_class, print_of, "left")
    whole = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(F.floor(F.col("doc_id") / factor).alias("doc_id") if factor > 1 else "doc_id", "print", F.col("n").alias("n_shingles"), (F.floor(whole / factor) if factor > 1 else whole).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("print")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM d),
s AS (SELECT DISTINCT doc_id, shingle FROM (SELECT doc_id, i, n, array_to_string(list(word) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), ' ') AS shingle FROM w)
  WHERE i = 0 OR i + 5 <= n),
z AS (SELECT doc_id, count(*) AS n, min(doc_id) OVER (PARTITION BY md5(string_agg(shingle, '|' ORDER BY shingle))) AS class FROM s GROUP BY doc_id),
r AS (SELECT s.doc_id, shingle, n FROM s JOIN z USING (doc_id) WHERE class = s.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM r a JOIN r b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
c AS (SELECT DISTINCT class AS a, class AS b FROM z UNION SELECT c.a, p.b FROM c JOIN p ON c.b = p.a),
m AS (SELECT a, min(b) AS component FROM c GROUP BY a)
SELECT d.doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, coalesce(m.component, d.doc_id) AS component_id
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN m ON z.class = m.a
"""
