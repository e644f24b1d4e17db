"""Token-ID output: documents as Parquet list columns of token ids, in doc_id order.

Documents are dealt by ranges of doc_id and sorted within them; each task encodes its
documents and Spark's writer commits one file for it, so a lost executor costs a task,
not the table.  A row holds (part, doc_id, local_start, n_tokens, ids): part numbers the
files in doc_id order and local_start counts ids within the part, so starts over the whole
table need only the parts' sums.  Files have dictionary- or delta-encoded pages, bounded
row groups and pages, and page indexes: metadata can be read without ids, and the ids of
some documents without the rest.

Encoding is by distinct word: none of the tokenizer's rules looks across white space, so a
text's ids are its words' ids one after the other.  Only words that a worker doesn't hold
yet (it holds about HELD) go through the tokenizer.

`read_index` gives each document's place and `read_tokens` the ids of some documents: the
filter on doc_id reaches the scan, which skips row groups and pages by their indexes.

Defined cases: null or empty text is the end id alone; null doc_ids come first; rows that
repeat a doc_id each stay, in any order among themselves (ties); long texts are encoded whole,
one at a time; extra columns are ignored, whatever their names; an empty table gives an empty
table.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _shared as S

END_ID = 1
HELD, HELD_CORES = 1_000_000, 100_000
#: Parquet's bytes of a row group and a page, and most rows of a page.
ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 1 << 18, 2000
#: Marks that part from the word before them.
_ENDINGS = ".,;:!?#*$%&)"
SCHEMA = "part int, doc_id long, local_start long, n_tokens long, ids array<int>"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: its own if it is
    printable Latin-1 without blanks, else the next free one from U+0100."""
    own = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c]
    free = iter(range(256, 512))
    return [chr(c) if c in set(own) else chr(next(free)) for c in range(256)]


def _same_words(some: tuple, others: tuple, which: np.ndarray) -> bool:
    """Whether words, given as (lanes, first lane, size), are equal to those of others that which names."""
    lanes, at, sizes = some
    if not np.array_equal(sizes, others[2][which]):
        return False
    n = (sizes + 7) >> 3
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return np.array_equal(lanes[np.repeat(at, n) + k], others[0][np.repeat(others[1][which], n) + k])


class WordEncoder:
    """Ids of words; unknown words go to the tokenizer.

    Words are looked up by 64-bit hash and compared with the word that is held, byte by byte."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.forget()

    def forget(self) -> None:
        self.cores: dict[str, list[int]] = {}
        self.hashes, self.ids = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)  # the k-th hash's ids: ids[at[k] : at[k] + n[k]]
        self.lanes, self.word_at, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)  # and its word

    @staticmethod
    def lower(text: bytes) -> bytes:
        """A-Z lower-cased where the tokenizer would do so with the same result:
        not beside combining marks, which compose first, nor in special tokens."""
        return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()

    def _core(self, core: str) -> list[int] | None:
        """Ids of a word of lower-case letters, by the model alone (None: not such a word)."""
        found = self.cores.get(core)
        if found is None and core.isalpha() and core == core.lower() and is_normalized("NFC", core):
            found = [x.id for x in self.model.tokenize("".join([self.letters[b] for b in core.encode()]))]
            if len(self.cores) > HELD_CORES:
                self.cores.clear()
            self.cores[core] = found
        return found

    def encode_words(self, words: list[str]) -> list[list[int]]:
        out, odd = [], []
        for word in words:
            core = word.rstrip(_ENDINGS)
            ids = self._core(core) if core else None
            if ids is not None and len(core) < len(word):
                end = word[len(core) :]
                tail = self.cores.get(end)
                if tail is None:
                    tail = self.cores[end] = self.tokenizer.encode(end, add_special_tokens=False).ids
                ids = ids + tail
            if ids is None:
                odd.append(len(out))
            out.append(ids)
        for k, found in zip(odd, self.tokenizer.encode_batch([words[k] for k in odd], add_special_tokens=False), strict=True):
            out[k] = found.ids
        return out

    def _ids(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words, one after the other; where each word's ids start, and the end)."""
        sizes, (lanes, n_lanes) = ends - starts, S.word_lanes(data, starts, ends)
        lane_at = np.cumsum(n_lanes) - n_lanes
        hashes, first, which = np.unique(S.hash_lanes(lanes, n_lanes, sizes), return_index=True, return_inverse=True)
        if len(self.hashes) > HELD:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        known = first[~new]
        if not (
            _same_words((lanes, lane_at, sizes), (lanes, lane_at[first], sizes[first]), which)
            and _same_words((lanes, lane_at[known], sizes[known]), (self.lanes, self.word_at, self.size), at[~new])
        ):  # two words have one hash: without what is held
            found = self.encode_words([data[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
            return np.fromiter(chain.from_iterable(found), np.int32), np.cumsum([0, *map(len, found)])
        if new.any():
            found = self.encode_words([data[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            n = np.fromiter(map(len, found), np.int64, len(found))
            more = len(self.ids) + np.cumsum(n) - n
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(n.sum()))])
            own = n_lanes[first[new]]
            ends_at = np.cumsum(own)
            words_at = len(self.lanes) + ends_at - own
            self.lanes = np.concatenate([self.lanes, lanes[np.repeat(lane_at[first[new]] - ends_at + own, own) + np.arange(own.sum())]])
            before = at[new]
            held = (self.hashes, hashes[new]), (self.at, more), (self.n, n), (self.word_at, words_at), (self.size, sizes[first[new]])
            self.hashes, self.at, self.n, self.word_at, self.size = (np.insert(x, before, y) for x, y in held)
            at = np.searchsorted(self.hashes, hashes)
        n = self.n[at][which]
        done = np.concatenate([[0], np.cumsum(n)])
        return self.ids[np.repeat(self.at[at][which] - done[:-1], n) + np.arange(done[-1])], done

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; how many each has)."""
        texts = [self.lower(x) for x in texts]
        data = b" ".join(texts)
        starts, ends = S.word_bounds(data)
        flat, done = self._ids(data, starts, ends)
        offsets = np.cumsum([0, *(len(x) + 1 for x in texts)])
        of_text = done[np.searchsorted(starts, offsets)]
        counts = np.diff(of_text)
        out = np.full(len(flat) + len(texts), end_id, np.int32)
        out[np.arange(len(flat)) + np.repeat(np.arange(len(texts)), counts)] = flat
        return out, counts + 1


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _encode(path, end_id):
    def run(batches, schema):
        encoder, part, done = _encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column("doc_id"), [x or b"" for x in S.texts_of(batch)]
            k = 0
            while k < len(texts):
                j, size = k + 1, len(texts[k])
                while j < len(texts) and size + len(texts[j]) < S.CHUNK:
                    size += len(texts[j])
                    j += 1
                flat, lengths = encoder.encode(texts[k:j], end_id)
                offsets = np.concatenate([[0], np.cumsum(lengths)])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                columns = [pa.array(np.full(j - k, part, np.int32)), ids.slice(k, j - k), pa.array(done + offsets[:-1]), pa.array(lengths), lists]
                yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)
                done += int(offsets[-1])
                k = j

    return run


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, delta: bool = False) -> None:
    """Encode every row's text and write the table to path."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    in_order = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    options = {
        "compression": "zstd",
        "parquet.block.size": ROW_GROUP,
        "parquet.page.size": PAGE,
        "parquet.page.row.count.limit": PAGE_ROWS,
        "parquet.writer.version": "PARQUET_2_0" if delta else "PARQUET_1_0",
        "parquet.enable.dictionary": str(not delta).lower(),
    }
    S.map_arrow(in_order, _encode(tokenizer, end_id), SCHEMA).write.options(**options).parquet(path)


def _crc(batches, schema):
    for batch in batches:
        lists = batch.column("ids")
        flat, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("part", "doc_id", "local_start", "n_tokens")), pa.array(crc, pa.int64())], schema=schema)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in the parts before each; reads the counts only."""
    sums = spark.read.schema(SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, from the files."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    found = S.map_arrow(rows, _crc, "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return found.join(starts(spark, path), "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id, n_tokens, ids of some documents; reads the pages that may hold them."""
    rows = spark.read.schema(SCHEMA).parquet(path).select("doc_id", "n_tokens", "ids")
    if not doc_ids:
        return rows.filter("false")
    return rows.filter(F.col("doc_id").between(min(doc_ids), max(doc_ids)) & F.col("doc_id").isin(*doc_ids))


def token_output(documents: DataFrame, tokenizer: str | None = None, delta: bool = False) -> DataFrame:
    """The index of the table that is written for documents."""
    spark = documents.sparkSession
    path = S.scratch_path(spark, "tokens")
    write_tokens(documents, path, tokenizer or tokenizer_path(), delta=delta)
    return read_index(spark, path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(spark.read.parquet(f"{sf_dir}/documents.parquet"))
