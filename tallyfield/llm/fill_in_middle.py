"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of about FRAME_BYTES, each with the bytes,
code points and units that lie before it.  A unit is a run of ASCII letters or one other
character; it counts where it begins, so a run may go on over any number of frames.  A cut
after k units is found by the counts: only the frame in which unit k begins is decompressed.
The transformed text is written frame by frame from ranges of the stored one, in the order
that its form asks for, and is itself a text of frames; `digests` streams it once as it is
and once more by ranges in the order of the original, told by form and markers alone.  So of
a text and its output no more than one frame of each is held plain.

`store` makes the frames, `write_frames` writes them, `transform` cuts and orders,
`digests` hashes the outputs and what `original` rebuilds from them.

Cuts and forms come from the hex sha256 of the salt, a colon and the doc_id: reruns agree.

Defined cases: null or empty text has no units and one form, plain, with null lengths; so
has a text that holds a marker, since its output could be read in two ways; a null doc_id is
hashed as no digits; rows that repeat a doc_id (ties) are cut at the same hashes, each in its
own text; long texts follow the frames; extra columns are ignored, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared as S

FRAME_BYTES, LEVEL = 1 << 16, 3
SALT = "1"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: data: a zstandard frame; at, points, units: bytes, code points and units before it; inside: it begins within a run of letters.
FRAMES = "array<struct<data: binary, at: long, points: long, units: long, inside: boolean>>"
STORED = f"doc_id long, n long, n_chars long, n_bytes long, marked boolean, frames {FRAMES}"
OUTPUT = f"doc_id long, n long, form string, prefix_chars long, middle_chars long, n_bytes long, frames {FRAMES}"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def unit_starts(piece: bytes, inside: bool) -> np.ndarray:
    """Where units begin in a piece of UTF-8; inside: it goes on with the run of letters before it."""
    b = np.frombuffer(piece, np.uint8)
    letter = (b | 32) - np.uint8(97) < 26
    before = np.empty(len(b), bool)
    if len(b):
        before[0], before[1:] = inside, letter[:-1]
    return np.flatnonzero((letter & ~before) | (~letter & ((b & 0xC0) != 0x80)))


def points_in(piece: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(piece, np.uint8) & 0xC0) != 0x80))


class FrameWriter:
    """Takes pieces of a text (cut between code points) and gives its frames."""

    def __init__(self, counting: bool = True):
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.counting = counting

    def frames(self, pieces: Iterator[bytes]) -> tuple[list[tuple], int, int, int]:
        """(frames, bytes, code points and units of the whole)."""
        out, at, points, units, inside = [], 0, 0, 0, False
        held: list[bytes] = []
        size = 0

        def close(piece: bytes) -> None:
            nonlocal at, points, units, inside
            out.append((self.packer.compress(piece), at, points, units, inside))
            at += len(piece)
            if self.counting:
                points += points_in(piece)
                units += len(unit_starts(piece, inside))
                inside = piece[-1:].isalpha()

        for piece in pieces:
            while size + len(piece) >= FRAME_BYTES:
                cut = FRAME_BYTES - size
                while cut < len(piece) and piece[cut] & 0xC0 == 0x80:
                    cut += 1
                close(b"".join([*held, piece[:cut]]))
                held, size, piece = [], 0, piece[cut:]
            if piece:
                held.append(piece)
                size += len(piece)
        if held:
            close(b"".join(held))
        return out, at, points, units


class FrameReader:
    """Ranges of a text that is stored in frames."""

    def __init__(self, frames: list[dict], n_bytes: int):
        self.frames, self.n_bytes = frames, n_bytes
        self.ats = [f["at"] for f in frames]
        self.unpacker = zstandard.ZstdDecompressor()

    def piece(self, k: int) -> bytes:
        return self.unpacker.decompress(self.frames[k]["data"])

    def range(self, start: int, end: int) -> Iterator[bytes]:
        """The bytes from start to end, a frame at a time."""
        k = bisect_right(self.ats, start) - 1
        while start < end:
            piece = self.piece(k)[start - self.ats[k] : end - self.ats[k]]
            yield piece
            start += len(piece)
            k += 1

    def place(self, unit: int, n: int, n_chars: int) -> tuple[int, int]:
        """(byte, code point) at which the unit of that number begins; the text's end if it has only so many."""
        if unit >= n:
            return self.n_bytes, n_chars
        k = bisect_right([f["units"] for f in self.frames], unit) - 1
        frame, piece = self.frames[k], self.piece(k)
        at = int(unit_starts(piece, frame["inside"])[unit - frame["units"]])
        return frame["at"] + at, frame["points"] + points_in(piece[:at])

    def find(self, marker: bytes, start: int) -> int:
        """Where the marker first occurs from start on."""
        at, held = start, b""
        for piece in self.range(start, self.n_bytes):
            here = held + piece
            if (k := here.find(marker)) >= 0:
                return at - len(held) + k
            at += len(piece)
            held = here[1 - len(marker) :]
        raise ValueError("the output lacks a marker")


def hashed(doc_id: int | None, salt: str) -> list[int]:
    digits = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[k : k + 8], 16) for k in range(0, 32, 8)]


def plan(doc_id: int | None, n: int, marked: bool, salt: str) -> tuple[str, int, int]:
    """(form, unit after which the prefix ends, the middle ends)."""
    h1, h2, h3, h4 = hashed(doc_id, salt)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or marked or h3 % 100 >= 100 - PLAIN_PERCENT:
        return "plain", first, second
    return "spm" if h4 % 100 < SPM_PERCENT else "psm", first, second


def original(form: str, text: FrameReader) -> Iterator[bytes]:
    """The text that an output was made of, from the output and its form alone."""
    if form == "plain":
        yield from text.range(0, text.n_bytes)
        return
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    a = len(first)  # the output begins with a marker
    b = text.find(second, a)
    c = text.find(MIDDLE, b + len(second))
    parts = (a, b), (b + len(second), c), (c + len(MIDDLE), text.n_bytes)
    for k in (0, 2, 1) if form == "psm" else (1, 2, 0):
        yield from text.range(*parts[k])


_FIELDS = ("data", "at", "points", "units", "inside")


def _dicts(frames: list[tuple]) -> list[dict]:
    return [dict(zip(_FIELDS, f, strict=True)) for f in frames]


def _store(batches, schema):
    writer = FrameWriter()

    def rows():
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text = texts[k].as_py() or b""
                frames, size, points, units = writer.frames(iter([text]))
                marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
                yield size, (doc_id, units, points, size, marked, _dicts(frames))

    yield from S.sized_batches(rows(), schema)


def _transform(salt):
    def run(batches, schema):
        writer = FrameWriter(counting=False)

        def rows():
            for batch in batches:
                for k in range(batch.num_rows):
                    row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                    n, text = row["n"], FrameReader(row["frames"], row["n_bytes"])
                    form, first, second = plan(row["doc_id"], n, row["marked"], salt)
                    if form == "plain":
                        yield row["n_bytes"], (row["doc_id"], n, form, None, None, row["n_bytes"], row["frames"])
                        continue
                    (a, chars_a), (b, chars_b) = (text.place(x, n, row["n_chars"]) for x in (first, second))
                    prefix, middle, suffix = (0, a), (a, b), (b, row["n_bytes"])

                    def pieces(form=form, text=text, prefix=prefix, middle=middle, suffix=suffix):
                        order = [(PREFIX, prefix), (SUFFIX, suffix)]
                        for marker, part in (*(order if form == "psm" else order[::-1]), (MIDDLE, middle)):
                            yield marker
                            yield from text.range(*part)

                    frames, size, _, _ = writer.frames(pieces())
                    yield size, (row["doc_id"], n, form, chars_a, chars_b - chars_a, size, _dicts(frames))

        yield from S.sized_batches(rows(), schema)

    return run


def _digests(batches, schema):
    def hexdigest(pieces: Iterator[bytes]) -> str:
        digest = hashlib.sha256()
        for piece in pieces:
            digest.update(piece)
        return digest.hexdigest()

    for batch in batches:
        rows = []
        for k in range(batch.num_rows):
            text = FrameReader(batch.column("frames")[k].as_py(), batch.column("n_bytes")[k].as_py())
            form = batch.column("form")[k].as_py()
            rows.append((hexdigest(text.range(0, text.n_bytes)), hexdigest(original(form, text))))
        if rows:
            kept = [batch.column(c) for c in schema.names[:5]]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c) for c in zip(*rows, strict=True))], schema=schema)


def store(documents: DataFrame) -> DataFrame:
    """Every row's text as frames (STORED)."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return S.map_arrow(docs, _store, STORED)


def write_frames(documents: DataFrame, path: str) -> None:
    """The store as Parquet; frames are compressed already."""
    store(documents).write.option("compression", "none").parquet(path)


def transform(stored: DataFrame, salt: str = SALT) -> DataFrame:
    """Outputs as frames (OUTPUT) of stored texts."""
    return S.map_arrow(stored, _transform(salt), OUTPUT)


def digests(outputs: DataFrame) -> DataFrame:
    """sha256 of each output and of the text rebuilt from it (RESULT)."""
    return S.map_arrow(outputs, _digests, RESULT)


def fill_in_middle(documents: DataFrame, salt: str = SALT) -> DataFrame:
    """Write the frames of documents, transform them from there, and give the digests."""
    spark = documents.sparkSession
    path = S.scratch_path(spark, "frames")
    write_frames(documents, path)
    return digests(transform(spark.read.schema(STORED).parquet(path), salt))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS h FROM documents
), units AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units,
    cast('0x' || substr(h, 1, 8) AS bigint) AS h1, cast('0x' || substr(h, 9, 8) AS bigint) AS h2,
    cast('0x' || substr(h, 17, 8) AS bigint) AS h3, cast('0x' || substr(h, 25, 8) AS bigint) AS h4 FROM hashed
), cuts AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM units
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(units, 1, a), '') AS prefix,
    array_to_string(list_slice(units, a + 1, b), '') AS middle, array_to_string(list_slice(units, b + 1, n), '') AS suffix FROM cuts
)
SELECT doc_id, cast(n AS bigint) AS n, form,
  CASE WHEN form <> 'plain' THEN cast(length(prefix) AS bigint) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN cast(length(middle) AS bigint) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
