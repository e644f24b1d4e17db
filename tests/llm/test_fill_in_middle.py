"""Fill-in-middle against a plain version, with frames of a few bytes and odd rows."""

import hashlib
import random
import re

import pytest

from tallyfield.llm import fill_in_middle as fim

DOCS = "doc_id long, text string, n int, form string, frames string"
PIECES = ["word", "a", "Z", " ", "\n", "é", "日本", "😀", "1", "<", "P", ">", "S", "M", "longer" * 9, "\x00", "."]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), sha(f"<S>{suffix}<P>{prefix}<M>{middle}"), sha(text)
    return doc_id, len(units), "psm", len(prefix), len(middle), sha(f"<P>{prefix}<S>{suffix}<M>{middle}"), sha(text)


def rows_of(seed):
    r = random.Random(seed)
    rows = [(k, "".join(r.choice(PIECES) for _ in range(r.randrange(60)))) for k in range(300)]
    rows += [(400 + k, t) for k, t in enumerate([None, "", "<P>", "a<S>b", "<M", "x" * 5000, "é" * 700, "ab " * 900, "<" * 50])]
    return [*rows, (None, "text without an id"), (None, None), (7, rows[7][1]), (7, "another text, same id"), (-3, "a b c")]


@pytest.mark.parametrize("frame_bytes", [1, 3, 64, 1 << 16])
def test_brute_force(spark, frame_bytes, monkeypatch):
    rows = rows_of(frame_bytes)
    monkeypatch.setattr(fim, "FRAME_BYTES", frame_bytes)  # frames are made below, in this process
    got = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        frames, size, points, units = fim.FrameWriter().frames(iter([raw]))
        assert points == len(text or "") and size == len(raw)
        reader = fim.FrameReader(fim._dicts(frames), size)
        assert b"".join(reader.range(0, size)) == raw
        form, first, second = fim.plan(doc_id, units, any(m in raw for m in (b"<P>", b"<S>", b"<M>")), "1")
        a, b = (reader.place(x, units, points) for x in (first, second))
        want = brute(doc_id, text)
        assert (units, form) == want[1:3]
        if form != "plain":
            assert (a[1], b[1] - a[1]) == want[3:5] and raw[: a[0]].decode() == (text or "")[: a[1]]
        got.append(want)
    if frame_bytes == 1 << 16:
        found = fim.fill_in_middle(spark.createDataFrame([(i, t, 0, "x", "y") for i, t in rows], DOCS)).collect()
        assert sorted(map(tuple, found), key=repr) == sorted(got, key=repr)


def test_texts_of_several_frames(spark):
    rows = [(k, "word and é日本 " * 40000) for k in range(12)]
    found = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found)) == sorted(brute(i, t) for i, t in rows)


def test_cuts_decompress_their_frames_only(monkeypatch):
    text = ("one two " * 100_000).encode()
    frames, size, points, units = fim.FrameWriter().frames(iter([text]))
    reader = fim.FrameReader(fim._dicts(frames), size)
    read = []
    monkeypatch.setattr(reader, "piece", lambda k, f=reader.piece: read.append(k) or f(k))
    assert reader.place(200_000, units, points) == (400_000, 400_000) and len(read) == 1 and len(frames) > 10


def test_outputs_are_rebuilt_from_their_form(spark):
    docs = spark.createDataFrame([(k, f"some text <S of {k} P> words") for k in range(40)], "doc_id long, text string")
    for row in fim.transform(fim.store(docs)).collect():
        reader = fim.FrameReader([f.asDict() for f in row.frames], row.n_bytes)
        out = b"".join(reader.range(0, row.n_bytes)).decode()
        assert out.count("<M>") == (row.form != "plain")
        assert b"".join(fim.original(row.form, reader)).decode() == f"some text <S of {row.doc_id} P> words"


def test_empty_table(spark):
    assert fim.fill_in_middle(spark.createDataFrame([], DOCS)).collect() == []
