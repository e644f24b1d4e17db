"""The pipeline's stages, each on odd rows and against its operator, and as a whole."""

import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyfield.llm import decontamination, mixing, ngram_jaccard, quality, token_output

from .test_corpus import corpus, frame

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_each_stage_does_what_its_operator_says(spark, sf, docs):
    good = STAGES["quality rules"](spark, docs, sf)
    assert good.columns == docs.columns and ids(good) == ids(quality.judge(docs).filter("kept"))
    one = STAGES["n-gram Jaccard join"](spark, docs, sf)
    assert one.columns == docs.columns and ids(one) == ids(ngram_jaccard.jaccard_groups(docs).filter("doc_id = component_id"))
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    clean = STAGES["benchmark decontamination"](spark, docs, sf)
    assert clean.columns == docs.columns and ids(clean) == ids(decontamination.leaks(docs, benchmark).filter("not contaminated"))
    mixed = STAGES["mixing sources to target weights"](spark, docs, sf)
    want = sorted(r.doc_id for r in mixing.mix(docs).collect() for _ in range(r.copies))
    assert mixed.columns == docs.columns and ids(mixed) == want


def test_whole_equals_stage_by_stage_in_plain_python(spark, sf, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_output.tokenizer_path())
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = spark.createDataFrame(stage(spark, rows, sf).collect(), docs.schema)
    at, want = 0, []
    for r in sorted(rows.collect(), key=lambda r: r.doc_id):
        found = [*tokenizer.encode(r.text, add_special_tokens=False).ids, token_output.END_ID]
        want.append((r.doc_id, at, len(found), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in found))))
        at += len(found)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want


@pytest.mark.parametrize("name", STAGES)
def test_odd_rows(spark, sf, name):
    clash = {c: F.lit(1) for c in ("row", "id", "of", "words", "size", "copies", "nth", "kept", "items", "component_id", "n_shingles", "part", "start")}
    empty = frame(spark, []).withColumns(clash)
    assert STAGES[name](spark, empty, sf).collect() == []
    long = " ".join(f"word{k % 5003} of {k}" for k in range(60_000))
    rows = corpus(21, 20) + [(3, "twice " * 60), (3, "twice " * 60), (None, "no id " * 60), (None, None), (77, long)]
    odd = frame(spark, rows).withColumns(clash)
    out = STAGES[name](spark, odd, sf)
    if name != "token-ID output":
        assert out.columns == odd.columns
    out.collect()


def test_one_of_each_group_by_id_and_text(spark, sf):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (5, b), (7, f"{b} more"), (3, f"{a} more"), (9, c), (None, c), (None, None)]
    docs = frame(spark, rows).withColumn("n_chars", F.monotonically_increasing_id())
    for again in (docs, docs.repartition(5)):
        kept = STAGES["n-gram Jaccard join"](spark, again, sf)
        assert kept.columns == docs.columns
        # 5's first text is in the group of 3, its second one leads a group
        assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(map(str, [(3, f"{a} more"), (5, b), (9, c), (None, c), (None, None)]))
