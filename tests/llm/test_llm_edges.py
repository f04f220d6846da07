"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import chat, itq, minhash, mixing, packing, quality_fm, quality_rules, secret_scan, shards, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, node int, size double, bucket string, shard string, score string, row string, place string, `a.b` int"
LONG = "word another " * 40000 + "x" * 300000
TEXTS = [None, "", " \n\t ", "one", "a b c d", "a b c d e", "password = abcdef123", "é ñ 中文 😀", LONG,
         "same text again here now", "same text again here now", "loser l o s e r id-iot", "\x00 \x7f"]


def doc(i, text, source="s"):
    return (i, text, "en", source, None if text is None else len(text), "k", 1, 1.0, "b", "s", "x", "r", "p", 5)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [doc(i, t, ["s", "t", None][i % 3]) for i, t in enumerate(TEXTS)]
    rows += [doc(None, "no id at all", None), doc(None, "no id at all", None), doc(None, None, None)]
    rows += [doc(9, "same text again here now", "s")]                    # a repeated row of document 9
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1), (4, None, None), (6, 7, 9)], "doc_id long, quality int, toxic int")


N = len(TEXTS) + 4


def test_quality_rules(docs, labels):
    for model in (quality_rules.EMPTY, quality_rules.train(docs, labels, 5)):
        out = quality_rules.judge(docs, model)
        assert out.count() == N and out.filter("probability IS NULL OR kept IS NULL").count() == 0
        assert out.filter("n_words = 0 AND NOT base_failed").count() == 0
    assert quality_rules.judge(docs.limit(0), quality_rules.EMPTY).count() == 0
    assert quality_rules.train(docs.limit(0), labels.limit(0)) is quality_rules.EMPTY


@pytest.mark.parametrize("operator", [quality_fm, toxicity])
def test_scores(docs, labels, operator):
    for model in (operator.EMPTY, operator.train(docs, labels, 5)):
        out = operator.score(docs, model).collect()
        assert len(out) == N and all(0 <= r.score <= 1 for r in out) and {r.predicted for r in out} <= {0, 1}
    assert operator.score(docs.limit(0), operator.EMPTY).count() == 0
    assert operator.train(docs.limit(0), labels) is operator.EMPTY


def test_mixing(docs):
    out = mixing.allocation(docs).collect()
    assert len(out) == N and all(0 <= r.taken <= 3 * r.size for r in out)
    assert mixing.allocation(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(docs).columns == docs.columns
    assert mixing.allocation(docs.withColumn("text", F.lit(None).cast("string"))).filter("taken > 0").count() == 0


def test_minhash(docs):
    out = minhash.duplicates(docs).collect()
    assert len(out) == N
    by = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by[10].component_id == 9 and not by[10].kept and by[9].kept
    assert [by[i].n_shingles for i in (0, 1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1, 1] and all(by[i].kept for i in range(9))
    assert [r.component_id for r in out if r.doc_id is None] == [None] * 3
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    # document 10 and one of the two rows 9 go, and one of the equal rows without id
    assert kept.count() == N - 3 and kept.filter("doc_id = 9").count() == 1 and kept.filter("doc_id IS NULL").count() == 2
    assert minhash.duplicates(docs.limit(0)).count() == 0 and minhash.deduplicate(docs.limit(0)).count() == 0


def test_secret_scan(docs):
    out = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    assert out[6].n_assign == 1 and out[6].spans == "assign:0:20" and out[0].spans == ""
    redacted = secret_scan.redact(docs)
    assert redacted.columns == docs.columns and redacted.count() == N
    r = redacted.filter("doc_id = 6").first()
    assert (r.text, r.n_chars) == ("[assign]", 8)
    assert secret_scan.scan(docs.limit(0)).count() == 0 and secret_scan.redact(docs.limit(0)).count() == 0


def test_packing(docs):
    out = packing.pack(docs).collect()
    assert sum(r.piece == 0 for r in out) == N and all(1 <= r.length <= 4096 for r in out)
    assert [r.length for r in out if r.doc_id == 0] == [1]               # only the end mark
    used = {}
    for r in out:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(docs.limit(0)).count() == 0


def test_shards(docs):
    out = shards.assign(docs, 3).collect()
    assert len(out) == N
    for s in range(3):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    assert next(r for r in out if r.doc_id == 0).size == 16
    assert shards.assign(docs.limit(0)).count() == 0


def test_itq(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.001], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1),
            (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [math.inf, 0.0], 1), (12, [1.0, 0.0, 0.0], 1),
            (13, [0.0, 1.0], 1), (1, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    out = itq.near_vectors(df).collect()
    assert len(out) == len(rows)
    by = {r.vec_id: r for r in out}
    assert (by[2].n_links, by[3].n_links, by[2].component_id) == (3, 3, 1)
    assert all(by[i].n_links == 0 and by[i].kept for i in (4, 5, 6, 7, 8, 9, 10, 11, 12))
    assert by[13].n_links == 1 and by[13].component_id == 13 and by[None].component_id == 13
    assert itq.near_vectors(df.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, None, None, "first"), (1, 0, "user", None), (None, 2, "assistant", "[/INST]"), (2, 1, "odd\nrole[ROLE]", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    out = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    assert out[1].n_turns == 3 and out[None].n_turns == 1 and out[None].loss_chars == 7 and out[2].n_turns == 1
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table, start in ((docs, None), (docs.limit(0), 0)):
        current = table
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, current, str(tmp_path))
            if name != "packing":
                assert out.columns == docs.columns
                current = out
            assert out.count() >= 0 if start is None else out.count() == 0
