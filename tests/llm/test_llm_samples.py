"""The bounded sample that models learn labels from."""

from __future__ import annotations

import warnings

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import common, quality_fm, quality_rules, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    return spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text"),
                                   F.lit(12).alias("n_chars"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"),
                                   (F.col("id") % 2).cast("int").alias("quality"))


def sizes(sample):
    return {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}


def test_labels_of_absent_documents_use_up_nothing(spark, docs, labels):
    absent = spark.range(1000, 200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"),
                                               (F.col("id") % 2).cast("int").alias("quality"))
    want = {tuple(r) for r in common.labelled(docs, labels, "toxic", 50).collect()}
    got = {tuple(r) for r in common.labelled(docs, labels.unionByName(absent), "toxic", 50).collect()}
    assert got == want and len(got) == 100


def test_null_texts_use_up_nothing(docs, labels):
    holes = docs.withColumn("text", F.when(F.col("doc_id") % 8 < 4, F.col("text")))
    assert sizes(common.labelled(holes, labels, "toxic", 40)) == {0: 40, 1: 40}


def test_a_repeated_id_is_one_row(spark, docs, labels):
    known = common.labelled(docs, labels, "toxic", 400).first().doc_id
    again = spark.range(50_000).select(F.lit(known).alias("doc_id"), F.concat(F.lit("copy "), F.col("id") % 3).alias("text"), F.lit(6).alias("n_chars"))
    sample = common.labelled(docs.unionByName(again), labels, "toxic", 400)
    assert sample.count() == sample.select("doc_id").distinct().count() == common.labelled(docs, labels, "toxic", 400).count()
    texts = lambda parts: common.labelled(docs.unionByName(again).repartition(parts), labels, "toxic", 400).filter(
        F.col("doc_id") == known).first().text
    assert texts(3) == texts(11)


@pytest.mark.parametrize("train, label", [(quality_rules.train, "quality"), (quality_fm.train, "quality"), (toxicity.train, "toxic")])
def test_an_empty_class_is_told(docs, labels, train, label):
    with pytest.warns(UserWarning, match=f"labelled {label}"):
        train(docs, labels.filter(F.col(label) == 0), 50)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        common.labelled(docs, labels, label, 50)
