"""Toxicity where clean documents quote the insults, or labels are wrong."""

from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity

INSULTS = ["zorbhead", "klunkface", "mudwit", "grimlout", "snarkpig", "dreckling"]


@pytest.fixture(scope="module")
def noisy(spark):
    """(documents, labels): every insult is quoted in two of the clean documents, in any part of the sample."""
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    rows = []
    for i in range(900):
        words = [rng.choice(vocabulary) for _ in range(40)]
        for insult in rng.sample(INSULTS, 2) if i < 300 else [INSULTS[i % 6]] if i < 300 + 12 else []:
            words.insert(rng.randrange(len(words)), insult)
        rows.append((i, " ".join(words), int(i < 300)))
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_quoted_insults_stay_positive(noisy):
    docs, labels = noisy
    model = toxicity.train(docs, labels)
    assert model is not toxicity.EMPTY
    rows = [r for r in toxicity.score(docs, model).collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and not 300 <= r.doc_id < 312]
    toxic = [r.predicted for r in rows if r.doc_id < 300]
    clean = [r.predicted for r in rows if r.doc_id >= 312]
    assert sum(toxic) >= 0.9 * len(toxic) > 0 and sum(clean) <= 0.03 * len(clean)


def test_labels_that_say_nothing_are_told(noisy):
    docs, labels = noisy
    wrong = labels.withColumn("toxic", F.pmod(F.xxhash64(F.lit("any"), "doc_id"), F.lit(2)).cast("int"))
    some = docs.withColumn("text", F.concat_ws(" ", F.slice(F.split("text", " "), 1, 4)))
    with pytest.warns(UserWarning, match="beyond chance"):
        assert toxicity.train(some, wrong, 6) is not toxicity.EMPTY
