"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row that the stage
before it left; all but the last return the columns of ``documents``:

1. ``toxicity``: documents whose toxicity score reaches the threshold go; the
   model is trained on the labelled ones among its own input;
2. ``minhash_dedup``: of each group of near copies (Jaccard of the five-word
   shingles at least NEAR percent) one document stays;
3. ``secret_scan``: secrets are masked in the text, no document goes;
4. ``mixing``: documents are repeated or left out so that every source gives its
   target share of words, in the order of the curriculum;
5. ``packing``: the texts' token pieces in sequences of at most 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import minhash, mixing, packing, secret_scan, toxicity
from ledgerloom.llm.common import store, table

#: Near copies share this part of their shingles, in percent; op3_minhash has its own 85.
NEAR = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs, NEAR)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_ids(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Toxicity is a trained model and packing an optimisation: no SQL says them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
