"""The registered training-data queries: SQL where there is some, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerloom.llm.common import store, table
from ledgerloom.llm.queries import ORACLE, QUERIES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "conversations", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    toxic = {r.doc_id for r in table(spark, SF, "labels").filter("toxic = 1").collect()}
    before, count = docs, docs.count()
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = store(stage(spark, before, SF), name)
        seen[name] = before
    ids = {n: [r.doc_id for r in df.select("doc_id").collect()] for n, df in seen.items()}
    gone = {r.doc_id for r in docs.collect()} - set(ids["toxicity"])
    # two thirds of some fifty labels are little to learn from; see test_held_out_accuracy for the score itself
    assert len(gone & toxic) >= 0.6 * len(toxic) and len(gone) < 0.15 * count
    assert len(ids["minhash_dedup"]) == len(set(ids["minhash_dedup"])) < len(ids["toxicity"])
    assert sorted(ids["secret_scan"]) == sorted(ids["minhash_dedup"])
    assert seen["secret_scan"].filter(r"text RLIKE 'AKIA[A-Z0-9]{16}'").count() == 0
    assert set(ids["mixing"]) <= set(ids["secret_scan"]) == set(ids["minhash_dedup"])
    lengths = {(r.sequence_id, r.offset): r.length for r in seen["packing"].collect()}
    assert set(ids["packing"]) == set(ids["mixing"]) and all(1 <= n <= 4096 for n in lengths.values())
    assert seen["packing"].filter("size(ids) <> length").count() == 0
