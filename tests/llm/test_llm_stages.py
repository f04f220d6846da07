"""Every stage of the pipeline against a plain version on the stage's own input, and op8's placement against a plain one."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import packing, shards, toxicity
from ledgerloom.llm.common import store, table
from ledgerloom.llm.queries import ORACLE

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark):
    """name -> (input, output) of every stage, as lists of rows, and the folder of the input."""
    docs, out = store(table(spark, SF, "documents"), "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, docs, SF), name)
        out[name] = (docs.collect(), after.collect(), docs.inputFiles())
        docs = after
    return out


def sql(stages, name, query):
    """``query`` in DuckDB over the stage's input as ``documents``."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet({[f.replace('file://', '') for f in stages[name][2]]!r})")
    cur = con.execute(query)
    names = [d[0] for d in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


def test_toxicity_keeps_exactly_the_rows_under_the_cut(spark, stages):
    before, after, _ = stages["toxicity"]
    docs = table(spark, SF, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, table(spark, SF, "labels")))
    clean = Counter(r.doc_id for r in scores.filter(F.col("score") < toxicity.CUT).collect())
    assert Counter(r.doc_id for r in after) == clean and set(after) <= set(before)


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_near_dedup_keeps_one_document_of_each_component(stages):
    before, after, _ = stages["minhash_dedup"]
    sets = {r.doc_id: shingles(r.text) for r in before}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if 100 * common >= corpus_pipeline.NEAR * (len(sets[a]) + len(sets[b]) - common) > 0:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    want = {i for i in sets if not sets[i] or top(i) == i}
    assert {r.doc_id for r in after} == want and len(after) == len(want) < len(before) and set(after) <= set(before)


def test_secrets_are_masked_where_plain_expressions_find_them(stages):
    before, after, _ = stages["secret_scan"]
    spans = {r["doc_id"]: r["spans"] for r in sql(stages, "secret_scan", ORACLE["op4_secrets"])}
    want = []
    for r in before:
        text, at, out = r.text or "", 0, []
        for kind, start, end in (s.split(":") for s in spans[r.doc_id].split(",") if s):
            if int(start) >= at:
                out += [text[at:int(start)], f"[{kind}]"]
            at = max(at, int(end))
        masked = "".join([*out, text[at:]])
        want.append((r.doc_id, masked if r.text is not None else None, r.lang, r.source, len(masked) if out else r.n_chars))
    assert Counter(want) == Counter(tuple(r) for r in after) and any(a != tuple(b) for a, b in zip(sorted(want), sorted(before)))


def test_mixing_takes_the_words_that_sql_says(stages):
    _, after, _ = stages["mixing"]
    want = {r["doc_id"]: r["taken"] for r in sql(stages, "mixing", ORACLE["op2_mix"])}
    got, copies, texts = Counter(), defaultdict(list), {r.doc_id: r.text for r in stages["mixing"][0]}
    for r in after:
        got[r.doc_id] += len(WORD.findall(r.text or ""))
        copies[r.doc_id].append(r.text)
    assert {i: n for i, n in want.items() if n} == dict(got)
    assert all(all((texts[i] or "").startswith(t) for t in ts) and len(ts) <= 3 for i, ts in copies.items())


def test_packing_holds_the_tokenizers_ids_once_each(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    before, after, _ = stages["packing"]
    want = Counter()
    for r in before:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, packing.END]
        want.update((r.doc_id, k, at, tuple(ids[at:at + 4096])) for k, at in enumerate(range(0, len(ids), 4096)))
    assert want == Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in after)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in after)
    sequences = defaultdict(list)
    for r in after:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in after) // 4096) + 1


def test_shards_are_those_of_a_plain_placement(spark):
    """Groups of different sizes, each over 1/GRAIN of the whole, placed one by one in plain Python."""
    rng, rows, seen = random.Random(9), [(1000, None), (1001, "")], {32}
    for n in rng.sample(range(20, 900), 300):
        text, copies = "word " * n + "é" * rng.randrange(5), rng.choice((1, 1, 2, 3))
        total = copies * (len(text.encode()) + 16)
        if total not in seen:                             # equal sums would be placed in any order
            seen.add(total)
            rows += [(len(rows) + k, text) for k in range(copies)]
    out = shards.assign(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), shards=7).collect()
    groups = defaultdict(lambda: [0, 0, 0])
    for i, t in rows:
        text = t or ""
        for k, x in enumerate((len(text.encode()) + 16, len(WORD.findall(text)), 1)):
            groups[text][k] += x
    total = [sum(g[k] for g in groups.values()) for k in range(3)]
    share = {t: [x / s for x, s in zip(g, total)] for t, g in groups.items()}
    assert len({s[0] for s in share.values()}) == len(share) and min(max(s) for s in share.values()) > 1 / shards.GRAIN
    left = [[1 / 7] * 3 for _ in range(7)]
    place = {}
    for text in sorted(share, key=lambda t: -share[t][0]):
        item = share[text]
        fits = [s for s in range(7) if left[s][0] >= item[0]]
        score = lambda s: sum(a * b * w for a, b, w in zip(left[s], item, shards.EMPHASIS)) if fits else left[s][0]
        best = max(fits or range(7), key=lambda s: (round(score(s), 15), -s))
        place[text] = best
        left[best] = [a - b for a, b in zip(left[best], item)]
    want = {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), place[t or ""]) for i, t in rows}
    assert {(r.doc_id, r["size"], r.text_crc32, r.shard) for r in out} == want
    for s in range(7):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
