"""Operators 11 to 13 against brute force, with their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import codebooks, prefix_trie, runs, spread, suffix_repeats
from ledgerloom.llm.common import table
from tests.conftest import SF_SMALL

# ------------------------------------------------------------------ codebooks


def coded_by_hand(rows, length):
    kept = [(v, label, np.array([math.floor(1024 * c) for c in x], np.int64)) for v, x, label in rows
            if x is not None and len(x) == length and all(c is not None and math.isfinite(c) and abs(c) < 1e6 for c in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))
    x = np.array([r[2] for r in kept]).reshape(len(kept), 4, -1)
    books = [x[:256, p].copy() for p in range(4)]

    def nearest(p):
        d = ((x[:, p, None, :] - books[p][None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(4):
        for p in range(4):
            entry, _ = nearest(p)
            for e in set(entry.tolist()):
                books[p][e] = x[entry == e, p].sum(axis=0) // (entry == e).sum()
    found = [nearest(p) for p in range(4)]
    error = sum(d for _, d in found)
    labels = defaultdict(int)
    for (_, label, _), e in zip(kept, error.tolist()):
        labels[label] += e
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b.reshape(-1).tolist()).encode()).hexdigest()
    return Counter((v, "".join(f"{f[0][i]:02x}" for f in found), int(error[i]), labels[label], sha) for i, (v, label, _) in enumerate(kept))


VECTORS = "vec_id long, embedding array<double>, label int, code string, x int, part int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(v, x, label, "c", 1, 2, 3) for v, x, label in rows], VECTORS).repartition(5)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) + (i % 7) for _ in range(16)], None if i % 5 == 0 else i % 3) for i in range(700)]
    rows += [(5, rows[5][1], 1), (5, rows[6][1], 1), (None, rows[9][1], 0), (None, rows[9][1], 0)]       # repeated rows and ids
    rows += [(900 + i, [float(c)] * 16, 2) for i, c in enumerate((0, -0.0, -1 / 4096, 0.5, 1e-300))]     # ties
    rows += [(1000, None, 1), (1001, [None] + [0.0] * 15, 1), (1002, [math.nan] * 16, 1), (1003, [math.inf] + [0.0] * 15, 1),
             (1004, [1.0] * 12, 1), (1005, [], 1), (1006, [1.0] * 18, 1), (1007, [1e30] + [0.0] * 15, 1)]
    return rows


def test_codes_and_codebooks_equal_brute_force(spark, vectors):
    out = codebooks.compress(frame(spark, vectors))
    assert Counter(tuple(r) for r in out.collect()) == coded_by_hand(vectors, 16)


def test_few_and_no_vectors(spark, vectors):
    out = codebooks.compress(frame(spark, vectors[:3]))
    assert Counter(tuple(r) for r in out.collect()) == coded_by_hand(vectors[:3], 16)
    empty = codebooks.compress(frame(spark, vectors[:3]).limit(0))
    assert empty.count() == 0 and empty.columns == out.columns
    assert codebooks.compress(frame(spark, [(1, None, 1)])).count() == 0


@pytest.mark.parametrize("entries, dims, spread_", [(256, 16, 1000), (1, 4, 10), (65, 1, 3), (200, 3, 1 << 25)])
def test_slices_find_the_nearest_entry(entries, dims, spread_):
    rng = np.random.RandomState(entries)
    book = rng.randint(-spread_, spread_, (entries, dims)).astype(np.int64)
    parts = np.concatenate([rng.randint(-spread_ * 2, spread_ * 2, (500, dims)), book, book + 1]).astype(np.int64)
    entry, distance = codebooks.Slices(book).nearest(parts)
    every = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (entry == every.argmin(axis=1)).all()


def test_few_entries_are_compared():
    """On clustered entries the masks leave a small part of the codebook."""
    rng = np.random.RandomState(1)
    book = (rng.randint(-5000, 5000, (256, 16)) // 1).astype(np.int64)
    parts = book[rng.randint(0, 256, 2000)] + rng.randint(-50, 51, (2000, 16))
    s = codebooks.Slices(book)
    _, distance = s.nearest(parts)
    left = np.bitwise_count(s.within(parts, np.sqrt(distance).astype(np.int64) + 1)).sum()
    assert left < 2 * len(parts)


# ------------------------------------------------------------------ prefix trie


def trie_by_hand(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members, children = defaultdict(list), Counter()
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = Counter(), Counter()
    for node, ms in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(ms) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter((min(ms), len(n), min(members[n[:-1]]) if n else None, len(ms), children[n], leaves[n], saved[n], hashlib.sha256(
        ",".join(str(c) for c in sorted(ms) if len(paths[c]) == len(n)).encode()).hexdigest()) for n, ms in members.items())


TURNS = "conv_id long, turn int, role string, text string"


def trie_rows(spark, rows, schema=TURNS):
    return Counter(tuple(r) for r in prefix_trie.trie(spark.createDataFrame(rows, schema).repartition(4)).collect())


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(8)
    rows = []
    for c in range(-12, 60):
        if c % 10 == 5:
            continue                                                     # no such conversation; its dependants have no base
        for t in range(rng.choice((1, 2, 9, 17, 40))):
            rows.append((c, t, rng.choice(("user", "assistant")) if t else "system", rng.choice(("hi", "é中", "")) if t % 4 == 3 else "hello"))
    rows += [(100 + i, t, "user", f"turn {t}") for i in range(30) for t in range(20)]                   # one long path for many
    rows += [(200, t, "user", f"turn {t}") for t in range(700)]                                         # a hot conversation
    rows += [(300, None, None, None), (300, None, "user", None), (300, 1, None, "x"), (300, 1, None, "x"), (None, 1, "user", "no id")]
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, conversations):
    assert trie_rows(spark, conversations) == trie_by_hand(conversations)


def test_trie_over_segments_and_short_runs(spark, conversations, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 3)
    monkeypatch.setattr(prefix_trie, "RUN", 2)
    assert trie_rows(spark, conversations) == trie_by_hand(conversations)


def test_trie_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "a", 7, 8, "n", 9), (2, 0, "user", "a", 7, 8, "n", 9)]
    schema = TURNS + ", depth int, block int, t1 string, level int"
    assert trie_rows(spark, rows, schema) == trie_by_hand([r[:4] for r in rows])
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert trie_rows(spark, [(None, 0, "user", "a")]) == Counter()


def test_rolled_up_prefixes_in_one_expand(spark, conversations):
    """All prefixes are aggregated by one Expand per ROLLUP, after a partial aggregation."""
    turns, convs = prefix_trie.rebuilt(prefix_trie.numbered(spark.createDataFrame(conversations, TURNS)))
    rows = prefix_trie.blocks(turns, convs).withColumn("leaf", F.lit(0))
    plan = prefix_trie.rolled(rows, "count(*) AS n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1


# ------------------------------------------------------------------ repeated strings


def cut_by_hand(rows, length):
    seen = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = Counter()
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


DOCS = "doc_id long, text string, ta int, name string, place int, `a.b` int"


def cut_rows(spark, rows, length):
    docs = spark.createDataFrame([(d, t, 1, "n", 2, 3) for d, t in rows], DOCS).repartition(4)
    return Counter(tuple(r) for r in suffix_repeats.digests(docs, length).collect())


def varied(seed, letters, n):
    rng = random.Random(seed)
    base = "".join(rng.choice(letters) for _ in range(1500))
    rows = [(0, None), (1, ""), (2, "short"), (None, base[:300]), (3, base[:300]), (3, base[:300]), (4, "a" * 900), (5, "ab" * 300)]
    for i in range(n):
        a, text = rng.randrange(1000), "".join(rng.choice(letters) for _ in range(rng.randrange(80)))
        piece = list(base[a:a + rng.randrange(500)])
        for _ in range(rng.randrange(4)):
            if piece:
                piece[rng.randrange(len(piece))] = rng.choice("éx中 ")
        rows.append((10 + i, text + "".join(piece) + "".join(rng.choice(letters) for _ in range(rng.randrange(40)))))
    return rows


@pytest.mark.parametrize("length, letters", [(200, "abcdefgh "), (20, "ab"), (7, "abc")])
def test_removed_bytes_equal_brute_force(spark, length, letters):
    rows = varied(length, letters, 60)
    assert cut_rows(spark, rows, length) == cut_by_hand(rows, length)


def test_long_texts_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "PIECE", 97)
    rows = varied(5, "abcd", 25)
    assert cut_rows(spark, rows, 40) == cut_by_hand(rows, 40)


def test_a_passage_in_every_document(spark):
    """A passage of many documents, with other words on either side, is one group over all partitions."""
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(260))
    rows = [(i, f"{rng.random()} {i} " + passage + f" {i} {rng.random()}") for i in range(1500)]
    assert cut_rows(spark, rows, 200) == cut_by_hand(rows, 200)


def test_kept_bytes_and_empty_table(spark):
    rows = [(1, "x" * 10 + "é" * 120), (2, "y" * 10 + "é" * 120), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept) for r in suffix_repeats.remove(docs).collect()} == {1: b"x" * 10, 2: b"y" * 10, 3: b""}
    assert suffix_repeats.digests(docs.limit(0)).count() == 0


def test_names_by_doubling_are_names():
    x = np.frombuffer(b"abcabcabcabc", np.uint8)
    for length in (1, 2, 3, 5, 8, 11):
        found = suffix_repeats.names(x, length)
        assert len(found) == len(x) - length + 1
        texts = [x[i:i + length].tobytes() for i in range(len(found))]
        assert len(set(found.tolist())) == len(set(texts)) == len(set(zip(found.tolist(), texts)))


# ------------------------------------------------------------------ shared helpers


def test_marked_runs_over_partitions(spark):
    rows = [("a", "x")] * 500 + [("a", "y"), ("b", "x"), ("c", "z"), ("c", "z"), ("d", "p"), ("d", "q")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, l string, i int").repartition(7)
    out = runs.marked(df, ["k"], ["l"], ["i"], "test").collect()
    assert Counter((r.k, r.l, r.same) for r in out) == Counter({("a", "x", True): 500, ("a", "y", False): 1, ("c", "z", True): 2,
                                                                ("d", "p", False): 1, ("d", "q", False): 1})
    assert sorted((r.k, r.l) for r in out if r.head) == [("a", "x"), ("a", "y"), ("c", "z"), ("d", "p"), ("d", "q")]


def test_spread_join_splits_a_hot_key_and_matches_nulls(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, None).otherwise(F.least(F.col("id") % 3, F.lit(1))).alias("k"))
    one = spark.createDataFrame([(None, "n"), (1, "one")], "k long, v string")
    out = spread.spread_join(left, one, ["k"], F.col("id"), "left").groupBy("k", "v").count().collect()
    assert {(r.k, r.v): r["count"] for r in out} == {(None, "n"): 100, (1, "one"): 600, (0, None): 300}


def test_queries_return_their_whole_tables(spark):
    from ledgerloom.llm.queries import QUERIES
    assert QUERIES["op11_codebooks"](spark, SF_SMALL).count() == table(spark, SF_SMALL, "embeddings").count()
    assert QUERIES["op13_suffix_repeats"](spark, SF_SMALL).count() == table(spark, SF_SMALL, "documents").count()
