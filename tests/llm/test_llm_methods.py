"""Each operator against a plain version of its result, or an exact round trip."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import chat, itq, minhash, mixing, packing, quality_fm, quality_rules, secret_scan, shards, toxicity
from ledgerloom.llm.text import slices, structure

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
pieces = st.lists(st.sampled_from(["a", "bb", "é", "%%", " ", "  ", "\n", "\t", "x" * 70, "|", "中", "a b c ", "\r"]), max_size=40).map("".join)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


# ------------------------------------------------------------------ 1, 6, 9: counts and models

def plain_structure(text):
    words = WORD.findall(text)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(tri), set()
    for i, t in enumerate(tri):
        if counts[t] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@settings(max_examples=60, deadline=None)
@given(st.lists(pieces, min_size=1, max_size=6))
def test_structure_against_brute_force(texts):
    for lo, hi, buf, off in slices(pa.array(texts)):
        got = structure(buf, off)
        for i in range(lo, hi):
            assert tuple(int(v[i - lo]) for v in got.values()) == plain_structure(texts[i])


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_quality_rules_base_and_held_out_accuracy(docs, labels):
    rows = quality_rules.judge(docs, quality_rules.train(docs, labels)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        base = plain_structure(texts[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 50 or 100 * base[4] > 50 * base[0]) and (r.kept <= (not r.base_failed))
    marks = {r.doc_id: r.quality for r in labels.collect()}
    judged = [(r.kept, marks[r.doc_id]) for r in rows if r.doc_id in marks and held_out(r.doc_id) and not r.base_failed]
    assert sum(k == bool(q) for k, q in judged) >= 0.95 * len(judged)


@pytest.mark.parametrize("operator, label, least", [(quality_fm, "quality", 0.95), (toxicity, "toxic", 0.9)])
def test_held_out_accuracy(docs, labels, operator, label, least):
    rows = operator.score(docs, operator.train(docs, labels)).collect()
    marks = {r.doc_id: r[label] for r in labels.collect()}
    judged = [(r.predicted, marks[r.doc_id]) for r in rows if r.doc_id in marks and r.held_out]
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    assert sum(p == y for p, y in judged) >= least * len(judged)


def test_factorisation_identity():
    """The linear-time score equals the sum over all pairs."""
    rng = np.random.RandomState(3)
    size = quality_fm.WORDS + len(quality_fm.STATS)
    model = quality_fm.Model(0.3, rng.normal(size=size) * 0.1, rng.normal(size=(size, 3)) * 0.3, np.zeros(len(quality_fm.STATS)),
                             np.ones(len(quality_fm.STATS)), 1.0, 0.0)
    text = b"one two two three\nfour %% five five"
    buf, off, n = np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.array([-1])
    _, bucket, value, distinct = quality_fm.word_inputs(buf, off)
    x = np.zeros(size)
    x[bucket] = value
    x[quality_fm.WORDS:] = model.scaled(quality_fm.statistics(buf, off, distinct, n))[0]
    at = np.flatnonzero(x)
    z = model.bias + model.linear @ x + sum(model.factors[i] @ model.factors[j] * x[i] * x[j] for a, i in enumerate(at) for j in at[a + 1:])
    assert model.score(buf, off, n)[0] == pytest.approx(1 / (1 + np.exp(-z)))


def test_string_kernel_against_its_definition():
    def plain(s, t):
        def phi(x):
            out = Counter()
            for i in range(len(x)):
                for j in range(i + 1, len(x)):
                    for k in range(j + 1, min(len(x), i + toxicity.SPAN)):
                        out[x[i], x[j], x[k]] += toxicity.DECAY ** (k - i + 1)
            return out
        a, b = phi(s), phi(t)
        dot = lambda u, v: sum(u[x] * v[x] for x in u)
        return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))

    words = ["pathetic", "paxthetic", "pathtic", "garden", "tic"]
    strings = np.concatenate([toxicity.spell(w) for w in words])
    codes = [[int(c) for c in row if c] for row in strings]
    got = toxicity.kernel(strings, strings)
    for i, s in enumerate(codes):
        for j, t in enumerate(codes):
            assert got[i, j] == pytest.approx(plain(s, t))
    assert got[0, 1] > 0.5 > got[0, 3]


def test_gapped_insults_score_like_plain_ones():
    rng = random.Random(1)
    syllables = ["tion", "an", "er", "the", "ou", "ing", "sh", "ble", "re", "on", "st", "ha", "wh", "ed"]
    clean = sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(1500)})
    insults = ["pathetic", "worthless", "disgusting", "idiot", "moron", "stupid", "loser", "clown"]
    spell = lambda ws: np.concatenate([x for x in map(toxicity.spell, ws) if (x > 0).sum() >= 4])
    model = toxicity.Model(*toxicity.fit(spell(insults), spell(clean), np.concatenate([spell(insults), spell(clean)[:100]])), toxicity.EMPTY.document)

    def value(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return model.of_texts(raw, np.array([0, len(raw)]))[0, 0]

    for text in ("so pathetic", "so path-etic", "so pat.he.tic", "p a t h e t i c you", "so pathxetic", "so w*orthless", "an idi0ot", "PATHETIC!"):
        assert value(text) > 0.2, text
    assert sum(value(f"so {w}") > 0.2 for w in clean) < 0.02 * len(clean)


# ------------------------------------------------------------------ 2: mixing

def plain_targets(sizes):
    """Cap, reshare and again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] >= 3 * sizes[s]]
        if not full:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def test_mixing_targets_shares_and_order(spark, docs):
    rows = mixing.allocation(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= 1
    again = mixing.allocation(docs.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    # The light sources come late, the heavy ones early: the schedule shows in the mean training time.
    weights = dict(zip(sorted(sizes), (mixing.BASE_WEIGHTS * 10)))
    mixed = mixing.mix(docs).withColumn("at", F.monotonically_increasing_id()).collect()
    place = {w: np.mean([i for i, r in enumerate(mixed) if weights[r.source] == w]) / len(mixed) for w in (5, 1)}
    assert place[5] < 0.5 < place[1]
    words = Counter()
    for r in mixed:
        words[r.source] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert words == {s: n for s, n in taken.items() if n}


def test_demand_is_inverted(spark):
    share = [i / 50 for i in range(51)]
    for knots in mixing.KNOTS.values():
        df = spark.createDataFrame([(s,) for s in share], "s double").select(
            "s", mixing.demand_time(F.col("s"), F.array(*[F.lit(x) for x in knots])).alias("t"))
        for r in df.collect():
            grid = np.linspace(0, 1, 20001)
            rate = np.interp(grid, [0, 0.5, 1], knots)
            done = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)]) / 20000
            assert np.interp(r.t, grid, done / done[-1]) == pytest.approx(r.s, abs=1e-6)


# ------------------------------------------------------------------ 3: near copies

def plain_components(texts):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall(t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in texts}


def test_minhash_on_a_group_of_varied_copies(spark):
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(150)]
    texts, n = {}, 0
    for _ in range(160):                                   # a chain of copies: some near, some only near to a few
        words = list(base)
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(len(words))] = f"v{rng.randint(0, 99999)}"
        texts[n] = " ".join(words)
        n += 1
    for _ in range(40):
        texts[n] = " ".join(f"u{rng.randint(0, 9999)}" for _ in range(60))
        n += 1
    texts |= {n: texts[0].upper(), n + 1: texts[3], n + 2: "a b", n + 3: "A  b", n + 4: "a b c d e"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.duplicates(df).collect()}
    assert got == plain_components(texts)
    kept = {r.doc_id for r in minhash.deduplicate(df).collect()}
    assert kept == {c for _, c in got.values()}


def test_estimate_counts_equal_low_bits(spark):
    rng = np.random.RandomState(0)
    a = rng.randint(0, 2**63 - 1, 3000).astype(np.uint64)
    sets = [np.unique(x) for x in (a[:2000], np.concatenate([a[:1840], a[2000:2160]]), a[1000:3000])]
    lanes = minhash.packed(minhash.minima(sets))
    df = spark.createDataFrame([(x.tolist(), y.tolist()) for x in lanes for y in lanes], "a array<long>, b array<long>")
    got = [r.e for r in df.select(minhash.estimate(F.col("a"), F.col("b")).alias("e")).collect()]
    for (i, j), e in zip([(i, j) for i in range(3) for j in range(3)], got):
        both = len(np.intersect1d(sets[i], sets[j]))
        assert e == pytest.approx(both / (len(sets[i]) + len(sets[j]) - both), abs=0.1)
    assert got[0] == 1.0


# ------------------------------------------------------------------ 4: secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain_spans(text):
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[0], secret_scan.BASE.index(x[2])))


SCANNER = secret_scan.Scanner()
parts = st.lists(st.sampled_from(["password", "Token", "secret", "api_key", "APIKEY", "AKIA", "ABCD0123456789ABCDEF", "=", ":", " ", '"', "'", "abcdef",
                                  "deadbeef0123", "é", "x", "\n", "K", "ſecret", "..", "passwd", "0123456789abcdef01234567"]), max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(parts)
def test_base_spans_against_regular_expressions(text):
    assert [x for x in SCANNER.spans(text.encode()) if x[2] in secret_scan.BASE] == plain_spans(text)


def test_added_kinds_and_masking():
    text = "a ghp_" + "a1B2" * 9 + " b xoxb-123456-abcdef c -----BEGIN RSA PRIVATE KEY----- d"
    found = SCANNER.spans(text.encode())
    assert [k for _, _, k in found] == ["github", "slack", "pem"]
    assert secret_scan.mask(text, found) == "a [github] b [slack] c [pem] d"


def test_automaton_is_minimal():
    """No two states of the combined automaton can be told apart by fewer marks than they have."""
    dfa = SCANNER.all
    size = len(dfa.hits)
    block = {i: dfa.hits[i] for i in range(size)}
    for _ in range(size):
        keys = {i: (block[i], tuple(block[x >> 8] for x in dfa.table[i * 256:i * 256 + 256])) for i in range(size)}
        names = {k: n for n, k in enumerate(dict.fromkeys(keys.values()))}
        if len(names) == len(set(block.values())):
            break
        block = {i: names[keys[i]] for i in range(size)}
    assert len(set(block.values())) == size


# ------------------------------------------------------------------ 5: packing

@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 4096), st.integers(1, 400), min_size=1, max_size=40))
def test_plan_holds_every_piece_once_and_fits(histogram):
    runs = packing.plan_runs(histogram, steps=60)
    held = Counter()
    for run in runs:
        assert run.slots and run.gap >= 0 and sum(k * n for k, n in run.slots) + run.gap == 4096
        for size, n in run.slots:
            held[size] += n * run.count
    assert held == Counter(histogram)
    lower = -(-sum(k * n for k, n in histogram.items()) // 4096)
    alone = sum(n for k, n in histogram.items() if k > 2048)
    assert lower <= sum(r.count for r in runs) <= 1.25 * max(lower, alone) + 3


def test_pieces_are_the_tokenizers_and_sequences_nearly_full(docs):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    rows = docs.collect()
    want = {}
    for r, e in zip(rows, tokenizer.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        for k, at in enumerate(range(0, len(ids), 4096)):
            want[r.doc_id, k] = (at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))
    got = packing.pack(docs).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    assert len({r.sequence_id for r in got}) <= 1.01 * -(-sum(r.length for r in got) // 4096) + 1


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("abcABC '  \n\tsltd.,é")), max_size=30), max_size=4))
def test_word_cache_equals_the_tokenizer(texts):
    from ledgerloom.llm.tokens import WordIds
    words = WORDS.setdefault("ids", None) or WORDS.setdefault("made", WordIds(packing.tokenizer_path()))
    texts = [*texts, "x <|endoftext|>y"]
    flat, bounds = words.encode([t.encode() for t in texts])
    for t, a, b in zip(texts, bounds, bounds[1:]):
        assert flat[a:b].tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids


WORDS: dict = {}


# ------------------------------------------------------------------ 7: vectors

def test_itq_recall_and_exact_links_on_noisy_groups(spark):
    rng = np.random.RandomState(2)
    centres = rng.normal(size=(60, 64))
    x = np.concatenate([centres[rng.randint(0, 60, 700)] + rng.normal(size=(700, 64)) * rng.uniform(0.05, 0.2, (700, 1)), rng.normal(size=(300, 64))]).astype(np.float32)
    label = rng.randint(0, 2, len(x))
    df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))], "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (label[:, None] == label[None, :]) & ~np.eye(len(x), dtype=bool)
    got = {r.vec_id: r.n_links for r in itq.near_vectors(df).collect()}
    assert near.sum() > 500
    assert all(got[i] <= near[i].sum() for i in range(len(x)))
    assert sum(got.values()) >= 0.95 * near.sum()


# ------------------------------------------------------------------ 8: shards

def test_shards_balance_bytes_and_keep_groups(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 300)) for i in range(6000)] + [(10000 + i, "the same hot text over and over") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = shards.assign(df).toPandas()
    size = out.groupby("shard")["size"].sum()
    assert len(size) == 40 and size.max() <= 1.02 * size.min()
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert out.groupby("text_crc32")["shard"].nunique().sort_values().iloc[:-1].max() == 1     # only the hot group is dealt
    again = shards.assign(df.repartition(7)).toPandas()
    key = ["doc_id", "shard", "slot"]
    assert out[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()


def test_shards_written_in_slot_order(spark, docs, tmp_path):
    shards.write(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.drop("shard").columns == docs.columns and back.count() == docs.count()


# ------------------------------------------------------------------ 10: chat

marks = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", " [/INST]", "[OUT] ", "\\", "<", "[", "/s>", "<\\/s>", "<\\\\s>", "[ROLE]", "\n", " ", "x", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), marks), marks), max_size=6))
def test_chat_round_trip(turns):
    text = "".join(chat.render(role, body) for role, body in turns)
    assert [x[:2] for x in chat.parse(text)] == turns


def test_chat_digests_against_plain_ones(spark):
    conversations = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(chat.with_probe(conversations))).collect()}
    turns = {}
    for r in conversations.collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
