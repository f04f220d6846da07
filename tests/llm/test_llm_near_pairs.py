"""Near pairs at the threshold itself, against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerloom.llm import itq, minhash


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_near_dedup_stage_takes_pairs_from_80_percent(spark):
    rng = random.Random(8)
    texts, near = {}, set()
    for n in range(0, 80, 2):                              # pairs on both sides of 0.80, none between the pairs
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(200)]
        texts[n] = " ".join(words)
        for k in range(3 + n // 2 % 4):
            words[20 + 25 * k] = f"v{rng.randint(0, 10**6)}"
        texts[n + 1] = " ".join(words)
        if jaccard(texts[n], texts[n + 1]) >= 0.8:
            near.add(n)
    between = [n for n in near if jaccard(texts[n], texts[n + 1]) < 0.85]
    assert len(near) == 20 and len(between) == 10
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, df, "").collect()}
    assert kept == {n for n in texts if n - 1 not in near}
    assert minhash.deduplicate(df).count() == len(texts) - 10      # op3's 85 stays


def components(texts: dict[int, str], percent: int) -> dict[int, int]:
    """doc_id -> smallest doc_id reachable, by brute force."""
    root = {i: i for i in texts}

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for b in texts:
        for a in range(b):
            if 100 * jaccard(texts[a], texts[b]) >= percent:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in texts}


def varied(rng: random.Random, words: list[str], changes: int, drop: bool = False) -> list[str]:
    """The words with some of them changed (or dropped), six or more words apart."""
    out = list(words)
    for k in rng.sample(range(len(words) // 6), changes):
        out[6 * k + 2] = "" if drop else f"v{rng.randint(0, 10**9)}"
    return out


def near_group(n: int) -> dict[int, str]:
    """n copies linked with their text, n that are too far from it and from each other, near copies of some of these
    that join them with each other or with the text, and n / 4 copies with words left out."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = [base] + [varied(rng, base, 2) for _ in range(n)]
    far = [varied(rng, base, 5) for _ in range(n)]
    rows += far + [varied(rng, base, 4 + k % 3, drop=True) for k in range(n // 4)]
    for k in range(0, n // 3, 3):
        rows.append(varied(rng, far[k], 1))
        rows.append([a if i < 100 else b for i, (a, b) in enumerate(zip(far[k + 1], base))])    # half of its changes
    rng.shuffle(rows)
    return {i: " ".join(w for w in r if w) for i, r in enumerate(rows)}


def test_pairs_to_confirm_follow_the_group_not_its_square(spark, monkeypatch):
    """Copies that are not linked with the hub are not tried with all that are, and no link is lost."""
    tried, confirmed = [], minhash.confirmed

    def counted(pairs, sets, percent):
        tried.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(minhash, "confirmed", counted)
    more = []
    for n in (30, 120):
        texts = near_group(n)
        df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in minhash.duplicates(df, corpus_pipeline.NEAR).collect()}
        want = components(texts, corpus_pipeline.NEAR)
        assert got == want and n // 2 < len(set(want.values())) < len(texts) - n
        more.append(tried[-1])
    assert more[0] < 5 * 30 and more[1] < 5 * 120, more


def test_bands_and_margin_follow_the_threshold():
    assert minhash.bands(85) == 28
    for percent in (80, 85, 90):
        assert (1 - (percent / 100) ** minhash.BAND_ROWS) ** minhash.bands(percent) < minhash.MISS
    assert minhash.margin(80) > minhash.margin(85)
    with pytest.raises(ValueError):
        minhash.bands(50)


def close_vectors(share: float, n: int = 400) -> np.ndarray:
    """Pairs with cosine 0.98 to 0.985, where a common direction holds ``share`` of every vector's square."""
    rng = np.random.RandomState(4)
    common = np.ones(64) / 8
    own = rng.normal(size=(n, 64))
    own -= (own @ common)[:, None] * common
    x = np.sqrt(share) * common + np.sqrt(1 - share) * own / np.linalg.norm(own, axis=1, keepdims=True)
    y = np.stack([itq.partners(x[i:i + 1], rng.normal(size=(1, 64)), rng.uniform(0.9801, 0.985))[0] for i in range(n)])
    return np.concatenate([x, y])


def test_itq_tables_follow_the_common_direction():
    plans = [itq.plan(close_vectors(share, 2000), 0.98) for share in (0.0, 0.5, 0.7, 0.9)]
    assert (plans[0].width, plans[0].parts, plans[0].match, plans[0].radius) == (8, 8, 2, 12)
    assert plans[-1] is itq.EVERY or plans[-1].match == 1
    order = [itq.LADDER.index((p.width, p.parts, p.match)) if p.match else len(itq.LADDER) for p in plans]
    assert order == sorted(order) and order[1] > 0


@pytest.mark.parametrize("share", [0.7, 0.97])
def test_itq_recall_with_a_common_direction(spark, share):
    x = close_vectors(share)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    near = (x @ x.T >= 0.98) & ~np.eye(len(x), dtype=bool)
    got = [r.n_links for r in itq.near_vectors(df).collect()]
    assert near.sum() >= len(x) and 0.96 * near.sum() <= sum(got) <= near.sum()


def test_the_survivor_is_the_same_on_every_run(spark):
    """Rows with one doc_id and equal sets but different texts, and rows that differ in other columns only."""
    rows = [(1, "A b  c d e f", "x", {"k": 1}), (1, "a b c d e f", "x", {"k": 2}), (1, "A b  c d e f", "w", {"k": 0}), (2, "a B c d e f", "a", None),
            (3, None, "n", None), (4, "other words altogether here now", "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, node map<string,int>")
    seen = {tuple(sorted(str(r) for r in minhash.deduplicate(df.repartition(n)).collect())) for n in (1, 2, 5, 7)}
    assert len(seen) == 1 and len(next(iter(seen))) == 3
    assert "A b  c d e f" in str(seen) and "'w'" in str(seen)
