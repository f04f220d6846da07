"""op2: the allocation comes from all copies in their training order."""

from __future__ import annotations

from collections import Counter
from hashlib import md5

import pytest

from ledgerloom.llm import mixing

WORDS = "one two three four five six seven"


@pytest.fixture
def docs(spark):
    rows = [(i, " ".join([WORDS] * (i % 5)) or None, f"s{i % 4}" if i % 9 else None, "x") for i in range(120)]
    return spark.createDataFrame([*rows, *rows[::7], (None, WORDS, "s1", "y")], "doc_id long, text string, source string, lang string")


def test_documents_come_in_the_order_of_their_first_copies(spark, docs):
    once = docs.dropDuplicates(["doc_id"])
    rows = mixing.allocation(once).collect()
    mixed = [r.doc_id for r in mixing.mix(once).select("doc_id").collect()]
    taken = [r.doc_id for r in rows if r.taken]
    assert taken == list(dict.fromkeys(mixed)) and len(mixed) > len(taken)
    assert all(r.taken == 0 and r.position is None for r in rows[len(taken):])
    assert [r.position for r in rows[:len(taken)]] == sorted(r.position for r in rows[:len(taken)])
    assert [md5(str(r.doc_id).encode()).hexdigest() for r in rows[len(taken):] if r.doc_id is not None] == sorted(
        md5(str(r.doc_id).encode()).hexdigest() for r in rows[len(taken):] if r.doc_id is not None)


def test_all_copies_are_range_sorted(docs):
    plan = mixing.allocation(docs)._jdf.queryExecution().optimizedPlan().toString()
    copies = next(line for line in plan.splitlines() if "Sort" in line and "position" in line)
    assert "true" in copies and plan.index(copies) < plan.index("posexplode(")       # a global sort, above the copies


def test_each_row_stands_once_and_its_words_are_those_of_its_copies(docs):
    rows = mixing.allocation(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.collect())
    words = Counter()
    for r in mixing.mix(docs).collect():
        words[r.doc_id] += len(r.text.split())
    want = Counter()
    for r in rows:
        want[r.doc_id] += r.taken
    assert +want == words
