import random
import re

import pytest
from pyspark.sql import functions as F

from daymark.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(docs, items, size, slack=None):
    out = []
    for doc_id, text in docs:
        own, hit, found = cut(text), set(), set()
        for item_id, item in items:
            terms = cut(item)
            k = min(size, len(terms))
            for at in range(len(terms) - k + 1 if k else 0):
                window = terms[at : at + k]
                for p in range(len(own)):
                    if slack is None:
                        end = p + k if own[p : p + k] == window else None
                    else:
                        ends = [
                            e
                            for e in range(p + 1, min(p + k + slack, len(own)) + 1)
                            if set(window) <= set(own[p:e])
                        ]
                        end = min(ends, default=None)
                        if end and set(window) <= set(own[p + 1 : end]):
                            end = None  # not the shortest span
                    if end:
                        hit |= set(range(p, end))
                        found.add(item_id)
        out.append((doc_id, len(own), len(hit), frozenset(found)))
    return sorted(out, key=str)


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, shard int, term string"),
        spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, terms string"),
    )


def found(spark, docs, items, size, shard_words=50, **more):
    left, right = tables(spark, docs, items)
    out = d.search(d.build_index(left, shard_words), right, size, **more)
    rows = out.withColumn("n_hit", d.covered("runs")).collect()
    return sorted(
        (
            (r.doc_id, r.n_words, r.n_hit, frozenset(r["items"]) | ({None} if r.null_item else set()))
            for r in rows
        ),
        key=str,
    )


def random_tables(seed):
    rng = random.Random(seed)

    def text(n):
        seps = [" ", ", ", "--", "\n"]
        return "".join(rng.choice("aAbBcdé") + rng.choice(seps) for _ in range(n))

    docs = [(i, text(rng.randrange(40))) for i in range(40)]
    docs += [(3, None), (None, "a b c"), (90, ""), (91, "a b " * 300), (91, "a b " * 300)]
    items = [(i, text(rng.randrange(8))) for i in range(12)]
    items += [(1, "a b"), (None, "c d a"), (50, None), (51, "")]
    return docs, items


@pytest.mark.parametrize("slack", [None, 0, 2])
def test_against_brute_force(spark, slack):
    docs, items = random_tables(1)
    if slack is not None:
        docs = [x for x in docs if x[0] != 91]
    expected = brute(docs, items, 3, slack)
    assert found(spark, docs, items, 3, slack=slack) == expected
    assert any(row[2] for row in expected)


def test_blocks_of_items(spark):
    docs, items = random_tables(2)
    assert found(spark, docs, items, 3, block_words=5) == brute(docs, items, 3)


@pytest.mark.parametrize("words", [1, 7, 40])
def test_items_beyond_one_block_are_met_in_tasks(spark, monkeypatch, words):
    docs, items = random_tables(3)
    expected = brute(docs, items, 3)
    assert found(spark, docs, items, 3) == expected  # one block
    monkeypatch.setattr(d, "_search_at_once", lambda *a: pytest.fail("items went through the driver"))
    assert found(spark, docs, items, 3, block_words=words) == expected


def test_empty_tables(spark):
    docs, items = random_tables(3)
    assert found(spark, docs, [], 3) == brute(docs, [], 3)
    assert found(spark, docs, [(1, None)], 3) == brute(docs, [], 3)
    assert found(spark, [], items, 3) == []


def test_contamination(spark):
    left, right = tables(
        spark,
        [(1, "a b " + "x " * 38), (2, "a b " + "x " * 39), (3, "x"), (4, None)],
        [(7, "a b"), (30, "A b!")],
    )
    rows = d.contamination(d.search(d.build_index(left), right)).orderBy("doc_id").collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in rows] == [
        (2, 2, True),
        (2, 2, False),
        (0, 0, False),
        (0, 0, False),
    ]
    assert rows[0].asDict()["items"] == [7, 30] or set(rows[0].asDict()["items"]) == {7, 30}


def test_hot_term_stays_in_its_shards(spark):
    docs = [(i, "the " * 100) for i in range(100)]
    left, _ = tables(spark, docs, [])
    index = d.build_index(left.coalesce(1), shard_words=1000)
    assert index.agg(F.max(F.size("places"))).first()[0] <= 10_000
    assert index.where("term IS NULL").count() >= 1
