from collections import defaultdict

import pytest

from daymark.llm import mixing

SCHEMA = "doc_id long, source string, text string, size long, hash string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def filled(sizes, weights, share, most):
    """Targets by dealing out again until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and level * weight[s] > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= more


def test_targets_are_met(spark):
    rows = [
        (i, f"s{i % 7}" if i % 11 else None, "w " * (i * 37 % 90), 5, "clash")
        for i in range(3000)
    ]
    rows += [(9000, "s1", "w " * 50_000, 0, ""), (9001, "s2", None, 0, ""), (9002, "s3", "", 0, "")]
    got = mixing.mix(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    text = {r[0]: r for r in rows}
    for r in got:
        assert r.size == len((text[r.doc_id][2] or "").split())
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    expected = filled(sizes, mixing.WEIGHTS, 1.5, 2)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1
    assert sorted(map(str, mixing.mix(frame(spark, rows)).collect())) == sorted(map(str, got))


def test_nested(spark):
    rows = [(i, "a", "w " * (1 + i % 9), 0, "") for i in range(500)]
    taken = []
    for share in (0.2, 0.5, 0.9):
        out = mixing.mix(frame(spark, rows), share=share).collect()
        taken.append({r.doc_id for r in out if r.taken})
        assert sum(r.taken for r in out) == pytest.approx(share * sum(r.size for r in out), abs=5)
    assert taken[0] < taken[1] < taken[2]


def test_repeated_rows_and_no_words(spark):
    same = [(1, "a", "w w", 0, "")] * 10 + [(None, "a", "w", 0, "")]
    out = mixing.mix(frame(spark, same), share=0.5).collect()
    assert len({r.taken for r in out if r.doc_id == 1}) == 1
    empty = mixing.mix(frame(spark, [(1, "a", None, 0, ""), (2, None, " ", 0, "")])).collect()
    assert {(r.size, r.target, r.taken) for r in empty} == {(0, 0.0, 0)}
    assert mixing.mix(frame(spark, same).limit(0)).count() == 0
