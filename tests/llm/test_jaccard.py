import random
from collections import defaultdict

import pytest

from daymark.llm import jaccard


def shingles(text, size):
    w = (text or "").encode().lower().split()
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(rows, percent, size):
    sets = [shingles(text, size) for _, text, *_ in rows]
    group = list(range(len(rows)))
    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    least = defaultdict(lambda: float("inf"))
    for g, (doc_id, *_) in zip(group, rows):
        if doc_id is not None:
            least[g] = min(least[g], doc_id)
    return sorted(
        (str(r[0]), len(s), str(None if least[g] == float("inf") else least[g]), sum(s == t for t in sets) if s else 1)
        for r, s, g in zip(rows, sets, group)
    )


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "doc_id long, text string, cls int, n string"
    ).repartition(4)


def joined(spark, rows, percent=85, size=4, **more):
    labelled, links = jaccard.similarity_join(frame(spark, rows), percent, size, **more)
    got = sorted(
        (str(r.doc_id), r.n_shingles, str(r.component_id), r.copies) for r in labelled.collect()
    )
    return got, links


def near_copies(rng, n, words, edits, start):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append((start + i, " ".join(own)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = near_copies(rng, 60, 120, 6, 1000)  # chains of links, distances around the bound
    rows += near_copies(rng, 30, 400, 20, 100)
    for i in range(50):  # unrelated texts that share most of their words
        own = " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(4, 40)))
        rows.append((2000 + i, f"{passage}\n{own}"))
    rows += [(3000 + i, "Same  text\there is it") for i in range(20)]
    rows += [(4, None), (5, ""), (6, " \n "), (7, "one"), (8, "ONE"), (9, "Ä"), (10, "ä"), (11, "two w")]
    rows += [rows[0], rows[0], (None, rows[40][1]), (None, "nobody else has this text"), (3000, "other")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("leaf", "pivots"), [(4096, 16), (20, 2), (1, 1)])
def test_against_brute_force(spark, leaf, pivots):
    rows = corpus(leaf)
    got, links = joined(spark, rows, leaf=leaf, pivots=pivots)
    assert got == brute(rows, 85, 4)
    by_id = {}
    for doc_id, text in rows:
        by_id.setdefault(doc_id, shingles(text, 4))
    for a, b in links.collect():
        both = len(by_id[a] & by_id[b])
        assert a is None or b is None or 100 * both >= 85 * len(by_id[a] | by_id[b])


@pytest.mark.parametrize(("percent", "size"), [(60, 2), (100, 1)])
def test_other_bounds(spark, percent, size):
    rng = random.Random(percent)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(9)))) for i in range(80)]
    got, _ = joined(spark, rows, percent, size, leaf=3, pivots=2)
    assert got == brute(rows, percent, size)


def test_hot_shingles(spark, monkeypatch):
    """Rows of hot shingles pass through, spread by class."""
    monkeypatch.setattr(jaccard, "HOT_SHINGLE", -1e9)
    rows = corpus(9)
    assert joined(spark, rows)[0] == brute(rows, 85, 4)


def test_long_texts_and_empty_table(spark):
    long = " ".join(f"l{i}" for i in range(60_000))
    rows = [(2, long), (1, long + " more"), (3, None)]
    assert joined(spark, rows)[0] == brute(rows, 85, 4)
    assert joined(spark, [])[0] == []


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 150)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    df = spark.createDataFrame(edges, "a long, b long")
    group = {x: x for e in edges for x in e}
    for _ in range(200):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    got = dict(jaccard.components(df).collect())
    assert got == {x: g for x, g in group.items() if x in got}
    assert all(a in got and b in got for a, b in edges if a != b)


def almost_alike(n, part, own):
    """Texts with a common part, each pair of them equally far apart."""
    common = " ".join(f"c{i}" for i in range(part))
    return [(k, f"{common} " + " ".join(f"x{k}-{i}" for i in range(own))) for k in range(n)]


@pytest.mark.parametrize("n", [100, 200, 400])
def test_rows_grow_with_members_not_pairs(spark, monkeypatch, n):
    """Pairs just below the bound give no rows, whatever their number; pairs above it a forest."""
    made = {"marked": [], "links": []}
    keep = jaccard.stored

    def noted(df, name):
        out = keep(df, name)
        if name in made:
            made[name].append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", noted)
    for part, own, linked in ((113, 10, False), (145, 10, True)):
        # 4-shingles: part - 3 common ones, 10 own ones.
        similar = (part - 3) / (part - 3 + 2 * own)
        assert (similar >= 0.85) == linked and abs(similar - 0.85) < 0.04
        labelled, _ = jaccard.similarity_join(frame(spark, almost_alike(n, part, own)), pivots=2)
        groups = {r.component_id for r in labelled.collect()}
        assert len(groups) == (1 if linked else n)
    # Each block pair marks its members at most, and of links there are fewer still.
    assert sum(made["marked"]) <= 30 * n
    assert sum(made["links"]) < 2 * n


def test_chains_just_above_the_bound_are_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[3 * k : 3 * k + 100])) for k in range(80)]
    got, _ = joined(spark, rows)
    assert got == brute(rows, 85, 4)
