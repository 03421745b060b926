import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from daymark.llm import langid

WORDS = {"xx": "ba na ka ma ta".split(), "yy": "oir eul öß ünd".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(WORDS[lang], k=rng.randrange(1, 4))) for _ in range(n))


def rows(n, seed=5):
    rng = random.Random(seed)
    return [(i, text(rng, "xy"[i % 2] * 2, rng.randrange(1, 30)), "xy"[i % 2] * 2) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "clash", 1.0) for r in rows],
        "doc_id long, text string, lang string, lang_pred string, score double",
    )


def normalised(value):
    words = "".join(c if c.isalpha() else " " for c in (value or "").lower()).split()
    return " " * 3 + "".join(w + " " for w in words)


def brute(training):
    """Character models by language: a function of text and language, bits per character."""
    grams = defaultdict(lambda: {k: Counter() for k in range(1, 5)})
    for value, lang in training:
        s = normalised(value)
        grams[lang][4].update(s[i : i + 4] for i in range(len(s) - 3))
    for levels in grams.values():
        for k in (3, 2, 1):
            levels[k].update(g[1:] for g in levels[k + 1])
    size = len({c for levels in grams.values() for c in levels[1]}) + 1

    def p(lang, gram):
        k = len(gram)
        if not k:
            return 1 / size
        level = grams[lang][k]
        own = {g: n for g, n in level.items() if g[:-1] == gram[:-1]}
        lower = p(lang, gram[1:])
        if not own:
            return lower
        once = sum(n == 1 for n in level.values())
        twice = sum(n == 2 for n in level.values())
        d = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.5
        total = sum(own.values())
        return max(own.get(gram, 0) - d, 0) / total + d * len(own) / total * lower

    def entropy(value, lang):
        s = normalised(value)
        return -sum(math.log2(p(lang, s[i : i + 4])) for i in range(len(s) - 3)) / (len(s) - 3)

    return entropy


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_cross_entropies_against_brute_force(spark):
    data = rows(60)
    model = langid.train(frame(spark, data))
    entropy = brute([(t, lang) for i, t, lang in data if fold(i) in (0, 1)])
    asked = [data[0][1], data[1][1], "ba oir Zz! na漢", "q", "B"]
    got, n = model.cross_entropies([*asked, "", None, "12 .."])
    assert n.tolist() == [len(normalised(a)) - 3 for a in asked] + [0, 0, 0]
    for row, value in zip(got, asked):
        for column, lang in enumerate(model.langs):
            assert row[column] == pytest.approx(entropy(value, lang), abs=1e-4)


def test_few_runs_kept(spark):
    """Shorter runs stand in for those that the bound leaves out."""
    data = rows(60)
    model = langid.train(frame(spark, data), most=20)
    assert all(len(grams.rows) <= 20 for grams, _ in model.levels)
    got = langid.predictions(model, [t for _, t, _ in data])["lang_pred"]
    assert np.mean([g == lang for g, (_, _, lang) in zip(got, data)]) > 0.9


def test_all_runs_count_beyond_the_bound(spark):
    """A model in slices gives the figures of the whole one, for rare runs too."""
    data = rows(300) + [(900, None, "xx"), (901, "", None), (None, "oir 漢字 𝒳𝒴", "yy"), (5, "ba", "xx"), (5, "ba", "xx")]
    data += [(1000 + i, "漢字仮名 " + text(random.Random(i), "xx", 5), "zz") for i in range(12)]
    docs = frame(spark, data)
    whole, sliced = langid.train(docs), langid.train(docs, at_once=20)
    assert isinstance(whole, langid.Model) and sliced.slices > 10
    assert max(len(sliced.slice(i).levels[3][0].rows) for i in range(sliced.slices)) < len(whole.levels[3][0].rows)

    def table(model):
        return sorted((tuple(r) for r in langid.predict(docs, model).collect()), key=str)

    got, expected = table(sliced), table(whole)
    assert len(got) == len(data)
    for a, b in zip(got, expected):
        assert a == tuple(pytest.approx(x, abs=1e-3) if isinstance(x, float) else x for x in b)
    kept = langid.accepted(docs, sliced)
    assert kept.schema == docs.schema
    assert sorted(kept.collect(), key=str) == sorted(langid.accepted(docs, whole).collect(), key=str)


def test_predictions(spark):
    data = rows(400)
    data += [(900, None, "xx"), (901, "", None), (902, "12 !!", "yy"), (903, "ba na", None)]
    data += [(904, "ba " * 50_000, "xx"), (None, "oir", "yy")] + [data[3]] * 3
    docs = frame(spark, data)
    model = langid.train(docs)
    got = langid.predict(docs, model).collect()
    assert len(got) == len(data)
    by_id = {r.doc_id: r for r in got}
    for i, value, lang in data:
        r = by_id[i]
        assert 0 <= r.score <= 1
        assert r.held_out == (i is not None and fold(i) == 2)
        if not normalised(value).strip():
            assert (r.lang_pred, r.rejected) == ("und", True)
        elif lang:
            assert r.lang_pred == lang
    assert by_id[903].lang_pred == "xx"
    held = [r for r in got if r.held_out]
    assert held and not any(r.rejected for r in held if r.lang_pred != "und")
    kept = langid.accepted(docs, model)
    assert kept.schema == docs.schema
    rejected = sum(r.rejected for r in got)
    assert kept.count() == len(data) - rejected


def test_gibberish_is_rejected(spark):
    model = langid.train(frame(spark, rows(400)))
    got = langid.predictions(model, ["zqx vwp " * 40, text(random.Random(1), "yy", 40)])
    assert got["rejected"].tolist() == [True, False]


def test_the_held_out_fold_is_not_learned_from(spark):
    data = rows(200)
    changed = [(i, "zzz" if fold(i) == 2 else t, lang) for i, t, lang in data]
    asked = [t for _, t, _ in data[:20]]
    a, b = (langid.train(frame(spark, d)).cross_entropies(asked)[0] for d in (data, changed))
    assert (a == b).all()


def test_nothing_to_learn(spark):
    docs = frame(spark, [(1, "a", None), (2, None, "xx")])
    assert langid.train(docs) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.accepted(docs, None).count() == 0
    assert langid.predict(docs.limit(0), None).count() == 0
