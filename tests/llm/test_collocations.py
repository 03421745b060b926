"""Indexes against plain counts, and mined phrases against a slow version."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daymark.llm import collocations

SCHEMA = "doc_id long, lang string, text string"


def cut(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", x) for x in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def counted(pieces, longest=4):
    found = Counter()
    for words in pieces:
        for k in range(1, longest + 1):
            found.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return found


def shards_of(rows, shard_words):
    batch = pa.RecordBatch.from_pylist(
        [{"lang": lang, "text": text} for lang, text in rows],
        pa.schema([("lang", pa.string()), ("text", pa.string())]),
    )
    return list(collocations._sequences([batch], shard_words))


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.text(alphabet="abcA .;\t\né", max_size=60), min_size=1, max_size=6),
    st.sampled_from([3, 10, 1000]),
)
def test_extension_of_intervals_counts_all_phrases(texts, shard_words):
    expected, found = Counter(), Counter()
    for text in texts:
        expected.update(counted(cut(text)))
    for _, hashes, begins, distinct, names in shards_of([("x", t) for t in texts], shard_words):
        assert distinct.tolist() == np.unique(hashes).tolist()
        ids = np.searchsorted(distinct, hashes)
        places = np.arange(len(ids)) + np.cumsum(begins) - 1
        symbols = np.zeros(int(places[-1]) + 2, np.int32)
        symbols[places] = ids + 1
        mirrored = np.append(symbols[-2::-1], np.int32(0))
        index = collocations.Index(
            collocations.transform(symbols, 4), collocations.transform(mirrored, 4), len(distinct) + 1
        )
        word = ["", *names]
        every = lambda phrases: np.ones(len(phrases), bool)
        for phrases in collocations.levels(index, 4, every):
            for row, n in zip(phrases.words.tolist(), phrases.n.tolist()):
                found[tuple(word[x] for x in row)] += n
    assert found == expected


def test_long_texts_fill_several_shards_between_pieces():
    text = " ".join(f"w{i % 50}{'.' if i % 7 == 6 else ''}" for i in range(1000))
    shards = shards_of([("x", text), ("y", "a b"), ("x", text)], 100)
    assert max(len(s[1]) for s in shards) <= 100
    assert sum(len(s[1]) for s in shards if s[0] == "x") == 2000
    assert all(s[2][0] for s in shards)
    one_piece = " ".join(f"w{i}" for i in range(300))
    assert [len(s[1]) for s in shards_of([("x", one_piece + ". z")], 100)] == [300, 1]


def slow(rows, top=2000, longest=4, least=30):
    by_lang = {}
    for _, lang, text in rows:
        by_lang.setdefault(lang or "und", []).extend(cut(text))
    for lang, pieces in by_lang.items():
        f = {g: n for g, n in counted(pieces, longest).items() if n >= least}
        n = sum(len(p) for p in pieces)
        out = []
        for g, a in f.items():
            if len(g) == 1:
                continue
            score, _, l, r = min(
                (2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))
            )
            longer = [
                c
                for h, c in f.items()
                if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
            ]
            if not any(100 * c >= 80 * a for c in longer):
                out.append((-score, -a, " ".join(g).encode(), a, l, r, n, score))
        for rank, row in enumerate(sorted(out)[:top], 1):
            yield (lang, rank, row[2].decode(), *row[3:])


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "日本", "x\x00y", "A-b"]
    phrases = ["new york city", "Of The", "a b c d", "in the middle of"]
    rows = []
    for k in range(150):
        words = []
        for _ in range(rng.randrange(80)):
            words.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocabulary))
            words.append(rng.choice([" ", "  ", "\t", ". ", ", ", "\n", " "]))
        rows.append((k, rng.choice(["en", "en", "de", None]), "".join(words)))
    return rows + [(None, None, None), (1, "fr", ""), (1, "en", "..."), (7, "und", "only here"), rows[5], rows[5]]


@pytest.mark.parametrize("least, top, shard_words", [(30, 2000, 10**6), (5, 20, 500)])
def test_mined_phrases_against_slow_version(spark, least, top, shard_words):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    clash = docs.withColumns({x: F.lit("?") for x in ("gram", "f", "n_words", "words", "rank", "bwt")})
    found = collocations.mine(clash, top, 4, least, shard_words)
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    expected = sorted(slow(rows, top, 4, least))
    assert expected and sorted(tuple(r) for r in found.select(*columns).collect()) == expected


def test_small_sketch_only_adds_work(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    index = collocations.stored(collocations.build_index(docs, 4, 300), "index")
    expected = sorted(map(tuple, collocations.count_phrases(index, 4, 10).collect()))
    monkeypatch.setattr(collocations, "LEAST_BITS", 3)
    monkeypatch.setattr(collocations, "MOST_BITS", 3)
    assert sorted(map(tuple, collocations.count_phrases(index, 4, 10).collect())) == expected


def test_empty_table(spark):
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).collect() == []


def test_products_beyond_64_bits(spark):
    big = 4 * 10**18
    rows = [("x", b"a" * 8, big), ("x", b"b" * 8, big), ("x", b"a" * 8 + b"b" * 8, big - 1)]
    grams = spark.createDataFrame([(k, bytearray(g), f) for k, g, f in rows], collocations.GRAM_SCHEMA)
    found = collocations.cut_scores(grams, grams.where("octet_length(gram) = 16")).collect()
    assert [(r.score, r.cut, r.l, r.r) for r in found] == [(2_000_000 * (big - 1) // (2 * big), 1, big, big)]
