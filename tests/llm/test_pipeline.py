"""Each stage against brute force or its operator, on its own input."""

import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daymark.llm import cotrain, jaccard, langid, mixing
from daymark.llm.common import stored, table

SF_DIR = os.environ.get("DAYMARK_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF_DIR, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(stored(stage(spark, docs[-1], SF_DIR), name))
    return docs


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.schema == steps[0].schema
    assert steps[-1].columns == [*steps[0].columns, "copy"]


def test_language(steps):
    before, after = steps[0], texts(steps[1])
    rejected = {r.doc_id for r in langid.predict(before, langid.train(before)).where("rejected").collect()}
    assert set(after) == set(texts(before)) - rejected
    assert len(after) >= 0.98 * before.count()


def test_quality(spark, steps):
    before, after = steps[1], texts(steps[2])
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    model = cotrain.train(before, table(spark, SF_DIR, "labels"))
    rejected = {r.doc_id for r in cotrain.score(before, model).where("rejected").collect()}
    assert set(after) == set(texts(before)) - rejected
    good = [i for i in texts(before) if labels.get(i) == 1]
    assert sum(i in after for i in good) >= 0.97 * len(good)
    assert sum(i in after for i, q in labels.items() if q == 0) <= 0.1 * len(labels)


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} - {()}


def test_deduplicated(steps):
    before, after = texts(steps[2]), texts(steps[3])
    ids = sorted(before)
    sets = {i: shingles(before[i]) for i in ids}
    group = {i: i for i in ids}
    for at, a in enumerate(ids):
        for b in ids[:at]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    assert set(after) == set(group.values())


def test_near_copies_of_five_words(spark):
    """Copies with up to five changed words, of which many are too far apart at four words and 85 %."""
    rng = random.Random(5)
    rows = []
    for start in range(0, 400, 10):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(40, 240))]
        for i in range(4):
            own = list(base)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            rows.append((start + i, " ".join(own), "en", "s", 9))
    sets = {r[0]: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for r in rows for w in [r[1].split()]}

    def kept(shared):
        group = {i: i for i in sets}
        for a in sets:
            for b in range(a - a % 10, a):
                if shared(a, b):
                    low, high = sorted((group[a], group[b]))
                    group = {i: low if g == high else g for i, g in group.items()}
        return set(group.values())

    near = kept(lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    four = {r[0]: shingles(r[1]) for r in rows}
    assert near != kept(lambda a, b: 100 * len(four[a] & four[b]) >= 85 * len(four[a] | four[b]))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert set(texts(corpus_pipeline.deduplicated(spark, df, SF_DIR))) == near


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e", "en", "s", 9)] * 2 + [(2, "A b c d e", "en", "s", 9), (None, "a b c d e", "en", "s", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(str(r.doc_id) for r in jaccard.one_of_each_group(df).collect()) == ["1", "None"]


def test_decontaminated(spark, steps):
    def cut(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return WORD.findall(lowered)

    windows = {}
    for r in table(spark, SF_DIR, "benchmark").collect():
        own = cut(r.text)
        k = min(13, len(own))
        for i in range(len(own) - k + 1 if k else 0):
            windows.setdefault(k, set()).add(tuple(own[i : i + k]))
    clean = set()
    for doc_id, text in texts(steps[3]).items():
        own, hit = cut(text), set()
        for k, found in windows.items():
            for i in range(len(own) - k + 1):
                if tuple(own[i : i + k]) in found:
                    hit |= set(range(i, i + k))
        if not hit or 20 * len(hit) < len(own):
            clean.add(doc_id)
    assert set(texts(steps[4])) == clean


def test_mixed(steps):
    got = Counter(r.doc_id for r in steps[5].collect())
    plan = mixing.mix(steps[4]).collect()
    assert {r.doc_id: r.taken // r.size for r in plan if r.taken} == dict(got)


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(str, got.collect())) == sorted(map(str, steps[5].collect()))


def test_no_documents(spark):
    docs = table(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "empty")
    assert docs.count() == 0


CLASHES = (
    "copy", "copy_", "_row", "_sums", "_letters", "_mix_source", "_mix_whole", "_mix_threshold", "_mix_times",
    "n", "h", "y", "cls", "root", "rid", "rep", "size", "hash", "target", "whole", "threshold", "rejected",
    "contaminated", "a.b", "component_id", "n_hit", "own", "range_no", "score",
)


def test_columns_with_clashing_names(spark):
    """Columns that have the names stages use inside stay as they are, and change no decision."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    wide = docs
    for k, name in enumerate(CLASHES):
        wide = wide.withColumn(name, F.lit(k))
    for name, stage in corpus_pipeline.STAGES:
        plain, clashing = (stored(stage(spark, x, "/root/testdata/sf0.001"), name) for x in (docs, wide))
        added = clashing.columns[len(wide.columns) :]
        assert clashing.columns[: len(wide.columns)] == wide.columns
        assert added == (["copy__"] if name == "mixed" else [])
        quoted = ["`" + c.replace("`", "``") + "`" for c in CLASHES]
        assert [tuple(r) for r in clashing.select(*quoted).distinct().collect()] == [tuple(range(len(CLASHES)))]
        kept = [Counter(r[0] for r in x.select("doc_id").collect()) for x in (plain, clashing)]
        assert kept[0] == kept[1]


def test_sliced_language_models_with_clashing_names(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").withColumns(
        {"_row": F.lit("x"), "_sums": F.lit(1), "_letters": F.lit(2.5)}
    )
    whole, sliced = langid.train(docs), langid.train(docs, at_once=3000)
    assert isinstance(sliced, langid.Sliced)
    got = [langid.accepted(docs, model) for model in (whole, sliced)]
    assert got[0].schema == got[1].schema == docs.schema
    assert [sorted(map(str, x.collect())) for x in got][0] == sorted(map(str, got[1].collect()))
