import random
from collections import Counter

from daymark.llm import rollup

SCHEMA = "doc_id long, tokenizer string, source string, lang string, tokens long, seq long, docs int"


def run(spark, base, batches):
    for number, rows in batches:
        rollup.commit(spark, base, number, spark.createDataFrame(rows, SCHEMA))
    return {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals(spark, base).collect()}


def test_batches_against_a_dictionary(spark, tmp_path):
    rng = random.Random(3)
    state, batches = {}, []
    for number in (1, 2, 5):
        rows = []
        for seq in range(60):
            key = (rng.choice([None, *range(20)]), rng.choice(["v1", "v2"]))
            value = (rng.choice(["a", "b", None]), rng.choice(["en", None]))
            tokens = rng.choice([None, 0, 5, 7])
            rows.append((*key, *value, tokens, seq, 9))
            if tokens is None:
                state.pop(key, None)
            else:
                state[key] = (*value, tokens)
        batches.append((number, rows))
    docs, tokens = Counter(), Counter()
    for (_, version), (source, lang, n) in state.items():
        docs[source, lang, version] += 1
        tokens[source, lang, version] += n
    base = f"{tmp_path}/r"
    # The second batch comes again after the third.
    got = run(spark, base, [*batches, batches[1]])
    assert got == {k: (docs[k], tokens[k]) for k in docs}


def test_a_broken_batch_is_written_anew(spark, tmp_path):
    base = f"{tmp_path}/r"
    half = spark.createDataFrame([("a", "en", "v1", 7, 70)], rollup.DELTA_SCHEMA)
    half.write.parquet(f"{base}/deltas/batch=1")  # but no commit
    assert rollup.totals(spark, base).count() == 0
    assert run(spark, base, [(1, [(1, "v1", "a", "en", 3, 0, 0)])]) == {("a", "en", "v1"): (1, 3)}


def test_ties_empty_batches_and_no_rollup(spark, tmp_path):
    base = f"{tmp_path}/r"
    assert rollup.totals(spark, base).collect() == []
    same = [(1, "v1", "a", "en", 3, 0, 0), (1, "v1", "a", "en", 5, 0, 0)] * 2
    assert run(spark, base, [(1, same)]) == {("a", "en", "v1"): (1, 5)}
    rows = spark.createDataFrame([], SCHEMA)
    assert rollup.commit(spark, base, 2, rows)
    assert not rollup.commit(spark, base, 2, rows)
    assert run(spark, base, [(3, [(8, "v1", "a", "en", None, 0, 0)])]) == {("a", "en", "v1"): (1, 5)}
