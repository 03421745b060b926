import random

import numpy as np
import pyarrow as pa
import pytest

from daymark.llm import cotrain


def text(rng, good, n):
    words = "the and of tion ly er an house tree".split()
    own = rng.choices(words, k=n)
    if good:
        return ". ".join(" ".join(own[i : i + 8]) for i in range(0, n, 8))
    return rng.choice([" ".join(w.upper() + "!!" for w in own), "### ".join(own), "\n".join([own[0]] * n)])


def table(n, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        value = text(rng, good, rng.randrange(12, 80))
        docs.append((i, value, rng.choice(["en", None]), rng.choice(["a", "b"]), len(value), 0.5))
        if rng.random() < 0.4:
            labels.append((i, int(good), 0))
    return docs, labels, {}


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, y double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def truth(value):
    return not (value.isupper() or "#" in value or "!" in value or len(set(value.split("\n"))) < value.count("\n"))


def test_held_out_accuracy(spark):
    docs, labels, _ = table(600)
    df, known = frames(spark, docs, labels)
    model = cotrain.train(df, known)
    got = {r.doc_id: r for r in cotrain.score(df, model).collect()}
    labelled = {i for i, *_ in labels}
    rest = [d for d in docs if d[0] not in labelled]
    assert np.mean([(got[d[0]].quality_score > 0.5) == truth(d[1]) for d in rest]) > 0.97
    assert not any(got[d[0]].rejected for d in rest if truth(d[1]) and got[d[0]].quality_score > 0.5)
    kept = cotrain.accepted(df, model)
    assert kept.schema == df.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}
    assert cotrain.score(df, cotrain.train(df, known)).orderBy("doc_id").collect() == sorted(got.values())


def test_odd_rows(spark):
    docs, labels, _ = table(300)
    docs += [(None, None, None, None, None, 0.0), (900, "", "en", "a", 0, 0.0), (901, None, "en", None, None, 0.0)]
    docs += [(902, "the tree. " * 50_000, "en", "a", 500_000, 0.0)] + [docs[0]] * 3
    labels += [(900, None, None), (None, 1, 0), (5, 1, 0), (5, 0, 0), (77_777, 0, 0)]
    df, known = frames(spark, docs, labels)
    got = cotrain.score(df, cotrain.train(df, known)).collect()
    assert len(got) == len(docs)
    assert all(0 <= r.quality_score <= 1 for r in got)
    assert len({r.quality_score for r in got if r.doc_id == docs[0][0]}) == 1


@pytest.mark.parametrize(("labels", "expected"), [([], 0.5), ([(0, 1, 0), (1, 1, 0)], 1.0), ([(0, 0, 0)], 0.0)])
def test_labels_of_one_kind(spark, labels, expected):
    docs, _, _ = table(5)
    df, known = frames(spark, docs, labels)
    model = cotrain.train(df, known)
    assert {(r.quality_score, r.rejected) for r in cotrain.score(df, model).collect()} == {(expected, False)}
    assert cotrain.accepted(df, model).count() == 5


def test_empty_table(spark):
    docs, labels, _ = table(5)
    df, known = frames(spark, docs, labels)
    assert cotrain.score(df.limit(0), cotrain.train(df.limit(0), known)).count() == 0


def test_views_teach_each_other():
    """A view that has seen few labels learns from the other one's sure guesses."""
    rng = np.random.default_rng(1)
    y = (rng.random(2000) < 0.5).astype(float)
    left = y[:, None] + rng.normal(0, 0.1, (2000, 30))
    right = np.hstack([y[:, None] + rng.normal(0, 0.4, (2000, 1)), rng.normal(0, 1, (2000, 30))])
    few, pool, test = slice(0, 60), slice(60, 1500), slice(1500, 2000)

    def scan(views, limits):
        sums = cotrain.Sums.none((30, 31))
        sums.add(views, (left[pool], right[pool]), limits)
        return sums

    _, taught = cotrain.co_train(left[few], right[few], y[few], scan)
    alone = cotrain.fit_view(right[few], y[few], 20.0)
    accuracy = [np.mean((v.raw(right[test]) > 0) == y[test]) for v in (alone, taught)]
    assert accuracy[1] > accuracy[0]


def test_text_features_do_not_depend_on_the_batch():
    values = ["a b a", None, "", "É!\nÉ!\n", "x" * 100]
    together = cotrain.text_features(pa.array(values))
    for row, value in zip(together, values):
        assert (cotrain.text_features(pa.array([value], pa.string()))[0] == row).all()


def test_sums_over_all_documents_without_a_label(spark):
    """Every document counts, in whatever task it is, and the driver gets one matrix."""
    docs, labels, _ = table(400)
    df, known = frames(spark, docs, labels)
    labelled = {i for i, *_ in labels}
    free = [d for d in docs if d[0] not in labelled]
    made = {}

    def noted(rows, views, limits):
        made["rows"] = rows.count()
        return cotrain.Sums.none()

    keep, cotrain.scanned = cotrain.scanned, noted
    try:
        cotrain.train(df, known)
    finally:
        cotrain.scanned = keep
    assert made["rows"] == len(free)

    batch = pa.RecordBatch.from_pydict(
        {name: [d[k] for d in free] for name, k in (("text", 1), ("lang", 2), ("source", 3), ("n_chars", 4))}
    )
    features = cotrain._features(batch)
    y = np.array([float(truth(d[1])) for d in free])
    views = tuple(cotrain.fit_view(x[:60], y[:60], cotrain.RIDGE) for x in features)
    limits = np.array([[900, 1100], [950, 1050]])
    expected = cotrain.Sums.none()
    expected.add(views, features, limits)
    only = spark.createDataFrame(free, df.schema).repartition(7)
    got = cotrain.scanned(only, views, limits)
    assert got.sure.sum() == 2 * len(free) and got.labelled.tolist() == expected.labelled.tolist()
    for a, b in zip((*got.gradient, *got.curvature), (*expected.gradient, *expected.curvature)):
        assert np.allclose(a, b)
    # By single documents: the other view's sure ones, and their residuals.
    p = [1 / (1 + np.exp(-v.raw(x))) for v, x in zip(views, features)]
    bins = [cotrain.sure_bins(v.raw(x)) for v, x in zip(views, features)]
    slow = np.zeros(cotrain.META_FEATURES + 1)
    for i in range(len(free)):
        if bins[0][i] <= 900 or bins[0][i] >= 1100:
            slow += views[1].standard(features[1][i : i + 1])[0] * (float(bins[0][i] >= 1100) - p[1][i])
    assert np.allclose(slow, got.gradient[1])


def test_limits_follow_the_shares():
    sure = np.zeros((2, cotrain.SURE_BINS))
    sure[0, :50], sure[0, -50:], sure[0, 1000] = 1, 1, 900
    sure[1, 1000] = 1000
    low, high = cotrain.sure_bins(np.log([0.05 / 0.95, 0.95 / 0.05]))
    least = [low - 1, high + 1]  # as sure as a view must be at least
    assert cotrain.sure_limits(sure, 0.5, 1).tolist() == [least, least]
    assert cotrain.sure_limits(sure, 0.2, 1)[0].tolist() == [least[0], 1980]  # 20 good ones at most
    assert cotrain.sure_limits(sure, 0.8, 1)[0].tolist() == [19, least[1]]  # 20 bad ones at most


def test_weights_are_those_of_plain_gradient_steps():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6))
    y = (x @ np.array([1, -2, 0.5, 0, 0, 1]) + rng.normal(size=300) > 0.3).astype(float)
    view = cotrain.fit_view(x, y, 5.0)
    own = view.standard(x)
    beta = np.zeros(7)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-own @ beta))
        beta += 0.005 * (own.T @ (y - p) - np.array([1e-6, *[5.0] * 6]) * beta)
    assert np.allclose(beta, view.weights, atol=1e-3)
    # A Newton step from there with nothing new, and one on the same documents again, stay.
    none = np.zeros(7), np.zeros((7, 7)), 0.0
    view = view._replace(weights=cotrain._newton(own[:, 1:], y, cotrain.RIDGE))
    assert np.allclose(cotrain.stepped(view, x, y, *none).weights, view.weights, atol=1e-4)


def test_a_view_never_counts_against_itself():
    rng = np.random.default_rng(4)
    y = (rng.random(400) < 0.5).astype(float)
    good = 4 * (y - 0.5) + rng.normal(size=400)
    beta = cotrain.combine(np.stack([good, 0.7 * good - 2 * (y - 0.5)], axis=1), y)
    assert beta[1] > 0 and beta[2] >= 0
    assert cotrain.combine(np.stack([-good, -good], axis=1), y)[1:].tolist() == [0, 0]


def test_one_labelled_id_with_most_rows(spark):
    docs, labels, _ = table(200)
    hot = labels[0][0]
    docs += [(hot, f"the tree {k % 50}. of the house", "en", "a", 9, 0.0) for k in range(3000)]
    df, known = frames(spark, docs, labels)
    ids = known.select("doc_id").distinct().selectExpr("doc_id", "1D AS y", "xxhash64(doc_id) AS h")
    got = cotrain._sampled(df.repartition(8), ids)
    assert len(got["y"]) == len({i for i, *_ in labels})
    again = cotrain._sampled(df.repartition(3), ids)
    assert all((got[k] == again[k]).all() for k in got)


def test_views_are_as_sure_as_they_are_right():
    """Fitted on noise a view is sure of what it has seen, and says so of nothing."""
    rng = np.random.default_rng(7)
    x, y = rng.normal(size=(120, 60)), (rng.random(120) < 0.5).astype(float)
    view = cotrain.cross_fitted(x, y)
    assert np.abs(view.raw(x)).max() > 1 and np.abs(view.logits(x)).max() < 1
    assert cotrain.cross_fitted(x[:3], np.array([1.0, 0, 1])).calibration == (0.0, 1.0)
