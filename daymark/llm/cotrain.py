"""Quality classification by co-training of a text view and a metadata view.

The text view sees how the text is written: shares of character classes, lengths and repetition
of words and lines, and hashed words. The metadata view sees source, language and length. Each
is a logistic regression, first fitted on labelled documents. Then, in every round, each view
labels those of all documents without a label that it is most sure of, in the proportion of the
labels and more of them from round to round, and the other view takes a Newton step on these and
the labelled ones. Pseudo-labels are given in the tasks that read the documents; what a task hands
on are sums, a gradient and a curvature for each view and histograms of how sure it is, whose size
depends on the features alone. Then each view is calibrated on labelled documents kept aside, a
logistic regression of both calibrated views gives the score (a view that would count against
itself is left out), and the bound below which documents are rejected is set so that few good ones
of those kept aside are lost. All documents are scored, in one scan.

The labelled sample is bounded: at most ``LABELLED`` documents, those with the smallest hashes of
their ids. Only their features reach the driver, some kilobytes each, one row for each id and label.
The documents without a label are all used, in one scan for each round and one before. What is
broadcast has a fixed size.

Edge cases: null and empty texts have no words and are scored by that, very long ones count whole;
null labels are ignored, and a document labelled both ways counts as both; a null source or
language is a value; without labels of both kinds everything has the share of good labels as its
score (0.5 without labels) and nothing is rejected; repeated rows get the same score, count as
often among the unlabelled ones, and once among the labelled ones, where of rows with one id the
one with the smallest features counts; ties in how sure a view is lie in the same bin of a
histogram and are taken or left together; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import broadcast_if_few, kept_rows, own_columns, small_batches, stored
from daymark.llm.textops import NOT_SPACE, text_slices, words

LABELLED = 6000
ROUNDS = 3
SURE = 0.95  # how sure a view must be of a pseudo-label
ROUND_SHARE = 0.1  # of the documents without a label, at most, that a view labels more in a round
SURE_BINS, MOST_LOGIT = 2000, 20.0  # bins of a view's logits
RIDGE = 20.0
CHUNK_ROWS = 64  # of a sum's matrix, that are added in one task
ASIDE = 0.3  # of the labelled documents, for calibration
LOST = 0.002  # of the good documents, how many may be rejected
HASHED_WORDS = 256
HASHED_META = 64

_BYTES = np.arange(256)
# Classes of bytes: each ASCII sign but letters and digits by itself, and five others.
_CLASS = np.where(_BYTES >= 0x80, 3, 0)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 1, 2, 4
_SIGNS = [b for b in range(0x20, 0x7F) if not chr(b).isalnum()] + [0x09, 0x0A]
_CLASS[_SIGNS] = np.arange(5, 5 + len(_SIGNS))
_CLASSES = 5 + len(_SIGNS)
_NOT_NEWLINE = _BYTES != 0x0A
DENSE = _CLASSES + 8
TEXT_FEATURES = DENSE + HASHED_WORDS
META_FEATURES = 2 * HASHED_META + 24


def _distinct(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The number of distinct hashes of each of n texts."""
    if not len(hashes):
        return np.zeros(n)
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    first = np.concatenate(([True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])))
    return np.bincount(t[first], minlength=n).astype(float)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of TEXT_FEATURES numbers for each text."""
    parts = [np.zeros((0, TEXT_FEATURES), np.float32)]
    for first, last, data, offsets in text_slices(column):
        n = last - first
        size = np.diff(offsets).astype(float)
        some = np.maximum(size, 1)
        text = np.repeat(np.arange(n), np.diff(offsets))
        shares = np.bincount(text * _CLASSES + _CLASS[data], minlength=n * _CLASSES)
        shares = shares.reshape(n, _CLASSES) / some[:, None]
        found = words(data, offsets, NOT_SPACE)
        of = found.texts()
        many = np.diff(found.first).astype(float)
        distinct = _distinct(found.hashes, of, n)
        rows = words(data, offsets, _NOT_NEWLINE)
        n_lines = np.diff(rows.first).astype(float)
        distinct_lines = _distinct(rows.hashes, rows.texts(), n)
        longest = np.zeros(n)
        np.maximum.at(longest, of, found.ends - found.starts)
        bag = np.bincount(
            of * HASHED_WORDS + (found.hashes % np.uint64(HASHED_WORDS)).astype(np.int64),
            minlength=n * HASHED_WORDS,
        ).reshape(n, HASHED_WORDS)
        dense = np.stack(
            [
                np.log1p(size),
                np.log1p(many),
                size / np.maximum(many, 1),
                np.log1p(longest),
                distinct / np.maximum(many, 1),
                np.log1p(n_lines),
                distinct_lines / np.maximum(n_lines, 1),
                many / np.maximum(n_lines, 1) / 100,
            ],
            axis=1,
        )
        parts.append(
            np.hstack([np.sqrt(shares), dense, np.sqrt(bag / np.maximum(many, 1)[:, None])]).astype(np.float32)
        )
    return np.concatenate(parts)


def meta_features(source: list, lang: list, n_chars: np.ndarray) -> np.ndarray:
    """A row of META_FEATURES numbers for each document."""
    out = np.zeros((len(source), META_FEATURES), np.float32)
    for at, (a, b) in enumerate(zip(source, lang)):
        out[at, zlib.crc32(f"s{a}".encode()) % HASHED_META] = 1
        out[at, HASHED_META + zlib.crc32(f"l{b}".encode()) % HASHED_META] = 1
    log = np.log2(np.maximum(n_chars, 0) + 1)
    out[np.arange(len(out)), 2 * HASHED_META + np.minimum(log.astype(int), 22)] = 1
    out[:, -1] = log / 20
    return out


class View(NamedTuple):
    """A logistic regression on standardised features, with Platt's calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    calibration: tuple[float, float] = (0.0, 1.0)

    def standard(self, x: np.ndarray) -> np.ndarray:
        """Standardised features behind a constant."""
        return np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.calibration[0] + self.calibration[1] * self.raw(x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Weights of a ridge logistic regression, the constant first."""
    x = np.hstack([np.ones((len(x), 1)), x])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(12):
        p = _sigmoid(x @ beta)
        step = np.linalg.solve(
            (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * beta
        )
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-5:
            break
    return beta


def fit_view(x: np.ndarray, y: np.ndarray, ridge: float) -> View:
    x = x.astype(np.float64)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1e6)
    return View(mean, scale, _newton((x - mean) / scale, y, ridge))


def sure_bins(raw: np.ndarray) -> np.ndarray:
    """The bin of each logit."""
    at = (raw + MOST_LOGIT) * (SURE_BINS / (2 * MOST_LOGIT))
    return np.clip(at, 0, SURE_BINS - 1).astype(int)


class Sums(NamedTuple):
    """What a round needs of the documents without a label; sums of these are of the same size."""

    gradient: tuple[np.ndarray, np.ndarray]  # by view, at its weights, of the other view's labels
    curvature: tuple[np.ndarray, np.ndarray]
    labelled: np.ndarray  # documents that each view learns from
    sure: np.ndarray  # by view and bin of its logits, documents

    @staticmethod
    def none(features: tuple[int, int] = (TEXT_FEATURES, META_FEATURES)) -> Sums:
        sizes = tuple(n + 1 for n in features)
        return Sums(
            tuple(np.zeros(n) for n in sizes),
            tuple(np.zeros((n, n)) for n in sizes),
            np.zeros(2),
            np.zeros((2, SURE_BINS)),
        )

    def add(self, views: tuple[View, View], features: tuple, limits: np.ndarray) -> None:
        """Add some documents. ``limits``, by view: the last bin that is bad, the first that is good."""
        bins = []
        for k, (view, x) in enumerate(zip(views, features)):
            bins.append(sure_bins(view.raw(x)))
            self.sure[k] += np.bincount(bins[k], minlength=SURE_BINS)
        for k, (view, x) in enumerate(zip(views, features)):
            teacher = bins[1 - k]
            good, bad = teacher >= limits[1 - k, 1], teacher <= limits[1 - k, 0]
            known = good | bad
            if not known.any():
                continue
            own = view.standard(x[known])
            y = good[known].astype(float)
            p = _sigmoid(own @ view.weights)
            self.gradient[k][:] += own.T @ (y - p)
            self.curvature[k][:] += (own * (p * (1 - p))[:, None]).T @ own
            self.labelled[k] += len(y)

    def flat(self) -> np.ndarray:
        """All numbers as rows of one length, for a sum by row."""
        both = np.concatenate(
            [x.ravel() for x in (*self.gradient, *self.curvature, self.labelled, self.sure)]
        )
        width = META_FEATURES + 1
        return np.append(both, np.zeros(-len(both) % width)).reshape(-1, width)

    @staticmethod
    def of(flat: np.ndarray) -> Sums:
        out, at, flat = Sums.none(), 0, flat.ravel()
        for part in (*out.gradient, *out.curvature, out.labelled, out.sure):
            part.ravel()[:] = flat[at : at + part.size]
            at += part.size
        return out


def sure_limits(
    sure: np.ndarray, share: float, rounds: int, views: tuple[View, View] | None = None
) -> np.ndarray:
    """By view: the last bin that it calls bad and the first that it calls good, -1 and SURE_BINS
    where there are none. A view is as sure as its calibrated logits say; the bins are of raw ones. Of
    the documents at most ``rounds`` times ROUND_SHARE are labelled."""
    out = np.zeros((2, 2), int)
    least = np.log(SURE / (1 - SURE))
    for k, counts in enumerate(sure):
        offset, slope = views[k].calibration if views else (0.0, 1.0)
        low, high = ((x - offset) / slope if slope > 0 else x * np.inf for x in (-least, least))
        room = min(ROUND_SHARE * rounds, 1.0) * counts.sum()
        good = np.cumsum(counts[::-1])[::-1]
        bad = np.cumsum(counts)
        fits = np.flatnonzero(good <= room * share + 1e-6)
        out[k, 1] = max(fits[0] if len(fits) else SURE_BINS, int(sure_bins(np.array(high))) + 1)
        fits = np.flatnonzero(bad <= room * (1 - share) + 1e-6)
        out[k, 0] = min(fits[-1] if len(fits) else -1, int(sure_bins(np.array(low))) - 1)
    return out


def stepped(view: View, x: np.ndarray, y: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, n: float) -> View:
    """The view after one Newton step on labelled documents and the sums of pseudo-labelled ones.

    Of the latter the weights are such that they count as much as the labelled ones at most.
    """
    own = view.standard(x)
    p = _sigmoid(own @ view.weights)
    weight = min(1.0, len(y) / n) if n else 0.0
    penalty = np.full(len(view.weights), RIDGE)
    penalty[0] = 1e-6
    slope = own.T @ (y - p) + weight * gradient - penalty * view.weights
    bend = (own * (p * (1 - p) + 1e-9)[:, None]).T @ own + weight * curvature + np.diag(penalty)
    return view._replace(weights=view.weights + np.clip(np.linalg.solve(bend, slope), -5, 5))


def cross_fitted(x: np.ndarray, y: np.ndarray) -> View:
    """A view whose calibration is that of views fitted on the other half of the documents.

    How sure a view is of what it has learnt says little; on few documents it is far too sure.
    """
    view, halves = fit_view(x, y, RIDGE), np.arange(len(y)) % 2 == 0
    if any(y[half].min(initial=1) == y[half].max(initial=0) for half in (halves, ~halves)):
        return view
    raw = np.empty(len(y))
    for half in (halves, ~halves):
        raw[half] = fit_view(x[~half], y[~half], RIDGE).raw(x[half])
    beta = _newton(raw[:, None], y, 0.1)
    return view._replace(calibration=(float(beta[0]), max(float(beta[1]), 0.0)))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, scan) -> tuple[View, View]:
    """Two views that have taught one another; ``scan`` sums over the documents without a label."""
    features = text, meta
    views = tuple(cross_fitted(x, y) for x in features)
    share = float(y.mean())
    nothing = np.array([[-1, SURE_BINS]] * 2)
    sums = scan(views, nothing)
    for k in range(1, ROUNDS + 1):
        limits = sure_limits(sums.sure, share, k, views)
        if not any(n[: low + 1].sum() + n[high:].sum() for n, (low, high) in zip(sums.sure, limits)):
            break
        sums = scan(views, limits)
        views = tuple(
            stepped(view, x, y, sums.gradient[i], sums.curvature[i], sums.labelled[i])
            for i, (view, x) in enumerate(zip(views, features))
        )
    return views


class Model(NamedTuple):
    text: View
    meta: View
    combined: np.ndarray  # constant, text, meta
    bound: float

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The score of each document, and those of its two views."""
        a, b = self.text.logits(text), self.meta.logits(meta)
        both = self.combined[0] + self.combined[1] * a + self.combined[2] * b
        return _sigmoid(both), _sigmoid(a), _sigmoid(b)


def _calibrated(view: View, x: np.ndarray, y: np.ndarray) -> View:
    beta = _newton(view.raw(x)[:, None], y, 1e-2)
    return view._replace(calibration=(float(beta[0]), float(beta[1])))


def combine(both: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Constant and weights of the views' logits; a view that would count negatively has none."""
    used = [0, 1]
    while True:
        beta = np.zeros(3)
        beta[[0, *(1 + k for k in used)]] = _newton(both[:, used], labels, 1.0)
        if not used or (beta[1:] >= 0).all():
            return beta
        used = [k for k in used if beta[1 + k] > 0]


def fit(text: np.ndarray, meta: np.ndarray, y: np.ndarray, scan) -> Model:
    """The model of labelled documents, in a random order; ``scan`` as for :func:`co_train`."""
    aside = max(1, int(ASIDE * len(y)))
    views = co_train(text[aside:], meta[aside:], y[aside:], scan)
    t, m, labels = text[:aside], meta[:aside], y[:aside]
    a, b = _calibrated(views[0], t, labels), _calibrated(views[1], m, labels)
    combined = combine(np.stack([a.logits(t), b.logits(m)], axis=1), labels)
    model = Model(a, b, combined, 0.0)
    good = np.sort(model.scores(t, m)[0][labels == 1])
    bound = good[int(LOST * len(good))] if len(good) else 0.0
    return model._replace(bound=float(min(bound, 0.5)))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    n_chars = np.nan_to_num(batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float))
    meta = meta_features(batch.column("source").to_pylist(), batch.column("lang").to_pylist(), n_chars)
    return text_features(batch.column("text")), meta


_INPUTS = ("text", "source", "lang", "n_chars")


def _sampled(docs: DataFrame, ids: DataFrame) -> dict[str, np.ndarray]:
    """Labels and features of the documents in ``ids``, (doc_id, y, h), by hash.

    An id with many rows gives a few from each task, and one in the end.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[tuple, tuple[bytes, bytes]] = {}
        for batch in batches:
            keys = zip(batch.column("h").to_pylist(), batch.column("y").to_pylist())
            for key, text, meta in zip(keys, *_features(batch)):
                own = text.tobytes(), meta.tobytes()
                least[key] = min(least.get(key, own), own)
        if least:
            h, y = zip(*least)
            text, meta = zip(*least.values())
            kinds = (pa.int64(), pa.float64(), pa.binary(), pa.binary())
            columns = [pa.array(x, t) for x, t in zip((h, y, text, meta), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["h", "y", "text", "meta"])

    rows = own_columns(docs, "doc_id", *_INPUTS).join(F.broadcast(ids), "doc_id")  # bounded
    found = rows.drop("doc_id").mapInArrow(cut, "h long, y double, text binary, meta binary")
    got = found.groupBy("h", "y").agg(F.min(F.struct("text", "meta")).alias("x")).select("h", "y", "x.*").toArrow()
    order = np.lexsort((got["y"].to_numpy(), got["h"].to_numpy()))
    out = {"y": got["y"].to_numpy()[order]}
    for name, width in (("text", TEXT_FEATURES), ("meta", META_FEATURES)):
        rows = [np.frombuffer(x.as_py(), np.float32) for x in got[name]]
        out[name] = np.array(rows, np.float32).reshape(len(rows), width)[order]
    return out


def scanned(docs: DataFrame, views: tuple[View, View], limits: np.ndarray) -> Sums:
    """The sums over all of ``docs``: one matrix from each task, added by chunks of its rows."""
    shared = docs.sparkSession.sparkContext.broadcast((views, limits))
    width = META_FEATURES + 1

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views, limits = shared.value
        sums = Sums.none()
        for batch in batches:
            text, meta = _features(batch)
            for a in range(0, len(text), 500):
                sums.add(views, (text[a : a + 500], meta[a : a + 500]), limits)
        flat = sums.flat()
        if sums.sure.any():
            parts = [flat[a : a + CHUNK_ROWS].tobytes() for a in range(0, len(flat), CHUNK_ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["chunk", "sums"]
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table["sums"])
        return pa.table({"chunk": table["chunk"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    made = own_columns(docs, *_INPUTS).mapInArrow(count, "chunk int, sums binary")
    flat = Sums.none().flat()
    # A fixed number of rows of fixed length.
    for row in made.groupBy("chunk").applyInArrow(add, "chunk int, sums binary").collect():
        part = np.frombuffer(row.sums).reshape(-1, width)
        flat[row.chunk * CHUNK_ROWS :][: len(part)] = part
    return Sums.of(flat)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model | float:
    """The model of (doc_id, text, source, lang, n_chars) and (doc_id, ``label``).

    Without documents of both labels, the share of good ones.
    """
    small_batches(docs.sparkSession)
    known = labels.select("doc_id", F.col(label).cast("double").alias("y")).where(
        "doc_id IS NOT NULL AND y IS NOT NULL"
    )
    known = stored(known.distinct(), "labels")
    present = docs.select("doc_id").distinct()
    labelled = known.join(present, "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id"))
    own = _sampled(docs, stored(labelled.orderBy("h", "y").limit(LABELLED), "labelled"))
    y = own["y"]
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.5
    ids = broadcast_if_few(known.select("doc_id").distinct())
    free = own_columns(docs, "doc_id", *_INPUTS).join(ids, "doc_id", "left_anti")
    return fit(own["text"], own["meta"], y, lambda views, limits: scanned(free, views, limits))


def _judge(model: Model | float, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Score, both views' scores, and whether the document is rejected."""
    if not isinstance(model, Model):
        same = np.full(len(batch), model)
        return same, same, same, np.zeros(len(batch), bool)
    score, text, meta = model.scores(*_features(batch))
    return score, text, meta, score < model.bound


SCORE_SCHEMA = "quality_score double, text_score double, meta_score double, rejected boolean"


def score(docs: DataFrame, model: Model | float) -> DataFrame:
    """(doc_id) and SCORE_SCHEMA of every document."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [part.split()[0] for part in SCORE_SCHEMA.split(", ")]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _judge(shared.value, batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x) for x in found)], ["doc_id", *names]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return own_columns(docs, "doc_id", *_INPUTS).mapInArrow(work, f"doc_id {kind}, {SCORE_SCHEMA}")


def accepted(docs: DataFrame, model: Model | float) -> DataFrame:
    """The rows of ``docs`` that are not rejected, as they are."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~_judge(shared.value, batch)[-1]))

    return kept_rows(docs, keep, docs.schema)
