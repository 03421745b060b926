"""Language identification with interpolated Kneser-Ney character models.

A text is lower-cased, everything but letters becomes one space, and it is padded at its start.
Runs of ``ORDER`` characters are counted for every language, in each task first and then over all
of the corpus. Each language gets an interpolated Kneser-Ney model: counts of the longest runs,
numbers of distinct preceding characters for the shorter ones, one discount for each length, and
the uniform distribution over the characters at the bottom.

The models are sorted arrays of 64-bit hashes of runs with one column of log probabilities per
language, and sorted arrays of contexts with back-off weights. Scoring looks every position's run
up, and shorter ones only where no language has it. The language with the lowest cross entropy
per character is taken. One fold of the training documents is kept from counting: on
it the score (how likely the answer is right) and the rejection bound are calibrated.

All counts cover the whole corpus, and scoring uses all of them. With more than ``MAX_GRAMS``
distinct runs of a length the model is cut into slices by the two middle characters of a run: all
that a place of a text looks up lies in one of them (runs of one or two characters are in all). The
slices are built and broadcast one after another, each adds up the places that are its own, and
the sums are put together by row.

Edge cases: null and empty texts and texts without letters are ``und`` with score 0, rejected;
ties go to the first language in code point order; rows without a language are not learned
from; repeated rows count as often as they come; if nothing can be learned, all is ``und``; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import (
    all_columns,
    free_name,
    kept_rows,
    own_columns,
    small_batches,
    stored,
)
from daymark.llm.textops import give_back, mix

ORDER = 4
FOLDS = 4
HELD_OUT = 2  # the fold that is never learned from
CALIBRATION = 3  # the training fold that is kept from counting
MAX_GRAMS = 400_000
UNKNOWN = "und"
FALSE_REJECTIONS = 0.0005
REJECTION_SLACK = 1.25
SLICE_CHARS = 250_000
HELD_GRAMS = 250_000  # distinct runs that a task holds before it passes them on
DIRECTORY_BITS = 18
CALIBRATION_BINS = 400

PREDICTION_SCHEMA = (
    "lang_pred string, score double, rejected boolean, cross_entropy double, margin double, "
    "letters long"
)
_FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
_letters: list[np.ndarray] = []


def fold(doc_id: str = "doc_id") -> Column:
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS


def _letter_table() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The padded letters and spaces of all texts as code points, and where each text starts.

    A text is ORDER - 1 spaces and then its words, with a space after each.
    """
    lowered = [(text or "").lower() + "\n" for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)))
    is_letter = _letter_table()[codes]
    # The newline ends the last word of each text, so no word reaches into the next one.
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    symbols = np.where(is_letter, codes, np.uint32(0x20))[kept]
    own = np.concatenate(([0], np.cumsum(kept)))[np.concatenate(([0], ends))]
    pad = ORDER - 1
    starts = own + pad * np.arange(len(own))
    out = np.full(starts[-1], 0x20, np.uint32)
    place = np.arange(len(symbols)) + pad * (np.repeat(np.arange(len(texts)), np.diff(own)) + 1)
    out[place] = symbols
    return out, starts


def gram_hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the runs of ``order`` code points that end at each place from order - 1 on."""
    n = len(codes) - order + 1
    total = np.full(max(n, 0), order, np.uint64)
    wide = codes.astype(np.uint64)
    for k in range(order):
        total += wide[k : k + len(total)] * np.uint64(_FACTORS[order - 1 - k])
    return mix(total)


def _text_slices(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    texts, first, size = [], 0, 0
    for at, text in enumerate(column):
        text = text.as_py()
        texts.append(text)
        size += len(text or "")
        if size >= SLICE_CHARS:
            yield first, at + 1, texts
            texts, first, size = [], at + 1, 0
    if texts:
        yield first, len(column), texts
    give_back()


def _predicted_places(starts: np.ndarray) -> np.ndarray:
    """A mask over the runs of ORDER: those that lie in one text."""
    mask = np.ones(max(int(starts[-1]) - ORDER + 1, 0), bool)
    for back in range(1, ORDER):
        cut = starts[1:-1] - back
        mask[cut[(cut >= 0) & (cut < len(mask))]] = False
    return mask


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each run of ORDER characters occurs, from (text, lang)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of: dict[str, int] = {}
        # Parallel arrays: hash with language, language, characters, count.
        held: list[tuple[np.ndarray, ...]] = []

        def merged():
            keys, langs, chars, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first], langs[order][first], chars[order][first], np.add.reduceat(n[order], first)

        def emit():
            keys, langs, chars, n = held.pop()
            names = np.array(list(codes_of))
            grams = np.ascontiguousarray(chars).view(f"<U{ORDER}").ravel()
            for at in range(0, len(keys), 50_000):
                own = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[langs[own]].tolist(), pa.string()),
                        pa.array(grams[own].tolist(), pa.string()),
                        pa.array(n[own], pa.int64()),
                    ],
                    ["lang", "gram", "n"],
                )

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, last, texts in _text_slices(batch.column("text")):
                codes, starts = normalised(texts)
                mask = _predicted_places(starts)
                hashes = gram_hashes(codes, ORDER)
                numbers = [codes_of.setdefault(x, len(codes_of)) for x in langs[first:last]]
                lang = np.repeat(np.array(numbers, np.uint64), np.diff(starts))[: len(mask)]
                at = np.flatnonzero(mask)
                keys = hashes[at] + lang[at] * np.uint64(_FACTORS[0])
                keys, where, n = np.unique(keys, return_index=True, return_counts=True)
                at = at[where]
                chars = codes[at[:, None] + np.arange(ORDER)]
                held.append((keys, lang[at].astype(np.int64), chars, n))
                if len(held) > 4:
                    held[:] = [merged()]
                    if len(held[0][0]) > HELD_GRAMS:
                        yield from emit()
        if held:
            held[:] = [merged()]
            yield from emit()

    rows = own_columns(docs, "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    parts = rows.mapInArrow(count, "lang string, gram string, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _most_frequent(level: DataFrame, weight: str, most: int | None) -> DataFrame:
    """The rows of at most ``most`` runs, the most frequent ones, without a sort of the runs."""
    if most is None:
        return level
    runs = level.groupBy("gram").agg(F.sum(weight).alias("_w"))
    sizes = runs.groupBy(F.log2(F.col("_w").cast("double")).cast("int").alias("b")).count()
    left, bound = most, 0  # at most 64 rows reach the driver
    for bucket, n in sorted(sizes.collect(), reverse=True):
        if n > left:
            bound = 2 ** (bucket + 1)
            break
        left -= n
    return level if not bound else level.join(runs.where(F.col("_w") >= bound), "gram", "left_semi")


def kneser_ney(counts: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """By length of the runs: (lang, gram, n, p) and (lang, context, weight), from (lang, gram, n).

    ``p`` is the interpolated probability of a run's last character after the others, ``weight``
    the share of its context that goes to the next shorter one.
    """
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = (
            levels[k + 1]
            .groupBy("lang", F.substring("gram", 2, k).alias("gram"))
            .agg(F.count("*").alias("n"))
        )
    made: dict[int, tuple[DataFrame, DataFrame]] = {}
    characters = levels[1].select("gram").distinct().count() + 1  # and one for all unknown ones
    for k in range(1, ORDER + 1):
        level = levels[k]
        rare = level.groupBy("lang").agg(
            F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")
        )
        share = F.col("once") / (F.col("once") + 2 * F.col("twice"))
        discount = F.when(F.col("once") > 0, F.least(F.lit(0.9), F.greatest(F.lit(0.1), share)))
        discounts = rare.select("lang", F.coalesce(discount, F.lit(0.5)).alias("d"))
        contexts = (
            level.groupBy("lang", F.substring("gram", 1, k - 1).alias("context"))
            .agg(F.sum("n").alias("total"), F.count("*").alias("types"))
            .join(F.broadcast(discounts), "lang")
            .withColumn("weight", F.col("d") * F.col("types") / F.col("total"))
        )
        rows = level.withColumn("context", F.substring("gram", 1, k - 1)).join(
            contexts, ["lang", "context"]
        )
        if k == 1:
            rows = rows.withColumn("lower", F.lit(1.0 / characters))
        else:
            lower = made[k - 1][0].select(
                "lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")
            )
            rows = rows.withColumn("suffix", F.substring("gram", 2, k - 1)).join(
                lower, ["lang", "suffix"]
            )
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col(
            "weight"
        ) * F.col("lower")
        made[k] = (
            stored(rows.select("lang", "gram", "n", p.alias("p")), f"grams{k}"),
            stored(contexts.select("lang", "context", "total", "weight"), f"contexts{k}"),
        )
    return made


class HashArray(NamedTuple):
    """Sorted hashes with a row of numbers each, and a directory by their first bits."""

    keys: np.ndarray
    directory: np.ndarray
    rows: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, rows: np.ndarray) -> HashArray:
        order = np.argsort(keys)
        keys = keys[order]
        marks = np.arange(1 << DIRECTORY_BITS, dtype=np.uint64) << np.uint64(64 - DIRECTORY_BITS)
        directory = np.append(np.searchsorted(keys, marks), len(keys)).astype(np.int32)
        return HashArray(np.append(keys, np.uint64(0)), directory, rows[order])

    def find(self, asked: np.ndarray) -> np.ndarray:
        """The row of each hash, -1 for those that aren't there."""
        bucket = (asked >> np.uint64(64 - DIRECTORY_BITS)).astype(np.int32)
        at, end = self.directory[bucket], self.directory[bucket + 1]
        out = np.full(len(asked), -1, np.int32)
        open_ = np.arange(len(asked))
        while len(open_):
            inside = at < end
            if not inside.all():
                open_, at, end, asked = open_[inside], at[inside], end[inside], asked[inside]
            same = self.keys[at] == asked
            out[open_[same]] = at[same]
            rest = ~same
            open_, at, end, asked = open_[rest], at[rest] + 1, end[rest], asked[rest]
        return out


class Model(NamedTuple):
    """The languages' models; ``levels[k - 1]`` has the runs of k characters and their contexts."""

    langs: list[str]
    levels: list[tuple[HashArray, HashArray]]
    unknown: np.ndarray
    calibration: Calibration | None = None

    def log_probabilities(self, codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        """log2 p of the runs of ``order`` code points that start at ``at``, by language."""
        if order == 0:
            return np.broadcast_to(self.unknown, (len(at), len(self.langs)))
        grams, contexts = self.levels[order - 1]
        found = grams.find(gram_hashes(codes, order)[at])
        out = grams.rows[found] if len(grams.rows) else np.zeros((len(at), len(self.langs)), np.float32)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            # Only rare runs come here, so their hashes are made for each of them alone.
            own = codes[at[missing][:, None] + np.arange(order)]
            out[missing] = self._backed_off(own, order)
        return out

    def _backed_off(self, chars: np.ndarray, order: int) -> np.ndarray:
        """log2 p of runs, one per row, that no language has."""
        flat = np.ascontiguousarray(chars).ravel()
        at = np.arange(len(chars)) * order
        weights = self.levels[order - 1][1]
        out = np.zeros((len(chars), len(self.langs)), np.float32)
        if len(weights.rows):
            hashes = (
                gram_hashes(flat, order - 1)[at] if order > 1 else np.zeros(len(at), np.uint64)
            )
            found = weights.find(hashes)
            out[found >= 0] = weights.rows[found[found >= 0]]
        return out + self.log_probabilities(flat, at + 1, order - 1)

    def cross_entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text by language, and its number of letters."""
        codes, starts = normalised(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        at = np.flatnonzero(_predicted_places(starts))
        n = np.maximum(np.diff(starts) - (ORDER - 1), 0)
        if len(at):
            bits = self.log_probabilities(codes, at, ORDER)
            # Texts without characters have no places, so the others lie one after another.
            filled = np.flatnonzero(n)
            sums[filled] = np.add.reduceat(
                bits, np.concatenate(([0], np.cumsum(n[filled])[:-1])), axis=0, dtype=np.float64
            )
        return -sums / np.maximum(n, 1)[:, None], n


    def slice_sums(self, texts: list[str | None], slices: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """log2 p by text and language, of the places in slice ``own``, and the number of letters."""
        codes, starts = normalised(texts)
        sums = np.zeros((len(texts), len(self.langs)))
        at = np.flatnonzero(_predicted_places(starts))
        if len(at):
            wide = codes.astype(np.int64)
            at = at[(wide[at + 1] * 31 + wide[at + 2]) % slices == own]
            text = np.searchsorted(starts, at, "right") - 1
            np.add.at(sums, text, self.log_probabilities(codes, at, ORDER))
        return sums, np.maximum(np.diff(starts) - (ORDER - 1), 0)


class Sliced(NamedTuple):
    """A model too large to be broadcast at once: its tables, and into how many slices it is cut."""

    langs: list[str]
    made: dict[int, tuple[DataFrame, DataFrame]] | None
    slices: int
    calibration: Calibration | None = None

    def slice(self, own: int) -> Model:
        def part(df: DataFrame, key: str, k: int) -> DataFrame:
            a, b = (F.ascii(F.substring(key, k - 2 + i, 1)).cast("long") for i in (0, 1))
            return df.where((a * 31 + b) % self.slices == own)

        return _build(
            {
                k: (part(grams, "gram", k), part(contexts, "context", k)) if k > 2 else (grams, contexts)
                for k, (grams, contexts) in self.made.items()
            },
            None,
        )

    def scored(self, docs: DataFrame) -> DataFrame:
        """``docs`` with two more columns in the end: log2 p by language, and the number of letters.

        One scan for each slice. Whatever the columns of ``docs`` are called, they stay.
        """
        row, sums_, letters = (free_name(docs, x) for x in ("_row", "_sums", "_letters"))
        rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
        parts = []
        for own in range(self.slices):
            shared = docs.sparkSession.sparkContext.broadcast(self.slice(own))

            def work(
                batches: Iterable[pa.RecordBatch], shared=shared, slices=self.slices, own=own
            ) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for first, last, texts in _text_slices(batch.column("text")):
                        sums, n = shared.value.slice_sums(texts, slices, own)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).slice(first, last - first),
                                pa.array(list(sums), pa.list_(pa.float64())),
                                pa.array(n, pa.int64()),
                            ],
                            ["_row", "_sums", "_letters"],
                        )

            made = rows.select(F.col(row).alias("_row"), "text").mapInArrow(
                work, "_row long, _sums array<double>, _letters long"
            )
            parts.append(stored(made, "slice"))
            shared.destroy()
        sums = (F.sum(F.col("_sums")[i]) for i in range(len(self.langs)))
        total = (
            reduce(DataFrame.unionByName, parts)
            .groupBy(F.col("_row").alias(row))
            .agg(F.array(*sums).alias(sums_), F.first("_letters").alias(letters))
        )
        return rows.join(total, row).select(*all_columns(docs), sums_, letters)


class Calibration(NamedTuple):
    """What the calibration fold says about right answers.

    ``slope`` and ``offset``: how likely an answer is right, by its margin. ``mean`` and
    ``spread``: the cross entropy of right answers by language. ``bound``: the largest normalised
    distance from that mean that is accepted.
    """

    offset: float
    slope: float
    mean: np.ndarray
    spread: np.ndarray
    bound: float


def _strength(margin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The lead over the second language in bits, damped for long texts."""
    return np.minimum(margin * np.sqrt(n), 40.0)


def _entropies(model: Model | Sliced | None, batch: pa.RecordBatch):
    """First and last row, bits per character by language, and letters, for parts of a batch."""
    if isinstance(model, Sliced):
        n = batch.column(batch.num_columns - 1).to_numpy()
        sums = batch.column(batch.num_columns - 2).flatten().to_numpy().reshape(len(n), len(model.langs))
        yield 0, len(n), -sums / np.maximum(n, 1)[:, None], n
        return
    for first, last, texts in _text_slices(batch.column("text")):
        if model is None:
            yield first, last, np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64)
        else:
            yield first, last, *model.cross_entropies(texts)


def _decide(entropies: np.ndarray, n: np.ndarray):
    """Best language, its cross entropy, the lead over the second one, and the letters."""
    best = entropies.argmin(axis=1)
    lowest = entropies[np.arange(len(n)), best]
    if entropies.shape[1] > 1:
        margin = np.partition(entropies, 1, axis=1)[:, 1] - lowest
    else:
        margin = np.full(len(n), 1.0)
    return best, lowest, margin, n


def _shared(spark, model: Model | Sliced | None):
    """The model broadcast, without its tables if these are not arrays."""
    return spark.sparkContext.broadcast(model._replace(made=None) if isinstance(model, Sliced) else model)


def _build(made: dict[int, tuple[DataFrame, DataFrame]], most: int | None) -> Model:
    langs = sorted(r.lang for r in made[1][0].select("lang").distinct().collect())
    column = {lang: i for i, lang in enumerate(langs)}
    characters = made[1][0].select("gram").distinct().count() + 1

    def chars(strings: list[str], k: int) -> np.ndarray:
        joined = "".join(strings).encode("utf-32-le")
        return np.frombuffer(joined, np.uint32).reshape(len(strings), k) if k else None

    def hashes(matrix: np.ndarray | None, n: int, k: int) -> np.ndarray:
        if not k:
            return np.zeros(n, np.uint64)
        return gram_hashes(np.ascontiguousarray(matrix).ravel(), k)[np.arange(n) * k]

    def arrays(df: DataFrame, key: str, value: str):
        """Distinct strings, and for each row its string's place, language and value."""
        got = df.select("lang", key, value).toArrow()
        strings, where = np.unique(np.array(got[key].to_pylist(), object).astype(str), return_inverse=True)
        lang = np.array([column[x] for x in got["lang"].to_pylist()], np.int64)
        return strings.tolist(), where, lang, got[value].to_numpy()

    levels: list[tuple[HashArray, HashArray]] = []
    # The bottom: one character's share of what each language leaves to unknown ones.
    model = Model(langs, levels, np.full(len(langs), -np.log2(characters), np.float32))
    for k in range(1, ORDER + 1):
        grams, contexts = made[k]
        if k > 1:
            contexts = _most_frequent(
                contexts.withColumnRenamed("context", "gram"), "total", most
            ).withColumnRenamed("gram", "context")
        strings, where, lang, weight = arrays(contexts, "context", "weight")
        table = np.zeros((len(strings), len(langs)), np.float32)
        table[where, lang] = np.log2(weight)
        context_array = HashArray.of(hashes(chars(strings, k - 1), len(strings), k - 1), table)
        strings, where, lang, p = arrays(_most_frequent(grams, "n", most), "gram", "p")
        matrix = chars(strings, k)
        empty = HashArray.of(np.zeros(0, np.uint64), np.zeros((0, len(langs)), np.float32))
        levels.append((empty, context_array))
        table = model._backed_off(matrix, k)  # for languages that don't have the run
        table[where, lang] = np.log2(p)
        levels[-1] = (HashArray.of(hashes(matrix, len(strings), k), table), context_array)
    return model


def _calibrate(docs: DataFrame, model: Model | Sliced) -> Calibration:
    """From (text, lang) of the calibration fold; each task hands on one row of sums.

    The sums are right and wrong answers by strength, and right ones by distance from a first
    mean; their number is fixed.
    """
    spark, n_langs = docs.sparkSession, len(model.langs)
    shared = _shared(spark, model)
    rows = own_columns(docs, "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    if isinstance(model, Sliced):
        rows = stored(model.scored(rows).drop("text"), "calibration")

    def judged(batch: pa.RecordBatch):
        langs = batch.column("lang").to_pylist()
        column = {lang: i for i, lang in enumerate(shared.value.langs)}
        for first, last, entropies, n in _entropies(shared.value, batch):
            best, lowest, margin, n = _decide(entropies, n)
            truth = np.array([column.get(x, -1) for x in langs[first:last]])
            some = n > 0
            yield best[some], lowest[some], margin[some], n[some], (best == truth)[some]

    def summed(collect):
        def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for part in judged(batch):
                    made = collect(*part)
                    total = made if total is None else total + made
            if total is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(total))), pa.array(total, pa.float64())], ["k", "v"]
                )

        parts = rows.mapInArrow(task, "k long, v double").groupBy("k").agg(F.sum("v").alias("v"))
        return dict(parts.collect())

    def moments(best, lowest, margin, n, right):
        out = np.zeros(4 * n_langs + 2 * CALIBRATION_BINS)
        for i, value in enumerate((np.ones(len(n)), lowest, lowest**2 * 1.0, 1.0 / n)):
            out[i * n_langs : (i + 1) * n_langs] = np.bincount(
                best[right], value[right], minlength=n_langs
            )
        strength = (_strength(margin, n) / 40.0 * (CALIBRATION_BINS - 1)).astype(int)
        both = strength + CALIBRATION_BINS * right
        out[4 * n_langs :] = np.bincount(both, minlength=2 * CALIBRATION_BINS)
        return out

    sums = summed(moments)
    if not sums:
        ones = np.ones(n_langs)
        return Calibration(0.0, 1.0, ones, ones, np.inf)
    flat = np.array([sums.get(k, 0.0) for k in range(4 * n_langs + 2 * CALIBRATION_BINS)])
    count, first, second, inverse = flat[: 4 * n_langs].reshape(4, n_langs)
    enough = np.maximum(count, 1)
    mean = first / enough
    # Spread of a text of one character, if the variance falls with the length.
    variance = np.maximum(second / enough - mean**2, 1e-6)
    spread = np.sqrt(variance / np.maximum(inverse / enough, 1e-6))
    wrong, right = flat[4 * n_langs :].reshape(2, CALIBRATION_BINS)
    offset, slope = _logistic((np.arange(CALIBRATION_BINS) + 0.5) * 40.0 / CALIBRATION_BINS, right, wrong)

    width = 0.25

    def distances(best, lowest, margin, n, right):
        away = np.maximum((lowest - mean[best]) * np.sqrt(n) / spread[best], 0.0)
        bins = np.minimum(away / width, CALIBRATION_BINS - 1).astype(int)
        return np.bincount(bins[right], minlength=CALIBRATION_BINS).astype(float)

    by_distance = summed(distances)
    tail = np.cumsum([by_distance.get(k, 0.0) for k in range(CALIBRATION_BINS)])
    within = int(np.searchsorted(tail, (1 - FALSE_REJECTIONS) * tail[-1])) if tail[-1] else 0
    bound = REJECTION_SLACK * (within + 1) * width if tail[-1] else np.inf
    return Calibration(offset, slope, mean, spread, bound)


def _logistic(x: np.ndarray, right: np.ndarray, wrong: np.ndarray) -> tuple[float, float]:
    """Platt's fit of how likely an answer is right; one of each kind is added to both ends."""
    right, wrong = right.copy(), wrong.copy()
    right[-1] += 1
    wrong[0] += 1
    scale = x.max()
    features = np.stack([np.ones_like(x), x / scale])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ features, -30, 30)))
        gradient = features @ (right - (right + wrong) * p) - 1e-3 * beta
        curvature = (features * ((right + wrong) * p * (1 - p))) @ features.T + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curvature, gradient), -5, 5)
    return float(beta[0]), float(max(beta[1], 0.0) / scale)


def train(docs: DataFrame, most: int | None = None, at_once: int = MAX_GRAMS) -> Model | Sliced | None:
    """The model of (doc_id, text, lang), without the held-out fold; None if there is nothing.

    With more than ``at_once`` runs of a length it is sliced. ``most`` keeps only that many runs.
    """
    small_batches(docs.sparkSession)
    rows = own_columns(docs, "doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    calibration = rows.where(fold() == CALIBRATION)
    counts = stored(
        count_grams(rows.where(~fold().isin(HELD_OUT, CALIBRATION))), "gram_counts"
    )
    if not counts.limit(1).count():
        return None
    made = kneser_ney(counts)
    runs = 0 if most else max(made[k][0].select("gram").distinct().count() for k in (ORDER - 1, ORDER))
    if runs > at_once:
        langs = sorted(r.lang for r in made[1][0].select("lang").distinct().collect())
        # Twice as many slices as needed, as they are uneven.
        model = Sliced(langs, made, 2 * -(-runs // at_once))
    else:
        model = _build(made, most)
    return model._replace(calibration=_calibrate(calibration, model))


def predictions(model: Model | None, texts: list[str | None]) -> dict[str, np.ndarray]:
    """The columns of PREDICTION_SCHEMA for some texts."""
    if model is None:
        return _answers(None, np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64))
    return _answers(model, *model.cross_entropies(texts))


def _answers(model: Model | Sliced | None, entropies: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """The columns of PREDICTION_SCHEMA, from bits per character by language and letters."""
    if model is None:
        zeros = np.zeros(len(n))
        names = np.full(len(n), UNKNOWN, object)
        return dict(
            lang_pred=names, score=zeros, rejected=zeros == 0, cross_entropy=zeros, margin=zeros,
            letters=zeros.astype(np.int64),
        )
    best, lowest, margin, n = _decide(entropies, n)
    known = n > 0
    c = model.calibration
    logit = c.offset + c.slope * _strength(margin, n)
    score = np.where(known, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0.0)
    away = (lowest - c.mean[best]) * np.sqrt(n) / c.spread[best]
    names = np.where(known, np.array(model.langs, object)[best], UNKNOWN)
    return dict(
        lang_pred=names,
        score=score,
        rejected=~known | (away > c.bound),
        cross_entropy=np.where(known, lowest, 0.0),
        margin=np.where(known, margin, 0.0),
        letters=n.astype(np.int64),
    )


def _fields() -> list[tuple[str, pa.DataType]]:
    return [
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("rejected", pa.bool_()),
        ("cross_entropy", pa.float64()),
        ("margin", pa.float64()),
        ("letters", pa.int64()),
    ]


def predict(docs: DataFrame, model: Model | Sliced | None) -> DataFrame:
    """(doc_id, held_out) and PREDICTION_SCHEMA for each row of (doc_id, text)."""
    small_batches(docs.sparkSession)
    shared = _shared(docs.sparkSession, model)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, entropies, n in _entropies(shared.value, batch):
                got = _answers(shared.value, entropies, n)
                rest = batch.select(["doc_id", "held_out"]).slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*rest.columns, *(pa.array(got[name], kind) for name, kind in _fields())],
                    ["doc_id", "held_out", *(name for name, _ in _fields())],
                )

    rows = own_columns(docs, "doc_id", "text").withColumn("held_out", fold() == HELD_OUT)
    if isinstance(model, Sliced):
        rows = model.scored(rows).drop("text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, {PREDICTION_SCHEMA}")


def accepted(docs: DataFrame, model: Model | Sliced | None) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, as they are."""
    small_batches(docs.sparkSession)
    shared = _shared(docs.sparkSession, model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [
                _answers(shared.value, entropies, n)["rejected"]
                for _, _, entropies, n in _entropies(shared.value, batch)
            ]
            if parts:
                yield batch.select(list(range(width))).filter(pa.array(~np.concatenate(parts)))

    width = len(docs.columns)
    rows = model.scored(docs) if isinstance(model, Sliced) else docs
    return kept_rows(rows, keep, docs.schema)
