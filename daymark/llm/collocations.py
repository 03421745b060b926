"""Phrases whose words keep together, mined from sharded FM-indexes over word ids.

Every task turns the texts of each language it reads into shards: sequences of word ids with a mark
between pieces, of which it stores two Burrows-Wheeler transforms, one of the sequence and one of
its mirror image. Suffixes are sorted by their first ``longest`` words only, which is all that
phrases up to that length need. A phrase is a pair of intervals, one in each index, and extending
it by a word on the left (right) takes the words in the interval of the forward (mirror) index:
their numbers are the counts of the longer phrases, and where they come narrows the other interval.

Shards know only their own counts, so a phrase is followed up as long as an upper bound of its count
in the whole corpus allows: the counts of a level are added up by hash in a sketch, of which one bit
per counter goes to all tasks. A bound never falls short, so nothing is lost; where the sketch is too
small for a corpus, more is followed up, and the result is the same. What remains after the last
level is summed by Spark, exactly, one row for each phrase and task.

Edge cases: a null text is empty; a null language is ``und``; texts without words count nothing; a
text repeated counts as often; languages with fewer rows than ``top`` return them all; ties are
settled by count, then by the bytes of the phrase; an empty table gives no rows; other columns are
ignored. A piece is never cut and must fit into a task, shards of long texts are cut between pieces.
Words are told apart by 64-bit hashes; if two words share one, the job fails instead of adding them up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.common import broadcast_if_few, own_columns, scratch, small_batches, stored
from daymark.llm.textops import LOWER, give_back, mix, text_slices, words

LONGEST = 4
LEAST_COUNT = 30
ABSORBED_PERCENT = 80  # a longer phrase with so much of the count stands for the shorter one
TOP = 2000
SCALE = 2_000_000  # of scores

SHARD_WORDS = 600_000
LEAST_BITS, MOST_BITS = 18, 26  # counters of the sketch; one bit of each is broadcast
WORDS_PER_COUNTER = 12  # by far fewer than the least count
BATCH_BYTES = 16_000_000  # of shards that are handed to a Python worker at a time
# The more shards a task reads, the more of its phrases are summed before they travel.
WORDS_PER_TASK = 12_000_000
CHUNK_BITS = 16

INDEX_SCHEMA = "lang string, n_words long, hashes binary, words array<string>, bwt binary, mirror binary"
GRAM_SCHEMA = "lang string, gram binary, f long"

_BYTES = np.arange(256)
_CUT = np.isin(_BYTES, np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_WORD = ~(_CUT | (_BYTES == 0x20) | (_BYTES == 0x09))


def ordered(keys: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0 on."""
    n = max(len(keys), 1)
    if len(keys) and int(keys.max()) < 2**62 // n:
        # Sorting numbers that hold their own place is several times as fast as sorting places.
        return np.sort(keys.astype(np.int64) * n + np.arange(n)) % n
    return np.argsort(keys, kind="stable")


def transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """What precedes each suffix, suffixes sorted by their first ``depth`` symbols.

    ``symbols`` ends with 0, the mark, which also stands for what is beyond either end.
    """
    rank, reach = symbols.astype(np.int64), 1
    while reach < depth:
        # From ``reach`` symbols to twice as many, or to ``depth``.
        ahead = min(reach, depth - reach)
        behind = np.zeros_like(rank)
        behind[:-ahead] = rank[ahead:]
        rank = rank * (int(rank.max()) + 1) + behind
        reach += ahead
        if reach < depth:
            order = ordered(rank)
            steps = np.concatenate(([0], np.diff(rank[order]) != 0)).cumsum()
            rank[order] = steps
    return symbols[ordered(rank) - 1].astype(np.int32)


class Transform:
    """One direction of an index."""

    def __init__(self, bwt: np.ndarray, symbols: int):
        self.bwt, self.symbols = bwt, symbols
        self.counts = np.bincount(bwt, minlength=symbols)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))[:-1]

    @cached_property
    def last_to_first(self) -> np.ndarray:
        out = np.empty(len(self.bwt), np.int64)
        out[ordered(self.bwt)] = np.arange(len(self.bwt))
        return out


class Phrases:
    """Phrases of one length: their words, and their intervals in both directions of an index."""

    def __init__(self, words: np.ndarray, lo: np.ndarray, mirror_lo: np.ndarray, n: np.ndarray):
        self.words, self.lo, self.mirror_lo, self.n = words, lo, mirror_lo, n

    def __len__(self) -> int:
        return len(self.n)

    def where(self, kept: np.ndarray) -> Phrases:
        return Phrases(self.words[kept], self.lo[kept], self.mirror_lo[kept], self.n[kept])


class Index:
    """A bidirectional FM-index of one shard."""

    def __init__(self, bwt: np.ndarray, mirror: np.ndarray, symbols: int):
        self.forward, self.backward = Transform(bwt, symbols), Transform(mirror, symbols)

    def single(self) -> Phrases:
        words = np.arange(1, self.forward.symbols)
        first = self.forward.first[1:]
        return Phrases(words[:, None], first, first, self.forward.counts[1:])

    def extended(self, phrases: Phrases, left: bool) -> Phrases:
        """All phrases with one more word on the left, or else on the right."""
        way = self.forward if left else self.backward
        lo, other = (phrases.lo, phrases.mirror_lo) if left else (phrases.mirror_lo, phrases.lo)
        total = int(phrases.n.sum())
        before = np.cumsum(phrases.n) - phrases.n
        rows = np.repeat(lo - before, phrases.n) + np.arange(total)
        key = np.repeat(np.arange(len(phrases)) * way.symbols, phrases.n) + way.bwt[rows]
        order = ordered(key)
        key = key[order]
        begins = np.flatnonzero(np.concatenate(([total > 0], key[1:] != key[:-1])))
        n = np.diff(np.append(begins, total))
        base, added = np.divmod(key[begins], way.symbols)
        # Rows of an interval are sorted by what precedes them in the other direction.
        other = other[base] + begins - before[base]
        lo = way.last_to_first[rows[order[begins]]]
        real = added > 0
        base, added, n, lo, other = (x[real] for x in (base, added, n, lo, other))
        pair = (added[:, None], phrases.words[base])
        found = np.hstack(pair if left else pair[::-1])
        return Phrases(found, *((lo, other) if left else (other, lo)), n)


def _within(places: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether each place lies in one of the intervals, which don't overlap."""
    if not len(lo):
        return np.zeros(len(places), bool)
    order = np.argsort(lo)
    lo, end = lo[order], (lo + n)[order]
    at = np.searchsorted(lo, places, "right") - 1
    return (at >= 0) & (places < end[np.maximum(at, 0)])


def levels(index: Index, longest: int, alive: Callable[[Phrases], np.ndarray]) -> Iterator[Phrases]:
    """The phrases of each length that ``alive`` leaves; only these are extended.

    Of a longer phrase both parts that lack one end were left.
    """
    phrases = index.single()
    phrases = phrases.where(alive(phrases))
    yield phrases
    single = np.zeros(index.forward.symbols, bool)
    single[phrases.words[:, 0]] = True
    for length in range(2, longest + 1):
        left = length % 2 == 1
        longer = index.extended(phrases, left)
        if length == 2:
            both = single[longer.words[:, 1]]
        elif left:
            both = _within(longer.lo, phrases.lo, phrases.n)
        else:
            both = _within(longer.mirror_lo, phrases.mirror_lo, phrases.n)
        longer = longer.where(both)
        phrases = longer.where(alive(longer))
        yield phrases


class _Held:
    """What a task has read of one language for its next shard: parts of slices of texts."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []  # whether a word begins a piece
        self.distinct: list[np.ndarray] = []
        self.names: list[bytes] = []  # of the distinct hashes
        self.size = 0

    def add(self, hashes: np.ndarray, begins: np.ndarray, name_of: Callable[[np.ndarray], list[bytes]]) -> None:
        distinct, at = np.unique(hashes, return_index=True)
        self.hashes.append(hashes)
        self.begins.append(begins)
        self.distinct.append(distinct)
        self.names += name_of(at)
        self.size += len(hashes)

    def vocabulary(self) -> tuple[np.ndarray, list[str]]:
        """The distinct hashes, sorted, and their words."""
        distinct = np.concatenate(self.distinct)
        order = np.argsort(distinct, kind="stable")
        again = distinct[order][1:] == distinct[order][:-1]
        for i, j in zip(order[:-1][again].tolist(), order[1:][again].tolist()):
            if self.names[i] != self.names[j]:
                raise ValueError(f"two words share a hash: {self.names[i]!r}, {self.names[j]!r}")
        order = order[np.concatenate(([True], ~again))]
        return distinct[order], [self.names[i].decode() for i in order.tolist()]


def _sequences(
    batches: Iterable[pa.RecordBatch], shard_words: int
) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(lang, word hashes, whether each begins a piece, distinct hashes, their words) of each shard."""
    held: dict[str, _Held] = {}

    def shard(lang: str) -> tuple:
        own = held.pop(lang)
        return lang, np.concatenate(own.hashes), np.concatenate(own.begins), *own.vocabulary()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, last, data, offsets in text_slices(batch.column("text")):
            found = words(data, offsets, _WORD)
            if not len(found.hashes):
                continue
            text = found.texts()
            cuts = np.concatenate(([0], np.cumsum(_CUT[data])))[found.starts]
            begins = np.concatenate(([True], (np.diff(cuts) > 0) | (np.diff(text) > 0)))
            lower = LOWER[data].tobytes()
            codes = {name: k for k, name in enumerate(dict.fromkeys(langs[first:last]))}
            code = np.array([codes[x] for x in langs[first:last]])[text]
            for lang, k in codes.items():
                own = np.flatnonzero(code == k)
                # A long text may fill several shards; a piece is in one.
                starts = np.append(np.flatnonzero(begins[own]), len(own))
                rest = 0
                while rest < len(own):
                    mine = held.setdefault(lang, _Held())
                    room = rest + max(shard_words - mine.size, 0)
                    to = int(starts[np.searchsorted(starts, room, "right") - 1])
                    if to <= rest and not mine.size:
                        to = int(starts[np.searchsorted(starts, rest, "right")])  # a piece too long for a shard
                    if to > rest:
                        part = own[rest:to]

                        def name_of(at: np.ndarray, part: np.ndarray = part) -> list[bytes]:
                            ends = found.ends[part[at]].tolist()
                            return [lower[a:b] for a, b in zip(found.starts[part[at]].tolist(), ends)]

                        mine.add(found.hashes[part], begins[part], name_of)
                        rest = to
                    if rest < len(own):
                        yield shard(lang)
    for lang in list(held):
        yield shard(lang)
    give_back()


def build_index(docs: DataFrame, longest: int = LONGEST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """INDEX_SCHEMA: the shards of (lang, text)."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, hashes, begins, distinct, names in _sequences(batches, shard_words):
            ids = np.searchsorted(distinct, hashes)
            # The symbols, with a mark before each piece but the first, and one in the end.
            places = np.arange(len(ids)) + np.cumsum(begins) - 1
            symbols = np.zeros(int(places[-1]) + 2, np.int32)
            symbols[places] = ids + 1
            mirrored = np.append(symbols[-2::-1], np.int32(0))
            columns = (
                pa.array([lang], pa.string()),
                pa.array([len(hashes)], pa.int64()),
                pa.array([distinct.tobytes()], pa.binary()),
                pa.array([names], pa.list_(pa.string())),
                pa.array([transform(symbols, longest).tobytes()], pa.binary()),
                pa.array([transform(mirrored, longest).tobytes()], pa.binary()),
            )
            fields = [field.split()[0] for field in INDEX_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(list(columns), fields)

    rows = own_columns(docs, "lang", "text")
    rows = rows.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    return rows.mapInArrow(build, INDEX_SCHEMA)


def stored_index(index: DataFrame) -> DataFrame:
    """The index in the shared folder, in small row groups: a reader holds one of these at a time."""
    path = scratch(index.sparkSession, "index")
    small = {
        "parquet.block.size": BATCH_BYTES,
        "parquet.block.size.row.check.min": 1,
        "parquet.page.size.row.check.min": 1,
    }
    index.write.options(**small).parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, Index]]:
    """(lang, hash of each symbol, index); symbol 0, the mark, has hash 0."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in ("lang", "hashes", "bwt", "mirror")}
            hashes = np.frombuffer(row["hashes"].as_buffer(), np.uint64)
            bwt, mirror = (np.frombuffer(row[x].as_buffer(), np.int32) for x in ("bwt", "mirror"))
            yield row["lang"].as_py(), np.append(np.uint64(0), hashes), Index(bwt, mirror, len(hashes) + 1)
            give_back()


def _counters(lang: str, hashes: np.ndarray, phrases: Phrases, bits: int) -> np.ndarray:
    """The counter of the sketch that each phrase is counted in."""
    seed = (crc32(lang.encode()) << 8) + phrases.words.shape[1]
    x = np.full(len(phrases), seed, np.uint64)
    for column in phrases.words.T:
        x = mix(x + hashes[column] * np.uint64(0x9E3779B97F4A7C15))
    return (x >> np.uint64(64 - bits)).astype(np.int64)


class Bounds:
    """Which counters of the sketches of each length reached the least count, as packed bits."""

    def __init__(self, bits: int):
        self.bits = bits
        self.packed: dict[int, np.ndarray] = {}

    def alive(self, lang: str, hashes: np.ndarray) -> Callable[[Phrases], np.ndarray]:
        def test(phrases: Phrases) -> np.ndarray:
            length = phrases.words.shape[1]
            if length not in self.packed:
                return np.ones(len(phrases), bool)
            at = _counters(lang, hashes, phrases, self.bits)
            return (self.packed[length][at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

        return test


def _sketch(index: DataFrame, bounds: Bounds, lengths: tuple[int, ...], least: int) -> np.ndarray:
    """The bits of the counters of ``lengths``, which share them."""
    bits, kind = bounds.bits, np.uint8 if least <= 255 else np.uint32
    chunk = 1 << min(CHUNK_BITS, bits)
    shared = index.sparkSession.sparkContext.broadcast(bounds)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, kind)
        for lang, hashes, shard in _shards(batches):
            for phrases in levels(shard, max(lengths), shared.value.alive(lang, hashes)):
                if phrases.words.shape[1] in lengths:
                    at = _counters(lang, hashes, phrases, bits)
                    order = np.argsort(at)
                    at = at[order]
                    begins = np.flatnonzero(np.concatenate(([len(at) > 0], at[1:] != at[:-1])))
                    if len(begins):
                        n = np.add.reduceat(phrases.n[order], begins) + total[at[begins]]
                        # More than the least count needn't be told apart from it.
                        total[at[begins]] = np.minimum(n, least)
        used = np.flatnonzero(total)
        edges = np.searchsorted(used, np.arange(0, (1 << bits) + 1, chunk))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = used[edges[k] : edges[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k], pa.int32()),
                    pa.array([(own - k * chunk).astype(np.uint16).tobytes()], pa.binary()),
                    pa.array([total[own].tobytes()], pa.binary()),
                ],
                ["chunk", "at", "counts"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(chunk, np.int64)
        for at, counts in zip(table["at"], table["counts"]):
            total[np.frombuffer(at.as_py(), np.uint16)] += np.frombuffer(counts.as_py(), kind)
        reached = np.packbits(total >= least, bitorder="little").tobytes()
        return pa.table({"chunk": table["chunk"][:1], "reached": pa.array([reached], pa.binary())})

    rows = index.select("lang", "hashes", "bwt", "mirror").mapInArrow(
        count, "chunk int, at binary, counts binary"
    )
    out = np.zeros((1 << bits) // 8, np.uint8)
    # One bit for each counter, however large the corpus.
    for row in rows.groupBy("chunk").applyInArrow(add, "chunk int, reached binary").toLocalIterator():
        out[row.chunk * chunk // 8 :][: chunk // 8] = np.frombuffer(row.reached, np.uint8)
    return out


def followed_up(index: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT) -> DataFrame:
    """GRAM_SCHEMA: the phrases of every shard that may occur ``least`` times in all of them,
    with their counts there. ``index`` is stored."""
    total = index.agg(F.sum("n_words")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    index = index.coalesce(max(total // WORDS_PER_TASK + 1, 2 * cores))
    bits = (total // WORDS_PER_COUNTER).bit_length()
    bounds = Bounds(min(max(bits, LEAST_BITS), MOST_BITS))
    reached = _sketch(index, bounds, (1, 2), least)
    bounds.packed |= {1: reached, 2: reached}
    for length in range(3, longest + 1):
        bounds.packed[length] = _sketch(index, bounds, (length,), least)
    shared = index.sparkSession.sparkContext.broadcast(bounds)

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, hashes, shard in _shards(batches):
            for phrases in levels(shard, longest, shared.value.alive(lang, hashes)):
                length = phrases.words.shape[1]
                for a in range(0, len(phrases), 100_000):
                    grams = hashes[phrases.words[a : a + 100_000]]
                    ends = pa.py_buffer((np.arange(len(grams) + 1) * 8 * length).astype(np.int32).tobytes())
                    gram = pa.Array.from_buffers(pa.binary(), len(grams), [None, ends, pa.py_buffer(grams.tobytes())])
                    langs = pa.repeat(pa.scalar(lang, pa.string()), len(grams))
                    n = pa.array(phrases.n[a : a + 100_000], pa.int64())
                    yield pa.RecordBatch.from_arrays([langs, gram, n], ["lang", "gram", "f"])

    return index.select("lang", "hashes", "bwt", "mirror").mapInArrow(emit, GRAM_SCHEMA)


def count_phrases(index: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT) -> DataFrame:
    """(lang, gram, f) of all phrases of up to ``longest`` words that occur ``least`` times or more.

    ``gram`` is the hashes of the words, 8 bytes each. ``index`` is stored.
    """
    rows = followed_up(index, longest, least)
    return rows.groupBy("lang", "gram").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def extensions(grams: DataFrame) -> DataFrame:
    """(lang, gram, f, n_left, most_left, n_right, most_right) of stored phrases.

    How many of the phrases are ``gram`` with a word more on the left (right), and the highest of
    their counts; 0 where there is none.
    """
    size = F.octet_length("gram")
    longer = grams.where(size > 8)
    parts = longer.select(
        "lang",
        "f",
        F.explode(
            F.array(
                F.struct(F.expr("substring(gram, 9)").alias("gram"), F.lit(True).alias("left")),
                F.struct(F.expr("substring(gram, 1, octet_length(gram) - 8)").alias("gram"), F.lit(False).alias("left")),
            )
        ).alias("part"),
    ).select("lang", "f", "part.*")
    sums = [
        f
        for name, side in (("left", F.col("left")), ("right", ~F.col("left")))
        for f in (F.count_if(side).alias(f"n_{name}"), F.max(F.when(side, F.col("f"))).alias(f"most_{name}"))
    ]
    found = parts.groupBy("lang", "gram").agg(*sums)
    names = ["n_left", "most_left", "n_right", "most_right"]
    return grams.join(found, ["lang", "gram"], "left").select(
        "lang", "gram", "f", *(F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in names)
    )


def cut_scores(grams: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, gram, score, cut, l, r): the cut of each of the ``phrases`` that scores lowest."""
    cuts = phrases.select(
        "lang",
        "gram",
        "f",
        F.explode(F.expr("sequence(1, cast(octet_length(gram) / 8 as int) - 1)")).alias("cut"),
    ).select(
        "*",
        F.expr("substring(gram, 1, 8 * cut)").alias("head"),
        F.expr("substring(gram, 8 * cut + 1)").alias("tail"),
    )
    heads = grams.select("lang", F.col("gram").alias("head"), F.col("f").alias("l"))
    tails = grams.select("lang", F.col("gram").alias("tail"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    # Decimals: the products pass 64 bits.
    score = F.expr(f"cast(cast({SCALE} as decimal(18,0)) * cast(f as decimal(20,0)) div (cast(l as decimal(20,0)) + r) as long)")
    scored = scored.withColumn("score", score)
    least = scored.groupBy("lang", "gram").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    return least.select("lang", "gram", "least.*")


def spelled(index: DataFrame, grams: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, gram, phrase): the words of ``phrases``, which ``grams`` has all parts of."""
    known = index.select("lang", "hashes", F.posexplode("words").alias("at", "word")).select(
        "lang", F.expr("substring(hashes, 8 * at + 1, 8)").alias("hash"), "word"
    )
    wanted = grams.where(F.octet_length("gram") == 8).select("lang", F.col("gram").alias("hash"))
    known = known.join(broadcast_if_few(wanted), ["lang", "hash"], "left_semi")
    names = known.groupBy("lang", "hash").agg(F.min("word").alias("word"), F.max("word").alias("other"))
    names = stored(names, "words")
    if names.where("word != other").limit(1).count():
        raise ValueError("two words share a hash")
    parts = phrases.select("lang", "gram", F.explode(F.expr("sequence(0, cast(octet_length(gram) / 8 as int) - 1)")).alias("at"))
    parts = parts.withColumn("hash", F.expr("substring(gram, 8 * at + 1, 8)"))
    joined = parts.join(broadcast_if_few(names.drop("other")), ["lang", "hash"])
    in_order = F.array_sort(F.collect_list(F.struct("at", "word")))
    return joined.groupBy("lang", "gram").agg(F.concat_ws(" ", F.transform(in_order, lambda x: x["word"])).alias("phrase"))


def mine(
    docs: DataFrame,
    top: int = TOP,
    longest: int = LONGEST,
    least: int = LEAST_COUNT,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, and the extensions) of the best phrases by language.

    ``a`` is the count of a phrase, ``l`` and ``r`` those of its parts at its weakest cut, ``n`` the
    words of the language.
    """
    spark, batch = docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    small_batches(spark)
    now = spark.conf.get(batch).lower().removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(batch, str(BATCH_BYTES))
    index = stored_index(build_index(docs, longest, shard_words))
    grams = stored(count_phrases(index, longest, least), "grams")
    phrases = extensions(grams).where(F.octet_length("gram") > 8)
    # A longer phrase with enough of the count has a part, one word longer, with as much.
    most = F.greatest("most_left", "most_right").cast("decimal(25,0)")
    phrases = stored(phrases.where(100 * most < ABSORBED_PERCENT * F.col("f")), "phrases")
    scored = phrases.join(cut_scores(grams, phrases), ["lang", "gram"])
    scored = scored.join(spelled(index, grams, phrases), ["lang", "gram"])
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("f"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    sizes = index.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return best.join(broadcast_if_few(stored(sizes, "sizes")), "lang").select(
        "lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score",
        "n_left", "most_left", "n_right", "most_right",
    )
