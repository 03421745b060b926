"""Exact Jaccard similarity join of documents in the metric space of their shingle sets.

Jaccard distance is a metric, so pivots and the triangle inequality tell which documents can lie
within the radius ``e`` (1 - the least similarity) of each other.

Equal sets are one class from the start. The classes are joined in regions:

1. Around one-shingle pivots. A set is at distance 1 - 1/n of each of its own n shingles and at 1
   of all others, so its nearest pivots are its own shingles; ties are broken by one global
   order, rarest first. Sets that share no shingle are at distance 1 and never meet. Of two sets
   within ``e``, either has at most ``e`` * n shingles that the other lacks, so the first common
   one is among the first ``e`` * n + 1 of both: so many regions a set is replicated to. These
   are the windows around the region's border.
2. A region that is still large takes some of its own sets as pivots, and the exact distances of
   all members to them are computed. Pivots are then done. Members within 2 ``e`` of their nearest
   pivot form that pivot's Voronoi region, the others the outer one. Whoever can have a partner
   in another region is replicated there: to pivot q if d(q) <= d(nearest) + 2 e and d(q) <= 3 e,
   to the outer region if d(nearest) > e. Regions that don't shrink this way are kept as they
   are, without the pivots. So on, with more pivots each time.
3. What is small is joined in blocks. A task compares two blocks and marks the members that may
   be linked to one of another component; then the sets of these are compared, block by block, in
   tasks that give only links which join components. A region all of whose members are connected
   already is done.

First of all, a single pivot in every region connects most near copies, whose pairs then never
show up.

Pairs are first compared by odd sketches, some bits for each shingle: these bound the distance
from below, so the sets of pairs that are far apart never travel. Each link that is found is
exact (the sets are intersected), and no pair of different components
is left out, so components are exact; within a component not all links need to be found.

The global order comes from a count sketch of fixed size. Sets are told apart by 64-bit hashes,
which are checked against 128-bit ones (another seed is tried if two sets share one); shingles
are told apart by 64-bit hashes. Regions of a shingle that the sketch calls hot are never gathered
in a task: their rows are spread by class and met by joins that adaptive execution splits.

Edge cases: null and empty texts and texts without words have no shingles and link with nothing;
fewer words than a shingle has are one shingle; repeated rows are copies; a null id is the
largest one (its component's id is null only if it has no other); an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.common import (
    all_columns,
    broadcast_if_few,
    own_columns,
    small_batches,
    stored,
)
from daymark.llm.textops import NOT_SPACE, mix, shingle_sets, text_slices, tidy, words

SHINGLE_WORDS = 4
LEAST_PERCENT = 85
SKETCH_BITS = 20  # counters of the sketch; 1 MB is broadcast
SKETCH_CHUNK = 1 << 14
HOT_SHINGLE = 50_000  # above the sketch's mean; such regions aren't gathered in one task
LEAF = 4096  # members of a region that is compared in blocks, without more pivots
BLOCK = 512
ROWS_PER_BUCKET = 4000  # members that a task compares by sketches at a time, about
SHINGLES_PER_BLOCK = 400_000  # of the sets that are compared exactly
FIRST_PIVOTS = 16  # after a first level with one
MORE_PIVOTS = 4  # times as many from level to level
ODD_BITS = 4  # buckets of an odd sketch for each shingle
POSTINGS_PER_BUCKET = 300_000
SPREAD = 64

SETS_SCHEMA = "doc_id long, cls long, other long, n int, chunk int, counts binary"
LINK_SCHEMA = "a long, b long, d double"
POSTING_SCHEMA = "shingle long, cls long, n int, pos int, hot boolean"


def _sets(column: pa.Array, size: int, seed: int) -> Iterator[np.ndarray]:
    """The shingle set of every text, sorted."""
    for _, _, data, offsets in text_slices(column):
        for own in shingle_sets(words(data, offsets, NOT_SPACE), size):
            if seed:
                own = np.sort(mix(own ^ np.uint64(seed)))
            yield own


def _class_of(own: np.ndarray) -> tuple[int, int]:
    digest = blake2b(own.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(
        digest[8:], "little", signed=True
    )


def shingled(docs: DataFrame, size: int = SHINGLE_WORDS, seed: int = 0) -> DataFrame:
    """(doc_id, cls, other, n) of every document, and in other rows the chunks of the sketch.

    ``cls`` and ``other`` are the two halves of a hash of the set, null for an empty one.
    """

    def count(counters: np.ndarray, fresh: list[np.ndarray]) -> None:
        if fresh:
            marks = np.concatenate(fresh).astype(np.int64)
            counters += np.bincount(marks, minlength=1 << SKETCH_BITS).astype(np.uint32)
            fresh.clear()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << SKETCH_BITS, np.uint32)
        seen = set()
        for batch in batches:
            rows, fresh = [], []
            for own in _sets(batch.column("text"), size, seed):
                if not len(own):
                    rows.append((None, None, 0))
                    continue
                both = _class_of(own)
                rows.append((*both, len(own)))
                if both[0] not in seen:
                    seen.add(both[0])
                    fresh.append(own >> np.uint64(64 - SKETCH_BITS))
                if len(fresh) == 500:
                    count(counters, fresh)
            count(counters, fresh)
            if rows:
                columns = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32()))]
                nulls = [pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *columns, *nulls],
                    ["doc_id", "cls", "other", "n", "chunk", "counts"],
                )
        if seen:
            parts = counters.reshape(-1, SKETCH_CHUNK)
            m = len(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(m, pa.int64()),
                    pa.nulls(m, pa.int64()),
                    pa.nulls(m, pa.int64()),
                    pa.nulls(m, pa.int32()),
                    pa.array(np.arange(m, dtype=np.int32)),
                    pa.array([x.tobytes() for x in parts], pa.binary()),
                ],
                ["doc_id", "cls", "other", "n", "chunk", "counts"],
            )

    return own_columns(docs, "doc_id", "text").mapInArrow(cut, SETS_SCHEMA)


def _sketch(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each counter occur, in steps of a quarter power of two."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_CHUNK, np.int64)
        for counts in table["counts"]:
            total += np.frombuffer(counts.as_py(), np.uint32)
        return pa.table({"chunk": table["chunk"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    chunks = sets.where("chunk IS NOT NULL").select("chunk", "counts")
    total = np.zeros((1 << SKETCH_BITS) // SKETCH_CHUNK * SKETCH_CHUNK, np.int64)
    # A fixed number of rows of fixed length, whatever the corpus.
    for row in chunks.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect():
        total[row.chunk * SKETCH_CHUNK :][:SKETCH_CHUNK] = np.frombuffer(row.counts, np.int64)
    return total


def prefix_length(n: int, percent: int) -> int:
    """How many of the first shingles must be looked at, of a set of n."""
    return n - (percent * n + 99) // 100 + 1


def postings(docs: DataFrame, sets: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    """POSTING_SCHEMA: the regions of one-shingle pivots with at least two classes.

    Rows travel packed, one for each task's slice and bucket. In a bucket, shingles that only one
    class has are dropped. Rows of hot shingles go to buckets by class and pass through.
    """
    spark = docs.sparkSession
    counts = _sketch(sets)
    hot = HOT_SHINGLE + counts.mean()
    order = np.where(counts > 0, np.floor(4 * np.log2(np.maximum(counts, 1))), 0).astype(np.uint8)
    order[counts >= hot] = 255
    shared = spark.sparkContext.broadcast(order)
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(SPREAD, int(total * (100 - percent) / 100 / POSTINGS_PER_BUCKET) + 1)

    def emit(rows: list) -> Iterator[pa.RecordBatch]:
        shingles = np.concatenate([r[0] for r in rows])
        ranks = np.concatenate([r[1] for r in rows])
        lengths = [len(r[0]) for r in rows]
        cls = np.repeat(np.array([r[2] for r in rows], np.int64), lengths)
        n = np.repeat(np.array([r[3] for r in rows], np.int32), lengths)
        pos = np.concatenate([np.arange(x, dtype=np.int32) for x in lengths])
        own = ((shingles >> np.uint64(8)) % np.uint64(buckets)).astype(np.int32)
        own = np.where(ranks == 255, -1 - (cls % SPREAD).astype(np.int32), own)
        by = np.argsort(own, kind="stable")
        own = own[by]
        edges = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
        packed = [x[by] for x in (shingles.view(np.int64), cls, n, pos)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[edges[:-1]])]
            + [
                pa.array([x[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())
                for x in packed
            ],
            ["bucket", "shingle", "cls", "n", "pos"],
        )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, seen, rows, held = shared.value, set(), [], 0
        for batch in batches:
            for own in _sets(batch.column("text"), size, seed):
                if not len(own):
                    continue
                cls = _class_of(own)[0]
                if cls in seen:
                    continue
                seen.add(cls)
                rank = ranks[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                key = (rank.astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
                k = prefix_length(len(own), percent)
                first = np.argpartition(key, k - 1)[:k] if k < len(own) else np.arange(len(own))
                first = first[np.argsort(key[first], kind="stable")]
                rows.append((own[first], rank[first], cls, len(own)))
                held += k
                if held > 500_000:
                    yield from emit(rows)
                    rows, held = [], 0
        if rows:
            yield from emit(rows)

    def meet(table: pa.Table) -> pa.Table:
        kinds = (np.int64, np.int64, np.int32, np.int32)
        shingles, cls, n, pos = (
            np.frombuffer(b"".join(table[name].to_pylist()), kind)
            for name, kind in zip(("shingle", "cls", "n", "pos"), kinds)
        )
        hot = table["bucket"][0].as_py() < 0
        if not hot:
            by = np.lexsort((cls, shingles))
            same = (shingles[by][1:] == shingles[by][:-1]) & (cls[by][1:] == cls[by][:-1])
            by = by[np.concatenate(([True], ~same))]  # copies in several tasks
            _, which, many = np.unique(shingles[by], return_inverse=True, return_counts=True)
            by = by[many[which] > 1]
            shingles, cls, n, pos = (x[by] for x in (shingles, cls, n, pos))
        flag = np.full(len(n), hot)
        return pa.table({"shingle": shingles, "cls": cls, "n": n, "pos": pos, "hot": flag})

    packed = "bucket int, shingle binary, cls binary, n binary, pos binary"
    rows = own_columns(docs, "text").mapInArrow(cut, packed)
    return rows.groupBy("bucket").applyInArrow(tidy(meet), POSTING_SCHEMA)


def _of_classes(
    docs: DataFrame,
    wanted: DataFrame,
    size: int,
    seed: int,
    pack: Callable[[list[np.ndarray]], pa.Array],
    kind: str,
) -> DataFrame:
    """(cls, value) of the classes in ``wanted``, (rep, cls): each from its representative.

    ``pack`` makes the values of some sets, of the SQL type ``kind``. A row repeated with its id
    gives its class again.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes = batch.column("cls").to_pylist()
            own, held = [], 0
            for cls, shingles in zip(classes, _sets(batch.column("text"), size, seed)):
                # Other documents may share the representative's id.
                if len(shingles) and _class_of(shingles)[0] == cls:
                    own.append((cls, shingles))
                    held += len(shingles)
                if held > 500_000:
                    yield packed(own)
                    own, held = [], 0
            if own:
                yield packed(own)

    def packed(own: list) -> pa.RecordBatch:
        values = pack([x for _, x in own])
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in own]), values], ["cls", "value"])

    wanted = broadcast_if_few(wanted)
    rows = own_columns(docs, "doc_id", "text")
    rows = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["rep"]))
    return rows.select("cls", "text").mapInArrow(cut, f"cls long, value {kind}")


def _whole(sets: list[np.ndarray]) -> pa.Array:
    edges = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    flat = np.concatenate(sets).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))


def odd_sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the shingles by bucket, packed; a power of two of at least 4 * n buckets."""
    buckets = max(64, 1 << (ODD_BITS * len(own) - 1).bit_length())
    at = (own & np.uint64(buckets - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=buckets) & 1).astype(np.uint8), bitorder="little")


def _odd_sketches(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([odd_sketch(x).tobytes() for x in sets], pa.binary())


def least_difference(left: bytes, right: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their odd sketches.

    Buckets whose parities differ hold an element that only one set has. A larger sketch is
    folded to the size of the smaller one.
    """
    x, y = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    while len(x) != len(y):
        if len(x) > len(y):
            x, y = y, x
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _least_distances(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """(a, b, least): lower bounds of the distances of pairs."""

    def bound(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("_a"), batch.column("_b"))
            apart = np.array([least_difference(x.as_py(), y.as_py()) for x, y in sides], float)
            n = batch.column("_n").to_numpy() + batch.column("_m").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(2 * apart / (n + apart))],
                ["a", "b", "least"],
            )

    left = sketches.select(F.col("cls").alias("a"), F.col("n").alias("_n"), F.col("value").alias("_a"))
    right = sketches.select(F.col("cls").alias("b"), F.col("n").alias("_m"), F.col("value").alias("_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "_n", "_m", "_a", "_b")
    return rows.mapInArrow(bound, "a long, b long, least double").dropDuplicates(["a", "b"])


def _distances(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, d, linked): the exact distances of pairs."""
    left = sets.select(F.col("cls").alias("a"), F.col("value").alias("_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("value").alias("_b"))
    overlap = F.size(F.array_intersect("_a", "_b"))
    both, either = F.col("both"), F.col("either")
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", overlap.alias("both"), (F.size("_a") + F.size("_b")).alias("all"))
        .distinct()
        .withColumn("either", F.col("all") - both)
        .select("a", "b", (1 - both / either).alias("d"), (100 * both >= percent * either).alias("linked"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable by ``links`` (a, b), for all nodes of links.

    Alternating stars: every node's larger neighbours, then its smaller ones, are tied to
    its least neighbour, until nothing changes. Each step is a minimum by node and a join.
    """
    def tied(edges: DataFrame, name: str) -> DataFrame:
        """Edges with their larger node first, without loops."""
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        return stored(pairs.where("u != v").distinct(), name)

    def least(ways: DataFrame) -> DataFrame:
        return ways.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    def state(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = tied(links.select(F.col("a").alias("u"), F.col("b").alias("v")), "edges")
    before = state(edges)
    while True:
        ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = ways.join(least(ways), "u").where("v > u")
        large = tied(larger.select(F.col("v").alias("u"), F.col("m").alias("v")), "large")
        smallest = least(large)
        smaller = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = smallest.select("u", F.col("m").alias("v"))
        edges = tied(smaller.unionByName(own), "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _may_link(percent: int) -> Column:
    """Whether the sizes of a pair, and its places where it meets first, allow a link."""
    need = F.ceil(percent * (F.col("n") + F.col("n2")) / (100 + percent) - 1e-9)
    left = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    return (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2")) & (left >= need)


def _block_pairs(table: pa.Table) -> Iterator[np.ndarray]:
    """The rows of each pair of blocks, sorted by size, that are in more than one component."""
    rid, low, high, root, n = (table[x].to_numpy() for x in ("rid", "low", "high", "root", "n"))
    order = np.lexsort((n, high, low, rid))
    keys = np.stack([rid[order], low[order], high[order]])
    edges = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True])))
    for first, last in zip(edges[:-1], edges[1:]):
        rows = order[first:last]
        if (root[rows] != root[rows[0]]).any():
            yield rows


def _candidates(
    table: pa.Table, rows: np.ndarray, sketches: list[np.ndarray], percent: int, label: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): for each of the ``rows`` the ones behind it that may be linked to it and whose
    ``label`` differs, as of when they are asked for. By size, place and odd sketch."""
    own, n, pos, low, high = (table[x].to_numpy()[rows] for x in ("own", "n", "pos", "low", "high"))
    two = low[0] != high[0]
    sizes = n.astype(float)
    folded: dict[int, np.ndarray] = {}
    for i in range(len(rows)):
        # Sorted by size: partners are those behind that aren't too large.
        to = int(np.searchsorted(sizes, sizes[i] * 100 / percent + 1e-9, "right"))
        if to <= i + 1:
            continue
        need = np.ceil(percent * (sizes[i] + sizes[i + 1 : to]) / (100 + percent) - 1e-9)
        left = np.minimum(sizes[i] - pos[i], sizes[i + 1 : to] - pos[i + 1 : to])
        fits = (left >= need) & (label[i + 1 : to] != label[i])
        if two:
            fits &= own[i + 1 : to] != own[i]
        at = np.flatnonzero(fits) + i + 1
        if not len(at):
            continue
        width = len(sketches[i])
        if width not in folded:
            # Larger sets have sketches as wide or wider; those before are never used.
            folded[width] = _fold(sketches, width)
        apart = np.bitwise_count(folded[width][at] ^ folded[width][i]).sum(axis=1, dtype=float)
        least = 2 * apart / (sizes[i] + sizes[at] + apart)
        near = at[least <= (100 - percent) / 100 + 1e-9]
        if len(near):
            yield i, near


def _mark_block(percent: int) -> Callable[[pa.Table], pa.Table]:
    """A function from rows of regions' blocks to (rid, cls): those that may be linked to another."""

    def mark(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rid, cls, root = (table[x].to_numpy() for x in ("rid", "cls", "root"))
        found = []
        for rows in _block_pairs(table):
            sketches = [np.frombuffer(table["value"][int(r)].as_py(), np.uint64) for r in rows]
            marked = np.zeros(len(rows), bool)
            for i, near in _candidates(table, rows, sketches, percent, root[rows]):
                marked[i] = True
                marked[near] = True
            found.append(rows[marked])
        both = np.concatenate(found) if found else np.zeros(0, np.int64)
        both = np.unique(np.stack([rid[both], cls[both]], axis=1), axis=0) if len(both) else np.zeros((0, 2), np.int64)
        return pa.table([pa.array(both[:, 0]), pa.array(both[:, 1])], ["rid", "cls"])

    return tidy(mark)


def _link_block(percent: int) -> Callable[[pa.Table], pa.Table]:
    """A function from rows of regions' blocks, with their sets, to LINK_SCHEMA.

    Of each pair of blocks only links are given that join components which weren't joined yet,
    fewer than there are rows. Sets are intersected exactly.
    """

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cls, root = table["cls"].to_numpy(), table["root"].to_numpy()
        out: list[tuple[int, int, float]] = []
        for rows in _block_pairs(table):
            sets = [table["value"][int(r)].values.to_numpy().view(np.uint64) for r in rows]
            sketches = [odd_sketch(x).view(np.uint64) for x in sets]
            names, flat = np.unique(np.concatenate(sets), return_inverse=True)
            lengths = np.array([len(x) for x in sets])
            starts = np.cumsum(lengths) - lengths
            own = np.zeros(len(names), bool)
            label = np.unique(root[rows], return_inverse=True)[1]
            for i, near in _candidates(table, rows, sketches, percent, label):
                mine = flat[starts[i] : starts[i] + lengths[i]]
                own[mine] = True
                # Some at a time, so that what is gathered stays small.
                for a in range(0, len(near), 64):
                    some = near[a : a + 64]
                    some = some[label[some] != label[i]]
                    if not len(some):
                        continue
                    places = np.concatenate([np.arange(starts[k], starts[k] + lengths[k]) for k in some])
                    edges = np.cumsum(lengths[some]) - lengths[some]
                    both = np.add.reduceat(own[flat[places]].astype(np.int64), edges)
                    either = lengths[i] + lengths[some] - both
                    for k in np.flatnonzero(100 * both >= percent * either).tolist():
                        j = int(some[k])
                        if label[j] != label[i]:
                            label[label == label[j]] = label[i]
                            out.append((int(cls[rows[i]]), int(cls[rows[j]]), 1 - both[k] / either[k]))
                own[mine] = False
        columns = list(zip(*out)) if out else [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], ["a", "b", "d"])

    return tidy(link)


def _fold(sketches: list[np.ndarray], width: int) -> np.ndarray:
    """All sketches at ``width`` words; narrower ones as zeros."""
    out = np.zeros((len(sketches), width), np.uint64)
    for i, x in enumerate(sketches):
        if len(x) >= width:
            while len(x) > width:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            out[i] = x
    return out


class _Levels:
    """A join in regions, level by level.

    ``sketches`` is (cls, n, value) of all classes, ``fetch`` gives (cls, value), the sets, of
    the classes in a frame (cls).
    """

    def __init__(self, sketches: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int):
        self.sketches, self.fetch, self.percent = sketches, fetch, percent
        self.e = (100 - percent) / 100 + 1e-9  # on the safe side of rounding
        self.known: list[DataFrame] = []
        self.roots: DataFrame | None = None

    def verify(self, pairs: DataFrame, reach: float) -> DataFrame:
        """(a, b, d, linked) of pairs (a, b), and of all that were known before.

        Distances up to ``reach`` are exact, larger ones may be lower bounds above it: these come
        from sketches, and the sets of such pairs aren't fetched.
        """
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = pairs.where("a != b").distinct()
        if self.known:
            settled = F.col("exact") | (F.col("d") > reach)
            before = reduce(DataFrame.unionAll, self.known).where(settled).select("a", "b")
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        bounded = stored(_least_distances(stored(pairs, "pairs"), self.sketches), "bounds")
        far = F.col("least") > reach
        near = bounded.where(~far).select("a", "b")
        no = F.lit(False)
        self.known.append(
            bounded.where(far).select("a", "b", F.col("least").alias("d"), no.alias("linked"), no.alias("exact"))
        )
        classes = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        exact = _distances(near, self.fetch(stored(classes, "near")), self.percent)
        self.known.append(stored(exact.withColumn("exact", F.lit(True)), "distances"))
        return reduce(DataFrame.unionAll, self.known)

    def links(self) -> DataFrame:
        return reduce(DataFrame.unionAll, self.known).where("linked").select("a", "b")

    def connect(self, fresh: DataFrame) -> None:
        """The components of the links so far, with the number of their classes, if any of the
        ``fresh`` pairs are linked."""
        if not fresh.where("linked").limit(1).count() and self.roots is not None:
            return
        roots = stored(components(self.links()), "roots")
        sizes = roots.groupBy("root").agg(F.count("*").alias("weight"))
        self.roots = stored(roots.join(sizes, "root").withColumnRenamed("node", "cls"), "weighed")

    def unfinished(self, members: DataFrame) -> DataFrame:
        """The members of regions with several components, with their root, their region's size
        and the root of its largest component."""
        members = members.select("rid", "cls", "n", "pos")
        if self.roots is None:
            labelled = members.withColumns({"root": F.col("cls"), "weight": F.lit(1).cast("long")})
        else:
            labelled = members.join(broadcast_if_few(self.roots), "cls", "left").withColumns(
                {"root": F.coalesce("root", "cls"), "weight": F.coalesce("weight", F.lit(1))}
            )
        sums = [
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("cls")).alias("_s1"),
            F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("_s2"),
        ]
        by_region = labelled.groupBy("rid")
        if self.roots is None:
            open_ = by_region.agg(*sums).where("size > 1").withColumn("main", F.lit(None).cast("long"))
        else:
            main = F.max(F.struct("weight", "root"))["root"].alias("main")
            least, most = F.min("root").alias("_r1"), F.max("root").alias("_r2")
            open_ = by_region.agg(*sums, main, least, most).where("_r1 != _r2")
        open_ = (
            open_
            # Near copies share many regions with the same members: one of each is enough.
            .groupBy("_s1", "_s2", "size", "main")
            .agg(F.min("rid").alias("rid"), F.count("*").alias("same"))
            .drop("_s1", "_s2")
        )
        # Places are those in one region, so merged ones go without them.
        pos = F.when(F.col("same") > 1, 0).otherwise(F.col("pos"))
        members = labelled.drop("weight").join(open_, "rid").withColumn("pos", pos).drop("same")
        return stored(members, "members")

    def join_blocks(self, members: DataFrame) -> None:
        """Find what links the components of regions, each in blocks of bounded size.

        Tasks compare two blocks by their odd sketches and mark the members that may be linked to
        one of another component. Only the sets of these travel, and the tasks that compare them
        intersect the sets and keep the components joined, so a pair of blocks gives fewer links
        than it has members, however many of its pairs look alike.
        """
        members = self.unfinished(members)
        if not members.limit(1).count():
            return
        few = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        rows = self.in_blocks(few, self.sketches.drop("n"), members.count() // ROWS_PER_BUCKET + 1)
        marked = stored(
            rows.groupBy("bucket").applyInArrow(_mark_block(self.percent), "rid long, cls long").distinct(),
            "marked",
        )
        # Regions whose marked members are the same need one look only.
        sums = [
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("cls")).alias("_s1"),
            F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("_s2"),
        ]
        once = marked.groupBy("rid").agg(*sums).groupBy("_s1", "_s2", "size").agg(
            F.min("rid").alias("rid"), F.count("*").alias("same")
        )
        left = marked.join(once.select("rid", "size", "same"), "rid")
        left = left.join(members.select("rid", "cls", "n", "pos", "root"), ["rid", "cls"])
        # Places are those in one region, so merged ones go without them.
        left = stored(left.withColumn("pos", F.when(F.col("same") > 1, 0).otherwise(F.col("pos"))), "left")
        if not left.limit(1).count():
            return
        sets = self.fetch(stored(left.select("cls").distinct(), "near"))
        # Blocks and buckets of a bounded number of shingles, however long the sets are.
        weights = left.groupBy("rid").agg(F.sum("n").alias("weight"))
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("weight") / SHINGLES_PER_BLOCK))
        left = left.join(weights, "rid").withColumn("blocks", blocks.cast("int"))
        total = left.agg(F.sum(F.col("blocks") * F.col("n"))).first()[0]
        rows = self.in_blocks(left, sets, total // (2 * SHINGLES_PER_BLOCK) + 1)
        found = rows.groupBy("bucket").applyInArrow(_link_block(self.percent), LINK_SCHEMA)
        yes = F.lit(True)
        found = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d").distinct()
        self.known.append(stored(found.select("*", yes.alias("linked"), yes.alias("exact")), "links"))
        self.connect(self.known[-1])

    def in_blocks(self, members: DataFrame, values: DataFrame, buckets: int) -> DataFrame:
        """Members with the ``values`` (cls, value) of their classes, once for each pair of their
        region's blocks that they belong to, in buckets for tasks."""
        blocks = F.col("blocks")
        own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
        others = F.sequence(F.lit(0), blocks - 1)
        rows = members.join(values, "cls").withColumns({"own": own, "other": F.explode(others)})
        rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64("rid", "low", "high"), F.lit(buckets)))
        return rows.select("bucket", "rid", "low", "high", "own", "cls", "root", "n", "pos", "value")

    def choose(self, members: DataFrame, k: int) -> DataFrame:
        """(rid, pivot, n2, pos2): ``k`` members of each region, those outside its main component first.

        The order is the same in all regions, so sets that share several regions have few pivots.
        """
        main = F.col("root") == F.col("main") if self.roots is not None else F.lit(False)
        order = Window.partitionBy("rid").orderBy(main, F.xxhash64("cls"), "cls")
        return stored(
            members.withColumn("_rank", F.row_number().over(order))
            .where(F.col("_rank") <= k)
            .select("rid", F.col("cls").alias("pivot"), F.col("n").alias("n2"), F.col("pos").alias("pos2")),
            "pivots",
        )

    def split(self, members: DataFrame, chosen: DataFrame, known: DataFrame) -> DataFrame:
        """The Voronoi regions of the pivots with their windows, and the outer regions."""
        e, columns = self.e, ["rid", "cls", "n", "pos"]
        away = members.join(broadcast_if_few(chosen), "rid").select(
            *columns,
            "size",
            "pivot",
            F.least("cls", "pivot").alias("a"),
            F.greatest("cls", "pivot").alias("b"),
        )
        homes = (
            # A pair may have a lower bound from before as well; the exact distance is larger.
            away.join(known.groupBy("a", "b").agg(F.max("d").alias("d")), ["a", "b"])
            .groupBy(*columns, "size")
            .agg(F.min("d").alias("home"), F.collect_list(F.struct("d", "pivot")).alias("all"))
        )
        home = F.col("home")
        near = F.filter(
            "all", lambda p: (home <= 2 * e) & (p["d"] <= home + 2 * e) & (p["d"] <= 3 * e)
        )
        outer = F.array(F.xxhash64("rid", F.lit("outer")))
        regions = F.concat(
            F.transform(near, lambda p: F.xxhash64(F.col("rid"), p["pivot"])),
            F.when(home > e, outer).otherwise(F.array().cast("array<long>")),
        )
        homes = stored(homes.select(*columns, "size", regions.alias("regions")), "homes")
        # Regions whose parts together would be more than twice as large stay as they are.
        kept = homes.groupBy("rid", "size").agg(F.sum(F.size("regions")).alias("parts"))
        kept = kept.select("rid", (F.col("parts") > 2 * F.col("size")).alias("kept"))
        parts = F.when(F.col("kept"), F.array("rid")).otherwise(F.col("regions"))
        return homes.join(kept, "rid").select(F.explode(parts).alias("rid"), "cls", "n", "pos")

    def meet_pivots(self, members: DataFrame, k: int, reach: float) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Compare the members of each region with ``k`` pivots, which are done then.

        Returns the members that are left in unfinished regions, the pivots, and what is known.
        """
        chosen = self.choose(members, k)
        met = members.join(broadcast_if_few(chosen), "rid")
        if reach <= self.e:  # then only links are asked for
            met = met.where(_may_link(self.percent))
        known = self.verify(met.select(F.col("cls").alias("a"), F.col("pivot").alias("b")), reach)
        self.connect(self.known[-1])
        done = broadcast_if_few(chosen.select("rid", F.col("pivot").alias("cls")))
        rest = members.join(done, ["rid", "cls"], "left_anti").select("rid", "cls", "n", "pos")
        return self.unfinished(rest), chosen, known

    def run(self, members: DataFrame, leaf: int, pivots: int) -> None:
        # First a single pivot in each region: that connects most copies.
        members, _, _ = self.meet_pivots(self.unfinished(members), 1, self.e)
        while members.limit(1).count():
            self.join_blocks(members.where(F.col("size") <= leaf))
            large = members.where(F.col("size") > leaf)
            if not large.limit(1).count():
                break
            rest, chosen, known = self.meet_pivots(large, pivots, 3 * self.e)
            members = self.unfinished(self.split(rest, chosen, known))
            pivots *= MORE_PIVOTS


def similarity_join(
    docs: DataFrame,
    percent: int = LEAST_PERCENT,
    size: int = SHINGLE_WORDS,
    leaf: int = LEAF,
    pivots: int = FIRST_PIVOTS,
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, component_id, copies) of (doc_id, text), and the links (a, b) found.

    ``copies`` is the number of documents with an equal set; links are between the smallest ids
    of such documents.
    """
    small_batches(docs.sparkSession)
    for seed in range(10):
        sets = stored(shingled(docs, size, seed), "sets")
        rows = sets.where("chunk IS NULL").select("doc_id", "cls", "other", "n")
        classes = stored(
            rows.where("cls IS NOT NULL")
            .groupBy("cls")
            .agg(
                F.min("doc_id").alias("rep"),
                F.first("n").alias("n"),
                F.count("*").alias("copies"),
                (F.min("other") != F.max("other")).alias("clash"),
            ),
            "classes",
        )
        if not classes.where("clash").limit(1).count():
            break
    regions = stored(postings(docs, sets, size, percent, seed), "postings")
    members = regions.where("NOT hot").select(F.col("shingle").alias("rid"), "cls", "n", "pos")
    if regions.where("hot").limit(1).count():
        # Copies in several tasks were not met in a bucket.
        hot = regions.where("hot").select(F.col("shingle").alias("rid"), "cls", "n", "pos")
        members = members.unionByName(hot.dropDuplicates(["rid", "cls"]))
    def made(of: DataFrame, pack, kind: str, name: str) -> DataFrame:
        wanted = stored(classes.join(of, "cls").select("rep", "cls"), "wanted")
        return stored(_of_classes(docs, wanted, size, seed, pack, kind), name)

    sketches = made(members.select("cls").distinct(), _odd_sketches, "binary", "sketches")
    sketches = sketches.join(classes.select("cls", "n"), "cls")
    levels = _Levels(
        stored(sketches, "sized"), lambda of: made(of, _whole, "array<long>", "class_sets"), percent
    )
    levels.run(members, leaf, pivots)
    if levels.roots is None:
        known = classes.select("cls", "copies", F.col("rep").alias("component_id"))
        links = docs.sparkSession.createDataFrame([], "a long, b long")
    else:
        rooted = classes.join(levels.roots.select("cls", "root"), "cls", "left").withColumn(
            "root", F.coalesce("root", "cls")
        )
        least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
        known = rooted.join(least, "root").select("cls", "copies", "component_id")
        reps = classes.select("cls", "rep")
        a, b = (reps.select(F.col("cls").alias(x), F.col("rep").alias(f"_{x}")) for x in "ab")
        links = levels.links().join(a, "a").join(b, "b")
        links = links.select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    known = broadcast_if_few(stored(known.withColumnRenamed("cls", "_cls"), "known"))
    labelled = rows.join(known, rows["cls"] == F.col("_cls"), "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
    )
    return labelled, links


def one_of_each_group(
    docs: DataFrame, percent: int = LEAST_PERCENT, size: int = SHINGLE_WORDS
) -> DataFrame:
    """The rows of ``docs`` without those that are linked to a document with a smaller id.

    Of rows repeated with their id and text one stays; rows without an id all stay.
    """
    labelled, _ = similarity_join(docs, percent, size)
    labelled = stored(labelled, "labelled")
    gone = stored(labelled.where("doc_id != component_id").select("doc_id").distinct(), "gone")
    if labelled.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        keyed = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
        docs = keyed.unionByName(docs.where("doc_id IS NULL"))
    return docs.join(broadcast_if_few(gone), "doc_id", "left_anti").select(*all_columns(docs))
