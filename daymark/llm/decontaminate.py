"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` cuts the documents into shards of bounded size and stores, for every shard and
term, the sorted places of the term in the shard: its posting list. Documents lie one behind the
other in a shard, with a place left free between them. A row without a term is the shard's
directory: its documents and where each begins.

``search`` looks for the windows of test items. Only posting lists of terms that the items have
are read; each shard's lists meet in one task. A window's lists are shifted by the term's offset
in the window and intersected, from the shard's rarest term on, until none is left: what remains
are the exact occurrences. With ``slack``, a window is found where all its terms lie, in any
order, within so many more words than it has. Items are searched in blocks of bounded size, so
what is broadcast doesn't grow.

No list is larger than its shard, and a shard is no larger than a bound or one document, whatever
the frequency of a term. Terms are compared by 64-bit hashes.

Edge cases: a null or empty text has no words and is a document without hits, or an item
without windows; an item with fewer words than a window is one window; repeated documents are
documents each; items that share an id are one item; a null id is an item or document like
others; an empty table of either kind finds nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import (
    all_columns,
    broadcast_if_few,
    own_columns,
    small_batches,
    stored,
)
from daymark.llm.textops import ALPHANUMERIC, text_slices, tidy, words

WINDOW = 13
SHARD_WORDS = 1_000_000
BLOCK_WORDS = 200_000  # of test items that are searched at once

INDEX_SCHEMA = (
    "shard long, term long, places array<int>, doc_ids array<long>, first array<int>, "
    "counts array<int>"
)
FOUND_SCHEMA = (
    "shard long, doc_no int, doc_id long, n_words long, "
    "runs array<struct<start:int,end:int>>, items array<long>, null_item boolean"
)
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())


def _lists(flat: np.ndarray, edges: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat, kind))


def _shard(number: int, ids: list, counts: list[np.ndarray], hashes: list[np.ndarray]):
    """The rows of one shard."""
    n_words = np.concatenate(counts).astype(np.int32)
    first = np.zeros(len(n_words), np.int32)
    np.cumsum(n_words[:-1] + 1, out=first[1:])
    terms = np.concatenate(hashes).view(np.int64)
    places = np.arange(len(terms), dtype=np.int32)
    places += np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)
    order = np.argsort(terms, kind="stable")
    terms, places = terms[order], places[order]
    edges = np.flatnonzero(np.concatenate(([True], terms[1:] != terms[:-1], [True])))
    if not len(terms):
        edges = np.zeros(1, np.int64)
    n = len(edges) - 1
    step = 20_000
    for at in range(0, n, step):
        own = edges[at : at + step + 1]
        m = len(own) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(m, number)),
                pa.array(terms[own[:-1]]),
                _lists(places[own[0] : own[-1]], own - own[0], pa.int32()),
                pa.nulls(m, _LONGS),
                pa.nulls(m, _INTS),
                pa.nulls(m, _INTS),
            ],
            ["shard", "term", "places", "doc_ids", "first", "counts"],
        )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.nulls(1, pa.int64()),
            pa.nulls(1, _INTS),
            pa.array([ids], _LONGS),
            pa.array([first], _INTS),
            pa.array([n_words], _INTS),
        ],
        ["shard", "term", "places", "doc_ids", "first", "counts"],
    )


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index of (doc_id, text), as INDEX_SCHEMA has it."""

    small_batches(docs.sparkSession)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shards are only told apart, so what they are numbered from may differ between runs.
        number = TaskContext.get().partitionId() << 32
        ids, counts, hashes, size = [], [], [], 0
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, last, data, offsets in text_slices(batch.column("text")):
                found = words(data, offsets, ALPHANUMERIC)
                ids += doc_ids[first:last].to_pylist()
                counts.append(np.diff(found.first))
                hashes.append(found.hashes)
                size += len(found.hashes)
                if size >= shard_words:
                    yield from _shard(number, ids, counts, hashes)
                    ids, counts, hashes, size = [], [], [], 0
                    number += 1
        if ids:
            yield from _shard(number, ids, counts, hashes)

    return stored(own_columns(docs, "doc_id", "text").mapInArrow(index, INDEX_SCHEMA), "index")


def _item_words(items: DataFrame) -> DataFrame:
    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_slices(batch.column("text")):
                found = words(data, offsets, ALPHANUMERIC)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id")[first:last],
                        _lists(found.hashes.view(np.int64), found.first, pa.int64()),
                    ],
                    ["item_id", "terms"],
                )

    cut_items = own_columns(items, "item_id", "text").mapInArrow(
        cut, "item_id long, terms array<long>"
    )
    return cut_items.where(F.size("terms") > 0)


class Postings:
    """The posting lists of one shard that a search needs."""

    def __init__(self, terms: np.ndarray, edges: np.ndarray, places: np.ndarray):
        order = np.argsort(terms)
        self.terms, self.starts, self.ends = terms[order], edges[:-1][order], edges[1:][order]
        self.places = places

    def ranges(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the lists of ``terms`` start and end; empty ranges for unknown terms."""
        if not len(self.terms):
            return np.zeros((2, len(terms)), np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        known = self.terms[at] == terms
        return np.where(known, self.starts[at], 0), np.where(known, self.ends[at], 0)

    def phrase(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The places where the terms with these ranges follow one another."""
        by_rarity = np.argsort(ends - starts, kind="stable")
        k = by_rarity[0]
        found = self.places[starts[k] : ends[k]] - k
        for k in by_rarity[1:]:
            own = self.places[starts[k] : ends[k]]
            at = np.minimum(np.searchsorted(own, found + k), len(own) - 1)
            found = found[own[at] == found + k]
            if not len(found):
                break
        return found

    def spans(self, starts: np.ndarray, ends: np.ndarray, width: int) -> list[tuple[int, int]]:
        """The shortest spans of at most ``width`` places that hold all the terms."""
        by_rarity = np.argsort(ends - starts, kind="stable")
        anchors = self.places[starts[by_rarity[0]] : ends[by_rarity[0]]]
        for k in by_rarity[1:]:
            own = self.places[starts[k] : ends[k]]
            low = np.searchsorted(own, anchors - width + 1)
            anchors = anchors[low < np.searchsorted(own, anchors + width)]
        found = set()
        for anchor in anchors.tolist():
            near = []
            for k in range(len(starts)):
                own = self.places[starts[k] : ends[k]]
                low, high = np.searchsorted(own, [anchor - width + 1, anchor + width])
                near += [(place, k) for place in own[low:high].tolist()]
            near.sort()
            last: dict[int, int] = {}
            for place, k in near:
                # Else a shorter span ended before, at another place of this term.
                needed = k not in last or last[k] == min(last.values())
                last[k] = place
                if needed and len(last) == len(starts) and place - min(last.values()) < width:
                    found.add((min(last.values()), place + 1))
        return sorted(found)


def _occurrences(
    postings: Postings, terms: np.ndarray, size: int, slack: int | None
) -> Iterator[tuple[int, int]]:
    """Spans of places at which windows of an item occur."""
    starts, ends = postings.ranges(terms)
    size = min(size, len(terms))
    known = np.lib.stride_tricks.sliding_window_view(ends > starts, size).all(axis=1)
    for at in np.flatnonzero(known).tolist():
        own = slice(at, at + size)
        if slack is None:
            for place in postings.phrase(starts[own], ends[own]).tolist():
                yield place, place + size
        else:
            _, distinct = np.unique(terms[own], return_index=True)
            yield from postings.spans(starts[own][distinct], ends[own][distinct], size + slack)


def search_shard(
    table: pa.Table, items: list[tuple[int | None, np.ndarray]], size: int, slack: int | None
) -> pa.Table:
    """All documents of a shard, with runs of hit words and the items found."""
    table = table.combine_chunks()
    lists = table.filter(pc.is_valid(table["term"])).combine_chunks()
    directory = table.filter(pc.is_null(table["term"])).to_pylist()[0]
    first, counts = np.array(directory["first"]), np.array(directory["counts"])
    if len(lists):
        places = lists["places"].combine_chunks()
        places = places.chunk(0) if isinstance(places, pa.ChunkedArray) else places
        edges = places.offsets.to_numpy().astype(np.int64)
        flat = places.values.to_numpy()
        postings = Postings(lists["term"].to_numpy(), edges, flat)
    else:
        postings = Postings(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int32))
    hits: dict[int, set] = {}
    spans: dict[int, set] = {}
    for item_id, terms in items:
        for start, end in _occurrences(postings, terms, size, slack):
            doc = int(np.searchsorted(first, start, "right")) - 1
            if end > first[doc] + counts[doc]:
                continue  # a loose span that reaches into the next document
            hits.setdefault(doc, set()).add(item_id)
            spans.setdefault(doc, set()).add((start - int(first[doc]), end - int(first[doc])))
    runs = []
    for doc in range(len(first)):
        merged: list[list[int]] = []
        for start, end in sorted(spans.get(doc, ())):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        runs.append([{"start": a, "end": b} for a, b in merged])
    n = len(first)
    run = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    found = [hits.get(doc, ()) for doc in range(n)]
    return pa.table(
        {
            "shard": pa.array([directory["shard"]] * n, pa.int64()),
            "doc_no": pa.array(range(n), pa.int32()),
            "doc_id": pa.array(directory["doc_ids"], pa.int64()),
            "n_words": pa.array(counts, pa.int64()),
            "runs": pa.array(runs, pa.list_(run)),
            "items": pa.array([[x for x in ids if x is not None] for ids in found], _LONGS),
            "null_item": pa.array([None in ids for ids in found], pa.bool_()),
        }
    )


def _items(table: pa.Table) -> list[tuple[int | None, np.ndarray]]:
    """(item_id, terms) of some rows."""
    return [(r["item_id"], np.array(r["terms"], np.int64)) for r in table.select(["item_id", "terms"]).to_pylist()]


def _search_at_once(index: DataFrame, cut: DataFrame, size: int, slack: int | None) -> DataFrame:
    """FOUND_SCHEMA for items of a bounded number of words, which all tasks get."""
    spark = index.sparkSession
    block = _items(cut.toArrow())
    terms = sorted({t for _, own in block for t in own.tolist()})
    asked = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term long"))
    lists = index.where("term IS NOT NULL").join(asked, "term", "left_semi")
    needed = lists.select(*index.columns).unionByName(index.where("term IS NULL"))
    shared = spark.sparkContext.broadcast(block)

    def look(table: pa.Table) -> pa.Table:
        return search_shard(table, shared.value, size, slack)

    return needed.groupBy("shard").applyInArrow(tidy(look), FOUND_SCHEMA)


def _search_in_blocks(
    index: DataFrame, cut: DataFrame, blocks: int, size: int, slack: int | None
) -> DataFrame:
    """FOUND_SCHEMA, a row for each document and block of items.

    A task meets one shard's lists of the terms of one block with the items of that block; nothing
    of the items passes through the driver.
    """
    number = F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)).cast("int")
    items = stored(cut.withColumn("block", number), "blocks")
    asked = stored(items.select("block", F.explode("terms").alias("term")).distinct(), "asked")
    lists = index.where("term IS NOT NULL").join(broadcast_if_few(asked), "term")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    directory = index.where("term IS NULL").withColumn("block", every)
    needed = lists.select(*index.columns, "block").unionByName(directory)
    met = items.join(broadcast_if_few(stored(directory.select("shard", "block"), "pairs")), "block")

    def look(table: pa.Table, own: pa.Table) -> pa.Table:
        return search_shard(table.drop_columns(["block"]), _items(own), size, slack)

    return (
        needed.groupBy("shard", "block")
        .cogroup(met.groupBy("shard", "block"))
        .applyInArrow(tidy(look), FOUND_SCHEMA)
    )


def search(
    index: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slack: int | None = None,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every document of the index with the runs of its words that windows of ``items`` hit.

    ``items`` is (item_id, text). As FOUND_SCHEMA: runs count words from the document's start.
    """
    cut = stored(_item_words(items), "items")
    total = cut.agg(F.sum(F.size("terms"))).first()[0]
    if not total:
        none = index.sparkSession.createDataFrame([], FOUND_SCHEMA)
        listed = index.where("term IS NULL").select(
            "shard", F.posexplode(F.arrays_zip("doc_ids", "counts")).alias("doc_no", "doc")
        )
        return none.unionByName(
            listed.select(
                "shard",
                "doc_no",
                F.col("doc.doc_ids").alias("doc_id"),
                F.col("doc.counts").cast("long").alias("n_words"),
                F.array().cast("array<struct<start:int,end:int>>").alias("runs"),
                F.array().cast("array<long>").alias("items"),
                F.lit(False).alias("null_item"),
            )
        )
    if total <= block_words:
        return _search_at_once(index, cut, window, slack)
    return (
        _search_in_blocks(index, cut, -(-total // block_words), window, slack)
        .groupBy("shard", "doc_no", "doc_id", "n_words")
        .agg(
            F.flatten(F.collect_list("runs")).alias("runs"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.bool_or("null_item").alias("null_item"),
        )
    )


def covered(runs: Column | str) -> Column:
    """How many words the runs cover together; they may overlap."""
    zero = F.lit(0).cast("long")
    state = F.struct(zero.alias("n"), zero.alias("to"))
    total = F.aggregate(
        F.array_sort(runs),
        state,
        lambda s, r: F.struct(
            (s["n"] + F.greatest(r["end"] - F.greatest(s["to"], r["start"]), zero)).alias("n"),
            F.greatest(s["to"], r["end"].cast("long")).alias("to"),
        ),
    )
    return total["n"]


def contamination(found: DataFrame, share: int = 20) -> DataFrame:
    """Documents with their hit words and items; contaminated from 1 / ``share`` of the words on."""
    counted = found.select(
        "doc_id",
        "n_words",
        covered("runs").alias("n_hit"),
        (F.size("items") + F.col("null_item").cast("int")).cast("long").alias("n_items"),
        "items",
    )
    n_hit = F.col("n_hit")
    return counted.withColumn(
        "contaminated", (n_hit > 0) & (n_hit * share >= F.col("n_words"))
    )


def clean(docs: DataFrame, items: DataFrame, share: int = 20) -> DataFrame:
    """The rows of ``docs`` without contaminated documents; rows without an id all stay."""
    found = contamination(search(build_index(docs), items), share)
    gone = stored(found.where("contaminated").select("doc_id").distinct(), "contaminated")
    return docs.join(broadcast_if_few(gone), "doc_id", "left_anti").select(*all_columns(docs))
