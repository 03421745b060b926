"""Fill-in-the-middle transformation of texts, cut by an indexable skip list.

A text is a sequence of units (runs of letters, and all other characters one by one). Its skip list
has the units in its lowest lane and in each higher one about a quarter of the nodes below; every
node carries the distance to the next one of its lane, in units and in code points. The descent to
a rank goes along a lane while the next node isn't beyond, then one lane down, and adds up both
widths; so it arrives at a unit and at its code point at the same time.

Documents with marks of their own in the text, empty ones and a stated share stay plain, so that
all outputs can be read back exactly.

Edge cases: a null text is empty; a null id is hashed as an empty one; repeated rows give the same
result each; an empty table gives no rows; other columns are ignored, whatever their names. A text
is one row and must fit into a task; the lists of at most some megabytes of texts, or of one text,
are built at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import own_columns, small_batches
from daymark.llm.textops import text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10
SUFFIX_FIRST_PERCENT = 20  # of those that aren't plain
LANE_STEP = 4  # of so many nodes, one is in the next lane, about
OUTPUT_BYTES = 8_000_000  # of a record batch, about

FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
_FIRST_BYTE = (_BYTES & 0xC0) != 0x80  # of a code point


class SkipList:
    """Units of known lengths, found by rank or by code point in logarithmic time."""

    def __init__(self, lengths: np.ndarray):
        """``lengths`` are the code points of each unit."""
        self.units = len(lengths)
        # Node 0 is the head, before the first unit; node i + 1 ends unit i.
        widths = np.asarray(lengths, np.int64)
        units = np.ones(self.units, np.int64)
        nodes = np.arange(self.units + 1, dtype=np.uint64)
        # Per lane: units and code points to the next node, and the node's place one lane below.
        self.lanes: list[tuple[list[int], list[int], list[int]]] = []
        below = np.arange(self.units + 1)
        level = 1
        while True:
            self.lanes.append((units.tolist(), widths.tolist(), below.tolist()))
            if len(nodes) <= 2 * LANE_STEP:
                break
            kept = _promoted(nodes, level)
            kept[0] = True
            below = np.flatnonzero(kept)
            # What lies behind the last node of a lane is reached one lane down.
            ends = below[-1]
            units = np.add.reduceat(units[:ends], below[:-1]) if len(below) > 1 else units[:0]
            widths = np.add.reduceat(widths[:ends], below[:-1]) if len(below) > 1 else widths[:0]
            nodes, level = nodes[kept], level + 1

    def descend(self, rank: int, by_points: bool = False) -> tuple[int, int]:
        """(units, code points) before the cut of the given rank.

        With ``by_points`` the rank is in code points, and the cut is at the last unit that
        begins there or before.
        """
        at = passed_units = passed_points = 0
        for units, points, below in reversed(self.lanes):
            measure, passed = (points, passed_points) if by_points else (units, passed_units)
            while at < len(measure) and passed + measure[at] <= rank:
                passed += measure[at]
                passed_units += units[at]
                passed_points += points[at]
                at += 1
            at = below[at]
        return passed_units, passed_points


def _promoted(nodes: np.ndarray, level: int) -> np.ndarray:
    """Which nodes are in the lane of this level as well: by a hash, alike in every run."""
    salt = np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)
    x = (nodes + salt) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(40)) % np.uint64(LANE_STEP) == 0


def unit_lengths(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The code points of every unit, for each text of a slice."""
    letter, first = _LETTER[data], _FIRST_BYTE[data]
    begins = first & ~letter
    begins |= letter & ~np.concatenate(([False], letter[:-1]))
    starts = offsets[:-1][offsets[:-1] < len(data)]
    begins[starts] = True
    points = np.concatenate(([0], np.cumsum(first)))
    at = np.flatnonzero(begins)
    edges = np.searchsorted(at, offsets)
    before = points[at]
    for i, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        yield np.diff(np.append(before[a:b], points[offsets[i + 1]]))


def rearranged(text: str, lengths: np.ndarray, h: tuple[int, int, int, int]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of a text by its four hash numbers."""
    n = len(lengths)
    marked = any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not n or marked or h[2] % 100 >= 100 - PLAIN_PERCENT:
        return n, "plain", None, None, text
    units = SkipList(lengths)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = units.descend(low)[1], units.descend(high)[1]
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _hash_numbers(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)
    ]


def transform(docs: DataFrame, seed: int = 1) -> DataFrame:
    """FIELDS of (doc_id, text): the text rearranged, or left plain."""
    small_batches(docs.sparkSession)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = [field.split()[0] for field in FIELDS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            ids = batch.column("doc_id")
            hashes = [batch.column(f"h{k}") for k in (1, 2, 3, 4)]
            rows, held = [], 0
            for first, last, data, offsets in text_slices(column):
                texts = column.slice(first, last - first).to_pylist()
                for i, lengths in enumerate(unit_lengths(data, offsets)):
                    h = tuple(x[first + i].as_py() for x in hashes)
                    rows.append((ids[first + i].as_py(), *rearranged(texts[i] or "", lengths, h)))
                    held += int(offsets[i + 1] - offsets[i])
                    if held > OUTPUT_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
            if rows:
                yield batch_of(rows)

    rows = own_columns(docs, "doc_id", "text")
    rows = rows.select(F.col("doc_id").cast("long"), "text", *_hash_numbers(F.col("doc_id"), seed))
    return rows.mapInArrow(cut, FIELDS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of: the marks are found, and the parts put in order."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    psm = F.split(body, f"{SUFFIX}|{MIDDLE}", 3)
    spm = F.split(body, f"{PREFIX}|{MIDDLE}", 3)
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )
