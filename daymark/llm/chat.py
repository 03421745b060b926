"""Chat formatting: whole conversations as token ids with a loss mask over the assistant's texts.

A conversation becomes one text, ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn. The
three control strings are tokens of their own. ``<|`` in a role or text gets a backslash between
its two characters (one more where it has some), so texts never hold a control string and can be
read back exactly. The text is encoded once with character offsets. Turns and tokens are sorted
spans of it, and binary search gives the tokens that each assistant text covers: these have
loss. As control strings are tokens, no token reaches from a text into what stands beside it.

Edge cases: a null text or role is an empty one; a null ``conv_id`` is a conversation of its own;
turns with the same number are ordered by role and text, a null number comes first, and repeated
rows are turns each; an empty table gives no rows; other columns are ignored. One conversation is
one row of the result, so it must fit into a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import own_columns

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
LEARNED = "assistant"
BATCH_CHARS = 2_000_000
SCHEMA = (
    "conv_id long, formatted string, token_ids array<int>, token_starts array<int>, "
    "token_ends array<int>, loss_mask array<boolean>"
)
READ_SCHEMA = (
    "conv_id long, turns array<struct<role:string,text:string>>, losses array<string>, "
    "formatted_chars long"
)

_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans in it of the texts that are learned."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == LEARNED:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def loss_mask(
    starts: np.ndarray, ends: np.ndarray, spans: Iterable[tuple[int, int]]
) -> np.ndarray:
    """Which of the tokens, sorted by place, share a character with one of the spans."""
    mask = np.zeros(len(starts), bool)
    for first, last in spans:
        if last > first:
            mask[np.searchsorted(ends, first, "right") : np.searchsorted(starts, last)] = True
    return mask


_tokenizers: dict[str, object] = {}


def tokenizer(path: str):
    """The byte-level tokenizer in a file, with the control strings as tokens; kept by worker."""
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on each core
        from tokenizers import Tokenizer, processors

        made = Tokenizer.from_file(path)
        made.post_processor = processors.ByteLevel(trim_offsets=False)
        made.add_special_tokens([START, SEP, END])
        _tokenizers[path] = made
    return _tokenizers[path]


def format_conversations(conversations: DataFrame, tokenizer_path: str = TOKENIZER) -> DataFrame:
    """One row per conversation, as SCHEMA has it; offsets count characters."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path)
        fields = pa.schema(
            [
                ("conv_id", pa.int64()),
                ("formatted", pa.string()),
                ("token_ids", pa.list_(pa.int32())),
                ("token_starts", pa.list_(pa.int32())),
                ("token_ends", pa.list_(pa.int32())),
                ("loss_mask", pa.list_(pa.bool_())),
            ]
        )

        def made(rows):
            arrays = [pa.array(x, f.type) for x, f in zip(zip(*rows), fields)]
            return pa.RecordBatch.from_arrays(arrays, schema=fields)

        for batch in batches:
            rows, chars = [], 0
            for conv_id, turns in zip(batch.column("conv_id"), batch.column("turns")):
                formatted, spans = render((x["role"], x["text"]) for x in turns.as_py())
                encoded = encoder.encode(formatted, add_special_tokens=False)
                places = np.array(encoded.offsets, np.int32).reshape(-1, 2)
                starts, ends = places[:, 0], places[:, 1]
                mask = loss_mask(starts, ends, spans)
                rows.append((conv_id.as_py(), formatted, encoded.ids, starts, ends, mask))
                chars += len(formatted)
                if chars > BATCH_CHARS:
                    yield made(rows)
                    rows, chars = [], 0
            if rows:
                yield made(rows)

    empty = F.lit("")
    turn = F.struct(
        "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    gathered = (
        own_columns(conversations, "conv_id", "turn", "role", "text")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    return gathered.mapInArrow(encode, SCHEMA)


def read_back(formatted: str, starts, ends, mask) -> tuple[list[tuple[str, str]], list[str]]:
    """The turns of a formatted text, and the texts under its loss mask, unescaped."""
    starts, ends, mask = np.asarray(starts), np.asarray(ends), np.asarray(mask, bool)
    losses = []
    if mask.any():
        edges = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
        for first, last in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1):
            losses.append(unescape(formatted[starts[first] : ends[last]]))
    return parse(formatted), losses


def read_conversations(formatted: DataFrame) -> DataFrame:
    """Turns and learned texts as READ_SCHEMA has them, from formatted conversations alone."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = pa.struct([("role", pa.string()), ("text", pa.string())])
        for batch in batches:
            names = ("formatted", "token_starts", "token_ends", "loss_mask")
            both = [
                read_back(text.as_py(), *(x.values.to_numpy(zero_copy_only=False) for x in rest))
                for text, *rest in zip(*(batch.column(name) for name in names))
            ]
            turns = [[{"role": r, "text": t} for r, t in x] for x, _ in both]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    pa.array(turns, pa.list_(turn)),
                    pa.array([x for _, x in both], pa.list_(pa.string())),
                    pc.utf8_length(batch.column("formatted")).cast(pa.int64()),
                ],
                ["conv_id", "turns", "losses", "formatted_chars"],
            )

    columns = ("conv_id", "formatted", "token_starts", "token_ends", "loss_mask")
    return own_columns(formatted, *columns).mapInArrow(read, READ_SCHEMA)
