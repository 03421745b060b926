import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from daymark.llm import chat

PARTS = [*"<|\\>im_startendsp aé漢🙂\n \t", chat.START, chat.SEP, chat.END]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|"]), TEXTS), max_size=5))
def test_round_trip(turns):
    formatted, _ = chat.render(turns)
    assert chat.parse(formatted) == turns
    encoded = chat.tokenizer(chat.TOKENIZER).encode(formatted, add_special_tokens=False)
    starts = np.array([a for a, _ in encoded.offsets], int)
    ends = np.array([b for _, b in encoded.offsets], int)
    mask = chat.loss_mask(starts, ends, chat.render(turns)[1])
    back, losses = chat.read_back(formatted, starts, ends, mask)
    assert back == turns
    assert losses == [text for role, text in turns if role == "assistant" and text]


def test_conversations(spark):
    long = "lang <|im_end|> " * 20_000
    rows = [
        (1, 1, "assistant", "b", "x"),
        (1, 0, "user", "a", "x"),
        (1, 1, "assistant", "b", "x"),
        (1, None, None, None, None),
        (2, 0, "assistant", long, None),
        (None, 0, "assistant", "", None),
    ]
    df = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, formatted string"
    )
    out = chat.format_conversations(df)
    assert all(len(r.token_ids) == len(r.loss_mask) == len(r.token_ends) for r in out.collect())
    back = {r.conv_id: r for r in chat.read_conversations(out).collect()}
    assert [tuple(t) for t in back[1].turns] == [
        ("", ""),
        ("user", "a"),
        ("assistant", "b"),
        ("assistant", "b"),
    ]
    assert back[1].losses == ["b", "b"]
    assert back[2].losses == [long]
    assert [tuple(t) for t in back[None].turns] == [("assistant", "")]
    assert back[None].losses == []
    assert chat.format_conversations(df.limit(0)).count() == 0
