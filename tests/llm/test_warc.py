import base64
import gzip
import hashlib
import io

import pytest

from daymark.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string")


ROWS = [
    (1, "http://a/ü?x=1\r\nX: y", "same", "clash"),
    (2, None, "same", None),
    (2, None, "same", None),
    (3, "http://c", None, None),
    (4, "http://d", "", None),
    (5, "http://e", "é\r\n\r\nWARC/1.1 \x00" * 60_000, None),
    (None, "http://f", "same", None),
    (7, "http://g", "alone", None),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark, tmp_path):
    manifest = warc.write_archives(
        warc.with_revisits(pages(spark, ROWS)), f"{tmp_path}/archives", archive_bytes=2000
    )
    rows = warc.read_archives(manifest, payloads=True).collect()
    keepers = {"same": 2, None: 4, "": 4}
    expected = sorted(
        (
            (
                i,
                url,
                len((html or "").encode()),
                digest(html),
                keepers[html] if i is not None and keepers.get(html, i) != i else None,
            )
            for i, url, html, _ in ROWS
        ),
        key=str,
    )
    got = [(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.refers_to) for r in rows]
    assert sorted(got, key=str) == expected
    for row in rows:
        assert row.record_type == ("response" if row.refers_to is None else "revisit")
        if row.refers_to is None:
            html = next(h for i, _, h, _ in ROWS if i == row.page_id)
            assert row.payload == (html or "").encode()
        else:
            assert row.payload is None


def test_least_bytes(spark):
    rows = warc.with_revisits(pages(spark, ROWS), least_bytes=5).collect()
    assert all(r.refers_to is None for r in rows)


def test_empty_table(spark, tmp_path):
    manifest = warc.write_archives(
        warc.with_revisits(pages(spark, ROWS).limit(0)), f"{tmp_path}/archives"
    )
    assert manifest.count() == 0
    assert warc.read_archives(manifest).count() == 0


def members(*texts):
    return b"".join(warc._member(warc.record(i, "u", text)) for i, text in enumerate(texts))


def test_header_of_any_length(spark, tmp_path):
    """A record that can be written can be read, however long its URL is."""
    url = "http://x/" + "%C3%A4é" * 400_000
    rows = spark.createDataFrame([(1, url, "a"), (2, "u", "b")], "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_revisits(rows), f"{tmp_path}/archives")
    found = {r.page_id: r for r in warc.read_archives(manifest).collect()}
    assert found[1].payload_bytes == 1 and found[2].payload_bytes == 1 and found[1].record_type == "response"


def test_one_member_per_record():
    data = members(b"a" * 300_000, b"", b"c")
    assert [r[3] for r in warc.records(io.BytesIO(data), "x")] == [300_000, 0, 1]
    assert gzip.decompress(data).count(b"WARC/1.1") == 3


@pytest.mark.parametrize(
    ("old", "new", "said"),
    [
        (b"hello", b"hullo", "block digest"),
        (b"Content-Length: 83", b"Content-Length: 80", "longer"),
        (b"Content-Length: 83", b"Content-Length: 99", "shorter"),
        (b"WARC/1.1", b"JUNK/1.1", "WARC"),
    ],
)
def test_altered_archives_fail(old, new, said):
    text = warc.record(1, "u", b"hello")
    assert old in text, text
    with pytest.raises(warc.BrokenArchive, match=said):
        list(warc.records(io.BytesIO(warc._member(text.replace(old, new))), "x"))


def test_truncated_archive_fails():
    data = members(b"a" * 1000, b"b" * 1000)
    for cut in (5, len(data) // 2, len(data) - 1):
        with pytest.raises(warc.BrokenArchive):
            list(warc.records(io.BytesIO(data[:cut]), "x"))
