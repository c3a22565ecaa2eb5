"""WARC archives: round trip, revisits, and refusal of damaged records."""

import struct

import pytest
import zstandard

from orderloom.llm import warc

PAGES = [
    (1, "http://a.example/x", "<p>same</p>"),
    (2, "http://a.example/y\r\nX: 1", "<p>same</p>"),
    (5, None, "<p>same</p>"),
    (5, "http://a.example/again", "<p>same</p>"),
    (3, "http://b.example", None),
    (4, "http://b.example", ""),
    (None, "http://c.example", "<p>same</p>"),
    (None, "http://c.example", "no id at all"),
    (6, "http://d.example/é", "größe \r\n\r\n " * 30_000),
]


def pages(spark, rows):
    wide = [(9, i, u, h, "x", 0) for i, u, h in rows]
    schema = "refers_to int, page_id bigint, url string, html string, digest string, first int"
    return spark.createDataFrame(wide, schema)


def test_archives_give_back_what_was_written(spark):
    df = pages(spark, PAGES).repartition(2)
    rows = warc.read(spark, warc.write(df)).collect()
    assert len(rows) == len(PAGES)
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = max(i, first.get(h or "", i))
    seen = []
    for r in rows:
        html = bytes(r.html).decode() if r.html is not None else "<p>same</p>"
        if r.record_type == "revisit":
            html = next(h or "" for _, _, h in PAGES if (h or "") in first and first[h or ""] == r.refers_to)
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == warc.payload_digest(html.encode())
        big = first.get(html)
        assert r.refers_to == (None if r.page_id == big else big)
        assert r.record_type == ("response" if r.refers_to is None else "revisit")
        seen.append((r.page_id, html))
    key = lambda x: (str(x[0]), x[1])
    assert sorted(seen, key=key) == sorted(((i, h or "") for i, _, h in PAGES), key=key)
    assert warc.archived(df.limit(0)).count() == 0


def test_small_payloads_are_all_responses(spark):
    rows = warc.archived(pages(spark, PAGES), revisit_bytes=12).collect()
    assert {r.record_type for r in rows} == {"response"}


def test_archive_has_a_dictionary_and_rolls_over(spark):
    many = [(k, f"http://h.example/{k}", f"<html><body>{'page text ' * 20}{k}</body></html>") for k in range(900)]
    paths = warc.write(pages(spark, many).coalesce(1), archive_bytes=100_000)
    assert len(paths) > 1
    with warc.open_shared(paths[0]) as f:
        assert struct.unpack("<I", f.read(4))[0] == warc.DICTIONARY_MAGIC
    rows = warc.read(spark, paths).collect()
    assert sorted(r.page_id for r in rows) == list(range(900))
    assert all(bytes(r.html).decode() == many[r.page_id][2] for r in rows)


def good():
    return warc.page_record(1, "http://x.example", "<p>", None, "2024-01-01T00:00:00Z")


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
        lambda r: r.replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""),
        lambda r: r[:-1],
        lambda r: r + b"x",
        lambda r: r.replace(b"<p>", b"<q>"),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other"),
        lambda r: r.replace(b"WARC-Type: ", b"WARC-Type "),
    ],
)
def test_damaged_records_are_refused(change):
    assert warc.page_row(good())[0] == 1
    with pytest.raises(ValueError):
        warc.page_row(change(good()))


def test_cut_archives_are_refused(tmp_path):
    path = tmp_path / "a.warc.zst"
    out = warc.ArchiveWriter(f"file://{path}")
    for _ in range(3):
        out.add(good())
    out.close()
    with path.open("rb") as f:
        assert list(warc.frames(f)) == [good()] * 3
    path.write_bytes(path.read_bytes()[:-5])
    with path.open("rb") as f, pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames(f))
