"""Archives read back at any split equal the pages; damage costs only the damaged record."""

import base64
import gzip
import hashlib
import io

import pytest

from conftest import SMALL
from tapewire.llm import warc
from tapewire.llm.queries import QUERIES

ROWS = [
    (1, "http://a/", "<p>é😀</p>", "x"), (2, "http://b/\nc d", "<p>é😀</p>", "x"), (3, None, None, None), (4, "", "", "x"), (0, "u", "z" * 300_000, "x"),
    (None, "n", "<p>é😀</p>", "x"), (1, "http://a/", "<p>é😀</p>", "x"), (7, "m", "\x1f\u008b\x08 WARC/1.1\r\n\r\n", "x"), (9, "u", "z" * 300_000, "x"),
]
SCHEMA = "page_id long, url string, html string, payload string"


def expected(rows):
    first = {}
    for page, _, html, *_ in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        origin = None if page is None or first[html or ""] == page else first[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "response" if origin is None else "revisit", origin))
    return sorted(out, key=repr)


def test_query(spark, duck):
    got = QUERIES["op1_warc"](spark, SMALL)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(duck.execute("SELECT * FROM pages").fetchall())


@pytest.mark.parametrize("split", [64, 999, 1 << 24])
def test_odd_rows_at_any_split(spark, split):
    files = warc.write_warc(warc.mark_revisits(spark.createDataFrame(ROWS, SCHEMA).repartition(2)))
    rows = warc.read_warc(files, split).collect()
    got = []
    for r in rows:
        page, origin = (int(x.rpartition(":")[2]) if x and not x.endswith("none") else None for x in (r["record_id"], r["refers_to_id"]))
        payload = bytes(r["payload"])
        assert r["type"] == "revisit" or (len(payload) == r["http_length"] and warc.base32_sha1(payload) == r["payload_digest"])
        got.append((page, r["http_length"], r["payload_digest"], r["type"], origin))
    assert sorted(got, key=repr) == expected(ROWS)


def test_empty_table(spark):
    assert warc.read_warc(warc.write_warc(warc.mark_revisits(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_least_bytes(spark):
    df = spark.createDataFrame([(1, "", "ab", ""), (2, "", "ab", ""), (3, "", "abc", ""), (4, "", "abc", "")], SCHEMA)
    assert sorted((r["page_id"], r["refers_to"]) for r in warc.mark_revisits(df, 3).collect()) == [(1, None), (2, None), (3, None), (4, 3)]


def test_ranges_and_damage():
    members = [warc.record_bytes(i, "u", bytes([i]) * (i * 700), None) for i in range(1, 9)]
    decoy = gzip.compress(b"WARC/1.1 but no record") + b"\x1f\x8b\x08junk"
    data = bytearray(b"".join(members[:4]) + decoy + b"".join(members[4:]))
    whole = list(warc.records_in_range(io.BytesIO(data), 0, len(data)))
    assert [h["warc-record-id"] for h, _ in whole] == [f"<urn:page:{i}>" for i in range(1, 9)]
    for step in (1, 7, 50, 333):
        parts = [x for s in range(0, len(data), step) for x in warc.records_in_range(io.BytesIO(data), s, min(s + step, len(data)))]
        assert parts == whole
    at = len(members[0]) + len(members[1]) - 12
    data[at : at + 4] = b"\0\0\0\0"
    left = [h["warc-record-id"] for h, _ in warc.records_in_range(io.BytesIO(data), 0, len(data))]
    assert left == [f"<urn:page:{i}>" for i in (1, 3, 4, 5, 6, 7, 8)]
    assert len(list(warc.records_in_range(io.BytesIO(data[:-3]), 0, len(data) - 3))) == 6


def test_urls_longer_than_a_read(spark):
    """Headers of over 64 KB, which end far behind the first decoded piece; and a lost record is an error."""
    rows = [(1, "http://a/" + "é" * 30_000, "<p>a</p>", ""), (2, "http://b/" + "x" * 200_000, "<p>a</p>", ""), (3, "http://c/", "", "")]
    files = warc.write_warc(warc.mark_revisits(spark.createDataFrame(rows, SCHEMA).repartition(1)))
    for split in (999, 1 << 24):
        back = warc.read_warc(files, split)
        got = {r["record_id"]: (r["target_uri"], r["type"]) for r in back.collect()}
        assert got == {f"urn:page:{i}": (warc._field(url), "revisit" if i == 2 else "response") for i, url, *_ in rows}
    ids = back.select("record_id")
    assert warc.checked(ids, files).count() == 3
    with pytest.raises(ValueError, match="2 records read of 3"):
        warc.checked(ids.where("record_id <> 'urn:page:3'"), files)
