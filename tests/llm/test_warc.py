import base64
import hashlib

import pytest
import zstandard

from tallyspark.llm import warc
from tallyspark.session import scratch_path


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


ROWS = [
    (1, "http://a/ b\r\nX: y", "same", 1), (5, "http://b", "same", 2), (3, None, "same", 3), (2, "http://c", None, 4), (4, "http://d", "", 5),
    (6, "http://e", "é🙂" * 50_000, 6), (None, "http://f", "same", 7), (7, "http://g", "line\r\n\r\nWARC/1.1\r\n\r\n", 8),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, payload int")
    got = {r["page_id"]: r for r in warc.round_trip(pages).collect()}
    assert len(got) == len(ROWS)
    for page_id, _, html, _ in ROWS:
        r = got[page_id]
        assert (r["payload_bytes"], r["payload_digest"]) == (len((html or "").encode()), digest(html))
    assert {k: r["refers_to"] for k, r in got.items() if r["record_type"] == "revisit"} == {1: 5, 3: 5, None: 5, 2: 4}
    large = {r["page_id"]: r["record_type"] for r in warc.round_trip(pages, least_bytes=2).collect()}
    assert large[2] == large[4] == "response" and large[1] == "revisit"
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_payload_comes_back(spark, monkeypatch):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, x int")
    folder = scratch_path(spark, "warc-test")
    monkeypatch.setattr(warc, "SAMPLE_BYTES", 50)
    listed = warc.write_archives(pages, folder, archive_bytes=100)
    assert listed.agg({"records": "sum"}).first()[0] == len(ROWS)
    rows = warc.read_archives(spark, [r["path"] for r in listed.collect()]).collect()
    html = {p: (t or "") for p, _, t, _ in ROWS}
    for r in rows:
        if r["record_type"] == "response":
            assert r["payload"].decode() == html[r["page_id"]]
        assert r["url"] != "http://a/ b\r\nX: y" or r["page_id"] != 1


def archive(n=400):
    records = [warc.record_bytes(i, f"http://{i}", f"<p>page {i} of {i % 7}</p>".encode() * 20, "", None, False) for i in range(n)]
    records = [r.replace(b"sha1:", b"sha1:" + warc.digest(r.split(b"\r\n\r\n", 2)[2][:-4]).encode()) for r in records]
    dictionary = warc.train_dictionary(records)
    coder = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    return records, (warc.dictionary_frame(dictionary) if dictionary else b""), [coder.compress(r) for r in records]


def test_reader_uses_the_leading_dictionary():
    records, front, coded = archive()
    assert front and list(warc.frames(front + b"".join(coded))) == records
    with pytest.raises(warc.WarcError):
        list(warc.frames(b"".join(coded)))
    with pytest.raises(warc.WarcError):
        list(warc.frames(front + coded[0][:-3]))
    assert [warc.parse_record(r)["page_id"] for r in records] == list(range(len(records)))


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1"), lambda r: r[:-2], lambda r: r.replace(b"page 1", b"page 9", 1),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: request"), lambda r: r.replace(b"Content-Length: ", b"Content-Length: -"),
        lambda r: r.replace(b"WARC-Record-ID: <urn:page:1>", b"WARC-Record-ID: none"),
    ],
)
def test_broken_records_are_refused(change):
    with pytest.raises(warc.WarcError):
        warc.parse_record(change(archive(2)[0][1]))


def test_errors_are_reported(spark, tmp_path):
    _, front, coded = archive(20)
    bad = zstandard.ZstdCompressor().compress(b"no record")
    (tmp_path / "a.warc.zst").write_bytes(front + coded[0] + bad + coded[1] + coded[2][:-5])
    rows = warc.read_archives(spark, str(tmp_path), on_error="report").collect()
    assert [r["page_id"] for r in rows] == [0, None, 1, None]
    assert [r["error"] is None for r in rows] == [True, False, True, False]
