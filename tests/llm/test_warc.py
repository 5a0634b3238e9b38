import hashlib
import zlib

import pyarrow.parquet as pq

from lodestone.llm.queries import op5_warc
from lodestone.llm.warc import opened, parse, ranges, read_records, record, write_archives


def brute(rows):
    top = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None and len(data) >= 1000:
            top[data] = max(i, top.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = top.get(data) if i is not None and top.get(data) != i else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


def check(found, rows):
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


BIG, MINE = "é" * 500, "x" * 999
ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, "http://a/3\r\nX-Evil: 1", BIG), (4, None, MINE), (5, "u", MINE), (6, "u", None), (7, "u", ""), (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (8, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (None, "n", BIG), (9, "u", "\x00 " * 700), (10, "u", "\x00 " * 700),
]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "clash") for r in ROWS], "page_id long, url string, html string, digest string")
    index, folder = write_archives(pages)
    check(read_records(index, folder), ROWS)
    payloads = {(r.page_id, r.record_type): r.payload for r in read_records(index, folder, with_payload=True).collect()}
    assert bytes(payloads[3, "response"]) == BIG.encode() and payloads[1, "revisit"] is None


def test_every_index_row_is_a_record_of_its_own(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    index, folder = write_archives(pages)
    fs, root = opened(folder)
    names = set()
    for r in index.collect():
        with fs.open_input_file(f"{root}/{r.file}") as f:
            fields, _ = parse(zlib.decompress(f.read_at(r.length, r.offset), 31))
        assert fields["X-Page-Id"] == ("" if r.page_id is None else str(r.page_id)) and fields["WARC-Type"] == r.record_type
        names.add(fields["WARC-Record-ID"])
        if r.record_type == "revisit":
            assert fields["WARC-Refers-To-Target-URI"] == {3: "http://a/3X-Evil: 1", 10: "u", 21: "v", 22: "w"}[int(fields["X-Refers-To-Page"])]
    assert len(names) == len(ROWS)
    for name in {r.file for r in index.collect()}:
        with fs.open_input_file(f"{root}/{name}") as f:
            assert parse(zlib.decompressobj(31).decompress(f.read()))[0]["WARC-Type"] == "warcinfo"


def test_selected_records_only(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    index, folder = write_archives(pages)
    assert {r.page_id for r in read_records(index.where("page_id in (3, 9)"), folder).collect()} == {3, 9}


def test_pages(spark, sf_dir):
    rows = [(r["page_id"], r["url"], r["html"]) for r in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist()]
    check(op5_warc(spark, sf_dir), rows)


def test_empty(spark):
    index, folder = write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == 0 and read_records(index, folder).count() == 0


def test_ranges_join_near_places():
    assert ranges([(0, 10), (10, 5), (100, 5), (10_000, 1)], gap=100, most=1000) == [(0, 105), (10_000, 1)]
    assert ranges([(0, 600), (600, 600)], gap=0, most=1000) == [(0, 600), (600, 600)]


def test_record_parses():
    fields, payload = parse(record("n", 1, "http://x", b"a\r\n\r\nb", "00" * 20, 7))
    assert payload == b"a\r\n\r\nb" and fields["WARC-Type"] == "response"
