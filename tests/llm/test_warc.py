"""Op 11: archives, index and byte-range reads against the pages themselves."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from ratecraft.llm import op11_warc as warc

BIG = "<p>" + "é long page \r\n\r\n" * 100


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://a.org/{i}", f"<p>page {i}") for i in range(40)]
    rows += [(100 + i, f"http://copy.org/{i}", BIG) for i in range(30)]
    rows += [(5, "http://a.org/5", BIG + "x"), (7, None, BIG + "x"), (None, "http://none.org", BIG + "y"), (None, None, BIG + "y"), (3, "u", BIG + "z"),
             (3, "u", BIG + "z"), (3, "u", BIG + "z"), (50, "http://b.org/a b\r\nWARC-Type: x", None), (9, "é://ü", ""), (60, "", "x" * 400_000),
             (11, "http://999.org", "y" * 999), (12, "http://999.org", "y" * 999), (13, "http://1000.org", "z" * 1000), (14, "http://1000.org", "z" * 1000)]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, digest string, top string").repartition(4)


@pytest.fixture(scope="module")
def index(pages):
    return warc.write_warc(pages)


def test_records_read_back(pages, index):
    want = sorted(((r.page_id, r.html or "") for r in pages.collect()), key=str)
    whole = warc.read_records(index).collect()
    assert len(whole) == len(want) == index.count()
    by_id = {r.record_id: r for r in whole}
    got = []
    for r in whole:
        source = by_id[r.refers_to_record] if r.record_type == "revisit" else r
        assert source.record_type == "response" and (r.payload is None) == (r.record_type == "revisit")
        assert r.refers_to == (source.page_id if r.record_type == "revisit" else None)
        text = bytes(source.payload).decode()
        assert r.payload_bytes == len(source.payload) and r.payload_digest == hashlib.sha1(source.payload).hexdigest()
        got.append((r.page_id, text))
    assert sorted(got, key=str) == want


def test_one_response_for_each_repeated_payload(index):
    whole = warc.read_records(index, with_payload=False).collect()
    per = {}
    for r in whole:
        per.setdefault((r.payload_digest, r.payload_bytes), []).append(r)
    for (_, size), rows in per.items():
        responses = [r for r in rows if r.record_type == "response"]
        if size < warc.MIN_REVISIT:
            assert len(responses) == len(rows)
        else:
            assert len(responses) == 1
            top = max((r.page_id for r in rows if r.page_id is not None), default=None)
            assert responses[0].page_id == top and all(r.refers_to == top for r in rows if r.record_type == "revisit")


def test_archives_are_gzip_members_at_their_offsets(index):
    rows = index.collect()
    assert len({(r.file, r.offset) for r in rows}) == len(rows)
    files, _ = warc.filesystem(rows[0].file)
    for r in rows[:20]:
        path = warc.filesystem(r.file)[1]
        with open(path, "rb") as f:
            f.seek(r.offset)
            head, _, _ = warc.parse_member(f.read(r.length))
        assert head["WARC-Record-ID"] == r.record_id and head["WARC-Type"] == r.record_type
    for path in {warc.filesystem(r.file)[1] for r in rows}:
        raw = gzip.open(path).read()
        assert raw.count(b"WARC/1.1\r\n") == 1 + sum(r.file.endswith(os.path.basename(path)) for r in rows)


def test_selection_and_payloads(pages, index):
    picked = index.filter("page_id between 100 and 105 or page_id = 50")
    got = {r.page_id: bytes(r.payload).decode() for r in warc.payloads(index, picked).collect()}
    assert got == {**{100 + i: BIG for i in range(6)}, 50: ""}
    one = warc.read_records(index.filter("page_id = 60")).collect()
    assert len(one) == 1 and one[0].payload_bytes == 400_000


def test_small_archives_and_spans(spark, pages):
    index = warc.write_warc(pages.coalesce(1), archive_bytes=1500)
    assert index.select("file").distinct().count() > 3
    assert warc.read_records(index, max_gap=0, max_span=1).count() == warc.read_records(index).count() == index.count()
    got = list(warc.spans([("a", 0, 10), ("a", 12, 5), ("a", 40, 5), ("a", 45, 100), ("b", 0, 3)], max_gap=4, max_span=30))
    assert got == [("a", 0, 17, [(0, 10), (12, 5)]), ("a", 40, 45, [(40, 5)]), ("a", 45, 145, [(45, 100)]), ("b", 0, 3, [(0, 3)])]


def test_damage_is_found(spark, pages):
    index = warc.write_warc(pages)
    row = index.filter("record_type = 'response' and page_id = 60").first()
    path = warc.filesystem(row.file)[1]
    data = bytearray(open(path, "rb").read())
    data[row.offset + row.length - 6] ^= 255
    open(path, "wb").write(data)
    with pytest.raises(Exception):
        warc.read_records(index.filter("page_id = 60")).collect()


def test_empty(spark, pages):
    index = warc.write_warc(pages.limit(0))
    assert index.count() == 0 and warc.read_records(index).count() == 0
    assert warc.read_records(index).filter(F.col("payload").isNull()).count() == 0
