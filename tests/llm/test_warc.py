"""ARC and WARC formats, and the query's rows against plain Python."""

from __future__ import annotations

import hashlib
import io

import pytest

from barloom.llm import archives, warc
from barloom.session import scratch_path

BIG = "<html>" + "payload " * 200 + "</html>"
PAGES = [
    (1, "http://a.example/1", BIG),
    (2, "http://a.example/2 with blanks", BIG),
    (7, None, BIG),
    (7, None, BIG),
    (3, "http://a.example/3", "small"),
    (4, "http://a.example/4", "small"),
    (5, "http://a.example/5", None),
    (6, "", ""),
    (None, "http://a.example/none", BIG),
    (8, "http://a.example/8", BIG + "é"),
    (9, "filedesc://x", "a page of any scheme"),
    (10, "filedesc://t.arc", BIG),
    (-9, "http://a.example/ü", "x" * 300_000),
]


@pytest.mark.parametrize("version", [1, 2])
def test_arc_is_read_as_written(version):
    stream = io.BytesIO(archives.arc_version_block(version, "t.arc"))
    stream.seek(0, io.SEEK_END)
    for page_id, url, html in PAGES:
        stream.write(
            archives.arc_record(version, "t.arc", stream.tell(), page_id, url, (html or "").encode())
        )
    stream.seek(0)
    block, *records = archives.read_arc(stream)
    assert block.version == version and block.fields["URL"] == "filedesc://t.arc"
    assert list(records[0].fields) == archives.ARC_FIELDS[version]
    for record, (page_id, url, html) in zip(records, PAGES, strict=True):
        converted = archives.convert(record)
        again = next(archives.read_warc(io.BytesIO(archives.warc_bytes(converted))))
        assert again.payload == (html or "").encode()
        assert archives.page_of(again.headers["WARC-Record-ID"]) == page_id
        assert again.headers["WARC-Type"] == "response"
        assert archives.digest_hex(again.headers["WARC-Payload-Digest"]) == hashlib.sha1(again.payload).hexdigest()
        assert again.headers["WARC-Date"][10] == "T" and again.headers["WARC-Date"].endswith("Z")


def test_declared_lengths_rule():
    arc = archives.arc_version_block(1, "t.arc") + archives.arc_record(1, "t.arc", 0, 1, "u", b"ab\n\ncd\n")
    assert list(archives.read_arc(io.BytesIO(arc)))[1].content.endswith(b"ab\n\ncd\n")
    with pytest.raises(ValueError, match="ends after"):
        list(archives.read_arc(io.BytesIO(arc[:-4])))
    with pytest.raises(ValueError, match="version block"):
        list(archives.read_arc(io.BytesIO(archives.arc_record(1, "t", 0, 1, "u", b"x"))))


def test_a_changed_payload_is_noticed():
    record = archives.arc_record(2, "t.arc", 0, 1, "u", b"payload")
    arc = archives.arc_version_block(2, "t.arc") + record.replace(b"payload", b"pAyload")
    with pytest.raises(ValueError, match="checksum"):
        [archives.convert(r) for r in archives.read_arc(io.BytesIO(arc))]


def test_identifiers_hold_the_page():
    for page_id in (0, 1, -1, 2**63 - 1, -(2**63)):
        assert archives.page_of(archives.record_id(page_id)) == page_id
    assert archives.page_of(archives.record_id(None, b"x")) is None


def test_pages_come_back(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    extra = frame.selectExpr("*", "'x' AS digest", "1 AS original", "'y' AS path")
    found = warc.archived_pages(extra).collect()
    expected = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        sharing = [p for p, _, h in PAGES if h == html and p is not None]
        original = max(sharing) if len(payload) >= 1000 and sharing else None
        revisit = original is not None and original != page_id
        expected.append(
            (page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", original if revisit else None)
        )
    assert sorted((tuple(r[:5]) for r in found), key=repr) == sorted(expected, key=repr)


def test_no_pages(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived_pages(frame).count() == 0


def test_files_of_lost_attempts_are_not_read(spark):
    frame = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test").replace("file:", "", 1)
    files = warc.convert_pages(frame, folder).collect()
    twice = warc.convert_pages(frame, folder).collect()  # leaves the first attempt's files
    assert {f.path for f in files}.isdisjoint(f.path for f in twice)
    assert warc.read_archives(spark.createDataFrame(twice)).count() == 3


def test_files_are_read_by_a_task_each(spark):
    folder = scratch_path(spark, "warc-test").replace("file:", "", 1)
    kinds = "page_id long, url string, html string"
    parts = [spark.createDataFrame(PAGES[n::3], kinds) for n in range(3)]
    files = spark.createDataFrame([f for p in parts for f in warc.convert_pages(p, folder).collect()])
    found = warc.read_archives(files)
    assert files.count() >= 3 and found.rdd.getNumPartitions() == files.count()
    assert found.count() == len(PAGES)
