"""WARC archives: format, round trip, revisits against brute force."""

import gzip
import hashlib
import io
from base64 import b32encode
from pathlib import Path

import pytest

from personweave.llm.warc import archive_pages, captures, deduplicated, parse, read_warc, resolve_revisits, write_warc
from tests.llm.common import clashing

SCHEMA = "page_id long, url string, html string"
PAGES = [(5, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (9, None, "<p>one</p>"), (3, "http://c/", None), (4, "http://d/", ""),
         (6, "http://e/\r\nX: y", "tricky\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (7, "http://f/", "é" * 200_000),
         (2, "http://b/", "<p>one</p>"), (None, "http://g/", "<p>one</p>"), (8, "http://h/", "﻿ \x00 end\r\n")]


def digest(text):
    return b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(pages, least=0):
    first = {}
    for i, _, h in pages:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    rows = []
    for i, _, h in pages:
        one = first.get(h or "", i)
        again = i is not None and i != one
        rows.append((i, len((h or "").encode()), digest(h), "revisit" if again else "response", one if again else None))
    return sorted(rows, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_against_brute_force(spark, tmp_path, least):
    out = archive_pages(clashing(spark.createDataFrame(PAGES, SCHEMA)), str(tmp_path / "w"), least)
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect()]
    assert sorted(rows, key=str) == brute(PAGES, least)


def test_payloads_come_back(spark, tmp_path):
    path = str(tmp_path / "w")
    write_warc(deduplicated(captures(spark.createDataFrame(PAGES, SCHEMA))), path, records_per_file=2)
    rows = read_warc(spark, path).collect()
    for i, _, h in PAGES:
        assert any(r.page_id == i and r.payload in (h or "", None) for r in rows)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert sorted(r.payload for r in rows if r.page_id in (6, 7, 8)) == sorted(h for i, _, h in PAGES if i in (6, 7, 8))


def test_files_are_warc(spark, tmp_path):
    write_warc(deduplicated(captures(spark.createDataFrame(PAGES, SCHEMA))), str(tmp_path / "w"))
    records = []
    for file in Path(tmp_path / "w").glob("part-*.gz"):
        data = gzip.decompress(file.read_bytes())
        assert not data or data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        records += parse(io.BytesIO(data))
    assert len(records) == len(PAGES)
    names = {f["warc-record-id"] for f, _ in records}
    for fields, block in records:
        assert len(block) == int(fields["content-length"]) and {"warc-date", "warc-payload-digest"} <= set(fields)
        assert block.startswith(b"HTTP/1.1 200 OK\r\n")
        if fields["warc-type"] == "revisit":
            assert fields["warc-refers-to"] in names and fields["warc-profile"].endswith("identical-payload-digest")
            assert block.endswith(b"\r\n\r\n") and b"x-page-id" not in block.lower()


def test_archives_are_deduplicated_again(spark, tmp_path):
    """Records that were read can be written anew: what was a response in two archives becomes one with a revisit."""
    pages = spark.createDataFrame(PAGES[:4], SCHEMA)
    for name, part in (("a", pages.where("page_id = 5")), ("b", pages.where("page_id <> 5"))):
        write_warc(deduplicated(captures(part)), str(tmp_path / name))
    both = read_warc(spark, str(tmp_path / "a")).unionByName(read_warc(spark, str(tmp_path / "b"))).where("record_type = 'response'")
    write_warc(deduplicated(both.drop("record_id", "record_type", "refers_to_id")), str(tmp_path / "c"))
    rows = {r.page_id: r for r in resolve_revisits(read_warc(spark, str(tmp_path / "c"), with_payload=False)).collect()}
    assert rows[5].record_type == "revisit" and rows[5].refers_to == 2 and rows[5].payload_bytes == 10


def test_damage_is_found(spark, tmp_path):
    write_warc(deduplicated(captures(spark.createDataFrame(PAGES[:1], SCHEMA))), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(f.read_bytes()) for f in Path(tmp_path / "w").glob("part-*.gz")).replace(b"<p>one", b"<p>two")
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.warc").write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        read_warc(spark, str(tmp_path / "x")).collect()


def test_empty_table(spark, tmp_path):
    assert archive_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "w")).collect() == []
