from __future__ import annotations

import gzip
import hashlib

import pytest

from courtside.llm import archives
from courtside.session import fresh_path

LONG = "<p>ä" + "x" * 1200 + "\r\n\r\nWARC/1.1\n\n</p>"
SCHEMA = "page_id long, url string, html string, record_id string, refers string, value int"
PAGES = [
    (1, "http://a/ b\n c", LONG, "r", "f", 1), (5, "http://a/", LONG, "r", "f", 1), (3, None, LONG, "r", "f", 1), (3, None, LONG, "r", "f", 1),
    (2, "http://s/", "short", "r", "f", 1), (4, "http://s/", "short", "r", "f", 1), (6, "", None, "r", "f", 1), (7, "u", "", "r", "f", 1),
    (None, "u", LONG, "r", "f", 1), (8, "u", LONG + "2", "r", "f", 1), (9, "u", "y" * 3_000_000, "r", "f", 1),
]


def test_both_versions_are_parsed_by_declared_length():
    for version in (1, 2):
        text = "\n".join([archives.version_block(version, "f.arc"), archives.arc_record(version, 4, "http://x/ y", LONG), archives.arc_record(version, None, None, ""), ""])
        for raw in (text.encode(), gzip.compress(text.encode()), gzip.compress(text.encode()[:100]) + gzip.compress(text.encode()[100:])):
            (_, one, first), (_, two, second) = archives.parse_arc(raw)
            assert one["URL"] == "http://x/%20y" and one["Archive-date"] == archives.DATE and len(one) == (5 if version == 1 else 10)
            head, payload = archives.split_http(first)
            assert payload == LONG.encode() and archives.http_field(head, "x-page-id") == "4"
            assert two["URL"] == "-" and archives.split_http(second)[1] == b""


def test_old_urls_with_blanks():
    body = "hello"
    text = f"{archives.version_block(1, 'f')}\nhttp://x/a b c 1.2.3.4 19990101000000 text/plain {len(body)}\n{body}\n"
    ((_, fields, content),) = archives.parse_arc(text.encode())
    assert fields["URL"] == "http://x/a b c" and fields["IP-address"] == "1.2.3.4" and content == b"hello"


@pytest.mark.parametrize("broken", [
    b"http://x/ 0 0 t 3\nabc\n", b"filedesc://f 0.0.0.0 0 text/plain 9\n3 0 x\na b\n\n",
    archives.version_block(1, "f").encode() + b"\nhttp://x/ 0 0 t 9\nabc\n", archives.version_block(1, "f").encode() + b"\nhttp://x/ 0 0 t 2\nabc\n",
    gzip.compress(archives.version_block(1, "f").encode())[:-9],
])
def test_broken_archives_are_refused(broken):
    with pytest.raises((archives.BrokenArchive, ValueError)):
        list(archives.parse_arc(broken))


def test_warc_round_trip_and_fields():
    text = archives.warc_record("urn:uuid:1", "response", "2024-01-01T00:00:00Z", "http://x", "d", archives.http_head(1, 3), "abc", None)
    text += "\r\n\r\n" + archives.warc_record("urn:uuid:2", "revisit", "2024-01-01T00:00:00Z", "http://x", "d", archives.http_head(2, 3), "abc", "urn:uuid:1") + "\r\n\r\n"
    (one, first), (two, second) = archives.parse_warc(text.encode())
    assert archives.split_http(first)[1] == b"abc" and archives.split_http(second)[1] == b""
    assert two["warc-refers-to"] == "<urn:uuid:1>" and two["warc-profile"] == archives.SAME_PAYLOAD
    assert one["warc-block-digest"] == "sha1:" + hashlib.sha1(first).hexdigest()
    with pytest.raises(archives.BrokenArchive):
        list(archives.parse_warc(text.encode()[:-3]))


def test_pages_come_back(spark):
    got = sorted((tuple(r) for r in archives.archived(spark.createDataFrame(PAGES, SCHEMA)).collect()), key=str)
    want = []
    for page, _, html, *_ in PAGES:
        raw = (html or "").encode()
        # the largest id of the long payload is 5
        revisit = html == LONG and page != 5
        want.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None))
    assert got == sorted(want, key=str)


def test_repeated_largest_page_keeps_one_response(spark):
    rows = [(5, "u", LONG, "", "", 0)] * 3 + [(4, "u", LONG, "", "", 0)]
    got = [(r.page_id, r.record_type, r.refers_to) for r in archives.archived(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted([(5, "response", None), (5, "revisit", 5), (5, "revisit", 5), (4, "revisit", 5)], key=str)


def test_files_hold_several_archives(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"page {i}", "", "", 0) for i in range(20)], SCHEMA).coalesce(1)
    arcs, warcs = fresh_path(spark, "arcs"), fresh_path(spark, "warcs")
    archives.write_arcs(pages, arcs, per_file=5)
    rows = archives.read_arcs(spark, arcs)
    assert sorted(r.payload for r in rows.collect()) == sorted(f"page {i}" for i in range(20))
    assert spark.read.format("binaryFile").load(arcs).count() == 5
    archives.convert(spark, arcs, warcs, per_file=7)
    back = archives.read_warcs(spark, warcs).collect()
    assert len({r.record_id for r in back}) == 20 and {r.payload for r in back} == {f"page {i}" for i in range(20)}
    assert {r.date for r in back} == {"2024-01-01T00:00:00Z"}


def test_files_meet_their_revisits_as_they_lie(spark):
    rows = [(i, f"http://x/{i}", LONG + str(i % 30), "", "", 0) for i in range(90)]
    arcs = fresh_path(spark, "arcs")
    archives.write_arcs(spark.createDataFrame(rows, SCHEMA).repartition(3), arcs, per_file=8)
    converted = archives._converted(spark, arcs, 1000)
    plan = converted._jdf.queryExecution().optimizedPlan().toString()
    # records with their payloads are made above the join, so no shuffle carries them
    assert plan.index("MapInArrow") < plan.index("Join") and "payload" not in plan[: plan.index("Join")]
    found = [record for (record,) in converted.collect()]
    assert len(found) == 90 and sum("WARC-Type: revisit" in record for record in found) == 60
    kept = {r.record_id: r.page_id for r in archives.read_arcs(spark, arcs).collect() if r.page_id >= 60}
    for record in found:
        head = dict(line.split(": ", 1) for line in record.split("\r\n") if ": " in line)
        if head["WARC-Type"] == "revisit":
            assert kept[head["WARC-Refers-To"].strip("<>")] == 60 + int(head["X-Page-Id"]) % 30


def test_packing_is_quick(spark):
    words = [hashlib.sha1(str(i % 97).encode()).hexdigest()[: i % 11 + 3] for i in range(60_000)]
    arcs = fresh_path(spark, "arcs")
    archives.write_arcs(spark.createDataFrame([(1, "u", " ".join(words), "", "", 0)], SCHEMA).coalesce(1), arcs)
    (raw,) = (bytes(r.content) for r in spark.read.format("binaryFile").load(arcs).collect() if r.content)
    whole = gzip.decompress(raw)
    # packed as by the writer's level, not by the default
    assert len(gzip.compress(whole, 6)) < 0.98 * len(raw) < len(raw) < 0.5 * len(whole)


def test_empty_table(spark):
    assert archives.archived(spark.createDataFrame([], SCHEMA)).count() == 0
