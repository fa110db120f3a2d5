"""WARC: round trip, revisits, and damaged archives."""

import gzip
import hashlib
import io
import os
import random

from mercata.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, kept int, record_type int, path string"


def page(i, html, url="http://h.example/a b\r\né"):
    return (i, url, html, "x", 1, 2, "p")


def test_round_trip_with_revisits(spark, frame):
    big, small = "é" * 600, "s" * 999
    rows = [page(1, big), page(5, big), page(3, big), page(2, small), page(4, small), page(6, None), page(7, ""), page(8, "x" * 2_000_000, None)]
    got = {r.page_id: r for r in warc.archived(frame(rows, SCHEMA)).collect()}
    assert len(got) == 8
    for i, _, html, *_ in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {1: 5, 3: 5}
    assert warc.archived(frame([], SCHEMA)).collect() == []


def test_repeated_rows_and_missing_ids(spark, frame):
    big = "b" * 1000
    rows = [page(1, big), page(9, big), page(9, big), page(None, big), page(None, "n" * 1000), page(None, "n" * 1000)]
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.archived(frame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted(
        [(1, "revisit", 9, 1000), (9, "response", None, 1000), (9, "response", None, 1000), (None, "revisit", 9, 1000)]
        + [(None, "response", None, 1000)] * 2, key=str,
    )


def test_files_roll_over_and_payloads_come_back(spark, frame, monkeypatch, tmp_path):
    rows = [page(i, os.urandom(300).hex()) for i in range(60)]
    monkeypatch.setattr(warc, "FILE_BYTES", 2_000)
    manifest = warc.write_archives(warc.with_revisits(frame(rows, SCHEMA)).coalesce(1), str(tmp_path / "a"))
    assert manifest.count() > 1 and manifest.agg({"records": "sum"}).first()[0] == 60
    back = {r.record_id: r for r in warc.read_archives(manifest, payloads=True).collect()}
    assert all(back[f"urn:page:{i}"].payload == html.encode() and back[f"urn:page:{i}"].uri == url for i, url, html, *_ in rows)
    assert sorted(os.listdir(tmp_path / "a")) == sorted(r.path.rsplit("/", 1)[1] for r in manifest.collect())


def members(n, compress=True):
    out = []
    for i in range(n):
        html = f"page {i} ".encode() * (20 + 40 * i)
        data = warc.record("response", i, f"http://x/{i}", html, hashlib.sha1(html).hexdigest(), None)
        out.append(data if compress else gzip.decompress(data))
    return out


def salvaged(data):
    return list(warc.salvage(io.BytesIO(data), len(data)))


def ids(items):
    return [int(i[3]["warc-record-id"][10:-1]) for i in items if i[0] == "record"]


def test_whole_archives_have_no_gaps():
    for compress in (True, False):
        got = salvaged(b"".join(members(6, compress)))
        assert ids(got) == list(range(6)) and all(i[0] == "record" for i in got)
    assert salvaged(b"") == []
    one = gzip.compress(b"".join(members(4, False)))  # all records in one member
    assert ids(salvaged(one)) == [0, 1, 2, 3]


def test_every_damage_is_logged_and_later_records_recovered():
    rng = random.Random(5)
    for compress in (True, False):
        parts = members(8, compress)
        starts = [sum(map(len, parts[:i])) for i in range(9)]
        whole = b"".join(parts)
        for hurt in range(8):
            for kind in ("flip", "cut", "junk", "zero"):
                data = bytearray(whole)
                a, b = starts[hurt], starts[hurt + 1]
                at = rng.randrange(a + 12, b - 8)
                if kind == "flip":
                    data[at] ^= 0x55
                elif kind == "cut":
                    del data[at:b]
                elif kind == "junk":
                    data[at:at] = b"\x1f\x8b\x08 WARC/1.0 \r\nWARC/1." + os.urandom(30)
                else:
                    data[a:b] = bytes(b - a)
                got = salvaged(bytes(data))
                kept = ids(got)
                assert [i for i in range(8) if i != hurt] == [i for i in kept if i != hurt], (compress, kind, hurt)
                gaps = [g for g in got if g[0] == "gap"]
                assert hurt in kept or (len(gaps) == 1 and gaps[0][1] == a and gaps[0][3]), (compress, kind, hurt, gaps)
                spans = [(i[1], i[2]) for i in got]
                assert spans[0][0] == 0 and spans[-1][1] == len(data)  # every byte is a record's or a gap's
                assert all(x[1] == y[0] for x, y in zip(spans, spans[1:]))


def test_truncated_end_and_foreign_head():
    parts = members(3)
    got = salvaged(b"#!garbage\n" + b"".join(parts)[:-20])
    assert [i[0] for i in got] == ["gap", "record", "record", "gap"] and got[-1][3] == "truncated member"


def test_small_reads_find_marks_across_blocks(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    parts = members(4)
    parts[1] = b"?" * 100 + parts[1][50:]
    got = salvaged(b"".join(parts))
    assert ids(got) == [0, 2, 3] and [i[0] for i in got] == ["record", "gap", "record", "record"]


def test_wrong_digests_are_quarantined():
    html = b"x" * 50
    bad = gzip.compress(gzip.decompress(warc.record("response", 1, None, html, hashlib.sha1(html).hexdigest(), None)).replace(b"xxxx", b"yyyy", 1))
    got = salvaged(bad + members(1)[0])
    assert [i[0] for i in got] == ["gap", "record"] and "digest" in got[0][3]
