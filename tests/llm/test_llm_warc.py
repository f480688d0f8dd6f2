import gzip
import hashlib

import pytest

from cases import AWKWARD
from ledgerspark.llm import warc

PAGES = "page_id long, url string, html string, value string, offset long"


def brute(rows):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, b in data:
        same = max(q for q, c in data if c == b)
        revisit = len(b) >= 1000 and same != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(),
                    "revisit" if revisit else "response", same if revisit else None))
    return sorted(out)


def archived(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    got = warc.archive_pages(df).collect()
    assert all(r["error"] is None for r in got)
    assert len({r["record_id"] for r in got}) == len(got)
    return sorted(tuple(r)[:5] for r in got)


def test_equals_brute_force(spark, monkeypatch):
    long = "<p>\r\n\r\nWARC/1.1\r\n" + "é" * 800
    rows = [(i, f"http://a b/{i}\n", t) for i, t in enumerate(AWKWARD)]
    rows += [(100 + i, None, long) for i in range(7)] + [(50, "u", "x" * 999), (51, "u", "x" * 999)]
    rows += [(60, "u", "y" * 1000), (61, "u", "y" * 1000)]
    assert archived(spark, rows) == brute(rows)


def test_many_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_ARCHIVE", 9)
    rows = [(i, f"http://h/{i}", ("z" * 1200) + str(i % 4)) for i in range(50)]
    assert archived(spark, rows) == brute(rows)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "u", "q" * 1500), (None, "u", "q" * 1500), (3, "u", "q" * 1500),
            (3, "u", "q" * 1500)]
    got = archived(spark, [r for r in rows if r[0] is not None])
    assert [r[3] for r in got].count("response") == 1
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    kinds = [(r["page_id"], r["record_type"], r["refers_to"])
             for r in warc.archive_pages(df).collect()]
    assert sorted(map(str, kinds)) == sorted(map(str, [
        (3, "response", None), (3, "revisit", 3), (None, "revisit", 3), (None, "revisit", 3)]))


def test_no_pages(spark):
    assert archived(spark, []) == []


def test_both_versions_and_damage():
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nhello"
    for version in (1, 2):
        arc = (warc._version_block(version, "a.arc", "20240101000000")
               + b"\n" + warc._arc_record(version, "a.arc", "1996", "http://t/", body) + b"\n")
        records = list(warc._arc_records(arc))
        assert [r[0] for r in records] == [version, version]
        assert records[1][3] == body
        with pytest.raises(warc.Damaged):
            list(warc._arc_records(arc[:-4]))
        with pytest.raises(warc.Damaged):
            list(warc._arc_records(arc + b"no header line\n"))
    assert warc._iso("1996") == "1996-01-01T00:00:00Z"
    assert warc._iso("19961231235959") == "1996-12-31T23:59:59Z"


def test_damaged_archive_is_reported(spark, scratch):
    good = warc._version_block(1, "a.arc", "20240101000000") + b"\n" + warc._arc_record(
        1, "a.arc", "20240101000000", "http://t/", b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nhi")
    with open(f"{scratch}/a.arc.gz", "wb") as f:
        f.write(gzip.compress(good + b"\nrubbish\n"))
    warc.convert(spark, scratch, f"{scratch}-warc")
    rows = warc.read_warc(spark, f"{scratch}-warc").collect()
    assert [r["page_id"] for r in rows if r["error"] is None] == [4]
    assert sum(r["error"] is not None for r in rows) == 1


def foreign(n, version=1, members=False):
    """An archive as others write them: payloads in any bytes, blanks in URLs and content types,
    records that are no HTTP responses, a gzip member a record."""
    head = warc._version_block(version, "x.arc", "19990101")
    more = "" if version == 1 else " 200 - - 0 x.arc"
    records = []
    for i in range(n):
        body = bytes([(i * 7 + k) % 256 for k in range(300)])
        content = f"HTTP/1.0 200 OK\r\nX-Page-Id: {i}\r\n\r\n".encode() + body
        url, kind = f"http://h/a b?q={i} 1999 x", "text/html; charset=iso-8859-1"
        if i % 10 == 3:
            url, kind, content = f"dns:h{i}", "text/dns", b"20010101 h\xe9 A 1.2.3.4"
        records.append(f"{url} 1.2.3.4 19990102030405 {kind}{more} {len(content)}\n".encode()
                       + content + b"\n")
    parts = [head + b"\n", *records]
    return b"".join(map(gzip.compress, parts)) if members else gzip.compress(b"".join(parts))


def put(scratch, name, data):
    with open(f"{scratch}/{name}", "wb") as f:
        f.write(data)


def through(spark, scratch):
    warc.convert(spark, scratch, f"{scratch}-warc")
    return warc.read_warc(spark, f"{scratch}-warc").collect()


@pytest.mark.parametrize("version,members", [(1, False), (1, True), (2, False), (2, True)])
def test_archives_of_others(spark, scratch, version, members):
    put(scratch, "x.arc.gz", foreign(200, version, members))
    rows = through(spark, scratch)
    assert [r["error"] for r in rows] == [None] * 200
    kinds = {r["page_id"]: r["record_type"] for r in rows if r["page_id"] is not None}
    assert kinds == {i: "response" for i in range(200) if i % 10 != 3}
    assert sum(r["record_type"] == "resource" for r in rows) == 20
    body = bytes([(7 + k) % 256 for k in range(300)])
    assert hashlib.sha1(body).hexdigest() in {r["payload_digest"] for r in rows if r["page_id"] == 1}
    assert {r["date"] for r in rows} == {"1999-01-02T03:04:05Z"}


def test_plain_archive(spark, scratch):
    put(scratch, "x.arc", gzip.decompress(foreign(30)))
    assert len(through(spark, scratch)) == 30


@pytest.mark.parametrize("members", [False, True])
def test_cut_off_and_changed_archives_give_what_comes_before(spark, scratch, members):
    data = foreign(200, members=members)
    put(scratch, "cut.arc.gz", data[:len(data) // 2])
    changed = bytearray(data)
    changed[len(data) // 2] ^= 0xFF
    put(scratch, "changed.arc.gz", bytes(changed))
    put(scratch, "none.arc.gz", b"\x1f\x8b no gzip at all")
    rows = through(spark, scratch)
    errors = [r for r in rows if r["error"] is not None]
    assert len(errors) >= 2 and all("damaged" in r["error"] or "differs" in r["error"] for r in errors)
    whole = [r["page_id"] for r in rows if r["error"] is None and r["page_id"] is not None]
    assert len(whole) > 50 and whole.count(0) == 2


def test_any_changed_byte_is_an_error_or_nothing():
    data = foreign(12, members=True)
    for at in range(0, len(data), 37):
        changed = bytearray(data)
        changed[at] ^= 0x55
        try:
            list(warc._arc_records(bytes(changed)))
        except warc.Damaged:
            pass


def test_archives_are_cut_by_bytes(spark, scratch, monkeypatch):
    import os
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    rows = [(i, f"http://h/{i}", f"{i} " + "z" * 20_000) for i in range(20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES).coalesce(1)
    warc.write_arc(df, f"{scratch}/arc")
    files = [f for f in os.listdir(f"{scratch}/arc") if f.endswith(".gz")]
    assert len(files) == 7
    assert archived(spark, rows) == brute(rows)
