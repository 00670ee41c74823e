import gzip
import hashlib

import pytest

from tidelog.llm import warc

PAGES = "page_id long, url string, html string, digest string, refers_to long"
BIG, SMALL = "é<p>" * 40, "small"
ROWS = [
    (5, "http://a.org/x y", BIG), (3, "http://b.org/", BIG), (3, None, BIG), (9, "http://c.org/", SMALL), (10, "http://c.org/", SMALL),
    (None, "http://d.org/", BIG), (11, "http://e.org/", None), (12, "http://e.org/\n2", ""), (13, "u", "\r\n\r\nWARC/1.0\r\n\r\n" * 20),
    (14, "http://f.org/", "z" * 100), (15, "http://f.org/", "z" * 100), (16, "http://f.org/", "w" * 99), (17, "http://f.org/", "w" * 99),
]


@pytest.mark.parametrize("version", [1, 2])
def test_pages_come_back(spark, version, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 1000)
    pages = spark.createDataFrame([(*r, "d", 1) for r in ROWS], PAGES)
    got = sorted(map(str, (tuple(r) for r in warc.archive_pages(pages, version).collect())))
    first = {}
    for d, _, h in ROWS:
        if d is not None:
            first[h or ""] = min(first.get(h or "", d), d)
    expected = []
    for d, _, h in ROWS:
        raw = (h or "").encode()
        again = len(raw) >= 100 and d is not None and d > first[h]
        expected.append((d, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    assert got == sorted(map(str, expected))


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_arc_versions_and_blocks():
    v1 = b"filedesc://x 0.0.0.0 20000101000000 text/plain 6\n1 0 ab\n\nhttp://a/ 1.2.3.4 19991231235959 text/html 5\nhello\n"
    v1 += b"http://a/with two spaces 1.2.3.4 never text/html 2\r\nok\n"
    v2 = b"filedesc://y 0.0.0.0 2002 text/plain 200 - - 0 y.arc 6\n2 0 ab\nhttp://b/ c 1.2.3.4 2001 text/html 200 - - 7 f.arc 3\na\nb\n"
    got = list(warc.split_arc(v1 + v2))
    assert [(h["url"], b) for h, b, _ in got] == [("http://a/", b"hello"), ("http://a/with two spaces", b"ok"), ("http://b/ c", b"a\nb")]
    assert got[2][0]["status"] == "200" and got[1][0]["date"] == "20000101000000"  # the version block's
    bare = list(warc.split_arc(b"http://b/ 1.2.3.4 2001 text/html 404 - - 7 f.arc 3\nabc\nhttp://c/ 1.2.3.4 2001 text/html 0\n\n"))
    assert [h.get("status") for h, _, _ in bare] == ["404", None]
    for broken, why in [(b"a b c\n", "fields"), (b"http://a/ 1.2.3.4 1999 text/html 50\nhello\n", "shorter"), (b"filedesc://x 0 2000 t 3\n9 0", "version"), (b"h i d m 3", "length")]:
        with pytest.raises(ValueError, match=why):
            list(warc.split_arc(broken))


@pytest.mark.parametrize(
    ("arc", "iso"),
    [
        ("2001", "2001-01-01T00:00:00Z"), ("200112", "2001-12-01T00:00:00Z"), ("20011224", "2001-12-24T00:00:00Z"),
        ("200112241830", "2001-12-24T18:30:00Z"), ("19991231235959", "1999-12-31T23:59:59Z"),
    ],
)
def test_dates(arc, iso):
    assert warc._warc_date(arc) == iso and warc._is_date(arc)
    assert not any(map(warc._is_date, ("", "199", "20011301", "20010230", "2001-01-01", "20000101000060")))


LATIN = "<p>caf\xe9 \xff".encode("latin-1") * 20


def foreign(spark, compress):
    """An archive of another maker: Latin-1 payloads, spaces in URLs, a bare LF header, no HTTP at all."""
    bodies = [b"HTTP/1.0 200 OK\r\nX-Name: caf\xe9\r\n\r\n" + LATIN, b"HTTP/1.0 200 OK\nA: b\n\n" + LATIN, b"dns answer", b"HTTP/1.0 204 No\r\n", b""]
    data = b"filedesc://x 0.0.0.0 2003 text/plain 9\n1 1 maker\n"
    for i, b in enumerate(bodies):
        data += b"http://old.org/a b%d 1.2.3.4 19970203 text/html %d\n%s\n" % (i, len(b), b)
    return spark.createDataFrame([("old.arc", bytearray(compress(data)))], "path string, content binary")


@pytest.mark.parametrize("compress", [bytes, gzip.compress])
def test_legacy_archives(spark, compress):
    rows = warc.convert_arc(foreign(spark, compress)).collect()
    assert [bytes(r.payload) for r in rows] == [LATIN, LATIN, b"dns answer", b"", b""]
    assert [None if r.http is None else bytes(r.http) for r in rows][:3] == [b"HTTP/1.0 200 OK\r\nX-Name: caf\xe9", b"HTTP/1.0 200 OK\nA: b", None]
    assert rows[0].uri == "http://old.org/a%20b0" and rows[0].date == "1997-02-03T00:00:00Z" and len({r.record_id for r in rows}) == 5
    records = warc.warc_records(warc.with_record_types(warc.convert_arc(foreign(spark, compress)))).collect()
    data = b"".join(bytes(r.record) + b"\r\n\r\n" for r in records)
    back = warc.read_warc(spark.createDataFrame([(bytearray(data),)], "content binary")).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert [(r.payload_bytes, r.payload_digest, r.record_type) for r in back] == [
        (len(p), sha(p), k) for p, k in [(LATIN, "response"), (LATIN, "response"), (b"dns answer", "resource"), (b"", "response"), (b"", "resource")]
    ]


def test_archives_are_bounded_by_bytes_and_compressed_by_record(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 50_000)
    pages = spark.createDataFrame([(i, f"http://a/{i}", "x" * (200 if i % 50 else 70_000), "d", 1) for i in range(400)], PAGES).repartition(2)
    path = warc.write_archives(warc.arc_records(pages), str(tmp_path / "arc"), warc.ARC_END, warc.version_block(1))
    files = warc.read_archives(spark, path).collect()
    whole = [warc.unpacked(bytes(f.content)) for f in files]
    assert sum(len(list(warc.split_arc(w))) for w in whole) == 400 and all(w.startswith(b"filedesc:") for w in whole)
    assert all(len(w) < 53_000 or len(list(warc.split_arc(w))) == 1 for w in whole)
    assert all(bytes(f.content).count(b"\x1f\x8b\x08") >= len(list(warc.split_arc(w))) for f, w in zip(files, whole, strict=True))
    with pytest.raises(ValueError, match="ends early"):
        warc.unpacked(bytes(files[0].content)[:-40])


def test_warc_records_are_well_formed(spark):
    pages = spark.createDataFrame([(*r, "d", 1) for r in ROWS[:3]], PAGES)
    arc = spark.createDataFrame(
        [("x", bytearray(gzip.compress(b"".join(bytes(r.record) + b"\n" for r in warc.arc_records(pages).collect()))))], "path string, content binary"
    )
    records = warc.warc_records(warc.with_record_types(warc.convert_arc(arc))).collect()
    data = warc.warc_info() + warc.WARC_END + b"".join(bytes(r.record) + warc.WARC_END for r in records)
    heads = [h for h, _ in warc.split_warc(data)]
    assert sorted(h["warc-type"] for h in heads) == ["response", "response", "revisit", "warcinfo"]
    assert all({"warc-record-id", "warc-date", "content-type"} <= set(h) for h in heads)
    ids = {h["warc-record-id"]: h for h in heads}
    again = next(h for h in heads if h["warc-type"] == "revisit")
    assert len(ids) == 4 and ids[again["warc-refers-to"]]["x-page-id"] == again["x-refers-to-page-id"] == "3"
    with pytest.raises(ValueError, match="shorter"):
        list(warc.split_warc(data[:-30]))
    with pytest.raises(ValueError, match="no WARC"):
        list(warc.split_warc(b"HTTP/1.1 200\r\n\r\n"))
