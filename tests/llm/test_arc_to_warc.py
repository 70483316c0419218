import base64
import gzip
import hashlib
from collections import Counter

import pytest

from keelson.llm import arc_to_warc as A


@pytest.fixture()
def pages():
    return [(1, "http://a.net/x", "<p>é</p>"), (2, "http://b.net/", "same"), (3, "http://c.net/", "same"), (4, None, ""), (5, "http://d e.net/\n", None),
            (6, "http://f.net/", "a\r\n\r\nWARC/1.1\r\n\r\nhttp://x 1 2 text/plain 5\nfiledesc://y"), (7, "http://g.net/", "same"), (7, "http://g.net/", "same"),
            (None, "http://h.net/", "alone"), (None, "http://h.net/", "same"), (8, "", "x" * 2_000_000), (9, "http://i.net/", "\n\n1 0\n")]


def brute(pages):
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    out = Counter()
    for i, _, h in pages:
        data = (h or "").encode()
        again = last[h or ""] >= 0 and i != last[h or ""]
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response",
            last[h or ""] if again else None] += 1
    return out


def table(spark, pages):
    return spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id bigint, url string, html string, offset int, value string")


def test_round_trip(spark, pages):
    assert Counter(tuple(r) for r in A.round_trip(table(spark, pages)).collect()) == brute(pages)
    assert A.round_trip(table(spark, [])).collect() == []


def test_payloads_survive_both_versions(spark, pages, tmp):
    for version in (1, 2):
        A.write_arc(table(spark, pages), f"{tmp}/v{version}", version)
        rows = A.read_arc(spark, f"{tmp}/v{version}").collect()
        assert Counter((r["page_id"], bytes(r["payload"]).decode(), r["version"]) for r in rows) == Counter((i, h or "", version) for i, _, h in pages)
        assert {r["url"] for r in rows} >= {"unknown:", "http://a.net/x"} and all(" " not in r["url"] for r in rows)


def arc(version, *records):
    about = f"{version} 0 someone\n{A._V1 if version == 1 else A._V2}\n".encode()
    body = A._arc_line(version, "filedesc://old.arc", "text/plain", len(about)).encode() + about + b"\n"
    return gzip.compress(body + b"".join(records))


def test_legacy_headers_and_damage():
    v1 = b"http://a/ 1.2.3.4 19990203040506 text/html 5\nhello\n"
    plain = [r for r in A.arc_records(arc(1, v1, b"rubbish line\n", v1, b"http://b/ 1.2.3.4 1999 text/html 50\ncut"))]
    assert [(r.url, r.body) for r in plain[1:]] == [("http://a/", b"hello")] * 2
    v2 = b"http://a/ 1.2.3.4 19990203040506 text/html 404 abc - 77 old.arc 5\nhello\n"
    two = [r for r in A.arc_records(arc(2, v2, v1))]  # a version 1 line is none of version 2
    assert [(r.version, r.date, r.body) for r in two[1:]] == [(2, "19990203040506", b"hello")]
    assert [r.version for r in A.arc_records(gzip.compress(v1 + v2))] == [1, 2]  # without a description
    assert list(A.arc_records(gzip.compress(b""))) == []


def test_synthesised_fields():
    assert A.warc_date("19990203040506") == "1999-02-03T04:05:06Z" and A.warc_date("1999") == "1999-01-01T00:00:00Z"
    a, b = (A.record_id("x.arc", n, "http://a/", "1999") for n in (0, 1))
    assert a != b and a == A.record_id("x.arc", 0, "http://a/", "1999")
    kinds = [next(A.warc_records(gzip.compress(A.warc_record("x.arc", 0, "dns:a", "1", "1999", 3, http, b"data", "D", to) + b"\n")))
             for http, to in ((b"", None), (b"HTTP/1.0 200 OK\r\n\r\n", None), (b"HTTP/1.0 200 OK\r\n\r\n", 9))]
    assert [(f["warc-type"], block) for f, block in kinds] == [
        ("resource", b"data"), ("response", b"HTTP/1.0 200 OK\r\n\r\ndata"), ("revisit", b"HTTP/1.0 200 OK\r\n\r\n")]


def test_convert_keeps_small_payloads_as_responses(spark, pages, tmp):
    A.write_arc(table(spark, pages), f"{tmp}/arc", 1)
    A.convert(spark, f"{tmp}/arc", f"{tmp}/warc", least=5)
    rows = A.read_warc(spark, f"{tmp}/warc").collect()
    assert len(rows) == len(pages) and all(r["record_type"] == "response" for r in rows if r["payload_bytes"] < 5)


def test_pages_named_like_descriptions_are_pages(spark):
    pages = [(i, f"filedesc://{i}", f"text {i % 3}") for i in range(8)]
    assert Counter(tuple(r) for r in A.round_trip(table(spark, pages)).collect()) == brute(pages)


def test_plain_files_and_foreign_headers(spark, tmp):
    page = b"HTTP/1.1 200 OK\r\nX-Page-Id: seven\r\n\r\nbody"
    record = b"http://a/ 1.2.3.4 1999 text/html %d\n" % len(page) + page + b"\n"
    for name, data in (("plain.arc", gzip.decompress(arc(1, record))), ("packed.arc.gz", arc(1, record))):
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(data)
    rows = A.read_arc(spark, tmp).collect()
    assert [(r["page_id"], bytes(r["payload"])) for r in rows] == [(None, b"body")] * 2


def test_files_are_bounded_by_bytes(spark, tmp, monkeypatch):
    pages = [(i, f"http://{i}/", "x" * (100 if i % 4 else 10_000 + i)) for i in range(200)] + [(500, "http://l/", "y" * 90_000)]
    A.write_arc(table(spark, pages).coalesce(1), tmp, 1, file_bytes=50_000)
    files = [list(A.arc_records(bytes(f["content"]))) for f in
             spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(tmp).collect()]
    sizes = [sum(len(r.body) for r in f[:-1]) for f in files]
    assert len(files) > 10 and max(sizes) <= 50_000 and all(f[0].described for f in files)
    assert len({r["archive"] for r in A.read_arc(spark, tmp).collect()}) == len(files)
    monkeypatch.setattr(A.write_arc, "__defaults__", (*A.write_arc.__defaults__[:-1], 50_000))
    monkeypatch.setattr(A.write_warc, "__defaults__", (*A.write_warc.__defaults__[:-1], 50_000))
    assert Counter(tuple(r) for r in A.round_trip(table(spark, pages)).collect()) == brute(pages)
