"""WARC archives and URL filtering."""

import base64
import hashlib

import pytest

from llm import url_filter as U
from llm import warc as W
from tidecast.session import scratch_path

PAGES = [
    (5, "http://a.example/x", "<p>same</p>"), (3, "http://b.example", "<p>same</p>"),
    (9, "http://c.example", "é" * 30_000), (4, None, None), (6, "http://d.example", ""),
    (None, "http://e.example", "<p>same</p>"), (None, "http://f.example", "only without an id"),
    (3, "http://b.example", "<p>same</p>"), (7, "http://g.example\r\nX: 1", "WARC/1.1\r\n\r\n0\r\n\r\n"),
    (8, "http://h.example", "x" * W.SEGMENT * 3)]


@pytest.fixture
def pages(spark):
    rows = [(*p, "response", 1, "d") for p in PAGES]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, type string, first int, same string")


def expected():
    out = []
    for page_id, _, html in PAGES:
        body = (html or "").encode()
        first = min((p for p, _, h in PAGES if p is not None and (h or "") == (html or "")),
                    default=None)
        own = page_id == first
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "response" if own else "revisit", None if own else first, True))
    return sorted(out, key=repr)


def test_archives_round_trip(pages):
    found = W.through_archives(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")
    assert sorted(map(tuple, found.collect()), key=repr) == expected()


def test_payloads_return(spark, pages):
    path = scratch_path(spark, "warc-test")
    W.write_archives(pages, path)
    back = {r.page_id: bytes(r.payload) for r in W.read_archives(spark, path).collect()
            if r.record_type == "response" and r.page_id is not None}
    assert back[9] == ("é" * 30_000).encode() and back[7] == b"WARC/1.1\r\n\r\n0\r\n\r\n"


def test_segments_out_of_order_and_lost(spark, tmp_path):
    records = [r.encode() + b"\r\n\r\n" for r in W.records_of(
        1, "u", "0123456789" * 40, None, False, "2024-01-01T00:00:00Z", segment=100)]
    assert len(records) > 4
    for name, some in (("whole", records[::-1]), ("lost", records[:2] + records[3:]),
                       ("no-end", records[:-1])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc").write_bytes(b"".join(some))
    read = {n: W.read_archives(spark, str(tmp_path / n)).collect()
            for n in ("whole", "lost", "no-end")}
    assert [len(r) for r in read.values()] == [1, 1, 1]
    assert read["whole"][0].intact and bytes(read["whole"][0].payload) == b"0123456789" * 40
    assert not read["lost"][0].intact and not read["no-end"][0].intact


def test_chunk_framing():
    assert W.unchunked(W.chunked("aé" * 50, 7).encode()) == ("aé" * 50).encode()
    assert W.unchunked(b"3;name=x\r\nabc\r\n0\r\n\r\n") == b"abc"
    for broken in (b"", b"3\r\nab\r\n0\r\n\r\n", b"zz\r\n", b"-1\r\n\r\n"):
        assert W.unchunked(broken) is None


def test_no_pages(pages):
    assert W.through_archives(pages.limit(0)).collect() == []


URLS = ["http://a.net/x", "https://EXAMPLE.net/en/1", "http://sub.example.net/en/", "http://example.net/de",
        "http://x.example.com/de/9?q=/fr/", "http://y.org/fr/1#f", "http://y.org/de/fr/", "http://z.org",
        "no scheme", "", None, "ftp://Ünder.NET", "http://net", "http://notexample.com/de/",
        "a://b://c.org/fr/", "http://q.net?x=/", "http://evil.com/de/", "http://r.net#a/b"]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if c < "\x80" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fits = [(len(h + p), h + p, v) for h, p, v in U.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1:] if fits else (None, None)


def test_urls(spark):
    rows = [(i, u, "h", 0.1) for i, u in enumerate(URLS)] + [(None, URLS[0], "h", 0.1)] * 2
    found = U.filter_urls(spark.createDataFrame(
        rows, "page_id long, url string, host string, score double")).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, (rule, verdict) = brute(URLS[r.page_id if r.page_id is not None else 0])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))


def test_model_learns_its_table(spark):
    rows = spark.createDataFrame(list(enumerate(u for u, _ in U.LABELLED)), "page_id long, url string")
    found = {r.page_id: r.verdict for r in U.filter_urls(rows, rules=[("none", "/", "allow")]).collect()}
    assert [found[i] for i in range(len(found))] == \
        ["block" if y else "allow" for _, y in U.LABELLED]


def test_no_urls(spark):
    assert U.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
