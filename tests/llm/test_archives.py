import gzip

import pytest

from forecastops.llm import archives as ar


def arc(*records, version=1):
    """An ARC file with its description record."""
    names = {1: b"1 0 Org\nURL IP-address Archive-date Content-type Archive-length\n", 2: b"2 0 Org\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"}[version]
    middle = b"" if version == 1 else b"200 - - 0 f.arc "
    out = b"filedesc://f.arc 0.0.0.0 19990101000000 text/plain " + middle + str(len(names)).encode() + b"\n" + names + b"\n"
    for url, body in records:
        out += url + b" 1.2.3.4 20010203040506 text/html " + middle + str(len(body)).encode() + b"\n" + body + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_arc_round_trip(version):
    bodies = [b"", b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n<p>x</p>", b"\n\nhttp://x 1 2 3 4\n", bytes(range(256)) * 40, b"WARC/1.1\r\n\r\n"]
    found = list(ar.parse_arc(arc(*[(b"http://h/%d" % i, b) for i, b in enumerate(bodies)], version=version)))
    assert found[0][0]["url"].startswith("filedesc:") and [b for _, b in found[1:]] == bodies
    whole = b""
    for fields, body in found:
        whole += ar.arc_to_warc(fields, body) + b"\r\n\r\n"
    again = list(ar.parse_warc(gzip.compress(whole)))
    assert [b for _, b in again] == [b for _, b in found]
    assert [h["warc-type"] for h, _ in again] == ["warcinfo", "resource", "response", "resource", "resource", "resource"]
    assert again[2][0]["warc-date"] == "2001-02-03T04:05:06Z"
    assert again[2][0]["warc-payload-digest"] == "sha1:" + ar.digest(b"<p>x</p>")
    assert len({h["warc-record-id"] for h, _ in again}) == len(again)
    assert ar.arc_to_warc(*found[2]) == ar.arc_to_warc(*found[2])


def test_broken_archives():
    good = arc((b"http://h/", b"body"))
    with pytest.raises(ValueError, match="shorter"):
        list(ar.parse_arc(good[:-3]))
    with pytest.raises(ValueError, match="header line"):
        list(ar.parse_arc(b"no header\n"))
    with pytest.raises(ValueError, match="WARC record"):
        list(ar.parse_warc(b"junk"))


def test_digest():
    assert ar.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_pages(spark):
    rows = [(1, "http://a/", "same", 5), (7, None, "same", 5), (3, "http://b c/\n", "same", 5), (4, "u", None, 5), (5, "u", "", 5), (6, "u", "é\r\n\r\nWARC/1.1\r\n", 5), (8, "u", "long " * 100_000, 5), (None, "u", "same", 5), (9, "u", "\x00", 5)]
    pages = spark.createDataFrame([(i, u, h, n) for i, u, h, n in rows], "page_id long, url string, html string, size int")
    got = {r.page_id: r for r in ar.archive_pages(pages).collect()}
    assert len(got) == len(rows)
    for i, _, h, _ in rows:
        payload = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(payload), ar.digest(payload))
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {
        1: ("revisit", 7), 7: ("response", None), 3: ("revisit", 7), 4: ("revisit", 5), 5: ("response", None), 6: ("response", None),
        8: ("response", None), None: ("revisit", 7), 9: ("response", None),
    }
    least = {r.page_id: r.record_type for r in ar.archive_pages(pages, least=5).collect()}
    assert set(least.values()) == {"response"}
    twice = ar.archive_pages(pages.unionAll(pages.filter("page_id = 7")))
    assert [r.record_type for r in twice.filter("page_id = 7").collect()] == ["response"] * 2
    assert ar.archive_pages(pages.limit(0)).collect() == []


def test_large_ids_stay_exact(spark):
    ids = [2**53 + 1, 2**53 + 3, 2**62, -(2**53) - 1, None]
    pages = spark.createDataFrame([(i, "u", "same") for i in ids] + [(5, "u", "other")], "page_id long, url string, html string").repartition(1)
    got = {r.page_id: r.refers_to for r in ar.archive_pages(pages).collect()}
    assert got == {**{i: 2**62 for i in ids}, 2**62: None, 5: None}
