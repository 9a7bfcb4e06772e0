import collections
import hashlib

import pytest

from stratum.llm import warc as V

BIG = "<p>é" + "x" * 200


def rows():
    out = [(i, f"http://h{i % 7}.example.org/{i}", f"<html>{i}{'y' * (i * 3)}</html>") for i in range(120)]
    out += [(200 + i, "http://same.example.org/", BIG) for i in range(80)]  # a hot url and a hot payload
    out += [(300, None, None), (301, None, ""), (302, "no scheme", "short"), (303, "http://a/\n\t%x", "short"), (None, "http://n.org/", BIG),
            (None, None, "z" * 150), (None, "http://n2.org/", "z" * 150), (150, "http://z.org/", BIG), (304, "http://big.org/", "w" * 1_000_000), (5, "http://h5.example.org/5", BIG)]
    return out + [out[3], out[3], (150, "http://z.org/", BIG)]


def want(table):
    groups = collections.defaultdict(list)
    for page, _, html in table:
        body = (html or "").encode()
        if len(body) >= V.MIN_REVISIT and page is not None:
            groups[body].append(page)
    out = []
    for page, _, html in table:
        body = (html or "").encode()
        first = min(groups.get(body, [page]))
        revisit = body in groups and page != first
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [V.BLOCK, 3])
def test_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    df = spark.createDataFrame(rows(), "page_id long, url string, html string").selectExpr("*", "'x' AS key", "'x' AS id", "'x' AS digest", "'x' AS first", "'x' AS body")
    got = V.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == want(rows())
    assert V.round_trip(df.where("false")).count() == 0


def test_lookup_gives_whole_payloads_of_the_asked_captures(spark):
    df = spark.createDataFrame(rows(), "page_id long, url string, html string")
    root = V.write(df)
    asked = spark.createDataFrame([(304, "http://big.org/"), (3, "http://h3.example.org/3"), (3, "http://elsewhere.org/"), (10**6, None)], "page_id long, url string")
    got = V.lookup(asked, root, payload=True).collect()
    assert sorted((r.page_id, len(r.payload)) for r in got) == [(3, len(rows()[3][2]))] * 3 + [(304, 1_000_000)]


def test_records_parse_back():
    body = "é\r\n\r\nWARC/1.1\r\n".encode() * 20
    r = V.parse(V._record(7, "http://a/\r\nWARC-Type: x", body, len(body), "d", None))
    assert (r["type"], r["page"], r["payload"], r["size"], r["refers"]) == ("response", 7, body, len(body), None)
    r = V.parse(V._record(None, None, None, 55, "d", 3))
    assert (r["type"], r["page"], r["payload"], r["size"], r["refers"]) == ("revisit", None, None, 55, 3)


def test_one_payload_of_a_third_of_all_pages(spark):
    hot = "<p>" + "x" * 200
    rows = [(i, f"http://h{i % 40}.org/{i}", hot if i % 3 == 0 else ("" if i % 3 == 1 else f"{i} " * 60)) for i in range(1, 6001)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in V.round_trip(pages).collect()}
    assert len(out) == 6000
    for i, _, html in rows:
        revisit = html == hot and i != 3
        assert (out[i].record_type, out[i].refers_to) == (("revisit", 3) if revisit else ("response", None))
        assert (out[i].payload_bytes, out[i].payload_digest) == (len(html), hashlib.sha256(html.encode()).hexdigest())


def test_lookup_has_a_partition_for_every_archive(spark):
    pages = spark.range(2000).selectExpr("id AS page_id", "concat('http://a', id % 90, '.org/', id) AS url", "repeat(concat(id, ' '), 50) AS html")
    root = V.write(pages)
    archives = spark.read.parquet(f"{root}/table").count()
    found = V.lookup(pages, root)
    assert found.rdd.getNumPartitions() == archives and found.count() == 2000
