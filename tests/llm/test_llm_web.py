"""URL rules and WARC captures against plain versions."""

import base64
import gzip
import hashlib

import duckdb
import pytest

from relaydesk.llm import queries, url_filter, warc

URLS = [
    None, "", "no scheme", "http://", "http://a.org", "http://a.org/", "HTTP://A.ORG/x", "http://notorg/", "http://example.org/es/1",
    "http://b.Example.org/es/", "http://example.org/en/1234?x#y", "http://example.org/en/2", "http://xexample.org/es/1",
    "http://a.com/fr/", "http://a.com/de/x", "http://a.com/de", "http://a.net?x=http://b.org/", "http://a.com#/fr/", "x://y://org/",
    "http://a.org/" + "long/" * 500, "http://a.org/",
]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


@pytest.mark.parametrize("limit", [url_filter.BROADCAST_RULES, 0])
def test_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", limit)
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)], "page_id long, url string, host string, verdict string")
    out = url_filter.judge(pages, url_filter.rule_table(spark, queries.URL_RULES)).collect()
    assert len(out) == len(URLS)
    for row in out:
        assert (row.host, row.path, row.rule, row.verdict) == plain(row.url, queries.URL_RULES)


def test_rules_are_those_of_the_contract(spark, tmp_path):
    urls = ["http://example.org/en/1x", "http://a.example.org/en/1", "http://example.org/en/2", "http://example.org/es/", "http://b.com/fr/", "http://b.com/de/", "http://b.net/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    out = queries.op3_url_filter(spark, str(tmp_path)).orderBy("page_id").collect()
    assert [r.verdict for r in out] == ["block", "block", "allow", "block", "allow", "block", "allow"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    found = con.execute(queries.SQL["op3_url_filter"] + " ORDER BY page_id").fetchall()
    assert found == [tuple(r) for r in out]


def test_rule_edges(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c"), (None, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.judge(pages, none, default="block").collect()} == {"block"}
    odd = url_filter.rule_table(spark, [("A.b", "/c", "allow"), ("a.b", "/c", "block"), ("", "/c", "allow"), (None, "/", "block"), ("b", None, "block")])
    out = url_filter.judge(pages, odd).collect()
    assert len(out) == 3 and {(r.rule, r.verdict) for r in out} == {("a.b/c", "block")}
    assert url_filter.judge(pages.limit(0), odd).count() == 0


PAGES = [
    (1, "http://a.org/1", "same"), (5, "http://a.org/5", "same"), (3, None, "same"), (2, "http://a.org/2", ""), (4, "http://a.org/4", None),
    (6, "http://a.org/\r\n6", "line\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (7, "http://a.org/7", "ü" * 5000), (None, "http://n", "own"),
    (8, "http://a.org/8", "twice"), (8, "http://a.org/8", "twice"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_captures(spark, tmp_path, least):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, type string")
    warc.write_archive(pages.repartition(3), str(tmp_path / "a"), revisit_from=least)
    out = {r.key: r for r in warc.captures(spark, str(tmp_path / "a")).collect()}
    assert set(out) == {p[0] for p in PAGES}
    for key, url, html in PAGES:
        payload = (html or "").encode()
        twins = [p[0] for p in PAGES if (p[2] or "") == (html or "") and p[0] is not None]
        original = max(twins, default=key)
        revisit = len(payload) >= least and original != key
        row = out[key]
        assert row.type == ("revisit" if revisit else "response")
        assert row.refers_to_key == (original if revisit else None)
        assert row.response.payload_bytes == len(payload)
        assert row.response.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert bytes(row.response.payload) == (b"" if revisit else payload)
        assert row.request.head.startswith("GET ") and row.metadata is not None
        assert row.response.target_uri == (url and url.replace("\r", "%0D").replace("\n", "%0A"))


def test_archives_are_warc_and_plain_ones_are_read(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.org/", "x")], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    (file,) = (tmp_path / "a").glob("*.gz")
    content = gzip.decompress(file.read_bytes())
    assert content.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and content.endswith(b"\r\n\r\n")
    # one gzip member for each record, and no gzip at all
    parts = [b"WARC/1.1" + p for p in content.split(b"WARC/1.1")[1:]]
    for name, data in (("members", b"".join(map(gzip.compress, parts))), ("plain", content)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.gz").write_bytes(data)
        row = warc.captures(spark, str(tmp_path / name)).first()
        assert (row.key, row.type, bytes(row.response.payload)) == (1, "response", b"x")


def test_no_pages(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "a"))
    assert warc.captures(spark, str(tmp_path / "a")).count() == 0


def test_records_without_partners(spark):
    rows = [
        ("r", "response", None, None, None, None, "", 1, "d", b"x"),
        ("r", "response", None, None, None, None, "", 1, "d", b"x"),
        ("q", "request", None, None, "elsewhere", None, "", 0, "d", None),
        (None, "response", None, None, None, None, "", 0, "d", None),
        ("v", "revisit", None, None, None, "gone", "", 3, "d", None),
    ]
    out = {r.record_id: r for r in warc.assemble(spark.createDataFrame(rows, warc.RECORDS)).collect()}
    assert set(out) == {"r", "v"} and out["r"].request is None and out["v"].refers_to_key is None
