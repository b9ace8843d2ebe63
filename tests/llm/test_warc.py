import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from daybook.llm import warc
from daybook.sources.session import checkpoint_dir

ROWS = [(i, f"http://www.H{i % 7}.example.com/a b!{i % 5}?q=%41\t#x" if i % 3 else None, "x" * (i % 4) + "é\r\n\r\nWARC/1.1" if i % 5 else None)
        for i in range(60)]
ROWS += [(None, "http://a", "zz"), (None, "http://a", "zz"), (5, "http://a\r\nb", "zz"), (5, "http://a", "zz"), (70, "", "x" * 300_000), (71, "é/ü", ""),
         (None, "http://only", "without an id"), (None, None, "without an id")]


def _want(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, u, h in rows:
        payload = (h or "").encode()
        f = first.get(h or "")
        whole = f is None or i == f or len(payload) < min_bytes
        out.append((i, u, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if whole else "revisit",
                    None if whole else f, payload if whole else None))
    return sorted(out, key=repr)


def _got(df):
    return sorted([(r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
                   for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    for c in ("key", "page", "bytes", "sha1", "archive", "payload", "n", "first"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.mark.parametrize("small", [True, False])
def test_pages_come_back(spark, pages, small):
    kw = {"archive_bytes": 2000, "part_captures": 7} if small else {}
    assert _got(warc.archive_pages(pages, **kw)) == _want(ROWS)
    assert _got(warc.archive_pages(pages, min_bytes=5, **kw)) == _want(ROWS, 5)
    assert warc.archive_pages(pages.where("false"), **kw).count() == 0


def test_copies_without_a_broadcast(spark, pages, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_BYTES", 0)
    assert _got(warc.archive_pages(pages)) == _want(ROWS)


def test_index_finds_what_there_is(spark, pages, monkeypatch):
    """Blocks of few lines, one key over many blocks and parts, keys that are not there."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    monkeypatch.setattr(warc, "HEAD_CHARS", 6)  # parts' first keys cut short
    monkeypatch.setattr(warc, "TASK_LOOKUPS", 3)
    folder = f"{checkpoint_dir(spark)}/warc-test"
    rows = [(i, f"http://{'hot' if i % 2 else f'h{i % 11}'}.example.com/") for i in range(200)]
    records = warc.plan_records(spark.createDataFrame([(i, u, f"p{i}") for i, u in rows], "page_id long, url string, html string"))
    directory = warc.write_index(warc.write_archives(records.repartition(3), f"{folder}/a"), f"{folder}/i", part_captures=20)
    assert directory.count() > 3 and directory.select(F.explode("heads")).count() > 20
    keys = spark.createDataFrame([(k,) for k in ["com,example,hot)/", "com,example,h4)/", "com,example,h4)/", "", "com,example,", "zz", "com,example,hot)/x", None]], "key string")
    found = warc.lookup(keys, directory, f"{folder}/i")
    assert sorted(int(r.page) for r in found.collect()) == sorted(i for i, u in rows if i % 2 or i % 11 == 4)
    texts = {r.page: bytes(r.payload).decode() for r in warc.read_ranges(found, f"{folder}/a").collect()}
    assert all(texts[k] == f"p{k}" for k in texts)


def test_archives_are_gzip_members(spark, pages, tmp_path):
    """Read one after the other, without the index."""
    warc.write_archives(warc.plan_records(pages.repartition(2)), str(tmp_path / "w"), archive_bytes=3000)
    files, kinds = list((tmp_path / "w").glob("*.warc.gz")), []
    assert len(files) > 2
    for f in files:
        raw, at = gzip.decompress(f.read_bytes()), 0
        while at < len(raw):
            head, _, _ = raw[at:].partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            at += len(head) + 4 + int(fields["Content-Length"]) + 4
            assert raw[at - 4:at] == b"\r\n\r\n"
            kinds.append(fields["WARC-Type"])
    assert sorted(kinds) == sorted(r[4] for r in _want(ROWS))


def test_damage_is_an_error():
    record = warc.write_record("response", "1", "http://a", 3, warc._digest(b"abc"), None, b"abc", "1970-01-01T00:00:00Z")
    assert warc.read_record(gzip.compress(record)).payload == b"abc"
    with pytest.raises(ValueError):
        warc.read_record(gzip.compress(record.replace(b"abc", b"abd")))
    with pytest.raises(ValueError):
        warc.read_record(gzip.compress(record[:-4]))


def test_url_keys(spark):
    urls = {"http://www.Example.COM:80/a/B?c=D#e": "com,example)/a/B?c=D", "https://u:p@a.b.c": "c,b,a)", "http://a.b?x": "b,a)?x", "no url": "no url",
            "ftp://x.y/ü": "y,x)/ü", "": "", None: "", "http://[::1]/x": "["}
    got = {r.u: r.k for r in spark.createDataFrame([(u,) for u in urls], "u string").select("u", warc.url_key(F.col("u")).alias("k")).collect()}
    assert {u: k for u, k in got.items() if u != "http://[::1]/x"} == {u: k for u, k in urls.items() if u != "http://[::1]/x"}
