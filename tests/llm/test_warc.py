import gzip
import io
import random
import zlib
from pathlib import Path

from gristmill.llm import warc


def brute(rows, least=0):
    data = [(i, (t or "").encode()) for i, _, t in rows]
    top = {}
    for i, b in data:
        top[b] = max(top.get(b, i), i)
    return sorted((i, len(b), warc.base32_sha1(b), "response" if len(b) < least or top[b] == i else "revisit", None if len(b) < least or top[b] == i else f"urn:row:{top[b]}") for i, b in data)


def shown(df):
    return sorted((int(r.record_id[8:]), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


ROWS = [(i, f"http://h/{i}", t) for i, t in enumerate(["a", "b", "a", None, "", "a" * 100_000, "é\r\n\r\nWARC/1.1\r\n", "b", "a"])] + [(99, None, "x\r\ny"), (100, "http://h/\r\nX: y", "z")]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").repartition(3)
    for least in (0, 2):
        path = f"{tmp_path}/a{least}"
        warc.write(df, path, min_revisit_bytes=least)
        for split in (1 << 20, 64, 7):
            got = warc.read(spark, path, split_bytes=split)
            assert shown(got) == brute(ROWS, least)
            assert all(r.digest_ok is not False for r in got.collect())
        payloads = {int(r.record_id[8:]): bytes(r.payload) for r in got.where("record_type = 'response'").collect()}
        assert all(payloads[i] == (t or "").encode() for i, _, t in ROWS if i in payloads)
        for f in Path(path).glob("part-*"):
            gzip.decompress(f.read_bytes())


def test_repeated_rows_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "a")] * 3 + [(2, None, "a"), (None, None, "a")], "page_id long, url string, html string")
    warc.write(df, f"{tmp_path}/r")
    got = warc.read(spark, f"{tmp_path}/r").collect()
    assert sorted(r.record_type for r in got) == ["response"] + ["revisit"] * 4
    warc.write(df.limit(0), f"{tmp_path}/e")
    assert warc.read(spark, f"{tmp_path}/e").count() == 0


def test_scan_owns_each_record_once(tmp_path):
    rng = random.Random(1)
    members, want = b"", []
    for i in range(60):
        body = rng.randbytes(rng.randint(0, 3000)) + warc.MAGIC * 3
        rec = warc.record("response", f"urn:row:{i}", None, body, warc.base32_sha1(body), None, warc.DATE)
        if i % 7 == 0:
            members += zlib.compress(b"noise") + warc.MAGIC + b"\x00junk" + warc.EMPTY_MEMBER
        want.append((len(members), f"<urn:row:{i}>"))
        # stored blocks keep the magic of the body in plain sight
        members += warc._gzip(rec, 0 if i % 2 else 6)
    two = io.BytesIO()
    with gzip.GzipFile(fileobj=two, mode="wb", mtime=0) as g:
        for i in (60, 61):
            g.write(warc.record("response", f"urn:row:{i}", None, b"", "", None, warc.DATE))
            want.append((len(members), f"<urn:row:{i}>"))
    members += two.getvalue()
    (tmp_path / "x.warc.gz").write_bytes(members)
    for step in (50, 1000, 1 << 20):
        got = [(at, h["warc-record-id"]) for s in range(0, len(members), step) for at, h, _ in warc.scan_range(f"{tmp_path}/x.warc.gz", s, min(s + step, len(members)))]
        assert got == want


def test_query_whole(spark, sf):
    from gristmill.llm import queries

    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = queries.op3_warc(spark, sf).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to and f"urn:row:{r.refers_to}") for r in got) == brute(pages)


def test_stores_that_only_spark_reads(spark, tmp_path, monkeypatch):
    """Without a file system of its own the reader takes the bytes from Spark's."""
    df = spark.createDataFrame([(i, f"http://x/{i}", "payload " * i) for i in range(30)], "page_id long, url string, html string")
    warc.write(df.repartition(3), f"{tmp_path}/archive")
    columns = ["file", "offset", "record_id", "payload_digest", "payload"]
    want = sorted(tuple(r) for r in warc.read(spark, f"{tmp_path}/archive").select(*columns).collect())

    def none(path):
        raise ValueError("Unrecognized filesystem type")

    monkeypatch.setattr(warc, "_place", none)
    assert sorted(tuple(r) for r in warc.read(spark, f"{tmp_path}/archive").select(*columns).collect()) == want and len(want) == 30


def test_places():
    assert warc._place("file:///a/b")[1] == "/a/b" and warc._place("dbfs:/a/b")[1] == "/dbfs/a/b" and warc._place("/a/b")[1] == "/a/b"
