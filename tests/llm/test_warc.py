import gzip
import hashlib
import re
from pathlib import Path

import pytest
from helpers import CLASHES

from herald.llm import warc as W

SCHEMA = "page_id long, url string, html string"
LONG = "<p>" + "long text " * 20 + "</p>"


def embedded():
    """Pages that hold records, cuts and ends of records themselves."""
    inner = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    return [(50, "http://a/e", f"<pre>{inner}{inner}</pre>" + LONG), (51, "http://a/f", "\r\n\r\nWARC/1."),
            (52, "http://a/g", W.CUT * 4 + LONG), (53, "http://a/h", "x\r\n\r\n"), (54, "http://a/i", "\r\n\r\n" + LONG),
            (55, "http://a/j", f"a\r\n\r\nWARC/1.1\r\nContent-Length: 999999\r\n\r\n{LONG}")]


def pages():
    return [(1, "http://a.example/x?y=1#z", LONG), (2, "https://b.example", LONG), (3, "http://c/", LONG + "1"),
            (4, "http://d/", "short"), (5, "http://e/", "short"), (6, None, None), (7, "", ""), (8, "u\r\nX: y", "é" * 99),
            (9, "http://f/ü", "é" * 50), (10, "http://g/", "é" * 50), (None, "http://h/", LONG), (11, "http://i/", "y" * 99),
            (12, "http://i/", "y" * 99), (13, "http://i/", "z" * 100), (14, "http://i/", "z" * 100),
            (15, "http://k/", "w" * 3_000_000)]


def brute(rows):
    out, first = [], {}
    for i, _, t in rows:
        d = (t or "").encode()
        if len(d) >= 100 and i is not None:
            first[d] = min(first.get(d, i), i)
    for i, _, t in rows:
        d = (t or "").encode()
        again = len(d) >= 100 and i != first[d]
        out.append((i, len(d), hashlib.sha256(d).hexdigest(), "revisit" if again else "response",
                    first[d] if again else None))
    return sorted(out, key=repr)


def parse(data: bytes):
    """A sequential reader: (headers, block) of each record by its Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield head, data[end + 4:end + 4 + size]
        assert data[end + 4 + size:end + 8 + size] == b"\r\n\r\n"
        at = end + 8 + size


@pytest.mark.parametrize("more", [[], embedded()])
def test_round_trip(spark, tmp_path, more):
    rows = pages() + more
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = W.archived_pages(df, str(tmp_path / "w"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_archives_follow_the_format(spark, tmp_path):
    rows = pages() + embedded()
    W.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(2), str(tmp_path / "w"), date="2024-01-02T03:04:05Z")
    found = [r for f in sorted(Path(tmp_path / "w").glob("*.gz")) for r in parse(gzip.open(f).read())]
    kinds = [h["WARC-Type"] for h, _ in found]
    assert kinds.count("request") == kinds.count("metadata") == len(rows)
    assert kinds.count("response") + kinds.count("revisit") == len(rows)
    ids = {h["WARC-Record-ID"]: h for h, _ in found}
    assert len(ids) == len(found) and all(re.fullmatch("<urn:uuid:[0-9a-f-]{36}>", i) for i in ids)
    for h, block in found:
        assert h["WARC-Date"] == "2024-01-02T03:04:05Z"
        if "WARC-Concurrent-To" in h:
            assert ids[h["WARC-Concurrent-To"]]["WARC-Type"] in ("response", "revisit")
        if h["WARC-Type"] == "response":
            http, payload = block.split(b"\r\n\r\n", 1)
            assert h["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
            assert f"Content-Length: {len(payload)}".encode() in http
        if h["WARC-Type"] == "revisit":
            to = ids[h["WARC-Refers-To"]]
            assert to["WARC-Type"] == "response" and to["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]


@pytest.mark.parametrize("split", [300])
def test_files_split_anywhere(spark, tmp_path, split):
    """A session with tiny splits, uncompressed archives, with and without cuts inside payloads."""
    rows = [r for r in pages() if r[0] != 15]
    for name, more in (("plain", []), ("cuts", embedded())):
        path = str(tmp_path / name)
        W.write_warc(spark.createDataFrame(rows + more, SCHEMA).coalesce(1), path, compression="none")
        want = W.read_warc(spark, path, payload=True).toPandas()
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = W.read_warc(spark, path, payload=True).toPandas()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        key = lambda d: sorted(zip(d.record_id, d.record_type, d.payload.map(bytes)))
        assert key(got) == key(want) and bool(got.whole.all())
        raw = b"".join(f.read_bytes() for f in Path(path).glob("part-*"))
        assert sorted(h["WARC-Record-ID"] for h, _ in parse(raw)) == sorted(got.record_id)


def test_long_payloads_of_line_breaks_and_cuts(spark, tmp_path):
    """Every place of a read buffer's end meets line breaks or parts of a cut."""
    rows = [(1, "http://a", "\r\n" * 300_000), (2, "http://b", "\r\n\r\n\r\nWARC/1" * 60_000),
            (3, "http://c", (W.CUT + "\r\n") * 50_000), (4, "http://d", "x\r\n\r" * 100_001)]
    for kind in ("gzip", "none"):
        W.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / kind), compression=kind)
        got = W.read_warc(spark, str(tmp_path / kind)).filter("record_type = 'response'").collect()
        assert sorted((r.payload_bytes, r.payload_digest) for r in got) == sorted(x[1:3] for x in brute(rows))


def test_no_record_is_missed_where_a_read_buffer_ends(spark, tmp_path):
    """Records end with line breaks of their own before the cut, at every place of a buffer's end."""
    rows = [(i, f"http://a/{'x' * (i % 11)}", "z" * (i % 7) + "\r\n" * (i % 3)) for i in range(40_000)]
    for kind in ("gzip", "none"):
        W.write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / kind), compression=kind)
        pieces = W._pieces(spark, str(tmp_path / kind))
        assert pieces.count() == 120_000
        got = W.read_warc(spark, str(tmp_path / kind))
        assert {r.record_type: r["count"] for r in got.filter("whole").groupBy("record_type").count().collect()} \
            == dict.fromkeys(("request", "response", "metadata"), 40_000)


def foreign(kind, name, *more, block="", end="\r\n\r\n"):
    head = [f"warc-type:{kind}", f"WARC-Record-ID: <{name}>", *more, f"content-length:  {len(block.encode())}"]
    return "WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n" + block + end


def test_foreign_transactions(spark, tmp_path):
    http = "Content-Type: application/http; msgtype=response"
    text = (foreign("warcinfo", "i", block="software: x\r\n")
            + foreign("response", "r1", http, "WARC-Concurrent-To: <q1>", block="HTTP/1.0 200 OK\r\nA: b\r\n\r\npay\r\n\r\nload")
            + foreign("request", "q1", block="GET / HTTP/1.0\r\n\r\n")
            + foreign("metadata", "m2", "WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <r2>", block="page-id: 7\r\n")
            + foreign("metadata", "m1", "WARC-Concurrent-To: <r1>", block="via: z\r\n")
            + foreign("resource", "r2", block="plain")
            + foreign("revisit", "r3", http, "WARC-Refers-To: <elsewhere>", "WARC-Payload-Digest: sha256:ab")
            + foreign("request", "lost", "WARC-Concurrent-To: <nowhere>"))
    (tmp_path / "a.warc").write_bytes(text.encode())
    (tmp_path / "b.warc").write_bytes(foreign("response", "cut", http, block="HTTP/1.0 200 OK\r\n\r\nabcdef")[:-8].encode())
    recs = W.read_warc(spark, str(tmp_path), payload=True)
    rows = {r.record_id: r for r in W.with_originals(W.captures(recs), ["payload_bytes"]).collect()}
    assert set(rows) == {"<r1>", "<r2>", "<r3>", "<cut>"}
    r1 = rows["<r1>"]
    assert bytes(r1.payload) == b"pay\r\n\r\nload" and r1.payload_bytes == 11
    assert [x.record_id for x in r1.requests] == ["<q1>"] and [x.record_id for x in r1.metadata] == ["<m1>", "<m2>"]
    assert rows["<r2>"].payload_bytes == 5 and [x.record_id for x in rows["<r2>"].metadata] == ["<m2>"]
    assert rows["<r3>"].original is None and rows["<r3>"].stated_digest == "ab" and not rows["<r3>"].requests
    assert not rows["<cut>"].whole and bytes(rows["<cut>"].payload) == b"ab"


def test_hot_payload_empty_table_and_clashes(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = [(i, f"http://x/{i}", LONG if i % 3 else f"{i}" * 60) for i in range(3000)] + [(5, "http://x/5", LONG)] * 2
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("?") for c in (*CLASHES, "nr", "digest", "payload", "file")})
    got = [tuple(r) for r in W.archived_pages(df, str(tmp_path / "h")).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert W.archived_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "e")).count() == 0
