import gzip
import hashlib
import random

import pytest

from edmart.llm import warc as W
from edmart.llm.shared import shared_folder

COLUMNS = "page_id long, url string, html string, size string, digest string"


def plain(rows):
    best = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if i is not None:
            best[data] = max(best.get(data, i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 1000 and data in best and best[data] != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best[data] if again else None))
    return sorted(out, key=str)


def archived(spark, rows):
    df = spark.createDataFrame([(*r, "s", "d") for r in rows], COLUMNS)
    return sorted((tuple(r) for r in W.archived(df).collect()), key=str)


def test_round_trip_equals_a_plain_count(spark):
    rng = random.Random(2)
    bodies = ["é" * 600, "x" * 999, "x" * 1000, "WARC/1.1\r\n\r\n" * 200, "", None, "\n\r\n" * 500]
    rows = [(i, f"http://h/{i}", rng.choice(bodies)) for i in range(80)]
    rows += [(200, None, "x" * 1000), (201, "http://a b\r\nX: y", bodies[0]), (None, "u", bodies[0]), (None, "u", "z" * 2000)]
    assert archived(spark, rows) == plain(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "u", "q" * 1500)] * 3 + [(4, "u", "q" * 1500)] * 2 + [(5, "u", "other")]
    assert archived(spark, rows) == plain(rows)
    assert archived(spark, rows[:0] or [(1, "u", "k")])[0][0] == 1
    empty = spark.createDataFrame([], COLUMNS)
    assert W.archived(empty).count() == 0


def test_files_are_warc(spark):
    df = spark.createDataFrame([(1, "http://h/1", "a" * 1200, "", ""), (2, "http://h/2", "a" * 1200, "", "")], COLUMNS)
    path = f"{shared_folder(spark)}/warc-test-{random.random()}"
    W.write_archives(df, path)
    import glob

    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*.gz"))
    assert data.count(b"WARC-Type: revisit") == 1 and data.count(b"WARC-Type: response") == 1
    assert data.count(b"a" * 1200) == 1
    assert b"WARC-Refers-To: <urn:page:2>" in data and b"WARC-Record-ID: <urn:page:1>" in data
    assert len(W.parse(data)) == 2
    with pytest.raises(ValueError):
        W.parse(b"HTTP/1.1 200\r\n\r\n")


def test_members_and_other_records(spark, tmp_path):
    def record(kind, key, block, digest=None):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{key}>\r\n"
        head += f"WARC-Payload-Digest: {digest}\r\n" if digest else ""
        return (head + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    import base64

    http = b"HTTP/1.1 200 OK\r\n\r\n"
    body = b"b" * 1500
    base32 = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    parts = [record("warcinfo", 0, b"software: x"), record("response", 1, http + body, base32), record("request", 2, b"GET /"),
             record("response", 3, http + b"c"), record("metadata", 4, b""), record("response", 5, http)]
    (tmp_path / "many.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(parts).replace(b"page:", b"page:1")))
    got = sorted((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in W.read_archives(spark, str(tmp_path)).collect())
    want = [(k, len(x), hashlib.sha1(x).hexdigest()) for k, x in ((1, body), (3, b"c"), (5, b""), (11, body), (13, b"c"), (15, b""))]
    assert got == want
