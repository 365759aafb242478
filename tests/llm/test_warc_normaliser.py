import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tripkpi.llm import warc_normaliser as M


def brute(rows, least=0):
    """(id, url, html) -> rows of (id, bytes, digest, type, refers_to)."""
    out = []
    for i, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        top = max(ids) if ids and len(body) >= least else None
        again = top is not None and i != top
        out.append((i, len(body), digest, "revisit" if again else "response", top if again else None))
    return out


def odd_pages():
    same = "<p>same payload</p>"
    rows = [(1, "http://a/1", same), (2, "http://b/2?x=1", same), (9, None, same), (9, None, same), (3, "", "<p>own</p>"),
            (4, "http://c/\r\nWARC-Type: x y\t\x01", "x" * 3_000_000), (5, "http://d/é", None), (6, "http://d/6", ""),
            (7, "http://e/7", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3), (8, "u", "\x00 nul é 中 \U0001f600"),
            (None, "http://n/", "null id"), (None, "http://n/", "null id"), (None, "http://n/2", same), (10, "http://f/", "null id too")]
    return rows


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(odd_pages(), "page_id long, url string, html string").repartition(3)
    for c in ("payload", "digest", "refers_to", "record", "offset", "archive", "other_id", "n"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_odd_pages(spark, pages, least):
    back = M.archived(pages, min_bytes=least, payloads=True).collect()
    got = sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back)))
    assert got == sorted(map(repr, brute(odd_pages(), least)))
    texts = {(i, h or "") for i, _, h in odd_pages()}
    for r in back:
        if r.record_type == "response":
            assert (r.page_id, bytes(r.payload).decode()) in texts
        else:
            assert r.payload is None


def test_urls_keep_to_their_line(spark, pages):
    urls = {r.page_id: r.target_uri for r in M.archived(pages).collect() if r.page_id is not None}
    assert urls[4] == "http://c/%0D%0AWARC-Type:%20x%20y%09%01" and urls[5] == "http://d/é" and urls[9] is None


def test_revisits_resolve_to_their_payload(spark, pages):
    whole = M.resolved(M.archived(pages, payloads=True)).collect()
    assert sorted((str(r.page_id), bytes(r.payload).decode()) for r in whole) == sorted((str(i), h or "") for i, _, h in odd_pages())


def test_empty_table(spark, pages):
    assert M.archived(pages.limit(0)).count() == 0


def inside(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_members_and_index(spark, pages, tmp_dir):
    M.archived(pages, path=tmp_dir).count()
    index = M.read_index(spark, f"{tmp_dir}/warc").collect()
    assert len(index) == len(odd_pages())
    by_file = {}
    for e in index:
        by_file.setdefault(e.archive, []).append(e)
    whole = []
    for path, entries in by_file.items():
        with open(inside(path), "rb") as f:
            data = f.read()
        at = 0
        for e in sorted(entries, key=lambda e: e.offset):
            assert e.offset == at
            member = zlib.decompressobj(31)
            record = member.decompress(data[at:at + e.length])
            assert member.eof and not member.unused_data and record.endswith(b"\r\n\r\n") and record.startswith(b"WARC/1.1")
            assert f"WARC-Record-ID: {e.record_id}\r\n".encode() in record and f"WARC-Type: {e.record_type}\r\n".encode() in record
            at += e.length
        assert at == len(data)
        whole.append(gzip.decompress(data))
    # the monolithic files are one member each, of the same bytes
    old = []
    for r in spark.read.format("binaryFile").load(f"{tmp_dir}/monolithic").collect():
        member = zlib.decompressobj(31)
        text = member.decompress(bytes(r.content))
        assert member.eof and not member.unused_data
        old.append(text)
    assert sorted(t for t in old if t) == sorted(t for t in whole if t)


def record(body, name="<urn:x-page:1>"):
    return f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: {name}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("chunk", [3, 50, 1 << 20])
def test_foreign_streams(monkeypatch, chunk):
    monkeypatch.setattr(M, "CHUNK", chunk)
    rng = random.Random(chunk)
    bodies = [bytes(rng.choice(b"ab\r\n") for _ in range(rng.choice([0, 1, 7, 400]))) for _ in range(20)]
    plain = b"".join(record(b, f"<urn:x-page:{k}>") for k, b in enumerate(bodies))
    cuts = sorted(rng.sample(range(len(plain)), 5))
    members = b"".join(gzip.compress(plain[a:b]) for a, b in zip([0, *cuts], [*cuts, len(plain)]))
    for data in (plain, gzip.compress(plain), members):
        out = io.BytesIO()
        entries = M.rewrite(io.BytesIO(data), out)
        for (at, size, name, kind), (k, b) in zip(entries, enumerate(bodies), strict=True):
            assert gzip.decompress(out.getvalue()[at:at + size]) == record(b, f"<urn:x-page:{k}>")
            assert (name, kind) == (f"<urn:x-page:{k}>", "resource")
    for broken in (plain[:-len(bodies[-1]) - 10], gzip.compress(plain)[:-30], gzip.compress(plain[3:]), plain + b"junk"):
        with pytest.raises((ValueError, zlib.error)):
            M.rewrite(io.BytesIO(broken), io.BytesIO())


def test_broken_archive_is_named(spark, tmp_dir):
    whole = gzip.compress(record(b"abc") * 50)
    spark.createDataFrame([("x",)], "value string").write.text(f"{tmp_dir}/in")      # makes the folder
    with open(f"{inside(tmp_dir)}/in/cut.gz", "wb") as f:
        f.write(whole[:-9])
    with pytest.raises(Exception, match="cut.gz.*ends inside"):
        M.normalise(spark, f"{tmp_dir}/in", f"{tmp_dir}/out")


def test_digest_in_base32(spark, docs):
    rows = docs.select("text", M.base32_sha1(F.col("text").cast("binary")).alias("d")).where("text is not null").limit(50).collect()
    for r in rows:
        assert r.d == base64.b32encode(hashlib.sha1(r.text.encode()).digest()).decode()
