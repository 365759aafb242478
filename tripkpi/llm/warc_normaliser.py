"""WARC archives: writing, normalising monolithic gzip, and reading by a sidecar index.

A record is a page: ``response`` records hold an HTTP head and the payload,
``revisit`` records the head alone, since another record has an equal payload.
Of the records with equal payloads of at least ``min_bytes`` bytes the one
with the largest id keeps it and the others refer to it.

Spark's text writer writes the archives, one file a task, with the records'
closing blank lines as line separator and gzip over the whole file. Such a
monolithic file can be read from its start only. ``normalise`` mends that: it
inflates each file's stream once, front to back, finds the records by their
declared lengths, and writes every record as a gzip member of its own; beside
each archive it writes a sidecar index (JSON lines: offset and length of each
member, record id and type). Input may also be plain, or of several members
cut anywhere. ``read_records`` deals the index's entries to tasks by ranges of
bytes, so that many tasks share one large archive, and seeks to the members.

Memory: streams pass in chunks of ``CHUNK``; a head is at most ``MAX_HEAD``
bytes; a payload is held only where it is asked for. Files are
written under another name and moved when complete, so that a task that runs
again leaves the same file. Texts are shuffled once, by id and digest, to mark
the revisits; a payload that many pages share is one row a task in the count,
and its rows carry no text when they meet. Archive folders must be of a kind
that ``pyarrow.fs`` opens (local or mounted paths, hdfs, s3, gs).

Defined cases: null html is an empty payload; payloads are equal as bytes; rows
that share the largest id and the payload are all responses; a null id is
smaller than any other, and rows with no other are all responses; a null url
gives no target; control characters and spaces of urls are percent-coded; an
empty table gives no rows; other input columns are ignored. An archive that
ends inside a record, or holds anything else than records, is an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi.llm.tables import bounded_batches, staged
from tripkpi.session import scratch_path

MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
CHUNK = 1 << 20
MAX_HEAD = 1 << 20
READ_BYTES = 8 << 20
LEVEL = 6
BREAK = "\r\n"
URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
ENTRY = "archive string, offset long, length long, record_id string, record_type string"
RECORD = ("page_id long, target_uri string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")


# --- writing -----------------------------------------------------------------------

def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32: 60, 60 and 40 bits by base 32, then the other alphabet."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, n), 16, 32), n * 4 // 5, "0") for at, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), *BASE32)


def payload_rows(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes, digest)."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"),
                       base32_sha1(F.col("payload").cast("binary")).alias("digest"))


def revisits(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload another page keeps."""
    named = staged(rows.where(F.col("payload_bytes") >= min_bytes).select("page_id", "digest"), "warc-digests")
    keeps = named.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    # staged, so that both sides of the join are plain exchanges, of which Spark can split a hot payload's partition
    keeps = staged(keeps.where("n > 1 and refers_to is not null").drop("n"), "warc-kept")
    others = named.join(keeps, "digest").where("page_id is null or page_id < refers_to")
    return others.select("page_id", "digest", "refers_to").distinct()


def _safe_url(url: Column) -> Column:
    for code in (*range(0x21), 0x7F):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _name(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{URN}"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def warc_records(pages: DataFrame, *, min_bytes: int = MIN_BYTES, date: str = DATE, id_col: str = "page_id",
                 url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One WARC record per page, as text without the two closing line breaks, in a column ``record``."""
    rows = payload_rows(pages, id_col, url_col, html_col)
    marked = revisits(rows, min_bytes).select(F.col("page_id").alias("other_id"), F.col("digest").alias("other_digest"), "refers_to")
    rows = rows.join(marked, rows["page_id"].eqNullSafe(marked["other_id"]) & (rows["digest"] == marked["other_digest"]), "left")
    again = F.col("refers_to").isNotNull()

    def line(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))
        return F.coalesce(text if when is None else F.when(when, text), F.lit(""))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}"),
                    line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(BREAK))
    body = F.when(again, F.lit("")).otherwise(F.col("payload"))
    url = F.when(F.col("url").rlike(r"[\x00-\x20\x7f]"), _safe_url(F.col("url"))).otherwise(F.col("url"))
    return rows.select(F.concat(
        F.lit(f"WARC/1.1{BREAK}"), line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _name(F.col("page_id"))), line("WARC-Target-URI", url), line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))), line("WARC-Profile", F.lit(PROFILE), again),
        line("WARC-Refers-To", _name(F.col("refers_to")), again),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")), F.lit(BREAK), http, body).alias("record"))


def write_monolithic(records: DataFrame, path: str) -> None:
    """Archives of one gzip stream each: the writer's line separator closes the records."""
    records.select("record").write.option("lineSep", BREAK * 2).option("compression", "gzip").text(path)


# --- streams -------------------------------------------------------------------------

def opened(path: str):
    """The file system of a path or URI, and the path inside it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return arrow_fs.FileSystem.from_uri(path)


def inflated(stream):
    """Yields the bytes of a gzip stream of any number of members (or of a plain one) in chunks of at most ``CHUNK``."""
    raw = stream.read(CHUNK)
    if raw[:2] != b"\x1f\x8b":
        while raw:
            yield raw
            raw = stream.read(CHUNK)
        return
    member = None
    while raw:
        if member is None:
            member = zlib.decompressobj(31)
        out = member.decompress(raw, CHUNK)
        if out:
            yield out
        raw = member.unused_data if member.eof else member.unconsumed_tail
        if member.eof:
            member = None
        raw = raw or stream.read(CHUNK)
    while member is not None:                             # what the last bytes still hold
        out = member.decompress(member.unconsumed_tail, CHUNK)
        if member.eof:
            member = None
        elif not out:
            raise ValueError("the archive ends inside a gzip member")
        if out:
            yield out


class Records:
    """The records of an inflated stream, one after another."""

    def __init__(self, chunks):
        self.chunks, self.held, self.at = chunks, b"", 0

    def _more(self) -> bool:
        chunk = next(self.chunks, b"")
        if chunk:
            self.held, self.at = self.held[self.at:] + chunk, 0
        return bool(chunk)

    def head(self) -> bytes | None:
        """The next record's header with its blank line; None at the end."""
        while True:
            while self.held[self.at:self.at + 2] == b"\r\n":
                self.at += 2
            if len(self.held) - self.at >= 2 or not self._more():
                break
        if self.at == len(self.held):
            return None
        while (end := self.held.find(b"\r\n\r\n", self.at)) < 0:
            if len(self.held) - self.at > MAX_HEAD or not self._more():
                raise ValueError("a record's header does not end")
        head = self.held[self.at:end + 4]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {head[:40]!r}")
        self.at = end + 4
        return head

    def block(self, size: int):
        """Yields the next ``size`` bytes in chunks."""
        while size:
            if self.at == len(self.held) and not self._more():
                raise ValueError("the archive ends inside a record")
            part = self.held[self.at:self.at + min(size, CHUNK)]
            self.at += len(part)
            size -= len(part)
            yield part


def fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8", "replace").split(BREAK)[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def rewrite(source, target) -> list[tuple[int, int, str, str]]:
    """Copies a stream's records to ``target``, each a member of its own; (offset, length, record id, type) of each."""
    entries, at = [], 0
    records = Records(inflated(source))
    while (head := records.head()) is not None:
        own = fields(head)
        member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        size = target.write(member.compress(head))
        for part in records.block(int(own["content-length"])):
            size += target.write(member.compress(part))
        size += target.write(member.compress(b"\r\n\r\n") + member.flush())
        entries.append((at, size, own.get("warc-record-id", ""), own.get("warc-type", "")))
        at += size
    return entries


def normalise(spark: SparkSession, path: str, out: str, glob: str = "*.gz") -> DataFrame:
    """Rewrites the archives of a folder into ``out``; one row per archive: its path, records and bytes.

    Each file is one stream and so one task's; Spark packs small files together.
    """
    target, inner = opened(out)
    target.create_dir(inner, recursive=True)
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")

    def each(batches):
        for b in batches:
            done = []
            for source in b.column(0).to_pylist():
                name = source.rsplit("/", 1)[-1].removesuffix(".gz").rsplit(".", 1)[0] + ".warc.gz"
                store, inner = opened(source)
                to_store, folder = opened(out)
                own = f"{folder}/_{uuid.uuid4().hex}"
                try:
                    with store.open_input_stream(inner, compression=None) as src, \
                            to_store.open_output_stream(own, compression=None, buffer_size=CHUNK) as dst:
                        entries = rewrite(src, dst)
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{source}: {e}") from e
                with to_store.open_output_stream(f"{own}.idx", compression=None, buffer_size=CHUNK) as idx:
                    for at, size, record, kind in entries:
                        idx.write((json.dumps({"archive": f"{out}/{name}", "offset": at, "length": size, "record_id": record,
                                               "record_type": kind}) + "\n").encode())
                to_store.move(own, f"{folder}/{name}")
                to_store.move(f"{own}.idx", f"{folder}/{name}.idx")
                done.append((f"{out}/{name}", len(entries), sum(e[1] for e in entries)))
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(
                (pa.string(), pa.int64(), pa.int64()))], ["archive", "n_records", "n_bytes"])

    return staged(files.mapInArrow(each, "archive string, n_records long, n_bytes long"), "warc-archives")


# --- reading ---------------------------------------------------------------------------

def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The sidecar indexes of a folder of normalised archives."""
    return spark.read.schema(ENTRY).option("pathGlobFilter", "*.idx").json(path)


def _page(name: str | None) -> int | None:
    inner = (name or "").strip("<>").removeprefix(URN)
    return int(inner) if inner else None


def parse_record(chunks, payloads: bool) -> tuple:
    """A record's page: id, target, type, payload bytes and digest, the id it refers to, the payload if asked for."""
    records = Records(chunks)
    own = fields(records.head())
    head, seen, body, digest = b"", 0, [], hashlib.sha1(usedforsecurity=False)
    for part in records.block(int(own["content-length"])):
        if not head.endswith(b"\r\n\r\n"):
            head += part
            end = head.find(b"\r\n\r\n")
            if end < 0:
                if len(head) > MAX_HEAD:
                    raise ValueError("an HTTP head does not end")
                continue
            head, part = head[:end + 4], head[end + 4:]
        seen += len(part)
        digest.update(part)
        if payloads:
            body.append(part)
    length = int(fields(head)["content-length"])
    declared = own["warc-payload-digest"].removeprefix("sha1:")
    kind = own["warc-type"]
    if kind == "response":
        found = base64.b32encode(digest.digest()).decode()
        if (seen, found) != (length, declared):
            raise ValueError(f"payload of {own['warc-record-id']} differs from its header")
    return (_page(own["warc-record-id"]), own.get("warc-target-uri"), kind, length, declared, _page(own.get("warc-refers-to")),
            b"".join(body) if payloads and kind == "response" else None)


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that an index lists, each read at its offset; response payloads are checked against their digests."""
    total = index.agg(F.sum("length")).first()[0] or 0
    spans = index.withColumn("span", F.floor(F.col("offset") / READ_BYTES))
    dealt = spans.repartition(max(1, -(-total // READ_BYTES)), "archive", "span").sortWithinPartitions("archive", "offset")

    def each(batches):
        path, file = None, None
        for b in batches:
            rows, held = [], 0
            for archive, at, size in zip(*(b.column(k).to_pylist() for k in range(3))):
                if archive != path:
                    if file is not None:
                        file.close()
                    store, inner = opened(archive)
                    path, file = archive, store.open_input_file(inner)
                file.seek(at)
                rows.append(parse_record(inflated(Window(file, size)), payloads))
                held += len(rows[-1][-1] or b"")
                if held > CHUNK or len(rows) > 10_000:
                    yield _parsed(rows)
                    rows, held = [], 0
            yield _parsed(rows)
        if file is not None:
            file.close()

    return dealt.select("archive", "offset", "length").mapInArrow(each, RECORD)


class Window:
    """The next ``size`` bytes of a file, as a stream."""

    def __init__(self, file, size: int):
        self.file, self.left = file, size

    def read(self, n: int) -> bytes:
        out = self.file.read(min(n, self.left))
        self.left -= len(out)
        return out


def _parsed(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      [f.split()[0] for f in RECORD.split(", ")])


def resolved(records: DataFrame) -> DataFrame:
    """Records with every payload: a revisit takes that of the record it refers to."""
    kept = records.where("record_type = 'response' and page_id is not null").select(
        F.col("page_id").alias("kept_id"), F.col("payload_digest").alias("kept_digest"), F.col("payload").alias("kept")).dropDuplicates(
        ["kept_id", "kept_digest"])
    on = (F.col("refers_to") == F.col("kept_id")) & (F.col("payload_digest") == F.col("kept_digest"))
    return records.join(kept, on, "left").select(
        *[c for c in records.columns if c != "payload"], F.coalesce("payload", "kept").alias("payload"))


def archived(pages: DataFrame, *, min_bytes: int = MIN_BYTES, payloads: bool = False, path: str | None = None, **columns) -> DataFrame:
    """Writes pages as archives under ``path`` (a fresh scratch folder if None), normalises them and reads them back."""
    bounded_batches(pages)
    spark = pages.sparkSession
    path = path or scratch_path(spark, "llm-warc")
    write_monolithic(warc_records(pages, min_bytes=min_bytes, **columns), f"{path}/monolithic")
    normalise(spark, f"{path}/monolithic", f"{path}/warc")
    return read_records(read_index(spark, f"{path}/warc"), payloads)
