"""Web archives: writing them, normalising monolithic gzip files, and reading records by offset.

The writer makes WARC files that are each one gzip stream. The normaliser inflates such a file once from end to end,
rewrites every record as a gzip member of its own, and writes a sidecar index of offsets. The reader seeks with the
index. Files live in a folder that all executors share. Each attempt of a task writes under names of its own, and only
those that the attempt that counts has returned are read on.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buzzmill.llm.shared import materialize, scratch_path

#: Raw bytes after which the writer starts another file.
FILE_BYTES = 64 << 20
PIECE = 1 << 20
GZIP = 31
DATE = "2024-01-01T00:00:00Z"
UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def mark_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Columns page_id, url, html, revisits_id (null for a response), first_known.

    Of pages with equal html (null counts as empty) of at least least_bytes, the one with the smallest page_id is the
    response and the others revisit it. A null page_id revisits if any equal page has an id. Rows that repeat the
    response's page_id with equal html are responses too. Only ids and digests are shuffled by digest.
    """
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    narrow = base.where(F.octet_length("html") >= least_bytes).select("page_id", F.sha2("html", 256).alias("digest"))
    firsts = narrow.groupBy("digest").agg(F.min("page_id").alias("revisits_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = narrow.join(firsts, "digest").where("revisits_id is not null and not page_id <=> revisits_id").distinct()
    later = later.withColumnRenamed("page_id", "later_id").withColumnRenamed("digest", "later_digest")
    return base.join(later, F.expr("later_id <=> page_id and later_digest = sha2(html, 256)"), "left").select("page_id", "url", "html", "revisits_id")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record_of(page_id: int | None, url: str | None, payload: bytes, revisits_id: int | None, date: str = DATE) -> bytes:
    """A WARC 1.1 response or revisit record; a revisit keeps the HTTP headers and leaves the payload out."""
    revisit = revisits_id is not None
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    lines += [f"WARC-Target-URI: {target}"] if target else []
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(revisits_id)}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(marked: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Write each partition as WARC files of one gzip stream each; returns a row (file, records) for each."""

    def task(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        number, attempt, part, out, done = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, None, []

        def close():
            out[1].write(out[2].flush())
            out[1].close()
            done.append((out[0], out[3]))

        for batch in batches:
            for page_id, url, html, revisits_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    name = f"part-{number:06d}-{part:04d}-{attempt}.warc.gz"
                    out, part = [name, store.open_output_stream(f"{root}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, GZIP), 0, 0], part + 1
                record = record_of(page_id, url, html.encode(), revisits_id)
                out[1].write(out[2].compress(record))
                out[3], out[4] = out[3] + 1, out[4] + len(record)
                if out[4] >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["file", "records"])

    return materialize(marked.select("page_id", "url", "html", "revisits_id").mapInArrow(task, "file string, records long"), "warc-files")


class Inflated:
    """Reads the inflated bytes of a gzip file of one or more members, in one pass and bounded memory."""

    def __init__(self, stream):
        self.stream, self.inflate, self.held, self.raw = stream, zlib.decompressobj(GZIP), bytearray(), b""

    def refill(self) -> bool:
        self.raw = self.raw or self.stream.read(PIECE)
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate another piece; False at the end of the file."""
        while True:
            if self.inflate.eof:
                self.raw = self.inflate.unused_data or self.raw
                if not self.refill():
                    return False
                self.inflate = zlib.decompressobj(GZIP)
            elif not self.refill():
                rest = self.inflate.flush()
                self.held += rest
                return bool(rest)
            got = self.inflate.decompress(self.raw, PIECE)
            self.raw = self.inflate.unconsumed_tail
            if got:
                self.held += got
                return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.held.find(mark, max(0, at - len(mark)))) < 0:
            at = len(self.held)
            if not self.more():
                if self.held.strip():
                    raise ValueError("the archive ends within a header")
                return b""
        head = bytes(self.held[: found + len(mark)])
        del self.held[: found + len(mark)]
        return head

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive ends within a record")
            piece = bytes(self.held[: min(n, PIECE)])
            del self.held[: len(piece)]
            n -= len(piece)
            yield piece


def headers_of(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, v in (line.split(":", 1) for line in head.decode().split("\r\n")[1:] if ":" in line)}


def normalise(spark: SparkSession, files: DataFrame, folder: str, target: str, level: int = 4) -> DataFrame:
    """Rewrite each file of folder in target, a gzip member for each record, with a .idx sidecar; returns the new (file, records).

    A file that ends within a record fails the task.

    A line of the sidecar is a JSON object: id, type, offset and length of the record's member.
    """

    def task(batches):
        (store, root), (made, out_root) = fs.FileSystem.from_uri(folder), fs.FileSystem.from_uri(target)
        made.create_dir(out_root)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            names, counts = [], []
            for name in batch.column(0).to_pylist():
                offset, n, new = 0, 0, name.replace(".warc.gz", f"-{attempt}.warc.gz")
                with store.open_input_stream(f"{root}/{name}", compression=None) as raw, made.open_output_stream(f"{out_root}/{new}", compression=None) as out, made.open_output_stream(f"{out_root}/{new}.idx", compression=None) as index:
                    source = Inflated(raw)
                    while head := source.until(b"\r\n\r\n"):
                        head = head.lstrip(b"\r\n")
                        fields = headers_of(head)
                        member, length = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0
                        for piece in (head, *source.pieces(int(fields["content-length"]) + 4)):
                            length += out.write(member.compress(piece)) or 0
                        length += out.write(member.flush())
                        index.write(json.dumps({"id": fields["warc-record-id"], "type": fields["warc-type"], "offset": offset, "length": length}).encode() + b"\n")
                        offset, n = offset + length, n + 1
                names.append(new)
                counts.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], ["file", "records"])

    return materialize(_one_a_task(files).mapInArrow(task, "file string, records long"), "warc-normal")


def _one_a_task(files: DataFrame) -> DataFrame:
    files = files.select("file")
    return files.repartition(max(1, min(files.count(), 10_000)), "file")


def page_of(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return None if name in ("", "none") else int(name)


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(files: DataFrame, folder: str) -> DataFrame:
    """Every record of normalised archives, read through the sidecar: page, payload's size and SHA-1, type, and what it revisits.

    A response's digest is that of the payload read; it must equal the header's, else the task fails.
    """

    def task(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{root}/{name}.idx", compression=None) as index:
                    entries = [json.loads(line) for line in index.read().splitlines()]
                with store.open_input_file(f"{root}/{name}") as archive:
                    for e in entries:
                        archive.seek(e["offset"])
                        head, _, rest = zlib.decompress(archive.read(e["length"]), GZIP).partition(b"\r\n\r\n")
                        fields = headers_of(head)
                        http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
                        said, revisit = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "revisit"
                        if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != said:
                            raise ValueError(f"{name}: the payload of {e['id']} does not match its digest")
                        size = int(headers_of(http)["content-length"]) if revisit else len(payload)
                        rows.append((page_of(e["id"]), size, said, fields["warc-type"], page_of(fields.get("warc-refers-to"))))
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return _one_a_task(files).mapInArrow(task, RECORDS)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Write pages as monolithic archives, normalise them, and read the records back.

    Null html is an empty payload; a null or empty url leaves the target header out, and control characters in it are
    percent-encoded. Rows with equal page_id make a record each. An empty table makes no files and no rows. Other
    columns of pages are ignored.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    files = write_archives(mark_revisits(pages, least_bytes), f"{folder}/monolithic")
    files = normalise(spark, files, f"{folder}/monolithic", f"{folder}/normal")
    return read_records(files, f"{folder}/normal")


#: SHA-1 in base 32: five hexadecimal digits make four letters.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""
