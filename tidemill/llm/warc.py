"""WARC archives: writing pages, turning monolithic gzip files into one member per record, and reading by offset.

`write_archives` writes a gzip stream per file, all records in one member, as many tools do; nothing in it can be
reached without inflating all before it. `normalise` inflates each such file once, as a stream, rewrites every record as a gzip
member of its own and writes a sidecar index (offset, length, record type, id) next to it. `read_archives` reads records through
the sidecar by offset. Files are written under the name of the attempt and renamed when complete.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, file_system, materialize
from tidemill.session import work_path

#: Smaller payloads are never written as revisits.
REVISIT_BYTES = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
LEVEL = 3
CHUNK = 1 << 20
_BREAKS = re.compile(r"[\x00-\x20\x7f]")


def _uri(url: str) -> str:
    return _BREAKS.sub(lambda m: f"%{ord(m[0]):02X}", url)


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One uncompressed record. A revisit holds the HTTP head only, whose Content-Length is that of the full payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
            f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file, member by member or all in one, in pieces of bounded size; a member that does not end is an error."""
    inflate, begun = zlib.decompressobj(31), False
    data = stream.read(CHUNK)
    while data:
        begun = True
        piece = inflate.decompress(data, CHUNK)
        if piece:
            yield piece
        if inflate.eof:
            data = inflate.unused_data or stream.read(CHUNK)
            inflate, begun = zlib.decompressobj(31), False
        else:
            data = inflate.unconsumed_tail or stream.read(CHUNK)
    rest = inflate.flush()
    if rest:
        yield rest
    # the checksum at the end of a member is part of it
    if begun and not inflate.eof:
        raise EOFError("the gzip stream ends early")


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) of a stream of records; only one record is held at a time."""
    buffer = bytearray()

    def fill(size: int) -> bool:
        while len(buffer) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while fill(1):
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not fill(seen + 1):
                raise EOFError("the last record's head is cut off")
        head = parse_head(bytes(buffer[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        if not fill(size):
            raise EOFError("the last record is cut off")
        yield head, bytes(buffer[:size])
        del buffer[:size]


def member(data: bytes, level: int = LEVEL) -> bytes:
    packed = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packed.compress(data) + packed.flush()


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to: of equal payloads of REVISIT_BYTES or more the smallest page_id is kept, the rest refer to it.

    Rows that share the smallest id are all kept. Null ids come last; where all ids are null each row is a response.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    payload = F.encode(html, "utf-8")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(payload, 256).alias("digest"))
    # digests that occur once need no reference; what is joined is one row per repeated payload
    first = (rows.filter(F.octet_length("html") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first")).filter("n > 1").select("digest", "first"))
    return rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes one monolithic .warc.gz per task of with_references(pages); (path, records)."""
    arrow_limits(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        context = TaskContext.get()
        files, base = file_system(folder)
        name = f"pages-{context.partitionId():06d}"
        attempt, out, packed, count = f"{base}/{name}.attempt-{context.taskAttemptId()}", None, None, 0
        for batch in batches:
            for row in range(batch.num_rows):
                page_id, url, html, digest, refers_to = (batch.column(n)[row].as_py() for n in range(5))
                if out is None:
                    out, packed = files.open_output_stream(attempt), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out.write(packed.compress(record_bytes(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to)))
                count += 1
        if out is not None:
            out.write(packed.flush())
            out.close()
            files.move(attempt, f"{base}/{name}.warc.gz")
            yield pa.RecordBatch.from_arrays([pa.array([f"{name}.warc.gz"]), pa.array([count])], names=["path", "records"])

    return materialize(with_references(pages).mapInArrow(write, "path string, records long"), "warc-files")


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites each file of archives.path below source into target, one gzip member per record, with a sidecar .idx; (path, records).

    The sidecar has one JSON line per record: offset, length, type, id. A file is inflated once, as a stream; memory is
    that of one record.
    """
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        files, base = file_system(source)
        out_files, out_base = file_system(target)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                attempt = f"{out_base}/{path}.attempt-{TaskContext.get().taskAttemptId()}"
                at = count = 0
                with files.open_input_stream(f"{base}/{path}", compression=None) as stream, out_files.open_output_stream(
                        attempt, compression=None) as out, out_files.open_output_stream(attempt + ".idx", compression=None) as index:
                    for head, data in records(inflated(stream)):
                        packed = member(data)
                        out.write(packed)
                        index.write((json.dumps({"offset": at, "length": len(packed), "type": head["warc-type"],
                                                 "id": head["warc-record-id"]}) + "\n").encode())
                        at, count = at + len(packed), count + 1
                out_files.move(attempt + ".idx", f"{out_base}/{path}.idx")
                out_files.move(attempt, f"{out_base}/{path}")
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count])], names=["path", "records"])

    tasks = max(1, min(archives.count(), 20_000))
    return materialize(archives.select("path").repartition(tasks).mapInArrow(rewrite, "path string, records long"), "warc-files")


def read_member(stream, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, body) of the record at an offset; reads that member only."""
    data = zlib.decompress(stream.read_at(length, offset), 31)
    head, _, block = data.partition(b"\r\n\r\n")
    head = parse_head(head)
    http, _, body = block[:int(head["content-length"])].partition(b"\r\n\r\n")
    fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in http.decode().split("\r\n")[1:])}
    return head, fields, body


def _page(urn: str | None):
    value = urn and urn.removeprefix("<urn:page:").removesuffix(">")
    return None if value in (None, "none") else value


def read_archives(archives: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, offset: one row per record, read through the sidecars.

    A response's digest and size are computed from its payload and must agree with its headers; a revisit's come from its headers.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = file_system(folder)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset"]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                with files.open_input_file(f"{base}/{path}") as stream, files.open_input_stream(f"{base}/{path}.idx", compression=None) as index:
                    rest = b""
                    while True:
                        data = index.read(CHUNK)
                        *lines, rest = (rest + data).split(b"\n")
                        for entry in map(json.loads, lines):
                            head, http, body = read_member(stream, entry["offset"], entry["length"])
                            digest, size = head["warc-payload-digest"].removeprefix("sha256:"), int(http["content-length"])
                            if head["warc-type"] == "response" and (hashlib.sha256(body).hexdigest(), len(body)) != (digest, size):
                                raise ValueError(f"{path} at {entry['offset']}: the payload does not match its digest")
                            rows.append((_page(head["warc-record-id"]), head.get("warc-target-uri"), size, digest, head["warc-type"],
                                         _page(head.get("warc-refers-to")), path, entry["offset"]))
                        if len(rows) >= 5000 or not data:
                            if rows:
                                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                                    pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()))], names=names)
                            rows = []
                        if not data:
                            break

    tasks = max(1, min(archives.count(), 20_000))
    found = archives.select("path").repartition(tasks).mapInArrow(
        read, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, file string, offset long")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def page_records(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: pages written as WARC, normalised and read back; a row per row.

    Null html: an empty payload, a response. Null url: no target. Repeated rows are records of their own; see with_references for
    ties and null ids. Empty table: no files, no rows.
    """
    spark = pages.sparkSession
    folder = folder or work_path(spark, "llm-warc")
    _folders(spark, f"{folder}/monolithic", f"{folder}/members")
    written = write_archives(pages, f"{folder}/monolithic")
    rewritten = normalise(written, f"{folder}/monolithic", f"{folder}/members")
    found = read_archives(rewritten, f"{folder}/members", pages.schema["page_id"].dataType.simpleString())
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _folders(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        files, path = file_system(folder)
        files.create_dir(path, recursive=True)
