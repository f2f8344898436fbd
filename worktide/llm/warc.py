"""WARC archives: pages written as gzip members record by record, and a salvage reader.

Pages with equal payloads become one response, that of the smallest page id, and revisits of it. Records are written
through Spark's own text writer, so any file system Spark can write to will do: a record's gzip member is the line, and
an empty gzip member, which readers skip, is the line end; the files are ordinary .warc.gz files.

The reader takes members and plain records. Where a check fails - member, version line, length, payload digest - it
searches for the next member or version line that reads well, goes on there, and reports the bytes between as a gap.

A null payload is empty, a null url is left out, a null page id reads back as null and is never referred to. Repeated
rows of the smallest id are all responses. Empty tables give empty archives. Other columns are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pages with shorter payloads are never revisits.
LEAST_PAYLOAD = 0
#: Records in a file at most: a file is read back as one value.
FILE_RECORDS = 4000
_MAGIC, _VERSION, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x02\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
_DATE = "1970-01-01T00:00:00Z"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _uri(url: str) -> str:
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None = None) -> bytes:
    """The bytes of one record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload
    heads = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{page_id}>"), ("WARC-Date", _DATE),
             ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
             ("WARC-Block-Digest", f"sha1:{digest_of(block)}"), ("X-Payload-Length", str(size))]
    if url is not None:
        heads.append(("WARC-Target-URI", _uri(url)))
    if refers_to is not None:
        heads += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    heads.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads).encode() + b"\r\n" + block + _END


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                   least_payload: int = LEAST_PAYLOAD, file_records: int = FILE_RECORDS) -> None:
    """Write the pages under ``path``. Only finished gzip members are shuffled, to meet what is known of their payload."""
    payload = F.coalesce(pages[html].cast("binary"), F.lit(b""))
    rows = pages.select(pages[key].alias("page_id"), pages[url].cast("string").alias("url"), payload.alias("payload"))
    equal = (rows.filter(F.octet_length("payload") >= least_payload).groupBy(F.sha1("payload").alias("sha"))
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first"))

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, urls, bodies, shas = (batch.column(k).slice(at, 256).to_pylist() for k in range(4))
                digests = [digest_of(b) for b in bodies]
                members = [member(record("response", i, u, b, d, len(b))) for i, u, b, d in zip(ids, urls, bodies, digests, strict=True)]
                yield pa.RecordBatch.from_pydict({"page_id": ids, "url": urls, "sha": shas, "digest": digests,
                                                  "size": [len(b) for b in bodies], "member": members}, schema=packed)

    packed = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("sha", pa.string()), ("digest", pa.string()),
                        ("size", pa.int64()), ("member", pa.binary())])
    members = rows.select(F.col("page_id").cast("long"), "url", "payload", F.sha1("payload").alias("sha")).mapInArrow(
        pack, "page_id long, url string, sha string, digest string, size long, member binary")
    known = members.join(equal, "sha", "left")

    def finish(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, urls, digests, sizes, done, firsts = (batch.column(k).slice(at, 256).to_pylist() for k in range(6))
                out = [done[k] if firsts[k] is None or firsts[k] == ids[k]
                       else member(record("revisit", ids[k], urls[k], b"", digests[k], sizes[k], firsts[k])) for k in range(len(ids))]
                yield pa.RecordBatch.from_pydict({"member": out}, schema=pa.schema([("member", pa.binary())]))

    final = known.select("page_id", "url", "digest", "size", "member", "first").mapInArrow(finish, "member binary")
    (final.select(F.col("member").cast("string").alias("value")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", _EMPTY_MEMBER.decode("latin-1")).option("maxRecordsPerFile", file_records).text(path))


class Damage(Exception):
    """What a check found wrong."""


def _unpack(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends."""
    unpacker, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not unpacker.eof:
            piece = data[fed:fed + 16384]
            if not len(piece):
                raise Damage("member cut short")
            parts.append(unpacker.decompress(piece))
            fed += len(piece)
    except zlib.error as error:
        raise Damage(f"member: {error}") from None
    return b"".join(parts), fed - len(unpacker.unused_data)


def _parse(data: bytes, at: int) -> tuple[dict, bytes, int]:
    """Headers, block and end of the plain record at ``at``."""
    if not data.startswith(_VERSION, at):
        raise Damage("no version line")
    split = data.find(_END, at)
    if split < 0:
        raise Damage("no end of headers")
    heads = {}
    for line in bytes(data[at:split]).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damage("header without a colon")
        heads[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = heads.get("content-length", "")
    if not length.isdigit():
        raise Damage("no content length")
    start = split + 4
    end = start + int(length)
    if data[end:end + 4] != _END:
        raise Damage("length does not meet the record's end")
    return heads, bytes(data[start:end]), end + 4


def _checked(heads: dict, block: bytes) -> dict:
    digest = heads.get("warc-block-digest")
    if digest and digest != f"sha1:{digest_of(block)}":
        raise Damage("block digest differs")
    head, _, payload = block.partition(_END)
    if heads.get("warc-type") == "response" and heads.get("warc-payload-digest", "sha1:" + digest_of(payload)) != "sha1:" + digest_of(payload):
        raise Damage("payload digest differs")
    return {"heads": heads, "payload": payload}


def _record_at(data: bytes, view: memoryview, at: int) -> tuple[list[dict], int]:
    if data.startswith(_MAGIC, at):
        content, end = _unpack(view, at)
        found, inner = [], 0
        while inner < len(content):
            heads, block, inner = _parse(content, inner)
            found.append(_checked(heads, block))
        return found, end
    heads, block, end = _parse(data, at)
    return [_checked(heads, block)], end


def salvage(data: bytes) -> Iterator[dict]:
    """Records (``heads``, ``payload``, ``offset``) and gaps (``gap``: reason, ``offset``, ``length``) of one archive."""
    view, at = memoryview(data), 0
    while at < len(data):
        try:
            found, end = _record_at(data, view, at)
        except Damage as damage:
            nxt = at
            while True:
                places = [p for p in (data.find(_MAGIC, nxt + 1), data.find(_VERSION, nxt + 1)) if p >= 0]
                nxt = min(places, default=len(data))
                if nxt == len(data):
                    break
                try:
                    _record_at(data, view, nxt)
                    break
                except Damage:
                    continue
            yield {"gap": str(damage), "offset": at, "length": nxt - at}
            at = nxt
            continue
        for one in found:
            yield one | {"offset": at, "length": end - at}
        at = end


_READ = ("file string, offset long, length long, gap string, record_type string, page_id long, url string, payload_bytes long, "
         "payload_digest string, refers_to long, payload binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and gaps of the archives under ``path``; ``gap`` is null for records and the reason for quarantined bytes."""
    names = [part.split()[0] for part in _READ.split(", ")]

    def number(text: str) -> int | None:
        digits = text.rpartition(":")[2].rstrip(">")
        return int(digits) if digits.lstrip("-").isdigit() else None

    def run(batches):
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in _READ.split(", ")])
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                for one in salvage(content.as_py()):
                    heads = one.get("heads", {})
                    rows.append(dict.fromkeys(names) | {"file": file, "offset": one["offset"], "length": one["length"], "gap": one.get("gap")})
                    if heads:
                        rows[-1] |= {
                            "record_type": heads.get("warc-type"), "page_id": number(heads.get("warc-record-id", "")),
                            "url": heads.get("warc-target-uri"), "payload_digest": heads.get("warc-payload-digest", "").removeprefix("sha1:"),
                            "payload_bytes": int(heads.get("x-payload-length", len(one["payload"]))),
                            "refers_to": number(heads.get("warc-refers-to", "")), "payload": one["payload"]}
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, _READ)


def archive_report(pages: DataFrame, path: str) -> DataFrame:
    """Write the pages under ``path``, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    write_archives(pages, path)
    back = read_archives(pages.sparkSession, path)
    return back.filter(F.col("gap").isNull()).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
