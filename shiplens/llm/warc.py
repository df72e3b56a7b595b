"""WARC archives: a deduplicating writer and a splittable reader.

Writing: equal payloads (same SHA-1, SHA-256 and length) are grouped; the
record of the smallest page_id is a ``response`` with the payload, the others
are ``revisit`` records that refer to it.  A task that reads pages passes a
payload on only while no smaller page_id with the same payload has passed it,
so the rows that become revisits are shuffled without theirs.  Each task writes
its records as one archive of gzip members under a name of its own attempt, and only the archives
in the committed manifest are read, so a failed or speculative attempt
leaves nothing that counts.

Reading: archives are cut into byte ranges, one task row each.  A range's
reader scans for the gzip magic, validates a candidate member by inflating
its start and decoding the WARC headers, and owns the records whose member
starts inside its range (reading past the range's end to finish the last).
A candidate also has to end in a valid trailer, followed by another member or
the end of the file.

Paths may be any URI that ``pyarrow.fs`` opens (local or shared files, hdfs,
s3, gs); they are made from ``spark.checkpoint.dir`` unless given.  A folder
without a scheme lies on Spark's default file system, archives and manifest alike.

Edge cases: a null html is an empty payload; empty payloads are equal payloads;
a null page_id yields to any other, is a response if the payload has no
other, and writes a record without a page number; rows that repeat the
response's page_id and payload are responses too; a null url writes no target;
a payload of any length is one record, held whole by one task at a time; an
empty table writes no archive and reads back no rows; extra columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
import zlib

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, read, staged
from shiplens.session import remove_at_exit, scratch_path

SPLIT_BYTES = 8 << 20
_MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 18
_PREFIX = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LAST = 2**63 - 1
_ROW = "page_id long, url string, payload binary, sha1 string, sha256 string, size int"
_MANIFEST = "path string, bytes long, records long"
_RECORD = "path string, offset long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _open(uri: str):
    """File system and path of a URI with a scheme (of a file as Hadoop writes it, nothing escaped)."""
    if uri.startswith("file://"):
        return pa.fs.LocalFileSystem(), uri.removeprefix("file://")
    return pa.fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as a URI with a scheme: Spark's default file system where it names none."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()
    return uri if "://" in uri else uri.replace(":/", ":///", 1)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def response_bytes(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """One gzip member holding one response record."""
    return _member(page_id, url, payload, None, base32_sha1(payload), len(payload))


def revisit_bytes(page_id: int | None, url: str | None, refers_to: int | None, digest: str, size: int) -> bytes:
    """One gzip member holding one revisit record of a payload with that digest and length."""
    return _member(page_id, url, None, refers_to, digest, size)


def _member(page_id: int | None, url: str | None, payload: bytes | None, refers_to: int | None, digest: str, size: int) -> bytes:
    is_response = payload is not None
    kind = "response" if is_response else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if is_response else http
    clean = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    name = f"{_PREFIX}{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {kind}')}"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", clean),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", None if is_response else _PROFILE),
        ("WARC-Refers-To", None if is_response or refers_to is None else f"<{_PREFIX}{refers_to}>"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def fingerprinted(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` with each payload's digests and length."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), body.alias("payload"))
    return rows.withColumns({"sha1": F.sha1("payload"), "sha256": F.sha2("payload", 256), "size": F.length("payload")})


def without_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with a null payload where an earlier row of the task has an equal one and a smaller page_id.

    Such a row can't be the response.  What a task holds besides its batch is
    one digest and page_id for each of its payloads.
    """

    def passed(batches):
        least: dict[bytes, int] = {}
        for b in batches:
            keep = []
            for page_id, sha256 in zip(b.column("page_id").to_pylist(), b.column("sha256").to_pylist()):
                key, number = bytes.fromhex(sha256), _LAST if page_id is None else page_id
                keep.append(number <= least.get(key, _LAST))
                least[key] = min(number, least.get(key, _LAST))
            payload = pc.if_else(pa.array(keep, pa.bool_()), b.column("payload"), pa.scalar(None, b.column("payload").type))
            yield b.set_column(b.schema.get_field_index("payload"), "payload", payload)

    bounded_batches(rows.sparkSession, 200)
    return rows.mapInArrow(passed, _ROW)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages(page_id, url, html)`` under ``folder``; returns the manifest, written beside them."""
    spark = pages.sparkSession
    folder = qualified(spark, folder).rstrip("/")
    rows = fingerprinted(pages)
    key = ["sha1", "sha256", "size"]
    # written first, so the join reads it from files of known size; the rows of a payload
    # that a third of the pages share are narrow, and the adaptive skew join can split them
    first = staged(rows.groupBy(*key).agg(F.min("page_id").alias("first_id")), "warc-first")
    planned = without_repeats(rows).join(first, key).select("page_id", "url", "payload", "first_id", "sha1", "size")
    fs, root = _open(f"{folder}/archives")
    fs.create_dir(root, recursive=True)

    def written(batches):
        uri = f"{folder}/archives/{uuid.uuid4().hex}.warc.gz"
        out, records, size = None, 0, 0
        for b in batches:
            for page_id, url, payload, first_id, sha1, length in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    fs, path = _open(uri)
                    out = fs.open_output_stream(path, compression=None)
                if page_id == first_id:
                    member = response_bytes(page_id, url, payload)
                else:
                    member = revisit_bytes(page_id, url, first_id, base64.b32encode(bytes.fromhex(sha1)).decode(), length)
                out.write(member)
                records, size = records + 1, size + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [uri], "bytes": [size], "records": [records]})

    planned.mapInArrow(written, _MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def _inflated(source, size: int, start: int, least: int | None = None) -> tuple[bytes, int] | None:
    """Content of the gzip member at ``start`` and where it ends; None if there is no valid one.

    With ``least`` it stops after so many bytes (the end is then -1).
    """
    unpack, out, at = zlib.decompressobj(31), io.BytesIO(), start
    try:
        while not unpack.eof:
            source.seek(at)
            chunk = source.read(min(_CHUNK if least is None else 4096, size - at))
            if not chunk:
                return None
            out.write(unpack.decompress(chunk))
            at += len(chunk)
            if least is not None and out.tell() >= least:
                return out.getvalue(), -1
    except zlib.error:
        return None
    return out.getvalue(), at - len(unpack.unused_data)


def parse_record(content: bytes) -> tuple[dict[str, str], bytes] | None:
    """WARC headers (names in lower case) and block; None if it isn't a WARC record."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/"):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        return None
    return fields, rest[: int(length)]


def owned_records(source, size: int, start: int, end: int):
    """``(offset, headers, block)`` of the records whose member starts in ``[start, end)``."""
    at = start
    window, base = b"", start
    while at < end:
        if not (base <= at and at + len(_MAGIC) <= base + len(window)):
            source.seek(at)
            window, base = source.read(min(_CHUNK, size - at)), at
        hit = window.find(_MAGIC, at - base)
        if hit < 0:
            if base + len(window) >= size:
                return
            at = max(at + 1, base + len(window) - len(_MAGIC) + 1)
            continue
        at = base + hit
        if at >= end:
            return
        peek = _inflated(source, size, at, least=5)
        whole = _inflated(source, size, at) if peek and peek[0].startswith(b"WARC/") else None
        if whole:
            source.seek(whole[1])
            follows = source.read(len(_MAGIC))
            record = parse_record(whole[0]) if follows in (b"", _MAGIC) else None
            if record:
                yield at, *record
                at = whole[1]
                continue
        at += 1


def _page(uri: str | None) -> int | None:
    name = (uri or "").strip("<>")
    return int(name[len(_PREFIX) :]) if name.startswith(_PREFIX) else None


def read_archives(archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of ``archives(path, bytes)``, by byte ranges of ``split_bytes``."""
    bounded_batches(archives.sparkSession, 200)
    first = F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes)))
    ranges = archives.where("bytes > 0").select("path", "bytes", first.alias("start"))
    n = max(1, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def records(batches):
        for b in batches:
            for path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                fs, name = _open(path)
                with fs.open_input_file(name) as source:
                    rows, held = [], 0
                    for offset, fields, block in owned_records(source, size, start, min(size, start + split_bytes)):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        response = fields.get("warc-type") == "response"
                        stated = [int(x[15:]) for x in http.decode("latin-1").lower().split("\r\n") if x.startswith("content-length:")]
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                        if response and digest != base32_sha1(payload):
                            raise ValueError(f"{path}: the record at {offset} doesn't have the payload its digest names")
                        rows.append(
                            {
                                "path": path,
                                "offset": offset,
                                "page_id": _page(fields.get("warc-record-id")),
                                "url": fields.get("warc-target-uri"),
                                "record_type": fields.get("warc-type"),
                                "refers_to": _page(fields.get("warc-refers-to")),
                                "payload_bytes": len(payload) if response else (stated or [None])[0],
                                "payload_digest": digest,
                                "payload": payload if response else None,
                            }
                        )
                        held += len(payload)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_schema)

    return ranges.repartition(n, "path", "start").mapInArrow(records, _RECORD)


_schema = pa.schema(
    [
        ("path", pa.string()),
        ("offset", pa.int64()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to archives and return what their records say."""
    folder = scratch_path(spark, f"llm-warc-{uuid.uuid4().hex[:12]}")
    remove_at_exit(spark, folder)
    archives = write_archives(read(spark, sf_dir, "pages"), folder)
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# Base 32 of a hex digest: each five hex digits are four letters.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p
"""
