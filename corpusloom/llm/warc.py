r"""WARC records in ZIP packages: a writer, and a reader that never unpacks.

A package is a ZIP file with two stored members: the records (``archive/data.warc.gz``, every
record a gzip member of its own) and their index (``indexes/index.jsonl``: offset and length of
each record). The reader takes the end of the file, the central directory and, where numbers exceed
32 bits, the ZIP64 directory, locates stored members by their local headers, reads the index by
range, and then each record by its range alone.

Scale: payloads are compared by digest; only digests that two pages have are joined back, copied
under ``SALTS`` salts, so that a payload that a third of all pages have is spread out. Each task
writes packages of its own under fresh names and tells them in its rows; as only rows of successful
tasks count, retries and lost executors leave no half package in the manifest. Reading is dealt out
by ranges of ``READ_BYTES`` bytes, so a large package is shared by many tasks.

Defined results: a null payload is empty; rows of the smallest id that share a payload are all
responses; a null id is never the smallest and revisits if a page with an id has its payload;
repeated rows give one record each; an empty table gives an empty table. Only the columns named
are read. The shared folder may be any file system that pyarrow opens by URI.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import fresh_path, materialize

MIN_REVISIT_BYTES = 100
SALTS = 16
PACKAGE_BYTES = 256 << 20
READ_BYTES = 8 << 20
#: Tasks that read records at most; and records whose places one task looks up.
MOST_TASKS, LOCATED = 100_000, 500_000
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else f"file://{uri}")


# ---------------------------------------------------------------------------------------- records


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has no payload but tells the payload's digest and size."""
    name = "none" if page_id is None else str(page_id)
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {quote(url or 'urn:unknown', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page(urn: str | None) -> int | None:
    name = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return None if name in ("", "none") else int(name)


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record; the payload's digest is verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(fields["content-length"])]
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload digest differs in {fields['warc-record-id']}")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": kind,
        "payload_digest": digest,
        "payload_bytes": len(payload) if payload is not None else int(fields["warc-payload-length"]),
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": payload,
    }


# ----------------------------------------------------------------------------------------- writer

_MANIFEST = "path string, bytes long, records long"


def _package_writer(root: str, limit: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(root)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        row, done = next(rows, None), []
        while row is not None:
            name = f"package-{uuid.uuid4().hex}.zip"
            index, offset = [], 0
            with files.open_output_stream(f"{base}/{name}") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
                with package.open(RECORDS, "w", force_zip64=True) as member:
                    while row is not None and offset < limit:
                        page_id, url, html, digest, size, refers_to = row
                        payload = b"" if refers_to is not None or html is None else html.encode()
                        raw = gzip.compress(record_bytes(page_id, url, payload, digest, size, refers_to), 1, mtime=0)
                        member.write(raw)
                        index.append(json.dumps({"offset": offset, "length": len(raw)}))
                        offset += len(raw)
                        row = next(rows, None)
                package.writestr(INDEX, "\n".join(index))
            done.append((f"{root}/{name}", files.get_file_info(f"{base}/{name}").size, len(index)))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done) if done else ([], [], []), (pa.string(), pa.int64(), pa.int64()))], names=["path", "bytes", "records"])

    return write


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, size, refers_to): refers_to is null for responses."""
    html = F.coalesce(pages[payload], F.lit(""))
    own = pages.select(pages[key].cast("long").alias("page_id"), pages[url].alias("url"), html.alias("html")).select(
        "*", F.sha2(F.encode("html", "UTF-8"), 256).alias("digest"), F.octet_length("html").cast("long").alias("size")
    )
    shared = own.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1 AND least IS NOT NULL")
    shared = shared.select(F.col("digest").alias("d"), "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    later = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("least")), F.col("least"))
    return own.join(shared, (F.col("digest") == F.col("d")) & (salt == F.col("s")), "left").select("page_id", "url", "html", "digest", "size", later.alias("refers_to"))


def write_packages(pages: DataFrame, root: str, package_bytes: int = PACKAGE_BYTES, **columns: str) -> DataFrame:
    """Write ``pages`` as packages below ``root`` and return their manifest (path, bytes, records)."""
    files, base = _open(root)
    files.create_dir(base, recursive=True)
    return materialize(with_revisits(pages, **columns).mapInArrow(_package_writer(root, package_bytes), _MANIFEST), "warc-manifest")


# ----------------------------------------------------------------------------------------- reader


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def _at(source: pa.NativeFile, offset: int, size: int) -> bytes:
    source.seek(offset)
    out = source.read(size)
    if len(out) != size:
        raise ValueError(f"{size} bytes wanted at {offset}, {len(out)} found")
    return out


def central_directory(source: pa.NativeFile) -> list[Member]:
    """Members of a ZIP file, from its last bytes and its central (or ZIP64) directory."""
    total = source.size()
    tail_at = max(0, total - (22 + 0xFFFF + 20))
    tail = _at(source, tail_at, total - tail_at)
    end = tail.rfind(b"PK\5\6")
    while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(b"PK\5\6", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, size, offset = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\6\7":
        (where,) = struct.unpack_from("<Q", tail, end - 12)
        wide = _at(source, where, 56)
        if wide[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        count, size, offset = struct.unpack_from("<QQQ", wide, 32)
    raw, members, p = _at(source, offset, size), [], 0
    for _ in range(count):
        if raw[p : p + 4] != b"PK\1\2":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, p + 8)
        packed, plain, n, x, c = struct.unpack_from("<IIHHH", raw, p + 20)
        (header,) = struct.unpack_from("<I", raw, p + 42)
        name = raw[p + 46 : p + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = raw[p + 46 + n : p + 46 + n + x]
        while len(extra) >= 4:
            kind, length = struct.unpack_from("<HH", extra)
            if kind == 1:  # the numbers that didn't fit, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, 4))
                plain = next(wide) if plain == 0xFFFFFFFF else plain
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                header = next(wide) if header == 0xFFFFFFFF else header
            extra = extra[4 + length :]
        members.append(Member(name, method if not flags & 1 else -1, packed, header))
        p += 46 + n + x + c
    return members


def stored_at(source: pa.NativeFile, member: Member) -> int:
    """Where a stored member's bytes begin."""
    if member.method != 0:
        raise ValueError(f"{member.name} isn't stored plainly, so it can't be read by range")
    local = _at(source, member.header, 30)
    if local[:4] != b"PK\3\4":
        raise ValueError("broken local header")
    n, x = struct.unpack_from("<HH", local, 26)
    return member.header + 30 + n + x


def locate_records(packages: DataFrame) -> DataFrame:
    """(path, offset, length) of every record of the packages of a manifest (path, records), from their directories and indexes.

    As many tasks as the packages' records need, and no fewer than are usual in the session, if there are as many packages.
    """
    known = packages.agg(F.count(F.lit(1)).alias("n"), F.sum("records").alias("records")).first()
    tasks = max(1, min(known.n, max(int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(known.records or 0) // LOCATED))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _open(path)
                with files.open_input_file(name) as source:
                    members = {m.name: m for m in central_directory(source)}
                    base = stored_at(source, members[RECORDS])
                    index = _at(source, stored_at(source, members[INDEX]), members[INDEX].size)
                found = [json.loads(x) for x in index.decode().splitlines()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(found), pa.string()), pa.array([base + x["offset"] for x in found], pa.int64()), pa.array([x["length"] for x in found], pa.int64())], names=["path", "offset", "length"])

    return packages.select("path").repartition(tasks, "path").mapInArrow(run, "path string, offset long, length long")


_FIELDS = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}


def read_records(located: DataFrame, columns: tuple[str, ...] = tuple(_FIELDS)) -> DataFrame:
    """Records by their ranges; ``columns`` are page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload."""
    kinds = {"int64": "long", "string": "string", "binary": "binary"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, source = None, None
        try:
            for batch in batches:
                rows, held = [], 0
                for path, offset, length in zip(*(batch.column(c).to_pylist() for c in range(3))):
                    if path != open_path:
                        if source is not None:
                            source.close()
                        files, name = _open(path)
                        open_path, source = path, files.open_input_file(name)
                    rows.append(parse_record(zlib.decompress(_at(source, offset, length), 31)))
                    held += length
                    if held > READ_BYTES:
                        yield _rows(rows)
                        rows, held = [], 0
                yield _rows(rows)
        finally:
            if source is not None:
                source.close()

    def _rows(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _FIELDS[c]) for c in columns], names=list(columns))

    # as many tasks as the bytes need, said outright: the rows are tiny, and would all be put together
    located = materialize(located.select("path", "offset", "length"), "warc-located")
    total = located.agg(F.sum("length")).first()[0] or 0
    share = max(READ_BYTES, -(-total // MOST_TASKS))
    tasks = max(1, -(-total // share))
    dealt = located.withColumn("part", F.floor(F.col("offset") / share)).repartition(tasks, "path", "part").sortWithinPartitions("path", "offset")
    return dealt.select("path", "offset", "length").mapInArrow(run, ", ".join(f"{c} {kinds[str(_FIELDS[c])]}" for c in columns))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    packages = write_packages(pages, fresh_path(spark, "warc"))
    return read_records(locate_records(packages), ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


OP3_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(encode(coalesce(html, ''))) AS payload_digest FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM p),
r AS (SELECT *, payload_bytes >= 100 AND least IS NOT NULL AND (page_id IS NULL OR page_id > least) AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN least END AS refers_to FROM r
"""
