"""Legacy archive converter: ARC files of version 1 and 2 to WARC 1.1 with revisit records.

ARC records are parsed by their version's header line and declared length. For each record the
converter synthesises a WARC record id (from archive name and offset), an ISO date (from the 14-digit
one), a type and SHA-1 digests of payload and block. Of records with equal payloads of at least
``MIN_REVISIT`` bytes the one with the largest page id is the response, all others revisit it.

1. ``scan_arc`` reads the archives in parallel into narrow rows (archive, offset, length, digest).
2. Equal payloads are found on the narrow rows; the grouping combines before its shuffle.
3. ``convert`` brings each archive's revisit decisions to the archive, streams it once more and writes
   its WARC file, one gzip member per record. No payload is ever shuffled.

Archives go to the shared folder under names that hold the task attempt; the manifest that a job
returns lists only files of attempts that Spark accepted, so lost or repeated tasks leave unlisted
files at most. Storage is reached through pyarrow's file systems (file, hdfs, s3, gs).

Defined results: a null html is an empty payload, a null url is written as ``about:blank``, white space in
a url is percent-encoded, a null page id stays null and ranks below every id. Among repeated rows the
first by archive and offset is the response. An empty table gives no record. Extra columns are ignored.
"""

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.tables import stage, table
from skyledger.session import shared_dir

MIN_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20
# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = "archive string, at long, page_id long, url string, payload_bytes long, payload_sha1 binary"
READ = (
    "record_id string, record_type string, page_id long, target_uri string, warc_date string, "
    "payload_bytes long, payload_digest string, refers_to_id string"
)


def _open(path: str, write: bool = False):
    from pyarrow import fs

    files, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if not write:
        return files.open_input_stream(name, compression=None)
    files.create_dir(name.rpartition("/")[0], recursive=True)
    return files.open_output_stream(name, compression=None)


class ArchiveWriter:
    """Appends records as gzip members of their own."""

    def __init__(self, path: str):
        self.path, self.out, self.records, self.bytes = path, _open(path, write=True), 0, 0

    def add(self, record: bytes) -> None:
        member = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.out.write(member.compress(record) + member.flush())
        self.records += 1
        self.bytes += len(record)

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.bytes


def _reader(path: str):
    """Uncompressed bytes of an archive, whether or not it is compressed."""
    source = io.BufferedReader(_open(path), 1 << 20)
    return io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 20) if source.peek(2)[:2] == b"\x1f\x8b" else source


def _exactly(source, n: int, path: str) -> bytes:
    got = source.read(n)
    if len(got) != n:
        raise ValueError(f"{path}: a record ends early")
    return got


# --- ARC ---------------------------------------------------------------------------------------------


def _arc_record(version: int, url: str, ip: str, date: str, mime: str, block: bytes, name: str, offset: int) -> bytes:
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = [url, ip, date, mime]
    if version == 2:
        fields += ["200", "-", "-", str(offset), name]
    return " ".join([*fields, str(len(block))]).encode() + b"\n" + block + b"\n"


def read_arc(path: str) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header fields, block) of each record; the first line's version block says how lines are read."""
    source, at, fields = _reader(path), 0, None
    while line := source.readline():
        if not line.strip():
            at += len(line)
            continue
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if fields is None:
            if not text.startswith("filedesc://"):
                raise ValueError(f"{path}: no version block")
            block = _exactly(source, int(text.rpartition(" ")[2]), path)
            version, names = block.decode("utf-8", "replace").split("\n")[:2]
            if int(version.split()[0]) not in ARC_FIELDS:
                raise ValueError(f"{path}: unknown version {version!r}")
            fields = names.split()
        else:
            values = text.rsplit(" ", len(fields) - 1)
            if len(values) != len(fields):
                raise ValueError(f"{path}: bad header line at {at}")
            head = dict(zip(fields, values, strict=True))
            block = _exactly(source, int(head["Archive-length"]), path)
            yield at, head, block
        at += len(line) + len(block)


def write_arc(
    pages: DataFrame, folder: str, versions: tuple[int, ...] = (1, 2), archive_bytes: int = ARCHIVE_BYTES,
    date: str = "20200101000000", id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Legacy archives of a table of pages; versions take turns by partition. Returns the manifest."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("about:blank")).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    )

    def write(batches):
        task, out, number, done = TaskContext.get(), None, 0, []
        version = versions[task.partitionId() % len(versions)]
        for batch in batches:
            for page_id, url, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                if out is None:
                    name = f"part-{task.partitionId():05d}-{number:04d}-{task.taskAttemptId()}.arc.gz"
                    out, number = ArchiveWriter(f"{folder}/{name}"), number + 1
                    about = f"{version} 0 legacy\n{ARC_FIELDS[version]}\n".encode()
                    out.add(_arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", about, name, 0))
                body = payload.as_py()
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(body)}\r\n"
                if page_id.is_valid:
                    head += f"X-Page-Id: {page_id.as_py()}\r\n"
                block = head.encode() + b"\r\n" + body
                out.add(_arc_record(version, url.as_py(), "0.0.0.0", date, "text/html", block, name, out.bytes))
                if out.bytes >= archive_bytes:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("path", "records", "bytes"), d, strict=True)) for d in done],
            schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
        )

    return stage(rows.mapInArrow(write, MANIFEST), "arc-manifest")


def _http(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head with its blank line, header fields in lower case, and payload of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    head, blank, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head + blank, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def _each(manifest: DataFrame, read, schema: str) -> DataFrame:
    """``read(path)`` gives rows as dictionaries; archives are dealt over as many tasks as there are archives."""
    archives = manifest.select("path").repartition(max(1, manifest.count()), "path")

    def rows(batches):
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                held = []
                for row in read(path):
                    held.append(row)
                    if len(held) == 5000:
                        yield _batch(held, names)
                        held = []
                yield _batch(held, names)

    return archives.mapInArrow(rows, schema)


def _batch(rows: list[dict], names: list[str]) -> pa.RecordBatch:
    kinds = {"at": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_sha1": pa.binary()}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds.get(n, pa.string())) for n in names]))


def _scan_one(path: str) -> Iterator[dict]:
    for at, head, block in read_arc(path):
        _, fields, payload = _http(block)
        page_id = fields.get("x-page-id")
        yield {
            "archive": path, "at": at, "page_id": int(page_id) if page_id else None, "url": head["URL"],
            "payload_bytes": len(payload), "payload_sha1": hashlib.sha1(payload).digest(),
        }


def scan_arc(manifest: DataFrame) -> DataFrame:
    return _each(manifest, _scan_one, RECORDS)


# --- WARC --------------------------------------------------------------------------------------------


def record_id(archive: str, at: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive.rpartition('/')[2]}#{at}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _warc_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _convert_one(path: str, revisits: dict[int, tuple[str, int, str]], out: ArchiveWriter) -> None:
    """Write one archive's records; ``revisits`` maps offsets to (archive, offset, url) of the response."""
    about = f"software: skyledger\r\nformat: WARC File Format 1.1\r\nsource: {path.rpartition('/')[2]}\r\n".encode()
    first = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(path, -1)), ("WARC-Date", "2020-01-01T00:00:00Z"),
        ("WARC-Filename", out.path.rpartition("/")[2]), ("Content-Type", "application/warc-fields"),
    ]
    out.add(_warc_record(first, about))
    for at, head, block in read_arc(path):
        http, _, payload = _http(block)
        original = revisits.get(at)
        kind = "revisit" if original else "response" if http else "resource"
        fields = [
            ("WARC-Type", kind), ("WARC-Record-ID", record_id(path, at)), ("WARC-Date", _warc_date(head["Archive-date"])),
            ("WARC-Target-URI", head["URL"]), ("WARC-IP-Address", head["IP-address"]), ("WARC-Payload-Digest", _sha1(payload)),
        ]
        if original:
            fields += [
                ("WARC-Refers-To", record_id(*original[:2])), ("WARC-Refers-To-Target-URI", original[2]),
                ("WARC-Profile", REVISIT_PROFILE), ("WARC-Truncated", "length"),
            ]
            block = http
        fields += [
            ("WARC-Block-Digest", _sha1(block)),
            ("Content-Type", "application/http; msgtype=response" if http else head["Content-type"]),
        ]
        out.add(_warc_record(fields, block))


def convert(manifest: DataFrame, folder: str, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """WARC archives of ARC archives (column ``path``). Returns the manifest of the new ones."""
    records = stage(scan_arc(manifest), "arc-records")
    large = records.where(F.col("payload_bytes") >= min_revisit).select("payload_sha1", "page_id", "archive", "at", "url")
    best = F.max(F.struct("page_id", F.struct((-F.col("at")).alias("back"), "archive", "at", "url").alias("r")))
    shared = stage(
        large.groupBy("payload_sha1").agg(F.count("*").alias("n"), best.alias("best")).where("n > 1")
        .select(F.col("payload_sha1").alias("digest"), F.struct("best.r.archive", "best.r.at", "best.r.url").alias("to")),
        "arc-responses",
    )
    revisits = (
        large.join(shared, F.col("payload_sha1") == F.col("digest"))
        .where((F.col("archive") != F.col("to.archive")) | (F.col("at") != F.col("to.at")))
        .select("archive", "at", F.col("to.archive").alias("to_archive"), F.col("to.at").alias("to_at"), F.col("to.url").alias("to_url"))
    )

    def write(key, archive: pd.DataFrame, decided: pd.DataFrame) -> pd.DataFrame:
        if not len(archive):
            return pd.DataFrame({"path": [], "records": [], "bytes": []})
        path = key[0]
        name = re.sub(r"\.arc(\.gz)?$", "", path.rpartition("/")[2])
        out = ArchiveWriter(f"{folder}/{name}-{TaskContext.get().taskAttemptId()}.warc.gz")
        to = {int(a): (b, int(c), d) for a, b, c, d in zip(decided["at"], decided["to_archive"], decided["to_at"], decided["to_url"], strict=True)}
        _convert_one(path, to, out)
        return pd.DataFrame([out.close()], columns=["path", "records", "bytes"])

    archives = max(1, manifest.count())
    left = manifest.select("path").repartition(archives, "path").groupBy("path")
    right = revisits.repartition(archives, "archive").groupBy("archive")
    return stage(left.cogroup(right).applyInPandas(write, MANIFEST), "warc-manifest")


def _warc_records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    source = _reader(path)
    while line := source.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: no WARC record where one must begin")
        fields = {}
        while (line := source.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, _exactly(source, int(fields["content-length"]), path)


def _read_one(path: str) -> Iterator[dict]:
    for fields, block in _warc_records(path):
        kind = fields["warc-type"]
        if kind == "warcinfo":
            continue
        _, http, payload = _http(block)
        declared = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        if kind != "revisit" and hashlib.sha1(payload).hexdigest() != declared:
            raise ValueError(f"{path}: {fields['warc-record-id']} does not match its digest")
        page_id = http.get("x-page-id")
        yield {
            "record_id": fields["warc-record-id"], "record_type": kind, "page_id": int(page_id) if page_id else None,
            "target_uri": fields["warc-target-uri"], "warc_date": fields["warc-date"],
            "payload_bytes": int(http.get("content-length", 0)) if kind == "revisit" else len(payload),
            "payload_digest": declared, "refers_to_id": fields.get("warc-refers-to"),
        }


def read_warc(manifest: DataFrame) -> DataFrame:
    """Records of WARC archives; payloads of responses are checked against their digests."""
    return _each(manifest, _read_one, READ)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    legacy = write_arc(table(spark, sf_dir, "pages"), shared_dir(spark, "arc"))
    records = stage(read_warc(convert(legacy, shared_dir(spark, "warc"))), "warc-records")
    cited = records.where("refers_to_id is not null").select(F.col("refers_to_id").alias("cited_id")).distinct()
    named = stage(
        records.join(cited, F.col("record_id") == F.col("cited_id"), "left_semi")
        .select(F.col("record_id").alias("response_id"), F.col("page_id").alias("refers_to")),
        "warc-cited",
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = records.where("refers_to_id is not null").join(named, F.col("refers_to_id") == F.col("response_id"), "left")
    rest = records.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return found.select(*columns).unionByName(rest.select(*columns))


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), r AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM r
"""
