"""WARC archives: a writer with revisit records, and a splittable reader.

An archive is a file of gzip members, one record each. The reader cuts files into byte ranges. A task looks in its range for the gzip
magic, accepts a candidate only if it inflates to a record header, and owns the records whose members start inside its range, also
those that end beyond it. Files are opened by URI through pyarrow's file systems, so that a range is read and nothing else.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


RANGE_BYTES = 4 << 20
#: Bytes of an archive before the next one of the same task is begun.
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 18
#: Tasks of a read at most; each then takes several ranges.
MOST_TASKS = 100_000
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
_DIGEST_NAME = "urn:x-row:"


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: HTTP response header and payload; a revisit keeps only the header, which states the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    target = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "")
    row = "null" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_DIGEST_NAME}{row}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if kind == "revisit":
        head[3:3] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_DIGEST_NAME}{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    """A gzip member of its own."""
    press = zlib.compressobj(level, zlib.DEFLATED, 31)
    return press.compress(data) + press.flush()


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out = name = None
        size, starts = 0, []

        def close():
            nonlocal out
            out.close()
            out = None
            return pa.RecordBatch.from_pydict({"archive": [name], "bytes": [size], "n_records": [len(starts)], "starts": pa.array([starts], pa.list_(pa.int64()))})

        for batch in batches:
            columns = batch.to_pydict()
            for kind, page_id, url, html, digest, refers in zip(*(columns[c] for c in ("record_type", "page_id", "url", "html", "sha1", "refers_to")), strict=True):
                if out is None:
                    name, size, starts = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                made = member(record(kind, page_id, url, html, base64.b32encode(bytes.fromhex(digest)).decode(), refers))
                out.write(made)
                starts.append(size)
                size += len(made)
                if size >= archive_bytes:
                    yield close()
        if out is not None:
            yield close()
    return run


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0,
               archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record per row to archives in ``folder/archives``; ``folder/manifest`` lists the archives that count.

    Payload is the html in UTF-8 (null: empty). Of rows with equal payloads of at least ``least_bytes`` bytes the largest id is a response
    and the others revisit it; rows that repeat that id are responses too, and where all ids are null every row is a response. Archives of
    failed or repeated tasks are not in the manifest and so are never read. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = pages.sparkSession
    rows = (pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
                         F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit("").cast("binary")).alias("html"))
            .withColumn("sha1", F.sha1("html")))
    sized = rows.withColumn("n_bytes", F.octet_length("html"))
    owners = sized.where(F.col("n_bytes") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("owner"))
    revisit = (F.col("n_bytes") >= least_bytes) & F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    typed = (sized.join(owners, "sha1", "left").withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
             .select("record_type", "page_id", "url", "html", "sha1", F.when(revisit, F.col("owner")).alias("refers_to")))
    typed.mapInArrow(_writer(f"{folder}/archives", archive_bytes), "archive string, bytes long, n_records long, starts array<long>").write.parquet(f"{folder}/manifest")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


def parse(data: bytes) -> dict | None:
    """Fields of a whole record, or None if it is none."""
    if not data.startswith(b"WARC/1."):
        return None
    head, blank, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    if not blank or "warc-type" not in fields or not fields.get("content-length", "").isdigit():
        return None
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return {"fields": fields, "http": _fields(http), "payload": payload, "block": block}


class _Range:
    """Bytes of a file from some place on, read as needed."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.base, self.held = file, size, at, bytearray()

    def need(self, upto: int) -> bool:
        """Have the bytes up to ``upto`` at hand, as far as the file goes; True if it reaches so far."""
        have = self.base + len(self.held)
        if upto > have and have < self.size:
            got = self.file.read_at(min(max(upto - have, READ_BYTES), self.size - have), have)
            if not got:
                raise EOFError(f"the archive ends at {have}, not at {self.size}")
            self.held += got
        return self.base + len(self.held) >= upto

    def drop(self, before: int) -> None:
        if before - self.base > READ_BYTES:
            del self.held[:before - self.base]
            self.base = before

    def find(self, what: bytes, at: int, end: int) -> int:
        """First place of ``what`` that starts at ``at`` or later and before ``end``; -1 if there is none."""
        while at < end:
            self.drop(at)
            self.need(min(at + READ_BYTES, self.size))
            held_end = self.base + len(self.held)
            found = self.held.find(what, at - self.base)
            if found >= 0:
                return self.base + found if self.base + found < end else -1
            if held_end >= self.size:
                return -1
            at = max(at, held_end - len(what) + 1)
        return -1


def inflate(source: _Range, at: int) -> tuple[bytes, int] | None:
    """The member that starts at ``at`` and the place after it; None if it is no record."""
    unpack, out, place = zlib.decompressobj(31), [], at
    head = b""
    try:
        while not unpack.eof:
            if not source.need(place + 1):
                return None
            chunk = source.held[place - source.base:place - source.base + READ_BYTES]
            out.append(unpack.decompress(chunk))
            place += len(chunk)
            if len(head) < 7:
                head += out[-1][:7]
                if not b"WARC/1.".startswith(head[:7]):
                    return None
    except zlib.error:
        return None
    return b"".join(out), place - len(unpack.unused_data)


def records_in(file, size: int, begin: int, end: int) -> Iterator[dict]:
    """Records whose members start in ``begin`` <= place < ``end``."""
    source, at = _Range(file, size, begin), begin
    while (at := source.find(MAGIC, at, end)) >= 0:
        got = inflate(source, at)
        found = parse(got[0]) if got else None
        if found is None:
            at += 1
            continue
        yield found | {"offset": at}
        at = got[1]


_READ_SQL = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, "
             "archive string, offset long")


def _row(value: str | None) -> int | None:
    text = (value or "").strip("<>").removeprefix(_DIGEST_NAME)
    return int(text) if re.fullmatch(r"-?\d+", text) else None


def _length(found: dict) -> int:
    """Bytes of the payload; a revisit states those of the payload it stands for."""
    stated = found["http"].get("content-length", "")
    return int(stated) if found["fields"]["warc-type"] == "revisit" and stated.isdigit() else len(found["payload"])


def _reader(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pyarrow.fs.FileSystem.from_uri(folder)
        names = [x.split()[0] for x in _READ_SQL.split(", ")]
        for batch in batches:
            for job in batch.to_pylist():
                rows, held = {n: [] for n in names}, 0

                def made():
                    kinds = {"payload": pa.binary(), "page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "offset": pa.int64()}
                    return pa.RecordBatch.from_arrays([pa.array(rows[n], kinds.get(n, pa.string())) for n in names], names=names)

                seen = 0
                with fs.open_input_file(f"{base}/{job['archive']}") as file:
                    for found in records_in(file, job["bytes"], job["begin"], job["end"]):
                        fields, payload, seen = found["fields"], found["payload"], seen + 1
                        digest = fields.get("warc-payload-digest", "")
                        stated, digest = digest.startswith("sha1:"), digest.removeprefix("sha1:") or None
                        if stated and fields["warc-type"] == "response" and "http" in fields.get("content-type", "") and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"{job['archive']} at {found['offset']}: the payload differs from its digest")
                        values = (_row(fields.get("warc-record-id")), fields.get("warc-target-uri"), fields["warc-type"], _length(found), digest,
                                  _row(fields.get("warc-refers-to")), payload if with_payload else None, job["archive"], found["offset"])
                        for n, v in zip(names, values, strict=True):
                            rows[n].append(v)
                        held += len(payload) if with_payload else 200
                        if held > 8 << 20:
                            yield made()
                            rows, held = {n: [] for n in names}, 0
                if job["expected"] is not None and seen != job["expected"]:
                    raise ValueError(f"{job['archive']} from {job['begin']} to {job['end']}: {seen} records, the manifest says {job['expected']}")
                yield made()
    return run


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives below ``folder``/archives that no manifest lists: archive, bytes. For archives of other writers."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/archives").select("path", F.col("length").alias("bytes"))
    return found.select(F.substring_index("path", "/archives/", -1).alias("archive"), "bytes")


def read_warc(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES, with_payload: bool = True, archives: DataFrame | None = None) -> DataFrame:
    """One row per record of the listed archives; a revisit has the length and digest of the payload it stands for, and no payload.

    A range that holds fewer or more records than the manifest says is an error, so a damaged member is never passed over. ``archives``
    (archive, bytes; see ``list_archives``) takes the manifest's place: of archives of other writers, members that are no records are passed over,
    payload_digest is null where a record has none, and only SHA-1 digests of HTTP responses are compared. Records longer than a range belong to the task
    in whose range they start, which holds one record at a time. An empty manifest gives no rows.
    """
    if archives is None:
        listed = spark.read.parquet(f"{folder}/manifest").select("archive", "bytes", "starts")
    else:
        listed = archives.select("archive", "bytes", F.lit(None).cast("array<long>").alias("starts"))
    begins = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))
    inside = F.size(F.filter("starts", lambda s: (s >= F.col("begin")) & (s < F.col("end"))))
    ranges = (listed.where("bytes > 0").select("archive", "bytes", "starts", F.explode(begins).alias("begin"))
              .withColumn("end", F.least(F.col("begin") + range_bytes, F.col("bytes")))
              .select("archive", "bytes", "begin", "end", F.when(F.col("starts").isNotNull(), inside).alias("expected")))
    # One range is one unit of work. A stated number of partitions, so that the few small rows are not put together into one task.
    n = listed.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 0
    spread = ranges.repartition(int(max(1, min(n, MOST_TASKS))))
    return spread.mapInArrow(_reader(f"{folder}/archives", with_payload), _READ_SQL)


__all__ = ["inflate", "list_archives", "member", "parse", "read_warc", "record", "records_in", "write_warc"]
