"""WARC archives as a PySpark Python data source.

``spark.read.format("docloom_warc")`` plans whole archive files as partitions,
takes predicates on the record type and on the parsed headers, parses the
headers of a record first and does not decode the payload of records that the
predicates reject or whose payload is not asked for (option ``payload=false``).
Each record is a gzip member of its own, as is usual; beside an archive lies
the list of its members' lengths, so the rest of an unwanted member is not even
inflated.  Archives of other writers are read as well: a file, or every ``.warc``
and ``.warc.gz`` below a folder.  Those are stepped through by Content-Length; in
compressed ones an unwanted payload is inflated but neither kept nor decoded, and
members may hold one record or many.  The writer puts one file per task attempt,
rolled at ``roll_mb``; the commit lists the files of the successful attempts in a
manifest, so a retried task leaves no duplicates.  Paths go through
``pyarrow.fs``: local and shared folders, and remote stores it knows.

Defined cases: header names are matched without regard to case, folded header
lines are joined, and bytes that are no UTF-8 become the replacement character.
Values with line breaks, control characters or outer white space are written as an
encoded word and read back unchanged.  Payloads of any length are kept whole; a
record is the unit of memory.  An empty table gives an archive without files.
Other columns of ``pages`` are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import io
import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, WriterCommitMessage

from ._util import Scratch

#: Payloads below this many bytes are never revisits.
REVISIT_BYTES = 1000
MANIFEST = "_manifest.json"
#: Ending of the list of member lengths (little-endian 64-bit), and the compression level.
LENGTHS, LEVEL = ".len", 4
SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_length long, headers map<string,string>, payload binary"
)
#: Columns that come from one header each.
HEADER = {
    "record_id": "WARC-Record-ID",
    "record_type": "WARC-Type",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_ENCODED = re.compile(r"=\?utf-8\?b\?([A-Za-z0-9+/=]*)\?=", re.IGNORECASE)
_COLUMN = {name.lower(): column for column, name in HEADER.items()}


def _fs(path: str):
    import pyarrow.fs as pf

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pf.LocalFileSystem(), path
    return pf.FileSystem.from_uri(path)


def _little(values: array) -> array:
    """The values in little-endian order (its own inverse)."""
    if sys.byteorder == "big":
        values = array(values.typecode, values)
        values.byteswap()
    return values


def _written(value: str) -> str:
    """A header value that neither ends nor splits the header; ``_value`` gives it back."""
    if re.search(r"[\x00-\x1f\x7f\ud800-\udfff]", value) or value != value.strip(" ") or _ENCODED.fullmatch(value):
        return f"=?utf-8?B?{base64.b64encode(value.encode('utf-8', 'surrogatepass')).decode()}?="
    return value


def _value(written: str) -> str:
    found = _ENCODED.fullmatch(written)
    return base64.b64decode(found[1]).decode("utf-8", "surrogatepass") if found else written


def record_bytes(row: dict) -> bytes:
    """One record: version line, headers, empty line, block, two line ends."""
    payload = bytes(row["payload"]) if row["payload"] is not None else b""
    head = [b"WARC/1.1"]
    for column, name in HEADER.items():
        if row.get(column) is not None:
            head.append(f"{name}: {_written(row[column])}".encode())
    for name, value in sorted((row.get("headers") or {}).items()):
        head.append(f"{_CONTROL.sub('-', name)}: {_written(value or '')}".encode())
    head.append(b"Content-Length: %d" % len(payload))
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


@dataclass
class _Files(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, roll: int):
        self.path, self.roll = path, roll

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        files, out, lengths, size = [], None, array("Q"), 0

        def close() -> None:
            if out is not None:
                out.close()
                with fs.open_output_stream(f"{base}/{files[-1]}{LENGTHS}") as side:
                    side.write(_little(lengths).tobytes())

        for row in iterator:
            data = gzip.compress(record_bytes(row.asDict()), LEVEL, mtime=0)
            if out is None or size + len(data) > self.roll:
                close()
                files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                out, lengths, size = fs.open_output_stream(f"{base}/{files[-1]}", compression=None), array("Q"), 0
            out.write(data)
            lengths.append(len(data))
            size += len(data)
        close()
        return _Files(files)

    def commit(self, messages: list) -> None:
        fs, base = _fs(self.path)
        fs.create_dir(base, recursive=True)
        names = sorted(f for m in messages if m is not None for f in m.files)
        with fs.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        fs, base = _fs(self.path)
        for m in messages:
            for f in m.files if m is not None else ():
                fs.delete_file(f"{base}/{f}")
                fs.delete_file(f"{base}/{f}{LENGTHS}")


@dataclass
class _File(InputPartition):
    file: str


def records(stream, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """Headers, and the payload if wanted, of every record whose headers ``wanted`` accepts.

    ``stream`` is a seekable binary file.  A payload that is not wanted is stepped over.
    """
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts here: {line[:40]!r}")
        lines = []
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line)
        headers = fields(lines)
        length = int(headers["Content-Length"])
        if not wanted(headers):
            stream.seek(length, 1)
            continue
        if with_payload:
            payload = stream.read(length)
            if len(payload) < length:
                raise ValueError("the archive ends inside a record")
            yield headers, payload
        else:
            stream.seek(length, 1)
            yield headers, None


def fields(lines: list[bytes]) -> dict[str, str]:
    """The named fields of a record's head, without its version line; known names in their usual case."""
    out: dict[str, str] = {}
    name = ""
    for line in lines:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and name:
            out[name] += " " + text.strip(" \t")
            continue
        name, _, value = text.partition(":")
        name = name.strip()
        name = HEADER[_COLUMN[name.lower()]] if name.lower() in _COLUMN else "Content-Length" if name.lower() == "content-length" else name
        out[name] = value.strip(" \t")
    if "Content-Length" not in out:
        raise ValueError("a record states no Content-Length")
    return {k: _value(v) for k, v in out.items()}


def _headers(block: bytes) -> dict[str, str]:
    lines = block.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"no record starts here: {lines[0][:40]!r}")
    return fields(lines[1:])


def member_records(stream, lengths: array, wanted, with_payload: bool) -> Iterator[tuple[dict, bytes | None]]:
    """The same for an archive of gzip members of known lengths: a member is inflated up to the end of its headers first."""
    at = 0
    for length in lengths:
        stream.seek(at)
        at += length
        data, inflate, head = stream.read(length), zlib.decompressobj(31), b""
        while (end := head.find(b"\r\n\r\n")) < 0:
            piece = inflate.decompress(inflate.unconsumed_tail if head else data, 2048)
            if not piece:
                raise ValueError("the archive ends inside a record")
            head += piece
        headers = _headers(head[:end])
        if not wanted(headers):
            continue
        payload = None
        if with_payload:
            size = int(headers["Content-Length"])
            payload = (head[end + 4 :] + inflate.decompress(inflate.unconsumed_tail))[:size]
            if len(payload) < size:
                raise ValueError("the archive ends inside a record")
        yield headers, payload


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = str(options.get("payload", "true")).lower() == "true"
        self.equal: list[tuple[str, tuple]] = []

    def pushFilters(self, filters: list):  # noqa: N802
        """Takes equality and membership on header columns and on keys of the header map; leaves the rest to Spark."""
        for f in filters:
            name = HEADER.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            if len(getattr(f, "attribute", ())) == 2 and f.attribute[0] == "headers":
                name = f.attribute[1]
            if name and isinstance(f, EqualTo):
                self.equal.append((name, (f.value,)))
            elif name and isinstance(f, In):
                self.equal.append((name, tuple(f.value)))
            elif name and isinstance(f, IsNotNull):
                yield f
            else:
                yield f

    def partitions(self) -> list:
        """The files of the manifest, or without one every archive below the path, or the path itself."""
        import pyarrow.fs as pf

        fs, base = _fs(self.path)
        if fs.get_file_info(f"{base}/{MANIFEST}").type == pf.FileType.File:
            with fs.open_input_stream(f"{base}/{MANIFEST}") as f:
                return [_File(f"{base}/{name}") for name in json.loads(f.read())]
        if fs.get_file_info(base).type == pf.FileType.File:
            return [_File(base)]
        found = fs.get_file_info(pf.FileSelector(base, recursive=True))
        return [_File(name) for name in sorted(x.path for x in found if x.type == pf.FileType.File) if name.lower().endswith((".warc", ".warc.gz"))]

    def read(self, partition) -> Iterator[tuple]:
        import pyarrow.fs as pf

        if partition is None:
            return
        fs, _ = _fs(self.path)
        wanted = lambda headers: all(headers.get(name) in values for name, values in self.equal)
        with fs.open_input_file(partition.file) as raw:
            stream = io.BufferedReader(_Raw(raw), 1 << 18)
            if not partition.file.lower().endswith(".gz"):
                found = records(stream, wanted, self.payload)
            elif fs.get_file_info(partition.file + LENGTHS).type == pf.FileType.File:
                with fs.open_input_stream(partition.file + LENGTHS) as side:
                    found = member_records(stream, _little(array("Q", side.read())), wanted, self.payload)
            else:
                found = records(io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 18), wanted, self.payload)
            for headers, payload in found:
                rest = {k: v for k, v in headers.items() if k not in HEADER.values() and k != "Content-Length"}
                yield (*(headers.get(h) for h in HEADER.values()), int(headers["Content-Length"]), rest, payload)


class _Raw:
    """The part of a raw file that a buffered reader needs."""

    def __new__(cls, file):
        class Raw(io.RawIOBase):
            def readable(self):
                return True

            def seekable(self):
                return True

            def readinto(self, buffer):
                data = file.read(len(buffer))
                buffer[: len(data)] = data
                return len(data)

            def seek(self, offset, whence=0):
                return file.seek(offset, whence)

            def tell(self):
                return file.tell()

        return Raw()


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "docloom_warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(float(self.options.get("roll_mb", 64)) * 1e6))


def register(spark: SparkSession) -> None:
    """Registers the source and lets Spark offer it filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def archive(pages: DataFrame, path: str, roll_mb: float = 64, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes one record per row of ``pages``.

    Of rows with equal payloads of ``REVISIT_BYTES`` or more, the one with the
    largest id is the response and the others revisit it without a payload.
    Rows with equal ids and payloads are all responses where that id is the
    largest.  Null html is the empty payload; a null url leaves its header out;
    a null id is written without a page header and never revisits.
    """
    spark = pages.sparkSession
    register(spark)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("body"))
    rows = rows.withColumn("bytes", F.octet_length("body").cast("long")).withColumn("digest", F.sha1("body"))
    first = rows.filter(F.col("bytes") >= REVISIT_BYTES).groupBy("digest", "bytes").agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("copies"))
    # only groups of copies matter: the others keep their narrow side
    known = first.filter("copies > 1").select(F.col("digest").alias("_d"), F.col("bytes").alias("_b"), "response")
    rows = rows.join(known, (F.col("digest") == F.col("_d")) & (F.col("bytes") == F.col("_b")), "left")
    revisit = F.coalesce(F.col("response") != F.col("id"), F.lit(False))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    out = rows.select(
        urn(F.col("id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.concat(F.lit("sha1:"), F.col("digest")).alias("payload_digest"),
        F.when(revisit, urn(F.col("response"))).alias("refers_to"),
        F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("long").alias("content_length"),
        F.when(revisit, F.create_map(F.lit("WARC-Profile"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).alias("headers"),
        F.when(revisit, F.lit(b"")).otherwise(F.col("body")).alias("payload"),
    )
    out.write.format("docloom_warc").mode("append").option("path", path).option("roll_mb", str(roll_mb)).save()


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("docloom_warc").option("path", path).option("payload", str(payload).lower()).load()


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per record: id, full payload bytes and digest, type and the response it refers to.

    Responses are digested from the payload that was read back; revisits take
    theirs from their response, and their own records are read without payload.
    """
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?\\d+)>$", 1).try_cast("long")
    response = read(spark, path).filter("record_type = 'response'").select(
        page(F.col("record_id")).alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest")
    )
    revisit = read(spark, path, payload=False).filter("record_type = 'revisit'").select(
        page(F.col("record_id")).alias("page_id"), page(F.col("refers_to")).alias("refers_to"), F.col("payload_digest").alias("stated")
    )
    body = response.groupBy(F.col("page_id").alias("refers_to"), F.concat(F.lit("sha1:"), "payload_digest").alias("stated")).agg(F.max("payload_bytes").alias("payload_bytes"))
    full = revisit.join(body, ["refers_to", "stated"], "left").select("page_id", "payload_bytes", F.substring("stated", 6, 40).alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to")
    plain = response.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(full)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archives ``pages`` in the shared folder and digests what is read back."""
    spark = pages.sparkSession
    path = Scratch(spark, "warc").path("archive")
    archive(pages, path)
    return digest(spark, path)
