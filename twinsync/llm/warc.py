"""WARC records in ZIP packages: written by tasks, and read back by ranges, without extraction.

A package holds stored members: ``archive/*.warc.gz`` (each record compressed on its own) and ``indexes/*.cdx`` (one line of
JSON per record, with its place).  A reader takes the central directory, locates the archive members and indexes, and
reads each record as a range of the file:

1. **Directory and index** of a package are read by one task; they are small beside the records.  An archive member
   that no index covers is walked through once, record by record.
2. **Records** are dealt out by package and place in even shares of bytes, so one large package is read by many tasks.

Packages are named by a manifest that Spark commits: what a lost task left behind is in no manifest.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinsync.llm.common import stored
from twinsync.llm.zip_archive import ArchiveError, Member, ZipWriter, data_start, members, read_at
from twinsync.session import work_folder
from twinsync.sources.files import open_path

MIN_REVISIT = 1000  # bytes of a payload that may be left to an equal one
PACKAGE_BYTES = 1 << 28  # a task begins a new package beyond this
SHARE_BYTES = 1 << 25  # of records, for a task to read
_BATCH_BYTES = 1 << 24
_CHUNK = 1 << 16

# Fixed values of the format.
VERSION = "WARC/1.1"
RESPONSE, REVISIT = "response", "revisit"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


# Writing.


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """A record as it stands in an uncompressed archive."""
    lines = [VERSION, *(f"{name}: {value}" for name, value in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header_text(value: str) -> str:
    """A header's value in one line."""
    return " ".join(value.split())


def record_id(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``pages`` with ``_refers_to``: the id of the row whose payload stands for this one's, or null.

    Of equal payloads of ``min_bytes`` or more, the rows of the largest page_id hold theirs.  Groups are made of digests;
    only groups of several rows are joined back, and every row has a key of its own payload, so a hot group is one that
    Spark splits.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    key = [F.sha2(payload, 256).alias("_key"), F.octet_length(payload).alias("_bytes")]
    groups = pages.select("page_id", *key).where(F.col("_bytes") >= min_bytes).groupBy("_key").agg(
        F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    groups = groups.where("_rows > 1").select("_key", "_first")
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("_key"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return rows.join(groups, "_key", "left").select("page_id", "url", "html", refers.alias("_refers_to"))


def _page_record(page_id: object, url: str | None, html: str | None, refers_to: object, date: str) -> tuple[bytes, dict[str, str]]:
    """A page's record, compressed, and its line of the index."""
    payload = (html or "").encode("utf-8", "surrogatepass")
    sha1 = _digest(payload)
    headers = {
        "WARC-Type": RESPONSE if refers_to is None else REVISIT,
        "WARC-Record-ID": record_id(page_id),
        "WARC-Date": date,
        "WARC-Target-URI": _header_text(url or ""),
        "WARC-Payload-Digest": sha1,
        "Content-Type": "application/http; msgtype=response",
    }
    head = _HTTP_HEAD.format(len(payload)).encode()
    if refers_to is not None:
        headers |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": record_id(refers_to)}
        payload = b""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(record_bytes(headers, head + payload)) + packer.flush()
    return packed, {"url": headers["WARC-Target-URI"], "mime": "text/html", "status": "200", "digest": sha1}


def _digest(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


class _Package:
    """A package as a task writes it."""

    def __init__(self, folder: str, wide: bool) -> None:
        system, root = open_path(folder)
        self.path, name = f"{folder}/{uuid.uuid4().hex}.wacz", "data.warc.gz"
        self.name, self.index, self.records = name, [], 0
        self.out = system.open_output_stream(f"{root}/{self.path.rpartition('/')[2]}")
        self.zip = ZipWriter(self.out, wide)
        self.zip.start(f"archive/{name}")

    def add(self, packed: bytes, line: dict[str, str], time: str) -> None:
        entry = line | {"offset": str(self.zip.size), "length": str(len(packed)), "filename": self.name}
        self.index.append(f"{line['url']} {time} {json.dumps(entry)}\n")
        self.zip.write(packed)
        self.records += 1

    def close(self) -> tuple[str, int]:
        self.zip.finish()
        self.zip.start("indexes/index.cdx")
        for line in sorted(self.index):
            self.zip.write(line.encode())
        self.zip.finish()
        resources = [{"name": m.name.rpartition("/")[2], "path": m.name, "bytes": m.size} for m in self.zip.members]
        self.zip.start("datapackage.json")
        self.zip.write(json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": resources}).encode())
        self.zip.finish()
        self.zip.close()
        self.out.close()
        return self.path, self.records


def write_packages(
    pages: DataFrame,
    folder: str,
    time: datetime,
    min_revisit: int = MIN_REVISIT,
    package_bytes: int = PACKAGE_BYTES,
    wide: bool = False,
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) into packages under ``folder``; returns (path, records).

    ``time`` is every record's date.  Each task writes packages of its own, and begins another beyond ``package_bytes``.
    ``wide`` writes the 64-bit form throughout, which otherwise only large packages have.  See ``mark_revisits`` for
    which payloads are left out.  Null html is an empty payload, null urls are empty, and a null id has an empty name.
    Other columns are left out.  No rows give no packages.
    """
    system, root = open_path(folder)
    system.create_dir(root, recursive=True)
    date, stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ"), time.strftime("%Y%m%d%H%M%S")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, done = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "_refers_to")]
            for row in zip(*columns):
                package = package or _Package(folder, wide)
                package.add(*_page_record(*(value.as_py() for value in row), date), stamp)
                if package.zip.size >= package_bytes:
                    done.append(package.close())
                    package = None
        if package:
            done.append(package.close())
        if done:
            paths, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], ["path", "records"])

    return stored(mark_revisits(pages, min_revisit).mapInArrow(write, "path string, records bigint"), "manifest")


# Reading.


class _Spot(NamedTuple):
    path: str
    offset: int | None
    length: int | None
    problem: str | None


def _is_archive(member: Member) -> bool:
    return member.name.startswith("archive/") and member.name.endswith((".warc", ".warc.gz"))


def _is_index(member: Member) -> bool:
    return member.name.startswith("indexes/") and member.name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz"))


def _chunks(file: BinaryIO, start: int, size: int, unpack: bool = False) -> Iterator[bytes]:
    """A member's data in parts, decompressed if they are to be; compressed data may be several streams in a row."""
    unpacker = zlib.decompressobj(31) if unpack else None
    for at in range(start, start + size, _CHUNK):
        data = read_at(file, at, min(_CHUNK, start + size - at))
        while unpacker and data:
            yield unpacker.decompress(data)
            data = unpacker.unused_data
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)
        if not unpack:
            yield data


def _lines(parts: Iterator[bytes]) -> Iterator[bytes]:
    held = b""
    for part in parts:
        *whole, held = (held + part).split(b"\n")
        yield from whole
    if held:
        yield held


def _indexed(file: BinaryIO, index: Member, archives: dict[str, tuple[int, int]]) -> Iterator[tuple[str, int, int] | str]:
    """Archive, place and length of each line's record, or what is wrong with the line."""
    parts = _chunks(file, data_start(file, index), index.size, index.name.endswith(".gz"))
    for line in _lines(parts):
        if not line.strip() or line.startswith(b"!"):
            continue
        try:
            entry = json.loads(line[line.index(b"{"):])
            name, offset, length = str(entry["filename"]).rpartition("/")[2], int(entry["offset"]), int(entry["length"])
        except (ValueError, KeyError, TypeError):
            yield "unreadable line of an index"
            continue
        if name not in archives:
            yield f"an index names {name}, which is not among the stored members"
        elif offset < 0 or length <= 0 or offset + length > archives[name][1]:
            yield f"an index reaches beyond {name}"
        else:
            yield name, offset, length


def _walked(file: BinaryIO, start: int, size: int, packed: bool) -> Iterator[tuple[int, int]]:
    """Place and length of each record of an archive member without an index."""
    at = 0
    while at < size:
        if packed:
            unpacker, read = zlib.decompressobj(31), at
            while not unpacker.eof:
                if read >= size:
                    raise ArchiveError("an archive ends within a record")
                data = read_at(file, start + read, min(_CHUNK, size - read))
                unpacker.decompress(data)
                read += len(data)
            end = read - len(unpacker.unused_data)
        else:
            head = read_at(file, start + at, min(_CHUNK, size - at))
            blank = head.find(b"\r\n\r\n")
            if blank < 0:
                raise ArchiveError("no end of a record's head")
            length = int(_fields(head[:blank])[1].get("content-length", "0"))
            end = at + blank + 4 + length + 4
        yield at, end - at
        at = end


def locate_package(path: str) -> Iterator[_Spot]:
    """Where each record of a package stands in the file, and what could not be read."""
    system, inner = open_path(path)
    with system.open_input_file(inner) as file:
        try:
            listed = list(filter(lambda m: _is_archive(m) or _is_index(m), members(file, file.size())))
            archives = {}
            for member in listed:
                if not member.ranges:
                    yield _Spot(path, None, None, f"{member.name} is compressed or encrypted as a whole")
                elif _is_archive(member):
                    archives[member.name.rpartition("/")[2]] = (data_start(file, member), member.size)
            covered = set()
            for member in listed:
                if _is_index(member) and member.ranges:
                    for found in _indexed(file, member, archives):
                        if isinstance(found, str):
                            yield _Spot(path, None, None, found)
                        else:
                            covered.add(found[0])
                            yield _Spot(path, archives[found[0]][0] + found[1], found[2], None)
            for name, (start, size) in archives.items():
                if name not in covered:
                    for offset, length in _walked(file, start, size, name.endswith(".gz")):
                        yield _Spot(path, start + offset, length, None)
        except (ArchiveError, zlib.error, ValueError) as error:
            yield _Spot(path, None, None, str(error))


def locate_records(packages: DataFrame) -> DataFrame:
    """Rows (path, offset, length, problem) for the packages named in column ``path``.

    A package that is no archive, is cut off, or holds members that cannot be read by ranges gives a row with its
    ``problem`` and no place; all that can be read of it is still listed.
    """

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("problem", pa.string())]
        schema, held = pa.schema(fields), []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for spot in locate_package(path):
                    held.append(spot._asdict())
                    if len(held) >= 1 << 14:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    # A row is a whole package: each is a task's work of its own.
    paths = packages.where("path is not null").select("path").distinct().repartition(F.col("path"))
    return stored(paths.mapInArrow(locate, "path string, offset bigint, length bigint, problem string"), "places")


def _fields(head: bytes) -> tuple[str, dict[str, str]]:
    """First line and header fields, names in lower case; a line that begins with a blank continues the one before."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last:
            fields[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = name.strip().lower()
            fields[last] = value.strip()
    return first, fields


class Record(NamedTuple):
    record_type: str | None
    record_id: str | None
    target_uri: str | None
    date: str | None
    refers_to: str | None
    digest: str | None
    payload: bytes | None
    problem: str | None


def parse_record(data: bytes) -> Record:
    """A record from its bytes, compressed or not.  The payload of an HTTP response is what follows its head."""
    try:
        if data[:2] == b"\x1f\x8b":
            data = zlib.decompress(data, 31)
        head, blank, rest = data.partition(b"\r\n\r\n")
        first, fields = _fields(head)
        if not blank or not first.startswith("WARC/"):
            raise ValueError("no head of a record")
        length = int(fields["content-length"])
        if length < 0 or length > len(rest):
            raise ValueError("a record is shorter than its head tells")
        block = rest[:length]
    except (ValueError, KeyError, zlib.error) as error:
        return Record(*[None] * 7, f"unreadable record: {error}")
    kind = fields.get("content-type", "")
    payload = block.partition(b"\r\n\r\n")[2] if kind.startswith("application/http") else block
    names = ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "warc-refers-to", "warc-payload-digest")
    return Record(*map(fields.get, names), payload, None)


_RECORD_TYPE = (
    "path string, offset bigint, record_type string, record_id string, target_uri string, date string, refers_to string,"
    " digest string, payload binary, problem string"
)


def read_records(packages: DataFrame, share_bytes: int = SHARE_BYTES) -> DataFrame:
    """The records of the packages named in column ``path``, each read as a range of its file.

    Columns: path, offset, record_type, record_id, target_uri, date, refers_to, digest (as in the head), payload (binary;
    empty for a revisit) and problem, which tells why a record or a package could not be read and is null else.  Other
    columns of ``packages`` are left out; a path that repeats is read once, a null path not at all.  No rows give no rows.
    """
    places = locate_records(packages)
    shares = places.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    dealt = places.where("problem is null").repartitionByRange(max(1, -(-shares // share_bytes)), "path", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, held, size = None, None, [], 0
        for batch in batches:
            for spot in batch.select(["path", "offset", "length"]).to_pylist():
                if spot["path"] != path:
                    if file:
                        file.close()
                    path = spot["path"]
                    system, inner = open_path(path)
                    file = system.open_input_file(inner)
                record = parse_record(read_at(file, spot["offset"], spot["length"]))
                held.append({"path": path, "offset": spot["offset"], **record._asdict()})
                size += len(record.payload or b"")
                if size >= _BATCH_BYTES or len(held) >= 1 << 12:
                    yield _record_batch(held)
                    held, size = [], 0
        if held:
            yield _record_batch(held)
        if file:
            file.close()

    found = dealt.sortWithinPartitions("path", "offset").mapInArrow(read, _RECORD_TYPE)
    lost = places.where("problem is not null").select("path", "offset", "problem")
    return found.unionByName(lost, allowMissingColumns=True)


def _record_batch(rows: list[dict]) -> pa.RecordBatch:
    names = ("record_type", "record_id", "target_uri", "date", "refers_to", "digest")
    fields = [("path", pa.string()), ("offset", pa.int64()), *((n, pa.string()) for n in names)]
    return pa.RecordBatch.from_pylist(rows, pa.schema([*fields, ("payload", pa.binary()), ("problem", pa.string())]))


def _page_id(urn: Column, id_type: str) -> Column:
    """The id in a record's name."""
    name = F.substring_index(F.substring(urn, len("<urn:page:") + 1, 1 << 20), ">", 1)
    return F.nullif(name, F.lit("")).cast(id_type)


def page_digests(records: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Per page record: page_id, payload_bytes, payload_digest (hex SHA-1), record_type, refers_to.

    Bytes and digest are those of the payload as read; a revisit takes them from the record that it refers to.  That join
    is a left join on one row per name, so revisits of one hot page are split among tasks.
    """
    measured = records.where("problem is null").select(
        F.col("record_id"), "record_type", F.col("refers_to").alias("refers"),
        F.octet_length("payload").cast("bigint").alias("own_bytes"), F.sha1("payload").alias("own_digest"),
    )
    measured = stored(measured, "measured")
    held = measured.where(F.col("record_type") == RESPONSE).groupBy(F.col("record_id").alias("refers")).agg(
        F.max(F.struct("own_bytes", "own_digest")).alias("held")
    )
    # A response refers to nothing and joins under its own name, which spreads them; its own values stand.
    keyed = measured.withColumn("refers", F.coalesce("refers", "record_id"))
    joined = keyed.join(held, "refers", "left")
    revisit = F.col("record_type") == REVISIT
    return joined.select(
        _page_id(F.col("record_id"), id_type).alias("page_id"),
        F.when(revisit, F.col("held.own_bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("held.own_digest")).otherwise(F.col("own_digest")).alias("payload_digest"),
        "record_type",
        F.when(revisit, _page_id(F.col("refers"), id_type)).alias("refers_to"),
    )


def package_and_read(pages: DataFrame, time: datetime, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Packages of all ``pages`` in a work folder, read back: see ``page_digests``."""
    spark = pages.sparkSession
    manifest = write_packages(pages, work_folder(spark, "packages"), time, min_revisit)
    return page_digests(read_records(manifest), pages.schema["page_id"].dataType.simpleString())
