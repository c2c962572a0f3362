"""WARC archives: a writer that stores equal payloads once, and a reader that salvages damaged files.

Writing: payloads are grouped by their SHA-256. The page with the smallest id of a group is
a ``response``, the others are ``revisit`` records that refer to it and hold the HTTP
header alone. Only groups of several pages go back to the pages: groups with a large
share of all rows, of which there cannot be many, are broadcast, the others too if their
number is checked to be small, else joined. Each record is a gzip member, and Spark's text
writer puts the members into files, so files appear as a whole or not at all, whatever
executors are lost. Its line separator is the last byte of a member: the top
byte of the member's length, which is 0 because no member holds 16 MB (a longer record
has several members).

Reading: files are cut into ranges of bytes, one task's work each, so neither a file nor a record
without its payload is ever held whole. A task reads the records that begin in its range.
Each is checked: deflate and CRC of its members, version line, header, length, end mark and
SHA-256 or SHA-1 digests, where it has any. After a failed check the reader looks for the next
gzip member or version line that begins a valid record, and goes on there. A record that a range
begins inside of could hold what looks like records; rows of each range that begin before the end of a
record of an earlier range are therefore left out. Bytes of no record are logged as gaps
with the first failed check. A member of many records that breaks off keeps those whose own digest matched.

Defined cases: a null or empty html is an empty payload, a null url has no URI line, control
characters and spaces in urls are percent-encoded; payloads below ``MIN_BYTES``
are never shared. Of equal payloads, every row with the smallest id is a response, rows
without an id are responses if the whole group has none; repeated rows give repeated records. Records of
any length are read in pieces, headers of over ``HEADER_BYTES`` fail their check. An empty
table gives files without records; other columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import Scratch, sliced

#: Smaller payloads are stored each time
MIN_BYTES = 100
#: Bytes of an archive that one task reads
SPLIT_BYTES = 16 << 20
#: Records of a file
FILE_ROWS = 100_000
#: Groups of equal payloads (40 bytes each) up to which the table is broadcast
BROADCAST_GROUPS = 200_000
#: Groups with at least this share of all rows are broadcast in any case: at most 1 / HEAVY of them
HEAVY = 0.001
HEADER_BYTES = 1 << 20
#: Most tasks of a read; each takes several ranges beyond that
MOST_TASKS = 20_000
DATE = "1970-01-01T00:00:00Z"

# fixed values of the format
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/[01]\.[0-9]+\r\n")
_BEGINS = re.compile(rb"\x1f\x8b\x08|WARC/[01]\.[0-9]")
_GZIP = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"

_MEMBER_BYTES = (1 << 24) - 1
_PIECE = 1 << 20


# ---- writing


def _id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def _uri(url: str) -> str:
    return re.sub("[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def _head(page, url, size: int, digest: str, first, refers: bool, date: str) -> tuple[bytes, bytes]:
    """Header of a record with its end, and the HTTP header that begins its block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {_id(page)}"]
    lines += [f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{digest}"]
    if refers:
        lines += [f"WARC-Refers-To: {_id(first)}", f"WARC-Profile: {_PROFILE}"]
        lines += [f"WARC-Block-Digest: sha256:{hashlib.sha256(http).hexdigest()}"]
    lines.append(f"Content-Length: {len(http) + (0 if refers else size)}")
    return "\r\n".join(lines).encode() + _END, http


def _members(record: bytes) -> bytes:
    """gzip members of a record, each below 16 MB; the last byte, a zero, is left out."""
    out = []
    for at in range(0, len(record), _MEMBER_BYTES):
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        out.append(pack.compress(record[at : at + _MEMBER_BYTES]) + pack.flush())
    return b"".join(out)[:-1]


def _packed(compress: bool, date: str):
    """Rows (page, url, html, bytes, digest, first, refers) to records without the separator's bytes."""

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(each):
            step = max(1, batch.num_rows * (4 * _PIECE) // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                records = []
                for row in batch.slice(at, step).to_pylist():
                    head, http = _head(
                        row["page"], row["url"], row["bytes"], row["digest"], row["first"], row["refers"], date
                    )
                    payload = b"" if row["refers"] else row["html"]
                    records.append(head + http + payload + (_END if compress else b""))
                data = pa.array([_members(r) for r in records] if compress else records, pa.large_binary())
                # bytes in a column of strings: Spark's text writer takes them as they are
                text = pa.LargeStringArray.from_buffers(len(data), data.buffers()[1], data.buffers()[2])
                yield pa.record_batch([text.cast(pa.string())], ["value"])

    return run


def first_of_equal(pages: DataFrame) -> DataFrame:
    """``(digest, first, rows)``: smallest page id of each payload that several pages have."""
    sized = pages.where(F.col("bytes") >= MIN_BYTES)
    groups = sized.groupBy(F.unhex("digest").alias("of")).agg(
        F.min("page").alias("first"), F.count(F.lit(1)).alias("rows")
    )
    return groups.where((F.col("rows") > 1) & F.col("first").isNotNull())


def _with_first(pages: DataFrame, groups: DataFrame) -> DataFrame:
    """Pages with the first page of equal payload, null where there is none."""
    same = (F.unhex("digest") == F.col("of")) & (F.col("bytes") >= MIN_BYTES)
    if groups.count() <= BROADCAST_GROUPS:
        return pages.join(F.broadcast(groups.select("of", "first")), same, "left").drop("of")
    share = groups.agg(F.sum("rows")).first()[0] * HEAVY
    heavy = groups.where(F.col("rows") >= share).select("of", "first")
    light = groups.where(F.col("rows") < share).select("of", F.col("first").alias("other"))
    found = pages.join(F.broadcast(heavy), same, "left").drop("of")
    # what needs no join stays out of it: empty payloads, for one, are all equal
    wanting = (F.col("bytes") >= MIN_BYTES) & F.col("first").isNull()
    joined = found.where(wanting).join(light, same, "left").withColumn("first", F.col("other"))
    return found.where(~wanting).unionByName(joined.drop("of", "other"))


def write(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    compress: bool = True,
    date: str = DATE,
) -> None:
    """A record for each page, as gzip members or, uncompressed, as plain records."""
    scratch = Scratch(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).cast("string").alias("url"), payload.alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("bytes"), F.sha2("html", 256).alias("digest"))
    groups = scratch.keep(first_of_equal(rows.select("page", "bytes", "digest")), "groups")
    rows = _with_first(rows, groups)
    refers = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    rows = rows.select("page", "url", "html", "bytes", "digest", "first", refers.alias("refers"))
    separator = "\0" if compress else _END.decode()
    rows.mapInArrow(_packed(compress, date), "value string").write.options(
        lineSep=separator, maxRecordsPerFile=FILE_ROWS, compression="none"
    ).text(path)


# ---- reading


class Broken(Exception):
    """A check that failed."""


class _File:
    """Bytes of a file by position, through a window."""

    def __init__(self, path: str, size: int):
        if local := re.match("file:/+(.*)", path):
            self.file = pyarrow.fs.LocalFileSystem().open_input_file("/" + local[1])
        else:
            system, name = pyarrow.fs.FileSystem.from_uri(path)
            self.file = system.open_input_file(name)
        self.size = size
        self.begin, self.window = 0, b""

    def at(self, place: int, n: int) -> bytes:
        n = max(0, min(n, self.size - place))
        if not self.begin <= place <= place + n <= self.begin + len(self.window):
            self.begin, self.window = place, self.file.read_at(max(n, min(_PIECE, self.size - place)), place)
        return self.window[place - self.begin : place - self.begin + n]


class _Plain:
    """Bytes from a place on."""

    def __init__(self, file: _File, place: int):
        self.file, self.place = file, place

    def read(self, n: int) -> bytes:
        got = self.file.at(self.place, min(n, _PIECE))
        self.place += len(got)
        return got

    def ended(self) -> bool:
        return True


class _Inflated:
    """What the gzip members from a place on hold; ``place`` is where the next member begins."""

    def __init__(self, file: _File, place: int):
        self.file, self.place = file, place
        self.member = None
        self.ready = b""

    def _more(self, upto: int = _PIECE) -> bytes:
        """Bytes of the member that is open, or none at its end."""
        while self.member:
            fed = self.member.unconsumed_tail or self.file.at(self.place, 1 << 16)
            new = not self.member.unconsumed_tail
            try:
                got = self.member.decompress(fed, upto)
            except zlib.error as error:
                raise Broken(f"gzip: {error}") from None
            if new:
                self.place += len(fed)
            if self.member.eof:
                self.place -= len(self.member.unused_data)
                self.member = None
            elif not fed and not got:
                raise Broken("gzip: member breaks off")
            if got:
                return got
        return b""

    def read(self, n: int) -> bytes:
        if not self.ready:
            if not self.member:
                if self.file.at(self.place, 3) != _GZIP:
                    return b""
                self.member = zlib.decompressobj(31)
            self.ready = self._more()
        got, self.ready = self.ready[:n], self.ready[n:]
        return got

    def ended(self) -> bool:
        """Whether the member that is open is over, with its checksum verified."""
        if not self.ready:
            self.ready = self._more()
        return not self.ready


def _until_end(read, most: int) -> tuple[bytes, bytes]:
    """A header up to its empty line, and what was read beyond."""
    data = b""
    while (at := data.find(_END)) < 0:
        if len(data) > most or not (got := read()):
            raise Broken("header without an end")
        data += got
    return data[: at + 4], data[at + 4 :]


def _fields(head: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found.setdefault(name.strip().lower(), value.strip())
    return found


def _matches(said: str | None, digests: dict) -> bool | None:
    """Whether a digest line holds; None if there is none of a known kind."""
    kind, _, value = (said or "").partition(":")
    if kind.lower() not in digests:
        return None
    raw = digests[kind.lower()].digest()
    return value.lower() == raw.hex() or value.upper() == base64.b32encode(raw).decode()


def _record(stream, file: _File, place: int, payloads: bool) -> dict:
    """The record that begins here, checked; the stream is then behind it."""
    rest = b""

    def more() -> bytes:
        nonlocal rest
        got, rest = rest or stream.read(1 << 12), b""
        return got

    first = more()
    while len(first) < 16 and (got := more()):
        first += got
    if not _VERSION.match(first):
        raise Broken("no version line")
    rest = first
    head, rest = _until_end(more, HEADER_BYTES)
    fields = _fields(head)
    if not re.fullmatch("[0-9]{1,18}", fields.get("content-length", "")):
        raise Broken("no length")
    left = int(fields["content-length"])
    if isinstance(stream, _Plain):
        # looked at first: a false length must not cost a read of the file
        if file.at(place + len(head) + left, 4) != _END:
            raise Broken("no end where the length says")

    def block() -> bytes:
        """The next piece of the block."""
        nonlocal rest, left
        got = (rest or stream.read(min(left, _PIECE) or 1))[:left] if left else b""
        rest = rest[len(got) :] if rest else rest
        if left and not got:
            raise Broken("record breaks off")
        left -= len(got)
        return got

    whole = {"sha256": hashlib.sha256(), "sha1": hashlib.sha1()} if "warc-block-digest" in fields else {}
    kind = fields.get("warc-type", "")
    parts, size, http = [], 0, {}
    inner = {"sha256": hashlib.sha256()}
    if (fields.get("warc-payload-digest") or "").lower().startswith("sha1:"):
        inner["sha1"] = hashlib.sha1()
    begin = b""
    if fields.get("content-type", "").lower().startswith("application/http"):

        def noted() -> bytes:
            got = block()
            for digest in whole.values():
                digest.update(got)
            return got

        top, begin = _until_end(noted, HEADER_BYTES)
        http = _fields(top)
    for piece in _pieces(begin, block, whole):
        size += len(piece)
        for digest in inner.values():
            digest.update(piece)
        if payloads:
            parts.append(piece)
    end = rest[:4]
    rest = rest[4:]
    while len(end) < 4 and (got := stream.read(4 - len(end))):
        end += got
    if end != _END:
        raise Broken("no end where the length says")
    if rest:  # belongs to the next record
        if isinstance(stream, _Plain):
            stream.place -= len(rest)
        else:
            stream.ready = rest + stream.ready
    checks = [_matches(fields.get("warc-block-digest"), whole)]
    if kind == "revisit":
        digest = (fields.get("warc-payload-digest") or "").partition(":")[2] or None
        size = int(http["content-length"]) if re.fullmatch("[0-9]{1,18}", http.get("content-length", "")) else None
    else:
        checks.append(_matches(fields.get("warc-payload-digest"), inner))
        digest = inner["sha256"].hexdigest()
    if False in checks:
        raise Broken("digest differs")
    return {
        "record_type": kind,
        "record_id": fields.get("warc-record-id"),
        "refers_to": fields.get("warc-refers-to"),
        "uri": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": b"".join(parts) if payloads and kind != "revisit" else None,
        "checked": True in checks,
    }


def _pieces(begin: bytes, block, whole: dict) -> Iterator[bytes]:
    if begin:
        yield begin
    while got := block():
        for digest in whole.values():
            digest.update(got)
        yield got


def _unit(file: _File, place: int, payloads: bool) -> tuple[list[dict], int | None, str | None]:
    """Records that begin here, where what follows begins (None if a check failed), and which one."""
    gzip = file.at(place, 3) == _GZIP
    stream = _Inflated(file, place) if gzip else _Plain(file, place)
    found: list[dict] = []
    try:
        while True:
            found.append(_record(stream, file, place, payloads))
            if stream.ended():
                return found, stream.place, None
    except Broken as error:
        return [r for r in found if r["checked"]], None, str(error)


def _next(file: _File, place: int, upto: int) -> int:
    """The first place from here that looks like the begin of a record, or ``upto``."""
    while place < upto:
        data = file.at(place, 1 << 16)
        if found := _BEGINS.search(data):
            return min(place + found.start(), upto)
        if len(data) < 1 << 16:
            return upto
        place += len(data) - 7
    return upto


_ROW = (
    "kind string, path string, part long, begin long, until long, nth long, why string, head_why string, record_type string, "
    "record_id string, refers_to string, uri string, payload_bytes long, payload_digest string, payload binary"
)


def _rows(path: str, size: int, part: int, start: int, end: int, payloads: bool) -> Iterator[dict]:
    """Records, gaps between them, and a last row with the range's first and last place in records."""
    file = _File(path, size)
    place, reach, first, why, head_why = start, None, None, None, None
    if start:
        place = _next(file, start, end)
    while place < end:
        records, after, failed = _unit(file, place, payloads)
        why = why or failed
        if records or after is not None:
            if reach is not None and place > reach:
                yield {"kind": "gap", "begin": reach, "until": place, "why": why}
            if first is None:
                first, head_why = place, why
            until = place if after is None else after
            for nth, record in enumerate(records):
                yield {"kind": "record", "begin": place, "until": until, "nth": nth, **record}
            reach, why = until, failed
        place = _next(file, place + 1, end) if after is None else after
        if after is not None and place < end and not _BEGINS.match(file.at(place, 16)):
            why = why or "no record here"
            place = _next(file, place, end)
    yield {"kind": "part", "begin": first, "until": reach, "why": why, "head_why": head_why}


def _read(payloads: bool):
    names = [f.split()[0] for f in _ROW.split(", ")]
    types = [pa.int64() if f.split()[1] == "long" else pa.binary() if f.split()[1] == "binary" else pa.string() for f in _ROW.split(", ")]

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, types)], names)

    def run(each: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ranges in each:
            for one in ranges.to_pylist():
                rows, held = [], 0
                start = one["part"] * one["step"]
                for row in _rows(one["path"], one["length"], one["part"], start, min(start + one["step"], one["length"]), payloads):
                    rows.append(row | {"path": one["path"], "part": one["part"]})
                    held += 1000 + len(row.get("payload") or b"")
                    if held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                yield batch(rows)

    return run


class Salvage:
    """What the archives below a path hold: ``records`` and ``gaps``."""

    def __init__(self, spark: SparkSession, path: str, payloads: bool = False, split_bytes: int | None = None):
        step = split_bytes or SPLIT_BYTES
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
        ranges = files.where("length > 0").select(
            "path",
            "length",
            F.lit(step).cast("long").alias("step"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step))).alias("part"),
        )
        tasks = min(MOST_TASKS, max(1, ranges.count()))
        found = ranges.repartition(tasks, "path", "part").mapInArrow(_read(payloads), _ROW)
        found = Scratch(spark, "salvage").keep(found, "rows")
        self.files, self.found = files, found
        # one row for each range of a file; earlier ranges may reach into later ones
        earlier = Window.partitionBy("path").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        self.parts = found.where("kind = 'part'").select(
            "path", "part", "begin", "until",
            F.coalesce(F.max("until").over(earlier), F.lit(0)).alias("reach"),
            F.coalesce(F.last("why", ignorenulls=True).over(earlier), "head_why").alias("head_why"),
            "why",
        )

    def _standing(self, kind: str) -> DataFrame:
        """Rows of a kind with the ``reach`` of earlier ranges, where that matters."""
        inside = self.parts.where("begin < reach").select("path", "part", "reach")
        return self.found.where(F.col("kind") == kind).join(inside, ["path", "part"], "left")

    @property
    def records(self) -> DataFrame:
        """Checked records: where they stand and what they say."""
        rows = self._standing("record").where("reach IS NULL OR begin >= reach")
        return rows.select(
            "path", "begin", "until", "nth", "record_type", "record_id", "refers_to", "uri",
            "payload_bytes", "payload_digest", "payload",
        )

    @property
    def gaps(self) -> DataFrame:
        """Bytes ``begin`` to ``until`` of each file that belong to no record, and the first failed check there."""
        inner = self._standing("gap").select(
            "path", F.greatest("begin", F.coalesce("reach", "begin")).alias("begin"), "until", "why"
        )
        ahead = self.parts.where("begin > reach").select(
            "path", F.col("reach").alias("begin"), F.col("begin").alias("until"), F.col("head_why").alias("why")
        )
        last = self.parts.groupBy("path").agg(
            F.coalesce(F.max("until"), F.lit(0)).alias("begin"),
            F.max_by("why", F.when(F.col("why").isNotNull(), F.col("part"))).alias("why"),
        )
        tail = last.join(self.files, "path").select("path", "begin", F.col("length").alias("until"), "why")
        return inner.unionByName(ahead).unionByName(tail).where("begin < until")


def page_number(record_id: Column) -> Column:
    """The page id in a record id of :func:`write`."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
