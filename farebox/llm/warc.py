"""WARC archives: a writer that stores repeated payloads once, and a salvage reader.

Every record is a gzip member of its own. Tasks write whole archive files to a folder through a file system that is
addressed by URI, and Spark's tasks read them back as streams. Records are parsed while a member is decoded. When a record
is damaged, the reader goes on at the next version line; when a member is, it keeps the records that were whole before and
looks for the next gzip header or version line in the file. The bytes it passed over are logged.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.tasks import small_batches, stored
from farebox.session import scratch_path

# Equal payloads of at least so many bytes are stored once.
LEAST_SHARED_BYTES = 100
# An archive is closed after so many compressed bytes.
ARCHIVE_BYTES = 64 << 20
# Bytes of records without a digest that wait for the check of their member; beyond them they are handed over unchecked.
HELD_BACK = 64 << 20
_CHUNK = 1 << 20
_PIECE = 1 << 14
_VERSION = b"WARC/1.1"
_VERSION_LINE = re.compile(rb"WARC/1\.[0-9]\r\n")
_NEXT_RECORD = re.compile(rb"\r\n(?=WARC/1\.[0-9]\r\n)")
_LONGEST_VERSION_LINE = 10
_MAGIC = b"\x1f\x8b\x08"
_RECORD_IDS = uuid.UUID("5b0f6a52-3c57-4ad1-9f0e-6a0a4d0c8d11")


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system behind a URI, and the path in it; a plain path is local."""
    if "://" not in uri:
        uri = uri.removeprefix("file:")
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def member(data: bytes) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record; line breaks in values become spaces."""
    lines = [f"{k}: {' '.join(v.splitlines())}" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return _VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    """``checked`` says that the member's own checksum or the record's digest has confirmed it."""

    headers: dict[str, str]
    block: bytes
    checked: bool = False


def payload_of(record: Record) -> bytes:
    """What a record is about: of an HTTP response its body, else the block."""
    if record.headers.get("content-type", "").replace(" ", "").startswith("application/http"):
        return record.block.partition(b"\r\n\r\n")[2]
    return record.block


def _digest_holds(record: Record) -> bool | None:
    """Whether a stated SHA-256 digest fits; None if none is stated."""
    for name, data in (("warc-block-digest", record.block), ("warc-payload-digest", None)):
        kind, _, value = record.headers.get(name, "").partition(":")
        if kind == "sha256" and record.headers.get("warc-type") != "revisit":
            return hashlib.sha256(payload_of(record) if data is None else data).hexdigest() == value
    return None


class Parser:
    """Records out of bytes that arrive piece by piece; ``gaps`` lists what had to be passed over, counted from the start.

    Every byte is looked at a fixed number of times: what was searched in vain is not searched again, and what was used up is
    let go in large steps.
    """

    def __init__(self, most: int | None = None):
        # ``most`` is how many bytes can arrive at all: a stated length beyond it is damage that need not be waited for
        self.most, self.ended = most, False
        self.held, self.start, self.at = bytearray(), 0, 0
        self.gaps: list[tuple[int, int]] = []
        self.begin_record()

    def begin_record(self) -> None:
        # of the record at ``start``: where the search for the blank line goes on, and header and length once known
        self.searched, self.header_end, self.size, self.lines_checked = 0, -1, None, 0

    def __len__(self) -> int:
        return len(self.held) - self.start

    def feed(self, data: bytes) -> None:
        if self.start > _CHUNK and self.start > len(self.held) // 2:
            del self.held[:self.start]
            self.start = 0
        self.held += data

    def drop(self, n: int) -> None:
        self.start += n
        self.at += n
        self.begin_record()

    def gap(self, n: int) -> None:
        if n:
            if self.gaps and self.gaps[-1][1] == self.at:
                self.gaps[-1] = (self.gaps[-1][0], self.at + n)
            else:
                self.gaps.append((self.at, self.at + n))
            self.drop(n)

    def _lines_fit(self, end: int) -> bool:
        """Whether the whole lines up to ``end`` are header lines: a name and a colon, or the continuation of one."""
        while True:
            stop = self.held.find(b"\r\n", self.start + self.lines_checked, self.start + end)
            if stop < 0:
                return True
            line = self.held[self.start + self.lines_checked:stop]
            if self.lines_checked and not (line[:1] in (b" ", b"\t") or b":" in line):
                return False
            self.lines_checked = stop + 2 - self.start

    def next_record(self) -> Record | None | bool:
        """The record at the start; None if more bytes are needed, False if there is no whole record here."""
        if len(self) < _LONGEST_VERSION_LINE and not self.ended:
            return None
        if not _VERSION_LINE.match(self.held, self.start):
            return False
        if self.header_end < 0:
            found = self.held.find(b"\r\n\r\n", self.start + self.searched)
            if not self._lines_fit(found + 2 - self.start if found >= 0 else len(self)):
                return False
            if found < 0:
                self.searched = max(0, len(self) - 3)
                return False if self.ended else None
            self.header_end = found - self.start
            self.size = _content_length(bytes(self.held[self.start:found]))
            if self.size is None or self.most is not None and self.at + self.header_end + 8 + self.size > self.most:
                return False
        end = self.header_end + 4 + self.size
        if len(self) < end + 4:
            return False if self.ended else None
        if self.held[self.start + end:self.start + end + 4] != b"\r\n\r\n":
            return False
        head = bytes(self.held[self.start:self.start + self.header_end])
        one = Record(_headers(head), bytes(self.held[self.start + self.header_end + 4:self.start + end]))
        self.drop(end + 4)
        return one

    def records(self) -> Iterator[Record]:
        """Records that are whole by now; what is none is passed over up to the next version line."""
        while len(self):
            one = self.next_record()
            if one is None:
                return
            if one is not False:
                yield one
                continue
            if not self._skip():
                return

    def _skip(self) -> bool:
        """Pass over bytes, one at least, up to the next version line; False if that lies beyond what is held."""
        found = self.held.find(b"WARC/1.", self.start + 1)
        while found >= 0:
            if len(self.held) - found < _LONGEST_VERSION_LINE and not self.ended or _VERSION_LINE.match(self.held, found):
                self.gap(found - self.start)
                return True
            found = self.held.find(b"WARC/1.", found + 1)
        # a version line may be cut off at the end of what is held
        self.gap(len(self) if self.ended else max(0, len(self) - _LONGEST_VERSION_LINE))
        return False


@dataclass
class Salvage:
    """Records of one archive. ``gaps`` lists the (start, stop) byte ranges of the file that had to be passed over,
    ``inner_gaps`` those inside decoded members: where the member starts, and the range in its decoded bytes.

    ``size`` is the archive's length, if known: no record can be longer than what is left of it.
    """

    stream: object
    size: int | None = None
    gaps: list[tuple[int, int]] = field(default_factory=list)
    inner_gaps: list[tuple[int, int, int]] = field(default_factory=list)

    def __post_init__(self):
        self.raw = Parser(self.size)
        self.raw.gaps = self.gaps

    def _more(self) -> bool:
        chunk = b"" if self.raw.ended else self.stream.read(_CHUNK)
        self.raw.ended |= not chunk
        self.raw.feed(chunk)
        return bool(chunk)

    def _member(self) -> Iterator[Record]:
        """The records of the gzip member at the start; the file is passed over up to its end, or, if it fails, up to the
        piece in which its last whole record ended, and to the next start from there.

        Records whose digest holds are handed over at once. Others wait for the member's checksum: if that fails they are
        lost, because any of them may be the damaged one; if the member is cut off or stops decoding, those without a digest
        stand before the damage and are handed over unchecked.
        """
        raw, unpack = self.raw, zlib.decompressobj(31)
        begin, used, sound, waiting, held_back, failure = raw.at, 0, 0, [], 0, None
        # deflate makes no more than 1032 bytes of one
        inner = Parser(None if self.size is None else (self.size - raw.at) * 1032)
        while not unpack.eof:
            if used >= len(raw) and not self._more():
                failure = "cut"
                break
            piece = bytes(raw.held[raw.start + used:raw.start + used + _PIECE])
            before = unpack.copy()
            try:
                inner.feed(unpack.decompress(piece))
            except zlib.error as error:
                failure = "check" if "data check" in str(error) or "length check" in str(error) else "damaged"
                data, sound = _until_error(before, piece)
                inner.feed(data)
            inner.ended = unpack.eof
            whole = 0
            for one in inner.records():
                whole += 1
                if _digest_holds(one):
                    one.checked = True
                    yield one
                else:
                    waiting.append(one)
                    held_back += len(one.block)
                if held_back > HELD_BACK:
                    yield from waiting
                    waiting, held_back = [], 0
            if failure is not None:
                break
            if whole and not unpack.eof:
                # all before this piece belongs to records that are whole
                raw.drop(used)
                used = 0
            used += len(piece)
        if failure is None:
            for one in waiting:
                one.checked = _digest_holds(one) is not False
            yield from waiting
            if len(inner):
                inner.gap(len(inner))
            raw.drop(used - len(unpack.unused_data))
        else:
            good = [one for one in waiting if _digest_holds(one) is None] if failure != "check" else []
            if len(good) < len(waiting) and raw.at > begin:
                self.gaps.append((begin, raw.at))
            yield from good
            self._skip_to_next_start(1 if raw.at == begin else 0, used + sound)
        self.inner_gaps += [(begin, *g) for g in inner.gaps]

    def _skip_to_next_start(self, after: int = 1, decoded: int = 0) -> None:
        """Pass over bytes, ``after`` at least, up to where the next member or version line may begin. In the first ``decoded``
        bytes, which a member was decoded from, only another member can: a version line there was seen in what it decoded to.
        """
        raw = self.raw
        while True:
            lines = max(after, decoded)
            found = [i - raw.start for i in (raw.held.find(_MAGIC, raw.start + after), raw.held.find(b"WARC/1.", raw.start + lines)) if i >= 0]
            if found or raw.ended:
                return raw.gap(min(found, default=len(raw)))
            passed = max(after, len(raw) - 8)  # a start may be cut off at the end of what is held
            raw.gap(min(passed, len(raw)))
            after, decoded = 0, max(0, decoded - passed)
            self._more()

    def __iter__(self) -> Iterator[Record]:
        raw = self.raw
        while len(raw) or self._more():
            while len(raw) < _LONGEST_VERSION_LINE and self._more():
                pass
            if raw.held.startswith(_MAGIC, raw.start):
                yield from self._member()
            elif raw.held.startswith(b"WARC/1.", raw.start):
                one = raw.next_record()
                while one is None:
                    self._more()
                    one = raw.next_record()
                if one is False:
                    self._skip_to_next_start()
                else:
                    one.checked = _digest_holds(one) is True
                    yield one
            else:
                self._skip_to_next_start()


def _until_error(unpack, piece: bytes) -> tuple[bytes, int]:
    """What a piece decodes to before its error, and how many of its bytes that takes: the error itself loses all that the
    call has decoded."""
    out, at, step = [], 0, len(piece)
    while step and at < len(piece):
        before = unpack.copy()
        try:
            out.append(unpack.decompress(piece[at:at + step]))
            at += step
        except zlib.error:
            unpack, step = before, step // 2
    return b"".join(out), at


def _content_length(head: bytes) -> int | None:
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit() and len(value) < 20:
            return int(value)
    return None


def _headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a continued line is joined to its field by a space."""
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += f" {line.strip()}"
        else:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def assign_records(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``digest`` (SHA-256), and for a page that repeats another's payload ``refers_to`` (that
    page) and ``refers_to_url``, else NULL.

    Of equal payloads of ``LEAST_SHARED_BYTES`` or more the smallest page id is the response; rows that repeat that id
    are responses too. A NULL id comes after all others; if no equal page has an id, all are responses. NULL html is empty.
    Page ids are whole numbers; a column of another type is cast.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("html"),
        F.sha2(payload, 256).alias("digest"))
    long = F.octet_length("html") >= LEAST_SHARED_BYTES
    least = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("least")
    first = own.where(long).groupBy(F.col("digest").alias("known")).agg(least, F.count("*").alias("n")).select(
        "known", "n", F.col("least.page_id").alias("first"), F.col("least.url").alias("first_url")).where(
        "n > 1 and first is not null")
    # read twice, written once: the digests are what is costly, and they stay with the narrow side of the join
    joined = own.join(first, F.col("digest") == F.col("known"), "left")
    repeats = long & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select(
        "page_id", "url", "html", "digest", F.when(repeats, F.col("first")).alias("refers_to"),
        F.when(repeats, F.col("first_url")).alias("refers_to_url"))


def record_id(page_id: int | None, url: str, digest: str) -> str:
    """The same for the same page, so that a revisit can name the record it refers to; equal rows share it."""
    return f"<urn:uuid:{uuid.uuid5(_RECORD_IDS, f'{page_id} {digest} {url}')}>"


def page_record(
    page_id: int | None, url: str, html: str, digest: str, refers_to: int | None, refers_to_url: str | None, date: str,
) -> bytes:
    """A page as a WARC/1.1 record: a response is an HTTP message with the payload as its body, a revisit has the head alone
    and names the record that holds the payload."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, url, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if refers_to is not None:
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, refers_to_url, digest)),
            ("WARC-Refers-To-Target-URI", refers_to_url),
            ("WARC-Refers-To-Date", date),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    headers += [("X-Page-ID", "" if page_id is None else str(page_id)), ("X-Payload-Length", str(len(payload)))]
    return record(headers, http if refers_to is not None else http + payload)


def write_archives(records: DataFrame, folder: str, date: datetime | None = None) -> DataFrame:
    """Write a record per row of ``assign_records`` into archives under ``folder``; returns their ``uri`` and ``n_records``.

    ``date`` is the pages' time (by default now). A task that is repeated writes files of new names; only those of the
    attempt whose rows arrive are listed.
    """
    small_batches(records.sparkSession)
    stamp = (date or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        out, uri, size, n, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out, uri, size, n = system.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0, 0
                data = member(page_record(*row, stamp))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((uri, n))
        if out is not None:
            out.close()
            done.append((uri, n))
        if done:
            yield pa.RecordBatch.from_pydict({"uri": [d[0] for d in done], "n_records": pa.array([d[1] for d in done], pa.int64())})

    return records.select("page_id", "url", "html", "digest", "refers_to", "refers_to_url").mapInArrow(write, "uri string, n_records long")


_READ = """page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string,
    valid boolean, html string, gap_start long, gap_stop long, decoded_start long, decoded_stop long, uri string"""
_READ_TYPES = [
    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.string()]
_READ_NAMES = [
    "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "valid", "html", "gap_start", "gap_stop",
    "decoded_start", "decoded_stop", "uri"]


def read_archives(archives: DataFrame, with_html: bool = False) -> DataFrame:
    """Records of the archives in column ``uri``, and a row for each gap: record type ``gap`` with the byte range in the file,
    or, for a damaged record inside a member that decodes, the member's place and the range in its decoded bytes.

    ``payload_digest`` and ``payload_bytes`` of a response are computed from what was read, and ``valid`` says whether
    they agree with its headers; a revisit has those of its headers. An archive is read as a stream, so its size is no
    matter; it is the unit of work.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def number(text):
            return int(text) if text and text.lstrip("-").isdigit() else None

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _READ_TYPES)], names=_READ_NAMES)

        rows, held = [], 0
        for uri in (u for b in batches for u in b.column(0).to_pylist()):
            system, path = file_system(uri)
            with system.open_input_stream(path, compression=None, buffer_size=_CHUNK) as stream:
                archive = Salvage(stream, system.get_file_info(path).size)
                for one in archive:
                    h = one.headers
                    stated, size = h.get("warc-payload-digest", "").removeprefix("sha256:"), number(h.get("x-payload-length"))
                    kind, html, valid = h.get("warc-type", ""), None, True
                    if kind == "response":
                        payload = payload_of(one)
                        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
                        valid, stated, size = digest == stated and length == size, digest, length
                        html = payload.decode("utf-8", "replace") if with_html else None
                    rows.append((
                        number(h.get("x-page-id")), size, stated, kind, number(h.get("x-refers-to-page-id")), h.get("warc-target-uri"),
                        valid, html, None, None, None, None, uri))
                    held += len(html or "")
                    if len(rows) >= 4096 or held > 4 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                rows += [(None, None, None, "gap", None, None, False, None, a, b, None, None, uri) for a, b in archive.gaps]
                rows += [(None, None, None, "gap", None, None, False, None, at, None, a, b, uri) for at, a, b in archive.inner_gaps]
        if rows:
            yield batch(rows)

    return archives.select("uri").mapInArrow(read, _READ)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write all pages to archives under ``folder`` (a fresh one in the shared folder by default) and return their list,
    one archive per partition or more, spread over as many partitions as there are archives at most."""
    spark = pages.sparkSession
    written = stored(write_archives(assign_records(pages), folder or scratch_path(spark, "warc")), "archives")
    return written.repartition(max(1, min(10_000, written.count())), "uri")
