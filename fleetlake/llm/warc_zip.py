"""WARC records in ZIP packages, and a reader that fetches records by range.

A package is a ZIP archive whose members are stored, not deflated: ``archive/data.warc.gz`` (one
gzip member per WARC record, so that every record can be read alone), ``indexes/index.cdxj`` (one
line per record: key of the url, time, and JSON with offset and length inside that member) and
``datapackage.json``.

The reader never extracts an archive.  It reads the end of the file, follows the end-of-central-
directory record (and its ZIP64 form), lists the central directory (with ZIP64 extra fields),
finds the stored archive members and their indexes (CDXJ, CDX, also compressed), cuts the members
at indexed records into ranges of bounded size and reads each range in a task of its own, window by
window.  What no index names (whole members, or request and metadata records between the indexed
ones) is walked record by record as well, so nothing that an archive holds is left out.

Records with equal payloads: the one with the largest page_id is the response, the others are
revisits that name it and carry only the HTTP header.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm import common

#: Bytes of compressed records in one package; bytes of one range read.
PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
MAX_READ_TASKS = 20_000
#: Bytes read at once, and bytes given to the decompressor at once.
WINDOW_BYTES, FEED_BYTES = 1 << 20, 1 << 14
#: Copies of a payload are dealt over so many parts when their response is looked up.
SALTS = 16
#: A payload with more than one in so many of all repeated rows is looked up in a broadcast table,
#: which has fewer rows than this.
HOT_PART = 1000

# Fixed values of the formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LOCAL_HEADER, CENTRAL_HEADER = 0x04034B50, 0x02014B50
END_RECORD, END64_RECORD, END64_LOCATOR = 0x06054B50, 0x06064B50, 0x07064B50
ZIP64_EXTRA = 0x0001
STORED = 0
#: Columns of a CDX file without a header line, by their number.
CDX_FIELDS = {9: "NbamskrVg", 10: "NbamskrMVg", 11: "NbamskrMSVg"}


# --- writing -----------------------------------------------------------------------------------


def warc_record(page_id, url, date: str, digest: str, n_bytes: int, payload: bytes | None, refers_to) -> bytes:
    """One WARC record: a response with its payload, or (``payload`` None) a revisit."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{'' if page_id is None else page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    block = http if payload is None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if payload is None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def url_key(url: str | None) -> str:
    """The sorting key of an index line: host names from the last to the first, then path and query,
    in lower case; a url without a host is its own key."""
    text = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "-")
    try:
        parts = urlsplit(text)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return text.lower()
    name = ",".join(reversed(host.removeprefix("www.").split(".")))
    return (name + (f":{port}" if port else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")).lower()


def index_line(url: str | None, date: str, digest: str, at: int, length: int, revisit: bool) -> str:
    fields = {
        "url": url or "",
        "mime": "warc/revisit" if revisit else "text/html",
        "status": "200",
        "digest": f"sha1:{digest}",
        "length": str(length),
        "offset": str(at),
        "filename": "data.warc.gz",
    }
    return f"{url_key(url)} {re.sub('[^0-9]', '', date)[:14]} {json.dumps(fields)}"


def package(records: list[bytes], index: list[str]) -> bytes:
    """A ZIP package of compressed records and their index lines."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(zipfile.ZipInfo("archive/data.warc.gz"), b"".join(records))
        z.writestr(zipfile.ZipInfo("indexes/index.cdxj"), "".join(x + "\n" for x in sorted(index)))
        z.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "resources": [{"path": "archive/data.warc.gz", "records": len(index)}]}))
    return out.getvalue()


def _write(folder: str, date: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = common.open_filesystem(folder)
        records, index, at = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal records, index, at
            name = f"pages-{uuid.uuid4().hex}.wacz"
            raw = package(records, index)
            with fs.open_output_stream(f"{base}/{name}") as out:
                out.write(raw)
            row = pa.RecordBatch.from_pylist([{"path": f"{folder}/{name}", "records": len(index), "n_bytes": len(raw)}])
            records, index, at = [], [], 0
            return row

        for batch in batches:
            for page, url, payload, digest, n, top in zip(*common.batches_of(batch, "page_id", "url", "payload", "digest", "n_bytes", "refers_to"), strict=True):
                code = base64.b32encode(bytes.fromhex(digest)).decode()
                raw = gzip_member(warc_record(page, url, date, code, n, payload, top))
                records.append(raw)
                index.append(index_line(url, date, code, at, len(raw), payload is None))
                at += len(raw)
                if at >= package_bytes:
                    yield flush()
        if records:
            yield flush()

    return run


def write_packages(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write one WARC record per row of ``pages`` (page_id, url, html) into packages below
    ``folder`` (a URI shared by all executors); returns the written manifest (path, records, n_bytes).

    Payload: html in UTF-8, null as empty.  Of records with equal payloads of at least
    ``least_bytes`` bytes the one with the largest page_id is the response (with it every row that
    repeats that page_id), the others revisit it.  A null page_id is never the response of others;
    where all are null, all are responses.  A null url becomes ``urn:page:<id>``; control
    characters and spaces in a url are percent-encoded.  Other columns are ignored.
    """
    spark = pages.sparkSession
    common.configure(spark)
    fs, base = common.open_filesystem(folder)
    fs.create_dir(base, recursive=True)
    payload = common.text_bytes("html")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    repeated = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
        .where(F.col("n") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    repeated = common.written(repeated, "warc-repeated")
    least_hot = (repeated.agg(F.sum("copies")).first()[0] or 0) / HOT_PART
    hot = repeated.where(F.col("copies") > least_hot).select("digest", F.col("top").alias("hot_top"), F.lit(True).alias("hot"))
    tops = repeated.where(F.col("copies") <= least_hot).select("digest", "top", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    # rows of a hot payload have salts that no row of ``tops`` has
    hashed = F.xxhash64("page_id", "url")
    salt = F.when(F.col("hot"), F.lit(SALTS) + F.pmod(hashed, F.lit(1 << 31))).otherwise(F.pmod(hashed, F.lit(SALTS)))
    dealt = rows.join(F.broadcast(hot), "digest", "left").withColumn("salt", salt).join(tops, ["digest", "salt"], "left").withColumn("top", F.coalesce("hot_top", "top"))
    revisit = F.col("top").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") != F.col("top")))
    out = dealt.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "digest",
        F.octet_length("payload").cast("long").alias("n_bytes"),
        F.when(revisit, F.col("top")).alias("refers_to"),
    )
    return common.written(out.mapInArrow(_write(folder, date, package_bytes), "path string, records long, n_bytes long"), "warc-manifest")


# --- the ZIP directory ----------------------------------------------------------------------------


def directory_place(read, size: int) -> tuple[int, int]:
    """(offset, entries) of the central directory; ``read(offset, length)`` gives bytes."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(struct.pack("<I", END_RECORD))
    while end >= 0 and (len(tail) < end + 22 or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
        end = tail.rfind(struct.pack("<I", END_RECORD), 0, end)
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP archive")
    entries, _, offset = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and struct.unpack_from("<I", tail, end - 20)[0] == END64_LOCATOR:
        (at64,) = struct.unpack_from("<Q", tail, end - 20 + 8)
        rec = read(at64, 56)
        if struct.unpack_from("<I", rec)[0] != END64_RECORD:
            raise ValueError("broken ZIP64 end of central directory")
        entries64, _, offset64 = struct.unpack_from("<QQQ", rec, 32)
        entries = entries64 if entries == 0xFFFF else entries
        offset = offset64 if offset == 0xFFFFFFFF else offset
    return offset, entries


def members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (method, offset of the data, stored size) of every member."""
    at, entries = directory_place(read, size)
    raw = read(at, size - at)
    out, p = {}, 0
    for _ in range(entries):
        sign, method, packed, plain, n_name, n_extra, n_comment, local = struct.unpack_from("<I6xH8xIIHHH8xI", raw, p)
        if sign != CENTRAL_HEADER:
            raise ValueError("broken central directory")
        name = raw[p + 46 : p + 46 + n_name].decode("utf-8", "replace")
        extra, q = raw[p + 46 + n_name : p + 46 + n_name + n_extra], 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, q)
            if kind == ZIP64_EXTRA:
                # holds, in this order, those of the fields that are saturated
                body, r = extra[q + 4 : q + 4 + n], 0
                if plain == 0xFFFFFFFF:
                    r += 8
                if packed == 0xFFFFFFFF:
                    (packed,) = struct.unpack_from("<Q", body, r)
                    r += 8
                if local == 0xFFFFFFFF:
                    (local,) = struct.unpack_from("<Q", body, r)
            q += 4 + n
        head = read(local, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL_HEADER:
            raise ValueError("broken local header")
        name_len, extra_len = struct.unpack_from("<HH", head, 26)
        out[name] = (method, local + 30 + name_len + extra_len, packed)
        p += 46 + n_name + n_extra + n_comment
    return out


def index_entries(name: str, raw: bytes) -> list[tuple[int, int | None, str | None]]:
    """(offset, length or None, file name or None) of each line of an index: CDXJ (key, time, JSON), bare
    JSON, or CDX with or without its header line; ``.gz`` of any number of members."""
    if name.endswith(".gz"):
        raw = b"".join(_inflated([raw]))
    out = []
    letters = None
    for line in raw.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if not line.strip() or line.startswith("!"):
            continue
        if line.lstrip().startswith("CDX "):
            letters = "".join(line.split()[1:])
            continue
        brace = 0 if line.startswith("{") else line.find(" {") + 1
        if brace or line.startswith("{"):
            x = json.loads(line[brace:])
            if "offset" in x:
                out.append((int(x["offset"]), int(x["length"]) if x.get("length") not in (None, "", "-") else None, x.get("filename")))
            continue
        parts = line.split(" ")
        columns = letters or CDX_FIELDS.get(len(parts))
        if columns is None or len(columns) != len(parts):
            raise ValueError(f"{name}: not an index line: {line[:80]!r}")
        x = dict(zip(columns, parts, strict=True))
        if x.get("V", "-") != "-":
            out.append((int(x["V"]), int(x["S"]) if x.get("S", "-") != "-" else None, x.get("g")))
    return out


def record_ranges(read, size: int, range_bytes: int = RANGE_BYTES) -> list[dict]:
    """Ranges (member, start, length) that together are a package's stored archive members, cut
    where an index says that a record begins; longer than ``range_bytes`` only where no index line
    allows a cut.  Index lines name their member by its file name, or there is one member only; lines
    of files that are not in the package are passed over."""
    found = members(read, size)
    archives = [n for n in found if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))]
    indexes = [n for n in found if n.startswith("indexes/") and n.endswith((".cdxj", ".cdx", ".json", ".cdxj.gz", ".cdx.gz"))]
    by_name = {n.removeprefix("archive/"): n for n in archives} | {n.rsplit("/", 1)[-1]: n for n in archives}
    starts: dict[str, set[int]] = {n: {0} for n in archives}
    for name in indexes:
        method, at, length = found[name]
        if method not in (STORED, zipfile.ZIP_DEFLATED):
            raise ValueError(f"{name}: compression {method}")
        raw = read(at, length)
        if method == zipfile.ZIP_DEFLATED:
            raw = zlib.decompress(raw, -15)
        for offset, n, file in index_entries(name, raw):
            member = by_name.get(file) or by_name.get(file.rsplit("/", 1)[-1]) if file else archives[0] if len(archives) == 1 else None
            if member is None:
                continue
            if offset < 0 or offset + (n or 0) > found[member][2]:
                raise ValueError(f"{name}: record at {offset} lies outside {member}")
            starts[member].add(offset)
            if n and offset + n < found[member][2]:
                starts[member].add(offset + n)
    out = []
    for name in archives:
        method, at, length = found[name]
        if method != STORED:
            raise ValueError(f"{name} is not stored")
        cuts = sorted(starts[name])
        begin = 0
        for here, after in zip(cuts, [*cuts[1:], length], strict=True):
            if here > begin and after - begin > range_bytes:
                out.append({"member": name, "start": at + begin, "length": here - begin})
                begin = here
        if length > begin:
            out.append({"member": name, "start": at + begin, "length": length - begin})
    return out


# --- reading records ------------------------------------------------------------------------------


def unchunked(body: bytes) -> bytes:
    """A body sent in chunks, put together; as it is where it is no such body."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = re.match(rb"\s*([0-9A-Fa-f]+)", body[at:end]) if end >= 0 else None
        if not size:
            return body
        n = int(size[1], 16)
        if not n:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def parse_record(raw: bytes) -> dict:
    """The fields of one WARC record (uncompressed).  The payload of an HTTP message is its body,
    that of any other record its block.  A SHA-1 that the record states, in base 32 or 16, must be
    that of the body as it was sent or put together from its chunks."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    block = rest[: int(fields["content-length"])]
    http, payload = b"", block
    if fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    revisit = fields["warc-type"] == "revisit"
    kind, _, digest = fields.get("warc-payload-digest", "").rpartition(":")
    if not revisit:
        stated = digest if kind.lower() in ("sha1", "") else ""
        if len(stated) == 40:
            stated = base64.b32encode(bytes.fromhex(stated)).decode()
        sha1 = lambda x: base64.b32encode(hashlib.sha1(x).digest()).decode()  # noqa: E731, S324 - the format's digest
        digest = sha1(payload)
        if stated and stated.upper() != digest:
            whole = unchunked(payload) if re.search(rb"(?im)^transfer-encoding:.*chunked", http) else payload
            if sha1(whole) != stated.upper():
                raise ValueError(f"payload digest of {fields.get('warc-record-id')}: {digest}, not {stated}")
            payload, digest = whole, stated.upper()
    of = lambda k: (re.fullmatch(r"<urn:page:(-?\d*)>", fields.get(k, "")) or ["", ""])[1]
    return {
        "page_id": int(of("warc-record-id")) if of("warc-record-id") else None,
        "url": fields.get("warc-target-uri"),
        "record_type": fields["warc-type"],
        "payload_digest": digest,
        "payload_bytes": int(length[1]) if revisit and length else len(payload),
        "refers_to": int(of("warc-refers-to")) if of("warc-refers-to") else None,
        "payload": None if revisit else payload,
        "record_id": fields.get("warc-record-id", "").strip("<>") or None,
    }


def _inflated(pieces) -> Iterator[bytes]:
    """The contents of consecutive gzip members, whose borders need not be those of the pieces.  The
    decompressor is fed little at once, as it copies what lies behind a member's end."""
    z = zlib.decompressobj(31)
    begun = False
    for piece in pieces:
        view, at = memoryview(piece), 0
        while at < len(view):
            feed = view[at : at + FEED_BYTES]
            yield z.decompress(feed)
            begun = True
            at += len(feed)
            if z.eof:
                at -= len(z.unused_data)
                z, begun = zlib.decompressobj(31), False
    if begun:
        raise ValueError("a gzip member ends early")


def split_records(pieces, gzipped: bool) -> Iterator[bytes]:
    """The records of consecutive pieces of an archive, of which the first begins with a record; a
    record is given once it is whole, and no more than it and a piece are held."""
    held = bytearray()
    seen = 0  # no end of the header in the bytes before
    need = None
    for piece in _inflated(pieces) if gzipped else pieces:
        held += piece
        while held:
            if need is None:
                if held[0] in b"\r\n":
                    blank = 1
                    while blank < len(held) and held[blank] in b"\r\n":
                        blank += 1
                    del held[:blank]
                    continue
                end = held.find(b"\r\n\r\n", seen)
                if end < 0:
                    seen = max(0, len(held) - 3)
                    break
                length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", held[:end])
                if not held.startswith(b"WARC/") or not length:
                    raise ValueError("not a WARC record")
                need = end + 4 + int(length[1])
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            seen, need = 0, None
    if held:
        raise ValueError("a WARC record ends early")


RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary, record_id string"
RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
        ("record_id", pa.string()),
    ]
)


def _reader(f):
    def read(at: int, n: int) -> bytes:
        f.seek(at)
        return f.read(n)

    return read


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
    for batch in batches:
        for (path,) in zip(*common.batches_of(batch, "path"), strict=True):
            fs, name = common.open_filesystem(path)
            with fs.open_input_file(name) as f:
                yield pa.RecordBatch.from_pylist([{"path": path, **r} for r in record_ranges(_reader(f), f.size())], schema=schema)


def windows(read, start: int, length: int, window: int = WINDOW_BYTES) -> Iterator[bytes]:
    for at in range(start, start + length, window):
        yield read(at, min(window, start + length - at))


def _fetch(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, member, start, length in zip(*common.batches_of(batch, "path", "member", "start", "length"), strict=True):
                fs, name = common.open_filesystem(path)
                with fs.open_input_file(name) as f:
                    rows, held = [], 0
                    for raw in split_records(windows(_reader(f), start, length), member.endswith(".gz")):
                        row = parse_record(raw)
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"")
                        if len(rows) >= 256 or held >= RANGE_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD_ARROW)

    return run


def read_packages(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the packages named in ``manifest`` (path): page_id, url, record_type,
    payload_digest (bare base32 SHA-1, recomputed for responses), payload_bytes and payload (null
    for revisits; both digest and length are those of the full payload), refers_to, record_id.
    page_id and refers_to are null where a record's id is not one that ``write_packages`` gives;
    records of all types are given, indexed or not.  Other columns of ``manifest`` are ignored.

    A digest that does not fit its payload, or a broken archive, is an error."""
    common.configure(manifest.sparkSession)
    # numbers, since the rows are tiny and the work behind them is not
    files = max(1, min(manifest.count(), MAX_READ_TASKS))
    ranges = manifest.select("path").repartition(files).mapInArrow(_plan, "path string, member string, start long, length long")
    return ranges.repartition(min(4 * files, MAX_READ_TASKS)).mapInArrow(_fetch(with_payload), RECORD)
