"""WARC archives: pages written as response, revisit and continuation records, and put together again from their segments."""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from sedimart.session import stage

#: Bytes of a record's block, of a chunk of the chunked body, and of records that are put into one row, at most.
SEGMENT, CHUNK, ROW = 16_384, 4_096, 1 << 20
TOGETHER = 64
#: Rows of an archive file at most, so that one file holds about 16 MB of records.
ROWS_A_FILE = 16
#: Bytes of a payload that is worth a revisit, and payloads with copies whose first owners are sent to every task.
LEAST, BROADCAST = 100, 200_000
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the WARC 1.1 format.
VERSION, END = b"WARC/1.1\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def _cut(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of at most ``size`` bytes that end between characters."""
    at = 0
    while at < len(data):
        stop = min(at + size, len(data))
        while stop < len(data) and data[stop] & 0xC0 == 0x80:
            stop -= 1
        yield data[at:stop]
        at = stop


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cut(payload, size)) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload of chunked transfer framing, with chunk extensions and trailers passed over; ValueError if it is damaged."""
    out, at = [], 0
    while True:
        line = framed.find(b"\r\n", at)
        size = framed[at:line].partition(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise ValueError("chunk without a size")
        at, n = line + 2, int(size, 16)
        if n == 0:
            return b"".join(out)
        if framed[at + n : at + n + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        out.append(framed[at : at + n])
        at += n + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response: what follows its headers, out of the chunked framing if they name it."""
    head, blank, body = block.partition(b"\r\n\r\n")
    if not blank:
        raise ValueError("response without headers")
    if re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head):
        return unchunked(body)
    return body


def _record_id(key: int | None, row: int, segment: int = 1) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{row}/{segment}')}>"


def _record(fields: dict[str, object], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    return VERSION + f"{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block


def records_of(page: dict, segment: int = SEGMENT, date: str = DATE) -> Iterator[bytes]:
    """The records of one page (key, row, url, body, first_key, first_row), without the blank lines after each."""
    key, row, body = page["key"], page["row"], page["body"].encode()
    uri = None if page["url"] is None else urllib.parse.quote(page["url"], safe="!#$%&'()*+,/:;=?@[]~\"<>\\^`{|}")
    common = {"WARC-Date": date, "WARC-Target-URI": uri, "Page-ID": key}
    digest = f"sha256:{hashlib.sha256(body).hexdigest()}"
    if page["first_row"] is not None:
        fields = {"WARC-Type": "revisit", "WARC-Record-ID": _record_id(key, row), **common, "WARC-Payload-Digest": digest, "WARC-Profile": PROFILE}
        fields |= {"WARC-Refers-To": _record_id(page["first_key"], page["first_row"]), "Refers-To-Page-ID": page["first_key"], "Content-Type": "application/http; msgtype=response"}
        yield _record(fields, f"{HTTP}Content-Length: {len(body)}\r\n\r\n".encode())
        return
    block = f"{HTTP}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(body)
    pieces = list(_cut(block, segment))
    for n, piece in enumerate(pieces, 1):
        if n == 1:
            fields = {"WARC-Type": "response", "WARC-Record-ID": _record_id(key, row), **common, "WARC-Payload-Digest": digest, "Content-Type": "application/http; msgtype=response"}
        else:
            fields = {"WARC-Type": "continuation", "WARC-Record-ID": _record_id(key, row, n), **common, "WARC-Segment-Origin-ID": _record_id(key, row)}
        if len(pieces) > 1:
            fields |= {"WARC-Segment-Number": n, "WARC-Segment-Total-Length": len(block) if n == len(pieces) else None}
        yield _record(fields, piece)


def _written(segment: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                for page in batch.slice(at, TOGETHER).to_pylist():
                    for record in records_of(page, segment, date):
                        held.append(record)
                        size += len(record)
                        if size >= ROW:
                            yield pa.RecordBatch.from_arrays([pa.array([END.encode().join(held)]).cast(pa.string())], ["value"])
                            held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([END.encode().join(held)]).cast(pa.string())], ["value"])

    return run


def _with_firsts(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (key, row, url, body) with (first_key, first_row) of the smallest key of their payload, where another row has that.

    One pass counts payloads by a quick hash and their length. Only of those that may have copies digests
    are taken and first owners found; counts are summed before they are shuffled. If few payloads have
    copies, their first owners are broadcast. Otherwise only those of payloads that hold more than a
    thousandth of all rows are, of which there are fewer than a thousand, and the rest meet by a
    shuffle, in which rows that are settled by then are spread evenly.
    """
    nothing = {"first_key": F.lit(None).cast("long"), "first_row": F.lit(None).cast("long")}
    size = F.octet_length("body")
    quick = rows.select(F.xxhash64("body").alias("quick"), size.alias("bytes")).groupBy("quick", "bytes").agg(F.count("*").alias("n"))
    quick = stage(quick.filter((F.col("n") > 1) & (F.col("bytes") >= LEAST)), "quick")
    if quick.isEmpty():
        return rows.withColumns(nothing)
    likely = rows.join(quick.select("quick", "bytes"), (F.xxhash64("body") == F.col("quick")) & (size == F.col("bytes")), "left_semi")
    ledger = likely.select("key", "row", F.sha2("body", 256).alias("digest"))
    first = F.min(F.struct(F.col("key").isNull().alias("nameless"), "key", "row")).alias("first")
    owners = ledger.groupBy("digest").agg(first, F.count("*").alias("n")).filter("n > 1")
    owners = stage(owners.select("digest", "n", F.col("first.key").alias("first_key"), F.col("first.row").alias("first_row")), "owners")
    rows = rows.withColumn("digest", F.sha2("body", 256))
    if owners.count() <= limit:
        met = rows.join(F.broadcast(owners.drop("n")), "digest", "left")
    else:
        often = F.col("n") * 1000 > rows.count()
        hot = owners.filter(often).select(F.col("digest").alias("hot"), F.col("first_key").alias("hot_key"), F.col("first_row").alias("hot_row"))
        cold = owners.filter(~often).select(F.col("digest").alias("at"), "first_key", "first_row")
        met = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot"), "left")
        met = met.withColumn("at", F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("-"), F.col("row").cast("string"))))
        met = met.join(cold, "at", "left").withColumn("first_key", F.coalesce("hot_key", "first_key")).withColumn("first_row", F.coalesce("hot_row", "first_row"))
    other = F.col("first_row") != F.col("row")
    return met.select("key", "row", "url", "body", F.when(other, F.col("first_key")).alias("first_key"), F.when(other, F.col("first_row")).alias("first_row"))


def write_archives(df: DataFrame, folder: str, key: str = "page_id", body: str = "html", url: str = "url", segment: int = SEGMENT, date: str = DATE, limit: int = BROADCAST) -> str:
    """Write one response or revisit record for each row into compressed archives in ``folder``, and return it.

    The payload is ``body`` in UTF-8 (null: empty), in chunked transfer framing. A block of more than
    ``segment`` bytes goes on in continuation records. Of rows with equal payloads of ``LEAST`` bytes or
    more, that of the smallest key (null keys last) is the response and the others are revisits, which
    name it, its payload's digest and its length; smaller payloads are all responses. Rows of equal key
    and payload are records of their own. Nulls in ``key`` or ``url`` leave that field out, a table
    without the column ``url`` is written without it, other columns are not read, and an empty table
    makes no record.

    Files are closed after ``ROWS_A_FILE`` rows of about ``ROW`` bytes, so no task reads a large one. Bodies
    are not shuffled unless more than ``limit`` payloads have copies. Row numbers must come out alike when
    ``df`` is read twice, as they do for files.
    """
    target = F.col(url) if url in df.columns else F.lit(None)
    rows = df.select(F.col(key).cast("long").alias("key"), target.cast("string").alias("url"), F.coalesce(F.col(body), F.lit("")).alias("body"))
    lines = _with_firsts(rows.withColumn("row", F.monotonically_increasing_id()), limit).mapInArrow(_written(segment, date), "value string")
    lines.write.option("lineSep", END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", ROWS_A_FILE).text(folder)
    return folder


def _inflated(data: bytes) -> bytes:
    """The content of an archive: of all its gzip members, or as it is."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join([*out, data])


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive; ValueError where it is damaged."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in data[at:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        length = int(fields["content-length"])
        block = data[end + 4 : end + 4 + length]
        at = end + 4 + length
        if len(block) < length or data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record cut short at byte {at}")
        at += 4
        yield fields, block


_RECORDS = pa.schema([
    ("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("target_uri", pa.string()), ("digest", pa.string()), ("refers_to", pa.string()),
    ("refers_to_page", pa.int64()), ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()),
])
RECORDS = "record_id string, type string, page_id long, target_uri string, digest string, refers_to string, refers_to_page long, origin string, segment int, total long, block binary"


def _row(fields: dict[str, str], block: bytes) -> dict:
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "record_id": fields["warc-record-id"], "type": fields["warc-type"], "page_id": number("page-id"), "target_uri": fields.get("warc-target-uri"),
        "digest": fields.get("warc-payload-digest"), "refers_to": fields.get("warc-refers-to"), "refers_to_page": number("refers-to-page-id"),
        "origin": fields.get("warc-segment-origin-id"), "segment": number("warc-segment-number"), "total": number("warc-segment-total-length"), "block": block,
    }


def _rows(turn: Callable[[dict], dict | None], schema: pa.Schema):
    """Records of archives, each as ``turn`` makes of it, about ``ROW`` bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for fields, block in parsed(_inflated(content.as_py())):
                    if row := turn(_row(fields, block)):
                        rows.append(row)
                        size += len(block)
                    if size >= ROW:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives in ``folder``, with their blocks; a damaged archive is an error.

    A file is read whole by one task, as a compressed one can't be split.
    """
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_rows(lambda r: r, _RECORDS), RECORDS)


_PAGES = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("refers_to_record", pa.string()), ("refers_to", pa.int64()), ("damage", pa.string()),
])
PAGES = "record_id string, record_type string, page_id long, payload binary, payload_bytes long, payload_digest string, refers_to_record string, refers_to long, damage string"


def _page(r: dict, whole: bool) -> dict:
    """What a response or a revisit says of its payload, and what is wrong with it."""
    out = {"record_id": r["record_id"], "record_type": r["type"], "page_id": r["page_id"], "refers_to_record": r["refers_to"], "refers_to": r["refers_to_page"]}
    said = (r["digest"] or "").removeprefix("sha256:")
    if r["type"] == "revisit":
        length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", r["block"])
        return out | {"payload_bytes": int(length[1]) if length else None, "payload_digest": said, "damage": None if length else "revisit without a length"}
    if "segments" in r:
        blocks = [s["block"] for s in r["segments"]]
        if [s["segment"] for s in r["segments"]] != list(range(1, len(blocks) + 1)) or r["type"] is None:
            return out | {"damage": "segments are missing or repeated"}
        if r["total"] is None or sum(map(len, blocks)) != r["total"]:
            return out | {"damage": "segments do not add up to the total length"}
        r = r | {"block": b"".join(blocks)}
    try:
        payload = payload_of(r["block"])
    except ValueError as wrong:
        return out | {"damage": str(wrong)}
    digest = hashlib.sha256(payload).hexdigest()
    return out | {"payload": payload if whole else None, "payload_bytes": len(payload), "payload_digest": digest, "damage": None if said in ("", digest) else "payload differs from its digest"}


#: Pages read so far, and the pieces of those that lie in segments.
_PIECES = pa.schema([*_PAGES, *[_RECORDS.field(c) for c in ("type", "digest", "segment", "total", "block")]])
PIECES = f"{PAGES}, type string, digest string, segment int, total long, block binary"


def _piece(whole: bool):
    def turn(r: dict) -> dict | None:
        if r["segment"] is not None:
            return {c: r[c] for c in ("page_id", "type", "digest", "segment", "total", "block")} | {"record_id": r["origin"] or r["record_id"]}
        return _page(r, whole) if r["type"] in ("response", "revisit") else None

    return turn


def _joined(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                rows = batch.slice(at, TOGETHER).to_pylist()
                yield pa.RecordBatch.from_pylist([_page(r | (r["head"] or {"type": None, "page_id": None, "digest": None}) | {"refers_to": None, "refers_to_page": None}, whole) for r in rows], _PAGES)

    return run


def read_pages(spark: SparkSession, folder: str, whole: bool = True, strict: bool = True) -> DataFrame:
    """One row for each response or revisit: record_id, record_type, page_id, payload, payload_bytes, payload_digest, refers_to_record, refers_to, damage.

    The segments of a response are grouped by the record they continue, put in order of their numbers and
    checked against the total length; a group is one page's. Blocks lose their headers and chunked
    framing; digests are taken of what is left and held against those of the records. A revisit has no
    payload of its own: its length and digest are those that it states of the record it refers to.
    ``damage`` says what is wrong with a record, null for nothing; with ``strict`` any damage, or a revisit
    whose response is missing or differs, is an error. Without ``whole``, ``payload`` is null. An empty
    folder gives no rows.
    """
    content = spark.read.format("binaryFile").load(folder).select("content")
    pieces = stage(content.mapInArrow(_rows(_piece(whole), _PIECES), PIECES), "pieces")
    head = F.max_by(F.struct("type", "page_id", "digest"), F.when(F.col("segment") == 1, 1)).alias("head")
    parts = F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("segments")
    groups = pieces.filter("segment is not null").groupBy("record_id").agg(head, parts, F.max("total").alias("total"))
    pages = pieces.filter("segment is null").select(*_PAGES.names).unionByName(groups.mapInArrow(_joined(whole), PAGES))
    if not strict:
        return pages
    pages = stage(pages, "pages")
    known = pages.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), "payload_bytes", "payload_digest")
    stated = pages.filter("record_type = 'revisit'").select("refers_to_record", "payload_bytes", "payload_digest").distinct()
    wrong = pages.filter("damage is not null").select("record_id", "damage")
    wrong = wrong.unionByName(stated.join(known, known.columns, "left_anti").select(F.col("refers_to_record").alias("record_id"), F.lit("is referred to, but missing or not equal").alias("damage")))
    if found := wrong.limit(3).collect():
        raise ValueError(f"damaged archives in {folder}: {[tuple(r) for r in found]}")
    return pages
