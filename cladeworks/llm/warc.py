"""WARC archives: one gzip member per record, read back sequentially.

The reader never holds more than one record: it inflates a member piece by
piece, frames the block by Content-Length, checks that the member ends where the
record does, and compares the payload digest as the bytes go by.

Defined results: null html is an empty payload; a null identifier is written as
a record without ``X-Page-Id`` and comes back null (it refers others only if no
identifier is known); repeated rows become records of their own; control and
non-ASCII characters of a url are percent-encoded in the header; a damaged or cut
member gives one row with ``error`` and ends its file; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, table, written
from .files import streaming, writing

PIECE = 1 << 16
FILE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORD = "page_id long, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to long, verified boolean, error string, path string, offset long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The bytes of one record before compression. A revisit keeps the full payload's digest and length but not its bytes."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 3) -> bytes:
    z = zlib.compressobj(level, wbits=31)
    return z.compress(data) + z.flush()


def _pieces(stream, size: int):
    """Yields (offset, iterator of inflated pieces) for each gzip member of a stream."""
    state = {"data": b"", "at": 0, "read": 0}

    def more() -> bool:
        state["data"] = bytes(stream.read(size))
        state["read"] += len(state["data"])
        return bool(state["data"])

    def inflate():
        z = zlib.decompressobj(wbits=31)
        while not z.eof:
            if not state["data"] and not more():
                raise EOFError("the member is cut off")
            yield z.decompress(state["data"], size)
            state["data"] = z.unused_data if z.eof else z.unconsumed_tail

    while state["data"] or more():
        pieces = inflate()
        yield state["read"] - len(state["data"]), pieces
        for _ in pieces:  # what the caller did not read
            pass


def _parse(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC version line")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def read_record(pieces, keep_payload: bool = False) -> dict:
    """Frames one record out of its inflated pieces and checks its digests."""
    data = bytearray()
    while (end := data.find(b"\r\n\r\n")) < 0:
        data += next(pieces)
    head = _parse(bytes(data[:end]))
    length, whole, body = int(head["content-length"]), hashlib.sha1(), hashlib.sha1()
    del data[: end + 4]
    left, http, in_body, n, kept = length, bytearray(), False, 0, bytearray()
    while True:
        part = bytes(data[:left])
        del data[:left]
        left -= len(part)
        whole.update(part)
        if not in_body:
            http += part
            if (at := http.find(b"\r\n\r\n")) >= 0:
                in_body, part = True, bytes(http[at + 4 :])
            else:
                part = b""
        if part:
            body.update(part)
            n += len(part)
            if keep_payload:
                kept += part
        if not left:
            break
        data += next(pieces)
    for piece in pieces:
        data += piece
        if len(data) > 4:
            break
    if bytes(data) != b"\r\n\r\n":
        raise ValueError("the member does not end with its record")
    b32 = lambda h: "sha1:" + base64.b32encode(h.digest()).decode()
    revisit = head["warc-type"] == "revisit"
    good = b32(whole) == head["warc-block-digest"] and (revisit or b32(body) == head["warc-payload-digest"])
    page = lambda x: int(x[len("<urn:page:") : -1]) if x else None
    return {
        "page_id": int(head["x-page-id"]) if "x-page-id" in head else None, "record_type": head["warc-type"], "target_uri": head.get("warc-target-uri"), "payload_bytes": int(head["x-payload-length"]) if revisit else n,
        "payload_digest": head["warc-payload-digest"].removeprefix("sha1:"), "refers_to": page(head.get("warc-refers-to")), "verified": good, "error": None,
    } | ({"payload": bytes(kept)} if keep_payload else {})


def records(stream, size: int = PIECE, keep_payload: bool = False):
    """Yields a dict per record of an archive; a damaged record is yielded with ``error`` and ends the archive."""
    at = 0
    try:
        for at, pieces in _pieces(stream, size):
            yield read_record(pieces, keep_payload) | {"offset": at}
    except (EOFError, ValueError, KeyError, StopIteration, RuntimeError, zlib.error, UnicodeDecodeError) as e:
        yield dict.fromkeys(("page_id", "record_type", "target_uri", "payload_bytes", "payload_digest", "refers_to")) | {"verified": False, "error": str(e)[:200] or type(e).__name__, "offset": at}


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes columns page_id, url, html, refers_to as archives; one row (path, n) per file."""
    import pyarrow as pa

    def write(batches):
        from pyspark import TaskContext

        name, rows = f"part-{TaskContext.get().partitionId():05d}.warc.gz", iter(r for b in batches for r in zip(*(b.column(k).to_pylist() for k in ("page_id", "url", "html", "refers_to")), strict=True))
        row = next(rows, None)
        while row is not None:
            with writing(folder, name) as (uri, out):
                n = size = 0
                while row is not None and size < FILE_BYTES:
                    page_id, url, html, refers_to = row
                    data = member(record(page_id, url, (html or "").encode(), refers_to))
                    out.write(data)
                    n, size, row = n + 1, size + len(data), next(rows, None)
            yield pa.RecordBatch.from_pydict({"path": [uri], "n": [n]}, schema=pa.schema([("path", pa.string()), ("n", pa.int64())]))

    return pages.select("page_id", "url", "html", "refers_to").mapInArrow(write, "path string, n long")


def read_archives(paths: DataFrame) -> DataFrame:
    """One row per record of the archives named in column ``path``."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def read(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                rows = []
                with streaming(path) as stream:
                    for r in records(stream):
                        rows.append(r | {"path": path})
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return paths.select("path").mapInArrow(read, RECORD)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to: the smallest identifier of an equal payload for all others (null for that one itself)."""
    pages = pages.select("page_id", "url", "html", F.sha2(F.coalesce(F.col("html"), F.lit("")), 256).alias("_d"))
    first = pages.groupBy("_d").agg(F.min("page_id").alias("_first"))
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("_first")), F.col("_first"))
    return pages.join(first, "_d").select("page_id", "url", "html", refers.alias("refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes all pages, reads all archives; columns of :data:`RECORD`."""
    spark = pages.sparkSession
    made = written(write_archives(with_revisits(pages), shared_dir(spark, "warc")), "warc-files")
    return read_archives(made.repartition(max(1, made.count())))


def op5_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    """Every page as a record, as read back from the archives."""
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b, sha1(encode(coalesce(html, ''))) as h from pages),
f as (select *, min(page_id) over (partition by h) as first from p)
select page_id, octet_length(b)::bigint as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, (i // 8) * 10 + 1, 10))::bigint >> (35 - 5 * (i % 8))) & 31)::int, 1)), '') as payload_digest,
       case when first is not null and (page_id is null or page_id > first) then 'revisit' else 'response' end as record_type,
       case when page_id is null or page_id > first then first end as refers_to, true as verified
from f
"""
