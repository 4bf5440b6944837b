"""WARC archives: write captures, read them back, and assemble transactions.

A capture is written as three records: the response (or a revisit of an equal payload), the
request and the metadata; the last two name the first as concurrent to them. Records are
text lines ended by the empty line that ends a WARC record, so that Spark's own writer and
reader carry them to and from any file system, gzip-compressed and streamed. Reading parts files
at the version mark and takes bytes as they are; a record whose payload holds that mark is put
together again by its declared length, and damaged records are set apart. Assembling joins the records through those identifiers into one nested row per capture; payloads
cross that join only if they are asked for.
"""

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textweft.llm.common import slices
from textweft.lookup import lookup_join
from textweft.scratch import materialize

VERSION = "WARC/1.1"
END = "\r\n\r\n"
SEPARATOR = f"{END}{VERSION}\r\n"
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(column: Column) -> Column:
    """Upper-case base 32 of the SHA-1, eight digits from every ten of the hex form."""
    hexed = F.sha1(column)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.upper(F.concat(*parts)), _HEX32, _BASE32)


def _header(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; a line with a null value is left out, line breaks in values are escaped."""
    lines = []
    for name, value in pairs:
        column = F.lit(value) if isinstance(value, str) else value.cast("string")
        safe = F.replace(F.replace(column, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit("")))
    return F.concat(*lines)


def _record(kind: Column | str, id: Column, block: Column, *pairs: tuple[str, Column | str]) -> Column:
    head = _header(("WARC-Type", kind), ("WARC-Record-ID", id), ("WARC-Date", DATE), *pairs)
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return F.concat(F.lit(f"{VERSION}\r\n"), head, length, block)


def _urn(id: Column, part: str) -> Column:
    return F.concat(F.lit("<urn:uuid:"), id, F.lit(f"{part}>"))


def mark_revisits(pages: DataFrame, id: str = "page_id", payload: str = "html", least: int = 0) -> DataFrame:
    """Add ``_digest`` and ``_first``, the id a revisit refers to (null for a response).

    Of rows with equal payloads of at least ``least`` bytes the one with the largest id is
    the response. All rows with that id, and all rows of a payload without any id, are
    responses. Only digests and ids are shuffled while the table of repeated payloads,
    measured first, fits a broadcast; beyond that rows are, but for those of hot payloads, such as
    the empty one, which never meet in one task.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    digests = pages.select(F.col(id).alias("_id"), F.octet_length(body).alias("_size"), sha1_base32(body).alias("_digest"))
    repeated = digests.filter(F.col("_size") >= least).groupBy("_digest")
    repeated = repeated.agg(F.count(F.lit(1)).alias("n"), F.max("_id").alias("_last")).filter("n > 1")
    repeated = materialize(repeated, "repeated-payloads")
    marked = pages.withColumn("_digest", sha1_base32(body))
    joined = lookup_join(marked, repeated, "_digest", "left", weight="n").drop("n")
    other = F.col(id).isNull() | (F.col(id) != F.col("_last"))
    return joined.withColumn("_first", F.when(other, F.col("_last"))).drop("_last")


def write_archives(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0
) -> None:
    """Write three records per row to gzip-compressed files below ``path``.

    A null payload is an empty one, a null url or id leaves its line out. Repeated rows are
    captures of their own. Other columns are not read.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("body"))
    rows = mark_revisits(rows, "id", "body", least).withColumn("uuid", F.expr("substring(uuid(), 1, 35)"))
    main, target = _urn(F.col("uuid"), "0"), ("WARC-Target-URI", F.col("url"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("body").cast("string"),
        F.lit(END),
    )
    first = F.col("_first")
    response = _record(
        F.when(first.isNull(), "response").otherwise("revisit"),
        main,
        F.when(first.isNull(), F.concat(http, F.col("body"))).otherwise(http),
        target,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        ("WARC-Profile", F.when(first.isNotNull(), PROFILE)),
        ("Content-Type", "application/http;msgtype=response"),
    )
    asked = F.concat(F.lit("GET "), F.coalesce(F.replace(F.replace("url", F.lit("\r"), F.lit("")), F.lit("\n"), F.lit("")), F.lit("*")), F.lit(f" HTTP/1.1{END}"))
    request = _record(
        "request",
        _urn(F.col("uuid"), "1"),
        asked,
        target,
        ("WARC-Concurrent-To", main),
        ("Content-Type", "application/http;msgtype=request"),
    )
    fields = _header(("page-id", F.col("id")), ("refers-to-page", first))
    metadata = _record(
        "metadata",
        _urn(F.col("uuid"), "2"),
        fields,
        target,
        ("WARC-Concurrent-To", main),
        ("Content-Type", "application/warc-fields"),
    )
    lines = rows.select(F.explode(F.array(response, request, metadata)).alias("value"))
    lines.write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD = (
    "record_id string, type string, concurrent_to string, target_uri string, date string, digest string, "
    "content_type string, fields map<string,string>, payload_bytes long, payload_digest string, damage string"
)
_CUT = "WARC/1."  # what parts a file into pieces; a record's minor version and line end follow
MOST_BYTES = 1 << 30  # a record that claims more is damaged


def _lines(head: str) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.replace("\r\n", "\n").split("\n"))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


class Record:
    """A record whose header was read; ``block`` may still be short of what the header says."""

    def __init__(self, piece: bytes):
        self.piece = piece
        head, gap, self.block = piece.partition(END.encode())
        start, _, lines = head.partition(b"\n")
        self.header = _lines(lines.decode("utf-8", "replace"))
        length = self.header.get("content-length", "")
        self.damage = None
        self.need = int(length) if length.isascii() and length.isdigit() and len(length) < 19 else -1
        if not gap or not start.strip().isdigit():
            self.damage = "no header"
        elif self.need < 0:
            self.damage = "no length"
        elif self.need > MOST_BYTES:
            self.damage = "length beyond what is read"

    def settled(self) -> bool:
        return self.damage is not None or len(self.block) >= self.need

    def aligned(self) -> bool:
        """Whether the block ends where its record does: nothing but line ends follow."""
        return not self.block[self.need :].strip(b"\r\n")


def _complete(pieces: Iterator[tuple[str, bytes]]) -> Iterator[Record]:
    """Whole records from the pieces ``(file, bytes)`` that the version mark parts files into.

    A piece that belongs to a payload is put back by the length its record states. A record that
    is cut short, or states a wrong length, is handed on as damaged, and what was taken for its
    payload is read again as records of their own.
    """
    waiting: list[tuple[str, bytes]] = []
    source = iter(pieces)

    def pull() -> tuple[str, bytes] | None:
        return waiting.pop() if waiting else next(source, None)

    while (piece := pull()) is not None:
        file, data = piece
        if not data.strip():
            continue  # before the first record of a file
        record = Record(data)
        taken, parts, size = [], [record.block], len(record.block)
        while record.damage is None and size < record.need:
            more = pull()
            if more is None or more[0] != file:
                if more is not None:
                    waiting.append(more)
                break
            taken.append(more)
            parts.append(_CUT.encode() + more[1])
            size += len(_CUT) + len(more[1])
        record.block = b"".join(parts)
        if record.damage is None and (size < record.need or not record.aligned()):
            record.damage = "cut short" if size < record.need or taken else "wrong length"
            record.block = parts[0]
            waiting += taken[::-1]
        elif record.damage is None:
            record.block = record.block[: record.need]
        yield record


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the files below ``path``; ``payload``, its bytes, only if asked for.

    Any WARC version 1 is read, bytes of any encoding, files compressed as a whole or record by record.
    ``payload_bytes`` and ``payload_digest`` are taken from the block itself, ``digest`` from the
    header. ``damage`` is null for a sound record and else says what is wrong: no header, no
    length, a length that does not end where the record does, or a record cut short; what
    follows a damaged record is read on. Files are read as a stream of records; an empty folder
    gives no rows.
    """
    schema = RECORD + (", payload binary" if payloads else "")
    names = [field.split()[0] for field in RECORD.split(", ")] + (["payload"] if payloads else [])

    def parse(record: Record) -> tuple:
        header, block = record.header, record.block
        kind = header.get("warc-type", "")
        payload = block.partition(END.encode())[2] if "application/http" in header.get("content-type", "") else block
        fields = _lines(block.decode("utf-8", "replace")) if header.get("content-type") == "application/warc-fields" else {}
        row = (
            header.get("warc-record-id"),
            kind,
            header.get("warc-concurrent-to"),
            header.get("warc-target-uri"),
            header.get("warc-date"),
            header.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            header.get("content-type"),
            list(fields.items()),
            len(payload),
            base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            record.damage,
        )
        return (*row, payload) if payloads else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (part for batch in batches for part in slices(batch, ["value"]))
        pieces = (row for part in parts for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist()))
        rows, size = [], 0
        for record in _complete(pieces):
            rows.append(parse(record))
            size += len(record.block)
            if size > 8 << 20 or len(rows) >= 5000:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
                rows, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    text = pa.string()
    types = [text, text, text, text, text, text, text, pa.map_(text, text), pa.int64(), text, text]
    types += [pa.binary()] if payloads else []
    pieces = spark.read.option("lineSep", _CUT).text(path)
    return pieces.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One row per response or revisit, with its ``request`` and ``metadata`` as nested rows.

    Records are joined through the identifiers they are concurrent to; a metadata record may
    also name the request. Of several such records the one with the least id is taken, a
    missing one is null, and records that belong to no capture are left out.
    """
    small = [c for c in records.columns if c not in ("payload",)]
    captures = records.filter(F.col("type").isin("response", "revisit"))
    requests = records.filter("type = 'request' AND concurrent_to IS NOT NULL").select(*small)
    extra = records.filter("type = 'metadata' AND concurrent_to IS NOT NULL").select(*small)
    hop = requests.groupBy(F.col("record_id").alias("_hop")).agg(F.min("concurrent_to").alias("_to"))
    extra = extra.join(hop, F.col("concurrent_to") == F.col("_hop"), "left")
    extra = extra.groupBy(F.coalesce("_to", "concurrent_to").alias("record_id")).agg(F.min_by(F.struct(*small), "record_id").alias("metadata"))
    asked = requests.groupBy(F.col("concurrent_to").alias("_to")).agg(F.min_by(F.struct(*small), "record_id").alias("request"))
    asked = asked.withColumnRenamed("_to", "record_id")
    response = captures.select("record_id", F.struct(*captures.columns).alias("response"))
    return response.join(asked, "record_id", "left").join(extra, "record_id", "left")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Rows ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of assembled captures.

    A revisit has no payload of its own: its length and its reference come from the response
    with the same digest and the largest id; both are null where there is none. Captures without
    a page id in their metadata have a null ``page_id``; repeated captures stay repeated, and no captures
    give no rows.
    """
    page = F.col("metadata.fields")["page-id"].cast("long")
    rows = captures.select(
        page.alias("page_id"),
        F.col("response.type").alias("record_type"),
        F.col("response.payload_bytes").alias("own_bytes"),
        F.when(F.col("response.type") == "response", F.col("response.payload_digest")).otherwise(F.col("response.digest")).alias("payload_digest"),
    )
    first = rows.filter("record_type = 'response'").groupBy("payload_digest")
    first = first.agg(F.max("page_id").alias("refers_to"), F.max("own_bytes").alias("full_bytes"))
    revisits = rows.filter("record_type = 'revisit'")
    times = revisits.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"))
    first = materialize(first.join(times, "payload_digest"), "responded")
    revisits = lookup_join(revisits, first, "payload_digest", "left", weight="n")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = rows.filter("record_type = 'response'").withColumns({"payload_bytes": F.col("own_bytes"), "refers_to": F.lit(None).cast("long")})
    return responses.select(*columns).unionByName(revisits.withColumn("payload_bytes", F.col("full_bytes")).select(*columns))
