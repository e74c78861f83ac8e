"""WARC archives written index first, read back by coalesced byte ranges.

Writing: each task appends the records of its rows to archives of about
``ARCHIVE_BYTES`` in a shared folder, every record a gzip member of its own
(``.warc.gz`` as crawlers write it), and returns one index row a record: file,
offset, length, record id, page id, url, digest, type. The index is a Parquet
table. File names are drawn per attempt and Spark commits the index rows of
one attempt only, so the index decides which files count: an attempt that is
lost or doubled leaves a file that no index row names.

Payloads that occur more than once: of the records with equal payloads of at
least ``MIN_REVISIT`` bytes the one with the largest page id is the
``response``; the others are ``revisit`` records (profile
identical-payload-digest) that hold the HTTP header and refer to it. The
choice is one aggregate over digests with map-side combine, and only digests
that repeat are joined back, so a very common payload is split by the skew
join and never gathered.

Reading: the index rows that are asked for (any filter of the index) are
range-partitioned by (file, offset) and sorted; ranges that lie closer than
``MAX_GAP`` are read together up to ``MAX_SPAN`` bytes, cut into records and
unpacked. A response's digest is computed again from its payload, and a
mismatch is an error.

Archives are opened through ``pyarrow.fs``: local or mounted shared folders,
``hdfs:`` and ``s3:`` / ``s3a:`` paths.

Defined cases: a null html is an empty payload; a null url gives a record
without a target; line breaks and other control bytes of a url are
percent-encoded in the record and kept in the index; a null page_id sorts
below every other (a revisit of such a response refers to null); of equal
page ids any one row is the response and the others revisit it; repeated rows
are records of their own; an empty table gives an empty index; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecraft.llm.common import ship, table
from ratecraft.session import materialize, scratch_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
MAX_GAP = 64 << 10
MAX_SPAN = 8 << 20
LEVEL = 1                                   # of gzip
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
INDEX = "file string, offset long, length long, record_id string, page_id long, url string, digest string, record_type string, refers_to string"
_RECORD = ("file string, offset long, record_id string, page_id long, url string, record_type string, refers_to long, "
           "refers_to_record string, payload_bytes long, payload_digest string, payload binary")


def filesystem(folder: str):
    """(pyarrow file system, path in it) of a folder that Spark names."""
    from pyarrow import fs
    parts = urlsplit(folder)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parts.path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", folder))


def member(head: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return gz.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + gz.flush()


def parse_member(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record header, HTTP header, payload) of one gzip member."""
    raw = zlib.decompress(data, 31)
    at = raw.index(b"\r\n\r\n")
    version, *lines = raw[:at].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines)
    block = raw[at + 4:at + 4 + int(head["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return head, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:] if ": " in line), payload


def record_id(row: int, run: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(run), str(row))}>"


def _page_record(row: dict, run: str, date: str) -> tuple[bytes, str, str, str | None]:
    """(member, record id, type, id of the record that it refers to) of one page."""
    payload, own = row["payload"] or b"", record_id(row["row"], run)
    revisit = row["top_row"] is not None and row["top_row"] != row["row"]
    kind = "revisit" if revisit else "response"
    to = record_id(row["top_row"], run) if revisit else None
    head = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Date", date)]
    if row["url"] is not None:
        head.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", row["url"])))
    if row["page_id"] is not None:
        head.append(("Page-ID", str(row["page_id"])))
    head.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", to)]
        if row["top_page"] is not None:
            head.append(("Refers-To-Page-ID", str(row["top_page"])))
    head.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    return member(head, http if revisit else http + payload), own, kind, to


def _write_archives(folder: str, run_id: str, date: str, archive_bytes: int):
    def run(batches):
        files, base = filesystem(folder)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                rows = []
                for row in _rows_of(batch):
                    if out is None:
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                        info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                       ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    data, own, kind, to = _page_record(row, run_id, date)
                    out.write(data)
                    rows.append((name, at, len(data), own, row["page_id"], row["url"], row["digest"], kind, to))
                    at += len(data)
                    if at >= archive_bytes:
                        out.close()
                        out = None
                yield _as_batch(rows, _INDEX_TYPES)
            if out is not None:
                out.close()
                out = None
        finally:
            if out is not None:
                out.close()
    return run


_INDEX_TYPES = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()),
                          ("url", pa.string()), ("digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])
_RECORD_TYPES = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                           ("record_type", pa.string()), ("refers_to", pa.int64()), ("refers_to_record", pa.string()),
                           ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _rows_of(batch):
    """Rows of a batch as dicts, one at a time (a batch may hold long payloads)."""
    for i in range(batch.num_rows):
        yield {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def write_warc(pages: DataFrame, folder: str | None = None, date: str = DATE, min_revisit: int = MIN_REVISIT,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives in ``folder`` and return their index (a written table)."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
                        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
                        F.monotonically_increasing_id().alias("row"))
    base = materialize(base, "warc-pages")          # fixes the row numbers; hashes every payload once
    top = (base.filter(F.col("bytes") >= min_revisit).groupBy("digest", "bytes")
           .agg(F.max(F.struct("page_id", "row")).alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    top = materialize(top.select("digest", "bytes", F.col("top.page_id").alias("top_page"), F.col("top.row").alias("top_row")), "warc-repeats")
    rows = base.join(top, ["digest", "bytes"], "left")
    index = rows.select("page_id", "url", "payload", "digest", "bytes", "row", "top_page", "top_row").mapInArrow(
        _write_archives(folder, str(uuid.uuid4()), date, archive_bytes), INDEX)
    return materialize(index.withColumn("file", F.concat(F.lit(folder.rstrip("/") + "/"), "file")), "warc-index")


def spans(ranges, max_gap: int = MAX_GAP, max_span: int = MAX_SPAN):
    """Coalesce sorted (file, offset, length): (file, start, end, [(offset, length)]), each at most ``max_span`` unless one record is longer."""
    file, start, end, parts = None, 0, 0, []
    for f, offset, length in ranges:
        if parts and (f != file or offset - end > max_gap or offset + length - start > max_span):
            yield file, start, end, parts
            parts = []
        if not parts:
            file, start, end = f, offset, offset
        parts.append((offset, length))
        end = max(end, offset + length)
    if parts:
        yield file, start, end, parts


def _read_ranges(max_gap: int, max_span: int, with_payload: bool):
    def run(batches):
        asked = ((f, o, n) for b in batches for f, o, n in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length"))))
        name, source, rows = None, None, []
        for file, start, end, parts in spans(asked, max_gap, max_span):
            if file != name:
                if source is not None:
                    source.close()
                files, path = filesystem(file)
                name, source = file, files.open_input_file(path)
            data = source.read_at(end - start, start)
            for offset, length in parts:
                head, http, payload = parse_member(data[offset - start:offset - start + length])
                digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                response = head["WARC-Type"] == "response"
                if response and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {head['WARC-Record-ID']} in {file} does not have its digest")
                number = lambda k: int(head[k]) if k in head else None  # noqa: E731,B023
                rows.append((file, offset, head["WARC-Record-ID"], number("Page-ID"), head.get("WARC-Target-URI"), head["WARC-Type"],
                             number("Refers-To-Page-ID"), head.get("WARC-Refers-To"), len(payload) if response else int(http["Content-Length"]),
                             digest, payload if with_payload and response else None))
            if with_payload or len(rows) >= 10_000:
                yield _as_batch(rows, _RECORD_TYPES)
                rows = []
        if source is not None:
            source.close()
        if rows:
            yield _as_batch(rows, _RECORD_TYPES)
    return run


def read_records(index: DataFrame, with_payload: bool = True, max_gap: int = MAX_GAP, max_span: int = MAX_SPAN) -> DataFrame:
    """The records of ``index`` (any selection of an index's rows), read from the archives.

    file, offset, record_id, page_id, url, record_type, refers_to (page id),
    refers_to_record, payload_bytes, payload_digest, payload (null in a revisit).
    """
    spark = index.sparkSession
    ship(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    return asked.mapInArrow(_read_ranges(max_gap, max_span, with_payload), _RECORD)


def payloads(index: DataFrame, selected: DataFrame) -> DataFrame:
    """record_id, page_id, url, payload of the index rows ``selected``; a revisit gets the payload of the record it refers to."""
    wanted = selected.select("record_id", "page_id", "url", F.coalesce("refers_to", "record_id").alias("source"))
    sources = index.join(wanted.select(F.col("source").alias("record_id")).distinct(), "record_id", "left_semi")
    found = read_records(sources).select(F.col("record_id").alias("source"), "payload")
    return wanted.join(found, "source", "left").drop("source")


def op11_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read_records(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
