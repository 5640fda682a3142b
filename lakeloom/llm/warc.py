"""WARC archives of pages with resolved revisits.

1. Headers: (row, page id, URL, payload digest, payload bytes) of every page; payloads stay where they are.
2. Revisit resolution: headers are shuffled by payload digest and reduced (per salt, then per digest) to the first
   record of each digest; the other records of the digest are joined to it and become its revisits.
3. Archives: every page meets its decision by its place in the input, and each task writes its records under fresh
   headers, payloads of revisits left out, one gzip member per record, in images of about ``IMAGE_BYTES``.
4. Reading back: members are parsed by their length, payload digests are computed again and compared, and revisit
   records are joined to the responses they refer to by record id, which gives them the payload's size.

The archives are rows of a Parquet table (``archive``, ``n_records``, ``image``) in the shared folder, so Spark's
committer makes them whole on any store and a lost task leaves nothing; each image is a file in the WARC 1.1 format.
Many copies of one payload never meet in one task: what is shuffled by digest is reduced first, and look-ups are salted.

Defined results: null html is an empty payload.  Payloads under ``least`` bytes are never revisits.  Of equal payloads
the record with the smallest page id is the response, null ids last; of equal ids exactly one is.  A null URL gives a
record without target URI; control characters and blanks in a URL are percent-encoded in its header.  Rows may repeat.
Other columns are not read.  An empty table gives no archive.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_limits, placed, salted_lookup, stored

LEAST_BYTES = 100
#: Compressed bytes after which an image is closed.
IMAGE_BYTES = 16 << 20
SALTS = 64
#: Fixed value: the profile of revisits that have the same payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_UNSAFE = re.compile(rb"[\x00-\x20\x7f]")
RECORDS = ("archive string, record_id string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
           "refers_id string")


def headers(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", row_col: str = "warc_row") -> DataFrame:
    """(row, page_id, url, digest, bytes) of ``placed`` pages."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    return pages.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"))


def resolve(heads: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(row, to_row, to_url): the revisits among ``heads`` and the original each refers to."""
    heads = heads.where(F.col("bytes") >= least).select(
        "row", "digest", F.struct(F.col("page_id").isNull().alias("no"), "page_id", "row", "url").alias("head"),
        F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"))
    heads = stored(heads, "warc-headers")
    by_salt = heads.groupBy("digest", "salt").agg(F.min("head").alias("first"), F.count("*").alias("n"))
    originals = by_salt.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    wanted = by_salt.select("digest", "salt").join(originals, "digest")
    return heads.join(wanted, ["digest", "salt"]).where(F.col("row") != F.col("first.row")).select(
        "row", F.col("first.row").alias("to_row"), F.col("first.url").alias("to_url"))


def record_id(row: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=bytes(row))}>"


def _record(fields: list[tuple[str, str | bytes | None]], block: bytes) -> bytes:
    lines = [b"WARC/1.1"]
    for name, value in [*fields, ("Content-Length", str(len(block)))]:
        if value is not None:
            lines.append(name.encode() + b": " + (value.encode() if isinstance(value, str) else value))
    return b"\r\n".join([*lines, b"", block, b"", b""])


def _uri(url: str | None) -> bytes | None:
    return None if url is None else _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], url.encode())


def page_record(row: bytes, page_id: int | None, url: str | None, html: str | None, digest: str, n_bytes: int,
                to_row: bytes | None, to_url: str | None, date: str) -> bytes:
    """The bytes of a page's record, uncompressed; a revisit has the HTTP headers only."""
    fields = [("WARC-Type", "response" if to_row is None else "revisit"), ("WARC-Record-ID", record_id(row)), ("WARC-Date", date),
              ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if to_row is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(to_row)), ("WARC-Refers-To-Target-URI", _uri(to_url))]
    fields += [("Page-ID", None if page_id is None else str(page_id)), ("Content-Type", "application/http; msgtype=response")]
    return _record(fields, _HTTP % n_bytes + (b"" if to_row is not None else (html or "").encode()))


def _member(record: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(record) + pack.flush()


def write_archives(pages: DataFrame, revisits: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   row_col: str = "warc_row", date: str | None = None, image_bytes: int = IMAGE_BYTES) -> DataFrame:
    """(archive, n_records, image), stored: all ``placed`` pages, those in ``revisits`` without their payload."""
    arrow_limits(pages.sparkSession)
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    slim = pages.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    marked = slim.join(revisits, "row", "left").select(
        "row", "page_id", "url", F.when(F.col("to_row").isNull(), F.col("html")).alias("html"),
        F.sha2(F.col("html").cast("binary"), 256).alias("digest"), F.octet_length("html").alias("bytes"), "to_row", "to_url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size, count = TaskContext.get().partitionId(), 0, [], 0, 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([held_name]), pa.array([count]), pa.array([b"".join(held)], pa.binary())],
                                              ["archive", "n_records", "image"])

        for b in batches:
            for values in zip(*(b.column(i).to_pylist() for i in range(b.num_columns)), strict=True):
                if not held:
                    held_name = f"{task:06d}-{number:05d}.warc.gz"
                    about = f"software: lakeloom\r\nformat: WARC File Format 1.1\r\nfilename: {held_name}\r\n".encode()
                    held.append(_member(_record([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, held_name + date)}>"),
                        ("WARC-Date", date), ("WARC-Filename", held_name), ("Content-Type", "application/warc-fields")], about)))
                held.append(_member(page_record(*values, date)))
                size, count = size + len(held[-1]), count + 1
                if size >= image_bytes:
                    yield closed()
                    number, held, size, count = number + 1, [], 0, 0
        if held:
            yield closed()

    return stored(marked.mapInArrow(write, "archive string, n_records long, image binary"), "warc-archives")


def records(image: bytes) -> Iterator[tuple[dict[str, bytes], bytes]]:
    """(headers by lower-case name, block) of every record of an image; ``ValueError`` if one is damaged."""
    with gzip.GzipFile(fileobj=io.BytesIO(image)) as data:
        while version := data.readline():
            if not version.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            fields = {}
            while (line := data.readline()) not in (b"\r\n", b""):
                name, _, value = line.partition(b":")
                fields[name.decode().lower()] = value.strip()
            block = data.read(int(fields["content-length"]))
            if len(block) != int(fields["content-length"]) or data.read(4) != b"\r\n\r\n":
                raise ValueError("a WARC record is cut off")
            yield fields, block


def read_archives(archives: DataFrame) -> DataFrame:
    """RECORDS: every page record of the archives.  Payloads of responses are checked against their digest, and
    their size is counted; a revisit's is null."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORDS.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
        for b in batches:
            for i in range(b.num_rows):
                out = []
                for fields, block in records(b.column("image")[i].as_py()):
                    kind = fields["warc-type"].decode()
                    if kind == "warcinfo":
                        continue
                    digest, size = fields["warc-payload-digest"].decode().partition(":")[2], None
                    if kind == "response":
                        payload = block[block.index(b"\r\n\r\n") + 4:]
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError("a payload does not have its digest")
                    page, url, to = (fields.get(k) for k in ("page-id", "warc-target-uri", "warc-refers-to"))
                    out.append((b.column("archive")[i].as_py(), fields["warc-record-id"].decode(), None if page is None else int(page),
                                None if url is None else url.decode(), kind, size, digest, None if to is None else to.decode()))
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)], names)
                        out = []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)], names)

    # an image per batch: a worker holds one at a time
    arrow_limits(archives.sparkSession)
    return archives.select("archive", "image").mapInArrow(read, RECORDS)


def resolved(found: DataFrame) -> DataFrame:
    """``found`` (RECORDS, stored) with the payload's size of every record, and of revisits the original's page id as ``refers_to``."""
    originals = found.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_id"), F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest"),
        F.col("page_id").alias("refers_to"))
    revisits = salted_lookup(found.where("record_type = 'revisit'"), originals, ["refers_id"], ["record_id"])
    whole = F.col("payload_digest") == F.col("full_digest")
    revisits = revisits.withColumn("payload_bytes", F.when(whole, F.col("full_bytes")).otherwise(
        F.raise_error(F.lit("a revisit refers to no response with its digest")).cast("long")))
    columns = [c for c in found.columns if c != "refers_id"]
    return revisits.select(*columns, "refers_to").union(
        found.where("record_type = 'response'").select(*columns, F.lit(None).cast("long")))


def warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Write the archives of all pages and read them back: (archive, record_id, page_id, url, record_type, payload_bytes,
    payload_digest, refers_to), one row per page."""
    pages = placed(pages, "warc_row")
    revisits = resolve(headers(pages, id_col, url_col, html_col), least)
    archives = write_archives(pages, revisits, id_col, url_col, html_col)
    return resolved(stored(read_archives(archives), "warc-records"))
