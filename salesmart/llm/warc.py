"""WARC writing and sequential reading (operator 7).

``write`` puts one record per page, each a gzip member of its own, into one
archive per task.  Of pages with equal payloads of at least ``least`` bytes,
the one with the largest id is the response; the others are revisit records
that name it.  ``read`` goes through an archive once: incremental zlib
decompression of each member, header block, content-length framing, and the
payload digest checked against the payload.

Scale: digests are aggregated first (partial, then by digest), and only those
with several pages are joined back, from a staged table: while it fits a
broadcast no html is moved, beyond that each page moves once and Spark can
split the partition of a payload that a third of all pages share.
A reader holds one record and one buffer, however long the archive.

Edge cases: null html is an empty payload; a null url gives a record without
target URI; null ids rank below all others; pages that repeat both id and html
are all responses.  Empty tables give no archive.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SharedFile, column, open_folder, shared_folder, ship, stage

DATE = "1970-01-01T00:00:00Z"
CHUNK = 1 << 16


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    head += f"Content-Length: {len(block)}\r\n\r\n"
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(head.encode() + block + b"\r\n\r\n") + squeeze.flush()


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def page_of(name: str | None) -> int | None:
    number = (name or "<urn:page:null>")[10:-1]
    return None if number == "null" else int(number)


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    clean = None if url is None else "".join(c for c in url if c not in "\r\n")
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", urn(page_id)),
              ("WARC-Date", DATE), ("WARC-Target-URI", clean),
              ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
              ("Content-Type", "application/http; msgtype=response")]
    if revisit:
        fields += [("WARC-Refers-To", urn(refers_to)),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return record(fields, http.encode() + (b"" if revisit else payload))


def write(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least: int = 0) -> DataFrame:
    """Write the archives; the manifest has a row per archive: file, n_records."""
    spark = df.sparkSession
    ship(spark)
    folder = shared_folder(spark)
    pages = df.select(column(df, id_col).cast("long").alias("page_id"), column(df, url_col).alias("url"),
                      F.coalesce(column(df, html_col), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    groups = stage(pages.filter(F.octet_length("payload") >= least).groupBy("digest")
                   .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").select("digest", "response"))
    marked = pages.join(groups.withColumn("shared", F.lit(True)), "digest", "left").select(
        "page_id", "url", "payload", "response",
        (F.coalesce("shared", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("response"))).alias("revisit"))

    def save(batches):
        name, n, rows = f"pages-{TaskContext.get().partitionId():06d}.warc.gz", 0, (b for b in batches if b.num_rows)
        first = next(rows, None)
        if first is None:
            return
        with SharedFile(folder, name) as stream:
            stream.write(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:archive:{name}>"),
                                 ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")],
                                b"format: WARC File Format 1.1\r\n"))
            while first is not None:
                for i in range(first.num_rows):
                    stream.write(page_record(*(c[i].as_py() for c in first.columns)))
                n += first.num_rows
                first = next(rows, None)
        yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "n_records": n}])

    return stage(marked.mapInArrow(save, "file string, n_records long"))


def members(stream):
    """Decompressed chunks of a file of gzip members, each with: does it end its member?"""
    unzip, data, inside = zlib.decompressobj(31), stream.read(CHUNK), False
    while data:
        out = unzip.decompress(data, CHUNK)
        inside = not unzip.eof
        yield out, unzip.eof
        if unzip.eof:
            data, unzip = unzip.unused_data, zlib.decompressobj(31)
        else:
            data = unzip.unconsumed_tail
        data = data or stream.read(CHUNK)
    if inside:
        raise ValueError("the archive ends inside a member")


def head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def read_records(stream):
    """(headers, block) of each record of an archive, read in sequence."""
    held = bytearray()
    fields, size, body = None, 0, 0
    for out, ends in members(stream):
        held += out
        if fields is None and (cut := held.find(b"\r\n\r\n")) >= 0:
            if not held.startswith(b"WARC/"):
                raise ValueError("a record does not begin with its version")
            fields = head_fields(bytes(held[:cut]))
            size, body = int(fields["content-length"]), cut + 4
        if ends:
            if fields is None or len(held) != body + size + 4 or held[-4:] != b"\r\n\r\n":
                raise ValueError("a record's length is not its content length")
            yield fields, bytes(held[body:body + size])
            held, fields = bytearray(), None
    if held:
        raise ValueError("the archive ends inside a record")


def read(manifest: DataFrame) -> DataFrame:
    """The page records of all archives.

    page_id, url, record_type, refers_to, payload_bytes, payload_digest (both of
    the full payload) and payload (null for revisits).  A response whose payload
    differs from its digest fails the job.
    """
    ship(manifest.sparkSession)
    tasks = max(1, min(manifest.count(), 4 * manifest.sparkSession.sparkContext.defaultParallelism + 100))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary())])

    def rows(uri):
        fs, path = open_folder(uri)
        with fs.open_input_stream(path, compression=None) as stream:
            for fields, block in read_records(stream):
                if fields["warc-type"] not in ("response", "revisit"):
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                size, digest = int(head_fields(http)["content-length"]), fields["warc-payload-digest"][5:]
                response = fields["warc-type"] == "response"
                if response and (len(payload) != size or base32_sha1(payload) != digest):
                    raise ValueError(f"{uri}: a payload differs from its digest")
                yield {"page_id": page_of(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
                       "record_type": fields["warc-type"], "payload_bytes": size, "payload_digest": digest,
                       "refers_to": None if response else page_of(fields["warc-refers-to"]),
                       "payload": payload if response else None}

    def run(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows(uri):
                    held.append(row)
                    size += row["payload_bytes"]
                    if len(held) == 1000 or size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    return manifest.select("file").repartition(tasks, "file").mapInArrow(
        run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
             "payload_digest string, payload binary")
