"""WARC archives with an index that comes first.

Writing: records with equal payloads keep one ``response`` (the smallest page
id), the others are ``revisit`` records that carry only the HTTP head.  Every task
writes gzip-member records into an archive of its own in the shared folder and
returns one index row per record: file, offset, length, URL, digest.  The index is
written as a table before anything is read; files of lost or repeated attempts are
in no index and so never read.

Reading: the index rows asked for are grouped by file and stretch of the file,
sorted by offset, and neighbouring ranges are read together; the records are
parsed from those bytes alone.

The shared folder is opened by pyarrow's file systems (file, hdfs, s3, gs).

Defined cases: null html is an empty payload; null url is left out of the record;
null page_id is never the smallest, and a payload that only null ids have is all response;
rows that repeat the smallest id are responses each, and only rows that repeat page id and payload share a record id; an empty table gives an empty index;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, shared_path

#: Bytes between two ranges that are read rather than skipped, and bytes of one read.
GAP, READ = 64 * 1024, 8 * 1024 * 1024
#: Stretches of a file that one reading group covers.
STRETCH = 64 * 1024 * 1024
INDEX = "page_id long, url string, file string, offset long, length long, digest string, record_type string, refers_to long"

RECORDS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "record_id string, refers_to_record string, payload binary")


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _line(name: str, value) -> str:
    return "" if value is None else f"{name}: {value}\r\n"


def record_id(page_id, digest: str) -> str:
    """The id of a record; only records that repeat page id and payload share one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """An uncompressed WARC/1.1 record; refers_to is None for a response."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head + (payload if refers_to is None else b"")
    clean = None if url is None else "".join(url.split())
    fields = (_line("WARC-Type", "response" if refers_to is None else "revisit") + _line("WARC-Target-URI", clean)
              + _line("WARC-Record-ID", record_id(page_id, digest))
              + _line("WARC-Date", "2020-01-01T00:00:00Z") + _line("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        fields += (_line("WARC-Refers-To", record_id(refers_to, digest))
                   + _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    fields += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", len(block))
    return b"WARC/1.1\r\n" + fields.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Fields, payload length and payload (empty for a revisit) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields, size, payload


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def typed(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload, sha1 (hex) and refers_to (null: a response)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    large = F.octet_length("payload") >= least
    first = rows.where(large).groupBy("sha1").agg(F.min("page_id").alias("first"))
    refers = F.when(large & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "sha1", "left").select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Writes the archives below ``folder`` and their index to ``folder``/index; returns the index."""
    spark = pages.sparkSession
    bounded_batches(spark)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        out, name, place = None, "", 0
        try:
            for batch in batches:
                made = []
                for page_id, url, payload, sha1, refers in batch.itertuples(index=False, name=None):
                    if out is None:
                        name = f"part-{uuid.uuid4().hex}.warc.gz"
                        fs.create_dir(root, recursive=True)
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)  # the records are packed already
                    refers = None if pd.isna(refers) else int(refers)
                    page_id = None if pd.isna(page_id) else int(page_id)
                    digest = base32(sha1)
                    packed = _gzip(record(page_id, url, bytes(payload), digest, refers))
                    out.write(packed)
                    made.append((page_id, url, name, place, len(packed), digest, "response" if refers is None else "revisit", refers))
                    place += len(packed)
                yield pd.DataFrame(made, columns=[f.split()[0] for f in INDEX.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})
        finally:
            if out is not None:
                out.close()

    index = typed(pages, least).mapInPandas(write, INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _ranges(rows: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, members) of coalesced ranges; rows of (offset, length) in order."""
    start = end = 0
    members: list[tuple[int, int]] = []
    for offset, length in rows:
        if members and (offset - end > GAP or offset + length - start > READ):
            yield start, end, members
            members = []
        if not members:
            start = offset
        members.append((offset, length))
        end = offset + length
    if members:
        yield start, end, members


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """RECORDS of the index rows, as the archives have them; a revisit has no payload.

    Fields come from the bytes read; a response's digest is computed from its payload, and ``refers_to`` is
    the index's page id after it was held against the record's ``WARC-Refers-To``: records that contradict their index are an error.
    """
    spark = index.sparkSession

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, rows in batch.groupby("file", sort=False):
                made = []
                with fs.open_input_file(f"{root}/{name}") as file:
                    table = iter(rows.itertuples(index=False))
                    for start, end, members in _ranges(list(zip(rows["offset"], rows["length"], strict=True))):
                        raw = file.read_at(end - start, start)
                        for offset, length in members:
                            row = next(table)
                            fields, size, payload = parse(zlib.decompress(raw[offset - start : offset - start + length], 31))
                            kind = fields["WARC-Type"]
                            digest = (base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response"
                                      else fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                            page_id, refers = (None if pd.isna(x) else int(x) for x in (row.page_id, row.refers_to))
                            want = record_id(page_id, row.digest), row.digest, None if refers is None else record_id(refers, digest)
                            if (fields["WARC-Record-ID"], digest, fields.get("WARC-Refers-To")) != want:
                                raise ValueError(f"{name}, offset {offset}: the record isn't what the index says")
                            made.append((page_id, fields.get("WARC-Target-URI"), size, digest, kind, refers, fields["WARC-Record-ID"],
                                         fields.get("WARC-Refers-To"), payload if kind == "response" else None))
                yield pd.DataFrame(made, columns=[f.split()[0] for f in RECORDS.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")  # index rows are short
    dealt = (index.repartition(F.col("file"), F.floor(F.col("offset") / STRETCH))
             .sortWithinPartitions("file", "offset"))
    return dealt.mapInPandas(read, RECORDS)


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives ``pages`` in a new shared folder and reads all of it back."""
    folder = shared_path(pages.sparkSession, "warc")
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_records(write_archives(pages, uri, least), uri).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
