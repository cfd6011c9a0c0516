"""WARC: writing archives with revisit records, and a splittable reader.

Archives are files of gzip members, one per record. The reader cuts files into byte
ranges. A task looks for the gzip magic in its range; a candidate counts only if it
decodes to a WARC header, and as a record only if the member decodes to its end with
the right checksum. A task owns the records that start in its range and reads on past
its end to finish the last one. From a record's end it goes on with the next member, so
bytes inside records are searched only after a break or at the start of a range.

The writer gives each task its own file under a name that no other attempt has; the
files that count are those in the manifest, which Spark commits with the tasks that
succeeded. Lost and repeated attempts leave files that nothing reads.

Defined results: a null payload is written as an empty one; of records with equal
payloads the one with the largest id is the response and the others revisit it, null ids
too; rows that repeat the largest id are all responses; a group of null ids only has no
revisits. Damaged members and members cut off at the end of a file are skipped. A
record is held whole in memory while it is read. A stored, uncompressed archive inside a
payload could be taken for records if a range starts within it; this writer compresses
payloads, so it makes none. Empty tables give archives without records. Only the named
columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from typing import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmfold.llm.common import pick, written
from firmfold.session import scratch_dir

SPLIT_BYTES = 8 << 20
FILE_BYTES = 1 << 30
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
_MAGIC = b"\x1f\x8b\x08"
_STEP = 1 << 16
_ID = "urn:x-page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _member(version_and_fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in version_and_fields], f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def _page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{_ID}{refers_to}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _member(fields, http + (payload if refers_to is None else b""))


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """id, url, payload (binary) and ``refers_to``: the id of the record that holds an equal payload, or null.

    Groups are found on digests alone, counted before they are moved; only groups of two
    and more enter the join.
    """
    rows = pick(pages, id=id_col, url=url_col, payload=payload_col).withColumn(
        "payload", F.coalesce(F.col("payload"), F.lit("")).cast("binary"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    groups = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha").agg(
        F.max("id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1 and largest is not null")
    other = F.col("id").isNull() | (F.col("id") != F.col("largest"))
    return rows.join(groups.drop("n"), "sha", "left").select(
        "id", "url", "payload", F.when(F.col("largest").isNotNull() & other, F.col("largest")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows of ``with_revisits``; the manifest (path, bytes, records) of the files that count."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, size, count = None, "", 0, 0
        for batch in batches:
            for r in batch.itertuples(index=False):
                if out is None:
                    name, size, count = f"part-{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                    head = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                                    ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC\r\n")
                    out.write(head)
                    size += len(head)
                known = [None if pd.isna(x) else int(x) for x in (r.id, r.refers_to)]
                member = _page_member(known[0], r.url, bytes(r.payload), known[1])
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pd.DataFrame({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]})

    # Ids as text: a column with nulls would reach the task as floating-point numbers.
    exact = records.withColumns({"id": F.col("id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    return written(exact.mapInPandas(write, "path string, bytes bigint, records bigint"), "manifest")


def list_archives(spark: SparkSession, folder: str, pattern: str = "*.warc.gz") -> DataFrame:
    """(path, bytes) of the archives of a folder, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


class _Range:
    """A file's bytes from a range's start on; bytes beyond the range are read when asked for."""

    def __init__(self, file, start: int, end: int, size: int) -> None:
        self._file, self.start, self.size = file, start, size
        # Two bytes more: the magic of the last member may stand across the end.
        self.data = file.read_at(min(end + 2, size) - start, start)

    def chunks(self, at: int) -> Iterator[bytes]:
        view = memoryview(self.data)
        held = self.start + len(view)
        for a in range(at, held, _STEP):
            yield view[a - self.start:min(a + _STEP, held) - self.start]
        for a in range(max(at, held), self.size, _STEP):
            yield self._file.read_at(min(_STEP, self.size - a), a)

    def find(self, at: int, end: int) -> int:
        return self.data.find(_MAGIC, at - self.start, end - self.start + 2)


def _decoded(held: _Range, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Header, block and end of the member at this place; None if it is no whole WARC record."""
    unpack, parts, got, used = zlib.decompressobj(31), [], b"", 0
    try:
        for chunk in held.chunks(at):
            used += len(chunk)
            part = unpack.decompress(chunk, 0 if len(got) >= 7 else 64)
            while True:
                parts.append(part)
                if len(got) < 7:
                    got += part
                    if not b"WARC/1."[:len(got)] == got[:7]:
                        return None
                if unpack.eof or not unpack.unconsumed_tail:
                    break
                part = unpack.decompress(unpack.unconsumed_tail, 0)
            if unpack.eof:
                break
    except zlib.error:
        return None
    if not unpack.eof:
        return None
    head, mark, rest = b"".join(parts).partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = fields.get("content-length", "")
    if not mark or not length.isdigit() or int(length) > len(rest):
        return None
    return fields, rest[:int(length)], at + used - len(unpack.unused_data)


def records_in(file, start: int, end: int, size: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of the records that start in a byte range."""
    held, at = _Range(file, start, end, size), start
    while at < end:
        place = held.find(at, end)
        if place < 0 or held.start + place >= end:
            return
        at = held.start + place
        found = _decoded(held, at)
        if found is None:
            at += 1
            continue
        fields, block, after = found
        yield at, after - at, fields, block
        at = after


_READ = ("path string, offset bigint, length bigint, type string, record_id string, target_uri string, date string, "
         "refers_to string, payload_digest string, payload_bytes bigint, payload binary")


def _row(path: str, offset: int, length: int, fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind, payload, size = fields.get("warc-type"), block, len(block)
    digest = None
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":  # the payload is elsewhere; its length and digest are stated here
            stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
            size, payload = int(stated[1]) if stated else None, None
            digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if payload is not None:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    strip = [fields[k].strip("<>") if k in fields else None for k in ("warc-record-id", "warc-target-uri")]
    refers = fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None
    return (path, offset, length, kind, *strip, fields.get("warc-date"), refers, digest, size, payload if with_payload else None)


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """One row per record of the files (path, bytes), read by byte ranges.

    The digest is computed from the payload that was read; a revisit states its own.
    """
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(split_bytes).cast("bigint"))
    ranges = files.filter("bytes > 0").select("path", "bytes", F.explode(starts).alias("start"))
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [part.split()[0] for part in _READ.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for r in batch.itertuples(index=False):
                store, path = fs.FileSystem.from_uri(r.path)
                with store.open_input_file(path) as file:
                    rows, held = [], 0
                    for offset, length, fields, block in records_in(file, r.start, min(r.start + split_bytes, r.bytes), r.bytes):
                        rows.append(_row(r.path, offset, length, fields, block, with_payload))
                        held += len(block) if with_payload else 200
                        if held > 16 << 20:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

    return ranges.repartition(tasks, "path", "start").mapInPandas(read, _READ)


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write a record per page, read the archives back: one row per page."""
    manifest = write_archives(with_revisits(pages, min_bytes), scratch_dir(pages.sparkSession, "warc"))
    found = read_archives(manifest, split_bytes, with_payload=False).filter(F.col("type").isin("response", "revisit"))

    def number(c: str):
        return F.nullif(F.regexp_extract(c, r"(-?\d*)$", 1), F.lit("")).cast("bigint")

    return found.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                        F.col("type").alias("record_type"), number("refers_to").alias("refers_to"))
