"""WARC round trips, range ownership, damaged bytes; the temporal URL list against plain Python."""

import base64
import gzip
import hashlib
import io
import re
import zlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from firmfold.llm import queries, url_filter, warc
from firmfold.session import scratch_dir

PAGES = "page_id bigint, url string, html string"


def expected(rows):
    by = {}
    for i, _, html in rows:
        by.setdefault((html or "").encode(), []).append(i)
    out = []
    for payload, ids in by.items():
        largest = max((i for i in ids if i is not None), default=None)
        for i in ids:
            refers = largest if largest is not None and i != largest else None
            out.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                        "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [100, 4096, 8 << 20])
def test_round_trip(llm, sf, split):
    rows = [tuple(r) for r in llm.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    rows += [(900 + i, "http://a.example/\r\nX: y", "same") for i in range(5)] + [(904, "u", "same"), (None, None, "same")]
    rows += [(910, "u", None), (911, "u", ""), (None, "u", "alone"), (912, "u", "WARC/1.1\r\n\r\n\x1f\x8b\x08" * 50)]
    pages = llm.createDataFrame(rows, PAGES).repartition(3).withColumn("payload", F.lit("clash"))
    got = sorted(map(tuple, warc.round_trip(pages, split_bytes=split).collect()), key=str)
    assert got == expected(rows)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_every_range_split_owns_each_record_once(tmp_path):
    members = [warc._page_member(i, "http://x.example", bytes([i]) * (i * 37), None) for i in range(1, 40)]
    data = b"".join(members)
    assert gzip.decompress(data).count(b"WARC/1.1") == 39
    starts = [sum(map(len, members[:k])) for k in range(len(members))]

    class File(io.BytesIO):
        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)

    for width in (1, 2, 3, 7, 100, 1000, len(data)):
        found = [at for a in range(0, len(data), width)
                 for at, *_ in warc.records_in(File(data), a, min(a + width, len(data)), len(data))]
        assert found == starts
    # Damage one member: only it is lost. Cut off the last one: likewise.
    broken = bytearray(data)
    broken[starts[10] + len(members[10]) // 2] ^= 0xFF
    found = [at for at, *_ in warc.records_in(File(bytes(broken)), 0, len(data), len(data))]
    assert set(starts) - set(found) == {starts[10]} and set(found) <= set(starts)
    short = data[:-3]
    assert len(list(warc.records_in(File(short), 0, len(short), len(short)))) == 38


def test_stored_blocks_and_foreign_members(tmp_path):
    """The magic inside a stored payload, and members that are no WARC records, are not taken for records."""
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    body = b"\x1f\x8b\x08\x00" * 30
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    stored = packer.compress(head + body + b"\r\n\r\n") + packer.flush()
    data = gzip.compress(b"no record") + stored + gzip.compress(b"WARC/1.0\r\nno length\r\n\r\n") + stored

    class File(io.BytesIO):
        def read_at(self, n, at):
            self.seek(at)
            return self.read(n)

    for width in (5, 50, len(data)):
        found = [block for a in range(0, len(data), width)
                 for *_, block in warc.records_in(File(data), a, min(a + width, len(data)), len(data))]
        assert found == [body, body]


def test_payloads_and_listing(llm, sf):
    pages = llm.read.parquet(f"{sf}/pages.parquet")
    folder = scratch_dir(llm, "archives")
    manifest = warc.write_archives(warc.with_revisits(pages), folder, file_bytes=20_000)
    listed = warc.list_archives(llm, folder)
    assert listed.count() == manifest.count() > 1
    got = {r.record_id: bytes(r.payload).decode() for r in warc.read_archives(listed, 5000).filter("type = 'response'").collect()}
    assert got == {f"urn:x-page:{r.page_id}": r.html for r in pages.collect()}


# -- URL filters ----------------------------------------------------------------

def chain(url):
    m = re.match(url_filter._HOST, url or "")
    host = m[1].lower().rstrip(".") if m else ""
    if not host:
        return []
    path = re.match(url_filter._PATH, url)[1]
    labels, segments = host.split("."), [s for s in path.split("/") if s]
    return [".".join(labels[-k:]) for k in range(1, len(labels) + 1)] + [
        host + "/" + "/".join(segments[:k]) for k in range(1, len(segments) + 1)]


def brute(captures, entries):
    rank = {a: k for k, a in enumerate(url_filter.ACTIONS)}
    history = {}
    for pattern, action, at in entries:
        if pattern is not None and at is not None and action in rank:
            days = history.setdefault(pattern.lower(), {})
            days[at] = min(days.get(at, action), action, key=rank.get)
    out = []
    for page, url, at in captures:
        found = []
        for pattern in map(str.lower, chain(url)) if at is not None else ():
            past = [d for d in history.get(pattern, {}) if d <= at]
            if past and history[pattern][max(past)] != "drop":
                found.append((pattern, history[pattern][max(past)]))
        pattern, action = found[-1] if found else (None, None)
        out.append((page, url, len(found), pattern, action, action != "block"))
    return sorted(out, key=str)


def test_url_list(llm):
    start = datetime(2023, 12, 25)
    urls = ["http://www.a.example/x/y?q=1", "https://user@A.example:80/", "http://a.example./x#f", "ftp://b.example", "http://b.example/x/",
            "not a url", "", None, "http://c.a.example/x/y/z", "http:///nohost"]
    captures = [(i, urls[i % len(urls)], start + timedelta(days=i * 3)) for i in range(120)] + [(7, urls[0], start)] * 3
    captures += [(500, urls[0], None), (None, urls[0], start + timedelta(days=400))]
    names = ["a.example", "example", "www.a.example", "WWW.A.example/x", "www.a.example/x/y", "a.example/x", "b.example", "c.a.example/x/y"]
    entries = [(names[k % 8], url_filter.ACTIONS[k * 7 % 3], start + timedelta(days=(k * 53) % 300, seconds=k % 2)) for k in range(60)]
    entries += [("a.example", "allow", start), ("a.example", "block", start), (None, "block", start), ("b.example", "strange", start), ("b.example", "block", None)]
    frame = llm.createDataFrame(captures, "page_id bigint, url string, fetched_at timestamp").withColumn("bucket", F.lit("clash"))
    listed = llm.createDataFrame(entries, "pattern string, action string, effective_at timestamp")
    for days in (1, 30, 1000):
        got = url_filter.judge(frame, listed, bucket_days=days).collect()
        assert sorted(((r.page_id, r.url, r.n_active, r.pattern, r.action, r.kept) for r in got), key=str) == brute(captures, entries)
    assert url_filter.judge(frame, listed.limit(0)).filter("kept").count() == len(captures)
    assert url_filter.judge(frame.limit(0), listed).count() == 0


def test_url_query_runs_no_python(llm, sf):
    plan = queries.QUERIES["op2_url_filters"](llm, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
