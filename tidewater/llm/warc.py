"""WARC archives with a two-level capture index.

Writing: every page becomes a record in its own gzip member, so a record can
be read by its byte range. Of equal payloads one is a response, the others
are revisit records that refer to it.

Index: captures are sorted by their reversed-host URL key (then page) over
range partitions; each partition writes one file of compressed blocks of
``BLOCK_LINES`` lines, and one directory row per block (first and last key,
byte range). A lookup bisects the files' key ranges, then the directory of
the file, reads only the blocks that can hold the key, and gives the byte
ranges of the records. A key with any number of captures spreads over as many
blocks and files as it needs.

Files are written and read by tasks under the shared folder, by its URI; a
file counts only when the row that names it was committed, so retried tasks
leave no doubt.

Inputs: null html is an empty payload; null url has the key "-"; a null
page_id refers to its group's largest page_id where there is one; rows that
repeat the largest page_id of their group are responses too; empty tables
give an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
import zlib
from base64 import b32encode
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of, written
from tidewater.session import workspace

BLOCK_LINES = 1000
FILE_CAPTURES = 200_000  # captures in one index file
MAX_FILES = 100_000  # rows of the file table that lookup tasks get; more raise
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 32 << 20  # of archives, for one reading task
GAP = 1 << 16  # neighbouring records closer than this are read at once


def url_key(url: str | None) -> str:
    """Reversed host, then path and query: ``com,example,www)/a?b``."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url
    if not host:
        return url
    tail = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + tail


def base32_sha1(payload: F.Column) -> F.Column:
    """Upper-case base32 SHA-1: 10 hex digits are 8 base-32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): the largest page_id of the
    rows with an equal payload, null on that row. Payloads under
    ``min_bytes`` never refer."""
    base = pages.select("page_id", "url", text_of("html").cast("binary").alias("payload"))
    base = base.withColumn("digest", base32_sha1(F.col("payload")))
    groups = (base.where(F.length("payload") >= min_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    joined = base.join(groups, "digest", "left")
    return joined.select("page_id", "url", "payload", "digest",
                         F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to"))


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]')}")
    if refers_to is None:
        block = http + payload
    else:
        block = http
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


CAPTURE = "key string, page_id long, file string, at long, bytes long"


def write_archives(records: DataFrame, level: int = 1, date: str = "1970-01-01T00:00:00Z",
                   max_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``with_revisits`` rows to archives; the captures' keys and byte ranges."""
    root = workspace(records.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _open(root)
        fs.create_dir(folder, recursive=True)
        out, name, at = None, "", 0
        for b in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                if out is None or at >= max_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = z.compress(_record(page_id, url, payload, digest, refers_to, date)) + z.flush()
                out.write(member)
                rows.append((url_key(url), page_id, f"{root}/{name}", at, len(member)))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                                                 names=["key", "page_id", "file", "at", "bytes"])
        if out is not None:
            out.close()

    return written(records.mapInArrow(run, CAPTURE), "captures")


DIRECTORY = "index string, first string, last string, at long, bytes long, lines long"


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES, file_captures: int = FILE_CAPTURES) -> DataFrame:
    """Writes the sorted index files; the directory, one row a block."""
    root = workspace(captures.sparkSession, "capture-index")
    files = max(1, math.ceil(captures.count() / file_captures))
    ordered = captures.repartitionByRange(files, "key", "page_id", "file", "at").sortWithinPartitions("key", "page_id", "file", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _open(root)
        fs.create_dir(folder, recursive=True)
        name, out, at, held, keys, found = f"{uuid.uuid4().hex}.cdx.gz", None, 0, [], [], []

        def flush():
            nonlocal at
            block = zlib.compress("\n".join(held).encode(), 6)
            out.write(block)
            found.append((f"{root}/{name}", keys[0], keys[-1], at, len(block), len(held)))
            at += len(block)
            held.clear()
            keys.clear()

        for b in batches:
            for key, page_id, file, start, size in zip(*(b.column(c).to_pylist() for c in ("key", "page_id", "file", "at", "bytes"))):
                out = out or fs.open_output_stream(f"{folder}/{name}", compression=None)
                keys.append(key)
                held.append(json.dumps([key, page_id, file, start, size]))
                if len(held) == block_lines:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["index", "first", "last", "at", "bytes", "lines"])

    return written(ordered.mapInArrow(run, DIRECTORY), "capture-directory")


def lookup(directory: DataFrame, keys: DataFrame) -> DataFrame:
    """The captures (key, page_id, file, at, bytes) of the distinct ``key`` values of ``keys``."""
    per_file = directory.groupBy("index").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    files = sorted(per_file.limit(MAX_FILES + 1).collect(), key=lambda r: (r["first"], r["last"]))
    if len(files) > MAX_FILES:
        raise ValueError(f"over {MAX_FILES} index files; build the index with larger files")
    names, firsts, lasts = ([r[c] for r in files] for c in ("index", "first", "last"))

    def place(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            hits = [(names[i], k) for k in pdf["key"] for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pd.DataFrame(hits, columns=["index", "key"])

    def search(wanted: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(wanted) or not len(blocks):
            return pd.DataFrame(columns=["key", "page_id", "file", "at", "bytes"])
        blocks = blocks.sort_values("at")
        first, last = blocks["first"].tolist(), blocks["last"].tolist()
        keys, need = set(wanted["key"]), set()
        for k in keys:
            need.update(range(bisect_left(last, k), bisect_right(first, k)))
        fs, path = _open(blocks["index"].iloc[0])
        rows = []
        with fs.open_input_file(path) as f:
            for i in sorted(need):
                raw = f.read_at(int(blocks["bytes"].iloc[i]), int(blocks["at"].iloc[i]))
                rows += [r for r in map(json.loads, zlib.decompress(raw).decode().split("\n")) if r[0] in keys]
        out = pd.DataFrame(rows, columns=["key", "page_id", "file", "at", "bytes"])
        return out.astype({"page_id": "Int64"})

    distinct = keys.select("key").where("key is not null").distinct()
    placed = distinct.mapInPandas(place, "index string, key string")
    return placed.groupBy("index").cogroup(directory.groupBy("index")).applyInPandas(search, CAPTURE)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _parse(member: bytes, with_payload: bool) -> tuple:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    number = lambda k: int(v) if (v := fields.get(k, "<urn:x-page:>")[len("<urn:x-page:"):-1]) else None
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    if kind == "response":
        own = b32encode(hashlib.sha1(payload).digest()).decode()
        if own != digest or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        digest = own
    row = (number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To"), fields.get("WARC-Target-URI"))
    return (*row, payload if kind == "response" else None) if with_payload else row


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records at the byte ranges of ``captures``; neighbours are read at once."""
    schema = READ + (", payload binary" if with_payload else "")
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][:len(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f = None, None
        for b in batches:
            spans = list(zip(*(b.column(c).to_pylist() for c in ("file", "at", "bytes"))))
            rows, k = [], 0
            while k < len(spans):
                file, start, size = spans[k]
                if file != name:
                    if f is not None:
                        f.close()
                    fs, path = _open(file)
                    name, f = file, fs.open_input_file(path)
                end, m = start + size, k + 1
                while m < len(spans) and spans[m][0] == file and spans[m][1] - end <= GAP and spans[m][1] + spans[m][2] - start <= 8 << 20:
                    end = max(end, spans[m][1] + spans[m][2])
                    m += 1
                raw = f.read_at(end - start, start)
                for _, a, n in spans[k:m]:
                    rows.append(_parse(raw[a - start:a - start + n], with_payload))
                    if sum(len(r[-1] or b"") for r in rows[-1:]) > 1 << 20 or len(rows) >= 2000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                k = m
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
        if f is not None:
            f.close()

    # Rows are pointers: tasks are sized by the bytes they point to, not by their own.
    captures = written(captures.select("file", "at", "bytes"), "wanted")
    tasks = max(1, math.ceil((captures.agg(F.sum("bytes")).first()[0] or 0) / READ_BYTES))
    near = captures.repartition(tasks, "file").sortWithinPartitions("file", "at")
    return near.select("file", "at", "bytes").mapInArrow(run, schema)


def archive(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Writes archives and index of ``pages``; (captures, directory)."""
    captures = write_archives(with_revisits(pages))
    return captures, build_index(captures)
