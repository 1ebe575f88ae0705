"""Deterministic sharded WARC writer and reader.

Records are range-sorted by page id, then payload digest, over shards of about
equal bytes.  The bounds are quantiles by bytes of a sample that is drawn by a
hash of the record itself (all records of a table of up to ``SAMPLE_ROWS``), so
the same table always gives the same files, far ids leave the others where they
are, and dense, equal or null ids are cut like all others; only copies of one
record, of ``REVISIT_BYTES`` and more, with one id stay together.  The number
of shards follows from the bytes, and a shard is several files: a task writes
the files of one shard, every record is a gzip member of its own, and a file is
closed once its compressed size reaches ``roll_bytes``.  Digests, lengths and
headers are made anew from the payload.  Files are written under a temporary
name and moved; then the shard's manifest (file, records, bytes, SHA-256) is
written the same way.  A repeated or parallel attempt of a task writes equal
bytes to equal names, so whichever attempt moves last changes nothing.  Readers
start from the manifests in the folder, in any session: only files that a
manifest lists are opened, and records, bytes and SHA-256 of each are compared.

The folder may be on any file system that ``pyarrow.fs`` opens by its URI.

Of records of equal payload of at least ``revisit_bytes`` the one of the
largest page id is a response and the others are revisits of it.  Defined
cases: a null html is an empty payload; null urls are written as empty; rows
that share both payload and largest page id are all responses; a group without
any page id is all responses; a null page id sorts first; an empty table
writes no file; extra columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesweft.llm.columns import spread
from salesweft.session import new_work_dir, written

REVISIT_BYTES = 1000
# Bytes of payload in a shard: a thousandth of the table between these bounds,
# and a file is closed at a part of that, compressed.
LEAST_SHARD, MOST_SHARD, SHARDS = 16 << 20, 1 << 30, 1000
FILES_PER_SHARD = 16
SAMPLE_ROWS = 500_000
READ_BYTES = 2 << 20
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"  # capture time of pages that come without one
MANIFEST = "shard int, file string, records long, bytes long, sha256 string"


def revisits(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, same, refers_to) of the pages that revisit another one; ``same`` is the payload's SHA-256.

    Digests only: payloads do not move for this decision.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_column).alias("page_id"), F.octet_length(payload).alias("size"), F.unhex(F.sha2(payload, 256)).alias("same")).where(F.col("size") >= revisit_bytes)
    groups = rows.groupBy("same").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    found = rows.join(groups.select("same", "refers_to"), "same")
    return found.where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "same", "refers_to").distinct()


def _identifier(page: int | None, url: str) -> str:
    digest = hashlib.sha256(f"{page}\n{url}".encode()).hexdigest()
    return f"<urn:uuid:{digest[:8]}-{digest[8:12]}-5{digest[13:16]}-8{digest[17:20]}-{digest[20:32]}>"


def record(page: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record.  A revisit keeps the HTTP headers, with the payload's length, and no payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_identifier(page, url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        *([f"X-Page-Id: {page}"] if page is not None else []),
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{os.path.abspath(uri)}")


def _uri(folder: str) -> str:
    return "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder


def _commit(files: pyarrow.fs.FileSystem, path: str, data: bytes, attempt: str) -> None:
    with files.open_output_stream(f"{path}.{attempt}.tmp") as out:
        out.write(data)
    files.move(f"{path}.{attempt}.tmp", path)


def _writer(folder: str, roll_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, root = _open(folder)
        attempt = str(TaskContext.get().taskAttemptId())
        noted_page, notes = None, {}
        now: dict = {"shard": None, "number": 0, "stream": io.BytesIO(), "records": 0, "done": []}

        def roll() -> None:
            data = now["stream"].getvalue()
            if data:
                name = f"pages-{now['shard']:05d}-{now['number']:05d}.warc.gz"
                _commit(files, f"{root}/{name}", data, attempt)
                now["done"].append({"shard": now["shard"], "file": name, "records": now["records"], "bytes": len(data), "sha256": hashlib.sha256(data).hexdigest()})
            now.update(number=now["number"] + 1, stream=io.BytesIO(), records=0)

        def close() -> pa.RecordBatch:
            roll()
            done = now["done"]
            _commit(files, f"{root}/manifest-{now['shard']:05d}.json", json.dumps(done).encode(), attempt)
            now.update(number=0, done=[])
            return pa.RecordBatch.from_pylist(done, pa.schema([("shard", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

        for batch in batches:
            for shard, page, url, payload, same, refers in zip(*[batch.column(c).to_pylist() for c in ("shard", "page_id", "url", "payload", "same", "refers_to")]):
                if now["shard"] not in (None, shard):
                    yield close()
                now["shard"] = shard
                if page != noted_page:
                    noted_page, notes = page, {}
                if payload is None:
                    # A note: the record of this page with this payload is a revisit.
                    notes[same] = refers
                    continue
                refers = notes.get(hashlib.sha256(payload).digest()) if notes else None
                now["stream"].write(gzip.compress(record(page, url, payload, refers), LEVEL, mtime=0))
                now["records"] += 1
                if now["stream"].tell() >= roll_bytes:
                    roll()
        if now["shard"] is not None:
            yield close()

    return run


def _with_shards(rows: DataFrame, shard_bytes: int | None) -> tuple[DataFrame, int]:
    """A shard number per row, non-decreasing in the key (id, digest), and the bytes aimed at for each."""
    narrow = rows.where("payload IS NOT NULL").select(*KEY, (F.octet_length("payload") + 500).alias("size"))
    count, total = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shard_bytes = shard_bytes or min(MOST_SHARD, max(LEAST_SHARD, total // SHARDS))
    rate = min(1.0, SAMPLE_ROWS / max(1, count))
    sample = narrow.where(spread(F.lit(7), *KEY) < rate).toArrow().to_pylist()
    sample = sorted(((r["known"], r["page_id"] or 0, r["digest"], r["extra"]), r["size"]) for r in sample)
    bounds, held = [], 0
    for key, size in sample:
        if held >= shard_bytes * rate:
            if not bounds or key > bounds[-1]:
                bounds.append(key)
            held = 0
        held += size
    sent = rows.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def shard(known: pd.Series, page: pd.Series, digest: pd.Series, extra: pd.Series) -> pd.Series:
        keys = zip(known, page.fillna(0), digest, extra)
        return pd.Series([bisect_right(sent.value, (bool(k), int(p), int(d), int(e))) for k, p, d, e in keys], dtype="int32")

    # Ids go as whole numbers: as doubles, neighbours above 2**53 would be equal.
    return rows.withColumn("shard", shard("known", F.coalesce("page_id", F.lit(0)), "digest", "extra")), shard_bytes


KEY = ["known", "page_id", "digest", "extra"]


def write_pages(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", roll_bytes: int | None = None, shard_bytes: int | None = None, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write all pages as WARC files below the folder; returns the table of manifests."""
    folder = _uri(folder)
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    url, payload = F.coalesce(F.col(url_column), F.lit("")), F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    page, none = F.col(id_column).cast("long").alias("page_id"), F.lit(None)
    # Small payloads have no notes, so copies of them can be told apart by url as well.
    extra = F.when(F.octet_length(payload) < revisit_bytes, F.xxhash64(url)).otherwise(F.lit(0).cast("long"))
    records = pages.select(
        F.col(id_column).isNotNull().alias("known"), page, F.xxhash64(F.unhex(F.sha2(payload, 256))).alias("digest"), extra.alias("extra"),
        url.alias("url"), payload.alias("payload"), none.cast("binary").alias("same"), none.cast("long").alias("refers_to"),
    )
    notes = revisits(pages, id_column, html_column, revisit_bytes).select(
        F.col("page_id").isNotNull().alias("known"), F.col("page_id").cast("long").alias("page_id"), F.xxhash64("same").alias("digest"), F.lit(0).cast("long").alias("extra"),
        F.lit("").alias("url"), none.cast("binary").alias("payload"), "same", F.col("refers_to").cast("long").alias("refers_to"),
    )
    # Notes travel with the records, by the same key, and sort before them, so payloads move once.
    sharded, aimed = _with_shards(records.unionByName(notes), shard_bytes)
    order = ["shard", *KEY, F.col("payload").isNotNull(), "url"]
    dealt = sharded.repartition("shard").sortWithinPartitions(*order)
    columns = dealt.select("shard", "page_id", "url", "payload", "same", "refers_to")
    return written(columns.mapInArrow(_writer(folder, roll_bytes or max(1, aimed // FILES_PER_SHARD)), MANIFEST), "warc-manifest")


def manifests(spark: SparkSession, folder: str) -> DataFrame:
    """The committed manifests of a folder; none in an empty one."""
    folder = _uri(folder)
    files, root = _open(folder)
    names = [f.base_name for f in files.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))]
    if not any(n.startswith("manifest-") and n.endswith(".json") for n in names):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("multiLine", True).json(f"{folder}/manifest-*.json")


def _members(stream: io.IOBase, digest) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time; ``digest`` is brought up to date with what is read."""

    def read() -> bytes:
        data = stream.read(1 << 20)
        digest.update(data)
        return data

    machine, out = zlib.decompressobj(31), []
    data = read()
    while data:
        out.append(machine.decompress(data))
        if machine.eof:
            yield b"".join(out)
            data, out = machine.unused_data, []
            machine = zlib.decompressobj(31)
            data = data or read()
        else:
            data = read()
    if b"".join(out):
        raise ValueError("the last record is cut off")


def parse_record(data: bytes) -> dict:
    """Headers and payload of a record as :func:`record` writes it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: ")).split(": ")[1])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    response = headers["WARC-Type"] == "response"
    if response and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} does not have its digest")
    page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page is None else int(page), "url": unquote(headers.get("WARC-Target-URI", "")), "payload": payload if response else None, "payload_bytes": size,
        "payload_digest": digest, "record_type": headers["WARC-Type"], "refers_to": None if refers is None else int(refers),
    }


def read_records(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of all files in a table of manifests, each file read by one task."""
    folder = _uri(folder)
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    names = [n for n, _ in fields if with_payload or n != "payload"]
    schema = pa.schema([f for f in fields if f[0] in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(folder)
        for batch in batches:
            for name, expected, sha256 in zip(*[batch.column(c).to_pylist() for c in ("file", "records", "sha256")]):
                count, rows, size, digest = 0, [], 0, hashlib.sha256()
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in _members(stream, digest):
                        row = parse_record(data)
                        rows.append({n: row[n] for n in names})
                        count, size = count + 1, size + (len(data) if with_payload else 200)
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if count != expected:
                    raise ValueError(f"{name} has {count} records, its manifest says {expected}")
                if digest.hexdigest() != sha256:
                    raise ValueError(f"{name} does not have the SHA-256 of its manifest")
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {"page_id": "long", "url": "string", "payload": "binary", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long"}
    # A manifest row is small, the file behind it is not: rows are dealt by hand, in tasks of about equal bytes.
    known = written(manifest.select("file", "records", "bytes", "sha256"), "warc-files")
    tasks = known.agg(F.coalesce(F.ceil(F.sum("bytes") / READ_BYTES), F.lit(1))).first()[0]
    return known.repartition(max(1, int(tasks)), "file").mapInArrow(run, ", ".join(f"{n} {kinds[n]}" for n in names))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to a fresh folder and read every record back, from the manifests in it."""
    folder = new_work_dir(spark, "warc")
    write_pages(pages, folder)
    return read_records(manifests(spark, folder), folder, with_payload=False).drop("url")
