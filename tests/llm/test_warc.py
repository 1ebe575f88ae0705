import gzip
import hashlib
import os
from collections import Counter
from urllib.parse import urlparse

import pytest

from salesweft.llm import warc
from salesweft.session import importable, new_work_dir

BIG, OTHER = "x" * 1500, "é" * 600
ROWS = [
    (None, None, None), (5, "http://a/ü b\n", BIG), (9, "v", BIG), (9, "v", BIG), (None, "q", BIG), (3, "", "short"), (4, "", "short"),
    (2**40, "z", OTHER), (-3, "z", OTHER), (11, "l", "line\r\n\r\nWARC/1.1\r\n" * 5000), (12, "e", ""),
] + [(100 + k, f"u{k}", f"<p>{k}</p>" * (k % 90)) for k in range(200)]


@pytest.fixture(scope="module")
def pages(spark):
    importable(spark)
    return spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, payload string, shard int")


def brute(rows):
    best = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            best[html] = max(best.get(html, i), i)
    out = Counter()
    for i, _, html in rows:
        payload = (html or "").encode()
        keeper = best.get(html) if len(payload) >= 1000 else None
        revisit = keeper is not None and keeper != i
        out[(i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None)] += 1
    return out


def write(spark, pages, **options):
    folder = new_work_dir(spark, "warc-test")
    return folder, warc.write_pages(pages, folder, **options)


def test_round_trip(spark, pages):
    folder, manifest = write(spark, pages)
    found = warc.read_records(manifest, folder).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == brute(ROWS)
    html = Counter((i, (h or "").encode()) for i, _, h in ROWS)
    assert all(html[(r.page_id, bytes(r.payload))] for r in found if r.record_type == "response")
    assert {r.url for r in found} == {u or "" for _, u, _ in ROWS}


def test_same_table_same_files_and_rolling(spark, pages):
    options = {"roll_bytes": 3000, "shard_bytes": 20_000}
    one, two = (sorted(map(tuple, write(spark, p, **options)[1].collect())) for p in (pages, pages.repartition(5)))
    assert one == two and len(one) > 5 and len({row[0] for row in one}) > 1
    folder, manifest = write(spark, pages, **options)
    path = urlparse(folder).path
    names = {r.file for r in manifest.collect()}
    assert {n for n in os.listdir(path) if n.endswith(".warc.gz")} == names and not [n for n in os.listdir(path) if "tmp" in n]
    # Ids do not fall along the files' order.
    last = None
    for name in sorted(names):
        with gzip.open(f"{path}/{name}") as stream:
            ids = [int(x.split(b": ")[1]) for x in stream.read().split(b"\r\n") if x.startswith(b"X-Page-Id: ")]
        assert ids == sorted(ids) and (last is None or not ids or ids[0] >= last)
        last = ids[-1] if ids else last


def test_damage_is_found(spark, pages):
    folder, manifest = write(spark, pages)
    name = manifest.first().file
    path = f"{urlparse(folder).path}/{name}"
    data = open(path, "rb").read()
    with open(path, "wb") as out:
        out.write(data[: len(data) // 2])
    with pytest.raises(Exception):
        warc.read_records(manifest, folder).count()


def test_another_reader_starts_from_the_committed_manifests(spark, pages):
    folder, manifest = write(spark, pages, roll_bytes=3000, shard_bytes=20_000)
    path = urlparse(folder).path
    with open(f"{path}/pages-00000-99999.warc.gz", "wb") as out:
        out.write(b"left by an attempt that was lost")
    found = warc.manifests(spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, manifest.collect()))
    assert warc.read_records(found, folder).count() == len(ROWS)
    name = manifest.first().file
    data = open(f"{path}/{name}", "rb").read()
    with open(f"{path}/{name}", "wb") as out:  # same records, other bytes
        out.write(gzip.compress(gzip.decompress(data), 1, mtime=0))
    with pytest.raises(Exception, match="SHA-256|records"):
        warc.read_records(found, folder).count()


def shards(manifest):
    sizes = Counter()
    for r in manifest.collect():
        sizes[r.shard] += r.records
    return sizes


def test_far_dense_equal_and_null_ids_are_cut(spark):
    importable(spark)
    body = lambda k: f"{k} " * 300
    plain = [(k, f"u{k}", body(k)) for k in range(300)]
    make = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    options = {"shard_bytes": 30_000, "roll_bytes": 2_000}
    usual = shards(write(spark, make(plain), **options)[1])
    assert len(usual) > 8
    far = shards(write(spark, make([*plain, (10**15, "far", "far"), (2**62, "far", "far")]), **options)[1])
    assert len(far) >= len(usual) and max(far.values()) <= max(usual.values()) + 2
    odd = [*[(None, f"n{k}", body(-k)) for k in range(300)], *[(7, f"s{k}", body(1000 + k)) for k in range(300)], *[(None, f"e{k}", None) for k in range(300)]]
    folder, manifest = write(spark, make(odd), **options)
    cut = shards(manifest)
    assert len(cut) > 15 and max(cut.values()) < 120
    assert len(manifest.collect()) > 2 * len(cut)  # files roll inside shards
    found = warc.read_records(warc.manifests(spark, folder), folder).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == brute(odd)


def test_empty_table(spark, pages):
    folder, manifest = write(spark, pages.limit(0))
    assert manifest.count() == 0 and warc.read_records(manifest, folder).count() == 0
