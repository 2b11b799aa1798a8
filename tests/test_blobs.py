"""Blob listing and checksum verification against the index."""

import hashlib
import os
import resource

import pyarrow as pa

from fleetlake.sources import blobs
from fleetlake.sources.blobs import scan_blobs, verify_blobs


def test_verify_blobs(spark, tmp_dir):
    root = os.path.join(tmp_dir, "store")
    keys = {
        "blob/audio/event_date=2024-01-01/event_hour=00/device_shard=01/device_id=device-001/e1.bin": b"abc",
        "blob/audio/event_date=2024-01-01/event_hour=00/device_shard=01/device_id=device-001/e2.bin": b"hello",
        "blob/audio/event_date=2024-01-01/event_hour=00/device_shard=01/device_id=device-001/e4.bin": b"stray",
    }
    for k, v in keys.items():
        os.makedirs(os.path.dirname(os.path.join(root, k)), exist_ok=True)
        with open(os.path.join(root, k), "wb") as fh:
            fh.write(v)
    k1, k2, k4 = list(keys)
    k3 = k1.replace("e1.bin", "e3.bin")
    man = spark.createDataFrame(
        [
            ("e1", f"s3://raw-blobs/{k1}", hashlib.sha256(b"abc").hexdigest(), 3),
            ("e2", f"s3://raw-blobs/{k2}", hashlib.sha256(b"other").hexdigest(), 5),
            ("e3", f"s3://raw-blobs/{k3}", "0" * 64, 1),
        ],
        "event_id string, blob_uri string, checksum_sha256 string, object_size long",
    )
    listing = scan_blobs(spark, root)
    assert listing.count() == 3 and "content" not in listing.columns
    got = {r["key"]: r["verify_status"] for r in verify_blobs(spark, man, root).collect()}
    assert got == {k1: "MATCH", k2: "MISMATCH", k3: "MISSING", k4: "UNINDEXED"}


def test_blob_beyond_two_gigabytes(spark, tmp_dir):
    size = (3 << 30) + 5
    path = os.path.join(tmp_dir, "store", "blob", "big.bin")
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as fh:  # sparse: no disk is used
        fh.seek(size - 1)
        fh.write(b"x")
    h = hashlib.sha256()
    with open(path, "rb") as fh:
        while chunk := fh.read(1 << 24):
            h.update(chunk)
    man = spark.createDataFrame([("e1", "s3://raw-blobs/blob/big.bin", h.hexdigest(), size)], "event_id string, blob_uri string, checksum_sha256 string, object_size long")
    listing = scan_blobs(spark, os.path.join(tmp_dir, "store"))
    assert [r["length"] for r in listing.collect()] == [size]
    (got,) = blobs.hash_blobs(listing).collect()
    assert (got["sha256"], got["bytes_read"]) == (h.hexdigest(), size)
    (row,) = verify_blobs(spark, man, os.path.join(tmp_dir, "store")).collect()
    assert row["verify_status"] == "MATCH"
    # the task's own code, here in this process: its memory is that of its chunks
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (batch,) = blobs._digests(8 << 20)(iter([pa.RecordBatch.from_pydict({"path": ["file:" + path]})]))
    assert batch.column(1).to_pylist() == [h.hexdigest()]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000  # KB


def test_blobs_are_dealt_by_bytes(spark):
    rows = [(f"p{i}", 1000 if i % 10 == 0 else 10) for i in range(300)] + [("big", 50_000)]
    files = spark.createDataFrame(rows, "path string, length long")
    dealt = blobs.deal_by_bytes(files, 4000, slots=4)
    parts = [sum(r["length"] for r in p) for p in dealt.rdd.glom().collect()]
    assert sum(parts) == sum(n for _, n in rows) and sorted(parts)[-1] <= 50_000 + 3 * 4000
    assert sorted(parts)[-2] <= 10_000 and len([p for p in parts if p]) >= 8
    assert blobs.deal_by_bytes(files.limit(0), 4000).count() == 0


def test_missing_file_has_no_hash(spark, tmp_dir):
    files = spark.createDataFrame([("file:" + os.path.join(tmp_dir, "gone.bin"), 3)], "path string, length long")
    assert [(r["sha256"], r["bytes_read"]) for r in blobs.hash_blobs(files).collect()] == [(None, None)]
