"""Files as a table: listing, exact copies, and empty or broken files in a batch run and a stream."""

import gzip
import hashlib
import json
import os

from clickforge.sources import listing as L
from clickforge.streaming import ingest as I

OK = json.dumps({"user_id": "u", "session_id": "s", "query": "q", "results_count": 3, "timestamp": "2024-01-15T10:00:00Z"})
BAD = json.dumps({"user_id": "u", "session_id": None, "query": "q", "results_count": 3, "timestamp": "2024-01-15T10:00:00Z"})


def put(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def lines(*rows):
    return "".join(r + "\n" for r in rows).encode()


def tree(root):
    whole = gzip.compress(lines(*[OK] * 5000))
    put(f"{root}/d1/search.jsonl", lines(OK, BAD))
    put(f"{root}/d1/a b+c/search.jsonl", b"")
    put(f"{root}/d2/search.jsonl.gz", whole)
    put(f"{root}/d3/search.jsonl.gz", whole[:len(whole) // 2])
    put(f"{root}/d4/search.jsonl.gz", b"no gzip at all")
    put(f"{root}/d1/_SUCCESS", b"x")


def test_listing_sees_every_file(spark, tmp_dir):
    tree(f"{tmp_dir}/raw")
    got = {r.file_path: (r.file_size, r.broken) for r in L.list_tree(spark, f"{tmp_dir}/raw").collect()}
    size = os.path.getsize(f"{tmp_dir}/raw/d3/search.jsonl.gz")
    assert {k.split("/raw/")[1]: v for k, v in got.items()} == {
        "d1/search.jsonl": (len(lines(OK, BAD)), False), "d1/a%20b+c/search.jsonl": (0, False),
        "d2/search.jsonl.gz": (os.path.getsize(f"{tmp_dir}/raw/d2/search.jsonl.gz"), False),
        "d3/search.jsonl.gz": (size, True), "d4/search.jsonl.gz": (14, True)}
    scanned = spark.read.option("recursiveFileLookup", "true").text(f"{tmp_dir}/raw/d1").select("_metadata.file_path").distinct()
    assert {r[0] for r in scanned.collect()} <= set(got)
    assert L.list_tree(spark, f"{tmp_dir}/raw/d1/search.jsonl").count() == 1
    assert L.list_tree(spark, f"{tmp_dir}/missing").count() == 0


def test_a_wide_tree_is_dealt_out_in_passes(spark, tmp_dir):
    for i in range(1_100):
        put(f"{tmp_dir}/raw/{i % 50}/{i}/x.jsonl", b"x" * (i % 3))
    got = [(r.file_path.split("/raw/")[1], r.file_size) for r in L.list_tree(spark, f"{tmp_dir}/raw").collect()]
    assert sorted(got) == sorted((f"{i % 50}/{i}/x.jsonl", i % 3) for i in range(1_100))


def test_copies_are_exact(spark, tmp_dir):
    contents = {"a b/x.jsonl": b"one\r\ntwo\r\nno end", "y+z.jsonl.gz": gzip.compress(b"three"), "é.jsonl": b"\xff\xfe\x00", "e.jsonl": b""}
    for key, data in contents.items():
        put(f"{tmp_dir}/raw/{key}", data)
    files = L.list_tree(spark, f"{tmp_dir}/raw")
    files = files.selectExpr("file_path", "substring_index(url_decode(replace(file_path, '+', '%2B')), '/raw/', -1) AS key")
    for _ in range(2):  # a repeated task finds the first one's copies
        got = {r.key: (r.bytes, r.sha256) for r in L.copy_files(files, f"{tmp_dir}/q").collect()}
    assert got == {k: (len(d), hashlib.sha256(d).hexdigest()) for k, d in contents.items()}
    found = {os.path.relpath(os.path.join(d, f), f"{tmp_dir}/q") for d, _, names in os.walk(f"{tmp_dir}/q") for f in names}
    assert found == set(contents)
    assert all(open(f"{tmp_dir}/q/{k}", "rb").read() == d for k, d in contents.items())


def metrics(spark, out):
    df = spark.read.parquet(f"{out}/ingest_metrics")
    cols = [c for c in df.columns if c not in ("run_id", "stream", "batch_id")]
    return sorted(tuple(r[c] for c in sorted(cols)) for r in df.collect())


def test_stream_and_batch_count_the_same_files(spark, tmp_dir):
    raw = f"{tmp_dir}/raw"
    tree(raw)
    I.ingest_files(spark, raw, f"{tmp_dir}/b", "r", skip_unreadable=True)
    I.start_ingest_stream(spark, raw, f"{tmp_dir}/s", f"{tmp_dir}/c", skip_unreadable=True,
                          max_files_per_trigger=2).awaitTermination(300)
    want = metrics(spark, f"{tmp_dir}/b")
    assert metrics(spark, f"{tmp_dir}/s") == want and len(want) == 5
    m = spark.read.parquet(f"{tmp_dir}/s/ingest_metrics").selectExpr(
        "sum(EmptyFiles)", "sum(ProcessingErrors)", "sum(ValidRecords)", "sum(InvalidRecords)").first()
    assert tuple(m) == (1, 2, 1, 5001)  # the whole gzip file is of an unknown type, search.gz
    copies = {os.path.relpath(os.path.join(d, f), f"{tmp_dir}/b/quarantine_files/run_id=r/quarantine"): os.path.join(d, f)
              for d, _, names in os.walk(f"{tmp_dir}/b/quarantine_files") for f in names}
    assert set(copies) == {"d1/search.jsonl", "d2/search.jsonl.gz"}
    assert all(open(p, "rb").read() == open(f"{raw}/{k}", "rb").read() for k, p in copies.items())
