"""Ingest runs over real files: batch vs stream equality (ST1), quarantine (S5),
idempotent re-runs, day-partition sinks (S3, S4) and the mixed-feed split (S6)."""

import json
import os

from pyspark.sql import functions as F

from clickforge.sources import files as FS
from clickforge.sources import raw as R
from clickforge.streaming import ingest as I

OK = {"event_type": "page_view", "user_id": "u1", "session_id": "s1", "page_url": "/home",
      "page_type": "home", "timestamp": "2024-01-15T10:00:00+00:00",
      "time_on_page_seconds": 30, "referrer": "", "device_type": "mobile", "country": "ES"}
BAD = {**OK, "page_type": "blog", "time_on_page_seconds": 0}


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def _raw_tree(root):
    day = os.path.join(root, "year=2024", "month=01", "day=15")
    _write(os.path.join(day, "page_view.jsonl"), [OK, "", "not json", BAD, {"user_id": "u2"}])
    _write(os.path.join(day, "cart_event.jsonl"),
           [{"user_id": "u1", "session_id": "s1", "product_id": "P1", "action": "add",
             "timestamp": "2024-01-15T10:05:00+00:00"}])
    _write(os.path.join(day, "click.jsonl"), [""])
    _write(os.path.join(root, "quarantine", "old", "page_view.jsonl"), [BAD])
    many = [{**BAD, "user_id": f"u{i}"} for i in range(150)]
    _write(os.path.join(root, "year=2024", "month=01", "day=16", "page_view.jsonl"), many)


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_batch_and_stream_agree(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _raw_tree(raw)
    summary = I.ingest_files(spark, raw, os.path.join(tmp_dir, "b"), "r1", root=raw)
    assert summary == {"processed_files": 3, "total_errors": 9 + 300}
    q = I.start_ingest_stream(spark, raw, os.path.join(tmp_dir, "s"),
                              checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(300)
    cols = ["file_path", "EmptyFiles", "FilesProcessed", "FilesWithErrors",
            "InvalidRecords", "ValidRecords", "FileSizeBytes"]
    b = spark.read.parquet(os.path.join(tmp_dir, "b", "ingest_metrics"))
    s = spark.read.parquet(os.path.join(tmp_dir, "s", "ingest_metrics"))
    assert _rows(b, *cols) == _rows(s, *cols)
    assert b.filter(F.col("file_path").contains("quarantine/")).count() == 0
    eb = spark.read.json(os.path.join(tmp_dir, "b", "quarantine_errors"))
    es = spark.read.json(os.path.join(tmp_dir, "s", "quarantine_errors"))
    assert _rows(eb, "source_key", "error_count") == _rows(es, "source_key", "error_count")


def test_quarantine_documents(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _raw_tree(raw)
    out = os.path.join(tmp_dir, "o")
    I.ingest_files(spark, raw, out, "r1", root=raw)
    meta = {r["source_key"]: r for r in
            spark.read.json(os.path.join(out, "quarantine_errors")).collect()}
    assert set(meta) == {"year=2024/month=01/day=15/page_view.jsonl",
                         "year=2024/month=01/day=16/page_view.jsonl"}
    big = meta["year=2024/month=01/day=16/page_view.jsonl"]
    assert big["error_count"] == 300 and len(big["errors"]) == 100
    assert [e["record_index"] for e in big["errors"][:4]] == [0, 0, 1, 1]
    assert big["quarantine_key"] == "quarantine/" + big["source_key"]
    assert big["error_key"].endswith(".jsonl.errors.json")
    small = meta["year=2024/month=01/day=15/page_view.jsonl"]
    assert [e["record_index"] for e in small["errors"]] == [1, 1] + [2] * 7
    lines = spark.read.parquet(os.path.join(out, "quarantine_lines")) \
        .filter(F.col("source_key") == small["source_key"]) \
        .orderBy("block_start", "line_id").select("line").collect()
    assert len(lines) == 5 and lines[2]["line"] == "not json"


def test_rerun_is_idempotent(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _raw_tree(raw)
    out = os.path.join(tmp_dir, "o")
    first = I.ingest_files(spark, raw, out, "r1", root=raw)
    again = I.ingest_files(spark, raw, out, "r1", root=raw)
    assert first == again
    m = spark.read.parquet(os.path.join(out, "ingest_metrics"))
    assert m.count() == 4


def test_a_repaired_file_leaves_no_stale_output(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "o")
    name = os.path.join(raw, "year=2024", "page_view.jsonl")
    _write(name, [OK, BAD])
    assert I.ingest_files(spark, raw, out, "r1")["total_errors"] == 2
    assert spark.read.parquet(os.path.join(out, "validation_errors")).count() == 2
    _write(name, [OK, OK])
    assert I.ingest_files(spark, raw, out, "r1") == {"processed_files": 1, "total_errors": 0}
    for table, n in (("validation_errors", 0), ("quarantine_lines", 0), ("valid_events", 2)):
        assert spark.read.schema("file_path string").parquet(os.path.join(out, table)).count() == n
    assert spark.read.schema("source_key string").json(os.path.join(out, "quarantine_errors")).count() == 0


def test_every_error_is_written(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "o")
    _raw_tree(raw)
    I.ingest_files(spark, raw, out, "r1")
    assert spark.read.parquet(os.path.join(out, "validation_errors")).count() == 309


def test_odd_paths_and_files(spark, tmp_dir):
    """A root below a folder named quarantine, a plus sign, a zero-byte file, an unreadable one."""
    raw, out = os.path.join(tmp_dir, "quarantine", "raw"), os.path.join(tmp_dir, "o")
    _write(os.path.join(raw, "a+b c", "page_view.jsonl"), [BAD])
    _write(os.path.join(raw, "quarantine", "page_view.jsonl"), [BAD])
    open(os.path.join(raw, "click.jsonl"), "w").close()
    with open(os.path.join(raw, "search.jsonl.gz"), "wb") as f:
        f.write(b"no gzip at all")
    got = I.ingest_files(spark, raw, out, "r1", skip_unreadable=True)
    assert got == {"processed_files": 1, "total_errors": 2}
    m = {os.path.basename(r.file_path): r for r in spark.read.parquet(os.path.join(out, "ingest_metrics")).collect()}
    assert set(m) == {"page_view.jsonl", "click.jsonl", "search.jsonl.gz"}
    assert (m["click.jsonl"].EmptyFiles, m["click.jsonl"].ProcessingErrors) == (1, 0)
    assert (m["search.jsonl.gz"].EmptyFiles, m["search.jsonl.gz"].ProcessingErrors) == (0, 1)
    keys = [r.source_key for r in spark.read.json(os.path.join(out, "quarantine_errors")).collect()]
    assert keys == ["a+b c/page_view.jsonl"]
    os.makedirs(os.path.join(tmp_dir, "none"))
    assert I.ingest_files(spark, os.path.join(tmp_dir, "none"), out, "r2") == {"processed_files": 0, "total_errors": 0}


def test_two_streams_into_one_folder(spark, tmp_dir):
    out = os.path.join(tmp_dir, "s")
    for name, n in (("x", 3), ("y", 2)):
        for i in range(n):
            _write(os.path.join(tmp_dir, name, str(i), "page_view.jsonl"), [OK, BAD])
        I.start_ingest_stream(spark, os.path.join(tmp_dir, name), out, os.path.join(tmp_dir, f"ckpt-{name}"),
                              max_files_per_trigger=1).awaitTermination(300)
    # a lost checkpoint starts at batch 0 again and writes beside the earlier output
    I.start_ingest_stream(spark, os.path.join(tmp_dir, "y"), out, os.path.join(tmp_dir, "ckpt-new")).awaitTermination(300)
    m = spark.read.parquet(os.path.join(out, "ingest_metrics"))
    assert m.count() == 7 and m.select("stream").distinct().count() == 3
    assert m.select("file_path").distinct().count() == 5


def test_day_partition_sink_overwrites_only_its_days(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-15", "a", 1), ("2024-01-16", "b", 2)],
                               "d string, k string, v int") \
        .withColumn("event_date", F.to_date("d")).drop("d")
    FS.write_days(df, tmp_dir, "m")
    FS.write_days(df.filter("k = 'a'").withColumn("v", F.lit(10)), tmp_dir, "m")
    FS.write_days(df.filter("k = 'a'").withColumn("v", F.lit(10)), tmp_dir, "m")
    got = _rows(FS.read_days(spark, tmp_dir, "m"), "k", "v")
    assert got == [("a", 10), ("b", 2)]
    one = FS.read_days(spark, tmp_dir, "m", "2024-01-16")
    assert _rows(one, "k", "v") == [("b", 2)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_split_by_type_round_trip(spark, tmp_dir):
    ev = spark.createDataFrame(
        [("page_view", "u1", "2024-01-15"), ("click", "u2", "2024-01-15"),
         ("page_view", "u3", "2024-01-16")], "event_type string, user_id string, d string") \
        .withColumn("event_date", F.to_date("d")).drop("d")
    out = os.path.join(tmp_dir, "split")
    FS.split_by_type(ev, out)
    text = spark.read.option("recursiveFileLookup", "true").text(out)
    typed = R.text_with_metadata(text).select(
        R.event_type_from_path(F.col("file_path")).alias("et"),
        F.get_json_object("line", "$.user_id").alias("u"))
    assert _rows(typed, "et", "u") == [("click", "u2"), ("page_view", "u1"),
                                       ("page_view", "u3")]


def test_stream_restart_processes_only_new_files(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _raw_tree(raw)
    out, ckpt = os.path.join(tmp_dir, "s"), os.path.join(tmp_dir, "ckpt")
    I.start_ingest_stream(spark, raw, out, checkpoint=ckpt).awaitTermination(300)
    I.start_ingest_stream(spark, raw, out, checkpoint=ckpt).awaitTermination(300)
    m = spark.read.parquet(os.path.join(out, "ingest_metrics"))
    assert m.count() == 4 and m.select("batch_id").distinct().count() == 1
    _write(os.path.join(raw, "year=2024", "month=01", "day=17", "page_view.jsonl"), [OK, BAD])
    I.start_ingest_stream(spark, raw, out, checkpoint=ckpt).awaitTermination(300)
    m = spark.read.parquet(os.path.join(out, "ingest_metrics"))
    new = m.filter(F.col("batch_id") == 1).collect()
    assert len(new) == 1 and new[0]["file_path"].endswith("day=17/page_view.jsonl")
    assert (new[0]["ValidRecords"], new[0]["InvalidRecords"]) == (1, 2)
    assert m.count() == 5


def test_event_type_from_path_forms(spark):
    df = spark.createDataFrame(
        [("s3a://b/raw/year=2024/month=01/day=15/page_view.jsonl",),
         ("file:/x/out/event_date=2024-01-15/event_type=click/part-0000.json",),
         ("raw/year=2024/month=01/day=15/cart%5Fevent.jsonl",)], "p string")
    got = [r[0] for r in df.select(R.event_type_from_path(F.col("p"))).collect()]
    assert got == ["page_view", "click", "cart_event"]
