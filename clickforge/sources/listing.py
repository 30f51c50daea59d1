"""Listing, checking and copying of files inside tasks (V9, S5, ST1).

Folders are a table that tasks walk, in as many passes as the tree needs, so neither names nor bytes
pass through the driver. File systems are opened with ``pyarrow.fs`` by the scheme of the path;
folder names are given plainly, without wildcards. Names that Spark's scans skip (a leading
``_`` or ``.``) are skipped here too.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickforge.session import scratch_path

#: Bytes that a task holds of a file it copies or checks.
CHUNK = 1 << 22


def opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path on it, and the prefix that scans write before that path."""
    path = re.sub(r"^file:/+", "/", path)
    if path.startswith("/"):
        return fs.LocalFileSystem(), path, "file:"
    system, inner = fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    scheme, rest = path.split("://", 1)
    # object stores keep the bucket in the path, others the host in the prefix
    return system, inner, f"{scheme}://" + (rest.split("/", 1)[0] if inner.startswith("/") else "")


def escaped(path: str) -> str:
    """A path as the URI that scans report: illegal ASCII characters in ``%XX`` form."""
    return "".join(c if ord(c) > 127 or c.isalnum() or c in "_-!.~'()*,;:$&+=/@" else f"%{ord(c):02X}" for c in path)


def _is_broken(system: fs.FileSystem, info: fs.FileInfo) -> bool:
    """Whether a gzip file has bytes but can't be read to its end."""
    if not info.path.endswith(".gz") or not info.size:
        return False
    try:
        with system.open_input_stream(info.path, compression=None) as raw, gzip.GzipFile(fileobj=raw) as f:
            while f.read(CHUNK):
                pass
    except (EOFError, gzip.BadGzipFile, zlib.error):
        return True
    return False


#: Entries after which a task leaves the folders that it has not entered to the next pass.
WALK = 1_000


def _walked(path: str) -> Iterator[tuple[str, bool, int, bool]]:
    """What lies below a folder (or a file itself): path, whether it is a folder that was not entered,
    size, broken."""
    system, inner, prefix = opened(path)
    own = system.get_file_info(inner)
    if own.type == fs.FileType.File:
        yield prefix + escaped(inner), False, own.size, _is_broken(system, own)
        return
    waiting, seen = [inner] if own.type == fs.FileType.Directory else [], 0
    while waiting and seen < WALK:
        for info in system.get_file_info(fs.FileSelector(waiting.pop())):
            seen += 1
            if info.base_name.startswith(("_", ".")):
                continue
            if info.type == fs.FileType.Directory:
                waiting.append(info.path)
            else:
                yield prefix + escaped(info.path), False, info.size, _is_broken(system, info)
    for left in waiting:
        yield prefix + left, True, 0, False


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path in b.column(0).to_pylist():
            columns = list(zip(*_walked(path))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                columns, (pa.string(), pa.bool_(), pa.int64(), pa.bool_()))], ["path", "folder", "size", "broken"])


def list_tree(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file_path`` (as scans report it), ``file_size`` and ``broken`` (a gzip file that can't be read to
    its end) of every file below some folders, those of no bytes included. Tasks walk a folder until they
    have met ``WALK`` entries; the folders left are dealt out again in a next pass. What a pass finds
    is written, the driver sees only whether there is a next one."""
    roots = [paths] if isinstance(paths, str) else list(paths)
    level, files = spark.createDataFrame([(p,) for p in roots], "path string"), None
    while True:
        at = scratch_path(spark, f"listing-{uuid.uuid4().hex}")
        level.repartition("path").mapInArrow(_listed, "path string, folder boolean, size long, broken boolean") \
            .write.parquet(at)
        found = spark.read.schema("path string, folder boolean, size long, broken boolean").parquet(at)
        own = found.where("not folder").select(F.col("path").alias("file_path"), F.col("size").alias("file_size"), "broken")
        files = own if files is None else files.unionByName(own)
        level = found.where("folder").select("path")
        if level.isEmpty():
            return files


def copy_files(files: DataFrame, target: str) -> DataFrame:
    """Copy the files of ``files`` (``file_path`` as scans report it, ``key``) byte for byte to
    ``<target>/<key>``: ``file_path``, ``key``, ``bytes`` and ``sha256`` of what was copied. A copy is written
    beside its place and moved there when whole, so a task that is lost and repeated leaves
    the same files. Evaluated lazily: write the result."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from urllib.parse import unquote
        out, base, _ = opened(target)
        for b in batches:
            sizes, sums = [], []
            for path, key in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                system, inner, _ = opened(unquote(path))
                place = f"{base.rstrip('/')}/{key}"
                out.create_dir(place.rsplit("/", 1)[0], recursive=True)
                part, sha, n = f"{place}.{uuid.uuid4().hex}.part", hashlib.sha256(), 0
                with system.open_input_stream(inner, compression=None) as source, \
                        out.open_output_stream(part, compression=None) as sink:
                    while chunk := source.read(CHUNK):
                        sha.update(chunk)
                        sink.write(chunk)
                        n += len(chunk)
                out.move(part, place)
                sizes.append(n)
                sums.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(sums, pa.string())],
                                             ["file_path", "key", "bytes", "sha256"])

    return files.select("file_path", "key").repartition("key").mapInArrow(
        run, "file_path string, key string, bytes long, sha256 string")


def write_files(lines: DataFrame, target: str) -> DataFrame:
    """Write text files from ``lines`` (``key``, ``n`` for the order, ``line``; null lines are left out, so
    a key of null lines only is a file of no bytes): ``key`` and ``bytes``, once for each file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, base, _ = opened(target)
        key, sink, n, done = None, None, 0, ([], [])
        for b in batches:
            for own, line in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if own != key:
                    if sink is not None:
                        sink.close()
                        done[0].append(key)
                        done[1].append(n)
                    key, n, place = own, 0, f"{base.rstrip('/')}/{own}"
                    out.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    sink = out.open_output_stream(place, compression=None)
                if line is not None:
                    data = line.encode() + b"\n"
                    sink.write(data)
                    n += len(data)
        if sink is not None:
            sink.close()
            done[0].append(key)
            done[1].append(n)
        yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.string()), pa.array(done[1], pa.int64())], ["key", "bytes"])

    return lines.select("key", "n", "line").repartition("key").sortWithinPartitions("key", "n") \
        .mapInArrow(run, "key string, bytes long")
