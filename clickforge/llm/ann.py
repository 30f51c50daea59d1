"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and get one more coordinate that makes all norms one,
so the largest inner product is the least Euclidean distance. Each table hashes a vector by
``floor((a.x + b) / width)`` for a few Gaussian directions ``a``. A query visits its own
bucket of a table and then perturbed ones in the order of their estimated success: by the sum
of squared distances to the walls that a perturbation crosses. The candidates of all tables
are merged and ranked by the exact inner product of the original vectors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import saved

#: Distinct vectors of a bucket that are compared in one place; larger buckets are split.
BLOCK = 4_096
#: Queries that are compared with a block at a time.
QUERIES = 1_024


def probe_order(walls: np.ndarray, probes: int, width: float = 1.0) -> list[list[tuple[int, int]]]:
    """Perturbations, (direction, -1 or 1) each, in order of estimated success, the empty one
    first. ``walls`` has the distance to the lower wall of each direction."""
    steps = sorted([(d * d, j, -1) for j, d in enumerate(walls.tolist())]
                   + [((width - d) ** 2, j, 1) for j, d in enumerate(walls.tolist())])
    out, heap = [[]], [(steps[0][0], (0,))]
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        if len({steps[c][1] for c in chosen}) == len(chosen):
            out.append([steps[c][1:] for c in chosen])
        last = chosen[-1]
        if last + 1 < len(steps):  # move the last step on, or add the next one
            more = steps[last + 1][0]
            heapq.heappush(heap, (cost - steps[last][0] + more, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + more, (*chosen, last + 1)))
    return out


class Hashes:
    """The hash functions of all tables, for vectors of one dimension."""

    def __init__(self, dim: int, largest: float, tables: int, directions: int, width: float,
                 probes: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a = rng.standard_normal((tables, directions, dim + 1))
        self.b = rng.random((tables, directions)) * width
        self.mix = rng.integers(1, 1 << 62, directions, dtype=np.int64) | 1
        self.largest, self.width, self.probes = largest, width, probes

    def _cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.einsum("tkd,nd->ntk", self.a, points) + self.b
        cells = np.floor(at / self.width)
        return cells.astype(np.int64), at - cells * self.width

    def keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((cells * self.mix).sum(axis=-1) * np.int64(31) + table) ^ np.int64(table << 56)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Bucket keys of vectors, a column a table."""
        x = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(1, keepdims=True)))
        cells, _ = self._cells(np.hstack((x, rest)))
        return np.stack([self.keys(cells[:, t], t) for t in range(len(self.a))], axis=1)

    def visits(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the bucket keys it visits, of all tables."""
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        cells, walls = self._cells(np.hstack((x, np.zeros((len(x), 1)))))
        for own, near in zip(cells, walls):
            out = []
            for t in range(len(self.a)):
                order = probe_order(near[t], self.probes, self.width)
                visited = np.repeat(own[t][None], len(order), axis=0)
                for i, moves in enumerate(order):
                    for j, step in moves:
                        visited[i, j] += step
                out.append(self.keys(visited, t))
            yield np.unique(np.concatenate(out))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v, "<f8") for v in column.to_pylist()])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (array of double) of the rows that can take part: an id, and a vector
    without null or non-finite components that is not zero. Exact repeats are one row."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"),
                          F.col(vector_col).cast("array<double>").alias("v")).where("id is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0)).distinct()


def _rows(points: DataFrame, hashes: Hashes, queries: bool) -> DataFrame:
    """A row for each bucket of a vector (``ids``, ``v``): its key ``b``, ``ids``, packed ``v``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                x = np.array(part.column(1).to_pylist(), np.float64)
                keys = list(hashes.visits(x) if queries else hashes.buckets(x))
                of = np.repeat(np.arange(len(x)), [len(k) for k in keys])
                packed = pa.array([r.astype("<f8").tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), part.column(0).take(pa.array(of)),
                     packed.take(pa.array(of))], ["b", "ids", "v"])

    return points.select("ids", "v").mapInArrow(run, "b long, ids array<bigint>, v binary")


def _nearest(base: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``score``, ``ids`` (equal vectors) of the ``k + 1`` nearest base vectors of
    each query within each group ``g``, ties included."""
    both = base.select("g", F.lit(0).alias("kind"), "ids", "v").unionAll(
        asked.select("g", F.lit(1).alias("kind"), "ids", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, ids, block = None, [], [], None
        for b in batches:
            g, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero((g[1:] != g[:-1]) | (kind[1:] != kind[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(g)]):
                if s == e:
                    continue
                if g[s] != group:
                    group, held, ids, block = g[s], [], [], None
                if kind[s] == 0:  # at most a block of base vectors, before the queries
                    held.append(_matrix(b.column(3).slice(s, e - s)))
                    ids += b.column(2).slice(s, e - s).to_pylist()
                elif held:
                    block = np.concatenate(held) if block is None else block
                    for at in range(s, e, QUERIES):
                        yield best(b.slice(at, min(QUERIES, e - at)), block, ids)

    def best(part, block, ids):
        scores = _matrix(part.column(3)) @ block.T
        if block.shape[0] > k + 1:
            floor = -np.partition(-scores, k, axis=1)[:, k]
            q, at = np.nonzero(scores >= floor[:, None])
        else:
            q, at = np.nonzero(np.ones(scores.shape, bool))
        own = np.array([x[0] for x in part.column(2).to_pylist()], np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(own[q]), pa.array(scores[q, at]),
             pa.array([ids[i] for i in at.tolist()], pa.list_(pa.int64()))], ["query_id", "score", "ids"])

    return both.repartition("g").sortWithinPartitions("g", "kind").mapInArrow(
        run, "query_id long, score double, ids array<bigint>")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query over all groups: each equal-vector set once, then ids."""
    # ids with several vectors may share their least id with other sets, but not all ids
    one = found.groupBy("query_id", "ids").agg(F.max("score").alias("score"))
    top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return one.select("query_id", "score", F.explode("ids").alias("vec_id")) \
        .where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def _dealt(base: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Base and query rows by group: the bucket, or a block of a large bucket."""
    hot = saved(base.groupBy("b").count().where(F.col("count") > BLOCK).select(
        "b", F.ceil(F.col("count") / (BLOCK // 2)).cast("int").alias("s")), "hot-buckets")
    part = F.coalesce(F.pmod(F.xxhash64("v"), F.col("s")).cast("int"), F.lit(0))
    every = F.sequence(F.lit(0), F.coalesce(F.col("s"), F.lit(1)) - 1)
    group = F.xxhash64("b", "part").alias("g")
    return (base.join(hot, "b", "left").withColumn("part", part).select(group, "ids", "v"),
            asked.join(hot, "b", "left").withColumn("part", F.explode(every)).select(group, "ids", "v"))


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", tables: int = 4, directions: int = 3, width: float = 1.0,
           probes: int = 32, seed: int = 7) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` (inner product, double) of the
    ``k`` nearest found of each query among ``vectors``, its own id left out, ties to the
    smaller id; all others, if fewer than ``k``.

    Rows with a null id, and vectors that are null, empty, zero, or hold null or non-finite
    components take no part, nor do vectors of another dimension than most (the larger of
    two as frequent). An id with several vectors has its nearest one counted. Other columns
    are ignored; empty tables give no rows. Equal vectors are hashed and compared once, with
    the ``k + 1`` least ids, which are all that can be among the nearest. Queries that find
    fewer than ``k`` are compared with all vectors, block by block.
    """
    spark = vectors.sparkSession
    clean = saved(usable(vectors, id_col, vector_col), "vectors")
    dims = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if dims is None:
        return empty
    own = clean.where(F.size("v") == dims["d"])
    largest = own.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))).first()[0]
    least = Window.partitionBy("v").orderBy("id")
    base = own.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1) \
        .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    base = saved(base, "distinct-vectors")
    asked = usable(queries, id_col, vector_col).where(F.size("v") == dims["d"]) \
        .select(F.array("id").alias("ids"), "v")
    asked = saved(asked, "queries")
    hashes = Hashes(dims["d"], largest, tables, directions, width, probes, seed)
    found = saved(_merged(_nearest(*_dealt(_rows(base, hashes, False), _rows(asked, hashes, True)), k), k),
                  "found")
    others = own.select("id").distinct().count() - 1
    short = asked.select(F.get("ids", F.lit(0)).alias("query_id"), "ids", "v").join(
        found.groupBy("query_id").count(), "query_id", "left") \
        .where(F.coalesce("count", F.lit(0)) < min(k, others))
    short = saved(short.select("query_id", "ids", "v"), "short-queries")
    if short.isEmpty():
        return found
    blocks = -(-base.count() // BLOCK) * 2
    pack = F.udf(lambda v: np.array(v, "<f8").tobytes(), "binary")
    rest = _nearest(base.select(F.pmod(F.xxhash64("v"), F.lit(blocks)).alias("g"), "ids", pack("v").alias("v")),
                    short.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("g"),
                                 "ids", pack("v").alias("v")), k)
    return found.join(short.select("query_id").distinct(), "query_id", "left_anti") \
        .unionAll(_merged(rest, k).select(*found.columns))
