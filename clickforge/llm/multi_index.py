"""Near-duplicate vectors of one label by an inverted multi-index.

Vectors are scaled to unit length and cut in two halves, each with a codebook of its own; the
product of the codebooks is a grid of cells. A vector lies in the cell of its two nearest
centroids and visits the cells around it in multi-sequence order, by the sum of the squared
distances of the halves to the centroids, until that sum exceeds its own cell's by a margin. The
margin is fitted so that a target share of pairs just at the threshold would meet. Vectors that
meet in a cell are verified by their exact cosine, in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import free_name, saved
from clickforge.llm.components import connected_components

#: Distinct vectors that the codebooks are fitted on, at most (those of the least hash).
SAMPLE = 20_000
#: Base vectors of a cell that are compared in one place, and visitors that meet them there;
#: larger cells are split.
BLOCK, VISITORS = 512, 4_096


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, also where their squares would overflow or vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None]
    return np.maximum(d, 0.0)


def codebook(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` centroids of ``x`` by Lloyd's rounds; an empty one moves to the farthest vector."""
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        d = _squared(x, centroids)
        of = d.argmin(1)
        for j in range(len(centroids)):
            own = of == j
            centroids[j] = x[own].mean(0) if own.any() else x[d.min(1).argmax()]
    return centroids


class Index:
    """Codebooks of both halves and the margin of the traversal."""

    def __init__(self, sample: np.ndarray, k: int, threshold: float, target: float, seed: int):
        rng = np.random.default_rng(seed)
        self.cut = (sample.shape[1] + 1) // 2
        halves = sample[:, :self.cut], sample[:, self.cut:]
        self.books = [codebook(h, k, 8, rng) for h in halves]
        self.margin = self._fitted_margin(sample[:4_000], threshold, target, rng)

    def distances(self, x: np.ndarray) -> list[np.ndarray]:
        return [_squared(x[:, :self.cut], self.books[0]), _squared(x[:, self.cut:], self.books[1])]

    def _fitted_margin(self, x: np.ndarray, threshold: float, target: float, rng) -> float:
        """The margin with which ``target`` of random neighbours just at the threshold are met
        from either side."""
        turned = rng.standard_normal(x.shape)
        turned -= (turned * x).sum(1, keepdims=True) * x
        lengths = np.linalg.norm(turned, axis=1, keepdims=True)
        y = threshold * x + np.sqrt(1 - threshold ** 2) * np.divide(turned, lengths, where=lengths > 0, out=turned)
        a, b = self.distances(x), self.distances(y)

        def needed(own, other):
            rows = np.arange(len(x))
            return sum(o[rows, p.argmin(1)] - o.min(1) for o, p in zip(own, other))

        return float(np.quantile(np.minimum(needed(a, b), needed(b, a)), target)) + 1e-9

    def visits(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each vector the cells it visits, its own first."""
        d1, d2 = self.distances(x)
        wide = len(self.books[1])
        for a, b in zip(d1, d2):
            yield np.fromiter((i * wide + j for _, i, j in multi_sequence(a, b, self.margin)), np.int64)


def multi_sequence(a: np.ndarray, b: np.ndarray, margin: float) -> Iterator[tuple[float, int, int]]:
    """Pairs of places of ``a`` and ``b`` by ascending sum, up to ``margin`` above the least."""
    by_a, by_b = a.argsort(kind="stable").tolist(), b.argsort(kind="stable").tolist()
    a, b = a.tolist(), b.tolist()
    most = a[by_a[0]] + b[by_b[0]] + margin
    heap = [(a[by_a[0]] + b[by_b[0]], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > most:
            return
        yield total, by_a[i], by_b[j]
        if j + 1 < len(by_b):
            heapq.heappush(heap, (a[by_a[i]] + b[by_b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(by_a):
            heapq.heappush(heap, (a[by_a[i + 1]] + b[by_b[0]], i + 1, 0))


def _matrix(packed: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), kind).reshape(len(packed), -1).astype(np.float64)


def packed_vectors(rows: DataFrame, kind: str) -> DataFrame:
    """``row``, ``label`` and ``v``, the vector's bytes, of the rows (``row``, ``label``, ``vector``)
    that can link: a label, and a vector without null or non-finite components that is not zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [])
            for row, label, vector in zip(b.column(0), b.column(1).to_pylist(), b.column(2)):
                if label is None or not vector.is_valid or vector.values.null_count or not len(vector.values):
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(kind)
                if np.isfinite(x).all() and x.any():
                    for column, value in zip(out, (row.as_py(), label, (x + 0.0).tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], b.schema.field(1).type),
                                              pa.array(out[2], pa.binary())], ["row", "label", "v"])

    label = dict(rows.dtypes)["label"]
    return rows.select("row", "label", "vector").mapInArrow(run, f"row long, label {label}, v binary")


def _placed(classes: DataFrame, index: Index, kind: str) -> DataFrame:
    """``node``, ``label``, ``copies``, ``v`` and ``cells``: the vector's own cell, then those it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1_024):
                part = b.slice(at, 1_024)
                cells = pa.array(list(index.visits(unit(_matrix(part.column(3), kind)))), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, cells], ["node", "label", "copies", "v", "cells"])

    label = dict(classes.dtypes)["label"]
    return classes.select("node", "label", "copies", "v").mapInArrow(
        run, f"node long, label {label}, copies long, v binary, cells array<bigint>")


def _dealt(placed: DataFrame) -> DataFrame:
    """Base vectors (kind 0, in their own cell) and visitors (kind 1, in every cell they visit, their
    own included) by ``g``, a block of a cell. A cell of many vectors or visitors is many blocks
    of both, so that each pair meets in one."""
    own = F.get("cells", F.lit(0))
    visits = placed.select("label", F.explode("cells").alias("cell"), "node", "copies", "v", "cells")
    sizes = placed.groupBy("label", own.alias("cell")).agg(F.count("*").alias("n"))
    counts = visits.groupBy("label", "cell").agg(F.count("*").alias("m"))
    split = saved(sizes.join(counts, ["label", "cell"]).select(
        "label", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("bases"),
        F.ceil(F.col("m") / VISITORS).cast("int").alias("parts")), "cell-blocks")

    def upto(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    def block(n):
        return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")

    base = placed.withColumn("cell", own).join(split, ["label", "cell"]) \
        .select("label", "cell", block("bases").alias("at"), F.explode(upto("parts")).alias("part"), F.lit(0).alias("kind"),
                "node", "copies", "v", "cells")
    # cells without a vector of the label have no row in `split`: nothing to meet there
    guests = visits.join(split, ["label", "cell"]).select(
        "label", "cell", F.explode(upto("bases")).alias("at"), block("parts").alias("part"), F.lit(1).alias("kind"),
        "node", "copies", "v", "cells")
    return base.unionAll(guests)


def _links(dealt: DataFrame, threshold: float, kind: str) -> DataFrame:
    """For every block the vectors with links in it: ``node``, ``n`` (rows it links with there) and
    ``root`` (one node that those links join it to): no list of pairs.

    A pair of two cells may be met in both; it counts in the one of the lesser number, if both
    are visited, and in one cell only from the side of the lesser node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, base, block = None, [], None
        for b in batches:
            key, role = list(zip(*(b.column(k).to_pylist() for k in range(4)))), b.column(4).to_numpy()
            s = 0
            while s < len(key):
                e = s
                while e < len(key) and key[e] == key[s] and role[e] == role[s]:
                    e += 1
                if key[s] != group:
                    group, base, block = key[s], [], None
                part = pa.Table.from_batches([b.slice(s, e - s)])
                if role[s] == 0:
                    base.append(part)
                elif base:
                    block = _Block(pa.concat_tables(base), group[1], kind) if block is None else block
                    for at in range(0, e - s, 1_024):
                        yield block.links(part.slice(at, 1_024), threshold)
                s = e

    key = ["label", "cell", "at", "part"]
    return dealt.repartition(*key).sortWithinPartitions(*key, "kind").select(*key, "kind", "node", "copies", "v", "cells") \
        .mapInArrow(run, "node long, n long, root long")


class _Block:
    """Base vectors of one block of a cell."""

    def __init__(self, rows: pa.Table, cell: int, kind: str):
        self.cell, self.kind = cell, kind
        self.nodes, self.copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        self.units = unit(_matrix(rows["v"].combine_chunks(), kind))
        self.visits = [set(c) for c in rows["cells"].to_pylist()]

    def links(self, rows: pa.Table, threshold: float) -> pa.RecordBatch:
        nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        homes = np.array([c[0] for c in rows["cells"].to_pylist()], np.int64)
        near = unit(_matrix(rows["v"].combine_chunks(), self.kind)) @ self.units.T >= threshold
        for home in np.unique(homes[near.any(1)]).tolist():
            own = homes == home
            if home == self.cell:
                near[own] &= nodes[own][:, None] < self.nodes[None]
            elif home < self.cell:  # pairs that meet there too
                near[own] &= ~np.array([home in v for v in self.visits])[None]
        x, y = near.any(1), near.any(0)
        near, guests, hosts = near[x][:, y], nodes[x], self.nodes[y]
        n = np.concatenate((near @ self.copies[y], near.T @ copies[x]))
        both, root = np.concatenate((guests, hosts)), None
        of_guest, of_host = guests, hosts
        top = np.iinfo(np.int64).max
        while len(both):  # the least node that the block's links reach
            of_host = np.minimum(of_host, np.where(near, of_guest[:, None], top).min(0))
            of_guest = np.minimum(of_guest, np.where(near, of_host[None], top).min(1))
            now = np.concatenate((of_guest, of_host))
            if root is not None and (now == root).all():
                break
            root = now
        return pa.RecordBatch.from_arrays([pa.array(both, pa.int64()), pa.array(n, pa.int64()), pa.array(
            root if root is not None else [], pa.int64())], ["node", "n", "root"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", centroids: int | None = None, target: float = 0.999,
                    sample: int = SAMPLE, seed: int = 11) -> DataFrame:
    """The columns of ``vectors`` and ``n_links`` (other rows of its label with a cosine of at least
    ``threshold``, as far as found), ``component_id`` (the least id reachable by links, its own
    included) and ``kept`` (its id is that one).

    A pair of cosine just at the threshold is met with probability ``target``, if neighbours lie
    in random directions; nearer ones with a higher one. No pair below is linked. Vectors that are
    null, empty, zero or hold null or non-finite components, vectors without a label, and vectors of
    another dimension than most (the larger of two as frequent) link with nothing. Equal vectors
    of a label are one node; a row with a null id is a node like any other, and never the least.
    An empty table gives no rows. Columns named like the results are replaced.

    ``centroids`` a half default to the root of a sixteenth of the largest label's distinct
    vectors (4 to 512), so that cells stay small as the table grows. The codebooks are fitted on
    ``sample`` vectors at most; every row is indexed.
    """
    kind = "<f4" if dict(vectors.dtypes)[vector_col] == "array<float>" else "<f8"
    element = "float" if kind == "<f4" else "double"
    key = free_name(vectors, "_row")
    rows = saved(vectors.withColumn(key, F.monotonically_increasing_id()), "vectors")
    packed = packed_vectors(rows.select(F.col(key).alias("row"), F.col(label_col).alias("label"),
                                        F.col(vector_col).cast(f"array<{element}>").alias("vector")), kind)
    packed = saved(packed.withColumn("h", F.sha2("v", 256)), "packed-vectors")
    dims = packed.groupBy(F.octet_length("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    own = packed.where(F.octet_length("v") == (dims["d"] if dims else 0))
    classes = own.groupBy("label", "h").agg(F.any_value("v").alias("v"), F.min("row").alias("node"),
                                            F.count("*").alias("copies"))
    classes = saved(classes, "vector-classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    if most:
        some = classes.orderBy(F.xxhash64("h"), "h").limit(sample).select("v").toArrow()
        k = centroids or int(np.clip(round((most / 16) ** 0.5), 4, 512))
        index = Index(unit(_matrix(some["v"].combine_chunks(), kind)), k, threshold, target, seed)
        placed = saved(_placed(classes, index, kind), "placed-vectors")
        links = saved(_links(_dealt(placed), threshold, kind), "vector-links")
    else:
        links = rows.sparkSession.createDataFrame([], "node long, n long, root long")
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    nodes = classes.select("label", "h", "node", "copies").join(counts, "node", "left").join(roots, "node", "left") \
        .select("label", "h", F.coalesce("root", "node").alias("root"),
                (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    linked = own.join(nodes, ["label", "h"]).select(F.col("row").alias(key), "root", "n_links")
    linked = saved(rows.select(key, F.col(id_col).alias("id")).join(linked, key, "left").select(
        key, "id", F.coalesce("root", key).alias("root"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")),
        "linked-rows")
    least = linked.groupBy("root").agg(F.min("id").alias("component_id"))
    found = linked.join(least, "root").select(key, "n_links", "component_id", F.col("id").eqNullSafe(
        F.col("component_id")).alias("kept"))
    results = ("n_links", "component_id", "kept")
    return rows.drop(*results).join(found, key).drop(key)
