"""SimHash near-duplicate detection, with links found by pigeonring filtering.

Every text gets a 64-bit fingerprint over its word shingles. Two fingerprints link when they
differ in at most ``max_bits`` bits. The bits are cut into ``segments`` laid out in a ring.
If the whole distance is at most tau, then there is a segment from which every chain of l
consecutive segments differs in at most floor(l * tau / m) bits. So for each start, and for
each set of segments within the chain that those proportional budgets allow to differ, the
values of the remaining segments form a lookup key: linked fingerprints share at least one.
Candidates that share a key are pruned chain by chain before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import free_name, row_hash, saved
from clickforge.llm.components import connected_components

#: Shingles hashed at a time, so that a very long text needs bounded memory.
SHINGLE_BLOCK = 65_536
#: Fingerprints of one key that are compared in one place; larger groups are split.
BLOCK = 4_096
#: Groups up to this size give all their links, larger ones a spanning forest.
SMALL = 8


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of one text as an unsigned 64-bit integer; 0 for a text without words."""
    from xxhash import xxh64_digest

    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not ws:
        return 0
    n, bits = max(1, len(ws) - shingle + 1), np.zeros((8, 256), np.int64)
    for at in range(0, n, SHINGLE_BLOCK):
        part = ws[at:at + SHINGLE_BLOCK + shingle - 1]
        joined, count = b" ".join(part), max(1, len(part) - shingle + 1)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        cuts = zip(starts[:count].tolist(), ends[len(part) - count:].tolist(), strict=True)
        hashes = b"".join([xxh64_digest(joined[s:e], seed) for s, e in cuts])
        octets = np.frombuffer(hashes, np.uint8).reshape(-1, 8).astype(np.int64)
        octets += np.arange(0, 2048, 256)
        bits += np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    ones = bits @ _BIT_OF  # by byte (most significant first), then bit
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


_BIT_OF = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """``id_col`` and ``fp`` (the fingerprint as a signed long) of every row. Rows keep their
    ids as they are, null ones included; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))],
                                             [b.schema.names[0], "fp"])

    kept = docs.select(id_col, F.col(text_col).cast("string").alias("_text"))
    return kept.mapInArrow(run, kept.select(id_col, F.lit(0).cast("long").alias("fp")).schema)


class Pigeonring:
    """Segments, chain budgets and lookup keys for a bit distance of at most ``tau``."""

    def __init__(self, tau: int = 4, segments: int = 7):
        if not 0 <= tau < segments <= 64:
            raise ValueError("needs 0 <= max_bits < segments <= 64")
        self.tau, self.m = tau, segments
        ends = [64 * i // segments for i in range(segments + 1)]
        self.masks = [(1 << e) - (1 << s) for s, e in zip(ends, ends[1:])]
        # budgets[l]: bits in which the first l segments of a viable chain may differ
        self.budgets = [n * tau // segments for n in range(segments + 1)]
        length = max(1, segments - 1)  # longer chains are checked, not looked up
        differ = [d for d in combinations(range(length), self.budgets[length])
                  if all(sum(x < n for x in d) <= self.budgets[n] for n in range(length + 1))]
        self.keys = [(s, sum(self.masks[(s + i) % segments] for i in range(length)
                             if i not in d)) for s in range(segments) for d in differ]

    def linked(self, differing: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of XORed pairs, those whose chains from their start stay within budget up to the
        whole ring, which is the full Hamming check."""
        masks = np.array(self.masks, np.uint64)
        alive, sums = np.arange(len(differing)), np.zeros(len(differing), np.int64)
        for n in range(1, self.m + 1):
            own = masks[(starts[alive] + n - 1) % self.m]
            sums = sums + np.bitwise_count(differing[alive] & own)
            near = sums <= self.budgets[n]
            alive, sums = alive[near], sums[near]
        return alive


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(ring: Pigeonring, k: np.ndarray, group: np.ndarray, fp: np.ndarray):
    """Linked pairs within runs of equal ``group`` (complete runs, in order)."""
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.concatenate((first, [len(group)])))
    starts = np.array([s for s, _ in ring.keys], np.int64)[k]
    of = np.repeat(size, size)
    a, b = [], []
    small = np.flatnonzero(of <= SMALL)
    for gap in range(1, SMALL):
        i = small[small + gap < len(group)]
        i = i[group[i] == group[i + gap]]
        i = i[ring.linked(fp[i] ^ fp[i + gap], starts[i])]
        a.append(fp[i])
        b.append(fp[i + gap])
    for at, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist()):
        own, label = fp[at:at + n], np.arange(n)
        for i in range(n - 1):
            rest = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
            near = rest[ring.linked(own[i] ^ own[rest], np.full(len(rest), starts[at]))]
            if len(near):
                near = near[np.unique(label[near], return_index=True)[1]]
                a.append(np.full(len(near), own[i]))
                b.append(own[near])
                label[np.isin(label, label[near])] = label[i]
    return np.concatenate(a), np.concatenate(b)


def links(fps: DataFrame, max_bits: int = 4, segments: int = 7) -> DataFrame:
    """Links ``a``, ``b`` between the distinct fingerprints of column ``fp``: enough to
    connect all that are connected. Within a key's group of up to eight all links are given,
    in a larger one a spanning forest of its links, so no group gives a square of its size.

    A key shared by more than ``BLOCK`` fingerprints is compared block against block, each
    pair of blocks being its own group, so none grows with the data.
    """
    ring = Pigeonring(max_bits, segments)
    keys = F.array(*[F.struct(F.lit(i).alias("k"),
                              F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("v"))
                     for i, (_, mask) in enumerate(ring.keys)])
    keyed = fps.select("fp", F.explode(keys).alias("key")).select("fp", "key.k", "key.v")
    hot = saved(keyed.groupBy("k", "v").count().where(F.col("count") > BLOCK).select(
        "k", "v", F.ceil(F.col("count") / BLOCK).cast("int").alias("s")), "hot-keys")
    block = F.pmod(F.xxhash64("fp"), F.col("s")).cast("int")
    pairs = F.when(F.col("s").isNull(), F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y")))) \
        .otherwise(F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda j: F.struct(
            F.least(block, j).alias("x"), F.greatest(block, j).alias("y"))))
    dealt = keyed.join(hot, ["k", "v"], "left") \
        .select("k", "v", "fp", F.explode(pairs).alias("p")) \
        .select("k", F.xxhash64("k", "v", "p.x", "p.y").alias("g"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.uint64)]
        for b in batches:
            own = [b.column(0).to_numpy(), b.column(1).to_numpy(),
                   b.column(2).to_numpy().view(np.uint64)]
            rows = [np.concatenate((h, o)) for h, o in zip(held, own)]
            if not len(rows[1]):
                continue
            # the last group may go on in the next batch
            end = np.searchsorted(rows[1], rows[1][-1])
            held = [r[end:] for r in rows]
            if end:
                yield out(*[r[:end] for r in rows])
        if len(held[1]):
            yield out(*held)

    def out(k, g, fp):
        a, b = _links(ring, k, g, fp)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                          ["a", "b"])

    # groups are told apart by a hash of key and block; a shared hash only adds checked pairs
    return dealt.repartition("g").sortWithinPartitions("g", "k", "fp") \
        .select("k", "g", "fp").mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 4, max_bits: int = 4, segments: int = 7,
                       extra: tuple = ()) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 lowercase hex digits) and ``component_id`` (the least
    id reachable over links, itself included) of every row.

    Texts without words and null texts have fingerprint zero and link like any other. Equal
    fingerprints are one node, so groups of copies cost one node whatever their size. A
    repeated row appears as often as it is given. A null id keeps its row and is never the
    least id; a component without any id has a null ``component_id``. Other columns are
    ignored. More ``segments`` make the keys longer: 7 gives 27-bit keys, 35 a fingerprint;
    8 gives 32-bit keys, 70 a fingerprint, for some ten billion documents.
    """
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return components_of(fps, id_col, max_bits, segments)


def components_of(fps: DataFrame, id_col: str, max_bits: int, segments: int) -> DataFrame:
    """As :func:`simhash_components`, from the rows of :func:`fingerprints`."""
    nodes = saved(fps.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    roots = connected_components(links(nodes, max_bits, segments))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = saved(rooted.join(least, "root").select("fp", "component_id"), "components")
    return fps.join(known, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **how) -> DataFrame:
    """One row of each component: that of the least id. Exact repeats of a row are one row;
    rows with a null id come after all others. All columns are kept as they are."""
    key = free_name(docs, "_row")
    rows = docs.withColumn(key, F.struct(F.col(id_col).alias("i"), row_hash(docs).alias("h")))
    comp = _row_components(rows, key, text_col, how)
    return rows.join(comp, key, "left_semi").dropDuplicates([key]).drop(key)


def _row_components(rows: DataFrame, key: str, text_col: str, how: dict) -> DataFrame:
    """The key of the row that stays, for every component."""
    order = F.struct(F.col(key)["i"].isNull().alias("none"), F.col(key)["i"].alias("i"),
                     F.col(key)["h"].alias("h"))
    fps = fingerprints(rows.withColumn(key, order), key, text_col, how.get("shingle", 4))
    nodes = saved(fps.groupBy("fp").agg(F.min(key).alias("least")), "nodes")
    roots = connected_components(links(nodes, how.get("max_bits", 4), how.get("segments", 7)))
    return nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least")) \
        .select(F.struct(F.col("least.i").alias("i"), F.col("least.h").alias("h")).alias(key))
