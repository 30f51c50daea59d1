"""Merkle dataset manifest with checkpointed levels: proofs recompute what is not stored.

The leaves of a group stand in order; every ``fan`` = 2 consecutive nodes become one of the
next level, until one is left. Only every ``STRIDE``-th level is written (a checkpoint). An
aligned subtree between two checkpoints has at most ``2 ** STRIDE`` stored descendants, so
building the next checkpoint and extracting proofs are both work on bounded arrays: the
missing interior nodes are computed again from the descendants, the siblings that a proof
needs are emitted, and the nodes are dropped. The roots of the groups are the leaves of one
more tree, built and proved in the same way.

A level's digests are SHA-256 in hex; a parent is the hash of its children's hex texts, left to
right, and a last node without a partner is hashed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import materialise, saved

#: Levels between two stored ones: an aligned subtree has 2 ** STRIDE stored descendants.
STRIDE = 6


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value: no two rows of fields have
    the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(f) for f in fields]), 256)


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves: the least h with ``2 ** h >= n``."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def placed(rows: DataFrame, group: str, order: list[Column], label: str) -> DataFrame:
    """``rows``, written once, with ``pos`` (place in its group by ``order``, from 0) and ``n``
    (the group's rows). Rows are dealt out by ranges of group and order, so a group of any size
    is spread over many tasks; places are the counts of the ranges before plus a running number
    within the range. Rows that tie in ``order`` are dealt out by their place in the input."""
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_salt")]
    ranged = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt") \
        .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    ranged = saved(ranged, label)
    parts = ranged.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # a row for each range and group that it holds: no more than ranges and groups together
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(group).alias("_group"), "_part", "_first", F.coalesce(
        F.sum("_rows").over(before), F.lit(0)).alias("_base"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("n"))
    return ranged.alias("r").join(parts.alias("p"), (F.col("r._part") == F.col("p._part"))
                                  & F.col(f"r.{group}").eqNullSafe(F.col("p._group"))) \
        .withColumn("pos", F.col("_base") + F.col("_at") - F.col("_first")) \
        .select("r.*", "pos", "n").drop("_part", "_at")


def _up(nodes: Column) -> Column:
    """The parents of an array of digests that starts at an even place."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), lambda i: F.sha2(
        F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256))


def _subtrees(nodes: DataFrame, level: int, stride: int, payload: list[str] = ()) -> DataFrame:
    """Aligned subtrees over the nodes (``grp``, ``pos``, ``n`` leaves of the group, ``d``) of a
    stored ``level``: ``grp``, ``top`` (the subtree's place), ``n``, ``nodes`` (structs of ``pos``,
    ``d`` and the payload, in order; ``2 ** stride`` at most) and ``l0`` ... : the
    regenerated levels, up to the one below the next checkpoint or the root."""
    grouped = nodes.groupBy("grp", F.shiftright("pos", stride).alias("top")).agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "d", *payload))).alias("nodes"))
    out = grouped.withColumn("h", _height(F.col("n")) - level)
    out = materialise(out, "l0", F.transform("nodes", lambda x: x["d"]))
    for k in range(1, stride + 1):
        out = materialise(out, f"l{k}", F.when(F.col("h") >= k, _up(F.col(f"l{k - 1}"))))
    return out


def checkpoints(leaves: DataFrame, label: str, stride: int = STRIDE) -> list[DataFrame]:
    """Stored levels of the trees over ``leaves`` (``grp``, ``pos``, ``n``, ``d``): the leaves
    themselves, then every ``stride``-th level above, up to the one under the highest root."""
    stored = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1 << (stride * len(stored)):
        level = stride * (len(stored) - 1)
        trees = _subtrees(stored[-1], level, stride).where(F.col("n") > (1 << (level + stride)))
        stored.append(saved(trees.select("grp", F.col("top").alias("pos"), "n", F.get(
            f"l{stride}", F.lit(0)).alias("d")), f"{label}-{level + stride}"))
    return stored


def _siblings(stride: int) -> Column:
    """For each of a subtree's nodes the siblings on its way up to the next checkpoint (null where
    it has none): regenerated, emitted and dropped with the subtree's levels."""
    def of(x, i):
        up = [F.when(F.col("h") > k, F.struct(F.get(F.col(f"l{k}"), F.shiftright(i, k).bitwiseXOR(F.lit(1))).alias("d")))
              for k in range(stride)]
        return F.struct(x.alias("node"), F.transform(F.filter(F.array(*up), lambda s: s.isNotNull()),
                                                     lambda s: s["d"]).alias("path"))
    return F.transform("nodes", of)


def tree_roots(stored: list[DataFrame], stride: int = STRIDE) -> DataFrame:
    """``grp`` and ``root`` of every tree, from the checkpoint under its root."""
    out = None
    for s, nodes in enumerate(stored):
        trees = _subtrees(nodes.where(F.col("n") <= (1 << (stride * (s + 1)))), stride * s, stride)
        own = trees.select("grp", _own_root(stride).alias("root"))
        out = own if out is None else out.unionAll(own)
    return out


def _own_root(stride: int) -> Column:
    """The root of a subtree whose tree ends within it, else null."""
    here = F.lit(None).cast("string")
    for k in range(stride + 1):
        here = F.when(F.col("h") == k, F.get(f"l{k}", F.lit(0))).otherwise(here)
    return here


def proofs(stored: list[DataFrame], payload: list[str], groups: DataFrame | None, label: str,
           stride: int = STRIDE) -> DataFrame:
    """Every leaf (``grp``, ``pos``, ``n``, ``d``, the ``payload`` columns of the leaves and the
    columns of ``groups``, keyed by ``grp``) with ``path``: its siblings from its own level up,
    null where there is none. Checkpoints are read from the top down; the path above a subtree
    is joined to the subtree once, not to each of its nodes, and no leaf's path is written."""
    above = None
    for s in range(len(stored) - 1, -1, -1):
        own = payload if s == 0 else []
        trees = _subtrees(stored[s], s * stride, stride, own)
        if above is None:
            trees = trees.withColumn("_path", F.lit(None).cast("array<string>"))
        else:
            a = above.select(F.col("grp").alias("_g"), F.col("pos").alias("_t"), F.col("path").alias("_path"))
            trees = trees.join(a, trees["grp"].eqNullSafe(a["_g"]) & (trees["top"] == a["_t"]), "left")
        kept = ["grp", "n"]
        if s == 0 and groups is not None:
            g = groups.withColumnRenamed("grp", "_name")
            trees = trees.join(g, trees["grp"].eqNullSafe(g["_name"]))
            kept += [c for c in g.columns if c != "_name"]
        out = trees.select(*kept, "_path", F.explode(_siblings(stride)).alias("x"))
        out = out.select(*kept, "x.node.pos", "x.node.d", *[f"x.node.{c}" for c in own], F.concat(
            "x.path", F.coalesce("_path", F.array().cast("array<string>"))).alias("path"))
        above = saved(out, f"{label}-paths-{s}") if s else out
    return above


def folded(digest: Column, pos: Column, path: Column) -> Column:
    """The root that ``digest`` at ``pos`` and the siblings of ``path`` give."""
    start = F.struct(digest.alias("d"), pos.cast("long").alias("p"))
    return F.aggregate(path, start, lambda a, s: F.struct(F.sha2(F.when(
        a["p"] % 2 == 1, F.concat(s, a["d"])).otherwise(F.concat(a["d"], F.coalesce(s, F.lit("")))), 256).alias("d"),
        F.shiftright(a["p"], 1).alias("p")))["d"]


def manifest(rows: DataFrame, group_col: str, id_col: str, fields: list[str], label: str = "merkle",
             check: dict[str, Column] | None = None, stride: int = STRIDE) -> DataFrame:
    """``id_col``, ``leaf``, ``subroot`` (of the row's group), ``root`` (of all groups),
    ``pos`` and ``path`` (place and siblings up to the subroot), ``group_pos`` and ``group_path``
    (those of the subroot up to the root), ``proof_sha256`` (hash of all siblings, in that
    order), and the columns ``check``, computed from the row.

    A leaf is the hash of the row's ``fields`` (see :func:`field_text`). Leaves stand by id (nulls
    first, then by leaf), groups by their UTF-8 bytes, null first. Rows repeated in every field are leaves of
    their own, side by side. Other columns are ignored; a table without rows gives none.
    ``rows`` is read once; the ids, hashes and ``check`` are written. A task's unit of work is a
    subtree of ``2 ** stride`` nodes; nothing is broadcast by hint, and only the height of the
    tallest tree reaches the driver.
    """
    extra = check or {}
    leaves = saved(rows.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf_digest(
        [rows[f] for f in fields]).alias("d"), *[c.alias(k) for k, c in extra.items()]), f"{label}-digests")
    stored = checkpoints(placed(leaves, "grp", [F.col("id").asc_nulls_first(), F.col("d")], f"{label}-leaves"),
                         label, stride)
    roots = saved(tree_roots(stored, stride), f"{label}-subroots")
    top = placed(roots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), F.col("root").alias("d")),
                 "grp", [F.col("name").asc_nulls_first()], f"{label}-top")
    top = checkpoints(top, f"{label}-top", stride)
    groups = proofs(top, ["name"], tree_roots(top, stride), f"{label}-top", stride)
    groups = saved(groups.select(F.col("name").alias("grp"), F.col("d").alias("subroot"), "root", F.col("pos").alias(
        "group_pos"), F.col("path").alias("group_path")), f"{label}-groups")
    every = proofs(stored, ["id", *extra], groups, label, stride)
    return every.select(F.col("id").alias(id_col), F.col("d").alias("leaf"), "subroot", "root", "pos", "path",
                        "group_pos", "group_path",
                        F.sha2(F.array_join(F.concat("path", "group_path"), ""), 256).alias("proof_sha256"), *extra)


def verified_manifest(docs: DataFrame, tampered: Column, id_col: str = "doc_id", group_col: str = "lang",
                      fields: tuple = ("doc_id", "source", "lang", "n_chars", "text"),
                      count_col: str = "n_chars") -> DataFrame:
    """:func:`manifest` of ``docs`` (``id_col``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``)
    with a check of every proof: where ``tampered`` (a null counts as false) ``count_col`` is one
    more (a null stays null), ``folded_root`` comes from that leaf, else from the original, and
    ``verified`` tells whether it is the root."""
    changed = leaf_digest([docs[f] + 1 if f == count_col else docs[f] for f in fields])
    rows = manifest(docs, group_col, id_col, list(fields), check={
        "seen": F.when(F.coalesce(tampered, F.lit(False)), changed)})
    rows = rows.withColumn("start", F.coalesce("seen", "leaf"))
    sub = folded(F.col("start"), F.col("pos"), F.col("path"))
    rows = materialise(rows, "folded_root", folded(sub, F.col("group_pos"), F.col("group_path")))
    return rows.select(id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))
