"""Mixing sources to target weights by a low-discrepancy schedule.

A source's documents stand in a shuffled order, end to end, cut into blocks of equal words
(one word more or less) that divide its own size. The mix is a row of slots of one block each;
a source needs as many as its target has blocks. Slot t belongs to the source whose interval of
the cumulative slots holds the t-th golden-ratio point, so that every stretch of the schedule is
close to the targets. The r-th slot of a source takes its block r, starting again when all are
taken. Then each source is settled: slots beyond its own number go, those that the points left
out follow at the end, and its last slot takes only the words up to the target. Everything is
joins, grouped sums and windows over bounded groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import free_name, row_hash, saved, words

#: The golden ratio's fraction times 2**32, odd: its multiples modulo 2**32 visit every value.
GOLDEN = 2_654_435_769
#: Equal cells of the unit interval by which points and intervals are joined: at least so many,
#: and four a source, so that a cell holds few intervals.
LEAST_CELLS = 1_024
#: Slots that are numbered together.
CHUNK = 65_536


def weighed_sources(sized: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5,
                    cap: float = 2.0) -> DataFrame:
    """One row a source of ``sized`` (``source``, ``size``): ``sid`` (by code point, null
    last), ``weight`` (the given ones, repeating), ``source_size``, ``target``.

    The targets share ``share`` times all sizes by weight, but none exceeds ``cap`` times its
    source's size: what is over is shared by weight among the rest, until none is above. In
    order of size by weight the capped sources come first, so one pass finds them.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # a row a source
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")) \
        .withColumn("sid", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("sid") - 1) % len(weights) + 1)
    by_ratio = Window.orderBy("ratio", "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    sources = sources.withColumn("weight", weight) \
        .withColumn("most", cap * F.col("source_size")) \
        .withColumn("ratio", F.col("most") / F.col("weight"))
    sources = sources.withColumn("level", (
        share * F.sum("source_size").over(all_rows)
        - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    capped = F.col("level") >= F.col("ratio")
    level = F.max(F.when(~capped, F.col("level"))).over(all_rows)
    return sources.select("sid", "source", "weight", "source_size", F.when(
        capped, F.col("most")).otherwise(level * F.col("weight")).alias("target"))


def _point(slot: Column) -> Column:
    """The golden-ratio point of a slot in units of 2**-32, without overflow of a long."""
    t = slot % (1 << 32)
    high = F.shiftleft((t * (GOLDEN >> 16)) % (1 << 16), 16)
    return (high + t * (GOLDEN & 0xFFFF)) % (1 << 32)


def _start(block: Column) -> Column:
    """The first word of a source's block: ``n_wide`` blocks of ``width + 1`` words, then others of ``width``."""
    return block * F.col("width") + F.least(block, F.col("n_wide"))


def _block_of(word: Column) -> Column:
    wide = F.col("n_wide") * (F.col("width") + 1)
    return F.when(word < wide, F.floor(word / (F.col("width") + 1))).otherwise(
        F.col("n_wide") + F.floor((word - wide) / F.col("width")))


def blocked(sources: DataFrame, block_words: int) -> DataFrame:
    """:func:`weighed_sources` that have words, with ``n_blocks`` (of ``block_words`` words or a few
    less), their ``width`` and ``n_wide``, ``most`` (the target in whole words), ``rest`` (words of the
    epoch that is not whole) and ``n_slots``."""
    rows = sources.where("source_size > 0").withColumn("n_blocks", F.ceil(F.col("source_size") / block_words)) \
        .withColumn("width", F.expr("source_size div n_blocks")).withColumn("n_wide", F.col("source_size") % F.col("n_blocks")) \
        .withColumn("most", F.least(F.round("target").cast("long"), 2 * F.col("source_size"))) \
        .withColumn("rest", F.col("most") % F.col("source_size"))
    partly = F.when(F.col("rest") > 0, _block_of(F.col("rest") - 1) + 1).otherwise(0)
    return rows.withColumn("n_slots", (F.expr("most div source_size") * F.col("n_blocks") + partly).cast("long"))


def schedule(sources: DataFrame) -> DataFrame:
    """Slots of the mix of :func:`blocked` sources: ``slot``, ``sid``, ``block`` (of the source's
    shuffled documents), ``epoch``, and ``upto``, the word at which the slot ends early (null: none)."""
    spark, span = sources.sparkSession, 1 << 32
    facts = sources.agg(F.sum("n_slots").alias("n"), F.count("*").alias("m")).first()
    n_slots, cells = facts["n"] or 0, LEAST_CELLS
    while cells < 4 * facts["m"] and cells < 1 << 24:
        cells *= 2
    by_id, all_rows = Window.orderBy("sid"), Window.partitionBy()  # a row a source
    upto = F.sum("n_slots").over(by_id.rowsBetween(Window.unboundedPreceding, 0))
    end = F.when(F.col("sid") == F.max("sid").over(all_rows), F.lit(span)).otherwise(
        F.floor(upto / n_slots * span) if n_slots else F.lit(0)).cast("long")
    parts = sources.select("sid", "n_slots", end.alias("high")).withColumn(
        "low", F.lag("high", 1, 0).over(by_id)).where("low < high")
    width = span // cells
    parts = saved(parts.select("sid", "low", "high", F.explode(F.sequence(
        F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width))).alias("cell")), "parts")
    slots = spark.range(n_slots).select(F.col("id").alias("slot"),
                                        _point(F.col("id") + 1).alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") / width)).join(parts, "cell") \
        .where("u >= low and u < high") \
        .select("slot", "sid", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    slots = saved(slots, "slots")
    counts = slots.groupBy("sid", "chunk").count()
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("sid", "chunk", F.coalesce(
        F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot"))
    ranked = slots.withColumn("within", within).join(counts, ["sid", "chunk"]) \
        .select("slot", "sid", (F.col("before") + F.col("within") - 1).alias("rank"))
    # what the points left out: a few slots a source
    found = slots.groupBy("sid").agg(F.count("*").alias("found"))
    left = sources.join(found, "sid", "left").withColumn("found", F.coalesce("found", F.lit(0))) \
        .where("found < n_slots").select("sid", F.explode(F.sequence("found", F.col("n_slots") - 1)).alias("rank"))
    left = left.select((F.lit(n_slots) + F.col("rank")).alias("slot"), "sid", "rank")
    own = sources.select("sid", "n_slots", "n_blocks", "rest")
    last = (F.col("rank") == F.col("n_slots") - 1) & (F.col("rest") > 0)
    return ranked.unionAll(left).join(own, "sid").where(F.col("rank") < F.col("n_slots")).select(
        "slot", "sid", (F.col("rank") % F.col("n_blocks")).alias("block"),
        F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch"), F.when(last, F.col("rest")).alias("upto"))


def _placed(sized: DataFrame, sources: DataFrame, keys: list[str], seed: str) -> DataFrame:
    """Every document with its source's row and ``at``, the number of words before it in the
    source's shuffled order (by a hash of the first two keys, id and text; sums by hash prefix
    keep a hot source spread out)."""
    docs = sized.withColumn("h", F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in keys[:2]]))) \
        .withColumn("part", F.substring("h", 1, 3)) \
        .join(sources, sized["source"].eqNullSafe(sources["source"]), "left").drop(sources["source"])
    sums = docs.groupBy("sid", "part").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("sid", "part").orderBy("h", *keys, "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return docs.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(sums, ["sid", "part"]).withColumn("at", F.col("base") + F.col("own")) \
        .drop("h", "part", "own", "base")


def mix_sizes(sized: DataFrame, keys: list[str], weights: tuple = (3, 1, 2), share: float = 1.5,
              block_words: int = 128, seed: str = "mix") -> DataFrame:
    """``sized`` (key columns, ``source``, ``size``, written once) with ``source_size``,
    ``target`` and ``taken``."""
    every = saved(weighed_sources(sized, weights, share), "sources")
    sources = saved(blocked(every, block_words), "blocked-sources")
    uses = schedule(sources).groupBy("sid", "block").agg(
        F.count_if(F.col("upto").isNull()).alias("uses"), F.max("upto").alias("upto"))
    blocks = sources.select(F.col("sid").alias("_sid"), "width", "n_wide")
    placed = _placed(sized, every.drop("weight"), keys, seed).join(blocks, F.col("sid") == F.col("_sid"), "left").drop("_sid")
    end = F.col("at") + F.col("size")
    pieces = placed.withColumn("block", F.explode_outer(F.when(
        F.col("size") > 0, F.sequence(_block_of(F.col("at")), _block_of(end - 1)))))
    low = F.greatest(F.col("at"), _start(F.col("block")))
    whole = F.least(end, _start(F.col("block") + 1)) - low
    partly = F.when(F.col("upto").isNotNull(), F.greatest(F.least(end, F.col("upto")) - low, F.lit(0)))
    columns = [*keys, "source", "size", "source_size", "target"]
    return pieces.join(uses, ["sid", "block"], "left").groupBy(*columns, "sid", "at") \
        .agg(F.coalesce(F.sum(whole * F.col("uses") + F.coalesce(partly, F.lit(0))), F.lit(0)).cast("long").alias("taken"),
             F.greatest(F.lit(1), F.sum((F.col("size") == 0).cast("int"))).alias("_rows")) \
        .select(*columns, "taken", F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int"))).alias("_copy")) \
        .drop("_copy")


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  source_col: str = "source", **how) -> DataFrame:
    """``id_col``, ``size`` (words), ``source_size``, ``target`` (both of the row's source) and
    ``taken`` (words of the row that the mix takes, repeats counted, at most twice ``size``).

    Every source takes its target, rounded to whole words. A null text has size 0 and is never
    taken. A null source is a source of its own, the last. Null and repeated ids are documents
    like any other, told apart by their text's hash; reruns agree, as rows that tie
    in every respect are taken alike up to their order. Other columns are ignored.
    """
    sized = saved(docs.select(F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
                              F.col(source_col).alias("source"),
                              F.size(words(F.col(text_col))).cast("long").alias("size")), "sizes")
    return mix_sizes(sized, ["id", "hash"], **how).drop("source", "hash").withColumnRenamed("id", id_col)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: every row as often as it is taken whole,
    and once with its first words (joined by single spaces) where a block border cuts it. At
    most one row of a source and epoch is cut."""
    key = free_name(docs, "_row")
    rows = docs.withColumn(key, F.struct(F.col(id_col).alias("i"), row_hash(docs).alias("h")))
    sized = saved(rows.select(F.col(f"{key}.i").alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
                              F.col(f"{key}.h").alias("row"), F.col(source_col).alias("source"),
                              F.size(words(F.col(text_col))).cast("long").alias("size")), "sizes")
    takes = mix_sizes(sized, ["id", "hash", "row"], **how).where("taken > 0").groupBy("id", "row").agg(
        F.sum(F.floor(F.col("taken") / F.col("size"))).cast("int").alias("whole"),
        F.collect_list(F.when(F.col("taken") % F.col("size") > 0, (F.col("taken") % F.col("size")).cast("int")))
        .alias("cut"))
    takes = takes.select(F.struct(F.col("id").alias("i"), F.col("row").alias("h")).alias(key),
                         F.concat(F.array_repeat(F.lit(0), F.col("whole")), "cut").alias("take"))
    part, take = free_name(docs, "_part"), free_name(docs, "_take")
    takes = takes.withColumnRenamed("take", take)
    out = rows.dropDuplicates([key]).join(takes, key).withColumn(part, F.explode(take))
    cut = F.array_join(F.slice(words(F.col(text_col)), 1, F.col(part)), " ")
    return out.withColumn(text_col, F.when(F.col(part) > 0, cut).otherwise(F.col(text_col))) \
        .select(*docs.columns)
