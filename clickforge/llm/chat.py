"""Chat formatting: cumulative snapshots collapse to maximal conversations, then render.

A log often holds a conversation many times, as it grew. A rolling hash over its turns gives
every prefix of a conversation one value; a conversation whose own value is a proper prefix
of another one is a snapshot and goes, by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickforge.llm.common import materialise, saved


def _turn_text(turn: Column) -> Column:
    """A turn as text that no other turn has: lengths first, null apart from empty."""
    def field(c):
        return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(field(turn["role"]), field(turn["text"]))


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, ``turns`` (array in order of turn, role and text, nulls first) and ``prefixes``
    (rolling SHA-256 of the first 1, 2, ... turns). Exact repeats of a turn are one turn."""
    rows = turns.select(F.col(id_col).alias("conv"), F.struct(
        F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text")).alias("t"))
    whole = rows.groupBy("conv").agg(F.array_sort(F.collect_set("t")).alias("turns"))
    rolling = F.aggregate("turns", F.array().cast("array<string>"), lambda done, t: F.concat(
        done, F.array(F.sha2(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")),
                                      _turn_text(t)), 256))))
    return materialise(whole, "prefixes", rolling)


def maximal(convs: DataFrame) -> DataFrame:
    """Of :func:`conversations` the ones that prefix no longer one, with ``n_copies``; of equal
    ones that of the least id (null last)."""
    last = F.element_at("prefixes", -1)
    one = convs.select(last.alias("whole"), "conv").groupBy("whole").agg(
        F.min(F.struct(F.col("conv").isNull().alias("none"), "conv")).alias("least"),
        F.count("*").alias("n_copies"))
    shorter = convs.select(F.explode(F.slice("prefixes", 1, F.size("prefixes") - 1)).alias("whole")).distinct()
    kept = one.join(shorter, "whole", "left_anti").select("least.conv", "whole", "n_copies")
    return convs.withColumn("whole", last).alias("c").join(
        kept.alias("k"), F.col("c.conv").eqNullSafe(F.col("k.conv")) & (F.col("c.whole") == F.col("k.whole"))) \
        .select("c.conv", "turns", "n_copies")


def rendered(turns: Column) -> Column:
    """ChatML text. ``<|`` in a role or text is written ``< |``, so content can't forge a turn;
    a null role is ``unknown``, a null text empty."""
    def safe(c, default):
        return F.replace(F.coalesce(c, F.lit(default)), F.lit("<|"), F.lit("< |"))
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit("<|im_start|>"), safe(t["role"], "unknown"), F.lit("\n"), safe(t["text"], ""),
        F.lit("<|im_end|>\n"))), "")


def render_maximal(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_turns``, ``n_copies`` (logged conversations equal to it, itself
    included) and ``rendered`` for every maximal conversation.

    Rows with a null id make one conversation. Turn numbers order the turns and need not be
    dense; they are no part of what is compared. Rows of one turn number are ordered by
    role and text. Other columns are ignored; an empty table gives no rows. A conversation
    is one row, as its rendered text is; copies and snapshots of one, however many, are
    reduced to distinct hashes before the join.
    """
    convs = saved(conversations(turns, id_col, turn_col, role_col, text_col), "conversations")
    return maximal(convs).select(
        F.col("conv").alias(id_col), F.size("turns").cast("long").alias("n_turns"), "n_copies",
        rendered(F.col("turns")).alias("rendered"))
