"""Conversation structure repair by a suffix-shared automaton of row signatures.

A row's signature is one letter: what its role's initial and its first fault mean for the
repair. A conversation's signatures, read from the end, are a path in an automaton in which two
places are one node if the same signatures follow them; so all conversations share what they
have in common at the end. For every node and every state of the role grammar the least cost to
go and the first edit of the best audit suffix are computed once; the rest of that suffix is what
the node's successor holds, so a suffix is never copied.

The automaton is built from sorted data: the distinct signature strings are dealt out and
sorted by their reversed text, where neighbours share their longest common suffix. A task keeps
one path of nodes, drops those that the next string does not share and adds its own, so it
holds no more than the longest string and meets every node once. Nodes that a border between two
tasks divides, one path a border, are met by both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickforge.llm.common import saved

# What edits cost, and the roles that the grammar (s?(ua)+)? asks for.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: States of the grammar: nothing yet, after s, after u, after a. What each expects next, and
#: where that leads.
EXPECTED = ("u", "u", "a", "u")
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"u": USER, "a": ASSISTANT, "s": SYSTEM}
INFINITE = 1 << 60
#: The signature of a row that has to go; others are the initial (o: any other one), in capitals
#: for a truncated row.
GONE = "x"


def damaged(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The rows of ``turns`` (these four columns) with faults, by the CRC-32 of ``id:turn`` modulo
    20: 0 drops the row (it stays with ``present`` false, so that its conversation is known), 1
    empties the text, 2 removes its ``.!?``, 3 repeats the row, 4 sets the role to user. A null
    role or text, and a null in the checksum's text, is one space. Other columns are dropped."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text(id_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    rows = turns.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"), fault.alias("fault"))
    return rows.select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", ""))
         .otherwise(F.col("text")).alias("text"), (F.col("fault") != 0).alias("present"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")) \
        .select(F.col("conv").alias(id_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col),
                F.col("text").alias(text_col), "present")


def signed(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv``, ``turn``, ``role``, ``text``) with ``pos`` (from 0, by turn, nulls first,
    then role and text), ``fault`` (the first of blank, duplicate, truncated, or null), ``sign``,
    ``illegal`` (its initial may not follow that of the row before) and ``new_turn``. Windows
    over one shuffle by conversation; their sorts spill."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    conv = Window.partitionBy("conv").orderBy(*order)
    same = Window.partitionBy("conv", "role", "text").orderBy("pos")
    solid = F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")
    initial = F.substring("role", 1, 1)
    rows = rows.withColumn("pos", F.row_number().over(conv) - 1).withColumn("seen", F.row_number().over(same) > 1) \
        .withColumn("before", F.lag(initial).over(conv)).withColumn("turn_before", F.lag("turn").over(conv))
    fault = F.when(solid == "", "blank").when(F.col("seen"), "duplicate") \
        .when(~F.substring(solid, -1, 1).isin(".", "!", "?"), "truncated")
    rows = rows.withColumn("fault", fault)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    sign = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(
        F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    illegal = (F.col("pos") > 0) & ~F.concat("before", initial).isin("su", "ua", "au")
    new_turn = F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))
    return rows.select("conv", "pos", "turn", "role", "text", "fault", sign.alias("sign"),
                       illegal.alias("illegal"), new_turn.alias("new_turn"))


Node = tuple[tuple[int, ...], str]  # cost to go and first edit, by state


def _with_inserts(best: list[tuple[int, str]]) -> Node:
    """A node from the best (cost, edit) by state without an insert here. Two inserts lead from
    user and assistant back to the same state, so one is all that can pay there."""
    user = min(best[USER], (INSERT + best[ASSISTANT][0], "I"))
    assistant = min(best[ASSISTANT], (INSERT + best[USER][0], "I"))
    start = min(best[START], (INSERT + user[0], "I"))
    system = min(best[SYSTEM], (INSERT + user[0], "I"))
    found = (start, system, user, assistant)
    return tuple(c for c, _ in found), "".join(e or " " for _, e in found)


#: The node after the last row: a conversation may end with nothing, or after an assistant.
END: Node = _with_inserts([(0, ""), (INFINITE, ""), (INFINITE, ""), (0, "")])


def step(sign: str, after: Node) -> Node:
    """The node of a row with signature ``sign`` in front of ``after``. Of equal costs the edit of
    the least letter is best: two edits of one state never share their letter."""
    costs, best = after[0], []
    low, more = sign.lower(), TRUNCATED if sign.isupper() else 0
    for state in range(4):
        found = [(DELETE + costs[state], "D")]
        if sign != GONE:
            expected = EXPECTED[state]
            if low == expected or (low == "s" and state == START):
                found.append((more + costs[AFTER[low]], "K"))
            found.append((REROLE + more + costs[AFTER[expected]], "R"))
        best.append(min(found))
    return _with_inserts(best)


def edits(signs: str, nodes: list[Node]) -> str:
    """The best audit of ``signs``; ``nodes[k]`` is the node that k last signatures follow."""
    out, state, at = [], START, 0
    while True:
        edit = nodes[len(signs) - at][1][state]
        if edit == " ":
            return "".join(out)
        out.append(edit)
        if edit in "IR":
            state = AFTER[EXPECTED[state]]
        elif edit == "K":
            state = AFTER[signs[at].lower()]
        at += edit != "I"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature strings, sorted by their reversed text: adds cost and audit."""
    path, last = [END], ""
    for b in batches:
        costs, audits = [], []
        for signs in b.column(0).to_pylist():
            back = signs[::-1]
            shared, most = 0, min(len(back), len(last))
            while shared < most and back[shared] == last[shared]:
                shared += 1
            del path[shared + 1:]
            for sign in back[shared:]:
                path.append(step(sign, path[-1]))
            last = back
            costs.append(path[-1][0][START])
            audits.append(edits(signs, path))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                                         ["signs", "cost", "audit"])


def audits(signatures: DataFrame) -> DataFrame:
    """``signs`` (distinct strings), ``cost`` and ``audit``."""
    back = F.reverse("signs")
    return signatures.select("signs").distinct().repartitionByRange(back).sortWithinPartitions(back) \
        .mapInArrow(_audits, "signs string, cost long, audit string")


class _Repair:
    """The hash of one conversation's repaired text, row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.first = audit, 0, START, True
        self.sha = hashlib.sha256()

    def _add(self, role: str, text: str) -> None:
        if not self.first:
            self.sha.update(b"\n")
        self.first = False
        self.sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.state = AFTER[role[0]]

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._add(ROLES[EXPECTED[self.state]], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self._add(role, text)
        elif edit == "R":
            self._add(ROLES[EXPECTED[self.state]], text)

    def digest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conversation and place, its audit first (at -1): one hash a conversation."""
    own = None
    for b in batches:
        key, done = b.column(0), ([], [])
        pos, role, text = b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()
        for i in range(b.num_rows):
            if pos[i] < 0:
                if own is not None:
                    done[0].append(name)
                    done[1].append(own.digest())
                own, name = _Repair(text[i]), key[i].as_py()
            else:
                own.row(role[i], text[i])
        yield pa.RecordBatch.from_arrays([pa.array(done[0], key.type), pa.array(done[1], pa.string())],
                                         ["conv", "repaired_sha256"])
    if own is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], key.type), pa.array([own.digest()], pa.string())],
                                         ["conv", "repaired_sha256"])


def repair_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row a conversation: ``id_col``, ``gaps`` (turn numbers missing between the least and the
    largest), ``blank``, ``duplicate``, ``truncated`` (rows by first fault), ``illegal`` (rows
    whose role may not follow the one before), ``cost`` and ``audit`` of the cheapest repair, and
    ``repaired_sha256`` of its rows.

    ``turns`` may have a boolean column ``present``: rows where it is not true only name their
    conversation. Rows with a null id are one conversation. Rows stand by turn (nulls first), then role
    and text; rows equal in all three are duplicates but for the first. A null role or text is
    one space. A conversation without rows has zeros, an empty audit and the hash of nothing. An
    empty table gives no rows, other columns are ignored.

    The texts of a conversation are never collected: they stream in order through the hash.
    Only its signatures, one letter a row, are one value, as the audit has to be.
    """
    here = F.coalesce(F.col("present"), F.lit(False)) if "present" in turns.columns else F.lit(True)
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = saved(turns.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                              text(role_col).alias("role"), text(text_col).alias("text"), here.alias("here")), "turns")
    signs = saved(signed(rows.where("here").drop("here")), "signed-turns")
    facts = signs.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if("illegal").alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sign"))), lambda x: x["sign"]), "")
        .alias("signs"))
    ids = rows.select("conv").distinct()
    facts = ids.alias("i").join(facts.alias("f"), F.col("i.conv").eqNullSafe(F.col("f.conv")), "left") \
        .select("i.conv", *[F.coalesce(f"f.{c}", F.lit(0)).cast("long").alias(c) for c in (
            "gaps", "blank", "duplicate", "truncated", "illegal")], F.coalesce("f.signs", F.lit("")).alias("signs"))
    facts = saved(facts, "conversation-facts")
    plans = saved(audits(facts), "audits").hint("merge")  # grows with the conversations
    facts = saved(facts.join(plans, "signs").drop("signs"), "repairs")
    lines = facts.select("conv", F.lit(-1).alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text")) \
        .unionAll(signs.select("conv", "pos", "role", "text"))
    kind = dict(signs.dtypes)["conv"]
    hashes = lines.repartition("conv").sortWithinPartitions("conv", "pos") \
        .mapInArrow(_hashes, f"conv {kind}, repaired_sha256 string")
    return facts.alias("f").join(hashes.alias("h"), F.col("f.conv").eqNullSafe(F.col("h.conv"))).select(
        F.col("f.conv").alias(id_col), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        "repaired_sha256")
