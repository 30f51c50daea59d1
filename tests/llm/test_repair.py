"""Structure repair: against a search over all edits, and odd rows."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from clickforge.llm.repair import END, audits, damaged, edits, repair_conversations, step

TURNS = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[\x20\x09-\x0D]+")


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        f = zlib.crc32(key.encode()) % 20
        if f == 4:
            role = "user"
        text = "" if f == 1 else re.sub("[.!?]", "", text) if f == 2 else text
        out += [(conv, turn, role, text)] * (0 if f == 0 else 2 if f == 3 else 1)
    return out


def search(rows, faults):
    """Least (cost, audit, lines) over all edits: every number of inserts before each row."""
    want = re.compile(r"(s?(ua)+)?")
    best = None

    def go(i, cost, audit, lines, roles):
        nonlocal best
        if best is not None and cost > best[0] or not re.fullmatch(r"s?(ua)*u?", roles):
            return
        for extra in range(3):
            if i == len(rows):
                got, c, a, l = roles, cost, audit, list(lines)
                for _ in range(extra):
                    role = "assistant" if got.endswith("u") else "user"
                    got, c, a = got + role[0], c + 3, a + "I"
                    l.append(f"{role}:")
                if want.fullmatch(got) and (best is None or (c, a) < best[:2]):
                    best = (c, a, l)
                continue
            got, c, a, l = roles, cost, audit, list(lines)
            for _ in range(extra):
                role = "assistant" if got.endswith("u") else "user"
                got, c, a = got + role[0], c + 3, a + "I"
                l.append(f"{role}:")
            role, text = rows[i]
            go(i + 1, c + 4, a + "D", l, got)
            if faults[i] not in ("blank", "duplicate"):
                t = 3 if faults[i] == "truncated" else 0
                go(i + 1, c + t, a + "K", l + [f"{role}:{text}"], got + (role[:1] or "?"))
                for to in ("user", "assistant"):
                    go(i + 1, c + t + 3, a + "R", l + [f"{to}:{text}"], got + to[0])

    go(0, 0, "", [], "")
    return best


def brute(rows, all_ids):
    out = []
    for conv in all_ids:
        own = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            solid = BLANK.sub("", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen
                          else "truncated" if solid[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, lines = search([r[2:] for r in own], faults)
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                    illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(n=60, seed=2):
    rnd, rows = random.Random(seed), []
    texts = ["One.", "Two!", "Three", "  ", "", "Four? ", "Fünf", None, "Six.\n"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "sys", "USER"]
    for conv in range(n):
        for turn in range(rnd.randint(1, 5)):
            rows.append((conv, turn * rnd.choice([1, 1, 2]), rnd.choice(roles[:rnd.choice([2, 3, 10])]), rnd.choice(texts)))
    rows += [(None, 0, "user", "No id."), (None, 1, "assistant", "Yes."), (5000, None, "user", "a."), (5000, None, "user", "b."),
             (5001, None, None, None), (5002, -3, "user", "x."), (5002, 9, "assistant", "y.")]
    return rows


def test_against_a_search_over_all_edits(spark):
    rows = table()
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("pos", "sign", "conv", "cost", "audit")})
    got = repair_conversations(damaged(df))
    want = brute(brute_damage(rows), {r[0] for r in rows})
    assert rows_of(got) == want
    assert {"D", "I", "K", "R"} <= set("".join(r[7] for r in want))


def test_without_damage(spark):
    """As an operator of its own; here with nothing dropped and no null."""
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (2, 0, "assistant", "Well?")]
    found = rows_of(repair_conversations(spark.createDataFrame(rows, TURNS)))
    assert [(r[0], r[6], r[7]) for r in found] == [(1, 0, "KKK"), (2, 3, "IK")]
    assert rows_of(repair_conversations(spark.createDataFrame([], TURNS))) == []


def test_dropped_conversations_stay(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = rows_of(repair_conversations(damaged(spark.createDataFrame([(gone, 0, "user", "Hi.")], TURNS))))
    assert found == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_one_long_conversation(spark):
    """30,000 rows of one conversation beside many copies of a short one."""
    long = [(7, i, "user" if i % 2 else "assistant", f"Turn {i}." if i % 5 else f"Turn {i}") for i in range(30_000)]
    short = [(100 + c, t, r, f"{r}.") for c in range(400) for t, r in enumerate(("user", "assistant"))]
    found = {r.conv_id: r for r in repair_conversations(spark.createDataFrame(long + short, TURNS)).collect()}
    assert len(found) == 401 and {r.audit for c, r in found.items() if c != 7} == {"KK"}
    # the first row, an assistant's and truncated, goes; the last one, a user's, needs an answer
    assert found[7].truncated == 6000 and found[7].cost == 4 + 3 * 5_999 + 3
    assert found[7].audit == "D" + "K" * 29_999 + "I"


def test_nodes_are_shared_and_edits_follow_them(spark):
    rnd = random.Random(5)
    strings = sorted({"".join(rnd.choice("suaoSUAOx") for _ in range(rnd.randint(0, 6))) for _ in range(300)})
    got = {r.signs: (r.cost, r.audit) for r in audits(spark.createDataFrame([(s,) for s in strings] * 2, "signs string")).collect()}
    assert sorted(got) == strings
    for s in strings:
        rows = [({"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}[c.lower()], "t") for c in s]
        faults = ["blank" if c == "x" else "truncated" if c.isupper() else None for c in s]
        assert got[s] == search(rows, faults)[:2], s
    nodes = [END]
    for c in "uau"[::-1]:
        nodes.append(step(c, nodes[-1]))
    assert (nodes[-1][0][0], edits("uau", nodes)) == (3, "KKKI")
