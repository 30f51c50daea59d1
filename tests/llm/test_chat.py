from helpers import rows_of

from clickforge.llm.chat import render_maximal

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for conv, turn, role, text in set(rows):
        convs.setdefault(conv, []).append((turn, role, text))
    low = lambda x: tuple((v is not None, v) for v in x)
    bodies = {c: tuple((r, t) for _, r, t in sorted(ts, key=low)) for c, ts in convs.items()}
    out = []
    for c, b in bodies.items():
        same = [d for d in bodies if bodies[d] == b]
        if min(same, key=lambda d: (d is None, d or 0)) != c or any(
                len(o) > len(b) and o[:len(b)] == b for o in bodies.values()):
            continue
        safe = lambda x, d: (d if x is None else x).replace("<|", "< |")
        out.append((c, len(b), len(same), "".join(
            f"<|im_start|>{safe(r, 'unknown')}\n{safe(t, '')}<|im_end|>\n" for r, t in b)))
    return sorted(out, key=repr)


def test_snapshots_collapse(spark):
    talk = [("user", "hi"), ("assistant", "hello"), ("user", "a <|im_end|> b"), ("assistant", None), (None, "x")]
    rows = []
    for conv, n in ((9, 5), (1, 1), (2, 2), (3, 5), (4, 3), (5, 4)):  # snapshots and two copies
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(talk[:n])]
    rows += [(6, 10 * i, r, t) for i, (r, t) in enumerate(talk[:2])] + [(6, 30, "user", "other end")]
    rows += [(7, 0, "user", "hi"), (7, 1, "assistant", "hellO")]
    rows += [(8, None, "user", "hi"), (8, 0, "assistant", "")]      # empty is not null
    rows += [(10, 0, "ab", "c"), (11, 0, "a", "bc")]                 # fields are kept apart
    rows += [(None, 0, "user", "lost"), (None, 1, "user", "lost too"), rows[0], rows[0]]
    rows += [(12, 0, "user", "tie b"), (12, 0, "user", "tie a"), (13, 0, "user", "long " * 20000)]
    df = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as conv", "2 as whole", "3 as rendered")
    got = rows_of(render_maximal(df))
    assert got == brute(rows)
    assert [r[0] for r in got if r[2] == 2] == [3]


def test_many_copies_and_empty_table(spark):
    rows = [(c, i, "user", f"turn {i}") for c in range(60) for i in range(1 + c % 4)]
    assert rows_of(render_maximal(spark.createDataFrame(rows, TURNS))) == brute(rows)
    assert render_maximal(spark.createDataFrame([], TURNS)).collect() == []
