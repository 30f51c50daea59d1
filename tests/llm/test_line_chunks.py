import hashlib

from helpers import DOCS, WORD, corpus, rows_of

from clickforge.llm import line_chunks as L


def chunks(text, long_line=50):
    lines = text.split("\n")
    words = [len(WORD.findall(x)) for x in lines]
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines] + [0]
    r = [(h[i] * L.BASE + h[i + 1]) % L.MODULUS for i in range(len(lines))]
    starts = [i for i in range(len(lines)) if i == 0 or words[i] >= long_line or words[i - 1] >= long_line
              or (r[i] < r[i - 1] and (i + 1 == len(lines) or r[i] <= r[i + 1]))]
    out = []
    for s, e in zip(starts, [*starts[1:], len(lines)]):
        whole = sum(n > 0 for n in words[s:e]) >= 2 or words[s] >= long_line
        out.append((e - s, "\n".join(lines[s:e]), whole))
    return out


def brute(rows):
    """(id, text, lines, removed lines, removed chunks) of each row."""
    docs = sorted({(r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest(), r[0], r[1])
                   for r in rows if r[1] is not None})
    first, done = set(), {}
    for *_, doc_id, text in docs:
        kept, gone, n_gone = [], 0, 0
        for n, c, whole in chunks(text):
            if whole and c in first:
                gone, n_gone = gone + n, n_gone + 1
            else:
                kept.append(c)
                first |= {c} if whole else set()
        done[doc_id, text] = ("\n".join(kept) if n_gone else text, text.count("\n") + 1, gone, n_gone)
    return [(r[0], *(done[r[0], r[1]] if r[1] is not None else (None, 0, 0, 0))) for r in rows]


def _rows():
    rows = corpus(100)
    passage = "\n".join(f"shared line number {i} of a passage that goes around" for i in range(9))
    rows += [(200 + i, f"own start {i}\n{passage}\nown end {i}", "en", "s", 1) for i in range(5)]
    rows += [(300, "\n".join(["again and again"] * 9), "en", "s", 1), (301, "yes\nyes\n\nyes", "en", "s", 1), rows[0]]
    rows += [(None, passage, "en", "s", 1), (400, "\n\n\n", "en", "s", 1), (401, "\n\n\n", "en", "s", 1)]
    return rows


def test_matches_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n_lines", "2 as t", "3 as row", "4 as gone", "5 as id")
    assert rows_of(L.dedup_line_chunks(docs)) == sorted(brute(rows), key=repr)


def test_a_shared_passage_goes_but_for_its_first_place(spark):
    rows = _rows()
    got = {r.doc_id: r for r in L.dedup_line_chunks(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[200].n_removed_lines == 0
    assert all(got[200 + i].n_removed_lines >= 5 for i in range(1, 5))
    assert all(got[200 + i].text.startswith(f"own start {i}\n") for i in range(5))
    long_line = [r[1].split("\n")[-1] for r in rows if r[0] == 6][0]
    holders = [r[0] for r in rows if r[0] is not None and r[1] and long_line in r[1].split("\n")]
    assert len(holders) > 5 and [long_line in got[i].text for i in holders] == [True] + [False] * (len(holders) - 1)


def test_borders_shift_with_the_text():
    passage = "\n".join(f"line {i * 7919 % 1009} of it" for i in range(40))
    inner = {c for _, c, _ in chunks("head\n" + passage)} & {c for _, c, _ in chunks("some\nother\nhead\n" + passage)}
    assert sum(c.count("\n") + 1 for c in inner) >= 36


def test_stage_keeps_columns_and_drops_what_it_emptied(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n_lines", "2 as done")
    kept = L.without_repeats(docs)
    assert kept.columns == docs.columns
    want = [(i, t) for i, t, _, _, n in brute(rows) if not n or WORD.search(t)]
    assert rows_of(kept.select("doc_id", "text")) == sorted(want, key=repr)
    assert L.without_repeats(docs.limit(0)).collect() == [] == L.dedup_line_chunks(docs.limit(0)).collect()
