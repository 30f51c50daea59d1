import hashlib
from collections import Counter

from helpers import DOCS, WORD, corpus, rows_of

from clickforge.llm import mixing as M


def water(sizes, weights, share=1.5):
    """Targets by resharing round by round."""
    out, open_, rest = {}, set(sizes), share * sum(sizes.values())
    while open_:
        level = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] >= 2 * sizes[s]}
        if not full:
            return out | {s: level * weights[s] for s in open_}
        for s in full:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
        open_ -= full
    return out


def brute(rows):
    docs = [(r[0], r[3], len(WORD.findall(r[1] or "")), hashlib.md5((r[1] or "").encode()).hexdigest()) for r in rows]
    names = sorted({d[1] for d in docs}, key=lambda s: (s is None, (s or "").encode()))
    sizes = {s: sum(d[2] for d in docs if d[1] == s) for s in names}
    target = water(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)})
    out = []
    for s in names:
        own = sorted([d for d in docs if d[1] == s], key=lambda d: (hashlib.md5("|".join(
            ["mix", *([str(d[0])] if d[0] is not None else []), d[3]]).encode()).hexdigest(), d[0] is not None, d[0] or 0))
        most, pos = min(int(target[s] + 0.5), 2 * sizes[s]), 0
        for doc_id, _, n, _ in own:  # whole epochs, and the words of the last one up to the target
            times, rest = divmod(most, sizes[s]) if sizes[s] else (0, 0)
            out.append((doc_id, n, sizes[s], round(target[s], 6), times * n + max(0, min(pos + n, rest) - pos)))
            pos += n
    return sorted(out, key=repr)


def _rows():
    rows = corpus(90)
    return rows + [rows[4], (500, "rare source words", "en", "\U0001F600", 1), (501, "b", "en", "ÿ", 1),
                   (502, None, "en", "only empty", 1), (None, "other words without an id", "en", "s0", 1)]


def test_matches_brute_force(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as size", "2 as target", "3 as id", "4 as sid")
    for block in (8, 128):
        got = M.mix_documents(docs, block_words=block)
        assert sorted([(*r[:3], round(r[3], 6), r[4]) for r in rows_of(got)], key=repr) == brute(rows)


def test_points_are_exact_beyond_two_to_the_31(spark):
    slots = [0, 1, 5, 2 ** 31 - 1, 2 ** 32 + 3, 10 ** 12]
    df = spark.createDataFrame([(s,) for s in slots], "slot long")
    got = [r[0] for r in df.select(M._point(df["slot"])).collect()]
    assert got == [s * M.GOLDEN % 2 ** 32 for s in slots]


def test_every_stretch_is_near_the_targets(spark):
    sized = spark.createDataFrame([("a", 6000), ("b", 1000), (None, 3000)], "source string, size long")
    sources = M.blocked(M.weighed_sources(sized), 10)
    n_slots = {r.sid: r.n_slots for r in sources.collect()}
    target = {r.sid: r.target for r in sources.collect()}
    assert all(t / 10 <= n_slots[s] < t / 10 + 1 for s, t in target.items())
    slots = sorted(M.schedule(sources).collect(), key=lambda r: r.slot)
    assert Counter(r.sid for r in slots) == n_slots
    for at in range(0, len(slots) - 200, 100):
        part = Counter(r.sid for r in slots[at:at + 200])
        assert all(abs(part[s] - 200 * t / sum(target.values())) <= 6 for s, t in target.items())
    seen = {}
    for r in slots:  # blocks in turn, then again
        n = seen.get(r.sid, 0)
        blocks = {1: 600, 2: 100, 3: 300}[r.sid]
        assert (r.block, r.epoch) == (n % blocks, n // blocks)
        seen[r.sid] = n + 1


def test_a_long_tail_of_small_sources(spark):
    """1,000 sources of 20 to 100 words beside one of 200,000: each takes its target."""
    rows = [(i, "w " * (20 + i * 7 % 81), "en", f"t{i:04}", 1) for i in range(1000)]
    rows += [(5000 + i, "h " * 1000, "en", "hot", 1) for i in range(200)]
    taken, target = Counter(), {}
    for r in M.mix_documents(spark.createDataFrame(rows, DOCS)).join(
            spark.createDataFrame(rows, DOCS).select("doc_id", "source"), "doc_id").collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items()) and len(target) == 1001


def test_rows_of_one_id(spark):
    """Many rows with a null id, told apart by their text."""
    rows = [(None, f"some words and {i}", "en", "s", 1) for i in range(300)] + [(None, "same", "en", "s", 1)] * 40
    got = rows_of(M.mix_documents(spark.createDataFrame(rows, DOCS), block_words=16))
    assert sum(r[4] for r in got) == int(got[0][3] + 0.5) and len(got) == 340


def test_reruns_agree_and_skewed_source(spark):
    rows = [(i, "w " * (1 + i % 50), "en", "hot" if i % 3 else f"s{i % 4}", 1) for i in range(600)]
    a, b = (M.mix_documents(spark.createDataFrame(rows, DOCS).repartition(n), block_words=16) for n in (3, 11))
    assert rows_of(a) == rows_of(b)


def test_mixed_rows_hold_the_taken_words(spark):
    rows = [r for r in _rows()]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as _row", "2 as _part", "3 as _take")
    mixed = M.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    got, copies = Counter(), Counter(rows)
    for r in mixed.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
        whole = [x[1] for x in rows if x[0] == r.doc_id]
        assert any(r.text == w or " ".join(WORD.findall(w)).startswith(r.text) for w in whole if w)
    want, ids = {}, Counter(r[0] for r in rows)
    for r in M.mix_documents(docs, block_words=16).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert {i: n for i, n in want.items() if n and ids[i] == 1} == {i: n for i, n in got.items() if ids[i] == 1}
    assert abs(sum(want.values()) - sum(got.values())) <= 64 and copies[rows[4]] == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    assert M.mix_documents(docs).collect() == [] == M.mixed_documents(docs).collect()
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, " ", None, None, None)], DOCS)
    assert rows_of(M.mix_documents(blank)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert M.mixed_documents(blank).collect() == []
