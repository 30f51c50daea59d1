import math
from collections import Counter

import pytest
from helpers import DOCS, WORD, corpus, rows_of

from clickforge.llm import quality as Q

LABELS = "doc_id long, quality int, toxic int"


def base(text):
    ws = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(ws[i:i + 5]) for i in range(len(ws) - 4)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 5))
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\n\t", "a b c d e a b c d e", "a a a a a a a a a", "x\nx\n\nx\ny", "#*$%&|<> ok",
         "é😀 ü\nnew\u00a0line\u2028 z", "p q r s t u p q r s t v w x y z p q r s t", "one two three four five",
         "w " * 3000, "\n".join(["same line here"] * 40), "\x0b\x0cform feed\x0b"]


def test_base_features_match_brute_force(spark):
    texts = TEXTS + [r[1] for r in corpus(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([], LABELS)
    for r in Q.judge_quality(docs, labels).collect():
        want = base(texts[r.doc_id])
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def _hash(spark, rows):
    """The engine's hash of tuples of values; strings within tuples of several are hashed first."""
    kinds = {}
    for r in set(rows):
        kinds.setdefault(len(r), []).append(r)
    out = {}
    for n, group in kinds.items():
        of = "xxhash64(c0)" if n == 1 else f"xxhash64(xxhash64(c0), xxhash64(c1){', 1' if n == 3 else ''})"
        df = spark.createDataFrame(group, ", ".join(f"c{i} string" for i in range(n)))
        out |= {tuple(r)[:-1]: r.h for r in df.selectExpr("*", f"{of} as h").collect()}
    return out


def test_score_matches_brute_force(spark):
    n, rows = 64, [r for r in corpus(60) if r[0] is not None]
    labels = [(i, int(i % 10 != 7), int(i % 11 == 0)) for i in range(50)] + [(3, 0, 0), (None, 1, 0), (1, None, None)]
    good = {i for i in range(50) if i % 10 != 7 and i % 11 and i not in (3, 1)}
    label_rows = spark.createDataFrame(labels, LABELS)
    trusted = {r.doc_id: r.held for r in Q.trusted_ids(label_rows, "doc_id").collect()}
    assert trusted.keys() == good and 0 < sum(trusted.values()) < len(good)
    grams = {}
    for i, text, *_ in rows:
        ws = WORD.findall(text or "")
        grams[i] = [(w,) for w in ws] + [(a[-2:], b[:2]) for a, b in zip(ws, ws[1:])] + [(w[:2], w[-2:], "") for w in ws]
    of = {k: h % n for k, h in _hash(spark, [g for gs in grams.values() for g in gs]).items()}
    raw, target = Counter(), Counter()
    for i, gs in grams.items():
        raw.update(of[g] for g in gs)
        target.update(of[g] for g in gs if trusted.get(i) is False)
    p = [(raw[b] + 1) / (sum(raw.values()) + n) for b in range(n)]
    weight = [math.log((target[b] + 4 * n * p[b]) / (sum(target.values()) + 4 * n)) - math.log(p[b]) for b in range(n)]
    want = {i: sum(weight[of[g]] for g in gs) / len(gs) if gs else 0.0 for i, gs in grams.items()}
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as kept", "2 as w", "3 as row", "4 as weights")
    held = sorted(want[i] for i, h in trusted.items() if h and len(WORD.findall(rows[i][1])) >= 10)
    at = 0.25 * (len(held) - 1)
    low = held[int(at)] + (at - int(at)) * (held[min(int(at) + 1, len(held) - 1)] - held[int(at)])
    for threshold in (0.0, None):
        got = Q.judge_quality(docs, label_rows, buckets=n, threshold=threshold, quantile=0.25).collect()
        for r in got:
            assert r.score == pytest.approx(want[r.doc_id], abs=1e-12)
            if abs(r.score - (low if threshold is None else threshold)) > 1e-9:
                assert r.kept == (not r.base_failed and r.score >= (low if threshold is None else threshold))


def test_sample_is_bounded_and_stable(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], LABELS)
    ids = {r.doc_id for r in Q.trusted_ids(labels, "doc_id", 10).collect()}
    assert len(ids) == 10 and ids == {r.doc_id for r in Q.trusted_ids(labels.repartition(7), "doc_id", 10).collect()}


def test_kept_rows_keep_their_columns(spark):
    rows = corpus(60)
    rows.append(rows[2])
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "true as kept", "2 as w", "3 as score", "4 as h")
    labels = spark.createDataFrame([(i, int(i % 10 != 7), 0) for i in range(40)], LABELS)
    judged = rows_of(Q.judge_quality(docs, labels).where("kept").select("doc_id"))
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and rows_of(kept.select("doc_id")) == judged
    assert (2,) in judged and judged.count((2,)) == 2
    assert Q.keep_good(docs.limit(0), labels).collect() == []
    assert Q.judge_quality(docs, labels.limit(0)).where("score <> 0").collect() == []


def test_held_out_labels(spark):
    """Trained on half of the labels, the verdict separates the other half."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    own = Q.judge_quality(docs, labels.where("doc_id % 2 = 0"))
    seen = own.join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    good = [r.kept for r in seen if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in seen if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


@pytest.mark.parametrize("half", (0, 1))
def test_held_out_toxic_documents(spark, half):
    """Trained on half of the labels, the verdict catches the toxic documents of the other half."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    own = Q.judge_quality(docs, labels.where(f"doc_id % 2 = {half}")).where("not base_failed")
    seen = own.join(labels.where(f"doc_id % 2 <> {half}"), "doc_id").groupBy("quality", "toxic").agg(
        {"kept": "count_if", "*": "count"}).collect()
    kept = {(r[0], r[1]): (r["count_if(kept)"], r["count(1)"]) for r in seen}
    print("kept, all by (quality, toxic):", half, kept)
    assert kept[1, 1][0] <= 0.1 * kept[1, 1][1] and kept[1, 0][0] >= 0.96 * kept[1, 0][1]


def test_marker_cut_weighs_both_sides():
    assert Q._marker_cut([], 1, 1) == Q.MARKER_RATIO
    assert Q._marker_cut([(True, 4.0), (True, 5.0), (False, 3.5)], 2, 100) > 3.5
    assert Q._marker_cut([(True, 4.0), (True, 5.0)], 2, 100) == Q.MARKER_RATIO


def test_every_labelled_document_counts(spark):
    """More labelled documents than any bound that was set before: none is left out."""
    labels = spark.range(60_000).selectExpr("id as doc_id", "1 as quality", "cast(id % 2 = 0 as int) as toxic")
    assert Q.trusted_ids(labels, "doc_id").count() == Q.toxic_ids(labels, "doc_id").count() == 30_000
    docs = labels.selectExpr("doc_id", "if(toxic = 1, 'bad word', 'good word') as text")
    sides = labels.selectExpr("doc_id", "doc_id % 3 = 0 as held", "toxic = 1 as toxic")
    words = {(r.n, r.good) for r in Q.fit_counts(docs, sides, "doc_id", "text", 64).where("of_words").collect()}
    assert words == {(20_000, 0), (20_000, 20_000)}


def test_quantile_is_exact(spark):
    import random
    rnd = random.Random(1)
    for n, q in ((1, 0.3), (2, 0.5), (500, 0.005), (501, 0.25), (77, 1.0)):
        xs = [rnd.choice((rnd.gauss(0, 1), 0.125, -0.5)) for _ in range(n)]
        df = spark.createDataFrame([(x,) for x in xs], "score double")
        assert Q._quantile(df, q) == pytest.approx(df.selectExpr(f"percentile(score, {q})").first()[0], abs=1e-12)
    assert Q._quantile(df.limit(0), 0.5) is None
