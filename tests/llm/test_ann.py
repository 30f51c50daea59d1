import itertools

import numpy as np
import pytest

from clickforge.llm import ann as A

VECS = "vec_id long, embedding array<float>, label int"


def brute(base, queries, k):
    out = {}
    for q, x in queries:
        near = {}
        for i, y in base:
            if i != q:
                near[i] = max(near.get(i, -np.inf), float(np.dot(x.astype(np.float64), y.astype(np.float64))))
        out[q] = sorted(((-s, i) for i, s in near.items()))[:k]
    return out


def recall(df, want, k):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((-r.score, r.vec_id))
    for q, rows in got.items():
        assert rows == sorted(rows) and q not in [i for _, i in rows] and len(set(rows)) == len(rows)
        assert len(rows) == len(want[q])
    hits = sum(len({i for _, i in got.get(q, [])} & {i for _, i in w}) for q, w in want.items())
    return hits / max(1, sum(map(len, want.values())))


def _frame(spark, vectors):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in vectors], VECS)


def test_probes_come_in_order_of_their_cost():
    walls = np.array([0.1, 0.7, 0.45])
    cost = lambda moves: sum(walls[j] ** 2 if s < 0 else (1 - walls[j]) ** 2 for j, s in moves)
    got = A.probe_order(walls, 27)
    assert got[0] == [] and len(got) == 27 and len({tuple(sorted(m)) for m in got}) == 27
    assert [cost(m) for m in got] == sorted(cost(m) for m in got)
    every = [[(j, s) for j, s in enumerate(c) if s] for c in itertools.product((-1, 0, 1), repeat=3)]
    assert sorted(map(cost, every)) == pytest.approx([cost(m) for m in got])


@pytest.mark.parametrize("block", [4096, 40])
def test_recall_on_random_vectors_of_different_norms(spark, monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = [(i, (rng.standard_normal(16) * rng.uniform(0.5, 2)).astype(np.float32)) for i in range(400)]
    df = _frame(spark, base)
    got = A.search(df, df.where("vec_id % 20 = 0"), k=10)
    assert recall(got, brute(base, base[::20], 10), 10) >= 0.9


def test_copies_odd_rows_and_ties(spark):
    rng = np.random.default_rng(5)
    common = rng.standard_normal(8).astype(np.float32)
    base = [(i, common) for i in range(100)] + [(i, rng.standard_normal(8).astype(np.float32)) for i in range(100, 160)]
    odd = [(200, None), (220, []), (240, [0.0] * 8), (260, [float("nan")] + [1.0] * 7), (280, [float("inf")] * 8),
           (300, [None] + [1.0] * 7), (320, [1.0] * 5), (None, [1.0] * 8), base[0]]
    df = _frame(spark, base + odd).selectExpr("*", "1 as id", "2 as v", "3 as score")
    queries = [b for b in base if b[0] % 20 == 0]
    got = A.search(df, df.where("vec_id % 20 = 0"), k=20)
    assert {r.query_id for r in got.collect()} == {q for q, _ in queries}
    want = brute(base, queries, 20)
    assert recall(got, want, 20) >= 0.95
    for q in (0, 20):  # all nearest are copies: the smallest ids, exactly
        assert [r.vec_id for r in sorted(got.collect(), key=lambda r: r["rank"]) if r.query_id == q] == [i for _, i in want[q]]


def test_few_candidates_are_all_found(spark):
    rng = np.random.default_rng(8)
    base = [(i, rng.standard_normal(32).astype(np.float32)) for i in range(12)]
    df = _frame(spark, base)
    got = A.search(df, df.where("vec_id % 4 = 0"), k=20, probes=1, tables=1)
    assert recall(got, brute(base, base[::4], 20), 20) == 1.0
    assert A.search(df.limit(0), df.limit(0)).collect() == []
    assert A.search(df.limit(1), df.limit(1)).collect() == []


def test_recall_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    base = [(r.vec_id, np.array(r.embedding, np.float32)) for r in df.collect()]
    got = A.search(df, df.where("vec_id % 20 = 0"), k=20)
    assert recall(got, brute(base, [b for b in base if b[0] % 20 == 0], 20), 20) >= 0.9


def test_sets_that_share_their_least_id_are_merged_apart(spark):
    found = spark.createDataFrame([(1, 0.9, [5, 7]), (1, 0.8, [5, 9]), (1, 0.9, [5, 7])],
                                  "query_id long, score double, ids array<long>")
    got = [tuple(r) for r in A._merged(found, 3).orderBy("rank").collect()]
    assert got == [(1, 1, 5, 0.9), (1, 2, 7, 0.9), (1, 3, 9, 0.8)]
