"""Near-duplicate vectors: against all pairs, in split cells, with odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickforge.llm import multi_index
from clickforge.llm.multi_index import Index, multi_sequence, near_duplicates, unit

VECTORS = "vec_id long, embedding array<double>, label int"


def brute(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    def ok(r):
        return r[2] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    use = [i for i, r in enumerate(rows) if ok(r)]
    dims = [len(rows[i][1]) for i in use]
    dim = max(set(dims), key=lambda d: (dims.count(d), d)) if dims else 0
    use = [i for i in use if len(rows[i][1]) == dim]
    x = unit(np.array([rows[i][1] for i in use])) if use else np.zeros((0, 1))
    near = (x @ x.T >= threshold) & (np.array([rows[i][2] for i in use])[:, None] == np.array([rows[i][2] for i in use])[None])
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links = [0] * len(rows)
    for p, q in np.argwhere(near).tolist():
        if p != q:
            links[use[p]] += 1
            root[find(use[p])] = find(use[q])
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], least.get(find(i)), r[0] == least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


def table(n=400, dim=24, seed=1, spread=0.9):
    """Random vectors of four labels and groups of near copies with cosines around the threshold."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rows.append((i, rng.standard_normal(dim).tolist(), int(rng.integers(0, 4))))
        if i % 4 == 0:
            for k in range(int(rng.integers(1, 6))):
                x = np.array(rows[-1][1])
                noise = rng.standard_normal(dim) * np.linalg.norm(x) / dim ** 0.5
                rows.append((1000 + 10 * i + k, ((x + noise * spread * rng.random()) * rng.random() * 9).tolist(), rows[-1][2]))
    return rows


def test_all_links_of_random_vectors(spark):
    """Recall over all pairs, nothing below the threshold."""
    rows = table()
    want, found = brute(rows, 0.9), rows_of(near_duplicates(spark.createDataFrame(rows, VECTORS), 0.9))
    assert sum(r[1] for r in want) > 200
    missed = sum(w[1] - f[1] for w, f in zip(want, found))
    assert all(f[1] <= w[1] for w, f in zip(want, found))
    assert missed <= 0.005 * sum(r[1] for r in want)


def test_split_cells_copies_and_odd_rows(spark, monkeypatch):
    """Blocks of few vectors; a vector that a third of the rows share; near copies in one cell."""
    monkeypatch.setattr(multi_index, "BLOCK", 7)
    monkeypatch.setattr(multi_index, "VISITORS", 11)
    rng = np.random.default_rng(4)
    rows = table(60, 8, 3)
    hot = rng.standard_normal(8)
    rows += [(20_000 + i, hot.tolist(), 1) for i in range(150)]
    rows += [(30_000 + i, (hot + rng.standard_normal(8) * 0.05).tolist(), 1 + i % 2) for i in range(120)]
    rows += [(None, hot.tolist(), 1), (None, [1.0] * 8, 3), (40_000, None, 1), (40_001, [], 1), (40_002, [0.0] * 8, 1),
             (40_003, [None] * 8, 1), (40_004, [math.nan] * 8, 1), (40_005, [math.inf] * 8, 1), (40_006, hot.tolist(), None),
             (40_007, [1.0, 2.0], 1), (40_008, (hot * 1e200).tolist(), 1), (40_009, (hot * 1e-200).tolist(), 1),
             (0, hot.tolist(), 1), (0, hot.tolist(), 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("node", "v", "kept", "row", "h")})
    got = near_duplicates(df, centroids=3, target=1.0)
    assert set(df.columns) | {"n_links", "component_id"} == set(got.columns)
    assert rows_of(got) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 0.0], 1)], [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1)]])
def test_few_rows(spark, rows):
    assert rows_of(near_duplicates(spark.createDataFrame(rows, VECTORS))) == brute(rows)


def test_traversal_goes_by_ascending_sums_and_stops():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    every = sorted((a[i] + b[j], i, j) for i in range(9) for j in range(7))
    got = list(multi_sequence(a, b, 0.7))
    assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in every if s <= every[0][0] + 0.7])
    assert len({(i, j) for _, i, j in got}) == len(got) < 63


def test_margin_prunes_and_cells_are_numbered_by_the_grid():
    x = unit(np.random.default_rng(3).standard_normal((3_000, 32)))
    index = Index(x, 16, 0.93, 0.99, 1)
    seen = [len(v) for v in index.visits(x[:200])]
    assert np.mean(seen) < 0.25 * 256
    d = index.distances(x[:5])
    for k, v in enumerate(index.visits(x[:5])):
        assert v[0] == d[0][k].argmin() * 16 + d[1][k].argmin()
