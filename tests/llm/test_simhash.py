import numpy as np
import pytest
from helpers import DOCS, classes, corpus, rows_of, simhash
from hypothesis import given, settings
from hypothesis import strategies as st

from clickforge.llm import simhash as S


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbZé \n\t  x", max_size=60))
def test_fingerprint_is_the_definition(text):
    assert S.fingerprint(text) == simhash(text)


def test_fingerprint_of_a_long_text_does_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(9000))
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "SHINGLE_BLOCK", 100)
    assert S.fingerprint(text) == whole


@pytest.mark.parametrize("tau,segments", [(0, 1), (3, 5), (4, 5), (4, 6), (4, 7), (4, 8), (4, 9)])
def test_every_near_pair_shares_a_viable_chain(tau, segments):
    ring, rng = S.Pigeonring(tau, segments), np.random.default_rng(tau)
    for _ in range(400):
        flips = rng.choice(64, rng.integers(0, tau + 1), replace=False)
        differing = sum(1 << int(f) for f in flips)
        starts = [s for s, mask in ring.keys if not differing & mask]
        assert len(ring.linked(np.full(len(starts), differing, np.uint64), np.array(starts, np.int64)))
    far = sum(1 << int(f) for f in rng.choice(64, tau + 1, replace=False))
    assert not len(ring.linked(np.full(len(ring.keys), far, np.uint64), np.array([s for s, _ in ring.keys])))


@pytest.mark.parametrize("small,block", [(8, 4096), (2, 4096), (8, 5)])
def test_links_connect_as_brute_force(spark, monkeypatch, small, block):
    """Chains, tight clusters and single fingerprints; large groups and split groups too."""
    monkeypatch.setattr(S, "SMALL", small)
    monkeypatch.setattr(S, "BLOCK", block)
    rng, fps = np.random.default_rng(1), []
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(25):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            fps.append(centre ^ sum(1 << int(f) for f in flips))
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    pairs = S.links(df).collect()
    mask = (1 << 64) - 1
    assert all(((p.a ^ p.b) & mask).bit_count() <= 4 for p in pairs)
    root = {r.node: r.root for r in S.connected_components(S.links(df)).collect()}
    want = classes([f & mask for f in fps])
    seen = {}
    for f, w in zip(fps, want):
        assert seen.setdefault(w, root.get(f, f)) == root.get(f, f)
    assert len(set(seen.values())) == len(seen)


def _want(rows):
    fps = [simhash(r[1]) for r in rows]
    first = classes(fps)
    least = {}
    for r, c in zip(rows, first):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return sorted([(r[0], f"{f:016x}", least.get(c)) for r, f, c in zip(rows, fps, first)], key=repr)


def test_components_match_brute_force(spark):
    """Null id, null and empty texts (linked by their zero fingerprints), copies, a repeated
    row, and extra columns named like the results."""
    rows = corpus()
    rows.append(rows[5])
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as fp", "'x' as fingerprint", "2 as component_id")
    assert rows_of(S.simhash_components(docs)) == _want(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert S.simhash_components(docs).collect() == []
    assert S.drop_near_duplicates(docs).collect() == []


def test_one_row_of_each_group_stays(spark):
    rows = corpus()
    rows += [rows[5], (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as _row", "map('a', 1) as m")
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    least = {c for _, _, c in _want(rows) if c is not None}
    alone = [r for r in rows if r[0] is None and (None, f"{simhash(r[1]):016x}", None) in _want(rows)]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(least)
    assert sum(r.doc_id is None for r in kept.collect()) == len(set(alone))
