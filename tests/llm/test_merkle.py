"""Merkle manifest: against a brute-force tree, over several checkpoints, odd rows included."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from clickforge.llm.merkle import manifest, verified_manifest
from helpers import DOCS, corpus


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    i, text, lang, source, n = row
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([H(*own[k:k + 2]) for k in range(0, len(own), 2)])
    return levels


def path(levels, pos):
    out = []
    for own in levels[:-1]:
        out.append(own[pos ^ 1] if pos ^ 1 < len(own) else None)
        pos //= 2
    return out


def fold(d, pos, siblings):
    for s in siblings:
        d = H(s, d) if pos % 2 else H(d, s or "")
        pos //= 2
    return d


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in groups[g]])
    top, out = tree([trees[g][-1][0] for g in names]), []
    for k, g in enumerate(names):
        for pos, r in enumerate(groups[g]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            seen = (*r[:4], r[4] + 1) if bad else r
            own, over = path(trees[g], pos), path(top, k)
            got = fold(fold(leaf(seen), pos, own), k, over)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], H(*[s for s in own + over if s]), got, got == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


def check(spark, rows, **how):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = verified_manifest(docs, tampered(), **how)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found, want = rows_of(got), brute(rows)
    assert found == want
    return found


def test_odd_rows(spark):
    rows = corpus(90)
    rows += [(5, "twin", None, "s", 4)] * 3 + [(None, None, None, None, None)] * 2 + [(7, "é" * 9, "", "ü", None)]
    found = check(spark, rows)
    assert any(not r[-1] for r in found) and any(r[-1] for r in found)


def test_many_checkpoints_and_groups(spark):
    """Groups of 1 to 300 leaves over checkpoints of every second level, and 70 groups."""
    sizes = {f"g{k}": k for k in (1, 2, 3, 4, 5, 15, 16, 17, 64, 65, 300)} | {f"x{k:02}": 1 for k in range(59)}
    rows, i = [], 0
    for g, n in sizes.items():
        for _ in range(n):
            rows.append((i * 37 % 10_007, f"text {i}", g, "s", i))
            i += 1
    docs = spark.createDataFrame(rows, DOCS)
    own = manifest(docs, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], stride=2)
    found = sorted((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in own.collect())
    assert found == sorted(r[:5] for r in brute(rows))
    assert max(len(r.path) for r in own.collect()) == 9  # 300 leaves


def test_one_row_and_none(spark):
    assert check(spark, [(3, "a", "en", "s", 1)])[0][1] == check(spark, [(3, "a", "en", "s", 1)])[0][3]
    empty = verified_manifest(spark.createDataFrame([], DOCS), tampered())
    assert empty.count() == 0


def test_extra_columns_that_clash(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(10)]
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("pos", "n", "d", "grp", "id", "path", "seen", "root", "leaf", "_part"):
        docs = docs.withColumn(c, F.lit("x"))
    assert rows_of(verified_manifest(docs, tampered())) == brute(rows)


@pytest.mark.parametrize("column", ["text", "source", "n_chars", "lang", "doc_id"])
def test_any_null_column(spark, column):
    at = DOCS.split(", ").index(next(f for f in DOCS.split(", ") if f.startswith(column + " ")))
    rows = [tuple(None if k == at and i % 2 else v for k, v in enumerate((i, f"t{i}", "en", "s", i))) for i in range(9)]
    check(spark, rows)
