import hashlib
import os

import duckdb
import pytest
from helpers import DOCS, WORD, classes, corpus, rows_of, simhash

import __spark_entry__ as entry
import corpus_pipeline as P
from clickforge.llm import queries, sql
from clickforge.llm.quality import judge_quality


def _tables(spark, folder, rows):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i % 10 != 7), 0) for i in range(0, 120, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages_one_by_one(spark, tmp_dir):
    """Each stage against brute force on its own input; run() gives the last one's rows."""
    import test_line_chunks
    import test_mixing

    _tables(spark, tmp_dir, corpus(120))
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    stage = dict(P.STAGES)
    good = stage["quality"](spark, docs, tmp_dir).cache()
    kept = {r.doc_id for r in good.collect()}
    assert good.columns == docs.columns and rows_of(good) == [r for r in rows_of(docs) if r[0] in kept]
    judged = judge_quality(docs, spark.read.parquet(f"{tmp_dir}/labels.parquet")).where("kept")
    assert kept == {r.doc_id for r in judged.collect()}
    assert len([i for i in kept if i and i % 10 == 7]) <= 3 and len(kept) >= 90
    rows = [tuple(r) for r in good.collect()]
    lines = stage["line_dedup"](spark, good, tmp_dir).cache()
    want = [(i, t) for i, t, _, _, n in test_line_chunks.brute(rows) if not n or WORD.search(t)]
    assert rows_of(lines.select("doc_id", "text")) == sorted(want, key=repr)
    near = stage["near_dedup"](spark, lines, tmp_dir).cache()
    left = sorted(want)
    first = classes([simhash(t) for _, t in left])
    assert rows_of(near.select("doc_id", "text")) == sorted([left[i] for i in set(first)], key=repr)
    mixed = stage["mixing"](spark, near, tmp_dir).cache()
    took = {}
    for r in mixed.collect():
        took[r.doc_id] = took.get(r.doc_id, 0) + len(WORD.findall(r.text))
    brute = test_mixing.brute([tuple(r) for r in near.collect()])
    assert took == {i: n for i, _, _, _, n in brute if n}
    done = P.run(spark, tmp_dir)
    assert sorted((r.doc_id, r.decoded_sha256) for r in done.collect()) == sorted(
        (r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in mixed.collect())


def test_empty_documents(spark, tmp_dir):
    _tables(spark, tmp_dir, [])
    assert P.run(spark, tmp_dir).collect() == []


def test_registered_queries():
    own = queries.queries()
    assert {f"op{i}_" for i in range(1, 14)} == {k.split("_")[0] + "_" for k in own}
    assert own.keys() <= entry.queries().keys() and "pipeline" in entry.queries()
    assert sql.ORACLES.keys() <= own.keys() and sql.ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_queries_match_their_sql(spark, name):
    from check_oracle import canon
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "pages", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(sf, t)}.parquet')")
    cur = con.execute(sql.ORACLES[name])
    df = queries.queries()[name](spark, sf)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([c[0] for c in cur.description], cur.fetchall())
