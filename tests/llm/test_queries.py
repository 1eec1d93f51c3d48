"""Queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from tagloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = df.select(columns).collect()
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, seen, SF)
        if k < 4:
            assert out.columns == columns and dict(out.dtypes) == dict(docs.dtypes)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage{k}"
        out.write.mode("overwrite").parquet(path)
        seen = spark.read.parquet(path)
    whole = {(r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {(r["doc_id"], r["ids_sha256"]) for r in seen.collect()}
    path = lambda k: f"{spark.conf.get('spark.checkpoint.dir')}/stage{k}"
    ids = [{r["doc_id"] for r in spark.read.parquet(path(k)).collect()} for k in range(4)]
    rules = queries.op6_quality_rules(spark, SF)
    assert ids[0] == {r["doc_id"] for r in rules.where("kept").collect()}
    assert ids[1] <= ids[0] and ids[2] == ids[1] and ids[3] <= ids[2]
    # Brute force over what stage 1 kept: one document of each group of linked ones stays.
    from tests.llm.test_pairs_and_spans import linked

    kept = [(r["doc_id"], r["text"]) for r in spark.read.parquet(path(0)).collect()]
    assert ids[1] == {component for _, _, component, _ in linked(kept)}
    from tests.llm.test_pairs_and_spans import removal

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(path(2)).collect()}
    before = [(r["doc_id"], r["text"]) for r in spark.read.parquet(path(1)).collect()]
    for doc, n, gone, _, _ in removal(before, 100):
        assert 0 <= len(texts[doc].encode()) - (n - gone) <= 6  # characters go only as a whole
