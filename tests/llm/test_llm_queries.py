"""Every query against its SQL, the pipeline against brute force."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from mixloom.llm import decontaminate, language, queries, sql
from test_llm_pairs import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sql.QUERIES)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = con.execute(sql.QUERIES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = Counter(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == expected and expected


@pytest.mark.parametrize("name", set(queries.QUERIES) - set(sql.QUERIES))
def test_query_covers_its_table(spark, name):
    df = queries.QUERIES[name](spark, SF)
    ids = {r[0] for r in df.select("doc_id").distinct().collect()}
    every = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert ids < every if name.startswith("op2") else ids == every


def test_contaminated_documents_are_those_with_an_item(spark):
    found = {r.doc_id for r in queries.op2_benchmark_decontamination(spark, SF).collect()}
    words = lambda t: " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split())
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert found == {r.doc_id for r in docs if any(i in words(r.text) for i in items)}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept, names = docs, [name for name, _ in corpus_pipeline.STAGES]
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.shared_path(spark, "test")
        stage(spark, kept, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        outs.append(kept)
    assert names == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding"]
    assert all(out.columns == docs.columns for out in outs[:-1])
    texts = {r.doc_id: r.text for r in docs.collect()}
    told = {i for i, t in texts.items() if t and language.LETTER.search(t)}
    assert {r.doc_id for r in outs[0].collect()} == told
    fps = {i: brute_fingerprint(texts[i]) for i in told}
    root = brute_components(set(fps.values()))
    first = {}
    for i in sorted(told):
        first.setdefault(root[fps[i]], i)
    assert sorted(r.doc_id for r in outs[1].collect()) == sorted(first.values())
    leaks = {r.doc_id for r in decontaminate.contaminated(outs[1], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in outs[2].collect()} == set(first.values()) - leaks and leaks
    assert outs[4].count() == outs[3].count() and {r.shard for r in outs[4].collect()} <= set(range(40))
    whole = corpus_pipeline.run(spark, SF)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, outs[4].collect()))
