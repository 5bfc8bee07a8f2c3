"""The registered queries against DuckDB where SQL can express them, and the pipeline by stages."""
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyframe.llm import decontaminate, fair_mix, lang_crf, near_dedup, queries

from ..conftest import SF_SMALL
from ..test_oracles import canon
from .test_operators import brute_components, library_ids


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(queries.SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, cur.fetchall())


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, stages = docs.columns, [f for _, f in corpus_pipeline.STAGES]
    after = [docs]
    for stage in stages:
        after.append(corpus_pipeline.written(stage(spark, after[-1], SF_SMALL), "test"))
    assert all(d.columns == columns for d in after[:-1])
    ids = [sorted(r[0] for r in d.select("doc_id").collect()) for d in after]
    labelled = lang_crf.identify(docs).filter("lang_pred != 'und' and score >= 0.3")
    assert ids[1] == sorted(r["doc_id"] for r in labelled.collect())
    rows = [(r["doc_id"], r["text"]) for r in after[1].collect()]
    groups = brute_components(rows, 5, 80)
    assert ids[2] == sorted(i for i, (_, c) in groups.items() if i == c)
    bad = {r["doc_id"] for r in decontaminate.contaminated(after[2], spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    assert ids[3] == [i for i in ids[2] if i not in bad]
    copies = {r["doc_id"]: r["copies"] for r in fair_mix.mix(after[3]).collect()}
    assert Counter(ids[4]) == Counter({i: n for i, n in copies.items() if n})
    texts = dict(rows)
    lengths = dict(zip(texts, map(len, library_ids(list(texts.values())))))
    assert sorted((r["doc_id"], r["n_tokens"]) for r in after[5].collect()) == sorted((i, lengths[i]) for i in ids[4])
    total = after[5].agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0]
    assert total == sum(lengths[i] for i in ids[4])


def test_pipeline_on_no_documents(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_dedup_keeps_first_of_group(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.groupBy("doc_id").count().filter("count > 1").count() == 0
