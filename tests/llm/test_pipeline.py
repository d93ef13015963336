"""The registered queries against their SQL, and the pipeline against plain versions of its stages."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tallybook.llm import pii_crf, quality_fm
from tallybook.llm.queries import ORACLE, QUERIES
from testbed.compare import connect, duckdb_rows, spark_rows

from .test_duplicates import plain_duplicates


def test_queries_are_registered():
    assert {*QUERIES, "pipeline"} <= set(__spark_entry__.queries())
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near-duplicates", "personal-data", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_is_its_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duckdb_rows(connect(sf_dir), ORACLE[name])


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = spark.createDataFrame([(None, "without id and quite clean", "en", "s", 26), (10**6, None, None, None, None),
                                   (10**6 + 1, "", "en", "s", 0), (0, docs.where("doc_id = 0").first().text, "fr", "src0", 1)],
                                  docs.schema)
    docs = docs.unionByName(extra)
    (_, quality), (_, near), (_, private), (_, packing) = corpus_pipeline.STAGES
    first = quality(spark, docs, sf_dir).cache()
    machine = quality_fm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_fm.score(docs, machine, name="s").where("s >= 0.3")
    assert first.columns == docs.columns and first.count() == scored.count() < docs.count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert first.join(labels.where("quality = 1"), "doc_id").select("doc_id").distinct().count() >= 0.98 * docs.join(
        labels.where("quality = 1"), "doc_id").select("doc_id").distinct().count()

    second = near(spark, first, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in first.collect()]
    whole = plain_duplicates(rows, 5, 80)
    assert second.columns == docs.columns
    assert sorted(str(r.doc_id) for r in second.collect()) == sorted(
        [str(i) for i in whole if whole[i] == i] + ["None"] * sum(i is None for i, _ in rows))

    third = private(spark, second, sf_dir).cache()
    field = pii_crf.train_table(pii_crf.labelled_table(spark))
    assert third.columns == docs.columns and third.count() == second.count()
    assert pii_crf.find(third, field).where("base <> ''").count() == 0
    clean = pii_crf.find(second, field).where("spans = ''").select("doc_id")
    assert third.join(clean, "doc_id").join(second.select("doc_id", F.col("text").alias("old")), "doc_id").where(
        "NOT text <=> old").count() == 0

    pieces = packing(spark, third, sf_dir)
    assert pieces.select("doc_id").distinct().count() == third.select("doc_id").distinct().count()
    assert pieces.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).where("n <> doc_tokens").count() == 0


def test_columns_of_any_name_are_carried_through(spark, sf_dir):
    names = ("_score", "_kept", "score", "component_id", "id", "kept", "n", "host")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumns({name: F.col("doc_id") for name in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns[-len(names):] == list(names)
        assert docs.where(" OR ".join(f"{name} <> doc_id" for name in names)).count() == 0 < docs.count()


def test_run_over_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
