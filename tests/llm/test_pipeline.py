"""The pipeline over a small part of the driver's tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from firn.llm import queries
from firn.llm.common import written


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf_dir, "documents")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        if name != "tokens":
            assert after.columns == docs.columns
        after = written(after, f"test-{name}")
        left[name] = (after.count(), after.select("doc_id").distinct().count())
        if name in ("quality", "exact", "near"):
            assert after.select("doc_id").subtract(docs.select("doc_id")).count() == 0 and left[name][0] == left[name][1]
        docs = after
    assert 1000 > left["quality"][0] >= left["exact"][0] >= left["near"][0] > 500
    assert left["mix"] == left["tokens"]
    assert docs.where(F.col("n_tokens") != F.size("ids")).count() == 0


def test_stages_on_odd_rows(spark, docs, empty):
    """Nulls, ties, repeated rows, long texts, extra columns whose names clash, and an empty table through every stage."""
    sf_dir = "/root/testdata/sf0.01"
    odd = docs.selectExpr("*", "1 AS `a.b`", "2 AS fp", "3 AS head", "4 AS expected_grade", "5 AS copies")
    for table in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = written(stage(spark, table, sf_dir), f"odd-{name}")
            n = after.count()
            assert (n > 0) == (table.count() > 0) or name == "mix"
            if name == "tokens":
                assert n == table.count()
            else:
                assert after.columns == table.columns
            if name in ("quality", "exact", "near"):
                assert n <= table.count()


def test_clean_documents_stay(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = queries.table(spark, sf_dir, "documents")
    good = queries.table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    kept = corpus_pipeline.quality(spark, docs, sf_dir).join(good, "doc_id", "left_semi").count()
    assert kept > 0.97 * docs.join(good, "doc_id", "left_semi").count()


def test_stages_do_not_touch_each_other(spark, docs):
    """Results that are built and not yet read stay readable, whatever runs in between."""
    plain = docs.where("doc_id IS NOT NULL")
    first, second = corpus_pipeline.exact(spark, plain, ""), corpus_pipeline.near(spark, plain, "")
    third = corpus_pipeline.exact(spark, plain.where("doc_id > 5"), "")
    corpus_pipeline.near(spark, plain, "").count()
    assert third.count() < first.count() and second.count() <= first.count()


def test_run_leaves_its_result_alone(spark, tmp_path):
    """run() over a small table, twice: both results can be read, and no other table of the runs is left."""
    import os

    from firn.llm import common

    for name in ("documents", "labels"):
        queries.table(spark, "/root/testdata/sf0.001", name).write.parquet(f"file://{tmp_path}/{name}.parquet")
    folder = common.shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(folder))
    a, b = (corpus_pipeline.run(spark, f"file://{tmp_path}") for _ in range(2))
    assert a.count() == b.count() > 0
    assert len({f for f in set(os.listdir(folder)) - before if "-" in f}) == 2
