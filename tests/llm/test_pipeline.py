"""The pipeline on the smallest tables, and the operators' plans."""

import duckdb

import corpus_pipeline
from bookpipe.llm import decontaminate, fingerprints, minhash
from bookpipe.llm.common import table
from bookpipe.llm.queries import LEAKS_SQL


def test_stages_keep_columns_and_follow_each_other(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns, name
        before = spark.createDataFrame(after.toPandas(), docs.schema)
    labels = table(spark, sf_dir, "labels")
    assert minhash.near_duplicates(before).where("not kept").count() == 0
    assert decontaminate.leaks(before, table(spark, sf_dir, "benchmark")).count() == 0
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    first = corpus_pipeline.judge_quality(spark, corpus_pipeline.identify_language(spark, docs, sf_dir), sf_dir)
    assert good.join(first, "doc_id", "left_anti").count() <= 0.01 * good.count() + 1
    ids = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert ids == {r.doc_id for r in before.collect()}


def test_leaks_equal_their_sql(spark, sf_dir):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    want = sorted(db.execute(f"select doc_id, item_id, start, similarity from ({LEAKS_SQL})").fetchall())
    got = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_native_plans_hold_no_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    items = decontaminate.items_of(table(spark, sf_dir, "benchmark"))
    for df in (fingerprints.edits(docs), decontaminate.hits(docs, decontaminate.item_shingles(items, 5), 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
