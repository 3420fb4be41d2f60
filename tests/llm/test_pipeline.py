"""The pipeline against the brute-force stages, and on rows that could break it."""

from __future__ import annotations

import brute
from pyspark.sql import functions as F

import corpus_pipeline
from chirplake.llm import host_rules
from chirplake.llm import queries as q

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_agree_with_brute_force(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seen = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{number}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{number}")
        old = {r["doc_id"]: r["text"] for r in before.collect()}
        new = {r["doc_id"]: r["text"] for r in docs.collect()}
        seen.append((name, docs.columns, old, new))
    assert all(columns == COLUMNS for _, columns, _, _ in seen[:-1])
    old, new = seen[0][2:]
    passing = {d for d, t in old.items() if not brute.base_metrics(t)[-1]}
    judged = host_rules.judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert set(new) == {r[0] for r in judged.where("kept").select("doc_id").collect()} <= passing
    old, new = seen[1][2:]
    lines = {d: sha for d, _, _, sha in brute.line_dedup(list(old.items()))}
    assert {d: brute.sha(t) for d, t in new.items()} == lines
    old, new = seen[2][2:]
    assert set(new) == {d for d, _, c in brute.near_groups(list(old.items())) if d == c}
    old, new = seen[3][2:]
    assert set(new) == {r[0] for r in brute.decontaminate(list(old.items()), items) if not r[-1]}
    old, new = seen[4][2:]
    assert new == old
    run = corpus_pipeline.run(spark, sf_dir)
    assert run.exceptAll(docs).isEmpty() and docs.exceptAll(run).isEmpty()


def test_extra_columns_nulls_and_empty_tables(spark, sf_dir, tmp_path):
    good = "every word of this text is here once and so it passes all rules we have"
    rows = [(1, good, "en", "a", None), (1, good, "en", "a", None), (None, good, None, None, 3), (2, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("_tag", F.lit("t")).withColumn("n_lines", F.lit(5)).withColumn("_metrics", F.lit(1))
    for frame, wanted in ((docs, ["1", "1", "None"]), (docs.limit(0), [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            columns = frame.columns
            frame = stage(spark, frame, sf_dir)
            assert frame.columns == columns
        last = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir)
        assert sorted(str(r[0]) for r in last.collect()) == wanted


def test_entry_names_all_queries():
    import __spark_entry__

    assert {*q.QUERIES, "pipeline"} <= set(__spark_entry__.queries())
