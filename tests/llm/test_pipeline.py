"""The pipeline's stages on small tables, each against what it promises."""

from pyspark.sql import functions as F

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kinds = docs.dtypes
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        seen[name] = docs.collect()
        assert docs.dtypes == kinds
    ids = {name: [r.doc_id for r in rows] for name, rows in seen.items()}
    assert set(ids["near_dedup"]) <= set(ids["line_dedup"]) == set(ids["quality_rules"]) <= set(texts)
    assert len(ids["near_dedup"]) == len(set(ids["near_dedup"]))
    assert all(texts[r.doc_id] == r.text for r in seen["quality_rules"])
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == len(ids["mix_sources"])


def test_odd_rows_pass_through(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None), (2, "", "a"), (3, good, None), (3, good, None), (None, good + " more", "a"), (4, "é " * 50_000, "b")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id bigint, text string, source string, n_chars int, __row string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        once = stage(spark, docs, SF_DIR)
        assert once.columns == docs.columns
        once.count()
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    kept = corpus_pipeline.STAGES[2][1](spark, docs, SF_DIR)
    assert kept.filter(F.col("doc_id") == 3).count() == 1
