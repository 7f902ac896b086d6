"""The pipeline's stages against brute-force versions of their decisions on one table."""

from __future__ import annotations

import corpus_pipeline
from riskframe.llm.common import saved
from riskframe.llm.queries import QUERIES
from tests.llm.test_jaccard import brute
from tests.llm.test_operators import odd

FOLDER = "/root/testdata/sf0.01"


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_each_stage_decides_on_its_own_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = saved(stage(spark, docs, FOLDER), name)
        assert after.columns == columns and ids(after) <= ids(docs)
        seen[name] = (docs, after)
        docs = after
    before, after = seen["quality_rules"]
    kept = {r.doc_id for r in QUERIES["op2_quality_rules"](spark, FOLDER).collect() if r.kept}
    assert len(ids(after) ^ (kept & ids(before))) <= 0.01 * len(kept)
    before, after = seen["near_dedup"]
    assert ids(after) == set(brute({r.doc_id: r.text for r in before.collect()}).values())
    before, after = seen["decontamination"]
    leaked = ids(QUERIES["op10_benchmark_leaks"](spark, FOLDER))
    assert ids(after) == ids(before) - leaked
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert ids(packed) == ids(docs)


def test_run_has_the_rows_of_its_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and max(r.offset + r.length for r in rows) <= 4096


def test_stages_take_odd_and_empty_tables(spark):
    for df in (odd(spark), odd(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, df, FOLDER)
            assert got.count() >= 0
            if name != "packing":
                assert got.columns == df.columns
