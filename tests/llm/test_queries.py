import os

import corpus_pipeline
import pytest
from harness.check import compare, database
from pyspark.errors import AnalysisException
from vigiltx.llm import mixing
from vigiltx.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, database(SF), SF, QUERIES[name], ORACLES[name]) == ""


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) and len(ids) > 0.8 * docs.count()
    assert all(len(r.pieces) == r.n_pieces for r in out)


def test_mixing_reaches_the_result(spark, monkeypatch):
    seen = {}

    def noted(name, stage):
        def run(spark, docs, sf_dir):
            seen[name] = docs
            return stage(spark, docs, sf_dir)

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [noted(*s) for s in corpus_pipeline.STAGES])
    out = [(r.slot, r.block_start, r.doc_id) for r in corpus_pipeline.run(spark, SF).collect()]
    want = mixing.mix(seen["mixing"]).select("slot", "block_start", "doc_id").collect()
    assert out == sorted(tuple(r) for r in want) and len({r[0] for r in out}) > 1
    monkeypatch.setattr(corpus_pipeline, "STAGES", [s for s in corpus_pipeline.STAGES if s[0] != "mixing"])
    with pytest.raises(AnalysisException, match="slot"):
        corpus_pipeline.run(spark, SF)


def test_native_queries_run_no_python(spark):
    for name in ("op2_secret_scans", "op6_mixing"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
