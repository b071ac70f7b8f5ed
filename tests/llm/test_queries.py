"""The registered corpus queries beside their SQL, and the pipeline stage by stage."""

import pytest

from tests.compare import connect, differences

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from rowloom.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_beside_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        docs = out
    packed = corpus_pipeline.run(spark, FOLDER)
    fill = packed.groupBy("sequence_id").sum("length").collect()
    assert fill and all(r["sum(length)"] <= 4096 for r in fill)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
