"""The registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from gridloom.llm import queries as llm
from gridloom.session import materialized
from tests.check_oracles import rows_of
from tests.conftest import SF


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = llm.queries()[name](spark, SF)
    found = con.execute(llm.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, found.fetchall())


def test_stages_keep_the_columns_and_lose_only_what_they_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialized(stage(spark, docs, SF))
        if name != "packing":
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    assert counts[-1] > 0.6 * counts[0] and counts[3] == counts[4]
    packed = docs.selectExpr("count(distinct doc_id)").first()[0]
    assert packed == counts[-1]


@pytest.mark.parametrize("operator", ["toxicity.without_toxic", "packing.pack_documents"])
def test_stages_send_texts_in_small_batches(spark, monkeypatch, operator):
    # 6000 rows of 4000 bytes: one Arrow batch of 24 MB by Spark's bounds
    docs = spark.range(0, 6000, 1, 1).selectExpr("id as doc_id", "repeat('word', 1000) as text")

    def sizes(docs, *_):
        def size(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

        return docs.mapInArrow(size, "bytes long")

    module, name = operator.split(".")
    monkeypatch.setattr(getattr(corpus_pipeline, module), name, sizes)
    stage = {"toxicity": corpus_pipeline.toxicity_stage, "packing": corpus_pipeline.packing_stage}[module]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    found = [r["bytes"] for r in stage(spark, docs, SF).collect()]
    assert sum(found) > 24_000_000 and max(found) < 5_000_000
    assert spark.conf.get(key) == before
