import os

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.helpers import awkward_rows, empty, frame
from tidemark.llm import exact, mixing, pieces, simhash, toxicity
from tidemark.llm.common import staged

FOLDER = "/root/testdata/sf0.001"


def labels_only(spark, folder):
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return str(folder)


def test_stages_on_awkward_documents(spark, tmp_path):
    folder = labels_only(spark, tmp_path)
    docs = staged(frame(spark, awkward_rows()), "docs")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for (name, stage), plain in zip(corpus_pipeline.STAGES, (
        lambda d: toxicity.score(d, labels).filter("predicted = 0").count(),
        lambda d: exact.exact_groups(d).filter("kept").select("text_sha256").distinct().count(),
        lambda d: simhash.near_groups(d).select("component_id").distinct().count(),
        lambda d: sum(r.taken // r["size"] for r in mixing.mix(d).collect() if r["size"]),
        lambda d: pieces.encode(d).filter("round_trip").count(),
    )):
        out = staged(stage(spark, docs, folder), "out")
        assert out.count() == plain(docs), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        docs = out


def test_empty_documents(spark, tmp_path):
    folder = labels_only(spark, tmp_path)
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), "out")
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_run_and_registered_queries(spark):
    duckdb = pytest.importorskip("duckdb")
    found = contract.queries()
    assert {n.split("_")[0] for n in found if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
    assert found["pipeline"](spark, FOLDER).count() > 0
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    for name in ("op1_substring_dedup", "op5_source_mixing", "op10_exact_dedup"):
        got = found[name](spark, FOLDER)
        columns = sorted(got.columns)
        result = connection.execute(contract.oracle_sql()[name])
        places = [[d[0] for d in result.description].index(c) for c in columns]
        want = sorted(tuple(row[i] for i in places) for row in result.fetchall())
        assert sorted(map(tuple, got.select(*columns).collect())) == want
