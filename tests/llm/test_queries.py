"""Registered queries and the pipeline on the smallest tables, some against DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

COLUMNS = {
    "op1": ["doc_id", "held_out", "lang_pred", "score"], "op2": ["query_id", "rank", "vec_id", "score"], "op3": ["vec_id", "n_links", "component_id", "kept"],
    "op4": ["doc_id", "n_shingles", "component_id", "kept"], "op5": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], "op7": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op8": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied"], "op9": ["doc_id", "held_out", "score", "predicted"],
    "op10": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def test_all_ten_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "pii", "packing"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF)
    assert found.columns == COLUMNS[name.split("_")[0]]
    rows = sorted(map(str, map(tuple, found.collect())))
    if name in ORACLE_SQL:
        expected = duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in found.columns)} from ({ORACLE_SQL[name]})").fetchall()
        assert rows == sorted(map(str, expected))
    elif name not in ("op10_packing",):
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == corpus_pipeline.COLUMNS
            docs = corpus_pipeline.staged(out, "test-stage")
            sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert docs.where("text rlike '@mail[0-9]'").count() == 0


def test_predictions_on_held_out_rows(spark):
    """Languages and quality of the given documents that training never saw."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    found = QUERIES["op1_language"](spark, folder).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    told = [r.lang == r.lang_pred for r in found.where("lang is not null and lang_pred <> 'und'").collect()]
    assert len(told) > 100 and sum(told) >= 0.98 * len(told)
    found = QUERIES["op9_quality"](spark, folder).where("held_out").join(labels, "doc_id")
    told = [r.quality == r.predicted for r in found.where("quality is not null").collect()]
    assert len(told) > 50 and sum(told) >= 0.9 * len(told)
