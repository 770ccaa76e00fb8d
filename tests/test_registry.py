"""Every registered query against its SQL, and what their plans must not hold."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from docsync.plans import inputs
from docsync.plans.oracle import ORACLES
from docsync.plans.registry import QUERIES
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    columns, got, names, want = compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR)
    assert columns == names
    assert got == want


WRITES = {
    "stream_fold", "stream_fold_shuffled", "repeated_batch", "feed_errors", "resume_position", "stored_map", "evolve_renamed",
    "stream_fold_stateful", "fold_many_collections", "audit_rows", "load_without_ids", "snapshot_load", "second_load", "load_errors", "transfer_stats",
    "stored_lookup",
}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES])
def test_plan(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "PythonUDF"):
        assert bad not in plan


def test_pruning_and_pushdown(spark):
    def plan(name):
        return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()

    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan("projected_scan")
    assert "EqualTo(o_orderkey,42)" in plan("point_lookup")
    assert "GreaterThanOrEqual(ts," in plan("resume_from")
    assert "TakeOrderedAndProject" in plan("recent_sample")
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan("key_violations")


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names_of_whole_texts_keep_digits_and_other_scripts(spark, con, tmp_path):
    texts = ["_id", "Área 51: myHTMLPage", "ДОМ и Сад2", "__漢字 ABCd__", "\n_x_\n", "", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["snake_case_texts"](spark, str(tmp_path)).orderBy("doc_id").collect()
    want = con.sql(ORACLES["snake_case_texts"].replace("FROM documents", f"FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')") + " ORDER BY 1").fetchall()
    assert [tuple(r) for r in got] == want
    assert [r.column_name for r in got][1:3] == ["área 51: my_htmlpage", "дом и сад2"]


def test_feed_files_grow_in_number_and_not_in_size(spark, con, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "FEED_FILE_ROWS", 50)
    monkeypatch.setattr(inputs, "scratch", lambda spark: str(tmp_path))
    _, got, _, want = compare(spark, con, QUERIES["stream_fold_stateful"], ORACLES["stream_fold_stateful"], SF_DIR)
    assert got == want
    files = spark.read.parquet(f"{tmp_path}/feed").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) <= 100 and sum(r["count"] for r in files) == spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    assert len([n for n in os.listdir(f"{tmp_path}/checkpoint/commits") if n.isdigit()]) == 4
