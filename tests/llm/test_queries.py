"""Every registered query: against SQL where there is any, over whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from docsync.llm.common import table
from docsync.llm.queries import ORACLES, QUERIES
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash import slow
from tests.oracle_check import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    columns, got, names, want = compare(spark, connect(SF_DIR), QUERIES[name], ORACLES[name], SF_DIR)
    assert columns == names
    assert got == want


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["op1_sharding", "op5_chat_formatting", "op9_mixing", "op10_secret_scan"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    whole = {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_copies", "decontamination", "mixing", "sharding"]

    told = stages["language"](spark, docs, SF_DIR)
    assert told.columns == columns
    kept = {r.doc_id for r in told.collect()}
    assert all(any(c.isalpha() for c in whole[i].text) for i in kept)
    assert len(kept) >= 0.98 * len(whole)

    single = stages["near_copies"](spark, told, SF_DIR)
    assert single.columns == columns
    ids = [r.doc_id for r in single.collect()]
    marks = [slow(whole[i].text) for i in ids]
    assert len(ids) == len(set(ids)) and all((a ^ b).bit_count() > 2 for i, a in enumerate(marks) for b in marks[i + 1 :])
    assert all(any((slow(whole[i].text) ^ m).bit_count() <= 2 for m in marks) for i in kept)

    clean = stages["decontamination"](spark, single, SF_DIR)
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {i for i in ids if not brute(whole[i].text, items)[-1]}

    mixed = stages["mixing"](spark, clean, SF_DIR)
    assert mixed.columns == columns
    assert stages["sharding"](spark, mixed, SF_DIR).count() == mixed.count()


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
