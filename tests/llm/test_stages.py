"""Every stage of the pipeline on odd rows, clashing columns and no rows."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from tests.llm.helpers import ODD, docs

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")

KEPT = {
    # Repeated rows stay; what has no letter goes.
    "language": [(i, t) for i, t, *_ in ODD if t and any(c.isalpha() for c in t)],
    # One of all without words, the least id that is not null; one of those that say x.
    "near_copies": [(i, t) for i, t, *_ in ODD if (i, t) in [(None, "a b c d e"), (1, None), (4, "x")] or (i or 0) > 5],
    "decontamination": [(i, t) for i, t, *_ in ODD],
}


def _sorted(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows_and_clashing_columns(spark, name, stage):
    data = docs(spark, ODD, extra=True)
    out = stage(spark, data, SF_DIR)
    if name != "sharding":
        assert out.columns == data.columns
    rows = out.collect()
    if name in KEPT:
        assert _sorted((r.doc_id, r.text) for r in rows) == _sorted(KEPT[name])
    elif name == "mixing":
        # Copies of given rows, whole.
        assert set(rows) <= set(data.collect())
    else:
        assert len(rows) == len(ODD)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_no_rows(spark, name, stage):
    data = docs(spark, ODD).where("false")
    out = stage(spark, data, SF_DIR)
    assert out.count() == 0 and (name == "sharding" or out.columns == data.columns)
