from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from docsync.functions import types as ct
from docsync.operators import mapping as m
from docsync.operators.project import project
from docsync.plans import inputs
from docsync.plans.registry import QUERIES
from docsync.sources import documents
from tests.helpers import COMPANY, EMPLOYEE, docs_frame

PEOPLE = [{"_id": str(i), "firstName": "a", "lastName": "b", "hair": "c"} for i in range(5)]


def votes(df):
    return {(r["field"], r["type"]): r["n"] for r in df.collect()}


def columns(df):
    return [tuple(c) for c in df.first()["types"]]


def test_histogram_of_employees(spark):
    got = votes(m.type_histogram(docs_frame(spark, PEOPLE)))
    assert got == {(f, "text"): 5 for f in ("_id", "firstName", "lastName", "hair")}


def test_majority_ties_and_nulls(spark):
    docs = [
        {"_id": "a", "x": 1, "tie": "old", "n": None, "y": True},
        {"_id": "b", "x": 2, "tie": 5, "n": None},
        {"_id": "c", "x": "s", "z": {"k": 1}},
    ]
    df = m.infer_map({"Things": docs_frame(spark, docs)})
    row = df.first()
    assert (row["collection_name"], row["relation_name"]) == ("Things", "things")
    # newest document first: c, b, a
    assert columns(df) == [
        ("id", "_id", "TEXT"), ("x", "x", "DOUBLE PRECISION"), ("z", "z", "JSONB"),
        ("tie", "tie", "DOUBLE PRECISION"), ("n", "n", "TEXT"), ("y", "y", "BOOLEAN"),
    ]
    with_nulls = m.infer_map({"Things": docs_frame(spark, docs)}, null_votes_as_jsonb=True)
    assert ("n", "n", "JSONB") in columns(with_nulls)


def test_equal_column_names(spark):
    docs = [{"_id": "a", "firstName": "x", "first_name": 1}, {"_id": "b", "first_name": 2}]
    df = docs_frame(spark, docs)
    got = votes(m.type_histogram(df))
    assert got == {("_id", "text"): 2, ("firstName", "text"): 1, ("first_name", "double precision"): 1}
    assert [c[1] for c in columns(m.infer_map({"T": df}))] == ["_id", "first_name"]


def test_sample_is_the_newest(spark):
    docs = [{"_id": str(i), "v": "old"} for i in range(5)] + [{"_id": "x", "v": 1}, {"_id": "y", "v": 2}]
    df = docs_frame(spark, docs)
    assert columns(m.infer_map({"T": df}, sample=2))[1] == ("v", "v", "DOUBLE PRECISION")
    assert columns(m.infer_map({"T": df}))[1] == ("v", "v", "TEXT")  # by default all vote
    assert documents.DEFAULT_SAMPLE == 100 and documents.newest(df, 3).count() == 3


def test_newest_by_cutoff(spark, folder):
    spark.range(1000).selectExpr("id AS seq", "to_json(named_struct('_id', id)) AS body").repartition(4).write.parquet(f"{folder}/t")
    df = documents.from_json(spark.read.parquet(f"{folder}/t"), "body", "seq")
    for n in (1, 7, 1000, 5000):
        got = [r["_seq"] for r in documents.newest_by_cutoff(df, n).collect()]
        assert got == list(range(999, max(-1, 999 - n), -1))
    plan = documents.newest_by_cutoff(df, 7)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(seq,993)" in plan
    ties = spark.sql("SELECT explode(array(1, 2, 2, 2, null)) AS seq")
    assert documents.newest_by_cutoff(ties, 2, "seq").count() == 2 and documents.newest_by_cutoff(ties, 5, "seq").count() == 5


def test_typed_collection_gives_the_same_map(spark):
    df = spark.createDataFrame([(1, "a", None, [1]), (2, None, None, [2])], "k long, someText string, gone double, list array<int>")
    typed = m.infer_map({"T": df}, sample=None, seqs={"T": "k"})
    general = m.infer_map({"T": documents.from_table(df, "k")}, sample=None)
    assert columns(typed)[:2] == [("k", "k", "DOUBLE PRECISION"), ("some_text", "someText", "TEXT")]
    # The schema has a type even for a column that is always null; among documents that is text.
    assert columns(typed)[2:] == [("gone", "gone", "DOUBLE PRECISION"), ("list", "list", "JSONB")]
    assert columns(general)[:2] == columns(typed)[:2] and columns(general)[2] == ("gone", "gone", "TEXT")


def test_several_collections_sorted(spark):
    df = docs_frame(spark, PEOPLE)
    rows = m.infer_map({"Zebra": df, "Apple": df}).orderBy("id").collect()
    assert [(r["id"], r["collection_name"]) for r in rows] == [(0, "Apple"), (1, "Zebra")]


def test_map_round_trip(spark, folder):
    frame = m.map_frame(spark, [COMPANY, EMPLOYEE])
    for fmt in ("json", "parquet"):
        m.write_map(frame, f"{folder}/{fmt}", fmt)
        back = m.read_map(spark, f"{folder}/{fmt}", fmt)
        assert m.load_maps(back) == {"Company": COMPANY, "Employee": EMPLOYEE}
        assert [r[0] for r in m.collection_names(back).collect()] == ["Company", "Employee"]
    one = m.column_rows(frame, "Company").collect()
    assert [(r["column"], r["source"]) for r in one] == [(c.column, c.source) for c in COMPANY.columns]
    assert m.column_rows(frame, "Nobody").isEmpty()
    assert m.map_json(frame).first()["types_json"].startswith('[{"column":"id"')


def test_details_with_extra_props():
    assert [c.column for c in COMPANY.with_extra_props().details()][-1] == "_extra_props"
    assert COMPANY.with_extra_props().schema().fieldNames()[-1] == "_extra_props"
    assert COMPANY.details() == list(COMPANY.columns)
    assert COMPANY.key.column == "id" and ct.spark_type("JSONB").simpleString() == "variant"


def test_a_map_of_typed_collections_reads_no_documents(spark):
    df = spark.createDataFrame([(1, "a")], "k long, text string").where("raise_error('read') IS NULL")
    assert columns(m.infer_map({"T": df}, seqs={"T": "k"})) == [("k", "k", "DOUBLE PRECISION"), ("text", "text", "TEXT")]


def test_a_field_on_the_oldest_document_only_has_a_column(spark):
    df = documents.from_json(spark.range(300).selectExpr("if(id = 0, '{\"_id\":0,\"rare\":1}', concat('{\"_id\":', id, '}')) AS body", "id AS seq"), "body", "seq")
    assert ("rare", "rare", "DOUBLE PRECISION") in columns(m.infer_map({"T": df}))
    assert ("rare", "rare", "DOUBLE PRECISION") not in columns(m.infer_map({"T": df}, sample=100))


def test_a_typed_collection_that_is_read_gives_the_map_of_its_documents(spark):
    df = spark.createDataFrame([(1, "a", None, [1]), (2, None, None, [2])], "k long, someText string, gone double, list array<int>")
    for jsonb in (False, True):
        typed = m.infer_map({"T": df}, null_votes_as_jsonb=jsonb, seqs={"T": "k"}, read_typed=True)
        assert columns(typed) == columns(m.infer_map({"T": documents.from_table(df, "k")}, null_votes_as_jsonb=jsonb))
    assert columns(m.infer_map({"T": df}, seqs={"T": "k"}, read_typed=True))[2] == ("gone", "gone", "TEXT")
    # A sample is not passed over: the newest document alone has no text.
    newest = spark.createDataFrame([(1, 5.0), (2, None)], "k long, n double")
    assert columns(m.infer_map({"T": newest}, sample=1, seqs={"T": "k"}))[1] == ("n", "n", "TEXT")
    assert m.infer_map({"T": df.limit(0)}, seqs={"T": "k"}, read_typed=True).isEmpty()


def test_the_maps_of_given_tables_read_every_column(spark, folder):
    for name in inputs.TABLES:
        spark.sql("SELECT 1L AS k, CAST(NULL AS DOUBLE) AS gone, 2 AS kept").write.parquet(f"{folder}/{name}.parquet")
    for name in ("inferred_map", "stored_map"):
        rows = QUERIES[name](spark, folder).collect()
        assert len({r["collection_name"] for r in rows}) == len(inputs.TABLES)
        assert {(r["column"], r["type"]) for r in rows} == {("k", "DOUBLE PRECISION"), ("gone", "TEXT"), ("kept", "DOUBLE PRECISION")}


def test_ids_as_field_names_are_no_columns(spark):
    docs = [{"_id": str(i), "name": f"n{i}", f"user{i}": {"x": i}} | ({"often": i} if i % 4 == 0 else {}) for i in range(400)]
    frame = docs_frame(spark, docs)
    assert m.frequent_fields(frame, 0.2, 200) == ["_id", "name", "often"]
    users = m.load_maps(m.infer_map({"Users": frame}, min_share=0.2, max_names=200), extra_props=True)["Users"]
    assert [(c.column, c.type) for c in users.columns] == [("id", "TEXT"), ("name", "TEXT"), ("often", "DOUBLE PRECISION")]
    row = project(frame, users).where("id = '7'").withColumn("e", F.to_json("_extra_props")).first()
    assert row["e"] == '{"user7":{"x":7}}'
    assert m.frequent_fields(frame, 0.25, 200) == ["_id", "name", "often"] and m.frequent_fields(frame, 0.26, 200) == ["_id", "name"]
    assert m.frequent_fields(docs_frame(spark, [{}]), 0.1, 100) == []


def test_a_sketch_too_coarse_says_so(spark):
    docs = [{"_id": str(i), f"user{i}": 1} for i in range(300)]
    with pytest.raises(ValueError, match="max_names must be 1400"):
        m.frequent_fields(docs_frame(spark, docs), 0.01, 100)
    assert m.frequent_fields(docs_frame(spark, docs), 0.01, 1400) == ["_id"]


def test_no_task_holds_more_names_than_said(spark):
    """Only the names that the sketch lets through are grouped and counted."""
    docs = docs_frame(spark, [{"_id": str(i), f"user{i}": 1} for i in range(500)])
    votes = m.field_votes(docs, m.frequent_fields(docs, 0.5, 64))
    assert votes.select("field").distinct().count() == 1


def test_dates_vote_timestamp(spark):
    df = spark.sql("SELECT 1 AS k, DATE'2024-02-03' AS day")
    for how in ({}, {"read_typed": True}):
        assert columns(m.infer_map({"T": df}, seqs={"T": "k"}, **how))[1] == ("day", "day", "TIMESTAMP")
    docs = documents.from_table(df, "k", {"day": F.col("day").cast("variant")})
    assert columns(m.infer_map({"T": docs})) == [("day", "day", "TIMESTAMP")]
    assert str(project(df, m.make_map("T", "t", [("day", "day", "TIMESTAMP")])).first()[0]) == "2024-02-03 00:00:00"
