from __future__ import annotations

from pyspark.sql import functions as F

from docsync.operators import project as p
from docsync.operators.mapping import make_map
from docsync.sources import collections, documents
from tests.helpers import COMPANY, docs_frame

DOCS = [
    {"_id": "1", "active": True, "domains": ["a.org"], "signupCode": "x"},
    {"_id": "2", "active": False, "domains": [], "more": {"k": None}, "signupCode": None},
    {"_id": "3", "more": 1},
]


def test_rows_in_map_order(spark):
    rows = p.project(docs_frame(spark, DOCS), COMPANY).withColumn("domains", F.to_json("domains")).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", True, '["a.org"]', "x"), ("2", False, "[]", None), ("3", None, None, None)]


def test_leftovers_keep_nulls_nested_and_unfit(spark):
    m = make_map("C", "c", [("id", "_id", "TEXT"), ("code", "signupCode", "DOUBLE PRECISION")], extra_props=True)
    df = p.project(docs_frame(spark, DOCS + [{"_id": "4", "x": None}]), m, with_failures=True)
    got = {r["id"]: (r["code"], r["e"], r["_failed"]) for r in df.withColumn("e", F.to_json("_extra_props")).collect()}
    assert got["1"] == (None, '{"active":true,"domains":["a.org"],"signupCode":"x"}', ["signupCode"])
    assert got["2"] == (None, '{"active":false,"domains":[],"more":{"k":null}}', [])
    assert got["4"] == (None, '{"x":null}', [])
    errors = p.cast_errors(docs_frame(spark, DOCS), m).collect()
    assert [(e["location"], e["message"]) for e in errors] == [("c", "value does not fit: signupCode: 1")]


def test_typed_leftovers(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "5", 2)], "_id int, code string, other int")
    m = make_map("C", "c", [("id", "_id", "TEXT"), ("code", "code", "DOUBLE PRECISION")], extra_props=True)
    out = p.project(df, m).select("id", "code", F.to_json("_extra_props").alias("e")).orderBy("id").collect()
    assert [tuple(r) for r in out] == [("1", None, '{"code":"x","other":null}'), ("2", 5.0, '{"other":2}')]


def test_odd_field_names(spark):
    names = ["a.b", "c d", 'q"x', "it's", "back`tick"]
    m = make_map("C", "c", [("id", "_id", "TEXT")] + [(n, n, "DOUBLE PRECISION") for n in names], extra_props=True)
    df = p.project(docs_frame(spark, [{"_id": "1", **{n: i for i, n in enumerate(names)}}]), m)
    row = df.first()
    assert [row[n] for n in names] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert df.select(F.to_json("_extra_props")).first()[0] == "{}"


def test_typed_scan_reads_only_mapped_columns(spark, folder):
    spark.range(10).selectExpr("id AS _id", "id AS a", "id AS b").write.parquet(f"{folder}/t")
    m = make_map("C", "c", [("id", "_id", "TEXT"), ("a", "a", "DOUBLE PRECISION")])
    plan = p.project(spark.read.parquet(f"{folder}/t"), m)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_id:bigint,a:bigint>" in plan


def test_align(spark):
    df = spark.createDataFrame([("x", 1)], "signup_code string, other int")
    out = p.align(df, COMPANY)
    assert out.columns == [c.column for c in COMPANY.columns] and out.first()["signup_code"] == "x"


def test_unparsable_documents(spark):
    df = spark.createDataFrame([("{bad", 1), ('{"_id":"a"}', 2)], "body string, seq long")
    assert [tuple(r) for r in documents.unparsable(df, "body", "seq").collect()] == [(1, "{bad")]


def test_reading_documents(spark, folder):
    with open(f"{folder}/docs.json", "w") as f:
        f.write('{"_id":"a","n":1}\n{"_id":"b","n":2}\n')
    df = documents.read_json_documents(spark, f"{folder}/docs.json", "n")
    assert [r["_seq"] for r in df.orderBy("_seq").collect()] == [1, 2]
    found = documents.lookup(df, "b")
    assert found.select(F.to_json("doc")).first()[0] == '{"_id":"b","n":2}'
    typed = spark.range(5).withColumnRenamed("id", "_id")
    assert documents.lookup(typed, "3").collect()[0]["_id"] == 3
    assert documents.projected(typed.withColumn("x", F.lit(1)), ["x"], newest_first_by="_id").count() == 5


def test_collections(spark, folder):
    for n in ("Company", "Employee"):
        spark.range(2).write.parquet(f"{folder}/{n}.parquet")
    existing = collections.list_folder(spark, folder, ".parquet")
    assert [r[0] for r in existing.collect()] == ["Company", "Employee"]
    wanted = collections.requested(spark, ["Employee", "Ghost", "Company"])
    assert [r[0] for r in collections.present(wanted, existing).collect()] == ["Employee", "Company"]
    assert [r[0] for r in collections.missing(wanted, existing).collect()] == ["Ghost"]
    spark.range(1).createOrReplaceTempView("some_view")
    assert "some_view" in [r[0] for r in collections.list_catalog(spark).collect()]
