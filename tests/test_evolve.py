from __future__ import annotations

from pyspark.sql import functions as F

from docsync.functions import types as ct
from docsync.operators import evolve as e, mapping as m
from tests.helpers import COMPANY, EMPLOYEE, docs_frame

WITH_TEXT_DOMAINS = m.make_map("Company", "company", [("id", "_id", "TEXT"), ("active", "active", "BOOLEAN"), ("domains", "domains", "TEXT"), ("signup_code", "signupCode", "TEXT")])
WITH_UPDATED = m.make_map("Company", "company", [tuple((c.column, c.source, c.type)) for c in COMPANY.columns] + [("updated_at", "updatedAt", "TIMESTAMP")])
WITHOUT_CODE = m.make_map("Company", "company", [(c.column, c.source, c.type) for c in COMPANY.columns[:-1]])


def diff(spark, old, new):
    rows = e.map_diff(m.map_frame(spark, old), m.map_frame(spark, new)).where("change <> 'same'").collect()
    return {(r["source"], r["change"]) for r in rows}


def test_map_versions(spark):
    assert diff(spark, [COMPANY], [COMPANY]) == set()
    assert diff(spark, [COMPANY], [WITH_TEXT_DOMAINS]) == {("domains", "retyped")}
    assert diff(spark, [COMPANY], [WITH_UPDATED]) == {("updatedAt", "added")}
    assert diff(spark, [COMPANY], [WITHOUT_CODE]) == {("signupCode", "removed")}
    renamed = m.make_map("Company", "company", [("id", "_id", "TEXT"), ("is_active", "active", "bool"), ("domains", "domains", "JSONB"), ("signup_code", "signupCode", "text")])
    assert diff(spark, [COMPANY], [renamed]) == {("active", "renamed")}


def test_tracking(spark):
    one, both = m.map_frame(spark, [COMPANY]), m.map_frame(spark, [COMPANY, EMPLOYEE])
    assert [r[0] for r in e.to_track(one, both).collect()] == ["Employee"]
    assert [r[0] for r in e.to_untrack(both, one).collect()] == ["Employee"]
    swapped = m.map_frame(spark, [EMPLOYEE])
    assert {(r["collection_name"], r["change"]) for r in e.map_changes(one, swapped).collect()} == {("Employee", "track"), ("Company", "untrack")}
    assert e.map_changes(both, both).isEmpty()


def test_schema_changed():
    assert not e.schema_changed(COMPANY.schema(), COMPANY)
    for other in (WITH_TEXT_DOMAINS, WITH_UPDATED, WITHOUT_CODE):
        assert e.schema_changed(COMPANY.schema(), other) and e.schema_changed(other.schema(), COMPANY)
    swapped = m.make_map("Company", "company", [("id", "_id", "TEXT"), ("active", "active", "JSONB"), ("domains", "domains", "BOOLEAN"), ("signup_code", "signupCode", "TEXT")])
    assert e.schema_changed(COMPANY.schema(), swapped)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_retype_all_or_nothing(spark):
    df = spark.createDataFrame([("1", 1.0, True, "x"), ("2.5", 0.0, None, "3"), (None, None, False, None)], "t string, d double, b boolean, mixed string")
    out, r = e.retype(df, "t", ct.TEXT, ct.DOUBLE)
    assert values(out, "t") == [1.0, 2.5, None] and r.change == "retyped"
    out, r = e.retype(df, "mixed", ct.TEXT, ct.DOUBLE)
    assert values(out, "mixed") == ["x", "3", None] and (r.change, r.failures) == ("refused", 1)
    assert e.retype(df, "d", ct.DOUBLE, ct.JSONB)[1].change == "refused"
    assert values(e.retype(df, "d", ct.DOUBLE, ct.BOOLEAN)[0], "d") == [True, False, None]
    assert values(e.retype(df, "b", ct.BOOLEAN, ct.DOUBLE)[0], "b") == [1.0, None, 0.0]
    assert values(e.retype(df, "b", ct.BOOLEAN, ct.TEXT)[0], "b") == ["true", None, "false"]
    j = e.retype(df, "b", ct.BOOLEAN, ct.JSONB)[0]
    assert values(j, F.to_json("b")) == ["true", None, "false"]
    assert values(e.retype(j, "b", ct.JSONB, ct.TEXT)[0], "b") == ["true", None, "false"]
    assert e.retype(j, "b", ct.JSONB, ct.DOUBLE)[1].failures == 2
    assert e.retype(j, "b", ct.JSONB, ct.BOOLEAN)[1].change == "refused"
    # Spellings of one type are no change.
    assert e.retype_all(df, {"t": (ct.TEXT, "character varying"), "d": ("double", "float")})[1] == []


def test_evolve_in_one_pass(spark):
    table = spark.sql("SELECT '1' AS id, true AS active, parse_json('[1]') AS domains, 'x' AS signup_code")
    target = m.make_map("Company", "company", [
        ("id", "_id", "TEXT"), ("updated_at", "updatedAt", "TIMESTAMP"), ("signup_code", "signupCode", "DOUBLE PRECISION"), ("domains", "domains", "TEXT")])
    out, report = e.evolve(table, target)
    assert out.columns == ["id", "updated_at", "signup_code", "domains"]
    assert tuple(out.first()) == ("1", None, "x", "[1]")
    assert {(r.column, r.change) for r in report} == {("active", "removed"), ("updated_at", "added"), ("signup_code", "refused"), ("domains", "retyped")}
    used = e.effective_map(target, report)
    assert {c.column: c.type for c in used.columns}["signup_code"] == ct.TEXT
    assert e.report_frame(table, "company", report).count() == 4
    same, nothing = e.evolve(out, used)
    assert nothing == [] and same.columns == out.columns


def test_backfill_only_the_new_column(spark):
    table = spark.sql("SELECT '1' AS id, true AS active, cast(null AS string) AS signup_code UNION ALL SELECT '9', false, null")
    docs = docs_frame(spark, [{"_id": "1", "active": False, "signupCode": "new"}, {"_id": "2", "signupCode": "z"}])
    m2 = m.make_map("Company", "company", [("id", "_id", "TEXT"), ("active", "active", "BOOLEAN"), ("signup_code", "signupCode", "TEXT")])
    got = {tuple(r) for r in e.backfill(table, docs, m2, ["signup_code"]).collect()}
    assert got == {("1", True, "new"), ("9", False, None)}


def test_column_steps(spark):
    df = spark.range(1).withColumn("a", F.lit(1))
    assert e.remove_columns(df, ["a"]).columns == ["id"]
    assert e.rename_columns(df, {"a": "b"}).columns == ["id", "b"]
    assert e.add_columns(df, [m.MappedColumn("c", "c", "JSONB")]).schema["c"].dataType.simpleString() == "variant"
