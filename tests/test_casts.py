from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from docsync.functions import types as ct
from docsync.functions.cast import cast_typed, variant_failed_sql
from docsync.functions.naming import namespace_collection, namespace_database, snake_case, start_epoch
from docsync.operators.mapping import MappedColumn
from docsync.operators.project import cast_fields
from docsync.sources.documents import nan_to_null, parse_document

NOON = dt.datetime(2024, 1, 2, 12)

CASES = [
    # JSON value, column type, result, failed
    ('"2"', ct.DOUBLE, 2.0, False),
    ('" -1.5e3 "', ct.DOUBLE, -1500.0, False),
    ('"xyz"', ct.DOUBLE, None, True),
    ('"1.0d"', ct.DOUBLE, None, True),
    ('"1_000"', ct.DOUBLE, None, True),
    ('"0x1p3"', ct.DOUBLE, None, True),
    ('"inf"', ct.DOUBLE, float("inf"), False),
    ('{"xyz": "oh no"}', ct.DOUBLE, None, True),
    ("true", ct.DOUBLE, None, True),
    ("null", ct.DOUBLE, None, False),
    ("12345678901", ct.DOUBLE, 12345678901.0, False),
    ("{}", ct.BOOLEAN, False, False),
    ("[]", ct.BOOLEAN, False, False),
    ("[null]", ct.BOOLEAN, True, False),
    ('"false"', ct.BOOLEAN, True, False),
    ('""', ct.BOOLEAN, False, False),
    ("0", ct.BOOLEAN, False, False),
    ("0.5", ct.BOOLEAN, True, False),
    ("null", ct.BOOLEAN, None, False),
    ("{}", ct.TIMESTAMP, None, True),
    ('"2024-01-02 12:00:00"', ct.TIMESTAMP, NOON, False),
    ('"soon"', ct.TIMESTAMP, None, True),
    ("5", ct.TIMESTAMP, None, True),
    ("true", ct.TEXT, "True", False),
    ("1.5", ct.TEXT, "1.5", False),
    ("7", ct.TEXT, "7", False),
    ('{"a":[1]}', ct.TEXT, '{"a":[1]}', False),
    ("null", ct.TEXT, None, False),
    ('"x"', "money", None, True),
]


@pytest.mark.parametrize("kind", sorted({c[1] for c in CASES}))
def test_variant_casts(spark, kind):
    cases = [(i, v, r, f) for i, (v, k, r, f) in enumerate(CASES) if k == kind]
    df = spark.createDataFrame([(i, v) for i, v, _, _ in cases], "i int, v string").select(
        "i", F.to_variant_object(F.struct(F.parse_json("v").alias("x"))).alias("doc")
    )
    ready = cast_fields(df, [MappedColumn("x", "x", kind)])
    got = {r["i"]: (r["_x0"], r["f"]) for r in ready.selectExpr("i", "_x0", f"{variant_failed_sql('_x0', '_t0', kind)} AS f").collect()}
    for i, value, result, failed in cases:
        assert got[i] == (result, failed), (value, kind, got[i])


def test_jsonb_cast_nulls_nan_by_value(spark):
    texts = ['{"a": NaN, "b": "NaN, NaN", "c": [1, NaN], "d": "say \\"NaN\\""}', '{"a": 1}', "{bad NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.to_json(parse_document(F.col("t")))).collect()]
    assert got == ['{"a":null,"b":"NaN, NaN","c":[1,null],"d":"say \\"NaN\\""}', '{"a":1}', None]
    assert df.select(nan_to_null(F.col("t"))).first()[0].count("NaN") == 3


def test_duplicate_keys_last_wins(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',)], "t string")
    assert df.select(F.to_json(parse_document(F.col("t")))).first()[0] == '{"a":2}'


def test_typed_casts_follow_the_same_rules(spark):
    df = spark.createDataFrame(
        [(True, 0, "2", [1], NOON, {"a": 1}), (False, 7, "xyz", [], None, None)],
        "b boolean, n int, s string, l array<int>, t timestamp_ntz, m map<string,int>",
    )
    f = {x.name: x.dataType for x in df.schema.fields}

    def run(column, kind):
        k = cast_typed(F.col(column), f[column], kind)
        return [tuple(r) for r in df.select(k.value, k.failed).collect()]

    assert run("b", ct.TEXT) == [("True", False), ("False", False)]
    assert run("b", ct.DOUBLE) == [(None, True), (None, True)]
    assert run("n", ct.BOOLEAN) == [(False, False), (True, False)]
    assert run("s", ct.DOUBLE) == [(2.0, False), (None, True)]
    assert run("s", ct.BOOLEAN) == [(True, False), (True, False)]
    assert run("l", ct.BOOLEAN) == [(True, False), (False, False)]
    assert run("l", ct.TEXT) == [("[1]", False), ("[]", False)]
    assert run("t", ct.TIMESTAMP) == [(NOON, False), (None, False)]
    assert run("n", ct.TIMESTAMP) == [(None, True), (None, True)]
    assert run("m", ct.BOOLEAN) == [(True, False), (None, False)]


def test_value_types(spark):
    values = ["true", "1", "1.5", '"x"', "{}", "[1]", "null", "1e400"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(ct.type_of_value(F.parse_json("v"))).collect()]
    assert got == [ct.BOOLEAN, ct.DOUBLE, ct.DOUBLE, ct.TEXT, ct.JSONB, ct.JSONB, None, ct.DOUBLE]
    ts = spark.range(1).select(ct.type_of_value(F.lit(NOON).cast("timestamp_ntz").cast("variant")))
    assert ts.first()[0] == ct.TIMESTAMP
    assert ct.column_type_of(T.IntegerType()) == ct.DOUBLE and ct.column_type_of(T.BinaryType()) == ct.JSONB


def test_conversion_matrix(spark):
    yes = {(a, b) for a in ct.COLUMN_TYPES for b in ct.COLUMN_TYPES if ct.convertible(a, b)}
    assert len(yes) == 18
    assert (ct.DOUBLE, ct.JSONB) not in yes and (ct.JSONB, ct.BOOLEAN) not in yes and (ct.TEXT, ct.JSONB) in yes
    assert ct.same_type("character varying", "CHARACTER") and ct.same_type("timestamp without time zone", "TIMESTAMP")
    df = spark.createDataFrame([(a, b.upper()) for a in ct.COLUMN_TYPES for b in ct.COLUMN_TYPES], "a string, b string")
    got = {(r.a, r.b.lower()) for r in df.where(ct.convertible_column(F.col("a"), F.col("b"))).collect()}
    assert got == yes


def test_names(spark):
    names = {"_id": "id", "firstName": "first_name", "HTMLPage": "htmlpage", "My_Field": "my__field", "signupCode": "signup_code"}
    df = spark.createDataFrame([(k,) for k in names], "n string")
    assert [r[0] for r in df.select(snake_case(F.col("n"))).collect()] == list(names.values())
    row = spark.range(1).select(
        namespace_database(F.lit("db.a.b")), namespace_collection(F.lit("db.a.b")), start_epoch(F.lit("31-12-24T08:30:00"))
    ).first()
    assert tuple(row) == ("db", "a.b", int(dt.datetime(2024, 12, 31, 8, 30, tzinfo=dt.timezone.utc).timestamp()))


def test_nan_is_null_however_deep_in_typed_values(spark):
    df = spark.sql(
        "SELECT array(struct(double('NaN') AS x, map('k', array(float('NaN'), 1.5F)) AS m, 'NaN' AS t), null) AS a, "
        "map('d', double('NaN')) AS m, named_struct('i', 1, 's', named_struct('f', double('nan'))) AS s, CAST(NULL AS STRUCT<x: DOUBLE>) AS n"
    )
    got = df.select(*[F.to_json(cast_typed(F.col(f.name), f.dataType, ct.JSONB).value).alias(f.name) for f in df.schema.fields]).first()
    assert got["a"] == '[{"m":{"k":[null,1.5]},"t":"NaN","x":null},null]'
    assert got["m"] == '{"d":null}' and got["s"] == '{"i":1,"s":{"f":null}}' and got["n"] is None
