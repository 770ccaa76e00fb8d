from __future__ import annotations

from docsync.operators import rows
from tests.helpers import rows_by_key

SCHEMA = "id string, first_name string, last_name string, hair string"
BASE = [
    ("12345", "Janos", "Snow", "black"), ("12346", "Arja", "Stark", "brown"), ("12347", "Sansa", "Stark", "red"),
    ("12348", "Tyrion", "L", "blonde"), ("12349", "No", None, "none"),
]
NEW = [
    ("12346", "Arja", "Stark", "brown"), ("12347", "Sansa", "Stark", "red"), ("12348", "Tyrion", "Lannister", "fair"),
    ("12349", "Nobody", None, "none"), ("12350", "Bran", "Stark", "dark"),
]
AFTER = {r[0]: r for r in BASE} | {r[0]: r for r in NEW}


def frames(spark):
    return spark.createDataFrame(BASE, SCHEMA), spark.createDataFrame(NEW, SCHEMA)


def result(df):
    return {r["id"]: tuple(r) for r in df.collect()}


def test_full_and_partial_upsert_agree(spark):
    base, new = frames(spark)
    assert result(rows.upsert(base, new)) == AFTER
    flags = rows.non_null_touched(["first_name", "last_name", "hair"])
    assert result(rows.upsert_partial(base, new, flags)) == AFTER


def test_unset_and_partial_rows(spark):
    base, _ = frames(spark)
    new = spark.createDataFrame(
        [("12348", None, None, None, ["last_name"]), ("12350", None, "Stark", None, []), ("12345", "J", None, None, None)],
        SCHEMA + ", unset array<string>",
    )
    flags = rows.non_null_touched(["first_name", "last_name", "hair"], "unset")
    got = result(rows.upsert_partial(base, new, flags))
    assert got["12348"] == ("12348", "Tyrion", None, "blonde")
    assert got["12350"] == ("12350", None, "Stark", None)
    assert got["12345"] == ("12345", "J", "Snow", "black")
    assert len(got) == 6


def test_insert_ignore_and_last_wins(spark):
    base = spark.createDataFrame([("a", 1)], "id string, v int")
    new = spark.createDataFrame([("a", 5, 1), ("b", 6, 3), ("b", 7, 2), ("c", 8, 4)], "id string, v int, s int")
    assert {r["id"]: r["v"] for r in rows.insert_ignore(base, new, "id", "s").collect()} == {"a": 1, "b": 7, "c": 8}
    assert {r["id"]: r["v"] for r in rows.upsert(base, new, "id", "s").collect()} == {"a": 5, "b": 6, "c": 8}


def test_append_and_delete(spark):
    base, new = frames(spark)
    assert rows.append(base, new).count() == 10
    gone = spark.createDataFrame([("12345",), ("12349",), ("x",)], "id string")
    assert sorted(rows_by_key(rows.delete_keys(base, gone))) == ["12346", "12347", "12348"]


def test_keys(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), ("2", "a")], "id string, signup_code string")
    assert {(r["id"], r["n_rows"]) for r in rows.key_violations(df).collect()} == {("1", 2), (None, 1)}
    assert {r["signup_code"] for r in rows.key_violations(df, "signup_code").collect()} == {"a"}
    assert rows.key_violations(df.where("id IS NOT NULL"), ["id", "signup_code"]).isEmpty()


def test_composite_key_upsert(spark):
    base = spark.createDataFrame([("1", "a", 1), ("1", "b", 2)], "id string, code string, v int")
    new = spark.createDataFrame([("1", "b", 3), ("2", "b", 4)], "id string, code string, v int")
    got = {(r["id"], r["code"]): r["v"] for r in rows.upsert(base, new, ["id", "code"]).collect()}
    assert got == {("1", "a"): 1, ("1", "b"): 3, ("2", "b"): 4}


def test_partial_rows_of_a_key_add_up(spark):
    base = spark.createDataFrame([("1", 0.0, "old"), ("2", 5.0, "keep")], "id string, a double, b string")
    new = spark.createDataFrame(
        [("1", 7.0, None, 1, None), ("1", None, "n", 2, None), ("1", None, None, 3, None), ("2", 6.0, None, 1, None), ("2", None, None, 2, ["a"]), ("3", None, "x", 1, None)],
        "id string, a double, b string, seq int, unset array<string>",
    )
    out = rows.upsert_partial(base, new, rows.non_null_touched(["a", "b"], "unset"), "id", "seq")
    assert sorted(tuple(r) for r in out.collect()) == [("1", 7.0, "n"), ("2", None, "keep"), ("3", None, "x")]
