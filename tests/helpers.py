"""Small documents and feeds, and a plain replay to compare the fold with."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from docsync.operators.mapping import make_map
from docsync.sources import documents

COMPANY = make_map(
    "Company", "company",
    [("id", "_id", "TEXT"), ("active", "active", "BOOLEAN"), ("domains", "domains", "JSONB"), ("signup_code", "signupCode", "TEXT")],
)
EMPLOYEE = make_map(
    "Employee", "employee",
    [("id", "_id", "TEXT"), ("first_name", "firstName", "TEXT"), ("last_name", "lastName", "TEXT"), ("hair", "hair", "TEXT")],
)


def docs_frame(spark, docs):
    rows = [(json.dumps(d), i) for i, d in enumerate(docs)]
    return documents.from_json(spark.createDataFrame(rows, "body string, seq long"), "body", "seq")


def events_frame(spark, events):
    """Events as tuples ``(op, coll, id, fields, removed, seq)``."""
    rows = [
        (op, coll, i, json.dumps(f) if op == "update" else None, removed, json.dumps(f) if op in ("insert", "replace") else None, seq)
        for op, coll, i, f, removed, seq in events
    ]
    df = spark.createDataFrame(rows, "op string, coll string, id string, u string, removed array<string>, d string, seq long")
    return df.select(
        F.col("op").alias("operationType"),
        F.struct(F.lit("db").alias("db"), "coll").alias("ns"),
        F.struct(F.col("id").alias("_id")).alias("documentKey"),
        F.struct(F.parse_json("u").alias("updatedFields"), F.col("removed").alias("removedFields")).alias("updateDescription"),
        F.parse_json("d").alias("fullDocument"),
        "seq",
    )


def event_json(op, coll, i, fields, removed, seq):
    """The same event as one line of JSON."""
    e = {"operationType": op, "ns": {"db": "db", "coll": coll}, "documentKey": {"_id": i}, "seq": seq}
    if op == "update":
        e["updateDescription"] = {"updatedFields": fields, "removedFields": removed}
    elif op in ("insert", "replace"):
        e["fullDocument"] = fields
    return json.dumps(e)


def replay(base, events, sources):
    """Apply events one after the other to ``{id: {source: value}}``."""
    rows = {k: dict(v) for k, v in base.items()}
    for op, _, i, fields, removed, _ in sorted(events, key=lambda e: e[5]):
        if op == "delete":
            rows.pop(i, None)
            continue
        row = rows.setdefault(i, {s: None for s in sources})
        for s in sources:
            if op == "replace":
                row[s] = fields.get(s)
            elif s in fields and (fields[s] is not None or op == "update"):
                row[s] = fields[s]
            if op == "update" and s in (removed or []):
                row[s] = None
    return rows


def rows_by_key(df, key="id"):
    return {r[key]: {k: v for k, v in r.asDict().items() if k != key} for r in df.collect()}
