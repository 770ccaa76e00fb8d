"""The registered queries as plain SQL over the given tables, for checking."""

from __future__ import annotations

# The change feed of ``inputs.as_feed``: one row per event.  ``s_*`` is the
# event's position where it touches the column, else null.
_FEED = """
feed AS (
  SELECT cast(user_id AS varchar) AS id, event_id AS seq, event_type AS kind,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
              {replace} ELSE 'update' END AS op,
         CASE WHEN event_type <> 'view' THEN value END AS v,
         cast(json_extract_string(props, '$.k') AS bigint) AS k_all
  FROM events
), touched AS (
  SELECT id, seq, op, v,
         CASE WHEN kind NOT IN ('click', 'purchase') THEN cast(k_all AS double) END AS k, kind,
         CASE WHEN op <> 'delete' THEN seq END AS s_v,
         CASE WHEN op <> 'delete' AND (kind <> 'click') THEN seq END AS s_k
  FROM feed
)"""

# One row per id: last delete, last other change, and per column the value of
# the last touch after the last delete (in a struct, for nulls to count).
_FOLD = """
ends AS (
  SELECT id, max(seq) FILTER (op = 'delete') AS ld, max(seq) FILTER (op <> 'delete') AS ll
  FROM touched {where} GROUP BY id
), folded AS (
  SELECT t.id, any_value(e.ld) AS ld, any_value(e.ll) AS ll,
         arg_max(struct_pack(x := t.v), t.seq) FILTER (t.s_v IS NOT NULL AND t.seq > coalesce(e.ld, -1)) AS n_v,
         arg_max(struct_pack(x := t.kind), t.seq) FILTER (t.s_v IS NOT NULL AND t.seq > coalesce(e.ld, -1)) AS n_e,
         arg_max(struct_pack(x := t.k), t.seq) FILTER (t.s_k IS NOT NULL AND t.seq > coalesce(e.ld, -1)) AS n_k
  FROM (SELECT * FROM touched {where}) t JOIN ends e ON t.id = e.id GROUP BY t.id
)"""

_USERS = """
users AS (
  SELECT cast(c_custkey AS varchar) AS id, c_acctbal AS value, c_mktsegment AS event_type,
         cast(c_nationkey AS double) AS k
  FROM customer
)"""

_APPLY = """
SELECT coalesce(u.id, f.id) AS id,
       CASE WHEN n_v IS NOT NULL THEN n_v.x WHEN ld IS NULL THEN u.value END AS value,
       CASE WHEN n_e IS NOT NULL THEN n_e.x WHEN ld IS NULL THEN u.event_type END AS event_type,
       CASE WHEN n_k IS NOT NULL THEN n_k.x WHEN ld IS NULL THEN u.k END AS k
FROM users u FULL OUTER JOIN folded f ON u.id = f.id
WHERE f.id IS NULL OR coalesce(ll, -1) > coalesce(ld, -1)
"""

_PLAIN_FEED = _FEED.format(replace="")
_REPLACE_FEED = _FEED.format(replace="WHEN 'purchase' THEN 'replace'")
_FLAGSHIP = f"WITH {_PLAIN_FEED}, {_FOLD.format(where='')}, {_USERS} {_APPLY}"

# Fields of ``inputs.mixed_order_fields`` with the type each value votes for.
_VOTES = """
votes AS (
  SELECT o_orderkey AS seq, unnest([
    struct_pack(field := '_id', col := 'id', pos := 1, type := 'text'),
    struct_pack(field := 'totalPrice', col := 'total_price', pos := 2, type := 'double precision'),
    struct_pack(field := 'orderedAt', col := 'ordered_at', pos := 3, type := 'timestamp'),
    struct_pack(field := 'payload', col := 'payload', pos := 4,
      type := CASE o_orderstatus WHEN 'F' THEN 'text' WHEN 'O' THEN 'double precision' END),
    struct_pack(field := 'Detail', col := 'detail', pos := 5,
      type := CASE WHEN o_orderstatus = 'P' THEN 'jsonb' WHEN o_totalprice > 250000 THEN 'boolean' ELSE 'jsonb' END),
    struct_pack(field := 'nothing', col := 'nothing', pos := 6, type := cast(NULL AS varchar))
  ], recursive := true)
  FROM {source}
), histogram AS (
  SELECT field, col, type, count(*) AS n, max(seq) AS newest FROM votes GROUP BY field, col, type
), dominant AS (
  SELECT field, col,
         coalesce(arg_max(type, struct_pack(n := n, newest := newest)) FILTER (type IS NOT NULL), 'text') AS type
  FROM histogram GROUP BY field, col
)"""
_MIXED = "WITH " + _VOTES.format(source="orders")

_ACCOUNTS = """
base AS (
  SELECT c_custkey AS id, c_acctbal AS amount, c_mktsegment AS note FROM customer WHERE c_mktsegment <> 'BUILDING'
), changes AS (
  SELECT o_custkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS amount,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS note, o_orderkey AS seq, o_orderstatus AS st
  FROM orders
), one AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq {direction}) AS rn FROM changes) WHERE rn = 1
)"""

_NUMBER = "o_orderpriority"

ORACLES: dict[str, str] = {
    "documents_to_rows": """
SELECT cast(event_id AS varchar) AS id, ts AS created_at, cast(user_id AS double) AS user_id, event_type,
       CASE WHEN event_type <> 'view' THEN value END AS value, value > 10 AS has_value,
       cast(json_extract_string(props, '$.k') AS double) AS props_k
FROM events""",
    "typed_documents_to_rows": """
SELECT cast(o_orderkey AS varchar) AS id, cast(o_custkey AS varchar) AS customer, o_totalprice AS total_price,
       o_orderdate AS ordered_at, o_orderpriority AS priority
FROM orders""",
    "extra_props_spill": """
SELECT cast(event_id AS varchar) AS id, cast(NULL AS double) AS event_type,
       CASE WHEN event_type <> 'view' THEN value END AS value, event_type AS extra_event_type,
       user_id AS extra_user_id, value > 10 AS extra_has_value,
       cast(json_extract_string(props, '$.k') AS bigint) AS extra_k, cast(5 AS bigint) AS n_extra
FROM events""",
    "cast_matrix": """
SELECT o_orderkey, o_orderpriority AS words_text, cast(NULL AS double) AS words_double, true AS words_double_failed,
       cast(NULL AS timestamp) AS words_timestamp, true AS words_timestamp_failed, true AS words_boolean,
       TRY_CAST(substr(o_orderpriority, 1, 1) AS double) AS digit_double, false AS digit_double_failed,
       o_orderdate AS date_timestamp, false AS date_timestamp_failed,
       cast(floor(o_totalprice) AS bigint) % 2 <> 0 AS bit_boolean,
       CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS flag_text,
       cast(NULL AS double) AS flag_double, true AS flag_double_failed, o_orderstatus = 'F' AS flag_boolean,
       CASE WHEN o_orderstatus <> 'O' THEN false END AS blank_boolean,
       cast(NULL AS double) AS blank_double, o_orderstatus <> 'O' AS blank_double_failed,
       o_orderstatus <> 'F' AS object_boolean, cast(NULL AS double) AS object_double, true AS object_double_failed
FROM orders""",
    "cast_errors": """
SELECT 'orders' AS location, 'value does not fit: priority: ' || o_orderkey AS message
FROM orders WHERE TRY_CAST(o_orderpriority AS double) IS NULL
UNION ALL
SELECT 'orders', 'value does not fit: orderedAt: ' || o_orderkey FROM orders""",
    "type_histogram": _MIXED + """
SELECT field, col AS "column", type, n AS n_documents FROM histogram""",
    "dominant_type": _MIXED + """
SELECT field, col AS "column", type FROM dominant""",
    "inferred_map": """
SELECT table_name AS collection_name, table_name AS relation_name, ordinal_position - 1 AS "position",
       column_name AS "column", column_name AS source,
       CASE WHEN data_type = 'VARCHAR' THEN 'TEXT' WHEN data_type LIKE 'TIMESTAMP%' THEN 'TIMESTAMP'
            WHEN data_type = 'BOOLEAN' THEN 'BOOLEAN'
            WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT') THEN 'DOUBLE PRECISION' ELSE 'JSONB' END AS type
FROM information_schema.columns
WHERE table_name IN ('benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels',
                     'lineitem', 'nation', 'orders', 'pages', 'part', 'region', 'supplier')""",
    "inferred_map_of_keyed_documents": """
WITH fields AS (
  SELECT unnest([
    struct_pack(f := '_id', c := 'id', t := 'TEXT', p := 1), struct_pack(f := 'totalPrice', c := 'total_price', t := 'DOUBLE PRECISION', p := 2),
    struct_pack(f := CASE WHEN o_orderstatus = 'F' THEN 'Note' END, c := 'note', t := 'TEXT', p := 3),
    struct_pack(f := CASE WHEN o_orderkey % 1000 = 0 THEN 'rare' END, c := 'rare', t := 'BOOLEAN', p := 4),
    struct_pack(f := 'c' || o_custkey, c := 'c' || o_custkey, t := 'JSONB', p := 5)], recursive := true)
  FROM orders
)
SELECT 'KeyedOrders' AS collection_name, 'keyed_orders' AS relation_name, row_number() OVER (ORDER BY min(p)) - 1 AS "position", c AS "column", f AS source, t AS type
FROM fields WHERE f IS NOT NULL GROUP BY f, c, t HAVING count(*) >= 0.05 * (SELECT count(*) FROM orders)""",
    "inferred_document_map": _MIXED + """
, placed AS (SELECT DISTINCT field, pos FROM votes)
SELECT 'MixedOrders' AS collection_name, 'mixed_orders' AS relation_name, pos - 1 AS "position",
       col AS "column", field AS source, upper(type) AS type
FROM dominant JOIN placed USING (field)
UNION ALL
SELECT 'Events', 'events', p, c, s, t
FROM (VALUES (0, 'id', '_id', 'DOUBLE PRECISION'), (1, 'created_at', 'createdAt', 'TEXT'), (2, 'user_id', 'userId', 'DOUBLE PRECISION'),
             (3, 'event_type', 'eventType', 'TEXT'), (4, 'value', 'value', 'DOUBLE PRECISION'),
             (5, 'has_value', 'hasValue', 'BOOLEAN'), (6, 'props', 'props', 'JSONB')) e(p, c, s, t)
WHERE EXISTS (SELECT 1 FROM events)""",
    "sampled_map": "WITH " + _VOTES.format(source="(SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 100)") + """
, placed AS (SELECT DISTINCT field, pos FROM votes)
SELECT 'MixedOrders' AS collection_name, 'mixed_orders' AS relation_name, pos - 1 AS "position",
       col AS "column", field AS source, upper(type) AS type
FROM dominant JOIN placed USING (field)""",
    "recent_sample": "SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 100",
    "projected_scan": "SELECT o_orderkey, o_totalprice FROM orders",
    "point_lookup": "SELECT * FROM orders WHERE o_orderkey = 42",
    "collection_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS collection_name, count(*) AS n_documents FROM {t}"
        for t in ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
                  "lineitem", "nation", "orders", "pages", "part", "region", "supplier")
    ),
    "collections_present": """
SELECT collection_name, "position" FROM (VALUES ('signup', 0), ('refund', 1), ('error', 2), ('logout', 3)) r(collection_name, "position")
WHERE collection_name IN (SELECT event_type FROM events)""",
    "collections_missing": """
SELECT collection_name, "position" FROM (VALUES ('signup', 0), ('refund', 1), ('error', 2), ('logout', 3)) r(collection_name, "position")
WHERE collection_name NOT IN (SELECT event_type FROM events)""",
    "snake_case_names": """
SELECT doc_id, trim(lower(regexp_replace(regexp_replace(text, '[^A-Za-z_]', '', 'g'), '([A-Z]+)', '_\\1', 'g')), '_') AS column_name
FROM documents""",
    "snake_case_texts": """
SELECT doc_id, trim(lower(regexp_replace(text, '([A-Z]+)', '_\\1', 'g')), '_') AS column_name FROM documents""",
    "append_rows": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "insert_ignore": "WITH " + _ACCOUNTS.format(direction="ASC") + """
SELECT * FROM base UNION ALL SELECT id, amount, note FROM one WHERE id NOT IN (SELECT id FROM base)""",
    "upsert_full": "WITH " + _ACCOUNTS.format(direction="DESC") + """
SELECT * FROM base WHERE id NOT IN (SELECT id FROM one) UNION ALL SELECT id, amount, note FROM one""",
    "upsert_partial": "WITH " + _ACCOUNTS.format(direction="DESC") + """, last AS (
  SELECT id, arg_max(struct_pack(x := amount), seq) FILTER (st = 'P' OR amount IS NOT NULL) AS amount,
         arg_max(struct_pack(x := note), seq) FILTER (note IS NOT NULL) AS note
  FROM changes GROUP BY id
)
SELECT coalesce(b.id, o.id) AS id, CASE WHEN o.amount IS NOT NULL THEN o.amount.x ELSE b.amount END AS amount,
       CASE WHEN o.note IS NOT NULL THEN o.note.x ELSE b.note END AS note
FROM base b FULL OUTER JOIN last o ON b.id = o.id""",
    "delete_keys": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "key_violations": "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "composite_key_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "normalise_changes": f"""WITH {_REPLACE_FEED}
SELECT 'app.Users' AS ns, id, seq, op, CASE WHEN op <> 'delete' THEN v END AS value,
       CASE WHEN op <> 'delete' THEN kind END AS event_type,
       CASE WHEN kind IN ('signup', 'view') THEN k_all END AS k,
       op <> 'delete' AND v IS NULL AS value_is_null, cast(NULL AS varchar) AS removed
FROM feed""",
    "changes_in_map": f"""WITH {_PLAIN_FEED}
SELECT 'Users.' || kind AS coll_name, op, count(*) AS n_changes, max(seq) AS last_seq FROM feed
WHERE kind IN (SELECT event_type FROM events WHERE value > 100 AND event_type <> 'click') GROUP BY 1, 2""",
    "merge_updates": f"""WITH {_PLAIN_FEED}
SELECT id, (arg_max(struct_pack(x := v), seq)).x AS value, (arg_max(struct_pack(x := kind), seq)).x AS event_type,
       (arg_max(struct_pack(x := k), seq) FILTER (s_k IS NOT NULL)).x AS k,
       true AS touched_value, true AS touched_event_type, count(s_k) > 0 AS touched_k, count(*) > 1 AS merged
FROM touched WHERE op = 'update' GROUP BY id""",
    "replace_document": f"WITH {_REPLACE_FEED}, {_FOLD.format(where='')}, {_USERS} {_APPLY}",
    "operation_runs": f"""WITH {_PLAIN_FEED}, sized AS (
  SELECT f.*, CASE WHEN e.value >= 20 THEN 'Big' ELSE 'Small' END AS coll
  FROM feed f JOIN events e ON f.seq = e.event_id
), marked AS (
  SELECT *, CASE WHEN lag(op) OVER w IS DISTINCT FROM op THEN 1 ELSE 0 END AS starts FROM sized
  WINDOW w AS (PARTITION BY coll ORDER BY seq)
), numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY coll ORDER BY seq) AS run FROM marked
)
SELECT 'app' AS db_name, coll AS coll_name, any_value(op) AS op, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n_changes
FROM numbered GROUP BY coll, run""",
    "fold_changes": _FLAGSHIP,
    "fold_in_batches": _FLAGSHIP,
    "stream_fold": _FLAGSHIP,
    "stream_fold_shuffled": _FLAGSHIP,
    "repeated_batch": _FLAGSHIP,
    "stream_fold_stateful": _FLAGSHIP,
    "stored_lookup": f"SELECT * FROM ({_FLAGSHIP}) f WHERE id IN ('1000000000000', {', '.join(repr(str(k)) for k in range(1, 13))})",
    "fold_many_collections": f"""WITH {_PLAIN_FEED}, {_FOLD.format(where='')}
SELECT 'c' || cast(id AS bigint) % 50 AS coll_name, id, n_v.x AS value, n_e.x AS event_type,
       CASE WHEN cast(id AS bigint) % 2 = 0 THEN n_k.x END AS k
FROM folded WHERE coalesce(ll, -1) > coalesce(ld, -1)""",
    "fold_across_maps": f"""WITH {_PLAIN_FEED}, {_FOLD.format(where='')}, {_USERS}, parts AS (
  SELECT max(event_id) // 3 AS p FROM events
), known AS (
  SELECT id, arg_max(struct_pack(x := seq >= p), seq) FILTER (s_v IS NOT NULL AND seq > coalesce(ld, -1)) AS n_e,
         arg_max(struct_pack(x := k), seq) FILTER (s_k IS NOT NULL AND seq > coalesce(ld, -1) AND seq >= p) AS n_k
  FROM touched JOIN ends USING (id), parts GROUP BY id
)
SELECT coalesce(u.id, f.id) AS id, CASE WHEN n_v IS NOT NULL THEN n_v.x WHEN ld IS NULL THEN u.value END AS value,
       CASE WHEN known.n_e.x THEN true END AS known, known.n_k.x AS k
FROM users u FULL OUTER JOIN folded f ON u.id = f.id LEFT JOIN known ON known.id = f.id
WHERE f.id IS NULL OR coalesce(ll, -1) > coalesce(ld, -1)""",
    "errors_across_maps": f"""WITH {_PLAIN_FEED}
SELECT 'users' AS location, 'value does not fit: eventType: ' || id AS message, count(*) AS n_errors
FROM feed WHERE op <> 'delete' AND seq >= (SELECT max(event_id) // 2 FROM events) GROUP BY id""",
    "fold_wide_with_extra_props": """
WITH feed AS (
  SELECT cast(user_id AS varchar) AS id, event_id AS seq, event_type AS kind, coalesce(cast(json_extract_string(props, '$.k') AS bigint), 0) AS k FROM events
), ends AS (
  SELECT id, max(seq) FILTER (kind = 'error') AS ld, max(seq) FILTER (kind <> 'error') AS ll, max(seq) FILTER (kind = 'signup') AS lc FROM feed GROUP BY id
), touches AS (
  SELECT id, seq, 'c' || seq % 300 AS field, CASE WHEN kind NOT IN ('click', 'purchase') THEN cast(k AS double) END AS v, kind = 'click' AS unfit, false AS other
  FROM feed WHERE kind <> 'error'
  UNION ALL SELECT id, seq, 'x' || seq % 7, NULL, false, true FROM feed WHERE kind <> 'error'
), last AS (
  SELECT t.id, field, any_value(other) AS other, arg_max(struct_pack(x := v), seq) AS v, arg_max(unfit, seq) AS unfit, max(seq) >= coalesce(any_value(lc), -1) AS fresh
  FROM touches t JOIN ends e ON t.id = e.id WHERE seq > coalesce(ld, -1) GROUP BY t.id, field
)
SELECT id, count(v.x) AS n_values, coalesce(sum(v.x), 0) AS sum_values, count(*) FILTER (fresh AND (other OR unfit)) AS n_extra,
       count(*) FILTER (fresh AND unfit) AS n_misfits
FROM last JOIN ends USING (id) WHERE coalesce(ll, -1) > coalesce(ld, -1) GROUP BY id""",
    "feed_errors": f"""WITH {_PLAIN_FEED}
SELECT 'Users' AS location, CASE op WHEN 'insert' THEN 'operation is unknown: explode: ' || id || ': ' || seq
       WHEN 'delete' THEN 'event has no id: delete: ' || seq ELSE 'event has no position: update: ' || id END AS message
FROM feed WHERE op <> 'update' OR kind = 'purchase'""",
    "resume_position": f"""WITH {_PLAIN_FEED}
SELECT id, seq, op FROM feed WHERE seq >= (SELECT max(event_id) FROM events WHERE day(ts) <= 15)""",
    "fold_with_extra_props": f"""WITH {_PLAIN_FEED}, {_FOLD.format(where='')}
SELECT id, n_v.x AS value, n_e.x AS extra_event_type, cast(n_k.x AS bigint) AS extra_k,
       (n_e.x IS NOT NULL)::BIGINT + (n_k.x IS NOT NULL)::BIGINT AS n_extra
FROM folded WHERE coalesce(ll, -1) > coalesce(ld, -1)""",
    "resume_from": f"""WITH {_PLAIN_FEED}
SELECT f.id, f.seq, f.op FROM feed f JOIN events e ON f.seq = e.event_id WHERE e.ts >= TIMESTAMP '2024-01-12 06:30:00'""",
    "map_diff": _MIXED + """, old AS (
  SELECT field, CASE col WHEN 'ordered_at' THEN 'ordered_at' ELSE col END AS col, upper(type) AS type FROM dominant
), new AS (
  SELECT field, CASE col WHEN 'ordered_at' THEN 'ordered_on' ELSE col END AS col,
         CASE WHEN field = 'totalPrice' THEN 'TEXT' ELSE type END AS type FROM old WHERE field <> 'nothing'
  UNION ALL SELECT 'customer', 'customer', 'DOUBLE PRECISION'
)
SELECT 'Orders' AS collection_name, coalesce(o.field, n.field) AS source, o.col AS old_column, n.col AS new_column,
       o.type AS old_type, n.type AS new_type,
       CASE WHEN o.field IS NULL THEN 'added' WHEN n.field IS NULL THEN 'removed' WHEN o.type <> n.type THEN 'retyped'
            WHEN o.col <> n.col THEN 'renamed' ELSE 'same' END AS change
FROM old o FULL OUTER JOIN new n ON o.field = n.field""",
    "track_untrack": """
SELECT 'Part' AS collection_name, 'track' AS change WHERE EXISTS (SELECT 1 FROM part)
UNION ALL SELECT 'Customer', 'untrack' WHERE EXISTS (SELECT 1 FROM customer)""",
    "retype_column": """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS double) AS rank, o_totalprice <> 0 AS o_totalprice,
       cast(o_orderdate AS varchar) AS o_orderdate, o_orderpriority FROM orders""",
    "retype_refused": """
SELECT 'orders' AS relation, 'o_orderpriority' AS "column",
       CASE WHEN count(*) FILTER (TRY_CAST(o_orderpriority AS double) IS NULL) > 0 THEN 'refused' ELSE 'retyped' END AS change,
       'text' AS old_type, 'double precision' AS new_type,
       count(*) FILTER (TRY_CAST(o_orderpriority AS double) IS NULL) AS failures FROM orders
UNION ALL SELECT 'orders', 'o_totalprice', 'refused', 'double precision', 'jsonb', 0
UNION ALL SELECT 'orders', 'o_orderdate', 'refused', 'timestamp', 'double precision', count(o_orderdate) FROM orders
UNION ALL SELECT 'orders', 'rank', CASE WHEN count(*) FILTER (TRY_CAST(substr(o_orderpriority, 1, 1) AS double) IS NULL) > 0
       THEN 'refused' ELSE 'retyped' END, 'text', 'double precision', 0 FROM orders""",
    "evolve_table": """
SELECT cast(c_custkey AS varchar) AS id, c_mktsegment AS mkt_segment, cast(NULL AS varchar) AS comment,
       c_acctbal AS acct_bal, c_nationkey <> 0 AS nation_key FROM customer""",
    "evolve_renamed": """
SELECT cast(c_custkey AS varchar) AS id, c_mktsegment AS name, c_acctbal AS balance, c_name AS customer_name FROM customer""",
    "second_load": """
SELECT cast(o_orderkey AS varchar) AS id, cast(o_custkey AS varchar) AS customer,
       CASE WHEN o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END AS total_price,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS ordered_at, o_orderpriority AS priority
FROM orders""",
    "load_without_ids": """
SELECT 'orders' AS location, 'document has no id' AS message, 2 * count(*) FILTER (o_orderpriority = '1-URGENT') AS n_errors,
       count(*) FILTER (o_orderpriority <> '1-URGENT') AS n_rows, count(*) FILTER (o_orderpriority <> '1-URGENT') AS n_ids,
       count(*) FILTER (o_orderpriority <> '1-URGENT') AS n_loaded
FROM orders""",
    "inferred_date_map": """
SELECT c AS collection_name, r AS relation_name, p AS "position", col AS "column", src AS source, t AS type
FROM (VALUES ('Days', 'days', 0, 'id', '_id', 'TEXT'), ('Days', 'days', 1, 'order_day', 'orderDay', 'TIMESTAMP'),
             ('TypedDays', 'typed_days', 0, 'o_orderkey', 'o_orderkey', 'DOUBLE PRECISION'), ('TypedDays', 'typed_days', 1, 'order_day', 'orderDay', 'TIMESTAMP')) v(c, r, p, col, src, t)
WHERE EXISTS (SELECT 1 FROM orders)""",
    "load_errors": """
SELECT 'events' AS location, 'document is not JSON: {"broken": ' || event_id AS message,
       (SELECT count(*) FROM events WHERE event_type <> 'error') AS rows_loaded
FROM events WHERE event_type = 'error'""",
    "evolve_report": """
SELECT 'customer' AS relation, c AS "column", change, old_type, new_type, 0 AS failures
FROM (VALUES ('name', 'removed', 'text', NULL), ('acct_bal', 'retyped', 'double precision', 'TEXT'),
             ('nation_key', 'retyped', 'double precision', 'BOOLEAN'), ('comment', 'added', NULL, 'text')) r(c, change, old_type, new_type)
WHERE EXISTS (SELECT 1 FROM customer)""",
    "backfill_column": """
SELECT cast(c_custkey AS varchar) AS id, c_name AS name, cast(c_nationkey AS double) AS nation_key,
       c_acctbal AS acct_bal, c_mktsegment AS mkt_segment FROM customer WHERE c_acctbal > 0""",
    "convertible_types": _MIXED + """
SELECT o.field, o.type AS old_type, o.n AS n_old, n.type AS new_type,
       NOT (o.type = 'double precision' AND n.type = 'jsonb' OR o.type = 'jsonb' AND n.type = 'boolean') AS convertible
FROM histogram o JOIN histogram n ON o.field = n.field AND o.type <> n.type""",
    "audit_rows": f"""WITH {_PLAIN_FEED}
SELECT seq, op AS operation, 'users' AS relation, id AS obj_id,
       op = 'update' AND count(*) FILTER (op = 'update') OVER (PARTITION BY id) > 1 AS merged,
       CASE WHEN op <> 'delete' THEN kind END AS "document_eventType", CASE WHEN op <> 'delete' THEN v END AS document_value,
       CASE WHEN kind IN ('signup', 'view') THEN k_all END AS document_k
FROM feed""",
    "change_errors": f"""WITH {_PLAIN_FEED}
SELECT 'users' AS location, 'value does not fit: eventType: ' || id AS message, count(*) AS n_errors
FROM feed WHERE op <> 'delete' GROUP BY id""",
    "position": "SELECT 'users' AS relation, max(event_id) AS latest_successful_ts FROM events",
    "snapshot_load": """
SELECT o_orderpriority AS kind, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_values, max(o_totalprice) AS top, 'orders' AS relation
FROM orders GROUP BY 1
UNION ALL
SELECT c_mktsegment, count(*), count(DISTINCT c_name), max(c_acctbal), 'customer' FROM customer GROUP BY 1""",
    "transfer_stats": """
SELECT 'orders' AS relation, 'INSERT' AS action, count(*) AS number_of_rows, 0 AS failures FROM orders
UNION ALL SELECT 'customer', 'INSERT', count(*), 0 FROM customer""",
    "typed_cast_matrix": """
SELECT vec_id, label <> 0 AS label_boolean, false AS label_boolean_failed, cast(label AS double) AS label_double,
       false AS label_double_failed, cast(NULL AS timestamp) AS label_timestamp, true AS label_timestamp_failed,
       len(embedding) > 0 AS embedding_boolean, false AS embedding_boolean_failed, cast(NULL AS double) AS embedding_double,
       true AS embedding_double_failed, cast(NULL AS timestamp) AS embedding_timestamp, true AS embedding_timestamp_failed,
       cast(embedding[1] AS double) AS first_value,
       CASE WHEN label % 3 = 0 THEN '[{"x":null,"y":{"k":[null]}}]'
            ELSE '[{"x":' || label || '.0,"y":{"k":[' || label || '.0]}}]' END AS nested_jsonb
FROM embeddings""",
}

ORACLES["stored_map"] = ORACLES["inferred_map"]
