"""DuckDB SQL for the catalog's queries, written from what the queries mean and not from how they work."""

from __future__ import annotations

#: Orders, line items in log order with their order's shape, and committed rows.
BASE = r"""
o AS (SELECT o_orderkey AS k, o_orderkey % 50 AS shape, o_orderkey + 1 AS gno, o_orderstatus AS st FROM orders),
l AS (
  SELECT k, shape, gno, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn,
         CASE st WHEN 'O' THEN 'insert' WHEN 'F' THEN 'update' ELSE 'delete' END AS op,
         CASE l_returnflag WHEN 'A' THEN 'shop.items' WHEN 'N' THEN 'shop.lines' ELSE 'shop.returns' END AS subject,
         l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_quantity::DECIMAL(12,2)::VARCHAR AS q
  FROM lineitem JOIN o ON l_orderkey = k WHERE shape NOT IN (7, 13)
),
c AS (SELECT *, k * 64 + 2 + rn AS pos FROM l WHERE shape NOT IN (19, 29, 37)),
done AS (
  SELECT k, gno, shape, CASE shape WHEN 7 THEN 'ddl' WHEN 13 THEN 'other' WHEN 23 THEN 'commit' ELSE 'xid' END AS ended_by,
         (shape IN (7, 31))::INT::BIGINT AS n_ddl
  FROM o WHERE shape NOT IN (19, 29, 37)
)"""

IMAGE = """'{"' || {a} || '":' || p || ',"' || {b} || '":' || s || ',"' || {c} || '":' || n || ',"' || {d} || '":"' || {q} || '"}'"""


def _image(q: str) -> str:
    named = [f"CASE WHEN subject = 'shop.returns' THEN 'col_{i}' ELSE '{name}' END" for i, name in enumerate(("part", "supp", "line", "qty"))]
    text = IMAGE
    for letter, column in zip("abcd", named, strict=True):
        text = text.replace("{" + letter + "}", column)
    return text.replace("{q}", q)


DATA = f"""'{{"op":"' || op || '"' || CASE WHEN op <> 'insert' THEN ',"before":' || {_image("'0.00'")} ELSE '' END || CASE WHEN op <> 'delete' THEN ',"after":' || {_image("q")} ELSE '' END || '}}'"""
KIND = "'org.logweave.log.row.' || op || CASE WHEN op = 'insert' THEN 'ed' ELSE 'd' END"
UUID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"

#: Document changes and what they mean.
DOCS = r"""
raw AS (
  SELECT event_id AS pos, event_id AS e, user_id, CASE event_type WHEN 'click' THEN 'update' WHEN 'view' THEN 'insert' WHEN 'purchase' THEN 'replace' WHEN 'signup' THEN 'delete'
           ELSE ['drop', 'rename', 'drop_database', 'invalidate', 'other'][event_id % 5 + 1] END AS op,
         CASE WHEN event_id % 89 = 0 THEN 'system.views' WHEN event_id % 97 <> 0 THEN 'c' || (user_id % 4) END AS coll,
         CASE WHEN event_id % 59 <> 0 THEN '{"_id":' || event_id || '}' END AS doc_key,
         CASE WHEN event_id % 53 <> 0 THEN '{"_id":' || event_id || ',"user":' || user_id || '}' END AS doc,
         CASE WHEN event_id % 70 < 49 THEN event_id // 7 END AS txn,
         epoch_us(ts) // 1000000 AS t,
         '82' || lower(printf('%08x', epoch_us(ts) // 1000000)) || lower(printf('%08x', event_id)) AS token
  FROM events
), kinds AS (
  SELECT *, CASE WHEN op IN ('insert', 'update', 'replace') AND coll IS NOT NULL AND coll NOT LIKE 'system.%' AND (doc IS NOT NULL OR MODE = 'signal') THEN 'row'
                 WHEN op = 'delete' AND coll IS NOT NULL AND (doc_key IS NOT NULL OR MODE = 'signal') THEN 'row'
                 WHEN op IN ('drop', 'rename') AND coll IS NOT NULL THEN 'control'
                 WHEN op IN ('drop_database', 'invalidate') THEN 'control' ELSE 'filtered' END AS raw_effect
  FROM raw
), eff AS (
  SELECT *, CASE WHEN raw_effect <> 'filtered' AND op NOT IN ('drop_database', 'invalidate') AND LISTED AND coll NOT IN ('c0', 'c1', 'c2') THEN 'filtered' ELSE raw_effect END AS effect
  FROM kinds
), run AS (
  SELECT *, max(CASE WHEN txn IS NULL OR prev IS NULL OR prev <> txn THEN pos END) OVER (ORDER BY pos) AS run_start
  FROM (SELECT *, lag(txn) OVER (ORDER BY pos) AS prev FROM eff)
)"""


def _docs(mode: str = "full", listed: bool = True) -> str:
    return DOCS.replace("MODE", f"'{mode}'").replace("LISTED", str(listed).lower())


LISTED = "subject IN ('shop.items', 'shop.lines')"
PLACE = """'{"resume_token":"' || {f}(token, pos) || '","cluster_time":{"t":' || {f}(t, pos) || ',"i":' || {f}(e, pos) || '}}'"""



def _avro(text: str) -> str:
    """A string of under 8,192 bytes as Avro writes it, in hex."""
    n = f"2 * length({text})"
    return f"CASE WHEN {n} < 128 THEN printf('%02x', {n}) ELSE printf('%02x%02x', {n} % 128 + 128, {n} // 128) END || lower(hex(encode({text})))"


ORACLES = {
    "commit_envelopes": f"""WITH {BASE}
SELECT d.gno, count(c.k) AS n_rows, any_value(n_ddl) AS n_ddl, any_value(ended_by) AS ended_by
FROM done d LEFT JOIN c ON c.k = d.k AND {LISTED} GROUP BY d.gno""",
    "commit_shapes": f"""WITH {BASE}, x AS (SELECT d.k, ended_by, n_ddl, count(c.k) AS n FROM done d LEFT JOIN c USING (k) GROUP BY ALL)
SELECT ended_by, count(*) AS n_commits, count(*) FILTER (WHERE n = 0 AND n_ddl = 0) AS n_empty, sum(n)::BIGINT AS n_rows, sum(n_ddl)::BIGINT AS n_ddl FROM x GROUP BY ended_by""",
    "empty_commits": f"""WITH {BASE}
SELECT gno, ended_by FROM done WHERE n_ddl = 0 AND k NOT IN (SELECT k FROM c WHERE subject = 'shop.items')""",
    "include_filtered": f"""WITH {BASE}
SELECT subject, op, count(*) AS n_rows, min(pos) AS first_pos, max(pos) AS last_pos FROM c WHERE {LISTED} GROUP BY ALL""",
    "include_asof": f"""WITH {BASE}
SELECT d.gno, count(c.k) AS n_rows FROM done d LEFT JOIN c ON c.k = d.k AND CASE WHEN c.k <= 300 THEN subject = 'shop.items' WHEN c.k < 700 THEN {LISTED} ELSE c.k < 1100 END GROUP BY d.gno""",
    "ddl_classify": r"""WITH q AS (
  SELECT o_orderkey, ['BEGIN', '  begin ;', '/* note */ CREATE TABLE shop.t (a INT)', '-- line' || chr(10) || 'DROP TABLE shop.t', '# x' || chr(10) || '/*!50003 ALTER TABLE t ADD c INT */',
    '/* never ends CREATE TABLE x', 'COMMIT', 'XA START ''x''', 'CREATE TABLE shop.c (a INT) start  transaction;', 'Rollback;', 'SAVEPOINT s1', 'RENAME TABLE a TO b', 'GRANT ALL ON *.* TO u',
    '--not a comment', 'TRUNCATE shop.orders'][o_orderkey % 15 + 1] AS query FROM orders
), s AS (
  SELECT *, regexp_replace(query, '^(\s+|/\*![0-9]*|/\*([^*]|\*+[^*/])*\*+/|(#|-- |--\t)[^\n]*\n)*', '') AS rest FROM q
), t AS (
  SELECT *, CASE WHEN regexp_matches(rest, '^(/\*|#|-- |--\t)') THEN '' ELSE rest END AS start FROM s
), u AS (
  SELECT *, upper(rtrim(rtrim(rtrim(start), ';'))) AS text FROM t
)
SELECT o_orderkey, start, regexp_matches(text, '^(CREATE|ALTER|DROP|TRUNCATE|RENAME)') AS is_ddl,
  CASE WHEN text IN ('BEGIN', 'START TRANSACTION') OR text LIKE 'XA START%' OR text LIKE 'XA BEGIN%' THEN 'begin' WHEN text = 'COMMIT' THEN 'commit' WHEN text = 'ROLLBACK' THEN 'rollback'
       WHEN regexp_matches(text, '^(CREATE|ALTER|DROP|TRUNCATE|RENAME)') THEN 'ddl' ELSE 'other' END AS kind,
  regexp_matches(upper(query), '\sSTART\s+TRANSACTION;?$') AS opens
FROM u""",
    "row_events_full": f"""WITH {BASE}
SELECT gno, pos, {KIND} AS type, subject, '{{"gtid":"{UUID}:' || gno || '"}}' AS extensions_json, {DATA} AS data_json FROM c""",
    "row_events_signal": f"""WITH {BASE}
SELECT gno, pos, {KIND} AS type, subject, '{{"gtid":"{UUID}:' || gno || '"}}' AS extensions_json, '{{"op":"' || op || '","signal":true}}' AS data_json FROM c""",
    "row_event_json": f"""WITH {BASE}, x AS (
  SELECT *, md5('shop-1|{UUID}:' || gno || '|' || pos || '|0') AS h FROM c
), y AS (
  SELECT pos, gno, op, '{{"specversion":"1.0","id":"' || h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] || '","type":"' || {KIND} || '","source":"shop-1","subject":"'
    || subject || '","time":"2024-02-01T00:00:00.000Z"' AS head FROM x
)
SELECT pos, head || ',"gtid":"{UUID}:' || gno || '","data":{{"op":"' || op || '","signal":true}}}}' AS structured,
       head || ',"extensions":{{"gtid":"{UUID}:' || gno || '"}},"data":{{"op":"' || op || '","signal":true}}}}' AS nested FROM y""",
    "table_map_asof": f"""WITH {BASE}, x AS (
  SELECT *, k * 64 + 2 + rn AS pos, CASE WHEN subject = 'shop.items' AND k >= 200 THEN 'shop.items2' ELSE subject END AS mapped FROM l
)
SELECT mapped AS subject, count(*) AS n_rows, min(pos) AS first_pos, max(pos) AS last_pos FROM x WHERE mapped <> 'shop.returns' OR k >= 40 GROUP BY mapped""",
    "payload_unpack": f"""WITH {BASE}
SELECT d.gno, count(c.k) AS n_rows, any_value(n_ddl) AS n_ddl, any_value(ended_by) AS ended_by FROM done d LEFT JOIN c USING (k) GROUP BY d.gno""",
    "log_violations": f"""WITH {BASE}, gone AS (
  SELECT k, shape FROM o WHERE k % 200 IN (0, 31)
), prior AS (
  SELECT k, k = 0 OR (k - 1) % 50 NOT IN (19, 29, 37) AS outside FROM gone
), bad AS (
  SELECT 'row event without a transaction' AS error, k * 64 + 2 + rn AS pos FROM l JOIN prior USING (k) WHERE outside AND {LISTED}
  UNION ALL SELECT 'commit without a transaction', k * 64 + 62 FROM prior WHERE outside
  UNION ALL SELECT 'schema statement without a transaction', k * 64 + 1 FROM prior WHERE outside AND k % 200 = 31
)
SELECT error, count(*) AS n, min(pos) AS first_pos FROM bad GROUP BY error""",
    "gtid_islands": f"""WITH {BASE}, x AS (SELECT gno, gno - row_number() OVER (ORDER BY gno) AS g FROM done)
SELECT '{UUID}' AS uuid, min(gno) AS lo, max(gno) AS hi FROM x GROUP BY g""",
    "gtid_set_after": f"""WITH {BASE}, x AS (SELECT gno, gno - row_number() OVER (ORDER BY gno) AS g FROM done)
SELECT gno, dense_rank() OVER (ORDER BY g)::BIGINT AS n_intervals, min(gno) OVER (PARTITION BY g) AS lo, gno AS hi FROM x""",
    "gtid_union": """WITH x AS (
  SELECT 'u' || (o_orderkey % 3) AS uuid, 4 * o_orderkey + 1 AS lo, 4 * o_orderkey + 1 + o_orderkey % 23 AS hi FROM orders
), y AS (
  SELECT DISTINCT uuid, unnest(range(lo, hi + 1)) AS g FROM x
), z AS (
  SELECT uuid, g, g - row_number() OVER (PARTITION BY uuid ORDER BY g) AS island FROM y
)
SELECT uuid, min(g) AS lo, max(g) AS hi FROM z GROUP BY uuid, island""",
    "gtid_handshake": f"""WITH {BASE}, x AS (
  SELECT DISTINCT gno FROM (SELECT gno FROM done UNION ALL SELECT unnest(range(1, 39)))
), y AS (
  SELECT gno, gno - row_number() OVER (ORDER BY gno) AS g FROM x
), z AS (
  SELECT min(gno) AS lo, max(gno) AS hi FROM y GROUP BY g
)
SELECT '{UUID}' AS uuid, '{UUID}:' || string_agg(lo || '-' || hi, ':' ORDER BY lo) AS text FROM z UNION ALL SELECT 'other', 'other:5-5'""",
    "parts_by_rows": f"""WITH {BASE}, x AS (SELECT gno, (rn - 1) // 3 + 1 AS part, count(*) OVER (PARTITION BY gno) AS total FROM c), y AS (
  SELECT gno, part, count(*) AS n_rows, (any_value(total) + 2) // 3 AS n_parts FROM x GROUP BY gno, part
)
SELECT gno, part::INT AS part, n_rows, CASE WHEN n_parts > 1 THEN part::INT END AS part_number, CASE WHEN n_parts > 1 THEN part = n_parts END AS part_last FROM y""",
    "parts_by_bytes": f"""WITH RECURSIVE {BASE}, w AS (
  SELECT gno, rn, (2 + length(op) + CASE WHEN op <> 'insert' THEN 6 + image + 4 ELSE 0 END + CASE WHEN op <> 'delete' THEN 5 + image + length(q) ELSE 0 END)::BIGINT AS size
  FROM (SELECT *, CASE WHEN subject = 'shop.returns' THEN 20 ELSE 15 END + 24 AS image FROM c)
), f AS (
  SELECT gno, rn, 1 AS part, 1 AS r, size AS b, size FROM w WHERE rn = 1
  UNION ALL
  SELECT w.gno, w.rn, CASE WHEN f.r >= 4 OR f.b >= 300 THEN f.part + 1 ELSE f.part END, CASE WHEN f.r >= 4 OR f.b >= 300 THEN 1 ELSE f.r + 1 END,
         CASE WHEN f.r >= 4 OR f.b >= 300 THEN w.size ELSE f.b + w.size END, w.size
  FROM f JOIN w ON w.gno = f.gno AND w.rn = f.rn + 1
), g AS (
  SELECT gno, part, count(*) AS n_rows, sum(size)::BIGINT AS n_bytes FROM f GROUP BY gno, part
)
SELECT gno, part, max(part) OVER (PARTITION BY gno) AS n_parts, n_rows, n_bytes FROM g""",
    "part_rules": f"""WITH {BASE}, x AS (
  SELECT d.gno, d.n_ddl, d.k, count(c.k) AS total FROM done d LEFT JOIN c USING (k) GROUP BY ALL
), y AS (
  SELECT gno, n_ddl, total, greatest((total + 1) // 2, 1) AS n_parts, unnest(range(1, greatest((total + 1) // 2, 1) + 1)) AS part FROM x
), s AS (
  SELECT gno, dense_rank() OVER (ORDER BY g)::BIGINT AS n_intervals, min(gno) OVER (PARTITION BY g) AS lo FROM (SELECT gno, gno - row_number() OVER (ORDER BY gno) AS g FROM done)
)
SELECT gno, CASE WHEN n_parts > 1 THEN part::INT END AS part_number, CASE WHEN n_parts > 1 THEN part = n_parts END AS part_last,
       least(2, total - 2 * (part - 1))::BIGINT AS n_rows, CASE WHEN part = 1 THEN n_ddl ELSE 0 END AS n_ddl,
       CASE WHEN part = n_parts THEN n_intervals END AS after_n_intervals, CASE WHEN part = n_parts THEN lo END AS after_lo, CASE WHEN part = n_parts THEN gno END AS after_hi
FROM y JOIN s USING (gno)""",
    "row_fanout": f"""WITH {BASE}, x AS (
  SELECT k, 0 AS pos, 'org.logweave.log.ddl' AS type, 'shop' AS subject,
         CASE shape WHEN 7 THEN '{{"schema":"shop","query":"ALTER TABLE shop.orders ADD COLUMN c INT"}}' ELSE '{{"schema":"shop","query":"CREATE TABLE shop.copy (a INT) START TRANSACTION"}}' END AS data_json
  FROM done WHERE n_ddl = 1
  UNION ALL SELECT k, pos, {KIND}, subject, '{{"op":"' || op || '","signal":true}}' FROM c
)
SELECT k, (row_number() OVER (PARTITION BY k ORDER BY pos) - 1)::INT AS ordinal, type, subject, data_json FROM x""",
    "envelope_size": f"""WITH {BASE}, x AS (
  SELECT gno, op, CASE WHEN subject = 'shop.returns' THEN 20 ELSE 15 END + 24 AS image, q FROM c
)
SELECT gno, sum(2 + length(op) + CASE WHEN op <> 'insert' THEN 6 + image + 4 ELSE 0 END + CASE WHEN op <> 'delete' THEN 5 + image + length(q) ELSE 0 END)::BIGINT AS n_bytes, count(*) AS n_events
FROM x GROUP BY gno""",
    "full_envelopes": f"""WITH {BASE}, s AS (
  SELECT gno, dense_rank() OVER (ORDER BY g)::BIGINT AS n_intervals, min(gno) OVER (PARTITION BY g) AS lo FROM (SELECT gno, gno - row_number() OVER (ORDER BY gno) AS g FROM done)
)
SELECT d.gno, any_value(n_intervals) AS n_intervals, any_value(lo) AS lo, d.gno AS hi, any_value(n_ddl) AS n_ddl, count(c.k) AS n_events,
       CASE any_value(d.shape) WHEN 7 THEN 'ALTER TABLE shop.orders ADD COLUMN c INT' WHEN 31 THEN 'CREATE TABLE shop.copy (a INT) START TRANSACTION' ELSE '' END AS queries,
       coalesce(string_agg(subject, ',' ORDER BY pos), '') AS subjects
FROM done d JOIN s ON s.gno = d.gno LEFT JOIN c USING (k) GROUP BY d.gno""",
    "doc_effects": f"""WITH {_docs()}
SELECT pos, effect, CASE WHEN effect = 'row' THEN CASE op WHEN 'replace' THEN 'update' ELSE op END END AS row_op,
  CASE WHEN effect = 'filtered' THEN NULL WHEN op IN ('drop_database', 'invalidate') THEN 'app' ELSE 'app.' || coll END AS subject,
  CASE WHEN effect = 'row' THEN CASE WHEN op = 'delete' THEN '{{"op":"delete","before":' || doc_key ELSE '{{"op":"' || CASE op WHEN 'replace' THEN 'update' ELSE op END || '","after":' || doc END || '}}' END AS data_json,
  CASE WHEN effect = 'control' THEN CASE op WHEN 'drop' THEN 'dropped' WHEN 'rename' THEN 'renamed' WHEN 'drop_database' THEN 'database_dropped' ELSE 'invalidated' END END AS control,
  CASE WHEN effect = 'control' AND op = 'rename' THEN CASE WHEN e % 2 = 0 THEN 'app2' ELSE 'app' END END AS to_database,
  CASE WHEN effect = 'control' AND op = 'rename' THEN CASE WHEN e % 3 = 0 THEN 'moved' ELSE '' END END AS to_table
FROM eff""",
    "doc_effects_signal": f"""WITH {_docs("signal", False)}, x AS (SELECT effect, CASE WHEN effect = 'row' THEN CASE op WHEN 'replace' THEN 'update' ELSE op END END AS row_op FROM eff)
SELECT effect, row_op, '{{"op":"' || row_op || '","signal":true}}' AS data_json, count(*) AS n FROM x GROUP BY ALL""",
    "doc_runs": f"WITH {_docs()} SELECT run_start, max(pos) AS run_end, count(*) AS n_changes FROM run GROUP BY run_start",
    "doc_positions": f"""WITH {_docs()}
SELECT run_start, count(*) FILTER (WHERE effect = 'row') AS n_rows, count(*) FILTER (WHERE effect = 'control') AS n_controls, bool_or(effect = 'control') AS stop,
       {PLACE.replace("{f}", "min_by")} AS at_json, {PLACE.replace("{f}", "max_by")} AS after_json
FROM run GROUP BY run_start""",
    "doc_parts": f"""WITH {_docs()}, x AS (
  SELECT run_start, count(*) FILTER (WHERE effect = 'row') AS n_rows, max(pos) AS last_pos, max(pos) FILTER (WHERE effect = 'row') AS last_row FROM run GROUP BY run_start
)
SELECT run_start, n_rows, CASE WHEN n_rows = 0 THEN 1 ELSE n_rows // 2 + CASE WHEN n_rows % 2 = 1 OR last_pos > last_row THEN 1 ELSE 0 END END::INT AS n_parts FROM x""",
    "control_stop": f"""WITH {_docs()}, x AS (
  SELECT run_start, max(pos) AS run_end, count(*) FILTER (WHERE effect = 'row') AS n_rows, bool_or(effect = 'control') AS stop FROM run GROUP BY run_start
)
SELECT * FROM x WHERE run_start <= (SELECT min(run_start) FROM x WHERE stop)""",
    "token_times": """SELECT event_id AS pos, CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN epoch_us(ts) // 1000000 END AS t, CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN event_id END AS i FROM events""",
    "seed_and_tail": f"""WITH {_docs("full", False)}
SELECT 0 AS phase, 'app.customer' AS subject, c_custkey AS key, 'insert' AS op, c_name AS document, 1704200000::BIGINT AS t, 700::BIGINT AS i FROM customer
UNION ALL
SELECT 1, 'app.' || coll, pos, CASE op WHEN 'replace' THEN 'update' ELSE op END, doc, t, e FROM eff WHERE effect = 'row' AND (t > 1704200000 OR (t = 1704200000 AND e >= 700))""",
    "gate_report": """WITH g AS (
  SELECT 's' || n_nationkey AS source_id, n_nationkey AS k, i, ['binlog_format', 'binlog_row_image', 'binlog_row_metadata', 'gtid_mode', 'enforce_gtid_consistency'][i + 1] AS name
  FROM nation, range(5) r(i)
), v AS (
  SELECT *, CASE WHEN k % 7 = i THEN 'OFF' WHEN k % 11 <> i THEN CASE name WHEN 'gtid_mode' THEN 'on' WHEN 'enforce_gtid_consistency' THEN 'ON' WHEN 'binlog_format' THEN 'Row' ELSE 'FULL' END END AS value FROM g
)
SELECT source_id, name, CASE WHEN i = 4 THEN CASE WHEN value = 'ON' THEN 'ok' ELSE 'warning' END WHEN value IS NULL THEN 'missing'
  WHEN upper(value) = CASE name WHEN 'binlog_format' THEN 'ROW' WHEN 'gtid_mode' THEN 'ON' ELSE 'FULL' END THEN 'ok' ELSE 'wrong' END AS status
FROM v""",
    "lag_metrics": "SELECT event_type, count(*) AS n, min(1706745600000 - epoch_us(ts) // 1000) AS least_ms, max(1706745600000 - epoch_us(ts) // 1000) AS most_ms FROM events GROUP BY event_type",
    "health_samples": f"""WITH {BASE}, x AS (SELECT row_number() OVER (ORDER BY pos) AS n, gno, subject FROM c)
SELECT n, gno, subject FROM x WHERE n = 1 OR n % 100 = 0""",
    "typed_cells": r"""SELECT event_id, event_id::VARCHAR AS as_longlong, (1970 + event_id % 100)::VARCHAR AS as_year, (event_id % 2)::VARCHAR AS as_bit,
  CASE WHEN event_id % 7 = 0 THEN 'null' ELSE '"' || event_type || '\"\\\n"' END AS as_string,
  CASE WHEN event_id % 3 = 0 THEN '"hex:ff' || printf('%02x', event_id % 256) || '"' ELSE '"' || event_type || '"' END AS as_blob,
  '"' || (event_id // 4) || ['.00', '.25', '.50', '.75'][event_id % 4 + 1] || '"' AS as_decimal,
  '"' || strftime(DATE '2024-01-01' + (event_id % 500)::INT, '%Y-%m-%d') || '"' AS as_date, (event_id * 1000003)::VARCHAR AS as_timestamp FROM events""",
    "txn_keys": "SELECT event_id, CASE WHEN event_id % 5 <> 0 AND event_id % 3 <> 0 THEN 's' || user_id || ':' || event_id END AS txn_key FROM events",
    "control_events": f"""WITH {_docs("full", False)}, x AS (
  SELECT *, md5('docs-1|' || pos) AS h, CASE op WHEN 'drop' THEN 'dropped' WHEN 'rename' THEN 'renamed' WHEN 'drop_database' THEN 'database_dropped' ELSE 'invalidated' END AS kind,
         CASE WHEN op IN ('drop', 'rename') THEN coll ELSE '' END AS tbl
  FROM eff WHERE effect = 'control'
)
SELECT pos, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS id, 'org.logweave.log.control.' || kind AS type, CASE tbl WHEN '' THEN 'app' ELSE 'app.' || tbl END AS subject,
       '2024-02-01T00:00:00.000Z' AS time,
       '{{"kind":"' || kind || '","subject":{{"database":"app","table":"' || tbl || '"}}' || CASE WHEN op = 'rename' THEN ',"renamed_to":{{"database":"' || CASE WHEN e % 2 = 0 THEN 'app2' ELSE 'app' END
       || '","table":"' || CASE WHEN e % 3 = 0 THEN 'moved' ELSE '' END || '"}}' ELSE '' END || '}}' AS data_json
FROM x""",
    "doc_boundaries": f"""WITH {_docs()}, b AS (
  SELECT pos * 2 AS pos, op, txn, token, effect FROM eff
  UNION ALL SELECT pos * 2 + 1, 'boundary', NULL, CASE WHEN pos % 80 = 0 THEN token ELSE token || 'ff' END, 'filtered' FROM eff WHERE pos % 40 = 0
), p AS (
  SELECT *, lag(txn) OVER (ORDER BY pos) AS prev, lag(token) OVER (ORDER BY pos) AS before FROM b
), r AS (
  SELECT *, max(CASE WHEN txn IS NULL OR prev IS NULL OR prev <> txn THEN pos END) OVER (ORDER BY pos) AS run_start FROM p
)
SELECT run_start, max(pos) AS run_end, count(*) FILTER (WHERE effect = 'row') AS n_rows, count(*) FILTER (WHERE effect = 'control') AS n_controls, bool_or(effect = 'control') AS stop
FROM r WHERE op <> 'boundary' OR before IS NULL OR before <> token GROUP BY run_start""",
    "gtid_legacy": f"""WITH {BASE} SELECT '{UUID}' AS uuid, '{UUID}:1-' || greatest(max(gno), 25) AS text FROM done UNION ALL SELECT 'other', 'other:5-5'""",
    "derived_positions": f"""WITH {BASE}, x AS (SELECT gno, gno - row_number() OVER (ORDER BY gno) AS g FROM done), y AS (SELECT gno, min(gno) OVER (PARTITION BY g) AS lo FROM x)
SELECT gno, CASE WHEN gno % 5 = 0 THEN 'mongo' ELSE 'mysql' END AS adapter, CASE WHEN gno % 5 = 0 THEN '{{"a":1}}' ELSE '{{"gtid":"{UUID}:' || gno || '"}}' END AS at_json,
       CASE WHEN gno % 5 = 0 THEN '{{}}' ELSE '{{"gtid":"{UUID}:' || lo || '-' || gno || '"}}' END AS after_json FROM y""",
    "avro_events": f"""WITH {BASE}, x AS (
  SELECT *, md5('shop-1|{UUID}:' || gno || '|' || pos || '|0') AS h FROM c
), y AS (
  SELECT pos, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS id, {KIND} AS type, subject, '{{"gtid":"{UUID}:' || gno || '"}}' AS ext, '{{"op":"' || op || '","signal":true}}' AS data FROM x
)
SELECT pos, {" || ".join(_avro(t) for t in ("'1.0'", "id", "type", "'shop-1'", "subject", "'2024-02-01T00:00:00.000Z'", "ext", "data"))} AS datum FROM y""",
    "database_scope": "SELECT CASE o_orderkey % 3 WHEN 0 THEN 'shopping' WHEN 1 THEN 'shop' ELSE 'other' END || '.items' AS subject, o_orderkey % 3 = 1 AS inside, count(*) AS n FROM orders GROUP BY ALL",
    "pushed_changes": f"""WITH {_docs()}
SELECT op, count(*) AS n, min(pos) AS first_pos, max(pos) AS last_pos FROM raw
WHERE coll IN ('c0', 'c1', 'c2') OR op IN ('drop_database', 'invalidate') OR token = (SELECT token FROM raw WHERE pos = 291) GROUP BY op""",
}
