"""Event sequences as servers write them, through the stream's assembler and the batch plan."""

import pytest
from pyspark.sql import functions as F

from logweave.operators import assemble, parts
from logweave.streaming.assembler import Assembler, LogError, State

MAP = {"kind": "table_map", "table_id": 1, "database": "demo", "table": "orders", "columns": []}
NOISE = {"kind": "table_map", "table_id": 2, "database": "demo", "table": "noise", "columns": ["a"]}


def gtid(n):
    return {"kind": "gtid", "gtid": f"uuid:{n}", "uuid": "uuid", "gno": n}


def query(text):
    return {"kind": "query", "schema_name": "demo", "query": text}


def rows(n, table=1, first=0):
    return [{"kind": "rows", "table_id": table, "op": "insert", "after": [str(first + k + 1)]} for k in range(n)]


XID = {"kind": "xid"}


def run(events, **how):
    made = Assembler(**how)
    out = []
    for k, event in enumerate(events):
        out += [(k, c) for c in made.push(event | {"pos": k})]
    return out


def shape(commit):
    part = commit["part"]
    return len(commit["rows"]), len(commit["ddl"]), part and (part["number"], part["last"])


def test_ddl_alone_commits_at_once():
    [(at, commit)] = run([gtid(1), query("TRUNCATE TABLE demo.orders")])
    assert at == 1 and shape(commit) == (0, 1, None) and commit["gtid_set_after"] == "uuid:1-1"


def test_rows_and_statements():
    got = run([
        gtid(1), query("BEGIN"), MAP, *rows(2), XID, gtid(2), query("CREATE DATABASE d"), gtid(3), query("ALTER TABLE demo.orders ADD b INT"), gtid(4), query("BEGIN"), MAP, *rows(1), XID, gtid(5), query("DROP TABLE demo.orders"),
    ])
    assert [shape(c)[:2] for _, c in got] == [(2, 0), (0, 1), (0, 1), (1, 0), (0, 1)] and got[-1][1]["gtid_set_after"] == "uuid:1-5"


@pytest.mark.parametrize("begin", [True, False])
def test_create_table_as_select(begin):
    got = run([gtid(1), *([query("BEGIN")] if begin else []), query("CREATE TABLE demo.c (a INT) START TRANSACTION"), MAP, *rows(3), XID])
    assert [shape(c) for _, c in got] == [(3, 1, None)]


@pytest.mark.parametrize(("n", "limit", "want"), [
    (3, 3, [(3, 0, None)]), (4, 3, [(3, 0, (1, False)), (1, 0, (2, True))]), (7, 3, [(3, 0, (1, False)), (3, 0, (2, False)), (1, 0, (3, True))]),
])
def test_parts(n, limit, want):
    got = run([gtid(1), query("BEGIN"), MAP, *rows(n), XID], max_rows=limit)
    assert [shape(c) for _, c in got] == want
    assert [c["gtid_set_after"] for _, c in got] == [""] * (len(want) - 1) + ["uuid:1-1"]


def test_parts_by_bytes_and_statements_with_the_first():
    got = run([gtid(1), query("CREATE TABLE demo.c (a INT) START TRANSACTION"), MAP, *rows(5), XID], max_rows=2)
    assert [shape(c)[:2] for _, c in got] == [(2, 1), (2, 0), (1, 0)]
    # op and insert, after and col_0, and 8 for the number: 26 bytes a row
    got = run([gtid(1), query("BEGIN"), MAP, *rows(5), XID], max_bytes=50)
    assert [shape(c)[0] for _, c in got] == [2, 2, 1]


def test_rollbacks():
    with pytest.raises(LogError, match="uuid:1"):
        run([gtid(1), query("BEGIN"), MAP, *rows(4), query("ROLLBACK")], max_rows=3)
    got = run([gtid(1), query("BEGIN"), MAP, *rows(3), query("ROLLBACK"), gtid(2), query("DROP TABLE x")], max_rows=3)
    assert [c["gtid"] for _, c in got] == ["uuid:2"]
    got = run([gtid(1), query("BEGIN"), MAP, *rows(1), query("SAVEPOINT a"), *rows(1), query("ROLLBACK TO a"), XID])
    assert [shape(c) for _, c in got] == [(2, 0, None)]


def test_commit_grant_and_xa():
    assert [shape(c) for _, c in run([gtid(1), query("BEGIN"), MAP, *rows(2), query("COMMIT")])] == [(2, 0, None)]
    got = run([gtid(1), query("GRANT a"), gtid(2), query("ANALYZE TABLE t"), gtid(3), query("CREATE USER u")])
    assert [shape(c)[:2] for _, c in got] == [(0, 0), (0, 0), (0, 1)]
    got = run([gtid(1), query("XA START 'x'"), MAP, *rows(1), query("XA END 'x'"), gtid(2), query("XA COMMIT 'x'"), gtid(3), query("BEGIN"), MAP, *rows(1), XID])
    assert [(c["gtid"], shape(c)[0]) for _, c in got] == [("uuid:2", 0), ("uuid:3", 1)]


def test_sets_with_holes():
    events = []
    for n in range(6, 11):
        events += [gtid(n), query("BEGIN"), MAP, *rows(1), query("ROLLBACK") if n == 9 else XID]
    got = run(events, state=State(executed="uuid:1-5"))
    assert [c["gtid_set_after"] for _, c in got] == ["uuid:1-6", "uuid:1-7", "uuid:1-8", "uuid:1-8:10-10"]


def test_filters_are_pinned_and_errors_told():
    only = {"demo.orders"}
    made = Assembler(include=lambda: only)
    for event in (gtid(1), query("BEGIN"), MAP, NOISE):
        made.push(event | {"pos": 0})
    only = {"demo.noise"}
    for event in (*rows(1), *rows(1, 2)):
        made.push(event | {"pos": 0})
    assert [r["subject"] for r in made.push(XID | {"pos": 0})[0]["rows"]] == ["demo.orders"]
    with pytest.raises(LogError):
        made.push(XID | {"pos": 0})
    with pytest.raises(LogError):
        run([MAP, *rows(1)])
    assert run([*rows(1)]) == [] and run([query("COMMIT")]) == []
    with pytest.raises(LogError):
        run([gtid(1), {"kind": "payload", "payload": []}])


def test_payload_and_state_between_batches():
    inner = [MAP, *rows(2), XID]
    assert [shape(c) for _, c in run([gtid(1), query("BEGIN"), {"kind": "payload", "payload": inner}])] == [(2, 0, None)]
    made = Assembler(max_rows=2)
    out = []
    for event in [gtid(1), query("BEGIN"), MAP, *rows(5), XID]:
        out += made.push(event | {"pos": 0})
        made = Assembler(State.loads(made.state.dumps()), max_rows=2)
    assert [shape(c) for c in out] == [(2, 0, (1, False)), (2, 0, (2, False)), (1, 0, (3, True))]


LOG = "source_id string, pos long, inner_pos int, kind string, gtid string, uuid string, gno long, schema_name string, query string, table_id long, database string, table string, columns array<string>, op string, before array<string>, after array<string>"


def as_log(spark, events):
    names = [c.split()[0] for c in LOG.split(", ")]
    return spark.createDataFrame([tuple(({"source_id": "s", "pos": k, "inner_pos": 0} | e).get(n) for n in names) for k, e in enumerate(events)], LOG)


def test_batch_plan_gives_what_the_assembler_gives(spark):
    events = [
        gtid(1), query("BEGIN"), MAP, NOISE, *rows(2), *rows(1, 2), XID, gtid(2), query("GRANT x"), gtid(3), query("BEGIN"), *rows(1), query("ROLLBACK"), gtid(4), query("CREATE TABLE c (a INT) START TRANSACTION"), *rows(3), XID,
        gtid(5), query("XA START 'x'"), *rows(1), query("XA END 'x'"), gtid(6), query("DROP TABLE t"), gtid(7), query("BEGIN"), query("ALTER TABLE a"), query("SAVEPOINT b"), *rows(1, 2), query("COMMIT"), gtid(8), query("BEGIN"), *rows(1, 9), XID,
    ]
    for only in (None, frozenset({"demo.orders"}), frozenset()):
        want = [(int(c["gtid"][5:]), len(c["rows"]), len(c["ddl"])) for _, c in run(events, include=lambda only=only: only)]
        for width in (3, 1000):
            got = assemble.commits(as_log(spark, events), only, width=width).select("gno", "n_rows", "n_ddl").orderBy("gno").collect()
            assert [tuple(r) for r in got] == want


def test_violations(spark):
    events = [MAP, *rows(1), *rows(1, 2), gtid(1), query("BEGIN"), *rows(1), XID, *rows(1), query("DROP TABLE x"), XID, query("COMMIT")]
    got = assemble.violations(as_log(spark, events)).orderBy("pos").collect()
    assert [r["pos"] for r in got] == [1, 7, 8, 9]


def test_parts_in_batch(spark):
    df = spark.createDataFrame([(t, k, s) for t, sizes in ((1, [5, 5, 5, 50, 1]), (2, [60, 1])) for k, s in enumerate(sizes)], "t int, pos int, size int")
    got = parts.by_size(df, ["t"], ["pos"], "size", 3, 50).orderBy("t", "pos").select("t", "part", "n_parts").collect()
    assert [tuple(r) for r in got] == [(1, 1, 3), (1, 1, 3), (1, 1, 3), (1, 2, 3), (1, 3, 3), (2, 1, 2), (2, 2, 2)]
    cut = parts.part_columns(parts.by_rows(df, ["t"], ["pos"], 5)).where("t = 1").agg(F.count("part_number")).first()[0]
    assert cut == 0
