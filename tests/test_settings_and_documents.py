"""Include lists, gates, settings and document changes."""

import json

import pytest
from pyspark.sql import functions as F

from logweave import options
from logweave.operators import documents, envelopes, gates, ordered
from logweave.operators import include as inc


def test_include_list_algebra():
    new = inc.IncludeList()
    assert new.is_all and new.insert("a.b") and new.subjects() == ["a.b"]
    assert inc.IncludeList.from_tables([]).is_all and not inc.IncludeList.from_tables([]).insert("a.b")
    none = inc.IncludeList.from_subjects([])
    assert none.subjects() == [] and not none.is_all and none.insert("z.z") and none.insert("a.a") and none.subjects() == ["a.a", "z.z"]
    assert not none.insert("a.a") and none.remove("a.a") and not none.remove("a.a")
    none.replace([])
    assert none.snapshot() == frozenset()
    seeded = inc.IncludeList()
    seeded.seed_if_unset(["a.b"])
    seeded.seed_if_unset(["c.d"])
    assert seeded.subjects() == ["a.b"] and not seeded.in_effect_allows("a.b")
    seeded.set_in_effect(seeded.snapshot())
    assert seeded.in_effect_allows("a.b") and not seeded.in_effect_allows("x.y")
    seeded.clear_in_effect()
    assert seeded.in_effect() == (False, None)
    with pytest.raises(ValueError):
        inc.IncludeList.from_tables(["nodot"])


def test_covers():
    a, b = frozenset({"x.a"}), frozenset({"x.a", "x.b"})
    assert inc.covers(None, a) and inc.covers(b, a) and not inc.covers(a, b) and not inc.covers(a, None) and inc.covers(None, None)


def test_pushed_filter(spark):
    df = spark.createDataFrame([("a", "insert", "1"), ("b", "insert", "2"), (None, "invalidate", "3"), ("b", "drop", "4")], "c string, op string, p string")
    got = lambda only, resume: [r["p"] for r in df.where(inc.pushed(F.col("c"), F.col("op"), F.col("p"), only, "x", resume)).collect()]
    assert got(frozenset({"x.a", "y.b"}), None) == ["1", "3"] and got(frozenset(), "4") == ["3", "4"] and got(None, None) == ["1", "2", "3", "4"]


GOOD = {"binlog_format": "row", "binlog_row_image": "FULL", "binlog_row_metadata": "FULL", "gtid_mode": "ON", "enforce_gtid_consistency": "ON"}


def test_gates():
    assert gates.check_variables(GOOD).warnings == []
    assert "advised" in gates.check_variables(GOOD | {"enforce_gtid_consistency": "WARN"}).warnings[0]
    for bad in (GOOD | {"gtid_mode": "OFF"}, {k: v for k, v in GOOD.items() if k != "binlog_format"}):
        with pytest.raises(gates.GateError):
            gates.check_variables(bad)
    gates.check_topology({"setName": "rs0"})
    for hello in ({}, {"setName": ""}, {"msg": "isdbgrid", "setName": "x"}):
        with pytest.raises(gates.GateError):
            gates.check_topology(hello)
    gates.check_version("8.0.3-rc1"), gates.check_version("10.1")
    for old in ("7.0.2", "", "x.y"):
        with pytest.raises(gates.GateError):
            gates.check_version(old)
    assert gates.post_images_enabled({"options": {"changeStreamPreAndPostImages": {"enabled": True}}}) and not gates.post_images_enabled({"options": {}})
    allowed = lambda r, a: {"authInfo": {"authenticatedUsers": [1], "authenticatedUserPrivileges": [{"resource": r, "actions": a}]}}
    gates.check_privileges({}, "app"), gates.check_privileges(allowed({"db": "app"}, ["find", "changeStream"]), "app"), gates.check_privileges(allowed({"anyResource": True}, ["find", "changeStream"]), "app")
    for bad in (allowed({"db": "app"}, ["find"]), allowed({"db": "other"}, ["find", "changeStream"]), {"authInfo": {"authenticatedUsers": [1]}}):
        with pytest.raises(gates.GateError):
            gates.check_privileges(bad, "app")
    assert gates.oplog_window(5, 9) == 4 and gates.oplog_window(9, 5) == 0


MYSQL = {"source": {"adapter": "mysql", "source_id": "s", "host": "h", "port": 1, "user": "u@x", "password": "p/w", "server_id": 7, "include_tables": ["a.b"]}, "checkpoint": {"path": "c"}, "sink": {"kind": "stdout"}}


def changed(base, **how):
    out = json.loads(json.dumps(base))
    for key, value in how.items():
        section, _, name = key.partition("__")
        out[section][name] = value
    return out


def test_settings(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('[source]\nadapter = "mysql"\nsource_id = "s"\nhost = "h"\nport = 1\nuser = "u"\nserver_id = 1\ninclude_tables = ["a.b"]\npayload_mode = " Signal "\n[checkpoint]\npath = "c"\n[sink]\nkind = "http"\nurl = "http://x"\nformat = "AVRO"\n')
    read = options.load(path)
    assert (read.source.payload_mode, read.sink.format, read.source.part_max_rows, read.warnings) == ("signal", "avro", 10_000, [])
    assert options.connection_url(options.from_tables(MYSQL).source) == "mysql://u%40x:p%2Fw@h:1?ssl-mode=required"
    assert options.from_tables(changed(MYSQL, source__tls=False)).warnings
    wrong = [{"source__adapter": "x"}, {"source__include_tables": []}, {"source__include_tables": ["x"]}, {"source__source_id": " "}, {"source__part_max_rows": 0}, {"source__queue_capacity": 0}, {"source__delivery_unit": "x"},
             {"checkpoint__path": ""}, {"sink__kind": "x"}, {"sink__kind": "http"}, {"source__server_id": 0}, {"source__seed": True}, {"source__nothing": 1}]
    for how in wrong:
        with pytest.raises(options.ConfigError):
            options.from_tables(changed(MYSQL, **how))
    mongo = {"source": {"adapter": "mongo", "source_id": "s", "uri": "u", "database": "a", "include_tables": ["a.b"]}, "checkpoint": {"path": "c"}, "sink": {"kind": "stdout"}}
    options.from_tables(mongo)
    for how in ({"source__uri": ""}, {"source__include_tables": ["b.c"]}, {"source__full_document": "x"}):
        with pytest.raises(options.ConfigError):
            options.from_tables(changed(mongo, **how))


CHANGES = "source_id string, pos long, op string, database string, collection string, to_database string, to_collection string, document_key string, full_document string, txn_key string, resume_token string, cluster_time struct<t:long,i:long>"


def changes(spark, some):
    names = [x.split()[0] for x in CHANGES.split(", ")]
    rows = [tuple(({"source_id": "d", "pos": k, "database": "app", "collection": "orders", "document_key": '{"_id":1}', "full_document": '{"a":1}', "resume_token": f"t{k}", "cluster_time": (1, k)} | c).get(n) for n in names) for k, c in enumerate(some)]
    return spark.createDataFrame(rows, CHANGES)


def test_runs_boundaries_and_positions(spark):
    ins = {"op": "insert"}
    some = [ins | {"txn_key": "a"}, ins | {"txn_key": "a"}, ins | {"txn_key": "b"}, ins, ins, {"op": "boundary", "resume_token": "t4"}, {"op": "boundary", "resume_token": "82" + "00000005" + "00000006"}, ins | {"txn_key": "b"}]
    for width in (2, 1000):
        got = documents.commits(documents.effects(changes(spark, some)), width=width).orderBy("run_start").collect()
        assert [(r["run_start"], r["run_end"], r["n_rows"]) for r in got] == [(0, 1, 2), (2, 2, 1), (3, 3, 1), (4, 4, 1), (6, 6, 0), (7, 7, 1)]
        assert json.loads(got[0]["after_json"])["resume_token"] == "t1" and json.loads(got[4]["at_json"])["cluster_time"] == {"t": 5, "i": 6}


def test_effects_and_controls(spark):
    some = [{"op": "insert", "collection": "system.x"}, {"op": "delete", "collection": "system.x"}, {"op": "update", "full_document": None}, {"op": "delete", "document_key": None}, {"op": "drop", "collection": None},
            {"op": "rename", "to_collection": "b"}, {"op": "invalidate", "collection": None}, {"op": "other"}, {"op": "drop", "collection": "unlisted"}]
    done = documents.effects(changes(spark, some), only=frozenset({"app.orders", "app.system.x"}))
    got = done.orderBy("pos").collect()
    assert [r["effect"] for r in got] == ["filtered", "row", "filtered", "filtered", "filtered", "control", "control", "filtered", "filtered"]
    assert got[5]["control"].asDict() == {"kind": "renamed", "database": "app", "table": "orders", "to_database": "app", "to_table": "b"}
    assert [r["effect"] for r in documents.effects(changes(spark, some), "signal").orderBy("pos").collect()][2:4] == ["row", "row"]
    event = done.where("pos >= 5 and effect = 'control'").orderBy("pos").select(envelopes.control_event(F.col("control"), F.lit("d"), F.lit("1"), F.timestamp_millis(F.lit(0))).alias("e")).select("e.*").collect()
    assert (event[0]["type"], event[0]["subject"], event[1]["subject"]) == ("org.logweave.log.control.renamed", "app.orders", "app")
    assert json.loads(event[0]["data_json"])["renamed_to"] == {"database": "app", "table": "b"} and "renamed_to" not in json.loads(event[1]["data_json"])


def test_transaction_keys(spark):
    df = spark.createDataFrame([("s", 1), (None, 1), ("s", None)], "session_id string, txn_number long")
    assert [r[0] for r in df.select(documents.transaction_key()).collect()] == ["s:1", None, None]


def test_ordered_scans_equal_whole_windows(spark):
    rows = [(k % 2, k * 3, None if k % 3 else k) for k in range(60)]
    df = spark.createDataFrame(rows, "s int, pos long, v long")
    for width in (1, 10, 1000):
        got = ordered.carry_last(df, ["s"], ["pos"], F.col("v"), "last", width)
        got = ordered.running_sum(ordered.previous(got, ["s"], ["pos"], F.col("v"), "prev", width), ["s"], ["pos"], F.lit(1), "n", width)
        for s in (0, 1):
            last = prev = None
            for n, r in enumerate(got.where(F.col("s") == s).orderBy("pos").collect()):
                last = r["v"] if r["v"] is not None else last
                assert (r["last"], r["prev"] and r["prev"]["v"], r["n"]) == (last, prev, n + 1) and (r["prev"] is None) == (n == 0)
                prev = r["v"]
