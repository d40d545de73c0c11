"""Sinks, checkpoints and the stream from a recorded log to them."""

import io
import json
import threading
import urllib.request

import pytest
from pyspark.sql import functions as F

from logweave.functions import avro
from logweave.operators.envelopes import FIELDS
from logweave.streaming import capture as c
from logweave.streaming import sinks
from logweave.streaming.source import HistoryLost, RecordedLog, _ChangeReader, _Reader
from mock_sink import MockSink

EVENT = {"specversion": "1.0", "id": "1", "type": "t", "source": "s", "subject": "d.t", "time": "2024-01-01T00:00:00.000Z", "extensions_json": '{"gtid":"u:1"}', "data_json": '{"op":"insert","after":{"é":1}}'}
COMMIT = {"gtid": "u:1", "gtid_set_after": "u:1-1", "ddl": [{"schema": "d", "query": "q"}], "events": [EVENT]}


def test_avro_round_trips_and_versions():
    assert avro.decode_event(avro.encode_event(EVENT)) == EVENT
    place = {"adapter": "mongo", "at": {"a": 1}, "after": {}}
    for extra, version in (({}, 1), ({"position": place}, 2), ({"control": [{"kind": "dropped"}], "position": place}, 2), ({"position": place, "part": {"number": 2, "last": False}}, 3)):
        commit = COMMIT | extra
        assert avro.commit_version(commit) == version and avro.commit_schema_id(commit).endswith(f"v{version}")
        assert avro.decode_commit(avro.encode_commit(commit), version) == commit
    part = COMMIT | {"part": {"number": 1, "last": True}, "position": {"adapter": "mysql", "at": {}, "after": {}}}
    assert "position" not in avro.decode_commit(avro.encode_commit(part), 3)
    assert avro.decode_commit(avro.encode_commit(COMMIT | {"control": [1]}), 2)["position"] == {"adapter": "mysql", "at": {}, "after": {}}


def test_avro_errors():
    with pytest.raises(avro.AvroError):
        avro.encode_commit(COMMIT | {"part": {"number": 2**31, "last": True}})
    with pytest.raises(avro.AvroError):
        avro.decode_commit(avro.encode_commit(COMMIT | {"part": {"number": -1, "last": True}}), 3)
    with pytest.raises(avro.AvroError):
        avro.decode_commit(avro.encode_commit(COMMIT), 2)
    for bad in (b"", b"\x02", avro.encode_event(EVENT) + b"\x00", b"\xff" * 12):
        with pytest.raises(avro.AvroError):
            avro.decode_event(bad)


def test_avro_columns(spark):
    df = spark.createDataFrame([tuple(EVENT[f] for f in FIELDS)], ",".join(f"{f} string" for f in FIELDS))
    got = df.select(avro.encoded_events(F.struct(*FIELDS)).alias("b")).select(avro.decoded_events(F.col("b")).alias("e")).select("e.*").first()
    assert got.asDict() == EVENT


def test_stdout():
    out = io.StringIO()
    sinks.StdoutSink("json", out).emit(EVENT)
    sinks.StdoutSink("avro", out).emit_commit(COMMIT)
    sinks.StdoutSink("json", out).emit_commit({"gtid": "u:1", "gtid_set_after": "u:1-1", "ddl": [], "events": []})
    lines = out.getvalue().splitlines()
    assert json.loads(lines[0])["extensions"] == {"gtid": "u:1"}
    assert lines[2] == '{"gtid":"u:1","gtid_set_after":"u:1-1","ddl":[],"events":[]}'


def test_http():
    with MockSink() as mock:
        plain, packed = sinks.HttpSink(mock.url, headers={"X-Own": "1"}), sinks.HttpSink(mock.url, "avro")
        plain.emit(EVENT), packed.emit(EVENT), plain.emit_commit(COMMIT), packed.emit_commit(COMMIT)
        headers, bodies = zip(*mock.received, strict=True)
        assert [h["Content-Type"] for h in headers] == ["application/cloudevents+json", avro.EVENT_TYPE, "application/json", avro.COMMIT_TYPE]
        assert json.loads(bodies[0])["gtid"] == "u:1" and headers[0]["X-Own"] == "1" and headers[3]["X-Avro-Schema"] == "logweave.commit.v1"
        assert avro.decode_commit(bodies[3], 1) == COMMIT
        assert json.loads(urllib.request.urlopen(mock.url).read())["count"] == 4
        mock.fail_after = 0
        with pytest.raises(sinks.SinkError, match="503") as caught:
            plain.emit(EVENT)
        assert len(str(caught.value)) < 300
    with pytest.raises(sinks.SinkError):
        sinks.HttpSink("ftp://x")


def test_checkpoints(tmp_path):
    store = sinks.CheckpointStore(tmp_path / "a" / "b.json")
    assert store.load() is None and sinks.start_position(None) is None
    store.save({"adapter": "mysql", "payload": {"baseline_gtid": "u:1-5"}})
    store.save(sinks.with_gtid(store.load(), "u:7-8"))
    assert store.load() == {"adapter": "mysql", "payload": {"baseline_gtid": "u:1-5", "gtid": "u:7-8"}}
    assert sinks.start_position(store.load(), "u:1-2") == "u:1-5:7-8"
    assert sinks.start_position({"adapter": "mongo", "payload": {"gtid": "u:1"}}) is None
    assert sinks.document_start({"adapter": "mongo", "payload": {"resume_token": {"_data": "x"}}}) == ("after", {"_data": "x"})
    assert sinks.document_start({"adapter": "mongo", "payload": {"resume_token": None, "seed_cluster_time": {"t": 1, "i": 2}}}) == ("at", {"t": 1, "i": 2})
    assert sinks.needs_seed(None) and not sinks.needs_seed({"adapter": "mongo", "payload": {"resume_token": "x"}})


def log_lines(n, rows=2, ends=True):
    out, pos = [], 0
    for k in range(1, n + 1):
        events = [{"kind": "gtid", "gtid": f"u:{k}", "uuid": "u", "gno": k}, {"kind": "query", "schema_name": "d", "query": "BEGIN"}, {"kind": "table_map", "table_id": 1, "database": "d", "table": "t", "columns": ["a"]}]
        events += [{"kind": "rows", "table_id": 1, "op": "insert", "after": [str(i)]} for i in range(rows)] + ([{"kind": "xid"}] if ends else [])
        for event in events:
            out.append(json.dumps({"source_id": "s", "pos": pos, "inner_pos": 0} | event))
            pos += 1
    return "".join(line + "\n" for line in out)


def test_reader_cuts_batches_at_transactions(tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text(log_lines(5) + '{"half": ')
    reader = _Reader({"path": str(path), "max_events": "8"})
    at, seen = reader.initialOffset(), []
    while True:
        rows, end = reader.read(at)
        rows = list(rows)
        if not rows:
            break
        assert rows == list(reader.readBetweenOffsets(at, end))
        assert rows[0][3] == "gtid" and rows[-1][3] == "xid"
        seen, at = seen + rows, end
    assert len(seen) == 30
    tiny = _Reader({"path": str(path), "max_events": "2"})
    assert [r[3] for r in tiny.read(tiny.initialOffset())[0]] == ["gtid", "query"]
    path.write_text("")
    with pytest.raises(HistoryLost):
        reader.read(at)


def run_capture(spark, path, delivery, at, **how):
    spark.dataSource.register(RecordedLog)
    log = spark.readStream.format("recorded_log").option("path", str(path)).option("max_events", "12").load()
    query = c.capture(log, delivery, str(at), **how)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_stream_delivers_in_order_and_redelivers_whole_transactions(spark, tmp_path):
    path, store = tmp_path / "log.jsonl", sinks.CheckpointStore(tmp_path / "own.json")
    path.write_text(log_lines(6, rows=3))
    seen = []

    def fails(event):
        if len(seen) == 7:
            raise RuntimeError("full")
        seen.append((json.loads(event["extensions_json"])["gtid"], json.loads(event["data_json"])["after"]["a"]))

    with pytest.raises(Exception, match="full"):
        run_capture(spark, path, c.Delivery(sinks.CallbackSink(fails), store), tmp_path / "stream")
    assert store.load()["payload"]["gtid"] == "u:1-2"
    before, seen[:] = len(seen), []
    run_capture(spark, path, c.Delivery(sinks.CallbackSink(lambda e: seen.append((json.loads(e["extensions_json"])["gtid"], json.loads(e["data_json"])["after"]["a"]))), store), tmp_path / "stream")
    assert before == 7 and store.load()["payload"]["gtid"] == "u:1-6"
    gtids = list(dict.fromkeys(g for g, _ in seen))
    assert gtids[-1] == "u:6" and seen == [(g, k) for g in gtids for k in range(3)] and "u:3" in gtids


def test_parts_don_t_move_the_checkpoint(spark, tmp_path):
    path, store = tmp_path / "log.jsonl", sinks.CheckpointStore(tmp_path / "own.json")
    path.write_text(log_lines(1, rows=5, ends=False))
    commits = []
    delivery = c.Delivery(sinks.CallbackSink(on_commit=commits.append), store, "transaction")
    run_capture(spark, path, delivery, tmp_path / "stream", max_rows=2)
    assert [x["part"] for x in commits] == [{"number": 1, "last": False}, {"number": 2, "last": False}] and store.load() is None
    with path.open("a") as file:
        file.write(json.dumps({"source_id": "s", "pos": 99, "inner_pos": 0, "kind": "xid"}) + "\n")
    run_capture(spark, path, delivery, tmp_path / "stream", max_rows=2)
    assert commits[-1]["part"] == {"number": 3, "last": True} and store.load()["payload"]["gtid"] == "u:1-1"


def test_max_events_and_health(tmp_path):
    told, store = [], sinks.CheckpointStore(tmp_path / "own.json")
    delivery = c.Delivery(sinks.CallbackSink(), store, max_events=3, on_health=told.append, clock=lambda: "2024-01-01T00:00:00.000Z")
    commit = {"gtid": "u:1", "gtid_set_after": "u:1-1", "ddl": [], "rows": [{"subject": "d.t", "op": "insert", "data": {}}] * 2, "part": None}
    delivery.deliver("s", commit)
    with pytest.raises(c.StopCapture):
        delivery.deliver("s", commit | {"gtid": "u:2", "gtid_set_after": "u:1-2"})
    assert store.load()["payload"]["gtid"] == "u:1-1" and told[0]["count"] == 1 and told[0]["lag_ms"] > 0
    assert c.lag_ms("no time") == -1 and c.lag_ms("2024-01-01T00:00:00.000Z", 1704067201.5) == 1500
    with pytest.raises(ValueError):
        c.Delivery(sinks.CallbackSink(), unit="batch")


def test_mock_sink_counts_from_several_threads():
    with MockSink(delay_ms=1) as mock:
        some = [threading.Thread(target=sinks.HttpSink(mock.url).emit, args=(EVENT,)) for _ in range(8)]
        [t.start() for t in some], [t.join() for t in some]
        assert len(mock.received) == 8


def test_compressed_payloads_through_the_reader(spark, tmp_path):
    path, plain = tmp_path / "log.jsonl", tmp_path / "plain.jsonl"
    inner = [{"kind": "query", "schema_name": "d", "query": "BEGIN"}, {"kind": "table_map", "table_id": 1, "database": "d", "table": "t", "columns": ["a"]}]
    inner += [{"kind": "rows", "table_id": 1, "op": "insert", "after": [str(i)]} for i in range(3)] + [{"kind": "xid"}]
    events = [{"kind": "gtid", "gtid": "u:1", "uuid": "u", "gno": 1}, {"kind": "payload", "payload": inner}]
    path.write_text("".join(json.dumps({"source_id": "s", "pos": k, "inner_pos": 0} | e) + "\n" for k, e in enumerate(events)))
    seen, store = [], sinks.CheckpointStore(tmp_path / "own.json")
    run_capture(spark, path, c.Delivery(sinks.CallbackSink(seen.append), store), tmp_path / "stream")
    assert [json.loads(e["data_json"])["after"]["a"] for e in seen] == [0, 1, 2] and store.load()["payload"]["gtid"] == "u:1-1"
    # the batch operators give the same ids
    from logweave.operators import assemble, envelopes

    spark.dataSource.register(RecordedLog)
    plain.write_text(path.read_text())
    rows = list(_Reader({"path": str(plain)}).read({"line": 0, "pos": 0})[0])
    from logweave.streaming.source import SCHEMA

    log = assemble.marked(assemble.unpack(spark.createDataFrame(rows, SCHEMA)))
    done = envelopes.row_events(assemble.committed_rows(log, assemble.endings(log)), F.current_timestamp()).orderBy("inner_pos")
    assert [r["id"] for r in done.select("event.id").collect()] == [e["id"] for e in seen]


def test_a_new_stream_goes_on_from_the_own_checkpoint(spark, tmp_path):
    path, store = tmp_path / "log.jsonl", sinks.CheckpointStore(tmp_path / "own.json")
    path.write_text(log_lines(4, rows=1))
    store.save({"adapter": "mysql", "payload": {"baseline_gtid": "v:1-3", "gtid": "u:1-2"}})
    seen = []
    run_capture(spark, path, c.Delivery(sinks.CallbackSink(seen.append), store), tmp_path / "stream")
    assert [json.loads(e["extensions_json"])["gtid"] for e in seen] == ["u:3", "u:4"]
    assert store.load()["payload"] == {"baseline_gtid": "v:1-3", "gtid": "u:1-4,v:1-3"}


def options(tmp_path, adapter="mysql", url="http://127.0.0.1:1", **source):
    from logweave import options as o

    known = {"mysql": {"host": "h", "port": 1, "user": "u", "server_id": 1}, "mongo": {"uri": "m", "database": "d"}}[adapter]
    return o.from_tables({"source": {"adapter": adapter, "source_id": "s", "include_tables": ["d.t"], **known, **source}, "checkpoint": {"path": str(tmp_path / "own.json")}, "sink": {"kind": "http", "url": url}})


def test_a_capture_from_its_options_with_a_live_list(spark, tmp_path):
    path, listed = tmp_path / "log.jsonl", tmp_path / "list.json"
    path.write_text(log_lines(2, rows=2))
    with MockSink() as mock:
        told = options(tmp_path, url=mock.url, payload_mode="signal")
        query = c.run(spark, told, str(path), str(tmp_path / "stream"), str(listed), executed="w:1-9")
        query.processAllAvailable()
        assert len(mock.received) == 4 and json.loads(mock.received[0][1])["data"] == {"op": "insert", "signal": True}
        listed.write_text('["d.other"]')
        with path.open("a") as file:
            file.write("".join(json.dumps(json.loads(line) | {"pos": 100 + k} | ({"gtid": "u:3"} if k == 0 else {})) + "\n" for k, line in enumerate(log_lines(1).splitlines())))
        query.processAllAvailable()
        query.stop()
        assert len(mock.received) == 4
    assert sinks.CheckpointStore(tmp_path / "own.json").load()["payload"] == {"baseline_gtid": "w:1-9", "gtid": "u:1-3,w:1-9"}


def change(k, op="insert", **more):
    return {"source_id": "s", "pos": k, "op": op, "database": "d", "collection": "t", "document_key": json.dumps({"_id": k}), "full_document": json.dumps({"_id": k, "é": [k]}), "resume_token": f"82{k:08x}{k:08x}", "cluster_time": {"t": k, "i": k}} | more


def test_document_capture_resumes_and_stops_on_control(spark, tmp_path):
    path, store = tmp_path / "changes.jsonl", sinks.CheckpointStore(tmp_path / "own.json")
    some = [change(1), change(2, txn_key="x:1"), change(3, "delete", txn_key="x:1"), change(4, collection="unlisted"), change(5, "replace")]
    path.write_text("".join(json.dumps(e) + "\n" for e in some))
    with MockSink() as mock:
        told = options(tmp_path, "mongo", mock.url, delivery_unit="transaction")
        query = c.run(spark, told, str(path), str(tmp_path / "one"))
        query.processAllAvailable()
        query.stop()
        commits = [json.loads(body) for _, body in mock.received]
        assert [len(x["events"]) for x in commits] == [1, 2, 0, 1] and store.load()["payload"]["resume_token"] == "820000000500000005"
        assert commits[1]["position"]["at"]["cluster_time"] == {"t": 2, "i": 2} and json.loads(json.dumps(commits[3]["events"][0]["data"])) == {"op": "update", "after": {"_id": 5, "é": [5]}}
        with path.open("a") as file:
            file.write("".join(json.dumps(e) + "\n" for e in [change(6), change(7, "drop"), change(8)]))
        query = c.run(spark, told, str(path), str(tmp_path / "two"))  # without Spark's own checkpoint
        with pytest.raises(Exception, match="control event"):
            query.processAllAvailable()
        commits = [json.loads(body) for _, body in mock.received][4:]
        assert [len(x["events"]) for x in commits] == [1, 0] and commits[1]["control"][0]["kind"] == "dropped"
        assert store.load()["payload"]["resume_token"] == "820000000700000007"
    path.write_text(json.dumps(change(9)) + "\n")
    with pytest.raises(HistoryLost):
        _ChangeReader({"path": str(path), "after": json.dumps("820000000700000007")})
    store.save({"adapter": "mongo", "payload": {"seed_cluster_time": {"t": 9, "i": 0}}})
    assert _ChangeReader({"path": str(path), "at": json.dumps({"t": 9, "i": 0})}).start == 9


def test_a_kept_connection_that_was_closed_is_opened_again():
    with MockSink() as mock:
        sink = sinks.HttpSink(mock.url)
        sink.emit(EVENT)
        sink.held.sock.shutdown(2)
        sink.emit(EVENT)
        assert len(mock.received) == 2
