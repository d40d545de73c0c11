"""A capture: a stream of log events in, events or commits out, the checkpoint last."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from datetime import UTC, datetime
from functools import partial

from pyspark.sql import DataFrame

from logweave.operators.envelopes import TYPE_PREFIX
from logweave.operators.include import ListFile
from logweave.options import Options
from logweave.streaming.assembler import Assembler, State
from logweave.streaming.grouper import Grouper
from logweave.streaming.sinks import CheckpointStore, Sink, document_start, make_sink, start_position, with_baseline, with_gtid, with_place
from logweave.streaming.source import RecordedChanges, RecordedLog

#: Log events that a batch may read for each place of the queue.
EVENTS_A_PLACE = 256

OUT = "source_id string, seq long, commit string"
STATE = "state string, n long"


class StopCapture(Exception):
    """Ends a capture on purpose, before the checkpoint of what it came with."""


def _clean(event: dict) -> dict:
    """An event of a pandas row as it was in the log: lists for arrays, numbers and None for NaN."""
    out = {}
    for name, value in event.items():
        value = value.tolist() if hasattr(value, "tolist") and not isinstance(value, str) else value
        out[name] = None if isinstance(value, float) and value != value else value
    if out.get("table_id") is not None:
        out["table_id"] = int(out["table_id"])
    if out.get("payload") is not None:
        out["payload"] = [_clean(inner if isinstance(inner, dict) else inner.asDict()) for inner in out["payload"]]
    return out


def assembled(log: DataFrame, subjects: list[str] | None = None, executed: str = "", max_rows: int = 0, max_bytes: int = 0, mode: str = "full", list_path: str | None = None) -> DataFrame:
    """Commits as JSON text (source_id, seq, commit) of a stream of log events.

    State is one open transaction for each source, bounded by the part limits, and its executed set. Events of a
    batch come in any order, so they are sorted by position first. executed: the set that was delivered before this
    stream began; its transactions are read over. The include list is asked for where a transaction begins: subjects,
    or what the file at list_path says by then.
    """
    include = ListFile(list_path, subjects) if list_path else partial(frozenset, subjects) if subjects is not None else None

    def run(key, frames, state):
        import pandas as pd

        held, n = state.get if state.exists else (None, 0)
        assembler = Assembler(State.loads(held) if held else State(executed=executed), include, max_rows, max_bytes, mode, executed)
        events = pd.concat(list(frames)).sort_values(["pos", "inner_pos"]).to_dict("records")
        out = []
        for event in events:
            out += assembler.push(_clean({k: v for k, v in event.items() if k != "source_id"}))
        state.update((assembler.state.dumps(), n + len(out)))
        yield pd.DataFrame({"source_id": [key[0]] * len(out), "seq": range(n, n + len(out)), "commit": [json.dumps(c) for c in out]})

    return log.groupBy("source_id").applyInPandasWithState(run, OUT, STATE, "append", "NoTimeout")


def grouped(changes: DataFrame, subjects: list[str] | None = None, max_rows: int = 0, max_bytes: int = 0, mode: str = "full", list_path: str | None = None, seed_time: dict | None = None) -> DataFrame:
    """Commits as JSON text (source_id, seq, commit) of a stream of document changes (source.CHANGES); as assembled.

    State is one open transaction for each source. A change of op boundary is an empty batch.
    """
    include = ListFile(list_path, subjects) if list_path else partial(frozenset, subjects) if subjects is not None else None

    def run(key, frames, state):
        import pandas as pd

        held, n = state.get if state.exists else (None, 0)
        grouper = Grouper(include, max_rows, max_bytes, mode, seed_time)
        if held:
            grouper.restore(held)
        out = []
        for event in pd.concat(list(frames)).sort_values("pos").to_dict("records"):
            change = _clean(event)
            if change["op"] == "boundary":
                out += grouper.boundary(change["resume_token"])
                continue
            time_ = None if change["t"] is None else {"t": int(change["t"]), "i": int(change["i"])}
            images = {name: json.loads(change[name]) if change[name] is not None else None for name in ("document_key", "full_document")}
            out += grouper.push(change | images | {"cluster_time": time_})
        state.update((grouper.dumps(), n + len(out)))
        yield pd.DataFrame({"source_id": [key[0]] * len(out), "seq": range(n, n + len(out)), "commit": [json.dumps(c) for c in out]})

    return changes.groupBy("source_id").applyInPandasWithState(run, OUT, STATE, "append", "NoTimeout")


def now_text() -> str:
    return datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")


def event_id(*parts) -> str:
    """As operators.envelopes.event_id."""
    digest = hashlib.md5("|".join("-" if part is None else str(part) for part in parts).encode(), usedforsecurity=False).hexdigest()
    return "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:]))


def events_of(commit: dict, source_id: str, clock: Callable[[], str] = now_text, prefix: str = TYPE_PREFIX) -> list[dict]:
    """The events of an assembled or grouped commit: schema statements first, then rows, then control events.

    Ids are those that the batch operators give: of the source, the transaction and the place in the log, whatever the
    part limits. A grouped commit's are of its position and the event's number in all its parts.
    """
    kinds = {"insert": "row.inserted", "update": "row.updated", "delete": "row.deleted"}
    to_text = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    place = commit.get("position")
    if place is None:
        extensions = {"gtid": commit["gtid"]} | ({"gtidset": commit["gtid_set_after"]} if commit["gtid_set_after"] else {})
        ids = [(commit["gtid"], *at) for at in commit.get("ddl_at") or [(None, k) for k in range(len(commit["ddl"]))]]
        ids += [(commit["gtid"], r.get("pos"), r.get("inner_pos", 0) if "pos" in r else k) for k, r in enumerate(commit["rows"])]
    else:
        extensions, number = {}, (commit.get("part") or {}).get("number", 1)
        ids = [(to_text(place["at"]), number, k) for k in range(len(commit["rows"]) + len(commit["control"]))]
    made = [("ddl", d["schema"], d) for d in commit.get("ddl") or []] + [(kinds[r["op"]], r["subject"], r["data"]) for r in commit["rows"]]
    for control in commit.get("control") or []:
        about = control["subject"]
        made.append((f"control.{control['kind']}", f"{about['database']}.{about['table']}" if about["table"] else about["database"], control))
    return [
        {"specversion": "1.0", "id": event_id(source_id, *own), "type": f"{prefix}.{kind}", "source": source_id, "subject": subject, "time": clock(), "extensions_json": to_text(extensions), "data_json": to_text(data)}
        for own, (kind, subject, data) in zip(ids, made, strict=True)
    ]


def lag_ms(event_time: str, now: float | None = None) -> int:
    """Milliseconds since an event's time; -1 if it can't be read."""
    try:
        then = datetime.fromisoformat(event_time)
    except ValueError:
        return -1
    if then.tzinfo is None:
        return -1
    return int((time.time() if now is None else now) * 1000 - then.timestamp() * 1000)


class Delivery:
    """foreachBatch target: commits in order, each acknowledged by the sink before the checkpoint moves.

    unit row: each event alone; transaction: each commit or part. The checkpoint moves after the whole of a
    transaction, also for one without events, and never after a part that isn't the last. Delivery is at least once:
    after a failure Spark gives the batch again, from its first commit.
    """

    def __init__(self, sink: Sink, store: CheckpointStore | None = None, unit: str = "row", max_events: int = 0, clock: Callable[[], str] = now_text, on_health: Callable[[dict], None] | None = None):
        if unit not in ("row", "transaction"):
            raise ValueError(f"delivery unit {unit!r} is neither row nor transaction")
        self.sink, self.store, self.unit, self.max_events, self.clock, self.on_health = sink, store, unit, max_events, clock, on_health
        self.n = 0
        self.held: dict | None = None

    def _count(self, gtid: str, subject: str, event_time: str) -> None:
        self.n += 1
        if self.on_health and (self.n == 1 or self.n % 100 == 0):
            self.on_health({"count": self.n, "gtid": gtid, "subject": subject, "lag_ms": lag_ms(event_time)})
        if self.max_events and self.n >= self.max_events:
            raise StopCapture(f"reached max_events={self.max_events}")

    def deliver(self, source_id: str, commit: dict) -> None:
        events, place = events_of(commit, source_id, self.clock), commit.get("position")
        name = commit["gtid"] if place is None else ""
        if self.unit == "row":
            for event in events:
                self.sink.emit(event)
                self._count(name, event["subject"], event["time"])
        else:
            rows = [e for e in events if ".row." in e["type"]]
            told = {k: commit[k] for k in ("gtid", "gtid_set_after", "ddl", "part")} if place is None else {"gtid": "", "gtid_set_after": "", "ddl": [], **{k: commit[k] for k in ("position", "control", "part")}}
            self.sink.emit_commit(told | {"events": rows})
            self._count(name, events[-1]["subject"] if events else "", events[-1]["time"] if events else self.clock())
        if commit["part"] is None or commit["part"]["last"]:
            self._checkpoint(commit)
            if commit.get("stop"):
                raise StopCapture(f"a control event ends the stream: {commit['control'][0]['kind']}")

    def _checkpoint(self, commit: dict) -> None:
        if self.store is None:
            return
        held = self.held if self.held is not None else self.store.load()
        if commit.get("position") is not None:
            self.held = with_place(held, commit["position"]["after"])
        elif commit["gtid_set_after"]:
            self.held = with_gtid(held, commit["gtid_set_after"])
        else:
            return
        self.store.save(self.held)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        # a global sort would run the batch once more to sample its ranges; what the reader hands on is bounded
        for row in batch.repartition(1).sortWithinPartitions("source_id", "seq").toLocalIterator():
            self.deliver(row["source_id"], json.loads(row["commit"]))


def capture(log: DataFrame, delivery: Delivery, checkpoint: str, **how):
    """Starts a capture of a stream of log events; how: as for assembled. Returns the running query.

    What the delivery's own checkpoint holds was delivered: a stream whose Spark checkpoint is new reads over it, and
    the set that it saves goes on from there.
    """
    if delivery.store is not None and "executed" not in how:
        how["executed"] = start_position(delivery.store.load()) or ""
    return assembled(log, **how).writeStream.foreachBatch(delivery).option("checkpointLocation", checkpoint).start()


def document_capture(changes: DataFrame, delivery: Delivery, checkpoint: str, **how):
    """Starts a capture of a stream of document changes; how: as for grouped. A control event ends it, checkpointed."""
    return grouped(changes, **how).writeStream.foreachBatch(delivery).option("checkpointLocation", checkpoint).start()


def run(spark, options: Options, log_path: str, checkpoint: str, list_path: str | None = None, executed: str = "", **delivery):
    """Starts the capture that options tell of, from a recorded log. Returns the running query.

    The sink, the payload mode, the delivery unit, the part limits and the include list are the options'; the queue
    limits bound what a batch reads. A first capture of a log stores the server's executed set as its baseline. A
    document stream goes on after its checkpoint's token, or at the time of its seed. list_path: as for assembled.
    """
    source, store = options.source, CheckpointStore(options.checkpoint_path)
    target = Delivery(make_sink(options.sink.kind, options.sink.url, options.sink.format), store, source.delivery_unit, **delivery)
    how = {"subjects": source.include_tables, "max_rows": source.part_max_rows, "max_bytes": source.part_max_bytes, "mode": source.payload_mode, "list_path": list_path}
    kind = RecordedLog if source.adapter == "mysql" else RecordedChanges
    spark.dataSource.register(kind)
    reader = spark.readStream.format(kind.name()).option("path", log_path).option("max_bytes", source.queue_max_bytes).option("max_events", source.queue_capacity * EVENTS_A_PLACE)
    if source.adapter == "mysql":
        if start_position(store.load()) is None and executed:
            store.save(with_baseline(store.load(), executed))
        return capture(reader.load(), target, checkpoint, executed=start_position(store.load()) or executed, **how)
    where, value = document_start(store.load())
    if where != "now":
        reader = reader.option(where, json.dumps(value))
    seed = (store.load() or {}).get("payload", {}).get("seed_cluster_time")
    return document_capture(reader.load(), target, checkpoint, seed_time=seed, **how)
