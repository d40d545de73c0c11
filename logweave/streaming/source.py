"""A recorded log as a stream: JSON lines, one event each, in order of pos."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

SCHEMA = (
    "source_id string, pos long, inner_pos int, kind string, gtid string, uuid string, gno long, schema_name string, query string, table_id long, database string, table string, "
    "columns array<string>, op string, before array<string>, after array<string>"
)
NAMES = [part.strip().split(" ")[0] for part in SCHEMA.split(", ")]
#: The events inside a compressed payload: as they are, without a place of their own.
INNER = [(name, kind) for name, kind in (part.strip().split(" ", 1) for part in SCHEMA.split(", ")) if name not in ("source_id", "pos", "inner_pos")]
SCHEMA += ", payload array<struct<" + ", ".join(f"{name}: {kind}" for name, kind in INNER) + ">>"
CHANGES = (
    "source_id string, pos long, op string, database string, collection string, to_database string, to_collection string, document_key string, full_document string, txn_key string, "
    "resume_token string, t long, i long"
)
CHANGE_NAMES = [part.strip().split(" ")[0] for part in CHANGES.split(", ")]


class HistoryLost(Exception):
    """What should be read next is no longer kept."""


class RecordedLog(DataSource):
    """format("recorded_log"): options path, max_events (of a batch, 10,000), max_bytes (32 MiB) and start (a pos).

    A batch ends where a transaction begins, unless one alone is longer than a batch; it always has one event at least.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded_log"

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Reader(self.options)


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options) -> None:
        self.path = Path(options["path"])
        self.max_events = int(options.get("max_events", 10_000))
        self.max_bytes = int(options.get("max_bytes", 32 << 20))
        self.start = int(options.get("start", 0))

    def initialOffset(self) -> dict:
        return {"line": 0, "pos": self.start}

    def _lines(self, line: int, end: int | None = None):
        with self.path.open("rb") as file:
            file.seek(line)
            while end is None or file.tell() < end:
                at, text = file.tell(), file.readline()
                if not text.endswith(b"\n"):  # still being written
                    return
                yield at, file.tell(), json.loads(text)

    def _rows(self, events) -> list[tuple]:
        inside = lambda told: [tuple(event.get(name) for name, _ in INNER) for event in told] if told is not None else None
        return [(*(event.get(name) for name in NAMES), inside(event.get("payload"))) for event in events]

    def _begins(self, event: dict, before: dict) -> bool:
        """Whether a batch may end before this event."""
        return event["kind"] == "gtid"

    def read(self, start: dict):
        if start["line"] > (self.path.stat().st_size if self.path.exists() else 0):
            raise HistoryLost(f"{self.path} is shorter than what was read of it")
        held, size, end, cut = [], 0, start, None
        if self.path.exists():
            for at, after, event in self._lines(start["line"]):
                if event["pos"] < self.start:
                    end = {"line": after, "pos": event["pos"]}
                    continue
                if held and self._begins(event, held[-1]):
                    cut = (len(held), end)
                if held and (len(held) >= self.max_events or size + after - at > self.max_bytes):
                    break
                held.append(event)
                size += after - at
                end = {"line": after, "pos": event["pos"]}
            else:
                cut = None  # the log's end: all of it goes
        if cut is not None:
            held, end = held[: cut[0]], cut[1]
        return iter(self._rows(held)), end

    def readBetweenOffsets(self, start: dict, end: dict):
        return iter(self._rows(event for _, _, event in self._lines(start["line"], end["line"]) if event["pos"] >= self.start))

    def commit(self, end: dict) -> None:
        pass


class RecordedChanges(DataSource):
    """format("recorded_changes"): a recorded stream of document changes, options as for recorded_log.

    Changes have resume_token and cluster_time {t, i}. after and at, both JSON text, start after a resume token or at a
    cluster time, as a change stream does; a token that the log doesn't hold any more ends the stream.
    """

    @classmethod
    def name(cls) -> str:
        return "recorded_changes"

    def schema(self) -> str:
        return CHANGES

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _ChangeReader(self.options)


class _ChangeReader(_Reader):
    def __init__(self, options) -> None:
        super().__init__(options)
        after, at = (json.loads(options[name]) if options.get(name) else None for name in ("after", "at"))
        if after is not None and self.path.exists():
            found = [event["pos"] for _, _, event in self._lines(0) if event["resume_token"] == after]
            if not found:
                raise HistoryLost(f"{self.path} doesn't hold the change {after!r} any more")
            self.start = found[-1] + 1
        elif at is not None and self.path.exists():
            times = ((event["pos"], event.get("cluster_time") or {}) for _, _, event in self._lines(0))
            self.start = next((pos for pos, time in times if (time.get("t", 0), time.get("i", 0)) >= (at["t"], at["i"])), self.start)

    def _rows(self, events) -> list[tuple]:
        flat = ({**event, **(event.get("cluster_time") or {})} for event in events)
        return [tuple(event.get(name) for name in CHANGE_NAMES) for event in flat]

    def _begins(self, event: dict, before: dict) -> bool:
        return event.get("txn_key") is None or event["txn_key"] != before.get("txn_key")
