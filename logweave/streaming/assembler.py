"""Commits from a stream of log events, one source at a time, with state between batches."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from logweave.functions.values import approx_bytes
from logweave.operators import positions
from logweave.operators.parts import MAX_BYTES, MAX_ROWS

LEADING = re.compile(r"(?:\s+|/\*![0-9]*|/\*.*?\*/|(?:#|-- |--\t)[^\n]*\n)*", re.DOTALL)
UNENDED = re.compile(r"/\*|#|-- |--\t")
DDL = re.compile(r"CREATE|ALTER|DROP|TRUNCATE|RENAME")
OPENS = re.compile(r"(?:^|\s)START\s+TRANSACTION\s*;*\s*$", re.IGNORECASE)


class LogError(Exception):
    """The log holds what can't be: no stream goes on after it."""


def query_kind(query: str) -> str:
    """As functions.statements.query_kind."""
    rest = query[LEADING.match(query).end() :]
    text = "" if UNENDED.match(rest) else re.sub(r"\s*;*\s*$", "", rest).upper()
    if text in ("BEGIN", "START TRANSACTION") or text.startswith(("XA START", "XA BEGIN")):
        return "begin"
    if text in ("COMMIT", "ROLLBACK"):
        return text.lower()
    return "ddl" if DDL.match(text) else "other"


@dataclass
class State:
    """What an assembler keeps between events; all of it is JSON."""

    executed: str = ""
    maps: dict[str, list] = field(default_factory=dict)
    gtid: str | None = None
    only: list[str] | None = None
    is_open: bool = False
    parts_sent: int = 0
    ddl: list[dict] = field(default_factory=list)
    ddl_at: list[list[int]] = field(default_factory=list)
    skips: bool = False
    rows: list[dict] = field(default_factory=list)
    size: int = 0

    def dumps(self) -> str:
        return json.dumps(self.__dict__, separators=(",", ":"))

    @classmethod
    def loads(cls, text: str | None) -> State:
        return cls(**json.loads(text)) if text else cls()


class Assembler:
    """Takes events in log order and gives commits, or parts of long ones, as soon as they are complete."""

    def __init__(self, state: State | None = None, include=None, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, mode: str = "full", done: str = ""):
        """done: the set that was delivered before; its transactions are read over."""
        self.state = state or State()
        self.done = positions.parse_set(done)
        self.include = include or (lambda: None)
        self.max_rows, self.max_bytes, self.mode = max_rows or MAX_ROWS, max_bytes or MAX_BYTES, mode
        self.warnings: list[str] = []

    def _clear(self) -> None:
        s = self.state
        s.gtid, s.is_open, s.parts_sent, s.ddl, s.ddl_at, s.rows, s.size, s.skips = None, False, 0, [], [], [], 0, False

    def _is_done(self, gtid: str) -> bool:
        uuid, _, number = gtid.rpartition(":")
        return any(low <= int(number) <= high for low, high in self.done.get(uuid, ()))

    def _deliver(self, last: bool) -> dict:
        s = self.state
        part = {"number": s.parts_sent + 1, "last": last} if s.parts_sent or not last else None
        after = ""
        if last:
            s.executed = after = positions.set_after(s.executed, s.gtid)
        out = {"gtid": s.gtid, "gtid_set_after": after, "ddl": s.ddl, "ddl_at": s.ddl_at, "rows": s.rows, "part": part}
        if last:
            self._clear()
        else:
            s.parts_sent, s.ddl, s.ddl_at, s.rows, s.size = s.parts_sent + 1, [], [], [], 0
        return out

    def push(self, event: dict) -> list[dict]:
        s, kind = self.state, event["kind"]
        if kind == "payload":
            if not event.get("payload"):
                raise LogError("a compressed payload holds no events")
            return [commit for k, inner in enumerate(event["payload"]) for commit in self.push(inner | {"pos": event["pos"], "inner_pos": k})]
        if kind == "gtid":
            if s.gtid is not None:
                self.warnings.append(f"{s.gtid} never ended and is dropped")
            self._clear()
            s.gtid = event["gtid"]
            s.skips = bool(self.done) and self._is_done(s.gtid)
            only = self.include()
            s.only = None if only is None else sorted(only)
        elif kind == "table_map":
            s.maps[str(event["table_id"])] = [event["database"], event["table"], list(event.get("columns") or ())]
        elif s.skips:
            return []
        elif kind == "rows":
            return self._row(event)
        elif kind == "xid":
            if s.gtid is None:
                raise LogError("a commit without a transaction")
            return [self._deliver(True)]
        elif kind == "query":
            return self._query(event)
        return []

    def _row(self, event: dict) -> list[dict]:
        s = self.state
        told = s.maps.get(str(event["table_id"]))
        if told is None:
            self.warnings.append(f"a row event of unknown table {event['table_id']} is skipped")
            return []
        subject = f"{told[0]}.{told[1]}"
        if s.only is not None and subject not in s.only:
            return []
        if s.gtid is None:
            raise LogError("a row event without a transaction")
        out = [self._deliver(False)] if len(s.rows) >= self.max_rows or (s.rows and s.size >= self.max_bytes) else []
        data: dict = {"op": event["op"]}
        if self.mode == "signal":
            data["signal"] = True
        else:
            for name, ops in (("before", ("update", "delete")), ("after", ("insert", "update"))):
                if event["op"] in ops:
                    cells = event.get(name) or []
                    names = [told[2][k] if k < len(told[2]) and told[2][k] is not None else f"col_{k}" for k in range(len(cells))]
                    data[name] = {n: json.loads(c) if c is not None else None for n, c in zip(names, cells, strict=True)}
        s.rows.append({"subject": subject, "op": event["op"], "pos": event["pos"], "inner_pos": event.get("inner_pos") or 0, "data": data})
        s.size += approx_bytes(data)
        return out

    def _query(self, event: dict) -> list[dict]:
        s, kind = self.state, query_kind(event["query"])
        if kind == "begin":
            s.is_open = True
        elif kind == "commit":
            return [self._deliver(True)] if s.gtid is not None else []
        elif kind == "rollback":
            if s.gtid is not None and s.parts_sent:
                raise LogError(f"{s.gtid} was rolled back after parts of it were delivered")
        elif kind == "ddl":
            if s.gtid is None:
                raise LogError("a schema statement without a transaction")
            s.ddl.append({"schema": event.get("schema_name") or "", "query": event["query"]})
            s.ddl_at.append([event["pos"], event.get("inner_pos") or 0])
            if not s.is_open:
                if OPENS.search(event["query"]):
                    s.is_open = True
                else:
                    return [self._deliver(True)]
        elif s.gtid is not None and not s.is_open:
            return [self._deliver(True)]
        return []
