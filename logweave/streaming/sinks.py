"""Where events and commits go, and the checkpoint that follows them."""

from __future__ import annotations

import base64
import json
import http.client
import os
import sys
from collections.abc import Callable
from pathlib import Path
from typing import Protocol
from urllib.parse import urlsplit

from logweave.functions import avro


class SinkError(Exception):
    """A sink didn't take what it was given."""


def structured(event: dict) -> dict:
    """An event as it is posted: its attributes, its extensions beside them, then its data."""
    out = {name: event[name] for name in avro.EVENT_FIELDS[:6]}
    return out | json.loads(event["extensions_json"]) | {"data": json.loads(event["data_json"])}


def nested(event: dict) -> dict:
    """An event as it is printed: extensions stay an object, left out when empty."""
    out = {name: event[name] for name in avro.EVENT_FIELDS[:6]}
    extensions = json.loads(event["extensions_json"])
    return out | ({"extensions": extensions} if extensions else {}) | {"data": json.loads(event["data_json"])}


def commit_json(commit: dict) -> dict:
    """A commit's record; position, control and part are left out when there are none."""
    out = {"gtid": commit["gtid"], "gtid_set_after": commit["gtid_set_after"], "ddl": commit.get("ddl") or [], "events": [nested(e) for e in commit.get("events") or []]}
    return out | {name: commit[name] for name in ("position", "control", "part") if commit.get(name)}


def to_json(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


class Sink(Protocol):
    def emit(self, event: dict) -> None: ...

    def emit_commit(self, commit: dict) -> None: ...


class StdoutSink:
    def __init__(self, form: str = "json", out=None):
        self.form, self.out = form, out

    def _line(self, text: str) -> None:
        print(text, file=self.out or sys.stdout, flush=True)

    def emit(self, event: dict) -> None:
        self._line(to_json(nested(event)) if self.form == "json" else base64.b64encode(avro.encode_event(event)).decode())

    def emit_commit(self, commit: dict) -> None:
        self._line(to_json(commit_json(commit)) if self.form == "json" else base64.b64encode(avro.encode_commit(commit)).decode())


class HttpSink:
    """Posts to an address, one request after another over one connection, which is opened anew once it was closed."""

    def __init__(self, url: str, form: str = "json", headers: dict[str, str] | None = None, timeout: float = 30):
        if not url.startswith(("http://", "https://")):
            raise SinkError(f"{url!r} is neither http nor https")
        self.url, self.form, self.headers, self.timeout = url, form, dict(headers or {}), timeout
        self.held: http.client.HTTPConnection | None = None

    def _post(self, body: bytes, headers: dict[str, str]) -> None:
        place = urlsplit(self.url)
        kept = self.held is not None
        try:
            if self.held is None:
                kind = http.client.HTTPSConnection if place.scheme == "https" else http.client.HTTPConnection
                self.held = kind(place.netloc, timeout=self.timeout)
            self.held.request("POST", (place.path or "/") + (f"?{place.query}" if place.query else ""), body, headers | self.headers)
            answer = self.held.getresponse()
            told = answer.read()
        except (OSError, http.client.HTTPException) as error:
            self.close()
            if kept and isinstance(error, (http.client.RemoteDisconnected, ConnectionError)):
                return self._post(body, headers)  # the other side had closed the connection meanwhile
            raise SinkError(f"{self.url}: {error}") from None
        if not 200 <= answer.status < 300:
            raise SinkError(f"{self.url} answered {answer.status}: {told[:200].decode('utf-8', 'replace')}")

    def close(self) -> None:
        if self.held is not None:
            self.held.close()
            self.held = None

    def emit(self, event: dict) -> None:
        if self.form == "json":
            self._post(to_json(structured(event)).encode(), {"Content-Type": "application/cloudevents+json"})
        else:
            self._post(avro.encode_event(event), {"Content-Type": avro.EVENT_TYPE, "X-Avro-Schema": avro.EVENT_SCHEMA_ID})

    def emit_commit(self, commit: dict) -> None:
        if self.form == "json":
            self._post(to_json(commit_json(commit)).encode(), {"Content-Type": "application/json"})
        else:
            self._post(avro.encode_commit(commit), {"Content-Type": avro.COMMIT_TYPE, "X-Avro-Schema": avro.commit_schema_id(commit)})


class CallbackSink:
    """Calls a function for each event or commit; what it raises ends the stream, and isn't checkpointed."""

    def __init__(self, on_event: Callable[[dict], None] | None = None, on_commit: Callable[[dict], None] | None = None):
        self.emit = on_event or (lambda event: None)
        self.emit_commit = on_commit or (lambda commit: None)


def make_sink(kind: str, url: str = "", form: str = "json") -> Sink:
    return HttpSink(url, form) if kind == "http" else StdoutSink(form)


class CheckpointStore:
    """A checkpoint {adapter, payload} in a JSON file. A save replaces the file at once or not at all."""

    def __init__(self, path: str | Path):
        self.path = Path(path)

    def load(self) -> dict | None:
        return json.loads(self.path.read_text()) if self.path.exists() else None

    def save(self, checkpoint: dict) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        beside = self.path.with_name(f".{self.path.name}.{os.getpid()}")
        beside.write_text(json.dumps(checkpoint, indent=2))
        os.replace(beside, self.path)


def with_gtid(checkpoint: dict | None, gtid_set: str, adapter: str = "mysql") -> dict:
    """The checkpoint with another set, joined to the one that it has; what else it holds for this adapter stays."""
    from logweave.operators.positions import union

    held = ((checkpoint or {}).get("payload") if (checkpoint or {}).get("adapter") == adapter else None) or {}
    return {"adapter": adapter, "payload": {**held, "gtid": union(held["gtid"], gtid_set) if held.get("gtid") else gtid_set}}


def with_baseline(checkpoint: dict | None, executed: str, adapter: str = "mysql") -> dict:
    """The checkpoint of a first connect: the set that the server had then. One that is there already stays."""
    held = ((checkpoint or {}).get("payload") if (checkpoint or {}).get("adapter") == adapter else None) or {}
    return {"adapter": adapter, "payload": {"baseline_gtid": executed, **held}}


def with_place(checkpoint: dict | None, place: dict) -> dict:
    """The checkpoint of a document stream at another place; a seed's time stays."""
    held = ((checkpoint or {}).get("payload") if (checkpoint or {}).get("adapter") == "mongo" else None) or {}
    return {"adapter": "mongo", "payload": {**({"seed_cluster_time": held["seed_cluster_time"]} if held.get("seed_cluster_time") else {}), **place}}


def start_position(checkpoint: dict | None, purged: str = "", adapter: str = "mysql") -> str | None:
    """The set to tell the server on connecting; None: from its newest event on."""
    from logweave.operators.positions import handshake

    payload = (checkpoint or {}).get("payload") or {}
    if (checkpoint or {}).get("adapter") != adapter or not payload.get("gtid"):
        return None
    return handshake(payload["gtid"], payload.get("baseline_gtid"), purged)


def document_start(checkpoint: dict | None) -> tuple[str, object]:
    """Where a document stream starts: (after, token), (at, time of the seed) or (now, None)."""
    payload = (checkpoint or {}).get("payload") or {} if (checkpoint or {}).get("adapter") == "mongo" else {}
    if payload.get("resume_token") is not None:
        return "after", payload["resume_token"]
    if payload.get("seed_cluster_time") is not None:
        return "at", payload["seed_cluster_time"]
    return "now", None


def needs_seed(checkpoint: dict | None) -> bool:
    return document_start(checkpoint)[0] != "after"
