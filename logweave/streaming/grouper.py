"""Commits from a stream of document changes: the form of operators.documents that keeps state between batches."""

from __future__ import annotations

import json
import re

from logweave.functions.values import approx_bytes
from logweave.operators.parts import MAX_BYTES, MAX_ROWS

ROW_OPS = {"insert": "insert", "update": "update", "replace": "update", "delete": "delete"}
CONTROLS = {"drop": "dropped", "rename": "renamed", "drop_database": "database_dropped", "invalidate": "invalidated"}


def token_time(token) -> dict | None:
    """As functions.values.token_time, of a token or of its data."""
    data = token.get("_data") if isinstance(token, dict) else token
    if not isinstance(data, str) or not re.match("82[0-9A-Fa-f]{16}", data):
        return None
    return {"t": int(data[2:10], 16), "i": int(data[10:18], 16)}


def effect(change: dict, mode: str = "full", only: frozenset[str] | None = None) -> tuple[str, dict | None]:
    """row, control or filtered, and the row or control; as operators.documents.effects."""
    op, collection, database = change["op"], change.get("collection"), change["database"]
    listed = only is None or f"{database}.{collection}" in only
    if op in ROW_OPS:
        image = change.get("document_key" if op == "delete" else "full_document")
        if collection is None or not listed or op != "delete" and collection.startswith("system.") or mode != "signal" and image is None:
            return "filtered", None
        told = {"signal": True} if mode == "signal" else {"before" if op == "delete" else "after": image}
        return "row", {"subject": f"{database}.{collection}", "op": ROW_OPS[op], "data": {"op": ROW_OPS[op], **told}}
    if op not in CONTROLS or op in ("drop", "rename") and (collection is None or collection and not listed):
        return "filtered", None
    control = {"kind": CONTROLS[op], "subject": {"database": database, "table": collection if op in ("drop", "rename") else ""}}
    if op == "rename":
        control["renamed_to"] = {"database": change.get("to_database") or database, "table": change.get("to_collection") or ""}
    return "control", control


class Grouper:
    """Takes changes in log order and gives commits, or parts of long ones.

    Consecutive changes of one transaction key are a commit; a change without one is its own. The include list is
    pinned where a commit begins. A full part goes out when any further change of its transaction comes, a filtered
    one too, so the last part may have no rows; control events wait for the last part, and a commit with one has stop.
    """

    def __init__(self, include=None, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, mode: str = "full", seed_time: dict | None = None, last_token=None):
        self.include, self.mode, self.seed_time, self.last_token = include or (lambda: None), mode, seed_time, last_token
        self.max_rows, self.max_bytes = max_rows or MAX_ROWS, max_bytes or MAX_BYTES
        self.open: dict | None = None

    def dumps(self) -> str:
        held = self.open and self.open | {"only": None if self.open["only"] is None else sorted(self.open["only"])}
        return json.dumps({"open": held, "last_token": self.last_token})

    def restore(self, text: str) -> Grouper:
        told = json.loads(text)
        self.open, self.last_token = told["open"], told["last_token"]
        if self.open and self.open["only"] is not None:
            self.open["only"] = frozenset(self.open["only"])
        return self

    def _place(self, token, time: dict | None) -> dict:
        out: dict = {"resume_token": token} | ({"cluster_time": time} if time else {})
        return out | ({"seed_cluster_time": self.seed_time} if self.seed_time else {})

    def _emit(self, last: bool, after: dict | None = None) -> dict:
        held = self.open
        part = {"number": held["sent"] + 1, "last": last} if held["sent"] or not last else None
        place = {"adapter": "mongo", "at": held["first"], "after": (after or held["last"]) if last else {}}
        out = {"position": place, "rows": held["rows"], "control": held["control"] if last else [], "part": part, "stop": last and bool(held["control"])}
        if last:
            self.last_token, self.open = place["after"]["resume_token"], None
        else:
            held.update(rows=[], size=0, sent=held["sent"] + 1)
        return out

    def push(self, change: dict) -> list[dict]:
        key, out = change.get("txn_key"), []
        if self.open and (key is None or key != self.open["key"]):
            out.append(self._emit(True))
        place = self._place(change["resume_token"], change.get("cluster_time"))
        if self.open is None:
            self.open = {"key": key, "only": self.include(), "first": place, "rows": [], "control": [], "size": 0, "sent": 0}
        elif len(self.open["rows"]) >= self.max_rows or self.open["rows"] and self.open["size"] >= self.max_bytes:
            out.append(self._emit(False))
        self.open["last"] = place
        kind, told = effect(change, self.mode, self.open["only"])
        if kind == "row":
            self.open["rows"].append(told)
            self.open["size"] += approx_bytes(told["data"])
        elif kind == "control":
            self.open["control"].append(told)
        if key is None:
            out.append(self._emit(True))
        return out

    def boundary(self, token) -> list[dict]:
        """An empty batch: ends the open commit, or is an empty commit itself if the token moved since the last one."""
        after = self._place(token, token_time(token))
        if self.open:
            return [self._emit(True, after)]
        if token is None or token == self.last_token:
            return []
        self.last_token = token
        return [{"position": {"adapter": "mongo", "at": after, "after": after}, "rows": [], "control": [], "part": None, "stop": False}]
