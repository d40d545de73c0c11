"""Include lists: which tables' row events are passed on."""

from __future__ import annotations

import json
import os

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.values import parse_subject


class IncludeList:
    """A live list of subjects, shared by all who hold it. Either all tables pass, or those of a set.

    A new one passes all until it is first set; from_tables takes an empty list as all, from_subjects and replace as none.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._set = False
        self._only: frozenset[str] | None = None
        self._in_effect: frozenset[str] | None = None
        self._capturing = False

    @classmethod
    def from_tables(cls, tables: list[str]) -> IncludeList:
        made = cls()
        made._set, made._only = True, frozenset(".".join(parse_subject(t)) for t in tables) or None
        return made

    @classmethod
    def from_subjects(cls, subjects: list[str]) -> IncludeList:
        made = cls()
        made._set, made._only = True, frozenset(subjects)
        return made

    def snapshot(self) -> frozenset[str] | None:
        """What passes now: None for all."""
        with self._lock:
            return self._only

    @property
    def is_all(self) -> bool:
        return self.snapshot() is None

    def subjects(self) -> list[str]:
        return sorted(self.snapshot() or ())

    def replace(self, subjects: list[str]) -> None:
        with self._lock:
            self._set, self._only = True, frozenset(subjects)

    def insert(self, subject: str) -> bool:
        """False if all pass already; a list that was never set becomes this subject alone."""
        with self._lock:
            if self._only is None and self._set:
                return False
            changed = subject not in (self._only or ())
            self._set, self._only = True, (self._only or frozenset()) | {subject}
            return changed

    def remove(self, subject: str) -> bool:
        with self._lock:
            if self._only is None or subject not in self._only:
                return False
            self._only -= {subject}
            return True

    def seed_if_unset(self, subjects: list[str]) -> None:
        with self._lock:
            if not self._set:
                self._set, self._only = True, frozenset(subjects) or None

    def set_in_effect(self, only: frozenset[str] | None) -> None:
        with self._lock:
            self._in_effect, self._capturing = only, True

    def clear_in_effect(self) -> None:
        with self._lock:
            self._in_effect, self._capturing = None, False

    def in_effect(self) -> tuple[bool, frozenset[str] | None]:
        with self._lock:
            return self._capturing, self._in_effect

    def in_effect_allows(self, subject: str) -> bool:
        capturing, only = self.in_effect()
        return capturing and (only is None or subject in only)


class ListFile:
    """An include list in a JSON file, a list of subjects or null for all: read again whenever the file has changed.

    Workers of a stream ask it where a transaction begins, so an edit counts from the next one on. The file lies in a
    folder that they share; until it is there, the given subjects count.
    """

    def __init__(self, path: str, subjects: list[str] | None = None):
        self.path, self.subjects, self.seen = path, subjects, None

    def __call__(self) -> frozenset[str] | None:
        if os.path.exists(self.path):
            told = os.stat(self.path)
            if (told.st_mtime_ns, told.st_size) != self.seen:
                with open(self.path) as file:
                    self.subjects = json.load(file)
                self.seen = told.st_mtime_ns, told.st_size
        return None if self.subjects is None else frozenset(self.subjects)


def covers(open_: frozenset[str] | None, wanted: frozenset[str] | None) -> bool:
    """Whether a reader opened with one filter sees all that another wants."""
    return open_ is None or (wanted is not None and wanted <= open_)


def allows(subject: Column, only: frozenset[str] | list[str] | None) -> Column:
    return F.lit(True) if only is None else subject.isin(sorted(only)) if only else F.lit(False)


def in_database(subject: Column, database: str) -> Column:
    return subject.startswith(f"{database}.")


def pushed(collection: Column, op: Column, position: Column, only: frozenset[str] | None, database: str, resume: str | None) -> Column:
    """A reader's own filter: listed collections, events that end a stream, and the event to resume after."""
    if only is None:
        return F.lit(True)
    own = sorted(s.partition(".")[2] for s in only if s.startswith(f"{database}."))
    kept = (collection.isin(own) if own else F.lit(False)) | op.isin("drop_database", "invalidate")
    return kept if resume is None else kept | (position == resume)


def pinned(rows: DataFrame, versions: DataFrame, start: str = "txn_start") -> DataFrame:
    """rows with `included`: by the list in force where their transaction began, not where they are.

    versions (valid_from, mode all or only, subjects) is a parameter: as many rows as the list was edited. Before the
    first version all pass.
    """
    spans = versions.select(
        F.col("valid_from").alias("_from"), F.col("mode").alias("_mode"), F.col("subjects").alias("_subjects"),
        F.lead("valid_from").over(_by_start()).alias("_to"),
    )
    joined = rows.join(F.broadcast(spans), (F.col(start) >= F.col("_from")) & (F.col("_to").isNull() | (F.col(start) < F.col("_to"))), "left")
    passes = F.coalesce(F.col("_mode") == "all", F.lit(True)) | F.coalesce(F.array_contains("_subjects", F.col("subject")), F.lit(False))
    return joined.withColumn("included", passes).drop("_from", "_to", "_mode", "_subjects")


def _by_start():
    from pyspark.sql import Window

    return Window.orderBy("valid_from")
