"""Settings of a capture, from a TOML file or in code."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import quote

from logweave.functions.values import parse_subject


class ConfigError(ValueError):
    """A setting is missing or wrong."""


def one_of(what: str, text: str, allowed: tuple[str, ...]) -> str:
    value = text.strip().lower()
    if value not in allowed:
        raise ConfigError(f"{what} {text!r} is none of {', '.join(allowed)}")
    return value


def payload_mode(text: str) -> str:
    return one_of("payload_mode", text, ("full", "signal"))


def delivery_unit(text: str) -> str:
    return one_of("delivery_unit", text, ("row", "transaction"))


def sink_format(text: str) -> str:
    return one_of("sink format", text, ("json", "avro"))


def full_document(text: str) -> str:
    return one_of("full_document", text, ("required", "update_lookup"))


@dataclass
class SourceOptions:
    adapter: str = ""
    source_id: str = ""
    host: str = ""
    port: int = 0
    user: str = ""
    password: str = ""
    server_id: int = 0
    tls: bool = True
    uri: str = ""
    database: str = ""
    full_document: str = "required"
    seed: bool = False
    include_tables: list[str] = field(default_factory=list)
    payload_mode: str = "full"
    delivery_unit: str = "row"
    queue_capacity: int = 64
    queue_max_bytes: int = 32 << 20
    part_max_rows: int = 10_000
    part_max_bytes: int = 16 << 20


@dataclass
class SinkOptions:
    kind: str = ""
    url: str = ""
    format: str = "json"


@dataclass
class Options:
    source: SourceOptions
    checkpoint_path: str
    sink: SinkOptions
    warnings: list[str] = field(default_factory=list)


def load(path: str | Path) -> Options:
    with open(path, "rb") as file:
        return from_tables(tomllib.load(file))


def from_tables(told: dict) -> Options:
    try:
        made = Options(SourceOptions(**told.get("source", {})), told.get("checkpoint", {}).get("path", ""), SinkOptions(**told.get("sink", {})))
    except TypeError as error:
        raise ConfigError(str(error)) from None
    return validated(made)


def validated(options: Options) -> Options:
    source, sink = options.source, options.sink
    if source.adapter not in ("mysql", "mongo"):
        raise ConfigError(f"source.adapter {source.adapter!r} is neither mysql nor mongo")
    if not source.include_tables:
        raise ConfigError("source.include_tables needs at least one database.table")
    if not source.source_id.strip():
        raise ConfigError("source.source_id is empty")
    for name in ("part_max_rows", "part_max_bytes", "queue_max_bytes", "queue_capacity"):
        if getattr(source, name) < 1:
            raise ConfigError(f"source.{name} must be 1 or more")
    source.payload_mode, source.delivery_unit = payload_mode(source.payload_mode), delivery_unit(source.delivery_unit)
    source.full_document, sink.format = full_document(source.full_document), sink_format(sink.format)
    if not options.checkpoint_path:
        raise ConfigError("checkpoint.path is empty")
    if sink.kind not in ("stdout", "http"):
        raise ConfigError(f"sink.kind {sink.kind!r} is neither stdout nor http")
    if sink.kind == "http" and not sink.url:
        raise ConfigError("an http sink needs sink.url")
    try:
        tables = [parse_subject(t) for t in source.include_tables]
    except ValueError as error:
        raise ConfigError(str(error)) from None
    if source.adapter == "mysql":
        for name in ("host", "port", "user", "server_id"):
            if not getattr(source, name):
                raise ConfigError(f"source.{name} is needed for mysql")
        if source.seed:
            raise ConfigError("source.seed is for mongo only")
        if not source.tls:
            options.warnings.append("the connection isn't encrypted")
    else:
        if not (source.uri and source.database):
            raise ConfigError("source.uri and source.database are needed for mongo")
        if outside := [t for t, (database, _) in zip(source.include_tables, tables, strict=True) if database != source.database]:
            raise ConfigError(f"{outside[0]} isn't in database {source.database}")
    return options


def connection_url(source: SourceOptions) -> str:
    return f"mysql://{quote(source.user, safe='')}:{quote(source.password, safe='')}@{source.host}:{source.port}?ssl-mode={'required' if source.tls else 'disabled'}"
