"""Events in their fixed envelope, and commits as one record each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.values import quoted, row_image

#: What event types begin with.
TYPE_PREFIX = "org.logweave.log"
FIELDS = ("specversion", "id", "type", "source", "subject", "time", "extensions_json", "data_json")
EVENT_SCHEMA = "struct<" + ",".join(f"{name}:string" for name in FIELDS) + ">"


def row_data(op: Column, before: Column, after: Column, mode: str = "full") -> Column:
    """The payload of a row event, JSON images given: inserts have after, updates both, deletes before; a signal only says that it was."""
    parts = [quoted(F.lit("op")), F.lit(":"), quoted(op)]
    if mode == "signal":
        return F.concat(F.lit("{"), *parts, F.lit(',"signal":true}'))
    if mode != "full":
        raise ValueError(f"payload mode {mode!r} is neither full nor signal")
    image = lambda name, text: F.concat(F.lit(f',"{name}":'), F.coalesce(text, F.lit("null")))
    none = F.lit("")
    return F.concat(
        F.lit("{"), *parts, F.when(op.isin("update", "delete"), image("before", before)).otherwise(none), F.when(op.isin("insert", "update"), image("after", after)).otherwise(none), F.lit("}")
    )


def document_data(op: Column, key: Column, document: Column, mode: str = "full") -> Column:
    """The payload of a document event: no image from before an update, and a delete has only its key."""
    if mode == "signal":
        return row_data(op, F.lit(None), F.lit(None), mode)
    head = F.concat(F.lit("{"), quoted(F.lit("op")), F.lit(":"), quoted(op))
    return F.when(op == "delete", F.concat(head, F.lit(',"before":'), key, F.lit("}"))).otherwise(F.concat(head, F.lit(',"after":'), document, F.lit("}")))


def event_id(*parts: Column) -> Column:
    """An id that a second reading of the same event gets too, in the form of a UUID."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat_ws("-", *cut)


def cloud_event(id_: Column, kind: Column, source: Column, subject: Column, time: Column, extensions: Column, data: Column, prefix: str = TYPE_PREFIX) -> Column:
    """An event as struct of strings; kind is what follows the prefix, time a timestamp (UTC, milliseconds)."""
    return F.struct(
        F.lit("1.0").alias("specversion"), id_.alias("id"), F.concat(F.lit(f"{prefix}."), kind).alias("type"), source.alias("source"), subject.alias("subject"),
        F.date_format(F.to_utc_timestamp(time, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("time"), F.coalesce(extensions, F.lit("{}")).alias("extensions_json"), data.alias("data_json"),
    )


def row_kind(op: Column) -> Column:
    return F.when(op == "insert", "row.inserted").when(op == "update", "row.updated").when(op == "delete", "row.deleted")


def log_extensions(gtid: Column, gtid_set: Column) -> Column:
    """gtid, and gtidset unless it is empty."""
    return F.to_json(F.struct(gtid.alias("gtid"), F.when(gtid_set != "", gtid_set).alias("gtidset")))


def row_events(rows: DataFrame, time: Column, mode: str = "full", prefix: str = TYPE_PREFIX, gtid_set: Column | None = None) -> DataFrame:
    """Committed rows (source_id, gtid, subject, columns, op, before, after, pos, inner_pos) with `event`."""
    data = row_data(F.col("op"), row_image(F.col("columns"), F.col("before")), row_image(F.col("columns"), F.col("after")), mode)
    id_ = event_id(F.col("source_id"), F.col("gtid"), F.col("pos"), F.col("inner_pos"))
    extensions = log_extensions(F.col("gtid"), gtid_set if gtid_set is not None else F.lit(""))
    return rows.withColumn("event", cloud_event(id_, row_kind(F.col("op")), F.col("source_id"), F.col("subject"), time, extensions, data, prefix))


def ddl_events(ddl: DataFrame, time: Column, prefix: str = TYPE_PREFIX) -> DataFrame:
    """Schema statements (source_id, gtid, schema_name, query, pos, inner_pos) with `event`; the subject is the schema."""
    data = F.to_json(F.struct(F.col("schema_name").alias("schema"), F.col("query")))
    id_ = event_id(F.col("source_id"), F.col("gtid"), F.col("pos"), F.col("inner_pos"))
    return ddl.withColumn("event", cloud_event(id_, F.lit("ddl"), F.col("source_id"), F.col("schema_name"), time, log_extensions(F.col("gtid"), F.lit("")), data, prefix))


def control_event(control: Column, source: Column, id_: Column, time: Column, prefix: str = TYPE_PREFIX) -> Column:
    """A control struct<kind, database, table, to_database, to_table> as an event; the subject is the database alone without a table."""
    table = lambda d, t: F.struct(control[d].alias("database"), control[t].alias("table"))
    renamed = F.when(control["to_database"].isNotNull(), table("to_database", "to_table"))
    data = F.to_json(F.struct(control["kind"].alias("kind"), table("database", "table").alias("subject"), renamed.alias("renamed_to")))
    subject = F.when(F.coalesce(control["table"], F.lit("")) == "", control["database"]).otherwise(F.concat_ws(".", control["database"], control["table"]))
    return cloud_event(id_, F.concat(F.lit("control."), control["kind"]), source, subject, time, F.lit("{}"), data, prefix)


def fan_out(ddl: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each event of a commit: its schema statements first, then its rows, with ordinal from 0."""
    from pyspark.sql import Window

    both = ddl.select(*keys, "pos", "inner_pos", F.lit(0).alias("_first"), "event").unionByName(rows.select(*keys, "pos", "inner_pos", F.lit(1).alias("_first"), "event"))
    order = Window.partitionBy(*keys).orderBy("_first", "pos", "inner_pos")
    return both.withColumn("ordinal", (F.row_number().over(order) - 1).cast("int")).drop("_first")


def envelopes(commits: DataFrame, ddl: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """commits with ddl array<struct<schema, query>> and events array<event>, in log order; both empty for empty commits.

    Rows must come in parts (key columns and part) where a transaction may be too long for one record.
    """
    said = ddl.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "inner_pos", F.struct(F.col("schema_name").alias("schema"), "query").alias("x")))).alias("_ddl"))
    held = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "inner_pos", "event"))).alias("_events"))
    joined = commits.join(said, keys, "left").join(held, keys, "left")
    return joined.select(
        *commits.columns,
        F.coalesce(F.transform("_ddl", lambda x: x["x"]), F.array().cast("array<struct<schema:string,query:string>>")).alias("ddl"),
        F.coalesce(F.transform("_events", lambda x: x["event"]), F.array().cast(f"array<{EVENT_SCHEMA}>")).alias("events"),
    )


def structured_json(event: Column) -> Column:
    """An event as it is posted: attributes, then extensions at the top level, then data."""
    attributes = F.to_json(F.struct(*[event[f].alias(f) for f in FIELDS[:6]]))
    inner = F.substr(event["extensions_json"], F.lit(2), F.char_length(event["extensions_json"]) - 2)
    more = F.when(F.trim(inner) == "", F.lit("")).otherwise(F.concat(F.lit(","), inner))
    return F.concat(F.substr(attributes, F.lit(1), F.char_length(attributes) - 1), more, F.lit(',"data":'), event["data_json"], F.lit("}"))


def nested_json(event: Column) -> Column:
    """An event as it is printed: extensions stay an object, left out when empty."""
    attributes = F.to_json(F.struct(*[event[f].alias(f) for f in FIELDS[:6]]))
    more = F.when(event["extensions_json"] == "{}", F.lit("")).otherwise(F.concat(F.lit(',"extensions":'), event["extensions_json"]))
    return F.concat(F.substr(attributes, F.lit(1), F.char_length(attributes) - 1), more, F.lit(',"data":'), event["data_json"], F.lit("}"))
