"""Queries over the driver's tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions import statements
from logweave.functions.avro import encoded_events
from logweave.functions.values import cell_json, epoch_millis, row_bytes, token_time
from logweave.operators import assemble, documents, envelopes, gates, include, ordered, parts, positions
from logweave.plans.sql import ORACLES
from logweave.sources import derived

TWO = frozenset({"shop.items", "shop.lines"})
DOCS = frozenset({"app.c0", "app.c1", "app.c2"})
KEYS = ["source_id", "txn_start"]
ORDER = ["pos", "inner_pos"]
#: The fixed clock of queries on lags, in milliseconds.
NOW_MS = 1_706_745_600_000


def _done(spark: SparkSession, sf_dir: str):
    log = assemble.written(assemble.marked(derived.order_log(spark, sf_dir)))
    ends = assemble.endings(log)
    return log, ends, assemble.committed_rows(log, ends)


def commit_envelopes(spark, sf_dir):
    return assemble.commits(derived.order_log(spark, sf_dir), TWO).select("gno", "n_rows", "n_ddl", "ended_by")


def commit_shapes(spark, sf_dir):
    done = assemble.commits(derived.order_log(spark, sf_dir))
    empty = F.count(F.when((F.col("n_rows") == 0) & (F.col("n_ddl") == 0), 1))
    return done.groupBy("ended_by").agg(F.count("*").alias("n_commits"), empty.alias("n_empty"), F.sum("n_rows").alias("n_rows"), F.sum("n_ddl").alias("n_ddl"))


def empty_commits(spark, sf_dir):
    return assemble.commits(derived.order_log(spark, sf_dir), frozenset({"shop.items"})).where("n_rows = 0 and n_ddl = 0").select("gno", "ended_by")


def include_filtered(spark, sf_dir):
    _, _, rows = _done(spark, sf_dir)
    from logweave.operators.include import allows

    return rows.where(allows(F.col("subject"), TWO)).groupBy("subject", "op").agg(F.count("*").alias("n_rows"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


def include_asof(spark, sf_dir):
    versions = spark.createDataFrame(
        [(0, "only", ["shop.items"]), (64 * 300 + 5, "only", ["shop.items", "shop.lines"]), (64 * 700, "all", []), (64 * 1100, "only", [])], "valid_from long, mode string, subjects array<string>"
    )
    return assemble.commits(derived.order_log(spark, sf_dir), versions=versions).select("gno", "n_rows")


def ddl_classify(spark, sf_dir):
    texts = (
        "BEGIN", "  begin ;", "/* note */ CREATE TABLE shop.t (a INT)", "-- line\nDROP TABLE shop.t", "# x\n/*!50003 ALTER TABLE t ADD c INT */", "/* never ends CREATE TABLE x", "COMMIT", "XA START 'x'",
        "CREATE TABLE shop.c (a INT) start  transaction;", "Rollback;", "SAVEPOINT s1", "RENAME TABLE a TO b", "GRANT ALL ON *.* TO u", "--not a comment", "TRUNCATE shop.orders",
    )
    query = F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("o_orderkey") % len(texts) + 1).cast("int"))
    q = derived.table(spark, sf_dir, "orders").select("o_orderkey", query.alias("query"))
    c = F.col("query")
    return q.select("o_orderkey", statements.statement_start(c).alias("start"), statements.is_ddl(c).alias("is_ddl"), statements.query_kind(c).alias("kind"), statements.opens_transaction(c).alias("opens"))


def _row_events(mode):
    def query(spark, sf_dir) -> DataFrame:
        _, _, rows = _done(spark, sf_dir)
        made = envelopes.row_events(rows, F.timestamp_millis(F.lit(NOW_MS)), mode)
        return made.select("gno", "pos", F.col("event.type").alias("type"), F.col("event.subject").alias("subject"), F.col("event.extensions_json").alias("extensions_json"), F.col("event.data_json").alias("data_json"))

    return query


def row_event_json(spark, sf_dir):
    _, _, rows = _done(spark, sf_dir)
    made = envelopes.row_events(rows, F.timestamp_millis(F.lit(NOW_MS)), "signal")
    return made.select("pos", envelopes.structured_json(F.col("event")).alias("structured"), envelopes.nested_json(F.col("event")).alias("nested"))


def table_map_asof(spark, sf_dir):
    log = derived.order_log(spark, sf_dir)
    k = F.floor(F.col("pos") / derived.STEPS)
    kept = (F.col("kind") != "table_map") | ((k % 20 == 0) & ((F.col("table_id") < 3) | (k >= 40)))
    renamed = F.when((F.col("table_id") == 1) & (k >= 200), F.lit("items2")).otherwise(F.col("table"))
    rows = assemble.with_table_maps(log.where(kept).withColumn("table", renamed))
    return rows.groupBy("subject").agg(F.count("*").alias("n_rows"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


def payload_unpack(spark, sf_dir):
    opened = assemble.unpack(derived.packed_log(derived.order_log(spark, sf_dir)))
    return assemble.commits(opened).select("gno", "n_rows", "n_ddl", "ended_by")


def log_violations(spark, sf_dir):
    log = derived.order_log(spark, sf_dir)
    k = F.floor(F.col("pos") / derived.STEPS)
    broken = log.where(~((F.col("kind") == "gtid") & (k % 200 == 0)) & ~((F.col("kind") == "gtid") & (k % 200 == 31)))
    return assemble.violations(broken, TWO).groupBy("error").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))


def gtid_islands(spark, sf_dir):
    return positions.islands(assemble.commits(derived.order_log(spark, sf_dir)), ["uuid"]).select("uuid", "lo", "hi")


def gtid_set_after(spark, sf_dir):
    done = positions.running_sets(assemble.commits(derived.order_log(spark, sf_dir)), ["uuid"], "txn_start")
    return done.select("gno", "n_intervals", "lo", "hi")


def _spans(spark, sf_dir):
    """An interval of every order: those of a uuid begin 12 numbers apart and hold up to 23, so that some overlap, touch or leave gaps."""
    k = F.col("o_orderkey")
    return derived.table(spark, sf_dir, "orders").select((k % 3).alias("uuid"), (4 * k + 1).alias("lo"), (4 * k + 1 + k % 23).alias("hi"))


def gtid_union(spark, sf_dir):
    return positions.union_rows(_spans(spark, sf_dir).withColumn("uuid", F.concat(F.lit("u"), F.col("uuid").cast("string"))), ["uuid"]).select("uuid", "lo", "hi")


def gtid_handshake(spark, sf_dir):
    held = gtid_islands(spark, sf_dir)
    purged = spark.createDataFrame([(derived.UUID, 1, 25), (derived.UUID, 20, 38), ("other", 5, 5)], "uuid string, lo long, hi long")
    return positions.set_text(positions.union_rows(held.unionByName(purged), ["uuid"])).select("uuid", "text")


def parts_by_rows(spark, sf_dir):
    _, _, rows = _done(spark, sf_dir)
    cut = parts.by_rows(rows, [*KEYS, "gno"], ORDER, 3)
    return parts.part_columns(cut.groupBy("gno", "part", "n_parts").agg(F.count("*").alias("n_rows"))).select("gno", "part", "n_rows", "part_number", "part_last")


def parts_by_bytes(spark, sf_dir):
    _, _, rows = _done(spark, sf_dir)
    sized = rows.withColumn("size", row_bytes(F.col("op"), F.col("columns"), F.col("before"), F.col("after")))
    cut = parts.by_size(sized, [*KEYS, "gno"], ORDER, "size", 4, 300)
    return cut.groupBy("gno", "part", "n_parts").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"))


def part_rules(spark, sf_dir):
    """Only the last part has a set after it, told by its last interval and how many there are; schema statements go with the first."""
    log, ends, rows = _done(spark, sf_dir)
    cut = parts.by_rows(rows, [*KEYS, "gno"], ORDER, 2).groupBy(*KEYS, "part", "n_parts").agg(F.count("*").alias("n_rows"))
    done = positions.running_sets(assemble.commits_of(log, ends, rows), ["uuid"], "txn_start").select(*KEYS, "gno", "n_ddl", "n_intervals", "lo", "hi")
    both = parts.part_columns(done.join(cut, KEYS, "left").withColumn("n_parts", F.coalesce("n_parts", F.lit(1))).withColumn("part", F.coalesce("part", F.lit(1))))
    last = F.coalesce("part_last", F.lit(True))
    return both.select(
        "gno", "part_number", "part_last", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), F.when(F.col("part") == 1, F.col("n_ddl")).otherwise(0).alias("n_ddl"),
        *[F.when(last, F.col(c)).alias(f"after_{c}") for c in ("n_intervals", "lo", "hi")],
    )


def row_fanout(spark, sf_dir):
    log, ends, rows = _done(spark, sf_dir)
    time = F.timestamp_millis(F.lit(NOW_MS))
    made = envelopes.fan_out(envelopes.ddl_events(assemble.committed_ddl(log, ends), time), envelopes.row_events(rows, time, "signal"), KEYS)
    return made.select((F.col("txn_start") / derived.STEPS).cast("long").alias("k"), "ordinal", F.col("event.type").alias("type"), F.col("event.subject").alias("subject"), F.col("event.data_json").alias("data_json"))


def envelope_size(spark, sf_dir):
    _, _, rows = _done(spark, sf_dir)
    size = row_bytes(F.col("op"), F.col("columns"), F.col("before"), F.col("after"))
    return rows.withColumn("size", size).groupBy("gno").agg(F.sum("size").alias("n_bytes"), F.count("*").alias("n_events"))


def full_envelopes(spark, sf_dir):
    log, ends, rows = _done(spark, sf_dir)
    time = F.timestamp_millis(F.lit(NOW_MS))
    done = positions.running_sets(assemble.commits_of(log, ends, rows), ["uuid"], "txn_start").select(*KEYS, "gno", "n_intervals", "lo", "hi")
    made = envelopes.envelopes(done, assemble.committed_ddl(log, ends), envelopes.row_events(rows, time), KEYS)
    return made.select(
        "gno", "n_intervals", "lo", "hi", F.size("ddl").cast("long").alias("n_ddl"), F.size("events").cast("long").alias("n_events"),
        F.array_join(F.transform("ddl", lambda x: x["query"]), ";").alias("queries"), F.array_join(F.transform("events", lambda x: x["subject"]), ",").alias("subjects"),
    )


def doc_effects(spark, sf_dir):
    done = documents.effects(derived.document_log(spark, sf_dir), only=DOCS)
    return done.select("pos", "effect", "row_op", "subject", "data_json", F.col("control.kind").alias("control"), F.col("control.to_database").alias("to_database"), F.col("control.to_table").alias("to_table"))


def doc_effects_signal(spark, sf_dir):
    return documents.effects(derived.document_log(spark, sf_dir), "signal").groupBy("effect", "row_op", "data_json").agg(F.count("*").alias("n"))


def doc_runs(spark, sf_dir):
    return documents.runs(derived.document_log(spark, sf_dir)).groupBy("run_start").agg(F.max("pos").alias("run_end"), F.count("*").alias("n_changes"))


def doc_positions(spark, sf_dir):
    done = documents.commits(documents.effects(derived.document_log(spark, sf_dir), only=DOCS))
    return done.select("run_start", "n_rows", "n_controls", "stop", "at_json", "after_json")


def doc_parts(spark, sf_dir):
    return documents.n_parts(documents.effects(derived.document_log(spark, sf_dir), only=DOCS), 2).select("run_start", "n_rows", "n_parts")


def control_stop(spark, sf_dir):
    done = documents.until_stop(documents.commits(documents.effects(derived.document_log(spark, sf_dir), only=DOCS)))
    return done.select("run_start", "run_end", "n_rows", "stop")


def token_times(spark, sf_dir):
    log = derived.document_log(spark, sf_dir)
    token = F.when(F.col("pos") % 5 == 0, F.concat(F.lit("83"), F.col("resume_token"))).when(F.col("pos") % 7 == 0, F.substring("resume_token", 1, 17)).otherwise(F.col("resume_token"))
    return log.select("pos", token_time(token).alias("x")).select("pos", F.col("x.t").alias("t"), F.col("x.i").alias("i"))


def seed_and_tail(spark, sf_dir):
    people = derived.table(spark, sf_dir, "customer")
    snapshot = people.select(F.lit("docs-1").alias("source_id"), F.lit("app.customer").alias("subject"), F.col("c_custkey").alias("key"), F.col("c_name").alias("document"))
    log = documents.effects(derived.document_log(spark, sf_dir)).where("effect = 'row'")
    tail = log.select("source_id", "subject", F.col("pos").alias("key"), F.col("row_op").alias("op"), F.col("full_document").alias("document"), F.col("cluster_time.t").alias("t"), F.col("cluster_time.i").alias("i"))
    return documents.seed_and_tail(snapshot, tail, 1_704_200_000, 700).select("phase", "subject", "key", "op", "document", "t", "i")


def gate_report(spark, sf_dir):
    k = F.col("n_nationkey")
    value = lambda name, at: F.when(k % 7 == at, "OFF").when(k % 11 != at, {"gtid_mode": "on", "enforce_gtid_consistency": "ON", "binlog_format": "Row"}.get(name, "FULL"))
    names = ("binlog_format", "binlog_row_image", "binlog_row_metadata", "gtid_mode", "enforce_gtid_consistency")
    held = derived.table(spark, sf_dir, "nation").select(F.concat(F.lit("s"), k.cast("string")).alias("source_id"), F.inline(F.array(*[F.struct(F.lit(n).alias("name"), value(n, i).alias("value")) for i, n in enumerate(names)])))
    return gates.variable_report(held.where("value is not null")).select("source_id", "name", "status")


def lag_metrics(spark, sf_dir):
    lag = F.lit(NOW_MS) - epoch_millis(F.col("ts"))
    return derived.table(spark, sf_dir, "events").select("event_type", lag.alias("lag_ms")).groupBy("event_type").agg(F.count("*").alias("n"), F.min("lag_ms").alias("least_ms"), F.max("lag_ms").alias("most_ms"))


def health_samples(spark, sf_dir):
    """The first and every hundredth row event, as a capture reports them."""
    _, _, rows = _done(spark, sf_dir)
    counted = ordered.running_sum(rows, ["source_id"], ORDER, F.lit(1).cast("long"), "n")
    return counted.where("n = 1 or n % 100 = 0").select("n", "gno", "subject")


def typed_cells(spark, sf_dir):
    """Cells of each kind of column as JSON text, from values that the events' ids give."""
    e = F.col("event_id")
    cells = {
        "longlong": e, "year": 1970 + e % 100, "bit": e % 2, "string": F.when(e % 7 != 0, F.concat(F.col("event_type"), F.lit('"\\\n'))),
        "blob": F.when(e % 3 == 0, F.unhex(F.concat(F.lit("ff"), F.lpad(F.hex(e % 256), 2, "0")))).otherwise(F.encode("event_type", "UTF-8")),
        "decimal": (e / 4).cast("decimal(14,2)"), "date": F.date_add(F.lit("2024-01-01").cast("date"), (e % 500).cast("int")), "timestamp": F.timestamp_micros(e * 1_000_003),
    }
    return derived.table(spark, sf_dir, "events").select("event_id", *[cell_json(value, kind).alias(f"as_{kind}") for kind, value in cells.items()])


def txn_keys(spark, sf_dir):
    e = F.col("event_id")
    told = derived.table(spark, sf_dir, "events").select("event_id", F.when(e % 5 != 0, F.concat(F.lit("s"), F.col("user_id").cast("string"))).alias("session_id"), F.when(e % 3 != 0, e).alias("txn_number"))
    return told.select("event_id", documents.transaction_key().alias("txn_key"))


def control_events(spark, sf_dir):
    done = documents.effects(derived.document_log(spark, sf_dir)).where("effect = 'control'")
    event = envelopes.control_event(F.col("control"), F.col("source_id"), envelopes.event_id(F.col("source_id"), F.col("pos")), F.timestamp_millis(F.lit(NOW_MS)))
    return done.select("pos", event.alias("event")).select("pos", *[F.col("event")[f].alias(f) for f in ("id", "type", "subject", "time", "data_json")])


def doc_boundaries(spark, sf_dir):
    """Runs of a log with empty batches, half of them with a token that moved."""
    log = derived.document_log(spark, sf_dir)
    e = F.col("pos")
    empty = log.where(e % 40 == 0).select(
        "source_id", (e * 2 + 1).alias("pos"), F.lit("boundary").alias("op"), F.lit("app").alias("database"), F.when(e % 80 == 0, F.col("resume_token")).otherwise(F.concat("resume_token", F.lit("ff"))).alias("resume_token")
    )
    both = log.withColumn("pos", e * 2).unionByName(empty, allowMissingColumns=True)
    return documents.commits(documents.effects(both, only=DOCS)).select("run_start", "run_end", "n_rows", "n_controls", "stop")


def gtid_legacy(spark, sf_dir):
    """What a checkpoint without a baseline is taken for, with what the server has purged."""
    purged = spark.createDataFrame([(derived.UUID, 1, 25), ("other", 5, 5)], "uuid string, lo long, hi long")
    held = positions.legacy_spans(gtid_islands(spark, sf_dir))
    return positions.set_text(positions.union_rows(held.unionByName(purged), ["uuid"])).select("uuid", "text")


def derived_positions(spark, sf_dir):
    """Positions of commits: their own, or what their id and the last interval of the set after them say."""
    done = positions.running_sets(assemble.commits(derived.order_log(spark, sf_dir)), ["uuid"], "txn_start")
    own = F.when(F.col("gno") % 5 == 0, positions.position_struct(F.lit("mongo"), F.lit('{"a":1}'), F.lit("{}")))
    after = F.concat_ws("", "uuid", F.lit(":"), "lo", F.lit("-"), "hi")
    return done.select("gno", positions.derived_position(own, F.col("gtid"), after).alias("p")).select("gno", "p.adapter", "p.at_json", "p.after_json")


def avro_events(spark, sf_dir):
    """Row events as Avro datums, in hex."""
    _, _, rows = _done(spark, sf_dir)
    made = envelopes.row_events(rows, F.timestamp_millis(F.lit(NOW_MS)), "signal")
    return made.select("pos", F.lower(F.hex(encoded_events(F.col("event")))).alias("datum"))


def database_scope(spark, sf_dir):
    subject = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "shopping").when(F.col("o_orderkey") % 3 == 1, "shop").otherwise("other"), F.lit(".items"))
    return derived.table(spark, sf_dir, "orders").select(subject.alias("subject")).select("subject", include.in_database(F.col("subject"), "shop").alias("inside")).groupBy("subject", "inside").agg(F.count("*").alias("n"))


def pushed_changes(spark, sf_dir):
    """What a reader's own filter lets through: listed collections, ends of a stream, and the change to resume after."""
    log = derived.document_log(spark, sf_dir)
    told = log.where("pos = 97 * 3").select("resume_token").first()  # a parameter of the reader
    kept = include.pushed(F.col("collection"), F.col("op"), F.col("resume_token"), DOCS, "app", told[0] if told else None)
    return log.where(kept).groupBy("op").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


NAMES = (
    commit_envelopes, commit_shapes, empty_commits, include_filtered, include_asof, ddl_classify, row_event_json, table_map_asof, payload_unpack, log_violations, gtid_islands, gtid_set_after, gtid_union,
    gtid_handshake, parts_by_rows, parts_by_bytes, part_rules, row_fanout, envelope_size, full_envelopes, doc_effects, doc_effects_signal, doc_runs, doc_positions, doc_parts, control_stop, token_times,
    seed_and_tail, gate_report, lag_metrics, health_samples, typed_cells, txn_keys, control_events, doc_boundaries, gtid_legacy, derived_positions, avro_events, database_scope, pushed_changes,
)


def queries() -> dict:
    return {f.__name__: f for f in NAMES} | {"row_events_full": _row_events("full"), "row_events_signal": _row_events("signal")}


def oracle_sql() -> dict:
    return dict(ORACLES)
