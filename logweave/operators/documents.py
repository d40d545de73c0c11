"""Document change streams: what each change means, and commits as runs of one transaction's changes.

Columns: source_id, pos, op (insert, update, replace, delete, drop, rename, drop_database, invalidate, other, boundary),
database, collection, to_database, to_collection, document_key, full_document, txn_key, resume_token, cluster_time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.values import subject, token_time
from logweave.operators.envelopes import document_data
from logweave.operators.include import allows
from logweave.operators.ordered import WIDTH, carry_last, previous


def transaction_key(session: str = "session_id", number: str = "txn_number"):
    """Session and number of a transaction; null unless both are there."""
    return F.when(F.col(session).isNotNull() & F.col(number).isNotNull(), F.concat(F.col(session), F.lit(":"), F.col(number).cast("string")))


def effects(changes: DataFrame, mode: str = "full", only: frozenset[str] | None = None) -> DataFrame:
    """changes with effect (row, control or filtered), row_op, subject, data_json and control.

    Inserts, updates, replacements (as updates) and deletes are rows; they are filtered without a collection, in system
    collections (deletes aside), and in full mode without the image that they carry. drop and rename need a collection,
    drop_database and invalidate don't; other kinds are filtered. Of unlisted subjects rows go, and so do drop and
    rename. A filtered change still moves the position.
    """
    op, collection = F.col("op"), F.col("collection")
    row_op = F.when(op == "replace", "update").when(op.isin("insert", "update", "delete"), op)
    image = F.lit(True) if mode == "signal" else F.when(op == "delete", F.col("document_key").isNotNull()).otherwise(F.col("full_document").isNotNull())
    is_row = row_op.isNotNull() & collection.isNotNull() & image & ((op == "delete") | ~F.coalesce(collection, F.lit("")).startswith("system."))
    kind = F.when(op == "drop", "dropped").when(op == "rename", "renamed").when(op == "drop_database", "database_dropped").when(op == "invalidate", "invalidated")
    of_table = op.isin("drop", "rename")
    is_control = kind.isNotNull() & (~of_table | collection.isNotNull())
    table = F.when(of_table, collection).otherwise(F.lit(""))
    name = subject(F.col("database"), F.when(is_row, collection).otherwise(table))
    listed = allows(name, only)
    row_ok = is_row & listed
    control_ok = is_control & (~of_table | listed | (F.coalesce(collection, F.lit("")) == ""))
    control = F.struct(
        kind.alias("kind"), F.col("database").alias("database"), table.alias("table"),
        F.when(op == "rename", F.coalesce("to_database", "database")).alias("to_database"), F.when(op == "rename", F.coalesce("to_collection", F.lit(""))).alias("to_table"),
    )
    return changes.withColumns({
        "effect": F.when(row_ok, "row").when(control_ok, "control").otherwise("filtered"),
        "row_op": F.when(row_ok, row_op),
        "subject": F.when(row_ok | control_ok, name),
        "data_json": F.when(row_ok, document_data(row_op, F.col("document_key"), F.col("full_document"), mode)),
        "control": F.when(control_ok, control),
    })


def runs(changes: DataFrame, width: int = WIDTH) -> DataFrame:
    """changes with run_start: consecutive changes of one transaction key are one commit, a change without one is its own.

    A boundary row (an empty batch) ends the run before it, and is a run of its own.
    """
    seen = previous(changes, ["source_id"], ["pos"], F.col("txn_key"), "_prev", width)
    same = F.col("txn_key").isNotNull() & (F.col("op") != "boundary") & F.coalesce(F.col("_prev")["v"] == F.col("txn_key"), F.lit(False))
    return carry_last(seen, ["source_id"], ["pos"], F.when(~same, F.col("pos")), "run_start", width).drop("_prev")


def commits(changes: DataFrame, seed_time: str | None = None, width: int = WIDTH) -> DataFrame:
    """One row for each run of changes with effects: n_rows, n_controls, stop, at (first) and after (last) position.

    A boundary is a commit only if its token moved since the change before it; it has no rows, and its time is read
    from the token. after of a plain run is its own last token.
    """
    done = runs(changes, width)
    boundary = F.col("op") == "boundary"
    moved = previous(done, ["source_id"], ["pos"], F.col("resume_token"), "_token", width)
    kept = moved.where(~boundary | F.col("_token").isNull() | (F.col("_token")["v"] != F.col("resume_token")))
    time = F.when(boundary, token_time(F.col("resume_token"))).otherwise(F.col("cluster_time"))
    first, last = (f("_place", "pos") for f in (F.min_by, F.max_by))
    seed = F.lit(seed_time).alias("seed_cluster_time")
    found = kept.withColumn("_place", F.struct("resume_token", time.alias("cluster_time"))).groupBy("source_id", "run_start").agg(
        F.max("pos").alias("run_end"),
        F.count(F.when(F.col("effect") == "row", 1)).alias("n_rows"),
        F.count(F.when(F.col("effect") == "control", 1)).alias("n_controls"),
        first.alias("first"),
        last.alias("last"),
    )
    place = lambda c: F.to_json(F.struct(F.col(c)["resume_token"].alias("resume_token"), F.col(c)["cluster_time"].alias("cluster_time"), seed))
    return found.withColumn("stop", F.col("n_controls") > 0).withColumn("at_json", place("first")).withColumn("after_json", place("last")).drop("first", "last")


def until_stop(done: DataFrame, stops: bool = True) -> DataFrame:
    """Commits up to the first with a control event, that one included; stops=False: all."""
    if not stops:
        return done
    ends = done.where("stop").groupBy(F.col("source_id").alias("_source")).agg(F.min("run_start").alias("_stop"))
    return done.join(ends, done["source_id"] == F.col("_source"), "left").where(F.col("_stop").isNull() | (F.col("run_start") <= F.col("_stop"))).drop("_source", "_stop")


def n_parts(done: DataFrame, max_rows: int, width: int = WIDTH) -> DataFrame:
    """Runs of changes with effects and their parts under a row limit: (source_id, run_start, n_rows, n_parts).

    A full part goes out when any further change of the transaction comes, a filtered one too; so the last part may
    have no rows.
    """
    found = runs(done, width).groupBy("source_id", "run_start").agg(
        F.count(F.when(F.col("effect") == "row", 1)).alias("n_rows"), F.max("pos").alias("_end"), F.max(F.when(F.col("effect") == "row", F.col("pos"))).alias("_last_row")
    )
    full = F.floor(F.col("n_rows") / max_rows)
    exact = (F.col("n_rows") > 0) & (F.col("n_rows") % max_rows == 0)
    more = F.when(exact, (F.col("_end") > F.col("_last_row")).cast("long")).otherwise(1)
    return found.select("source_id", "run_start", "n_rows", (full + more).cast("int").alias("n_parts"))


def seed_and_tail(snapshot: DataFrame, tail: DataFrame, seed_t: int, seed_i: int) -> DataFrame:
    """A snapshot's documents as inserts at the noted time, then the changes from that time on.

    snapshot and tail: (source_id, subject, document, key); tail also t, i, op. Changes before the time are in the
    snapshot already; those at it are read again, since delivery is at least once.
    """
    seeded = snapshot.select("source_id", F.lit(0).alias("phase"), "subject", "key", F.lit("insert").alias("op"), "document", F.lit(seed_t).cast("long").alias("t"), F.lit(seed_i).cast("long").alias("i"))
    later = tail.where((F.col("t") > seed_t) | ((F.col("t") == seed_t) & (F.col("i") >= seed_i)))
    return seeded.unionByName(later.select("source_id", F.lit(1).alias("phase"), "subject", "key", "op", "document", "t", "i"))
