"""Commits rebuilt from a log of begin, row, statement and end events.

Log columns: source_id, pos, inner_pos (order), kind (gtid, query, table_map, rows, xid, other), gtid, uuid, gno,
schema_name, query, table_id, database, table, columns, op, before, after. A gtid event begins a transaction that
ends at the first event that commits it; what begins again before that was never committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.statements import opens_transaction, query_kind
from logweave.functions.values import subject
from logweave.operators.ordered import WIDTH, carry_last

TXN = ["source_id", "txn_start"]


def written(df: DataFrame) -> DataFrame:
    """df, written to the folder that spark.checkpoint.dir names, as several branches read it; as it is without such a folder."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            return df
        spark.sparkContext.setCheckpointDir(shared)
    return df.checkpoint(eager=True)


def _at():
    return F.struct("pos", "inner_pos")


def unpack(log: DataFrame) -> DataFrame:
    """Compressed payload events replaced by the events inside, in order. An empty payload is an error."""
    plain = log.where(F.col("kind") != "payload").drop("payload")
    inside = log.where(F.col("kind") == "payload")
    full = F.when(F.coalesce(F.size("payload"), F.lit(0)) <= 0, F.raise_error(F.lit("a compressed payload holds no events"))).otherwise(F.col("payload"))
    opened = inside.select("source_id", "pos", F.posexplode(full).alias("_k", "_event"))
    fields = inside.schema["payload"].dataType.elementType.names
    return plain.unionByName(opened.select("source_id", "pos", F.col("_k").alias("inner_pos"), *[F.col("_event")[f].alias(f) for f in fields]), allowMissingColumns=True)


def with_table_maps(log: DataFrame, width: int = WIDTH) -> DataFrame:
    """Row events with the database, table and columns of the latest map of their table_id; those of unknown tables go.

    Maps are upserted and never cleared, so a map may be of an earlier transaction.
    """
    told = F.when(F.col("kind") == "table_map", F.struct("database", "table", "columns"))
    both = carry_last(log.where(F.col("kind").isin("table_map", "rows")), ["source_id", "table_id"], ["pos", "inner_pos"], told, "_map", width)
    rows = both.where((F.col("kind") == "rows") & F.col("_map").isNotNull())
    return rows.withColumns({c: F.col("_map")[c] for c in ("database", "table", "columns")}).withColumn("subject", subject(F.col("database"), F.col("table"))).drop("_map")


def marked(log: DataFrame, width: int = WIDTH) -> DataFrame:
    """The log with txn_start, the position of the gtid event that each event comes under (null before the first)."""
    return carry_last(log, ["source_id"], ["pos", "inner_pos"], F.when(F.col("kind") == "gtid", F.col("pos")), "txn_start", width)


def endings(log: DataFrame) -> DataFrame:
    """One row for each transaction of a marked log: gtid, uuid, gno, opened, ended (struct<pos, inner_pos>) and ended_by.

    BEGIN and the like open; so does a DDL statement that ends with START TRANSACTION. While it is not open, any other
    DDL statement and any other statement at all commits; an xid and COMMIT always do. ROLLBACK does nothing: what was
    read stays until the next gtid. ended is null for what was never committed.
    """
    kind = F.when(F.col("kind") == "query", query_kind(F.col("query")))
    opens = (kind == "begin") | ((kind == "ddl") & opens_transaction(F.col("query")))
    ends = (F.col("kind") == "xid") | (kind == "commit")
    alone = (kind == "other") | ((kind == "ddl") & ~opens_transaction(F.col("query")))
    by = F.when(F.col("kind") == "xid", "xid").otherwise(kind)
    told = log.where(F.col("txn_start").isNotNull() & F.col("kind").isin("gtid", "query", "xid")).groupBy(*TXN).agg(
        *[F.max(F.when(F.col("kind") == "gtid", F.col(c))).alias(c) for c in ("gtid", "uuid", "gno")],
        F.min(F.when(opens, _at())).alias("opened"),
        F.min(F.when(ends, F.struct("pos", "inner_pos", by.alias("by")))).alias("_end"),
        F.min(F.when(alone, F.struct("pos", "inner_pos", by.alias("by")))).alias("_alone"),
    )
    place = lambda c: F.struct(F.col(c)["pos"].alias("pos"), F.col(c)["inner_pos"].alias("inner_pos"))
    alone_ends = F.col("_alone").isNotNull() & (F.col("opened").isNull() | (place("_alone") < F.col("opened")))
    first = F.when(alone_ends & (F.col("_end").isNull() | (F.col("_alone") < F.col("_end"))), F.col("_alone")).otherwise(F.col("_end"))
    return told.withColumn("_first", first).select(*TXN, "gtid", "uuid", "gno", "opened", F.when(F.col("_first").isNotNull(), place("_first")).alias("ended"), F.col("_first")["by"].alias("ended_by"))


def committed_rows(log: DataFrame, ends: DataFrame, width: int = WIDTH) -> DataFrame:
    """Row events of committed transactions of a marked log, with gtid, uuid, gno and ended."""
    known = with_table_maps(log, width)
    return known.drop("gtid", "uuid", "gno").join(ends.where("ended is not null").select(*TXN, "gtid", "uuid", "gno", "ended"), TXN).where(_at() < F.col("ended"))


def committed_ddl(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Schema statements of committed transactions of a marked log."""
    ddl = log.where((F.col("kind") == "query") & (query_kind(F.col("query")) == "ddl")).select(*TXN, "pos", "inner_pos", "schema_name", "query")
    return ddl.join(ends.where("ended is not null").select(*TXN, "gtid", "gno", "ended"), TXN).where(_at() <= F.col("ended"))


def commits(log: DataFrame, only: frozenset[str] | None = None, versions: DataFrame | None = None, width: int = WIDTH) -> DataFrame:
    """One row for each commit, those without rows too: source_id, txn_start, gtid, uuid, gno, ended, ended_by, n_rows, n_ddl.

    only: the subjects whose rows count (None: all); versions: instead of it, the list's versions, pinned where each
    transaction began. Schema statements are never filtered.
    """
    log = written(marked(log, width))
    ends = endings(log)
    return commits_of(log, ends, committed_rows(log, ends, width), only, versions)


def commits_of(log: DataFrame, ends: DataFrame, rows: DataFrame, only: frozenset[str] | None = None, versions: DataFrame | None = None) -> DataFrame:
    """As commits, of a marked log whose endings and committed rows are there already."""
    from logweave.operators.include import allows, pinned

    rows = pinned(rows, versions).where("included") if versions is not None else rows.where(allows(F.col("subject"), only))
    events = rows.select(*TXN, F.lit(1).alias("row"), F.lit(0).alias("ddl")).unionByName(committed_ddl(log, ends).select(*TXN, F.lit(0).alias("row"), F.lit(1).alias("ddl")))
    counts = events.groupBy(*TXN).agg(F.sum("row").alias("n_rows"), F.sum("ddl").alias("n_ddl"))
    whole = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_rows", "n_ddl")}
    return ends.where("ended is not null").drop("opened").join(counts, TXN, "left").withColumns(whole)


def violations(log: DataFrame, only: frozenset[str] | None = None, width: int = WIDTH) -> DataFrame:
    """(source_id, pos, inner_pos, error): included rows, schema statements and xids outside a transaction.

    A strict reader stops at the first of them. Rows of unknown or unlisted tables are no error.
    """
    from logweave.operators.include import allows

    log = marked(log, width)
    ends = endings(log).select(*TXN, "ended")
    rows = with_table_maps(log, width).where(allows(F.col("subject"), only)).select(*TXN, "pos", "inner_pos", F.lit("row event without a transaction").alias("error"))
    query = (F.col("kind") == "query") & (query_kind(F.col("query")) == "ddl")
    others = log.where(query | (F.col("kind") == "xid")).select(
        *TXN, "pos", "inner_pos", F.when(query, "schema statement without a transaction").otherwise("commit without a transaction").alias("error")
    )
    joined = rows.unionByName(others).join(ends, TXN, "left")
    return joined.where(F.col("txn_start").isNull() | (_at() > F.col("ended"))).select("source_id", "pos", "inner_pos", "error")
