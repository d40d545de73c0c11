"""Change logs derived from the tables of a star schema: always the same log for the same tables.

An order is a transaction at position 64 x its key, its line items are the row events; every 50th order has one of
several special shapes. The events table is a stream of document changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.functions.values import epoch_millis

SOURCE, UUID, STEPS = "shop-1", "3e11fa47-71ca-11e1-9e33-c80aa9429562", 64
#: Shapes by order key modulo 50: how the transaction begins and ends; all others are BEGIN ... xid.
ALTER, GRANT, ROLLED_BACK, COMMITTED, XA, CREATED_AS, UNENDED = 7, 13, 19, 23, 29, 31, 37
TABLES = {"A": (1, "items"), "N": (2, "lines"), "R": (3, "returns")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event(step, kind: str, **fields):
    kinds = {"gtid": "string", "uuid": "string", "gno": "long", "schema_name": "string", "query": "string", "table_id": "long", "database": "string", "table": "string", "columns": "array<string>"}
    return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), *[fields.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of all orders, as operators.assemble reads it."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status")).withColumn("shape", F.pmod("k", F.lit(50)))
    shape, gno = F.col("shape"), F.col("k") + 1
    opening = F.when(shape == ALTER, "ALTER TABLE shop.orders ADD COLUMN c INT").when(shape == GRANT, "GRANT SELECT ON shop.* TO reader").when(shape == XA, "XA START 'x'").when(
        shape == CREATED_AS, "CREATE TABLE shop.copy (a INT) START TRANSACTION"
    ).otherwise("BEGIN")
    closing = F.when(shape == ROLLED_BACK, "ROLLBACK").when(shape == COMMITTED, "COMMIT").when(shape == XA, "XA END 'x'")
    query = lambda step, text: _event(step, "query", schema_name=F.lit("shop"), query=text)
    named = F.array(*[F.lit(c) for c in ("part", "supp", "line", "qty")])
    maps = [
        _event(2, "table_map", table_id=F.lit(i), database=F.lit("shop"), table=F.lit(name), columns=named if i < 3 else F.array().cast("array<string>")) for i, name in TABLES.values()
    ]
    plain = ~shape.isin(ALTER, GRANT)
    steps = F.array_compact(F.array(
        _event(0, "gtid", gtid=F.concat(F.lit(f"{UUID}:"), gno.cast("string")), uuid=F.lit(UUID), gno=gno),
        query(1, opening),
        *[F.when(plain, m) for m in maps],
        F.when(closing.isNotNull(), query(62, closing)),
        F.when(plain & ~shape.isin(ROLLED_BACK, COMMITTED, XA, UNENDED), _event(62, "xid")),
    ))
    told = orders.select("k", F.inline(steps)).withColumn("op", F.lit(None).cast("string"))
    for image in ("before", "after"):
        told = told.withColumn(image, F.lit(None).cast("array<string>"))
    lines = table(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    cells = lambda qty: F.array(*[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_linenumber")], qty)
    quantity = F.concat(F.lit('"'), F.col("l_quantity").cast("decimal(12,2)").cast("string"), F.lit('"'))
    table_id = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3)
    op = F.when(F.col("status") == "O", "insert").when(F.col("status") == "F", "update").otherwise("delete")
    rows = (
        lines.withColumn("step", 2 + F.row_number().over(order))
        .join(orders.where(plain), F.col("l_orderkey") == F.col("k"))
        .select("k", "step", F.lit("rows").alias("kind"), table_id.cast("long").alias("table_id"), op.alias("op"),
                F.when(F.col("status") != "O", cells(F.lit('"0.00"'))).alias("before"), F.when(F.col("status").isin("O", "F"), cells(quantity)).alias("after"))
    )
    both = told.unionByName(rows, allowMissingColumns=True)
    inner = F.when(F.col("kind") == "table_map", F.col("table_id") - 1).otherwise(0).cast("int")
    return both.select(F.lit(SOURCE).alias("source_id"), (F.col("k") * STEPS + F.col("step")).alias("pos"), inner.alias("inner_pos"), *[c for c in both.columns if c not in ("k", "step")])


def packed_log(log: DataFrame) -> DataFrame:
    """The same log with all of a transaction but its gtid event inside one compressed payload event."""
    inside = [c for c in log.columns if c not in ("source_id", "pos", "inner_pos")]
    key = F.floor(F.col("pos") / STEPS)
    packed = log.where("kind <> 'gtid'").groupBy("source_id", key.alias("k")).agg(F.sort_array(F.collect_list(F.struct("pos", "inner_pos", F.struct(*inside).alias("event")))).alias("events"))
    payload = packed.select("source_id", (F.col("k") * STEPS + 1).cast("long").alias("pos"), F.lit(0).alias("inner_pos"), F.lit("payload").alias("kind"), F.transform("events", lambda x: x["event"]).alias("payload"))
    return log.where("kind = 'gtid'").unionByName(payload, allowMissingColumns=True)


def document_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as document changes, as operators.documents reads them: seven in ten in transactions of seven."""
    e = F.col("event_id")
    t = F.floor(epoch_millis(F.col("ts")) / 1000)
    hex8 = lambda c: F.lower(F.lpad(F.hex(c), 8, "0"))
    error = F.element_at(F.array(*[F.lit(x) for x in ("drop", "rename", "drop_database", "invalidate", "other")]), (e % 5 + 1).cast("int"))
    op = F.when(F.col("event_type") == "click", "update").when(F.col("event_type") == "view", "insert").when(F.col("event_type") == "purchase", "replace").when(F.col("event_type") == "signup", "delete").otherwise(error)
    collection = F.when(e % 89 == 0, "system.views").when(e % 97 != 0, F.concat(F.lit("c"), (F.col("user_id") % 4).cast("string")))
    return table(spark, sf_dir, "events").select(
        F.lit("docs-1").alias("source_id"),
        e.alias("pos"),
        op.alias("op"),
        F.lit("app").alias("database"),
        collection.alias("collection"),
        F.when(e % 2 == 0, "app2").alias("to_database"),
        F.when(e % 3 == 0, "moved").alias("to_collection"),
        F.when(e % 59 != 0, F.concat(F.lit('{"_id":'), e.cast("string"), F.lit("}"))).alias("document_key"),
        F.when(e % 53 != 0, F.concat(F.lit('{"_id":'), e.cast("string"), F.lit(',"user":'), F.col("user_id").cast("string"), F.lit("}"))).alias("full_document"),
        F.when(e % 70 < 49, F.concat(F.lit("s:"), F.floor(e / 7).cast("string"))).alias("txn_key"),
        F.concat(F.lit("82"), hex8(t), hex8(e)).alias("resume_token"),
        F.struct(t.alias("t"), e.alias("i")).alias("cluster_time"),
    )
