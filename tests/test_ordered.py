"""Scans along a log against plain windows, over several buckets and groups of buckets; and parts against a plain loop."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from logweave.functions.values import approx_bytes, row_bytes
from logweave.operators import ordered, parts


def test_scans_equal_plain_windows(spark):
    wild = random.Random(4)
    places = sorted(wild.sample(range(5 * 2 * ordered.GROUP), 300))
    rows = [(k, p, wild.choice([None, None, wild.randrange(100)])) for k in ("a", "b") for p in places]
    df = spark.createDataFrame(rows, "k string, pos long, v long")
    over = Window.partitionBy("k").orderBy("pos")
    so_far = over.rowsBetween(Window.unboundedPreceding, 0)
    for made, plain in (
        (ordered.carry_last(df, ["k"], ["pos"], F.col("v"), "x", 2), F.last("v", ignorenulls=True).over(so_far)),
        (ordered.previous(df, ["k"], ["pos"], F.col("v"), "x", 2), F.lag(F.struct(F.col("v").alias("v"))).over(over)),
        (ordered.running_sum(df, ["k"], ["pos"], F.coalesce("v", F.lit(0)), "x", 2), F.sum(F.coalesce("v", F.lit(0))).over(so_far)),
        (ordered.highest_before(df, ["k"], ["pos"], F.col("v"), "x", 2), F.max("v").over(over.rowsBetween(Window.unboundedPreceding, -1))),
    ):
        got, want = (sorted(map(str, d.select("k", "pos", "x").collect())) for d in (made, df.withColumn("x", plain)))
        assert got == want


def test_parts_equal_a_plain_loop(spark):
    wild = random.Random(5)
    rows = [(t, p, wild.choice([0, 1, 5, 30, 200])) for t in range(6) for p in range(wild.randrange(1, 400))]
    df = spark.createDataFrame(rows, "t long, pos long, size long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for limit, most in ((3, 50), (1, 10**6), (50, 100), (10, 1)):
            got = {(r["t"], r["pos"]): (r["part"], r["n_parts"]) for r in parts.by_size(df, ["t"], ["pos"], "size", limit, most).collect()}
            want, last = {}, {}
            for t, p, size in rows:
                part, n, full = last.get(t, (1, 0, 0))
                if n >= limit or n and full >= most:
                    part, n, full = part + 1, 0, 0
                last[t] = part, n + 1, full + size
                want[t, p] = part
            assert got == {k: (part, last[k[0]][0]) for k, part in want.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bytes_of_a_row_are_those_of_its_payload(spark):
    rows = [("insert", None, ['"é\\n\\"x"', "1", None]), ("update", ['"a"', "true", "2.5"], ['""', "null", "7"]), ("delete", ['"日本"', "1", "2"], None)]
    df = spark.createDataFrame([(op, ["a", "bé"], b, a) for op, b, a in rows], "op string, names array<string>, before array<string>, after array<string>")
    from logweave.operators.envelopes import row_data
    from logweave.functions.values import row_image
    import json

    for mode in ("full", "signal"):
        data = row_data(F.col("op"), row_image(F.col("names"), F.col("before")), row_image(F.col("names"), F.col("after")), mode)
        for r in df.select(data.alias("data"), row_bytes(F.col("op"), F.col("names"), F.col("before"), F.col("after"), mode).alias("size")).collect():
            assert r["size"] == approx_bytes(json.loads(r["data"])), r
