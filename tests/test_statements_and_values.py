"""Scalar functions, on columns and in Python alike."""

import json

import pytest
from pyspark.sql import functions as F

from logweave.functions import statements, values
from logweave.streaming import assembler

CASES = [
    ("BEGIN", "begin", False), ("  start transaction ;", "begin", True), ("commit", "commit", False), ("ROLLBACK;", "rollback", False), ("rollback to savepoint a", "other", False),
    ("/* a */ -- b\n# c\nCREATE USER x", "ddl", False), ("/*!50503 DROP TABLE t */", "ddl", False), ("/* open CREATE TABLE t", "other", False), ("-- open", "other", False), ("--x", "other", False),
    ("XA START 'a'", "begin", False), ("xa begin 'a'", "begin", False), ("XA COMMIT 'a'", "other", False), ("CREATE TABLE t (a INT) START TRANSACTION", "ddl", True), ("", "other", False),
    ("GRANT ALL", "other", False), ("ANALYZE TABLE t", "other", False), ("truncate t", "ddl", False), ("CREATE TABLE t START  transaction ;", "ddl", True),
]


def test_statements(spark):
    df = spark.createDataFrame([(q,) for q, _, _ in CASES], "q string")
    got = df.select("q", statements.query_kind(F.col("q")).alias("k"), statements.opens_transaction(F.col("q")).alias("o")).collect()
    assert [(r["q"], r["k"], r["o"]) for r in got] == CASES
    assert [assembler.query_kind(q) for q, _, _ in CASES] == [k for _, k, _ in CASES]


def test_cells(spark):
    row = spark.sql("SELECT 1 i, 1.5D d, cast('12.30' as decimal(10,2)) m, X'ff00' b, 'a\"b' s, timestamp_micros(5) t, cast(null as int) n")
    got = row.select(
        values.cell_json(F.col("i"), "long").alias("i"), values.cell_json(F.col("d"), "double").alias("d"), values.cell_json(F.col("m"), "decimal").alias("m"), values.cell_json(F.col("b"), "blob").alias("b"),
        values.cell_json(F.col("s"), "string").alias("s"), values.cell_json(F.col("t"), "timestamp").alias("t"), values.cell_json(F.col("n"), "long").alias("n"),
    ).first()
    assert tuple(got) == ("1", "1.5", '"12.30"', '"hex:ff00"', '"a\\"b"', "5", "null")
    with pytest.raises(ValueError):
        values.cell_json(F.col("i"), "unknown")


def test_row_image_names_and_nulls(spark):
    df = spark.createDataFrame([(["a", None], ["1", None, '"x"']), ([], []), (["a"], None)], "names array<string>, cells array<string>")
    got = [r[0] for r in df.select(values.row_image(F.col("names"), F.col("cells"))).collect()]
    assert json.loads(got[0]) == {"a": 1, "col_1": None, "col_2": "x"} and got[1] == "{}" and got[2] is None


def test_tokens_and_subjects(spark):
    df = spark.createDataFrame([("8265920000" + "0000000a" + "ff",), ("826592000000000",), ("83" + "0" * 16,), ("82" + "g" * 16,), (None,)], "t string")
    assert [r[0] and tuple(r[0]) for r in df.select(values.token_time(F.col("t"))).collect()] == [(0x65920000, 10), None, None, None, None]
    assert values.parse_subject("a.b.c") == ("a", "b.c")
    for bad in ("a", ".b", "a.", ""):
        with pytest.raises(ValueError):
            values.parse_subject(bad)
    assert values.approx_bytes({"k": "é", "l": [1, None, True], "m": {"n": "xy"}}) == 1 + 2 + 1 + 24 + 1 + 1 + 2
