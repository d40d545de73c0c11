"""Columns of the input that have the names of an operator's own ones come out as they were."""

import pytest
from pyspark.sql import functions as F

from logweave.llm import decontaminate, lines, packing, passages, quality, sharding, simhash

TEXT = " ".join(f"word{k}" for k in range(70)) + "."
NAMES = ["_id", "_lines", "_dropped", "_of", "_as", "_words", "_hashes", "_place", "_rank", "_slot", "_hit", "_items", "_doc", "_node", "_cell", "_turn"]


@pytest.mark.parametrize("operator", [lines.dedup_lines, quality.clean_lines, quality.kept_documents, sharding.shard_rows, simhash.keep_one, simhash.keep_similar_one, passages.without_passages, decontaminate.decontaminate])
def test_operators(spark, operator):
    rows = spark.createDataFrame([(1, TEXT), (2, TEXT + " More.")], "doc_id long, text string").select("*", *[F.concat(F.lit(f"own{k}-"), F.col("doc_id").cast("string")).alias(n) for k, n in enumerate(NAMES)])
    more = (spark.createDataFrame([("i", "a b c")], "item_id string, text string"),) if operator is decontaminate.decontaminate else ()
    got = operator(rows, *more).collect()
    assert got and all(r[n] == f"own{k}-{r['doc_id']}" for r in got for k, n in enumerate(NAMES))
    # an id of such a name
    renamed = rows.drop("_id").withColumnRenamed("doc_id", "_id")
    if operator not in (quality.clean_lines, quality.kept_documents, decontaminate.decontaminate):
        assert {r["_id"] for r in operator(renamed, *more, id_col="_id").collect()} <= {1, 2}


def test_packing(spark):
    rows = spark.createDataFrame([(k, 0, 0, 10 + k, 5, "own", "other") for k in range(20)], "id long, piece int, start long, length long, crc long, _cell string, _rank string")
    got = packing.pack(rows, 64).collect()
    assert len(got) == 20 and {(r["_cell"], r["_rank"]) for r in got} == {("own", "other")}
