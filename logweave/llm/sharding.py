"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm.common import literal_rows, own_columns, read, text_or_empty

#: Places on the ring: 60 bits of an MD5.
RING_BITS = 60


def ring_place(key: Column) -> Column:
    """A key's place on the ring; the place of a null is that of the word null."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("null"))), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise."""
    place = lambda name: int(hashlib.md5(name.encode()).hexdigest()[: RING_BITS // 4], 16)
    return sorted((place(f"shard {shard} node {node}"), shard) for shard in range(shards) for node in range(virtual_nodes))


def allot(ring_nodes: list[tuple[int, int]], arc_counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): who of each arc goes where.

    Arcs fill the shards in the ring's order. A shard holds floor(n / shards) keys, the first n mod shards one more;
    a key whose shard is full goes on clockwise to the next virtual node of one that isn't.
    """
    total = sum(arc_counts.values())
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    filled = [0] * shards
    out = []
    for arc in range(len(ring_nodes)):
        rank, left, at = 0, arc_counts.get(arc, 0), arc
        while left:
            shard = ring_nodes[at % len(ring_nodes)][1]
            if take := min(left, room[shard] - filled[shard]):
                out.append((arc, rank, rank + take, shard, filled[shard]))
                filled[shard] += take
                rank += take
                left -= take
            at += 1
    return out


@own_columns
def shard_rows(docs: DataFrame, shards: int = 16, virtual_nodes: int = 64, id_col: str = "doc_id", tie_cols: tuple[str, ...] = ("text",), cell_rows: int = 20_000) -> DataFrame:
    """docs with shard and slot: row counts of any two shards differ by one at most, slots run from 0 without gaps.

    A row's place is its id's hash; its arc ends at the next virtual node. Only arc totals (shards x virtual_nodes
    rows, whatever the input) reach the driver, which works out the overflow. A row's rank in its arc is the count of
    rows in earlier cells of the arc plus its rank in its own cell; cells are slices of the ring that get finer with
    the number of rows, so no task sorts more than about cell_rows of them. Ties in place go by id, then tie_cols, so
    repeated rows get slots of their own. Null ids share a place; any other column may be null; an empty table stays
    empty; columns shard and slot of the input are replaced.
    """
    spark = docs.sparkSession
    nodes = ring(shards, virtual_nodes)
    step = 1 << (RING_BITS - 14)
    slices = [(at, bisect.bisect_left(nodes, (at * step, -1)), [place for place, _ in nodes if at * step <= place < (at + 1) * step]) for at in range(1 << 14)]
    slices_df = literal_rows(spark, [s for s in slices if s[2]], "_slice long,_arc0 long,_ends array<long>")
    plain = literal_rows(spark, [s[:2] for s in slices if not s[2]], "_slice long,_arc0 long").withColumn("_ends", F.array().cast("array<long>"))
    cells = 1 << max(10, (docs.count() // cell_rows).bit_length())
    placed = (
        docs.drop("shard", "slot")
        .withColumn("_place", ring_place(F.col(id_col)))
        .withColumn("_slice", F.shiftright("_place", RING_BITS - 14))
        .join(F.broadcast(slices_df.unionByName(plain)), "_slice")
        .withColumn("_arc", ((F.col("_arc0") + F.size(F.filter("_ends", lambda end: end < F.col("_place")))) % len(nodes)).cast("int"))
        .withColumn("_cell", F.shiftright("_place", RING_BITS - (cells.bit_length() - 1)))
        # the arc that crosses zero starts at the ring's end
        .withColumn("_cell", F.when((F.col("_arc") == 0) & (F.col("_place") > nodes[0][0]), F.col("_cell") - cells).otherwise(F.col("_cell")))
        .drop("_slice", "_arc0", "_ends")
    )
    counted = placed.groupBy("_arc", "_cell").agg(F.count("*").alias("_rows"))
    arcs = {row[0]: row[1] for row in counted.groupBy("_arc").agg(F.sum("_rows")).collect()}
    before = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(Window.partitionBy("_arc").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_rows")
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("_arc", "_cell").orderBy("_place", id_col, *tie_cols)))
    shares = literal_rows(spark, allot(nodes, arcs, shards), "_of long,_from long,_to long,shard int,_slot long")
    at = ranked.join(before.withColumnsRenamed({"_arc": "_a", "_cell": "_c"}), (F.col("_arc") == F.col("_a")) & (F.col("_cell") == F.col("_c"))).withColumn("_rank", F.col("_rank") - 1 + F.col("_before"))
    return (
        at.join(F.broadcast(shares), (F.col("_arc") == F.col("_of")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .withColumn("slot", F.col("_slot") + F.col("_rank") - F.col("_from"))
        .drop("_place", "_arc", "_cell", "_rank", "_a", "_c", "_before", "_of", "_from", "_to", "_slot")
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = text_or_empty("text")
    narrow = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    # size and CRC stand for the text in ties, so no text is moved
    done = shard_rows(narrow, tie_cols=("size", "text_crc32"))
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
