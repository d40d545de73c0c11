"""Long transactions cut into parts of bounded rows and bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS, MAX_BYTES = 10_000, 16 << 20


def by_rows(rows: DataFrame, txn: list[str], order: list[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """rows with part (from 1) and n_parts: a part is full at max_rows, and goes out only when another row comes."""
    limit = max_rows or MAX_ROWS
    own = Window.partitionBy(*txn)
    return rows.withColumn("part", F.ceil(F.row_number().over(own.orderBy(*order)) / limit).cast("int")).withColumn("n_parts", F.max("part").over(own))


def cut_places(sizes: np.ndarray, rows: int, size: int, limit: int, most: int) -> tuple[np.ndarray, int, int]:
    """(how many parts ended before each row, rows and bytes of the last part) of rows of one transaction, in order.

    rows and size are what the part has that the first row may go into. One search for each part, not one step a row.
    """
    ends = np.concatenate([[0], np.cumsum(sizes)])
    cuts, at = [], 0
    while at < len(sizes):
        # the part that begins or goes on here is full at the first place with enough rows, or with a row and enough bytes
        full = min(at + max(limit - rows, 0), max(int(np.searchsorted(ends, ends[at] + most - size)), at + (rows == 0)))
        if full >= len(sizes):
            rows, size = rows + len(sizes) - at, size + int(ends[-1] - ends[at])
            break
        cuts.append(full)
        at, rows, size = full, 0, 0
    out = np.zeros(len(sizes), np.int64)
    np.add.at(out, cuts, 1)
    return np.cumsum(out), rows, size


def by_size(rows: DataFrame, txn: list[str], order: list[str], size: str, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """rows with part and n_parts: before the next row, a part that has max_rows rows or max_bytes bytes goes out.

    A transaction's keys, places and sizes are sorted (that spills) and walked once, Arrow batch by batch, with its
    part, rows and bytes carried on: a long one is never held as a whole. A part may pass max_bytes by its last row.
    0 means the default. Rows with a null in txn or order are not kept; places that repeat in a transaction aren't allowed.
    """
    limit, most = max_rows or MAX_ROWS, max_bytes or MAX_BYTES
    thin = rows.select(*txn, *order, F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_size"))
    names = [*txn, *order]

    def walk(batches):
        held, part, n, full = None, 1, 0, 0
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in txn), strict=True))
            sizes = batch.column("_size").to_numpy(zero_copy_only=False)
            out = np.zeros(len(keys), np.int64)
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for low, high in zip(edges, edges[1:], strict=False):
                if low == high:
                    continue
                if keys[low] != held:
                    held, part, n, full = keys[low], 1, 0, 0
                steps, n, full = cut_places(sizes[low:high], n, full, limit, most)
                out[low:high] = part + steps
                part = int(out[high - 1])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(out, pa.int32())], [*names, "part"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in thin.select(*names).dtypes)
    cut = thin.repartition(*txn).sortWithinPartitions(*names).mapInArrow(walk, f"{fields}, part int")
    last = cut.groupBy(*txn).agg(F.max("part").alias("n_parts"))
    return rows.drop("part", "n_parts").join(cut, names).join(last, txn)


def part_columns(parts: DataFrame) -> DataFrame:
    """Parts (part, n_parts) as they are delivered: part_number and part_last, both null for a transaction in one part."""
    several = F.col("n_parts") > 1
    return parts.withColumn("part_number", F.when(several, F.col("part"))).withColumn("part_last", F.when(several, F.col("part") == F.col("n_parts")))
