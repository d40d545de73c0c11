"""What several corpus operators share."""

from __future__ import annotations

import gc
import os
import tempfile
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words.
SPACE = " \t\n\x0b\f\r"
#: An ASCII upper-case letter and its lower-case letter, place by place.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where a missing integer id sorts: after every other.
LAST_ID = 2**63 - 1


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_or_last(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def let(value: Column, then) -> Column:
    """`then(value)` with `value` computed once."""
    return F.transform(F.array(value), then)[0]


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as spark.checkpoint.dir names it; in local mode one may be made."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="checkpoints-")


def durable(df: DataFrame) -> DataFrame:
    """df, written to the folder that the cluster's executors share, and cut from its lineage."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def shuffles_freed(spark: SparkSession) -> None:
    """Shuffle files of what isn't referred to any more go: Spark deletes them only after the driver has collected its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def deleted_at_the_end(spark: SparkSession, path: str) -> str:
    """path, a folder that goes when the driver ends."""
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(made)
    return path


def written_table(df: DataFrame) -> DataFrame:
    """df as durable gives it, but as a Parquet table: for many rows, as checkpoints aren't compressed."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{os.urandom(8).hex()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(deleted_at_the_end(spark, path))


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of one's own, made of the given ones, that df doesn't have in any case of letters."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in held:
            name += "_"
        out.append(name)
    return out


def literal_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A few rows from the driver as a constant of the plan."""
    import json

    fields = [part.split()[0] for part in schema.split(",")]
    text = json.dumps([dict(zip(fields, row, strict=True)) for row in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{','.join(':'.join(p.split()) for p in schema.split(','))}>>")))


def own_columns(operator):
    """An operator on docs whose columns that begin with an underscore don't meet its own ones, which all do.

    Such columns, and arguments that name them, have other names while it runs, and come out under their own.
    """

    @wraps(operator)
    def run(docs: DataFrame, *args, **how) -> DataFrame:
        theirs = [c for c in docs.columns if c.startswith("_")]
        if not theirs:
            return operator(docs, *args, **how)
        meanwhile = dict(zip(theirs, fresh_names(docs, *[f"theirs{k}" for k in range(len(theirs))]), strict=True))
        named = lambda x: meanwhile.get(x, x) if isinstance(x, str) else tuple(map(named, x)) if isinstance(x, tuple) else x
        done = operator(docs.withColumnsRenamed(meanwhile), *map(named, args), **{k: named(v) for k, v in how.items()})
        return done.withColumnsRenamed({new: old for old, new in meanwhile.items()})

    return run
