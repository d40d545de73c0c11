"""Sets of executed transactions as intervals, and resume positions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.operators.ordered import WIDTH, carry_last, highest_before, previous, running_sum

Intervals = dict[str, list[tuple[int, int]]]


def parse_set(text: str) -> Intervals:
    """uuid:a-b:c-d,uuid:... as sorted, merged intervals by uuid. An empty text is the empty set."""
    out: Intervals = {}
    for part in filter(None, (p.strip() for p in text.split(","))):
        uuid, *spans = part.split(":")
        if not spans or not uuid:
            raise ValueError(f"{part!r} isn't a set of transaction ids")
        for span in spans:
            m = re.fullmatch(r"(\d+)(?:-(\d+))?", span.strip())
            if not m or int(m[2] or m[1]) < int(m[1]) or m[1] == "0":
                raise ValueError(f"{span!r} isn't an interval")
            out.setdefault(uuid, []).append((int(m[1]), int(m[2] or m[1])))
    return {uuid: merge(spans) for uuid, spans in out.items()}


def print_set(sets: Intervals) -> str:
    """A single id prints as a-a; uuids are sorted."""
    return ",".join(":".join([uuid, *(f"{lo}-{hi}" for lo, hi in sets[uuid])]) for uuid in sorted(sets) if sets[uuid])


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Intervals that overlap or touch become one."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def union(*texts: str) -> str:
    held: Intervals = {}
    for text in texts:
        for uuid, spans in parse_set(text).items():
            held[uuid] = merge(held.get(uuid, []) + spans)
    return print_set(held)


def set_after(executed: str, gtid: str) -> str:
    """The set with one more transaction; the given one isn't changed."""
    uuid, _, number = gtid.rpartition(":")
    return union(executed, f"{uuid}:{int(number)}")


def handshake(checkpoint: str, baseline: str | None, purged: str) -> str:
    """What a reader tells the server that it has: purged, the baseline of its first connect, and the checkpoint.

    A checkpoint of old, without a baseline, is taken as everything up to its largest number, of that uuid alone.
    """
    if baseline:
        return union(purged, baseline, checkpoint)
    held = parse_set(checkpoint)
    if not held:
        return union(purged, checkpoint)
    uuid = max(held, key=lambda u: max(hi for _, hi in held[u]))
    return union(purged, f"{uuid}:1-{max(hi for _, hi in held[uuid])}")


def islands(ids: DataFrame, keys: list[str], number: str = "gno", width: int = WIDTH) -> DataFrame:
    """(keys, lo, hi): runs of consecutive numbers. Repeated ones count once."""
    seen = previous(ids.select(*keys, number).distinct(), keys, [number], F.col(number), "_prev", width)
    starts = F.when(F.col("_prev").isNull() | (F.col("_prev")["v"] < F.col(number) - 1), F.col(number))
    return carry_last(seen, keys, [number], starts, "lo", width).groupBy(*keys, "lo").agg(F.max(number).alias("hi"))


def running_sets(ids: DataFrame, keys: list[str], order: str, number: str = "gno", width: int = WIDTH) -> DataFrame:
    """ids, in log order with growing numbers, with the set after each: n_intervals, and the last one's lo and hi.

    The intervals before the last one are those of the rows before, so the set isn't repeated in every row.
    """
    seen = previous(ids, keys, [order], F.col(number), "_prev", width)
    new = F.col("_prev").isNull() | (F.col("_prev")["v"] < F.col(number) - 1)
    seen = carry_last(seen.withColumn("_new", new), keys, [order], F.when(F.col("_new"), F.col(number)), "lo", width)
    return running_sum(seen, keys, [order], F.col("_new").cast("long"), "n_intervals", width).withColumn("hi", F.col(number)).drop("_prev", "_new")


def union_rows(spans: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """(keys, lo, hi) merged where they overlap or touch, scanned in buckets of `lo`. Of spans with one lo the longest counts."""
    longest = spans.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))
    seen = highest_before(longest, keys, ["lo"], F.col("hi"), "_reach", width)
    starts = F.when(F.col("_reach").isNull() | (F.col("lo") > F.col("_reach") + 1), F.col("lo"))
    return carry_last(seen, keys, ["lo"], starts, "_start", width).groupBy(*keys, F.col("_start").alias("lo")).agg(F.max("hi").alias("hi"))


def set_text(spans: DataFrame, uuid: str = "uuid") -> DataFrame:
    """(uuid, text): each uuid's intervals printed."""
    ordered = F.sort_array(F.collect_list(F.struct("lo", "hi")))
    one = F.transform(ordered, lambda x: F.concat(x["lo"].cast("string"), F.lit("-"), x["hi"].cast("string")))
    return spans.groupBy(uuid).agg(F.concat(F.col(uuid), F.lit(":"), F.array_join(one, ":")).alias("text"))


def legacy_spans(spans: DataFrame, uuid: str = "uuid") -> DataFrame:
    """(uuid, lo, hi) of a checkpoint of old, without a baseline: all up to its largest number, of the uuid that has it."""
    top = spans.groupBy(uuid).agg(F.max("hi").alias("hi"))
    return top.agg(F.max_by(F.struct(uuid, F.lit(1).cast("long").alias("lo"), "hi"), F.struct("hi", uuid)).alias("_top")).where("_top is not null").select("_top.*")


def position_struct(adapter: Column, at: Column, after: Column) -> Column:
    return F.struct(adapter.alias("adapter"), at.alias("at_json"), after.alias("after_json"))


def derived_position(position: Column, gtid: Column, set_after_: Column) -> Column:
    """A commit's own position, or the one that its transaction id and set give."""
    at = F.to_json(F.struct(gtid.alias("gtid")))
    after = F.to_json(F.struct(set_after_.alias("gtid")))
    return F.coalesce(position, position_struct(F.lit("mysql"), at, after))
