"""Interval sets."""

import random

import pytest

from logweave.operators import positions as p


def test_parse_print_and_union():
    assert p.print_set(p.parse_set("b:3, a:1-2:4-9:3")) == "a:1-9,b:3-3"
    assert p.union("abc:1-10:12-15", "abc:11") == "abc:1-15"
    assert p.union("", " ") == "" and p.union("a:1", "b:2") == "a:1-1,b:2-2"
    for bad in ("a", "a:0", "a:5-2", ":1", "a:x"):
        with pytest.raises(ValueError):
            p.parse_set(bad)


def test_set_after_fills_holes_and_repeats():
    assert p.set_after("abc:1-10:12-15", "abc:11") == "abc:1-15"
    assert p.set_after("abc:1-10", "abc:5") == "abc:1-10"
    assert p.set_after("", "abc:7") == "abc:7-7"


def test_handshake():
    assert p.handshake("a:10-12", "a:1-8", "a:1-3") == "a:1-8:10-12"
    assert p.handshake("a:10-12,b:1-3", None, "c:1-2") == "a:1-12,c:1-2"
    assert p.handshake("", "", "c:1-2") == "c:1-2"


def test_islands_and_running_sets(spark):
    wild = random.Random(2)
    some = sorted(wild.sample(range(1, 400), 250))
    ids = spark.createDataFrame([("u", g) for g in some] + [("v", 5)], "uuid string, gno long")
    want = p.merge([(g, g) for g in some])
    for width in (7, 64, 100_000):
        got = p.islands(ids.union(ids), ["uuid"], width=width).collect()
        assert sorted((r["lo"], r["hi"]) for r in got if r["uuid"] == "u") == want
        after = {r["gno"]: r for r in p.running_sets(ids.where("uuid = 'u'"), ["uuid"], "gno", width=width).collect()}
        text = ""
        for g in some:
            text = p.set_after(text, f"u:{g}")
            held = p.parse_set(text)["u"]
            assert (after[g]["n_intervals"], after[g]["lo"], after[g]["hi"]) == (len(held), *held[-1])


def test_union_rows(spark):
    spans = [("u", 1, 3), ("u", 4, 4), ("u", 2, 9), ("u", 11, 12), ("v", 1, 1)]
    got = p.union_rows(spark.createDataFrame(spans, "uuid string, lo long, hi long"), ["uuid"])
    assert sorted((r["uuid"], r["lo"], r["hi"]) for r in got.collect()) == [("u", 1, 9), ("u", 11, 12), ("v", 1, 1)]
    assert {r["uuid"]: r["text"] for r in p.set_text(got).collect()} == {"u": "u:1-9:11-12", "v": "v:1-1"}


def test_union_rows_over_several_buckets(spark):
    wild = random.Random(6)
    spans = [(u, lo, lo + wild.choice([0, 1, 2, 30])) for u in ("u", "v") for lo in wild.choices(range(2000), k=300)] + [("w", 1, 5000), ("w", 4000, 4001), ("w", 5001, 5001), ("w", 5003, 5003)]
    df = spark.createDataFrame(spans + spans[:50], "uuid string, lo long, hi long")
    want = sorted((u, *span) for u in ("u", "v", "w") for span in p.merge([(lo, hi) for v, lo, hi in spans if v == u]))
    for width in (3, 100, 1 << 16):
        assert sorted((r["uuid"], r["lo"], r["hi"]) for r in p.union_rows(df, ["uuid"], width).collect()) == want
