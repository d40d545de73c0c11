"""SimHash fingerprints and links against brute force."""

import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from logweave.llm import simhash
from logweave.llm.components import components


def plain_fingerprint(text, width=3):
    words = (text or "").encode().translate(simhash.words.LOWERED).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    ones = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle, 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


def plain_components(ids, prints, distance):
    least = dict(enumerate(ids))
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            ra, rb = find(a), find(b)
            if ra != rb:
                root[rb] = ra
                least[ra] = min(least[ra], least[rb])
    return [least[find(k)] for k in range(len(ids))]


def plain_similar(texts, similarity, width=5):
    """{id: smallest id that pairs of at least that Jaccard similarity of shingles lead to}."""
    sets = {}
    for i, text in texts.items():
        words = (text or "").lower().split()
        sets[i] = {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else {()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(texts), 2):
        common = len(sets[a] & sets[b])
        if common >= similarity * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def texts(n=120):
    wild = random.Random(11)
    bank = [f"w{k}" for k in range(60)] + ["Ünï", "ẞ", "ABC", "x y"]
    out = ["", None, " \n\t", "one", "One two", "a b c", "A  B\tC"]
    for _ in range(n):
        out.append(" ".join(wild.choice(bank) for _ in range(wild.randrange(1, 80))))
    for k in range(60):
        words = (out[7 + k % 20] or "").split(" ")
        words[wild.randrange(len(words))] = wild.choice(bank)
        out.append(" ".join(words))
    out.append(" ".join(wild.choice(bank) for _ in range(140_000)))  # more shingles than one block of bits
    return out + out[:40] + ["same words again and again here"] * 50


def test_fingerprints_and_components_equal_brute_force(spark):
    some = texts()
    docs = spark.createDataFrame([(3 * k, t, "x", 1) for k, t in enumerate(some)], "doc_id long, text string, fp string, component int")
    got = {r["id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_fingerprint(t) for t in some]
    want = plain_components([3 * k for k in range(len(some))], prints, 3)
    assert [got[3 * k]["fp"] & (2**64 - 1) for k in range(len(some))] == prints
    assert [got[3 * k]["component"] for k in range(len(some))] == want


def test_links_are_all_pairs_within_the_distance(spark):
    wild = np.random.default_rng(2)
    centres = wild.integers(0, 2**63, 12, dtype=np.uint64)
    prints = set()
    for centre in centres.tolist():
        for _ in range(40):
            prints.add(centre ^ sum({1 << int(b) for b in wild.integers(0, 64, wild.integers(0, 6))}))
    prints = sorted(prints)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    rows = spark.createDataFrame([(s, s) for s in signed], "rep long, fp long")
    for distance, parts in ((3, 2), (3, 4), (2, 3), (1, 2)):
        want = {tuple(sorted((signed[a], signed[b]))) for a, b in itertools.combinations(range(len(prints)), 2) if (prints[a] ^ prints[b]).bit_count() <= distance}
        got = [(r["a"], r["b"]) for r in simhash.links(rows, distance, parts).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_thresholds_are_the_cheapest_that_miss_nothing():
    wild = np.random.default_rng(7)
    for parts, distance in ((2, 3), (3, 3), (4, 3), (3, 5)):
        costs = np.cumsum(wild.random((20, parts, distance + 2)), axis=2)
        got = simhash.allocate(costs, distance)
        assert (got.sum(axis=1) == distance - parts + 1).all()
        for k in range(20):
            options = [t for t in itertools.product(range(-1, distance + 1), repeat=parts) if sum(t) == distance - parts + 1]
            cost = lambda t: sum(costs[k, part, level + 1] for part, level in enumerate(t))  # noqa: B023, E731
            assert abs(cost(got[k]) - min(map(cost, options))) < 1e-9


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "other words in this one"), (None, None), (9, "")], "doc_id long, text string")
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == 5
    assert {(r["id"], r["component"]) for r in got} == {(None, 5), (5, 5), (None, 9), (9, 9)}
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components_of_paths_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(61)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similar_documents_are_found(spark):
    wild = random.Random(21)
    fresh = lambda n: [f"u{wild.randrange(10**6)}" for _ in range(n)]
    told, pairs = [], []
    for k in range(150):
        body = fresh(wild.randrange(60, 400))
        near = list(body)
        for at in wild.sample(range(len(body)), max(1, len(body) // 100)):
            near[at] = "changed"
        told += [body, near]
        pairs.append((2 * k, 2 * k + 1))
    told += [fresh(3), fresh(1), [], [], fresh(900), ["x"] * 500, ["x"] * 700]
    told += [told[0]] * 30
    rows = {k: " ".join(t) for k, t in enumerate(told)}
    docs = spark.createDataFrame(list(rows.items()) + [(None, None), (None, "one only")], "doc_id long, text string").withColumn("_id", F.lit("own"))
    got = {r["id"]: r["component"] for r in simhash.similar_documents(docs).collect()}
    want = plain_similar(rows, 0.8)
    assert {i for i in rows if got[i] != want[i] and want[i] == i} == set()  # nothing is linked that isn't alike
    alike = [i for i in rows if want[i] != i]
    assert len(alike) > 140 and sum(got[i] == want[i] for i in alike) >= 0.98 * len(alike)
    kept = simhash.keep_similar_one(docs)
    assert kept.columns == docs.columns and {r["_id"] for r in kept.collect()} == {"own"}
    assert simhash.keep_similar_one(docs.limit(0)).collect() == []
    assert simhash.keep_one(docs).columns == docs.columns


def test_a_large_group_of_near_copies_is_one(spark):
    wild = random.Random(22)
    body = [f"u{wild.randrange(10**6)}" for _ in range(300)]
    rows = []
    for k in range(1500):
        near = list(body)
        for at in wild.sample(range(300), 2):
            near[at] = f"e{wild.randrange(10**6)}"
        rows.append((k, " ".join(near)))
    got = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum(r["component"] == 0 for r in got) >= 0.99 * len(rows)


def test_no_similar_pair_is_left_out(spark):
    wild = random.Random(23)
    fresh = lambda n: [f"u{wild.randrange(10**6)}" for _ in range(n)]
    told = []
    for k in range(60):
        body, share = fresh(104), 11
        # 100 shingles, of which the ends of two keep 89 each: at 89 / 111 they are just alike; every other one is alike to neither end
        told += [body, body[: 104 - share] + fresh(share), fresh(4) + body[4 + k % 7 :], fresh(50) + body[50:]]
    told += [[*x, "more"] for x in told[::9]] + [["a", "b"], ["a", "b"], ["c"], [], []]
    rows = {k: " ".join(t) for k, t in enumerate(told)}
    want = plain_similar(rows, 0.8)
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for recall in (0.97, 0.01):  # what SimHash leaves out the prefixes find
        assert {r["id"]: r["component"] for r in simhash.similar_documents(docs, recall=recall).collect()} == want


def test_prefixes_miss_nothing_and_leave_out_what_is_linked(spark):
    wild = random.Random(24)
    bodies = [[f"u{wild.randrange(30)}" for _ in range(wild.randrange(0, 60))] for _ in range(40)]
    told = bodies + [[w if wild.random() > 0.02 else "x" for w in b] for b in bodies for _ in range(3)]
    rows = {k: " ".join(t) for k, t in enumerate(told)}
    shingles = {k: {tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))} if t else set() for k, t in enumerate(told)}
    want = {(a, b) for a in rows for b in rows if a < b and shingles[a] and shingles[b] and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]) - 1e-9}
    texts = spark.createDataFrame(list(rows.items()), "id long, text string")
    own = texts.selectExpr("id", "id AS node")
    found = lambda member: {tuple(r) for r in simhash.prefix_pairs(texts, own, spark.createDataFrame(member, "node long, component long"), len(rows), 5, 0.8).collect()}
    assert len(want) > 60 and want <= found([])
    assert found([(k, 0) for k in rows]) == set()
