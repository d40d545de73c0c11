"""Decontamination against brute force over every place of every window."""

import random

from logweave.llm import decontaminate, words


def split(text):
    return decontaminate.WORD.findall((text or "").encode().translate(words.ALNUM))


def plain(text, items, window):
    own, hit, found = split(text), set(), set()
    for item, item_text in items:
        other = split(item_text)
        n = min(window, len(other))
        wins = {tuple(other[i : i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if tuple(own[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add("null" if item is None else str(item))
    return len(own), len(hit), sorted(found)


def cases():
    wild = random.Random(4)
    bank = ["a", "b", "c", "D", "é", "1"]
    items = [(k, " ".join(wild.choice(bank) for _ in range(wild.randrange(0, 14)))) for k in range(25)]
    items += [(None, "x-y z"), (3, "unlike the rest of them"), (40, None), (41, "!!!"), (42, "x y"), (43, "solo")]
    docs = ["", None, "...", "x Y, z", "one solo word", "a" * 3000]
    for _ in range(150):
        body = [wild.choice(bank) for _ in range(wild.randrange(0, 60))]
        if wild.random() < 0.4:
            body += (wild.choice(items)[1] or "").upper().split()
        docs.append("".join(w + wild.choice([" ", ", ", "\n", "--"]) for w in body))
    return docs, items


def test_hits_and_items_equal_brute_force(spark):
    docs, items = cases()
    rows = spark.createDataFrame([(k, t, "kept", 5) for k, t in enumerate(docs)], "doc_id long, text string, kept string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for window, block in ((4, 100_000), (6, 20)):
        got = {r["doc_id"]: r for r in decontaminate.decontaminate(rows, bench, window, block_words=block).collect()}
        for k, text in enumerate(docs):
            n, n_hit, found = plain(text, items, window)
            assert (got[k]["n_words"], got[k]["n_hit"], got[k]["hit_items"]) == (n, n_hit, found), (window, text)
            assert got[k]["kept"] == (n_hit <= 0.5 * n)


def test_spans_are_removed_and_the_rest_stays(spark):
    rows = spark.createDataFrame([(1, "Keep this. One two, THREE four! And this é."), (2, "nothing here"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(9, "one two three four")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.decontaminate(rows, bench, 4).collect()}
    assert got[1]["cleaned"] == "Keep this. ! And this é."
    assert [tuple(s) for s in got[1]["hit_spans"]] == [(11, 30)]
    assert got[2]["cleaned"] == "nothing here" and got[2]["hit_spans"] == [] and got[3]["cleaned"] is None and got[3]["kept"]


def test_empty_tables(spark):
    rows = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in decontaminate.decontaminate(rows, none).collect()] == [0]
    assert decontaminate.decontaminate(rows.limit(0), none).collect() == []


def test_automaton_knows_every_substring():
    wild = random.Random(9)
    some = [[wild.randrange(3) for _ in range(wild.randrange(1, 12))] for _ in range(30)]
    automaton = decontaminate.Automaton(3)
    for own in some:
        automaton.add(own)
    stream = [wild.randrange(3) for _ in range(400)]
    known = {tuple(own[i:j]) for own in some for i in range(len(own)) for j in range(i + 1, len(own) + 1)}
    for place, _, length in automaton.walk(stream):
        want = max(n for n in range(13) if n == 0 or n <= place + 1 and tuple(stream[place + 1 - n : place + 1]) in known)
        assert length == want
