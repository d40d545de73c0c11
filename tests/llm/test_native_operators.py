"""Line dedup, sharding, chat formatting, quality rules and license scans against brute force on small tables."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from logweave.llm import chat, licenses, lines, quality, sharding

SPACE = "[\\x20\\x09-\\x0D]"


def test_line_dedup_equals_brute_force(spark):
    wild = random.Random(6)
    bank = ["a common line of text", "  A COMMON line of TEXT\t", "short", "another line here", "Ünïcode lines too é", "", "   ", "twelve chars", "123456789", "1234567890"]
    texts = ["\n".join(wild.choice(bank + [f"own line number {k}"]) for _ in range(wild.randrange(0, 9))) for k in range(60)] + [None, "", "\n", "a common line of text\n" * 3000]
    rows = [(k, t, 7, "x") for k, t in enumerate(texts)] + [(None, "another line here", 1, "y"), (3, texts[3], 7, "x")]
    key = lambda x: re.sub(f"^{SPACE}+|{SPACE}+$", "", x).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    last = 2**63 - 1
    holders = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(last if i is None else i)
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, n_lines int, key string")).collect()
    assert len(got) == len(rows)
    want = []
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if not (len(key(x)) >= 10 and len(holders[key(x)]) >= 2 and min(holders[key(x)]) != (last if i is None else i))]
        want.append((i, len(own), len(own) - len(kept), "\n".join(kept)))
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got), key=str) == sorted(want, key=str)
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_line_dedup_over_a_threshold(spark):
    rows = [(k, "in three documents\nonly twice here" if k < 2 else "in three documents") for k in range(3)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=3).orderBy("doc_id").collect()
    assert [r["text"] for r in got] == ["in three documents\nonly twice here", "only twice here", ""]


def plain_shards(ids, shards, nodes):
    """Keys in the order of their places on the ring, each to the first shard clockwise that has room."""
    total = len(ids)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    place = lambda i: int(hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    first = nodes[0][0]
    arc = lambda p: next((k for k, (end, _) in enumerate(nodes) if end >= p), 0)
    order = sorted(range(total), key=lambda k: (arc(place(ids[k])), place(ids[k]) - (2**60 if arc(place(ids[k])) == 0 and place(ids[k]) > first else 0)))
    out = {}
    for k in order:
        at = arc(place(ids[k]))
        while not room[nodes[at % len(nodes)][1]]:
            at += 1
        room[nodes[at % len(nodes)][1]] -= 1
        out[k] = nodes[at % len(nodes)][1]
    return out


@pytest.mark.parametrize("n", [0, 5, 397])
def test_sharding_equals_brute_force(spark, n):
    rows = [(k * 7, f"text {k}", 99) for k in range(n)]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string, slot int"), 16, 8, cell_rows=10).collect()
    assert len(got) == n
    want = plain_shards([r[0] for r in rows], 16, sharding.ring(16, 8))
    assert {r["doc_id"]: r["shard"] for r in got} == {rows[k][0]: s for k, s in want.items()}
    for shard in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots))) and n // 16 <= len(slots) <= n // 16 + 1


def test_sharding_of_nulls_and_repeated_rows(spark):
    rows = [(None, "a")] * 40 + [(5, None)] * 40 + [(6, "b")]
    got = sharding.shard_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 81 and len({(r["shard"], r["slot"]) for r in got}) == 81


def test_sharding_moves_little(spark):
    rows = spark.createDataFrame([(k, "t") for k in range(4000)], "doc_id long, text string")
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.shard_rows(rows, n).collect()} for n in (16, 17))
    assert sum(before[k] != after[k] for k in before) < 0.1 * len(before)


def test_sharding_digest(spark, tmp_path):
    spark.createDataFrame([(1, "é"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in sharding.op4_sharding(spark, str(tmp_path)).collect()}
    assert (got[1]["size"], got[1]["text_crc32"], got[2]["size"], got[2]["text_crc32"]) == (3, zlib.crc32("é".encode()), 1, 0)


EVENTS = "conv_id long, seq long, kind string, target long, role string, text string"


def folded(spark, events):
    rows = chat.rebuild(spark.createDataFrame(events, EVENTS)).orderBy("conv_id", "place").collect()
    return [(r["conv_id"], r["role"], r["text"]) for r in rows]


def test_chat_events_fold(spark):
    events = [
        (1, 1, "message", None, "user", "Hi"), (1, 2, "message", None, "assistant", "He"), (1, 3, "delta", None, None, "llo"), (1, 4, "delta", 2, None, "!"), (1, 5, "message", None, "user", "more"),
        (1, 6, "edit", 1, None, "Hi there"), (1, 7, "delta", 1, None, "."), (1, 8, "regenerate", 2, None, ""), (1, 9, "delta", 2, None, "Good day"), (1, 10, "message", None, "user", "end"),
        (2, 1, "delta", None, None, "lost"), (2, 2, "message", None, None, None), (2, 3, "edit", 9, None, "lost"), (2, 4, "unknown", None, None, "lost"), (None, 1, "message", None, "user", "n"),
    ]
    assert folded(spark, events) == [(None, "user", "n"), (1, "user", "Hi there."), (1, "assistant", "Good day"), (1, "user", "end"), (2, "", "")]
    assert folded(spark, [(3, 1, "message", None, "user", "same")] * 2 + [(3, None, "message", None, "user", "first")]) == [(3, "user", "first"), (3, "user", "same"), (3, "user", "same")]
    assert folded(spark, []) == []


def test_chat_templates_are_reversible(spark):
    hard = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>", "<\\|turn|>", "<\\\\|end|>", "<", "|>", "<<||", "", "\n\n", "a%0Ab%25", "[\\INST] <\\s> <s>", "é🙂<|", None]
    events = [(k, i, "message", None, role, t) for k in range(3) for i, t in enumerate(hard) for role in ["user\n%0A<|", "assistant"][i % 2 : i % 2 + 1]]
    done = chat.render(chat.rebuild(spark.createDataFrame(events, EVENTS)))
    got = done.select("conv_id", "formatted", "loss_spans", chat.read_back(F.col("formatted")).alias("turns")).collect()
    assert len(got) == 3
    for row in got:
        own = [(r or "", t or "") for c, _, _, _, r, t in events if c == row["conv_id"]]
        assert [(x["role"], x["text"]) for x in row["turns"]] == own
        assert row["formatted"].count("<|turn|>") == len(own)
        learned = [row["formatted"][s["start"] : s["start"] + s["length"]] for s in row["loss_spans"]]
        assert len(learned) == sum(r == "assistant" for r, _ in own)
        undone = spark.createDataFrame([(x,) for x in learned], "x string").select(chat.unescape(F.col("x"))).collect()
        assert [x[0] for x in undone] == [t for r, t in own if r == "assistant"]
        assert not re.search(r"</?s>|\[/?INST\]", row["formatted"])


def plain_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    again = {w for w in wins if wins.count(w) > 1}
    covered = {p for i, w in enumerate(wins) if w in again for p in range(i, i + 3)}
    own = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(own) - len(set(own)), len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words)


def test_quality_counts_equal_brute_force(spark):
    wild = random.Random(12)
    bank = ["a", "b", "c", "é#", "d|", "\n", "\t", "x&y", "\x0b", "\x1c", " "]
    texts = [None, "", "one", "a b c a b c", "a a a a a", " \n ", "same\nsame\nother\nsame"] + [" ".join(wild.choice(bank) for _ in range(wild.randrange(0, 90))) for _ in range(80)]
    texts.append(" ".join(f"w{k % 700}" for k in range(4000)))
    rows = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: r for r in quality.clean_lines(rows).collect()}
    for k, text in enumerate(texts):
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_quality(text), text
    assert quality.clean_lines(rows.limit(0)).collect() == []


def test_lines_are_judged_first(spark):
    prose = "\n".join(f"Line{k} tells{k * 3} of some{k * 7} prose{k}, which says{k} nothing{k * 5} much{k * 2}." for k in range(8))
    nav, shout, cookie = "Home | News | Sport | Shop", "BUY!! NOW!! FREE!! WIN!!", "Please accept all cookies to go on."
    texts = [prose, f"{nav}\n{prose}\n{cookie}", "\n".join([nav + " | More | Less"] * 30), "\n".join([shout] * 2 + [f"A{k}!! B{k}!! C{k}!!" for k in range(40)]), prose.replace("says", "says######")]
    got = quality.clean_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["kept"] for r in got] == [True, True, False, False, False]
    assert got[1]["cleaned"] == prose and got[0]["cleaned"] == prose
    kept = quality.kept_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1]


def test_licenses(spark):
    wild = random.Random(2)
    filler = lambda n: " ".join(wild.choice(["some", "words", "of", "prose", "here"]) for _ in range(n))
    rows, want = [], {}
    for k, (name, text) in enumerate(licenses.TEMPLATES * 4):
        rows.append((k, f"{filler(wild.randrange(40))} {text.upper() if k % 2 else text} {filler(wild.randrange(40))}", name))
        want[k] = name
    near = licenses.TEMPLATES[9][1].split()
    near[20] = "changed"
    rows += [(900, " ".join(near[:14]), ""), (901, None, ""), (902, "", ""), (903, "Licensed under", ""), (904, filler(3000), ""), (905, " ".join(near), "")]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect():
        got.setdefault(r["id"], set()).add(r["license"])
        assert 0.8 <= r["containment"] <= 1 and r["first_word"] >= 0
    assert all(want[k] in got.get(k, ()) for k in want)
    assert not {900, 901, 902, 903, 904} & set(got) and got[905] == {"gpl-3.0"}
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        licenses.scan(spark.createDataFrame([], "doc_id long, text string"), (("x", "too short"),))


def test_edited_notices_are_retrieved(spark):
    wild = random.Random(8)
    parts = lambda own: {" ".join(own[i : i + 5]) for i in range(len(own) - 4)}
    rows, want = [], {}
    for name, text in licenses.TEMPLATES:
        own = licenses.plain_words(text)
        for _ in range(30 if len(own) >= 9 else 0):
            near = list(own)
            for _ in range(wild.choice([1, 1, 2])):
                near[wild.choice([0, 0, len(own) - 1, len(own) - 1, wild.randrange(len(own))])] = f"edit{wild.randrange(10**6)}"
            if 0.8 <= len(parts(near) & parts(own)) / len(parts(own)) < 1:
                want[len(rows)] = name
                around = [f"w{wild.randrange(500)}" for _ in range(40)]
                at = wild.randrange(40)
                rows.append((len(rows), " ".join(around[:at] + near + around[at:])))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r["id"], set()).add(r["license"])
    assert len(want) >= 150
    assert sum(name in got.get(k, ()) for k, name in want.items()) == len(want)


def test_usual_license_wordings_and_headings(spark):
    told = {
        "Licensed under the MIT License.": {"mit"},
        "This program is distributed under the MIT license, as is.": {"mit"},
        "Apache License\n    Version 2.0, January 2004": {"apache-2.0"},
        "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007": {"gpl-3.0"},
        "GNU GENERAL PUBLIC LICENSE\n Version 2, June 1991": {"gpl-2.0"},
        "GNU LESSER GENERAL PUBLIC LICENSE\n Version 2.1, February 1999": {"lgpl"},
        "Released under the GNU Lesser General Public License.": {"lgpl"},
        "GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007": {"agpl-3.0"},
        "Mozilla Public License Version 2.0": {"mpl-2.0"},
        "licensed under version 3 of the GNU Affero General Public License into a single combined work": set(),
        "use the GNU Lesser General Public License instead of this License": set(),
        "She was licensed under the old rules, as a driver, version 2.0 of herself.": set(),
    }
    texts = [f"some words before it\n{text}\nand some after it" for text in told]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in licenses.scan(rows).collect():
        got.setdefault(r["id"], set()).add(r["license"])
    assert [got.get(k, set()) for k in range(len(told))] == list(told.values())
