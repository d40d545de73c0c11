"""Token counts and packing against the library itself and by exact accounting."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")

from logweave.llm import packing, tokens  # noqa: E402

PATH = P.path("word_bpe_49k.json")
TEXTS = [
    "", None, " ", "Hello, world! it's 1234 don't WE'LL", "a" * 5000, "=" * 4097, "xyxyxyxy" * 300, "ab cd ef", "x<|endoftext|>y <|STARTOFTEXT|><|startoftext|>",
    "Ünïcødé ß ẞ İ ı Σς ǅ ﬁ", "é ́a ̀", "日本語 テキスト 한국어 ᄒ ᅡ", "🙂🙃 👩‍👩‍👧", "\x00\x1c\x85  a\x1cb", "'s 't 're're '", "٣٤ ५ Ⅷ ½", "The quick brown fox. " * 400,
]


LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_counts_and_ids_are_the_librarys(spark):
    wild = random.Random(5)
    texts = TEXTS + ["".join(wild.choice("abAé ß'1<|\n\t=🙂́") for _ in range(wild.randrange(120))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: len(library_ids(t)) for i, t in enumerate(texts)}
    got = {r["id"]: (r["n_bytes"], r["n_tokens"]) for r in tokens.token_counts(docs, PATH).collect()}
    assert got == {i: (len((t or "").encode()), want[i]) for i, t in enumerate(texts)}
    ids = packing.WordIds(PATH).ids(pa.array(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [library_ids(t) for t in texts]


def test_merging_one_at_a_time_where_a_product_merges_earlier():
    vocab = {c: i for i, c in enumerate(["a", "b", "ab", "aba", "ba"])}
    merger = tokens.RaggedMerger(vocab, [["ab", "a"], ["a", "b"]], "")
    assert not merger.all_at_once
    library = tokenizers.models.BPE(vocab, [("ab", "a"), ("a", "b")])
    some = ["abab", "ab", "", "a", "ababa", "abaababab"]
    assert merger.counts(some).tolist() == [len(library.tokenize(x)) if x else 0 for x in some]


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        tokens.TokenCounter(P.path("byte_bpe_50k.json"))


def check_packing(rows, texts, room):
    want = {i: library_ids(t) + [1] for i, t in enumerate(texts)}
    bins = {}
    for r in rows:
        ids = want[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["start"] == r["piece"] * room and len(ids) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(map(len, want.values()))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= room
    return len(bins)


def test_packing_places_every_piece_once(spark):
    wild = random.Random(3)
    texts = TEXTS + [" ".join(wild.choice(["thing", "zebra", "of", "a"]) for _ in range(wild.randrange(90))) for _ in range(200)] + ["same text"] * 150
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for room in (64, 300):
        rows = packing.pack_documents(docs, PATH, room=room, islands=2, people=4, generations=3, epochs=2).collect()
        n = check_packing(rows, texts, room)
        assert n <= 1.01 * sum(len(library_ids(t)) + 1 for t in texts) / room + 1
    empty = packing.pack_documents(docs.limit(0), PATH)
    assert empty.collect() == [] and "sequence_id" in empty.columns


def test_repeated_rows_and_null_ids_get_places_of_their_own(spark):
    docs = spark.createDataFrame([(None, "a b c")] * 5 + [(7, "a b c")] * 5 + [(7, None)], "doc_id long, text string")
    rows = packing.pack_documents(docs, PATH, room=10).collect()
    assert len(rows) == 11 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 11


def test_genetic_operators_keep_every_item():
    wild = random.Random(1)
    counts = dict(Counter(wild.randrange(1, 101) for _ in range(400)))
    one, other = (packing.best_fit(counts, 100, wild, 0.3) for _ in range(2))
    for groups in (one, packing.crossover(one, other, counts, 100, wild, 0.1), packing.mutate(one, 100, wild, 0.1)):
        held = Counter()
        for bin_, times in groups:
            assert packing.filled(bin_) <= 100 and times > 0
            for length, n in bin_:
                held[length] += n * times
        assert held == counts


def test_evolution_beats_the_first_packing():
    wild = random.Random(9)
    for lengths, n, room in ((range(900, 2101), 600, 4096), (range(1200, 1501), 900, 4096), ((1900, 1700, 1500, 1100, 900, 700), 300, 4096)):
        counts = dict(Counter(wild.choice(lengths) for _ in range(n)))
        first = packing.best_fit(counts, room)
        best = packing.evolve(counts, room, [], 1, 10, 60)
        assert packing.least_bins(counts, room) <= packing.score(best, room)[0] < packing.score(first, room)[0]
        held = Counter()
        for bin_, times in best:
            assert packing.filled(bin_) <= room
            for length, many in bin_:
                held[length] += many * times
        assert held == counts


def test_bounds_are_no_more_than_any_packing():
    wild = random.Random(10)
    for _ in range(60):
        counts = dict(Counter(wild.randrange(1, 31) for _ in range(wild.randrange(1, 40))))
        some = [packing.best_fit(counts, 30), packing.tight_fit(counts, 30, wild), packing.evolve(counts, 30, [], 2, 4, 10)]
        assert packing.least_bins(counts, 30) <= min(packing.score(groups, 30)[0] for groups in some)
    # three of any two items never meet, though their tokens would fit fewer bins
    assert packing.least_bins({14: 30}, 40) == 15
