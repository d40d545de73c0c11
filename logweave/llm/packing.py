"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import json
import random
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm import words
from logweave.llm.common import durable, own_columns, read
from logweave.llm.tokens import WordSplitter

#: Words whose ids a worker keeps. This bounds memory and changes no id.
KEPT_WORDS = 400_000

#: A bin's items as ((length, how many), ...), longest first, and how many such bins there are.
Group = tuple[tuple[tuple[int, int], ...], int]


class WordIds:
    """Token ids as the tokenizers library gives them, a word at a time: no token of its vocabulary spans white space.

    A word's pre-tokens go to the library's model; a word with a special string goes through all of the library.
    """

    def __init__(self, path: str):
        self.pretokens = WordSplitter(path)
        self.library = self.pretokens.library
        self.known: dict[str, bytes] = {}

    def learn(self, some: list[str]) -> None:
        tokenize, pretokens, known = self.library.model.tokenize, self.pretokens, self.known
        for word in some:
            if pretokens.is_special(word):
                found = self.library.encode(word, add_special_tokens=False).ids
            else:
                found = [token.id for pretoken in pretokens(word) for token in tokenize(pretoken)]
            known[word] = array("I", found).tobytes()

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Unsigned little-endian 32-bit ids of each text."""
        flat, n_words = words.split(texts)
        coded = flat.dictionary_encode()
        some = coded.dictionary.to_pylist()
        if len(self.known) > KEPT_WORDS:  # short words come often, so they stay
            self.known = {word: own for word, own in self.known.items() if len(word) < 8}
            if len(self.known) > KEPT_WORDS // 2:
                self.known.clear()
        self.learn([word for word in some if word not in self.known])
        held = list(map(self.known.__getitem__, some))
        lengths = np.fromiter(map(len, held), np.int64, len(held)) // 4
        starts = np.cumsum(lengths) - lengths
        place = coded.indices.to_numpy()
        n, first = lengths[place], starts[place]
        ends = np.cumsum(n)
        every = np.frombuffer(b"".join(held), "<u4")[np.repeat(first - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n_words)])]
        data = every.tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, room: int = 4096, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, crc[, ids]): each text's ids and end_id, cut at every `room` ids.

    ids, if asked for, are unsigned little-endian 32-bit numbers. A null text is empty: one piece, end_id alone.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        made = word_ids(path)
        for batch in words.slices(batches):
            out = [[], [], [], [], []]
            held = []
            for own, ids in zip(batch.column("id").to_pylist(), made.ids(batch.column("text")), strict=True):
                ids += end
                for piece, low in enumerate(range(0, len(ids), 4 * room)):
                    cut = ids[low : low + 4 * room]
                    for column, value in zip(out, (own, piece, low // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                        column.append(value)
                    if with_ids:
                        held.append(cut)
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(held, pa.binary())] if with_ids else []), ["id", "piece", "start", "length", "crc"] + ["ids"] * with_ids)

    schema = "id long, piece int, start long, length long, crc long" + ", ids binary" * with_ids
    return words.map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, schema)


class Stock:
    """Items not yet in a bin: how many there are of each length, the lengths sorted."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def fill(self, room: int, wild: random.Random | None, slip: float) -> tuple[tuple[int, int], ...]:
        """Items for one bin: the longest that fits goes in, again and again; with chance slip, a shorter one."""
        used: dict[int, int] = {}
        while True:
            at = bisect_right(self.lengths, room) - 1
            while at >= 0 and used.get(self.lengths[at], 0) >= self.counts[self.lengths[at]]:
                at -= 1
            if at < 0:
                return tuple(sorted(used.items(), reverse=True))
            if wild and used and wild.random() < slip:
                at = wild.randrange(at + 1)
            length = self.lengths[at]
            n = min(self.counts[length] - used.get(length, 0), room // length if not wild else 1)
            if n <= 0:
                return tuple(sorted(used.items(), reverse=True))
            used[length] = used.get(length, 0) + n
            room -= n * length


def best_fit(counts: dict[int, int], room: int, wild: random.Random | None = None, slip: float = 0.0) -> list[Group]:
    """Bins for all items, longest first. Equal bins are made at once, until one of their lengths runs out."""
    stock, out = Stock(counts), []
    while stock.lengths:
        top = stock.lengths[-1]
        stock.counts[top] -= 1
        rest = stock.fill(room - top, wild, slip)
        stock.counts[top] += 1
        one = Counter(dict(rest))
        one[top] += 1
        times = min(stock.counts[length] // n for length, n in one.items())
        for length, n in one.items():
            stock.take(length, n * times)
        out.append((tuple(sorted(one.items(), reverse=True)), times))
    return out


def tight_fit(counts: dict[int, int], room: int, wild: random.Random, samples: int = 12) -> list[Group]:
    """Bins for all items: the longest one left, then, again and again, the one, two or three items that leave least room.

    All singles and pairs are tried, and triples with some lengths at random. Equal bins are made at once.
    """
    left = np.zeros(room + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while len(held := np.flatnonzero(left)):
        used: Counter = Counter([int(held[-1])])
        left[held[-1]] -= 1
        gap = room - int(held[-1])
        while gap and len(some := np.flatnonzero(left[: gap + 1])):
            best = [int(some[-1])]
            if best[0] < gap and 2 * some[0] <= gap:
                thirds = np.concatenate([[0], np.unique(some[[wild.randrange(len(some)) for _ in range(samples)]])])
                at = np.searchsorted(some, gap - thirds[:, None] - some[None, :], "right") - 1
                pair = some[np.maximum(at, 0)]
                # of one length there must be as many as are taken
                taken = 1 + (pair == some[None, :]) + (pair == thirds[:, None])
                ok = (at >= 0) & (left[pair] >= taken) & (left[some][None, :] >= 1 + (some[None, :] == thirds[:, None]))
                sums = np.where(ok, thirds[:, None] + some[None, :] + pair, 0)
                sums[0] += sums[0] > 0  # of equal sums, two items rather than three
                k, j = np.unravel_index(int(sums.argmax()), sums.shape)
                if sums[k, j] > best[0]:
                    best = [int(x) for x in (thirds[k], some[j], pair[k, j]) if x]
            for length in best:
                left[length] -= 1
                used[length] += 1
                gap -= length
        more = min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * more
        out.append((tuple(sorted(used.items(), reverse=True)), 1 + more))
    return out


def filled(bin_: tuple[tuple[int, int], ...]) -> int:
    return sum(length * n for length, n in bin_)


def score(groups: list[Group], room: int) -> tuple[int, float]:
    """To be made small: the number of bins, then less the mean squared fill, which prefers full and empty bins to half full ones."""
    bins = sum(times for _, times in groups)
    return bins, -sum((filled(b) / room) ** 2 * times for b, times in groups) / max(bins, 1)


def insert_best_fit(groups: list[Group], displaced: dict[int, int], room: int, wild: random.Random, slip: float) -> list[Group]:
    """Displaced items, longest first, into the bins that they leave least room in; what fits nowhere gets new bins."""
    open_bins: dict[tuple[tuple[int, int], ...], int] = Counter()
    for bin_, times in groups:
        open_bins[bin_] += times
    gaps = sorted((room - filled(bin_), bin_) for bin_ in open_bins if filled(bin_) < room)
    left: dict[int, int] = {}
    for length in sorted(displaced, reverse=True):
        n = displaced[length]
        while n:
            at = bisect_left(gaps, (length,))
            if at == len(gaps):
                left[length] = n
                break
            gap, bin_ = gaps[at]
            times = min(n, open_bins[bin_])
            open_bins[bin_] -= times
            if not open_bins[bin_]:
                del open_bins[bin_], gaps[at]
            grown = Counter(dict(bin_))
            grown[length] += 1
            new = tuple(sorted(grown.items(), reverse=True))
            if new not in open_bins and gap > length:
                insort(gaps, (gap - length, new))
            open_bins[new] += times
            n -= times
    return list(open_bins.items()) + (tight_fit(left, room, wild) if left else [])


def dominate(groups: list[Group], displaced: dict[int, int], room: int, passes: int = 3) -> tuple[list[Group], dict[int, int]]:
    """Local search before displaced items are inserted: one that fits a bin in the place of a shorter item takes it.

    Bins get fuller by it, and what is displaced instead is shorter and easier to place.
    """
    free = Counter(displaced)
    lengths = sorted(length for length, n in free.items() if n)
    for _ in range(passes):
        out, changed = [], False
        for bin_, times in groups:
            gap = room - filled(bin_)
            best = None
            if gap and lengths:
                for length, _ in bin_:
                    at = bisect_right(lengths, length + gap) - 1
                    if at >= 0 and lengths[at] > length and (best is None or lengths[at] - length > best[1] - best[0]):
                        best = length, lengths[at]
            if best is None:
                out.append((bin_, times))
                continue
            old, new = best
            n = min(times, free[new])
            items = Counter(dict(bin_))
            items[old] -= 1
            items[new] += 1
            out.append((tuple(sorted(((k, v) for k, v in items.items() if v), reverse=True)), n))
            if times > n:
                out.append((bin_, times - n))
            free[new] -= n
            if not free[new]:
                lengths.remove(new)
            if not free[old]:
                insort(lengths, old)
            free[old] += n
            changed = True
        groups = out
        if not changed:
            break
    return groups, {length: n for length, n in free.items() if n}


def crossover(one: list[Group], other: list[Group], counts: dict[int, int], room: int, wild: random.Random, slip: float) -> list[Group]:
    """Whole well-filled bins of `other` go into `one`, whose bins that hold the same items go; their other items are displaced."""
    fullest = sorted(other, key=lambda group: -filled(group[0]))
    some = [group for group in fullest[: max(1, len(fullest) // 2)] if wild.random() < 0.5] or fullest[:1]
    free = dict(counts)
    child: list[Group] = []
    for bin_, times in some + sorted(one, key=lambda group: (-filled(group[0]), wild.random())):
        times = min([times, *(free[length] // n for length, n in bin_)])
        if times:
            child.append((bin_, times))
            for length, n in bin_:
                free[length] -= n * times
    return insert_best_fit(*dominate(child, {length: n for length, n in free.items() if n}, room), room, wild, slip)


def mutate(groups: list[Group], room: int, wild: random.Random, slip: float) -> list[Group]:
    """The emptiest bins and a few others are taken apart, and their items inserted again."""
    ranked = sorted(groups, key=lambda group: filled(group[0]))
    apart = {id(group) for group in ranked[: max(1, len(ranked) // 10)]} | {id(group) for group in groups if wild.random() < 0.05}
    displaced: Counter = Counter()
    for group in groups:
        if id(group) in apart:
            for length, n in group[0]:
                displaced[length] += n * group[1]
    return insert_best_fit(*dominate([group for group in groups if id(group) not in apart], displaced, room), room, wild, slip)


def least_bins(counts: dict[int, int], room: int) -> int:
    """No packing has fewer bins, as each of these shows.

    The tokens need as many. Of items of k tokens or more, room // k go into one. Items over half a bin have one each,
    and what they leave holds only some of the items of k tokens or more, none at all if it is under k.
    """
    n = np.zeros(room + 1, np.int64)
    for length, many in counts.items():
        n[length] = many
    size = np.arange(room + 1)
    tokens = int((n * size).sum())
    at_least = n[::-1].cumsum()[::-1]
    several = -(-at_least[1:] // (room // size[1:]))
    half = room // 2
    big, bigs = n[half + 1 :].sum(), np.concatenate([[0], n.cumsum()])
    summed = np.concatenate([[0], (n * size).cumsum()])
    best = max(-(-tokens // room), int(several.max(initial=0)))
    for k in range(1, half + 1):
        open_n, open_sum = bigs[room - k + 1] - bigs[half + 1], summed[room - k + 1] - summed[half + 1]
        small = summed[half + 1] - summed[k]
        best = max(best, int(big + max(0, -(-(small - (open_n * room - open_sum)) // room))))
    return best


def evolve(counts: dict[int, int], room: int, immigrants: list[list[Group]], seed: int, people: int, generations: int, work: int = 60_000) -> list[Group]:
    """One island's best after some generations, which end early at a packing that can't be beaten.

    work bounds the groups of bins that the children of all generations may have: large worlds get fewer generations.
    """
    wild = random.Random(seed)
    slip = 0.02
    rank = lambda groups: score(groups, room)
    crowd = [best_fit(counts, room), *immigrants]
    goal = least_bins(counts, room)
    while len(crowd) < people and rank(min(crowd, key=rank))[0] > goal:
        crowd.append(tight_fit(counts, room, wild) if len(crowd) % 2 else best_fit(counts, room, wild, slip))
    groups = sum(map(len, crowd)) // len(crowd)
    for _ in range(max(2, min(generations, work // (groups * max(1, people // 2))))):
        crowd.sort(key=rank)
        if rank(crowd[0])[0] <= goal:
            break
        crowd = crowd[:people]
        picked = lambda: min(wild.sample(crowd, min(2, len(crowd))), key=rank)
        children = []
        for _ in range(max(1, people // 2)):
            child = crossover(picked(), picked(), counts, room, wild, slip)
            children.append(mutate(child, room, wild, slip) if wild.random() < 0.5 else child)
        crowd += children
    return min(crowd, key=rank)


def plan(spark: SparkSession, counts: dict[int, int], room: int, islands: int = 6, people: int = 10, generations: int = 60, epochs: int = 4) -> list[Group]:
    """The best packing that the islands find. After each epoch an island's elite moves on to the next one.

    An island's whole world is the number of items of each length: at most `room` numbers, however many items there
    are. A packing has no more groups of equal bins than a few for each length.
    """
    told = {int(length): int(n) for length, n in counts.items()}
    elites: list[list[Group]] = []
    for epoch in range(epochs):
        moved = elites[-1:] + elites[:-1]
        rows = [(k, json.dumps(moved[k] if elites else [])) for k in range(islands)]

        def run(frames, epoch=epoch):
            for frame in frames:
                out = []
                for island, came in zip(frame["island"], frame["came"], strict=True):
                    guests = [[(tuple(map(tuple, bin_)), times) for bin_, times in json.loads(came)]] if came != "[]" else []
                    out.append((island, json.dumps(evolve(told, room, guests, 1000 * epoch + int(island), people, generations))))
                yield pd.DataFrame(out, columns=["island", "elite"])

        world = spark.createDataFrame(rows, "island int, came string").repartition(islands, "island")
        found = sorted(world.mapInPandas(run, "island int, elite string").collect())
        elites = [[(tuple(map(tuple, bin_)), times) for bin_, times in json.loads(elite)] for _, elite in found]
        best = min(elites, key=lambda groups: score(groups, room))
        if score(best, room)[0] <= least_bins(told, room):
            break
    return best


def places(groups: list[Group]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the ranks at which groups begin, and each group's first sequence, items a bin, and offset in it."""
    begins: dict[int, list] = {}
    taken: Counter = Counter()
    sequence = 0
    for bin_, times in groups:
        offset = 0
        for length, n in bin_:
            begins.setdefault(length, []).append((taken[length], sequence, n, offset))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return {length: tuple(np.array(column, np.int64) for column in zip(*rows, strict=True)) for length, rows in begins.items()}


@own_columns
def pack(cut: DataFrame, room: int = 4096, rows_a_cell: int = 50_000, **islands) -> DataFrame:
    """The rows of cut (id, piece, start, length, crc, more) with sequence_id and offset: few sequences of at most room tokens.

    Equal lengths are interchangeable, so the packing is worked out on the lengths' counts (at most `room` numbers go
    to the driver), and a row finds its place from its rank among the rows of its length. Ranks come from cells, a
    hash of the row within its length, that get more with the number of rows: a length that a third of the rows have
    is spread over as many. Ties go by id, piece, start and CRC; repeated rows get places of their own; null ids are
    carried; an empty table gives no rows. The rows are read twice, so give a checkpointed or written table.
    """
    spark = cut.sparkSession
    counts = {row[0]: row[1] for row in cut.groupBy("length").agg(F.count("*")).collect()}
    found = places(plan(spark, counts, room, **islands)) if counts else {}
    cells = max(64, sum(counts.values()) // rows_a_cell)
    cut = cut.drop("sequence_id", "offset")
    celled = cut.withColumn("_cell", F.pmod(F.xxhash64("id", "piece", "crc"), F.lit(cells)))
    before = celled.groupBy("length", "_cell").agg(F.count("*").alias("_n")).select(
        F.col("length").alias("_l"), F.col("_cell").alias("_c"), (F.sum("_n").over(Window.partitionBy("length").orderBy("_cell")) - F.col("_n")).alias("_before")
    )
    ranked = celled.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_cell").orderBy("id", "piece", "start", "crc")) - 1)
    ranked = ranked.join(before, (F.col("length") == F.col("_l")) & (F.col("_cell") == F.col("_c"))).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_l", "_c", "_before", "_cell")
    table = spark.sparkContext.broadcast(found)
    names = [name for name in ranked.columns if name != "_rank"]

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order], prepend=-1))
            for some in np.split(order, edges[1:]) if len(order) else []:
                own = int(length[some[0]])
                begin, first, n, at = table.value[own]
                k = np.searchsorted(begin, rank[some], "right") - 1
                within = rank[some] - begin[k]
                sequence[some] = first[k] + within // n[k]
                offset[some] = at[k] + within % n[k] * own
            yield pa.RecordBatch.from_arrays([batch.column(name) for name in names] + [pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{name}` {kind}" for name, kind in ranked.select(*names).dtypes)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, room: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", **islands) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of docs.

    path: a vocabulary in the tokenizers library's JSON form that splits at white space, readable on every executor.
    Null and empty texts are one piece with end_id alone. pieces(with_ids=True) and pack() carry the ids themselves.
    """
    cut = durable(pieces(docs, path, room, end_id, id_col=id_col, text_col=text_col))
    done = pack(cut, room, **islands)
    return done.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
