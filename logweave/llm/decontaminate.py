"""Benchmark decontamination with a generalised suffix automaton of the items' words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import words
from logweave.llm.common import durable, own_columns, read

#: A word, in a text as words.ALNUM leaves it.
WORD = re.compile(rb"[^\t\n\x0b\x0c\r ]+")
#: Items' words in one automaton; more items take more passes over the documents, so memory has a bound.
BLOCK_WORDS = 100_000


class Automaton:
    """All substrings of some items, each a list of word numbers.

    A state stands for substrings that end at the same places; `span` is its longest one's length and `link` the state
    of the longest suffix that ends at more places. Items are added one after another from the root, so no substring
    crosses from one item into the next.
    """

    def __init__(self, window: int):
        self.window = window
        self.span, self.link, self.next = [0], [-1], [{}]
        self.items: dict[int, set[str]] = {}  # by the state of a window
        self.short: dict[int, list[tuple[int, str]]] = {}  # (length, item) by the state of an item shorter than a window
        self.shortest = window

    def _copy(self, state: int, span: int) -> int:
        self.span.append(span)
        self.link.append(self.link[state])
        self.next.append(dict(self.next[state]))
        return len(self.span) - 1

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state != -1 and self.next[state].get(word) == old:
            self.next[state][word] = new
            state = self.link[state]

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.span[known] == self.span[last] + 1:
                return known
            clone = self._copy(known, self.span[last] + 1)
            self.link[known] = clone
            self._redirect(last, word, known, clone)
            return clone
        self.span.append(self.span[last] + 1)
        self.link.append(0)
        self.next.append({})
        new, state = len(self.span) - 1, last
        while state != -1 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state != -1:
            known = self.next[state][word]
            if self.span[known] != self.span[state] + 1:
                clone = self._copy(known, self.span[state] + 1)
                self.link[known] = clone
                self._redirect(state, word, known, clone)
                known = clone
            self.link[new] = known
        return new

    def add(self, numbers: list[int]) -> None:
        last = 0
        for word in numbers:
            last = self._extend(last, word)

    def name(self, item: str, numbers: list[int]) -> None:
        """Tells whose windows are whose; after all items were added."""
        if len(numbers) < self.window:
            state = 0
            for word in numbers:
                state = self.next[state][word]
            self.short.setdefault(state, []).append((len(numbers), item))
            self.shortest = min(self.shortest, len(numbers))
            return
        for _, state, length in self.walk(numbers):
            if length >= self.window:
                self.items.setdefault(self.window_state(state), set()).add(item)

    def window_state(self, state: int) -> int:
        while self.span[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def walk(self, numbers) -> Iterator[tuple[int, int, int]]:
        """(place, state, length of the longest match that ends there) along a stream of words."""
        state = length = 0
        for place, word in enumerate(numbers):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.span[state]
            following = self.next[state].get(word)
            if following is not None:
                state, length = following, length + 1
            yield place, state, length

    def matches(self, numbers) -> Iterator[tuple[int, int, object]]:
        """(start, end, items) for each window, or whole shorter item, in a stream of words."""
        for place, state, length in self.walk(numbers):
            if length >= self.window:
                yield place + 1 - self.window, place + 1, self.items[self.window_state(state)]
            at = state
            while at > 0 and self.short:
                for own, item in self.short.get(at, ()):
                    if own <= length:
                        yield place + 1 - own, place + 1, (item,)
                at = self.link[at]


class Index:
    """An automaton and the numbers of its words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        numbers: dict[bytes, int] = {}
        coded = [(item, [numbers.setdefault(word, len(numbers)) for word in own]) for item, own in items]
        self.words = pa.array([word.decode() for word in numbers], pa.string())
        self.automaton = Automaton(window)
        for _, own in coded:
            self.automaton.add(own)
        for item, own in coded:
            self.automaton.name(item, own)

    def search(self, flat: pa.Array, edges: np.ndarray) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words of the texts (flat, cut at edges) are hit, and the items found in each text.

        Only runs of the items' words, long enough for their shortest window, are streamed.
        """
        hit = np.zeros(len(flat), bool)
        found: dict[int, set[str]] = {}
        numbers = pc.index_in(flat, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        known = numbers >= 0
        breaks = np.zeros(len(flat) + 1, bool)
        breaks[edges] = True
        starts = np.flatnonzero(known & (breaks[:-1] | ~np.concatenate([[False], known[:-1]])))
        ends = np.flatnonzero(known & (breaks[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        long = ends - starts >= self.automaton.shortest
        owners = np.searchsorted(edges, starts[long], "right") - 1
        for start, end, owner in zip(starts[long].tolist(), ends[long].tolist(), owners.tolist(), strict=True):
            for a, b, items in self.automaton.matches(numbers[start:end].tolist()):
                hit[start + a : start + b] = True
                found.setdefault(owner, set()).update(items)
        return hit, found


def item_blocks(items: DataFrame, window: int, most: int, id_col: str, text_col: str) -> Iterator[Index]:
    """Indexes of at most `most` words each (or one item), read from the items as they are needed."""
    held: dict[str, list[list[bytes]]] = {}
    n = 0
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    for item, text in rows.toLocalIterator():
        own = WORD.findall(text.encode().translate(words.ALNUM))
        if n and n + len(own) > most:
            yield Index([(k, x) for k, texts in held.items() for x in texts], window)
            held, n = {}, 0
        if own:
            held.setdefault(item, []).append(own)
            n += len(own)
    if held:
        yield Index([(k, x) for k, texts in held.items() for x in texts], window)


def without(text: str, hit: np.ndarray) -> tuple[str, list[dict[str, int]]]:
    """The text without its hit words and what lies between two of them, and the byte spans that went."""
    data = text.encode()
    places = [m.span() for m in WORD.finditer(data.translate(words.ALNUM))]
    turns = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    spans = [(places[a][0], places[b - 1][1]) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True)]
    kept, at = [], 0
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]]).decode(), [{"start": a, "end": b} for a, b in spans]


@own_columns
def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, item_id: str = "item_id", item_text: str = "text", text_col: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """docs with n_words, n_hit (long), hit_items (array<string>, sorted), hit_spans, cleaned and kept.

    A word is a run of ASCII letters and digits and of all other characters beyond ASCII, A-Z in lower case. A word is
    hit inside any occurrence of `window` consecutive words of an item, or of the whole of a shorter item. The words
    of a document stream through a suffix automaton of the items; where the longest match reaches `window`, a window
    ends. cleaned is the text without the hit spans; kept is false where over max_coverage of the words are hit. Items
    go into automata of at most block_words words; one pass over docs for each, so memory doesn't grow with them.
    Null texts have no words, on both sides; items of one id are one item, a null id reads as `null`; without items
    nothing is hit. Columns of the new names are replaced, all others carried; a row in, a row out.
    """
    docs = docs.drop("n_words", "n_hit", "hit_items", "hit_spans", "cleaned", "kept")
    own = docs.columns
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    state = docs.withColumns({"_hit": F.lit(None).cast("binary"), "_items": F.lit(None).cast("array<string>")})

    def search(batches, shared):
        """The batches with the hits of one more index."""
        for batch in words.slices(batches, text_col):
            flat, counts = words.split(batch.column(text_col), words.ALNUM)
            edges = np.concatenate([[0], np.cumsum(counts)])
            hit, found = shared.value.search(flat, edges)
            bits, names = batch.column("_hit").to_pylist(), batch.column("_items").to_pylist()
            for k, more in found.items():
                mine = hit[edges[k] : edges[k + 1]]
                if bits[k] is not None:
                    mine = mine | np.unpackbits(np.frombuffer(bits[k], np.uint8))[: len(mine)].astype(bool)
                bits[k], names[k] = np.packbits(mine).tobytes(), sorted({*(names[k] or ()), *more})
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(bits, pa.binary()), pa.array(names, pa.list_(pa.string()))], [*own, "_hit", "_items"])

    def finish(batches):
        for batch in words.slices(batches, text_col):
            texts = batch.column(text_col)
            _, counts = words.split(texts, words.ALNUM)
            n_hit, cleaned, spans = np.zeros(len(counts), np.int64), texts, [[]] * len(counts)
            rows = [k for k, bits in enumerate(batch.column("_hit").to_pylist()) if bits is not None]
            if rows:
                cleaned = texts.to_pylist()
                for k in rows:
                    mine = np.unpackbits(np.frombuffer(batch.column("_hit")[k].as_py(), np.uint8))[: counts[k]].astype(bool)
                    n_hit[k] = mine.sum()
                    cleaned[k], spans[k] = without(cleaned[k], mine)
                cleaned = pa.array(cleaned, texts.type)
            kept = n_hit <= max_coverage * counts
            names = pa.array([x or [] for x in batch.column("_items").to_pylist()], pa.list_(pa.string()))
            spans = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            columns = [pa.array(counts.astype(np.int64)), pa.array(n_hit), names, spans, cleaned, pa.array(kept)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *columns], [*own, "n_words", "n_hit", "hit_items", "hit_spans", "cleaned", "kept"])

    new = "n_words long, n_hit long, hit_items array<string>, hit_spans array<struct<start:long,end:long>>, cleaned string, kept boolean"
    last = None
    for index in item_blocks(items, window, block_words, item_id, item_text):
        if last is not None:
            state = durable(words.map_arrow(state, lambda batches, shared=last: search(batches, shared), f"{fields}, _hit binary, _items array<string>"))
        last = docs.sparkSession.sparkContext.broadcast(index)
    return words.map_arrow(state, lambda batches: finish(search(batches, last) if last else batches), f"{fields}, {new}")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT n FROM wins
), seen AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)
), hits AS (
  SELECT r, i, n, item_id FROM seen JOIN wins USING (n, win)
), marked AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""
