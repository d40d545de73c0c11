"""Token counts by rank-synchronous merging of arrays."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import words
from logweave.llm.common import read

#: Words whose counts a worker keeps. This bounds memory and changes no count.
KEPT_WORDS = 400_000
NONE = np.iinfo(np.int32).max


class RaggedMerger:
    """Counts what byte-pair merging leaves of many pre-tokens at once.

    The symbols of all pre-tokens lie in one array. In each round every pre-token finds its own lowest-rank pair and
    all its non-overlapping occurrences merge, from the left; pre-tokens without a pair to merge are done. This equals
    merging one occurrence at a time because no merge's product is in a merge of a lower rank; where a vocabulary has
    such a merge (checked on loading), only the leftmost occurrence merges in a round.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
        self.size = max(vocab.values()) + 1
        left, right = (np.array([vocab[pair[k]] for pair in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab["".join(pair)] for pair in pairs], np.int32)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = np.append(keys[order], np.int64(2**62)), np.append(order, NONE).astype(np.int32), made
        least = np.full(self.size, NONE, np.int64)
        np.minimum.at(least, left, np.arange(len(pairs)))
        np.minimum.at(least, right, np.arange(len(pairs)))
        self.all_at_once = bool((least[made] > np.arange(len(pairs))).all())
        self.inner, self.final = {}, {}
        for token, number in vocab.items():
            if len(token) == 1:
                self.inner[ord(token)] = number
            if suffix and len(token) == 1 + len(suffix) and token.endswith(suffix):
                self.final[ord(token[0])] = number
        top = max([*self.inner, *self.final]) + 1
        self.inner, self.final = (np.array([some.get(c, -1) for c in range(top)], np.int32) for some in (self.inner, self.final or self.inner))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """Symbols left of each pre-token, which is spelled in the vocabulary's characters; an empty one has none."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        points = np.frombuffer("".join(pretokens).encode("utf-32-le"), np.uint32)
        ends = np.cumsum(lengths)
        symbols = self.inner[points]
        last = ends[lengths > 0] - 1
        symbols[last] = self.final[points[last]]
        out = lengths.copy()
        who = np.flatnonzero(lengths > 1)
        keep = np.repeat(lengths > 1, lengths)
        symbols, lengths = symbols[keep], lengths[who]
        while len(who):
            starts = np.cumsum(lengths) - lengths
            ranks = np.full(len(symbols), NONE, np.int32)
            ranks[:-1] = self.rank_of(symbols[:-1], symbols[1:])
            ranks[starts + lengths - 1] = NONE
            lowest = np.minimum.reduceat(ranks, starts)
            owner = np.repeat(np.arange(len(who)), lengths)
            hits = np.flatnonzero((ranks == lowest[owner]) & (ranks != NONE))
            if self.all_at_once:
                fresh = np.diff(hits, prepend=-2) != 1
                first = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
                hits = hits[(hits - hits[first]) % 2 == 0]
            else:
                hits = hits[np.diff(owner[hits], prepend=-1) != 0]
            symbols[hits] = self.made[ranks[hits]]
            gone = np.zeros(len(symbols), bool)
            gone[hits + 1] = True
            left = lengths - np.bincount(owner[hits], minlength=len(who))
            out[who] = left
            going = (lowest != NONE) & (left > 1)
            symbols = symbols[~gone & going[owner]]
            who, lengths = who[going], left[going]
        return out


class WordSplitter:
    """A vocabulary file's own pre-tokens, a word at a time: the model that it is for must split at white space.

    Words of ASCII and of Latin letters that are their own NFC form take a short way, with the same result; all others
    go through the library's normalizer and pre-tokenizer.
    """

    short = re.compile("[!-~À-ÖØ-öø-į]+")
    plain = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-į]+|[0-9]|[^a-z0-9ß-öø-į]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            self.told = json.load(file)
        self.library = Tokenizer.from_file(path)
        added = self.told["added_tokens"]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} has added tokens that don't stand for their string alone")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.spelled = self._byte_letters()
        for probe in ("a b", "It's a1,", "Ünï-ßx don't_3²", "łódź"):
            if self.by_library(probe) != [token for word in probe.split() for token in self(word)]:
                raise ValueError(f"{path} doesn't split texts at white space and punctuation as expected")

    def _byte_letters(self) -> dict[int, str]:
        """The character that stands for each byte: printable ones for themselves, the others from 256 on, in order."""
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}

    def by_library(self, piece: str) -> list[str]:
        if self.library.normalizer is not None:
            piece = self.library.normalizer.normalize_str(piece)
        return [token for token, _ in self.library.pre_tokenizer.pre_tokenize_str(piece)]

    def is_special(self, word: str) -> bool:
        return "<" in word and self.special is not None and self.special.search(word) is not None

    def __call__(self, word: str) -> list[str]:
        """Pre-tokens of a word without special strings, spelled in the vocabulary's characters."""
        if word.isascii():
            if word.isalpha():
                return [word.lower()]
            if word.isprintable():
                return self.plain.findall(word.lower())
        elif self.short.fullmatch(word):
            return [x.encode().decode("latin-1").translate(self.spelled) for x in self.plain.findall(word.lower())]
        return self.by_library(word)


class TokenCounter:
    """Counts tokens as the library that a vocabulary file is for does, without added special tokens."""

    def __init__(self, path: str):
        self.pretokens = WordSplitter(path)
        model = self.pretokens.told["model"]
        if model["type"] != "BPE":
            raise ValueError(f"{path} holds a {model['type']} model; byte-pair merging needs BPE")
        self.merger = RaggedMerger(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.known: dict[str, int] = {}

    def learn(self, some: list[str]) -> None:
        """Adds the counts of words not yet known."""
        found, owner, extra = [], [], np.zeros(len(some), np.int64)
        for k, word in enumerate(some):
            if self.pretokens.is_special(word):
                extra[k] = len(self.pretokens.special.findall(word))
                own = [token for piece in self.pretokens.special.split(word) if piece for token in self.pretokens(piece)]
            else:
                own = self.pretokens(word)
            found += own
            owner += [k] * len(own)
        total = extra + np.bincount(np.array(owner, np.int64), weights=self.merger.counts(found), minlength=len(some)).astype(np.int64)
        self.known.update(zip(some, total.tolist(), strict=True))

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; a null has none. A token never spans white space, so words are counted once each."""
        flat, n_words = words.split(texts)
        coded = flat.dictionary_encode()
        some = coded.dictionary.to_pylist()
        if len(self.known) > KEPT_WORDS:  # short words come often, so they stay
            self.known = {word: n for word, n in self.known.items() if len(word) < 8}
            if len(self.known) > KEPT_WORDS // 2:
                self.known.clear()
        if new := [word for word in some if word not in self.known]:
            self.learn(new)
        per_word = np.fromiter(map(self.known.__getitem__, some), np.int64, len(some))
        running = np.concatenate([[0], np.cumsum(per_word[coded.indices.to_numpy()])])
        edges = np.concatenate([[0], np.cumsum(n_words)])
        return running[edges[1:]] - running[edges[:-1]]


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) for each row of docs: UTF-8 bytes and tokens of the whole text.

    path: a BPE vocabulary in the tokenizers library's JSON form that splits at white space, readable on every
    executor. A null text is empty; rows are counted one by one, so repeated ids keep a row each and null ids stay
    null; an empty table gives no rows. Other columns are not carried.
    """

    def run(batches):
        counts = counter(path)
        for batch in words.slices(batches):
            text = batch.column("text").fill_null("")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pc.binary_length(text).cast("int64"), pa.array(counts.count(text))], ["id", "n_bytes", "n_tokens"])

    return words.map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, "id long, n_bytes long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    done = token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))
