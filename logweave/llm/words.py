"""Words of whole texts in Arrow arrays, for the operators that count in numpy."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from logweave.llm.common import LOWER, SPACE, UPPER

#: Bytes as they are, but A-Z in lower case.
LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Lower case, and every ASCII character but letters and digits a space.
ALNUM = bytes(LOWERED[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds about `most` bytes of text, or one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with every byte looked up in the table; nulls are empty."""
    texts = pa.concat_arrays([texts.fill_null("")])
    _, offsets, data = texts.buffers()
    data = pa.py_buffer((data.to_pybytes() if data else b"").translate(table))
    return pa.Array.from_buffers(texts.type, len(texts), [None, offsets, data], 0, texts.offset)


def split(texts: pa.Array, table: bytes | None = None) -> tuple[pa.Array, np.ndarray]:
    """All words (runs without ASCII white space) in one array, and how many each text has."""
    texts = translated(texts, table) if table else texts.fill_null("")
    lists = pc.ascii_split_whitespace(texts)
    flat, ends = lists.flatten(), np.diff(lists.offsets.to_numpy())
    full = pc.not_equal(flat, "")
    seen = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    edges = np.concatenate([[0], np.cumsum(ends)])
    return flat.filter(full), seen[edges[1:]] - seen[edges[:-1]]


def joined(flat: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with a space after each, as bytes, and where each starts and ends."""
    lengths = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1
    spaced = pc.binary_join_element_wise(flat, "", " ")
    spaced = pa.concat_arrays([spaced]) if len(spaced) else spaced
    data = spaced.buffers()[2] if len(spaced) else None
    return (data.to_pybytes() if data else b""), ends - lengths, ends


def shingle_codes(texts: pa.Array, width: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of `width` words, made of their words' hashes, and where each text's begin and end among them.

    short: a text of fewer words, but not none, has one shingle of them all.
    """
    flat, counts = split(texts, LOWERED)
    n = np.maximum(counts - width + 1, np.minimum(counts, 1) if short else 0)
    edges = np.concatenate([[0], np.cumsum(n)])
    if not edges[-1]:
        return np.zeros(0, np.uint64), edges
    coded = flat.dictionary_encode()
    data, starts, ends = joined(coded.dictionary)
    cut = map(data.__getitem__, map(slice, starts.tolist(), ends.tolist()))
    each = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(42)), np.uint64, len(starts))[coded.indices.to_numpy()]
    owner = np.repeat(np.arange(len(counts)), n)
    first = np.concatenate([[0], np.cumsum(counts)])[owner] + np.arange(edges[-1]) - edges[owner]
    size = np.minimum(counts, width)[owner] if short else np.full(len(owner), width)
    out = each[first]
    for k in range(1, width):
        out = out * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
        out += np.where(size > k, each[np.minimum(first + k, len(each) - 1)], np.uint64(0))
    return out, edges


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches that stay small however long texts are, unless the session already says how."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, "-1", str(2**63 - 1), str(2**31 - 1)):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def give_back() -> None:
    """Memory that Python and Arrow no longer use goes back to the system: a worker stays between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(docs: DataFrame, function, schema: str) -> DataFrame:
    small_batches(docs.sparkSession)

    def run(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return docs.mapInArrow(run, schema)
