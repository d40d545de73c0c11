"""SimHash near-dedup, with candidates by a generalised pigeonhole principle."""

from __future__ import annotations

import itertools
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweave.llm import words
from logweave.llm.common import durable, fresh_names, id_or_last, read, written_table
from logweave.llm.components import components

BITS = 64


def fingerprints_of(texts: pa.Array, width: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    flat, counts = words.split(texts, words.LOWERED)
    data, starts, ends = words.joined(flat)
    out = np.zeros(len(counts), np.uint64)
    if not len(starts):
        return out
    edges = np.concatenate([[0], np.cumsum(counts)])
    # a shingle starts at each word that has width - 1 words of its text after it, or at the first of a shorter text
    n_shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), n_shingles)
    shingle_edges = np.concatenate([[0], np.cumsum(n_shingles)])
    first = edges[owner] + np.arange(len(owner)) - shingle_edges[owner]
    last = np.minimum(first + width, edges[owner + 1]) - 1
    cut = map(data.__getitem__, map(slice, starts[first].tolist(), ends[last].tolist()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, cut, itertools.repeat(42)), np.uint64, len(owner))
    some = n_shingles > 0
    ones = np.zeros((int(some.sum()), BITS), np.int64)
    at = shingle_edges[:-1][some]
    step = 1 << 16
    for low in range(0, len(owner), step):  # bits of a bounded number of shingles at a time
        high = min(low + step, len(owner))
        bits = np.unpackbits(hashes[low:high].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        a, b = np.searchsorted(at, low, "right") - 1, np.searchsorted(at, high, "left")
        ones[a:b] += np.add.reduceat(bits, np.maximum(at[a:b], low) - low, axis=0, dtype=np.int64)
    set_bits = ones * 2 > n_shingles[some][:, None]
    out[some] = np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)
    return out


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): a fingerprint for each row of docs, its bits as a long.

    A bit is 1 if set in over half the XXH64 (seed 42) of the text's width-word shingles, repeats included. A text of
    fewer words is one shingle; one without words, or null, has fingerprint 0. Ids are carried as they are.
    """

    def run(batches):
        for batch in words.slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fingerprints_of(batch.column("text"), width).view(np.int64))], ["id", "fp"])

    return words.map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), run, "id long, fp long")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Of all rows of prints: their number, and for each two bits how often both are set (64 x 64)."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)
            total += bits.T @ bits
            n += len(fp)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.ravel().tolist()])], ["n", "both"])

    parts = prints.select("fp").mapInArrow(run, "n long, both array<double>")
    summed = parts.select("n", F.posexplode("both")).groupBy("pos").agg(F.sum("col").alias("both"), F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS)
    for pos, value, _ in summed:  # 64 x 64 sums, whatever the input
        both[pos] = value
    return (summed[0][2] if summed else 0), both.reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits (0 the highest) in `parts` groups of equal size, correlated ones together.

    Each group starts from the free bit that correlates most with the others, and takes the one that correlates most
    with those that it has, again and again.
    """
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = BITS // parts + (k < BITS % parts)
        own = [max(free, key=lambda b: (related[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < size:
            own.append(max(free, key=lambda b: (related[b, own].sum(), -b)))
            free.remove(own[-1])
        out.append(sorted(own))
    return out


def packed(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, side by side in an integer."""
    out = np.zeros(len(fp), np.uint64)
    for bit in bits:
        out = (out << np.uint64(1)) | ((fp >> np.uint64(BITS - 1 - bit)) & np.uint64(1))
    return out


def flips(width: int, most: int) -> np.ndarray:
    """Every value of `width` bits of which at most `most` are set."""
    return np.array([sum(1 << b for b in some) for k in range(most + 1) for some in itertools.combinations(range(width), k)], np.uint64)


def allocate(costs: np.ndarray, distance: int) -> np.ndarray:
    """Thresholds for each row: costs[row, part, t + 1] is what threshold t (from -1: the part isn't probed) costs.

    Dynamic programming over the parts: the thresholds of a row add up to distance - parts + 1, which by the
    pigeonhole principle leaves no pair within the distance unprobed, at the least total cost.
    """
    rows, parts, levels = costs.shape
    units = distance + 1  # of t + 1, over all parts
    best = np.full((rows, units + 1), np.inf)
    best[:, 0] = 0
    picked = np.zeros((parts, rows, units + 1), np.int8)
    for part in range(parts):
        new = np.full_like(best, np.inf)
        for level in range(min(levels, units + 1)):
            cost = best[:, : units + 1 - level] + costs[:, part, level][:, None]
            better = cost < new[:, level:]
            new[:, level:][better] = cost[better]
            picked[part][:, level:][better] = level
        best = new
    out, left = np.zeros((rows, parts), np.int64), np.full(rows, units)
    for part in reversed(range(parts)):
        out[:, part] = picked[part][np.arange(rows), left]
        left -= out[:, part]
    return out - 1


def within(values: np.ndarray, p: np.ndarray, most: int) -> np.ndarray:
    """For each value, the chance that a row of independent bits with rates p lies within 0 ... most of it."""
    width = len(p)
    near = np.zeros((len(values), most + 1))
    near[:, 0] = 1
    for k in range(width):
        bit = (values >> np.uint64(width - 1 - k)) & np.uint64(1)
        differs = np.where(bit == 1, 1 - p[k], p[k])[:, None]
        near[:, 1:] = near[:, 1:] * (1 - differs) + near[:, :-1] * differs
        near[:, :1] *= 1 - differs
    return np.cumsum(near, axis=1)


def links(prints: DataFrame, distance: int = 3, parts: int = 2) -> DataFrame:
    """(a, b, bits): all pairs of rows of prints (rep, fp; fp distinct) whose fingerprints differ in <= distance bits, a < b.

    The bits fall into `parts` groups of correlated ones, by counts over all rows. A row gets a threshold for each
    group, by dynamic programming on the candidates to be expected: rows that hold its very value there (counted) and
    independent bits at the measured rates (for those near it), besides the values to be probed. It probes every value
    within its threshold; who holds one is a candidate, and is verified on all 64 bits. Two halves are the default:
    with quarters, a candidate would have 1 / 65536 of all rows as candidates, which is quadratic in earnest at 10^9.
    """
    prints = durable(prints)
    n, both = bit_statistics(prints)
    groups = grouped_bits(n, both, parts)
    rates = np.clip(np.diag(both) / max(n, 1), 1e-6, 1 - 1e-6)

    def values(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k, bits in enumerate(groups):
                own = pa.array(np.full(len(fp), k, np.int32)), pa.array(packed(fp, bits).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("fp"), *own], ["rep", "fp", "part", "value"])

    held = durable(prints.select("rep", "fp").mapInArrow(values, "rep long, fp long, part int, value long"))
    counts = held.groupBy("part", "value").agg(F.count("*").alias("n")).where("n > 1")
    crowd = held.join(counts, ["part", "value"]).groupBy("rep").agg(F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("crowd"))
    rows = prints.join(crowd, "rep", "left").select("rep", "fp", *[F.coalesce(F.col("crowd")[k], F.lit(1)).cast("long").alias(f"c{k}") for k in range(parts)])

    def probes(batches):
        patterns = [[flips(len(bits), t) for t in range(distance + 1)] for bits in groups]
        for batch in words_of_rows(batches):
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            rep = batch.column("rep").to_numpy(zero_copy_only=False)
            costs = np.zeros((len(fp), parts, distance + 2))
            for k, bits in enumerate(groups):
                crowded = batch.column(f"c{k}").to_numpy(zero_copy_only=False)
                own = within(packed(fp, bits), rates[bits], distance)
                for t in range(distance + 1):
                    costs[:, k, t + 1] = len(patterns[k][t]) + n * own[:, t] + (crowded - 1) * (1 + t)
            chosen = allocate(costs, distance)
            for k, bits in enumerate(groups):
                value = packed(fp, bits)
                for t in range(distance + 1):
                    if (some := chosen[:, k] == t).any():
                        for low in range(0, int(some.sum()), 2000):
                            piece = np.flatnonzero(some)[low : low + 2000]
                            probed = (value[piece][:, None] ^ patterns[k][t][None, :]).ravel()
                            many = len(patterns[k][t])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.repeat(rep[piece], many)), pa.array(np.repeat(fp[piece], many).view(np.int64)), pa.array(np.full(len(probed), k, np.int32)), pa.array(probed.view(np.int64))],
                                ["of", "as", "part", "value"],
                            )

    asked = rows.mapInArrow(probes, "of long, as long, part int, value long")
    bits = F.bit_count(F.col("fp").bitwiseXOR(F.col("as")))
    found = asked.join(held, (asked["part"] == held["part"]) & (asked["value"] == held["value"]) & (F.col("of") != F.col("rep")) & (bits <= distance))
    return found.select(F.least("of", "rep").alias("a"), F.greatest("of", "rep").alias("b"), bits.cast("int").alias("bits")).distinct()


def words_of_rows(batches, most: int = 4096):
    for batch in batches:
        for low in range(0, batch.num_rows, most):
            yield batch.slice(low, most)


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, parts: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component): the fingerprint of each row of docs and the smallest id that links lead to, itself included.

    Fingerprints link at `distance` or fewer differing bits. Rows of one fingerprint are one node from the start, so
    a group of copies of any size costs no pairs; only distinct fingerprints are probed, and links stay distributed.
    Null and empty texts share fingerprint 0; a null id sorts last, as 2^63 - 1; rows with one id keep a row each; an
    empty table gives no rows. Other columns are not carried.
    """
    prints = durable(fingerprints(docs, width, id_col, text_col))
    nodes = prints.groupBy("fp").agg(F.min(id_or_last("id")).alias("rep"))
    nodes = durable(nodes)
    # fingerprints are the nodes' names while they are linked; ids come back afterwards
    linked = links(nodes.select(F.col("fp").alias("rep"), "fp"), distance, parts)
    member = components(linked.select("a", "b"))
    least = nodes.join(member, nodes["fp"] == member["node"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("root"))
    roots = least.groupBy("root").agg(F.min("rep").alias("component"))
    named = least.select("fp", "root").join(roots, "root").select(F.col("fp").alias("_fp"), "component")
    return prints.join(named, prints["fp"] == named["_fp"]).select("id", "fp", "component")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = near_duplicates(read(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


#: Lanes of a long, one for each bit of a byte, the highest first.
_LANES = np.array([sum((byte >> bit & 1) << 8 * bit for bit in range(8)) for byte in range(256)], np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, owner) of the different shingles of each text, by owner and code; a text of fewer words than a shingle is one."""
    codes, edges = words.shingle_codes(texts, width, short=True)
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return codes[new], owner[new]


def wide_prints_of(texts: pa.Array, width: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles, their sum, blocks of 64 bits) of each text: SimHash over its set of shingles, each block with hashes of its own.

    Bits are counted in eight lanes of a long, over runs of 255 shingles at most, so that no lane runs over.
    """
    codes, owner = shingle_sets(texts, width)
    sizes = np.bincount(owner, minlength=len(texts))
    out = np.zeros((len(texts), blocks), np.uint64)
    sums = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(sizes)
    if not len(some):
        return sizes, sums, out
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    sums[some] = np.add.reduceat(codes, first[some])
    runs = -(-sizes[some] // 255)
    of_text = np.concatenate([[0], np.cumsum(runs)[:-1]])
    cuts = np.repeat(first[some], runs) + 255 * (np.arange(runs.sum()) - np.repeat(of_text, runs))
    half = sizes[some][:, None]
    for block in range(blocks):
        mixed = (codes ^ np.uint64(0x9E3779B97F4A7C15 * (block + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
        mixed ^= mixed >> np.uint64(32)
        for byte in range(8):
            lanes = np.add.reduceat(_LANES[(mixed >> np.uint64(8 * byte)).astype(np.uint8)], cuts)
            ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), of_text, axis=0)
            bits = np.packbits(ones * 2 > half, axis=1, bitorder="little").ravel().astype(np.uint64)
            out[some, block] |= bits << np.uint64(8 * byte)
    return sizes, sums, out


def partition_plan(n: int, similarity: float, recall: float) -> tuple[int, int, int]:
    """(bits of a part, parts of a block, blocks): so that parts are told apart among n rows, and alike pairs are found with the chance `recall`.

    Sets of that Jaccard similarity and about equal sizes differ in each bit with a chance of acos(cosine) / pi. A pair
    is a candidate where all bits of a part are equal; with thresholds of 0 for each part the pigeonhole principle
    leaves out no pair that differs in fewer bits than there are parts, and chance finds those that differ in more.
    """
    cosine = 2 * similarity / (1 + similarity)
    same = 1 - np.arccos(cosine) / np.pi
    width = int(min(32, max(16, np.ceil(np.log2(max(n, 2))) + 2)))
    parts = 64 // width
    blocks = int(np.ceil(np.log1p(-recall) / np.log1p(-(same**width)) / parts))
    return width, parts, max(2, blocks)


def block_statistics(prints: DataFrame, blocks: int) -> tuple[int, np.ndarray]:
    """Of all rows of prints (fps): their number, and for each block and two bits of it how often both are set."""

    def run(batches):
        total, n = np.zeros((blocks, BITS, BITS)), 0
        for batch in batches:
            fps = batch.column("fps").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, blocks)
            for low in range(0, len(fps), 2048):
                bits = np.unpackbits(fps[low : low + 2048].astype(">u8").view(np.uint8).reshape(-1, blocks, 8), axis=2).astype(np.float32)
                total += np.matmul(bits.transpose(1, 2, 0), bits.transpose(1, 0, 2))
            n += len(fps)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks), pa.int32()), pa.array(np.full(blocks, n)), pa.array(list(total.reshape(blocks, -1)))], ["block", "n", "both"])

    def added(batches):
        held: dict[int, list] = {}
        for batch in batches:
            both = batch.column("both").flatten().to_numpy(zero_copy_only=False).reshape(-1, BITS * BITS)
            for k, (block, n) in enumerate(zip(batch.column("block").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                old = held.setdefault(block, [0, np.zeros(BITS * BITS)])
                old[0] += n
                old[1] += both[k]
        for block, (n, both) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([n]), pa.array([both.tolist()])], ["block", "n", "both"])

    schema = "block int, n long, both array<double>"
    summed = prints.select("fps").mapInArrow(run, schema).repartition("block").mapInArrow(added, schema).collect()  # 64 x 64 sums for each block
    both = np.zeros((blocks, BITS, BITS))
    for block, _, values in summed:
        both[block] = np.reshape(values, (BITS, BITS))
    return (summed[0][1] if summed else 0), both


def thresholds(n: int, both: np.ndarray, groups: list[list[int]]) -> list[int]:
    """A threshold for each group of bits of a block, the same for all rows: by dynamic programming on expected candidates.

    With a threshold t a row probes all values within t bits, and meets the rows that lie there: with independent bits
    at the measured rates. The thresholds add up to 0, as those of one block's own pigeonhole principle.
    """
    costs = np.zeros((1, len(groups), 3))
    for k, bits in enumerate(groups):
        rates = np.clip(np.diag(both)[bits] / max(n, 1), 1e-6, 1 - 1e-6)
        near = np.array([1.0, 0.0])
        for p in rates:
            differ = 2 * p * (1 - p)
            near = np.array([near[0] * (1 - differ), near[1] * (1 - differ) + near[0] * differ])
        costs[0, k, 1], costs[0, k, 2] = 1 + n * near[0], 1 + len(bits) + n * near.sum()
    return allocate(costs, len(groups) - 1)[0].tolist()


def similar_documents(docs: DataFrame, width: int = 5, similarity: float = 0.8, recall: float = 0.97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, component): the smallest id that near copies lead to, itself included, for each different id of docs.

    Near copies have sets of `width`-word shingles with a Jaccard similarity of at least `similarity`, worked out
    exactly for every candidate. Candidates come from SimHash blocks of 64 bits (see partition_plan for how many, and
    the chance `recall` with which a pair at just that similarity becomes one): each block's correlated bits are
    grouped into parts, which get thresholds; who holds a probed value is compared with the smallest id that holds it,
    if the next block's bits agree by and large. What chance and these bounds leave out is found by prefixes (see
    prefix_pairs), which miss nothing, among documents that aren't linked by then. So the result doesn't depend on
    `recall`. Equal sets of shingles, and texts without words, are one node from the start.
    A text of fewer words than a shingle is one shingle. Ids that repeat are one document, whose words are those of its
    smallest text; null ids sort last; an empty table gives no rows.
    """
    texts = docs.select(id_or_last(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = docs.count()
    size, parts, blocks = partition_plan(n, similarity, recall)

    def run(batches):
        for batch in words.slices(batches):
            sizes, sums, fps = wide_prints_of(batch.column("text"), width, blocks)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, fps.size + 1, blocks), pa.int32()), pa.array(fps.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes.astype(np.int64)), pa.array(sums.view(np.int64)), lists], ["id", "size", "sum", "fps"])

    found = words.map_arrow(texts, run, "id long, size long, sum long, fps array<long>")
    prints = durable(found.withColumn("same", F.xxhash64("size", "sum", "fps")).drop("sum"))
    nodes = durable(prints.groupBy("same").agg(F.min("id").alias("node")))
    distinct = durable(prints.join(nodes, (F.col("id") == F.col("node")) & (prints["same"] == nodes["same"])).select("node", "size", "fps").dropDuplicates(["node"]))
    held, both = block_statistics(distinct, blocks)
    groups = [[bits[:size] for bits in grouped_bits(held, both[block], parts)] for block in range(blocks)]
    levels = [thresholds(held, both[block], groups[block]) for block in range(blocks)]

    def values(batches):
        for batch in words_of_rows(batches):
            fps = batch.column("fps").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, blocks)
            full = np.flatnonzero(batch.column("size").to_numpy(zero_copy_only=False))
            node = batch.column("node").to_numpy(zero_copy_only=False)[full]
            for block in range(blocks):
                beside = pa.array(fps[full, (block + 1) % blocks].view(np.int64))
                for k, bits in enumerate(groups[block]):
                    if levels[block][k] < 0:
                        continue
                    value = packed(fps[full, block], bits)
                    for flip in flips(len(bits), levels[block][k]).tolist():
                        key = (value ^ np.uint64(flip)) << np.uint64(24) | np.uint64(block * parts + k)
                        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(key.view(np.int64)), beside], ["node", "key", "beside"])

    rows = words.map_arrow(distinct, values, "node long, key long, beside long")
    heads = durable(rows.groupBy("key").agg(F.min(F.struct("node", "beside")).alias("head"), F.max("node").alias("last")).where(F.col("head.node") < F.col("last")).drop("last"))
    far = int(BITS * np.arccos(2 * similarity / (1 + similarity)) / np.pi + 4 * np.sqrt(BITS) * 0.36) + 1
    near = rows.join(heads, "key").where((F.col("node") != F.col("head.node")) & (F.bit_count(F.col("beside").bitwiseXOR(F.col("head.beside"))) <= far))
    pairs = durable(near.select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct())
    linked = durable(_alike(pairs, texts, width, similarity))
    of = durable(prints.select("id", "same").join(nodes, "same").select("id", "node"))
    rest = durable(_alike(prefix_pairs(texts, of, components(linked), n, width, similarity), texts, width, similarity))
    member = components(linked.unionByName(rest)).withColumnRenamed("node", "_node")
    named = of.join(member, F.col("node") == F.col("_node"), "left")
    return named.groupBy("id").agg(F.min(F.coalesce("component", "node")).alias("component"))


def _alike(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """Those of pairs (a, b) whose texts (id, text), the smallest of an id, have sets of shingles with at least that Jaccard similarity."""
    own = texts.groupBy("id").agg(F.min("text").alias("text"))
    one = own.join(pairs.select("a").union(pairs.select("b")).distinct(), F.col("id") == F.col("a"), "left_semi")
    told = pairs.join(one.select(F.col("id").alias("a"), F.col("text").alias("text")), "a").join(one.select(F.col("id").alias("b"), F.col("text").alias("other")), "b")

    def verify(batches):
        for batch in words.slices(batches):
            (codes, edges), (others, ends) = (words.shingle_codes(batch.column(c), width, short=True) for c in ("text", "other"))
            keep = []
            for k in range(batch.num_rows):
                x, y = np.unique(codes[edges[k] : edges[k + 1]]), np.unique(others[ends[k] : ends[k + 1]])
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return words.map_arrow(told.select("a", "b", "text", "other"), verify, "a long, b long")


def usual_shingles(texts: DataFrame, n: int, width: int, look: int = 20_000, most: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(codes in order, counts) of shingles that three or more of about `look` texts have, `most` at most: to be last in prefixes.

    Any order of all shingles is right; one in which usual ones come last makes few candidates.
    """

    def run(batches):
        for batch in words.slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(batch.column("text"), width)[0].view(np.int64))], ["code"])

    some = texts.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // look))) == 0)
    held = words.map_arrow(some.select("text"), run, "code long").groupBy("code").agg(F.count("*").alias("n")).where("n > 2")
    rows = held.orderBy(F.desc("n"), "code").limit(most).collect()
    codes, counts = np.array([r[0] for r in rows], np.int64).view(np.uint64), np.array([r[1] for r in rows], np.int64)
    order = np.argsort(codes)
    return codes[order], counts[order]


def prefix_pairs(texts: DataFrame, of: DataFrame, member: DataFrame, n: int, width: int, similarity: float) -> DataFrame:
    """(a, b), a the smaller: all nodes that may be as alike and aren't of one component, n being about the number of texts (id, text).

    of (id, node) names an id's nodes, member (node, component) the components so far. Two sets with a Jaccard
    similarity of at least `similarity` have in common at least that share of the larger one. So in any one order of
    all shingles, the first 1 - similarity of each, and one more, have a shingle in common, and at the first such one
    enough are left of both. Shingles of one document alone, and of one component alone, go before any pair is made.
    """
    usual, counts = usual_shingles(texts, n, width)

    def run(batches):
        for batch in words.slices(batches):
            codes, owner = shingle_sets(batch.column("text"), width)
            at = np.minimum(np.searchsorted(usual, codes), max(len(usual) - 1, 0))
            rank = np.where(usual[at] == codes, counts[at], 0) if len(usual) else np.zeros(len(codes), np.int64)
            order = np.lexsort((codes, rank, owner))
            codes, owner = codes[order], owner[order]
            sizes = np.bincount(owner, minlength=batch.num_rows)
            place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            taken = np.flatnonzero(place < (sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1)[owner])
            ids = batch.column("id").to_numpy()
            columns = codes[taken].view(np.int64), ids[owner[taken]], sizes[owner[taken]].astype(np.int32), place[taken].astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["code", "id", "size", "place"])

    rows = written_table(words.map_arrow(texts, run, "code long, id long, size int, place int"))
    shared = rows.groupBy("code").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("code")
    live = rows.join(shared, "code", "left_semi").join(of, "id")
    named = live.join(member.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    held = written_table(named.select("code", "node", "size", "place", F.coalesce("component", "node").alias("component")).distinct())
    split = held.groupBy("code").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("code")
    one = written_table(held.join(split, "code", "left_semi"))
    other = one.select(*[F.col(c).alias(f"_{c}") for c in one.columns])
    both = F.col("size") + F.col("_size")
    enough = F.least(F.col("size") - F.col("place"), F.col("_size") - F.col("_place")) >= F.lit(similarity / (1 + similarity)) * both - 1e-6
    alike = (F.least("size", "_size") >= F.lit(similarity) * F.greatest("size", "_size") - 1e-6) & enough
    pairs = one.join(other, (F.col("code") == F.col("_code")) & (F.col("node") < F.col("_node")) & (F.col("component") != F.col("_component")) & alike)
    return durable(pairs.select(F.col("node").alias("a"), F.col("_node").alias("b")).distinct())


def keep_similar_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs whose id is the smallest of their group of near copies, all columns carried; how: as for similar_documents.

    A document is an id; null ids are one document that sorts last. Of rows repeated with id and text one stays.
    """
    found = similar_documents(docs, id_col=id_col, text_col=text_col, **how)
    return _one_row_each(docs, found.where("id = component").select("id"), id_col, text_col)


def _one_row_each(docs: DataFrame, stay: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs whose id is in stay (id), each once for an id and a text."""
    own, stays, turn = fresh_names(docs, "_id", "_stays", "_turn")
    kept = docs.withColumn(own, id_or_last(id_col)).join(stay.select(F.col("id").alias(stays)), F.col(own) == F.col(stays), "left_semi")
    once = Window.partitionBy(own, F.xxhash64(text_col)).orderBy(own)
    return kept.withColumn(turn, F.row_number().over(once)).where(F.col(turn) == 1).drop(own, turn)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs whose id is the smallest of their group, all columns carried; how: as for near_duplicates.

    A document is an id: rows of the id that stays, with other texts, stay too, but a row repeated with its text stays
    once. Null ids are one document that sorts last.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    return _one_row_each(docs, found.where(id_or_last("id") == F.col("component")).select(id_or_last("id").alias("id")).distinct(), id_col, text_col)
