"""SimHash near-duplicates by meeting in the middle.

Two fingerprints differ in at most 2r bits exactly when some value lies within r bits of both. Every
distinct fingerprint stands for all variants within r flips; variants are shuffled by their leading
bits, and those that collide link their owners. A fingerprint is sent once for each leading-bit
pattern that its variants can have, and the variants themselves are made where they meet, so the
shuffle carries tens of values for each fingerprint instead of thousands.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from ledgersieve.llm.graph import components
from ledgersieve.llm.words import row_offsets, slices
from ledgersieve.sources.cut import cut

SEED = 42
# Variants that meet under one pattern of leading bits, and those that one step of a task holds at a time.
BUCKET_VARIANTS = 1 << 22
LEAF_VARIANTS = 1 << 20
_U = np.uint64
_FILTER_BITS = 22


def shingle_hashes(text: str | None, words: int) -> list[int]:
    """XXH64 of every run of `words` words, A-Z in lower case, joined by one space."""
    found = (text or "").encode().lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    starts = row_offsets(lengths + 1)[:-1]
    ends = starts + lengths
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())]


def majority_bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A fingerprint for each range of hashes: the bits set in over half of them; 0 for an empty range."""
    counts = np.diff(bounds)
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        sums = np.add.reduceat(bits, bounds[full], axis=0, dtype=np.int32)
        set_bits = 2 * sums > counts[full, None]
        out[full] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with `fingerprint`, a signed 64-bit column. All other columns pass through."""
    passed = docs.columns
    schema = StructType([*docs.schema.fields, StructField("fingerprint", LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros(0, np.uint64)]
            for a, b in slices(batch, text_col):
                hashes = [shingle_hashes(t, words) for t in batch[text_col].slice(a, b - a).to_pylist()]
                bounds = row_offsets(np.array([len(h) for h in hashes], np.int64))
                flat = np.fromiter((x for h in hashes for x in h), np.uint64, int(bounds[-1]))
                parts.append(majority_bits(flat, bounds))
            found = pa.array(np.concatenate(parts).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in passed], found], names=[*passed, "fingerprint"])

    return docs.mapInArrow(add, schema)


def flip_masks(bits: range, flips: int) -> list[np.ndarray]:
    """Masks over the given bit positions, by their number of flips."""
    return [
        np.array([sum(1 << b for b in chosen) for chosen in combinations(bits, k)], np.uint64)
        for k in range(flips + 1)
    ]


def _links_at(prints: np.ndarray, left: np.ndarray, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (first, other) of positions that meet in a variant whose high bits are settled.

    `left`: the flips each print may still spend on its `low_bits` low bits. Each group of prints
    that meet is linked to its first member only.
    """
    low = _U((1 << low_bits) - 1)
    masks = flip_masks(range(low_bits), int(left.max(initial=0)))
    parts, owners = [], []
    for spent, mask in enumerate(masks):
        able = np.flatnonzero(left >= spent)
        parts.append(((prints[able] & low)[:, None] ^ mask[None, :]).ravel())
        owners.append(np.repeat(able, len(mask)))
    variants, owner = np.concatenate(parts), np.concatenate(owners)
    # Values alone in their slot of a hashed count cannot meet another; the rest is sorted.
    slot = ((variants * _U(0x9E3779B97F4A7C15)) >> _U(64 - _FILTER_BITS)).astype(np.int32)
    shared = np.flatnonzero(np.bincount(slot, minlength=1 << _FILTER_BITS).astype(np.int32)[slot] > 1)
    variants, owner = variants[shared], owner[shared]
    order = np.lexsort((owner, variants))
    variants, owner = variants[order], owner[order]
    if not len(variants):
        return owner, owner
    start = np.flatnonzero(np.concatenate([[True], variants[1:] != variants[:-1]]))
    first = np.repeat(owner[start], np.diff(np.append(start, len(variants))))
    met = first != owner
    return first[met], owner[met]


def _descend(prints: np.ndarray, left: np.ndarray, low_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Settle further bits until a step is small enough. Yields links as pairs of prints."""
    if len(prints) < 2:
        return
    size = sum(len(m) * int((left >= k).sum()) for k, m in enumerate(flip_masks(range(low_bits), int(left.max()))))
    if size <= LEAF_VARIANTS or not low_bits:
        a, b = _links_at(prints, left, low_bits)
        if len(a):
            yield prints[a], prints[b]
        return
    bit = (prints >> _U(low_bits - 1)) & _U(1)
    for value in (0, 1):
        after = left - (bit != value)
        able = after >= 0
        yield from _descend(prints[able], after[able], low_bits - 1)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: every node to the least one it reaches through these."""
    nodes, coded = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = coded[: len(a)], coded[len(a) :]
    label = np.arange(len(nodes))
    while True:
        new, least = label.copy(), np.minimum(label[x], label[y])
        for target in (x, y, label[x], label[y]):
            np.minimum.at(new, target, least)
        new = new[new]
        if np.array_equal(new, label):
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            return nodes[label[moved]], nodes[moved]
        label = new


def near_links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints within `max_bits` of each other, directly or in chains.

    `prints` has one `fingerprint` per row, without repeats. No group of prints is turned into all
    its pairs: those that meet in a variant hang on one of them, and a task returns a forest.
    """
    spark, flips = prints.sparkSession, (max_bits + 1) // 2
    n = prints.count()
    variants = sum(math.comb(64, k) for k in range(flips + 1))
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    high = min(24, max(6, math.ceil(math.log2(max(1, n * variants / BUCKET_VARIANTS, tasks)))))
    low_bits = 64 - high

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.concatenate(flip_masks(range(high), flips))
        held = [np.zeros(0, np.uint64)] + [b.column(0).to_numpy().view(np.uint64) for b in batches]
        values = np.concatenate(held)
        for at in range(0, len(values), 1 << 16):
            part = values[at : at + (1 << 16)]
            bucket = ((part >> _U(low_bits))[:, None] ^ masks[None, :]).ravel()
            owner = np.repeat(np.arange(len(part)), len(masks))
            order = np.argsort(bucket, kind="stable")
            bucket, owner = bucket[order], owner[order]
            start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            stop = np.append(start[1:], len(bucket))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[start].astype(np.int32)),
                 pa.array([part[owner[a:b]].tobytes() for a, b in zip(start, stop)], pa.binary())],
                names=["bucket", "prints"])

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = np.concatenate([np.frombuffer(x, np.uint64) for x in table["prints"].to_pylist()])
        spent = np.bitwise_count((values >> _U(low_bits)) ^ _U(key[0].as_py())).astype(np.int64)
        links = list(_descend(values, flips - spent, low_bits))
        a = np.concatenate([np.zeros(0, np.uint64), *[x for x, _ in links]])
        b = np.concatenate([np.zeros(0, np.uint64), *[y for _, y in links]])
        true = np.bitwise_count(a ^ b) <= max_bits
        a, b = forest(a[true], b[true])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = prints.select("fingerprint").mapInArrow(
        send, StructType([StructField("bucket", IntegerType()), StructField("prints", BinaryType())]))
    links = StructType([StructField("a", LongType()), StructField("b", LongType())])
    return dealt.groupBy("bucket").applyInArrow(meet, links).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text",
    root_col: str | None = None,
) -> DataFrame:
    """`docs` with `fingerprint` (signed 64-bit) and `component_id`, the least id its links reach.

    Texts without words (NULL, empty, white space) have fingerprint 0 and are linked like any other.
    Rows that share an id are separate rows of the same id. A NULL id is never a component id unless
    no row of the component has one. With `root_col`, a column of that name tells components apart
    whatever their ids: it holds one fingerprint of the component. Columns other than the text pass
    through unchanged; input columns with the names of the results give way to them. An empty table
    gives an empty table.
    """
    docs = docs.drop("fingerprint", "component_id", *[root_col] * bool(root_col))
    # Fingerprints are stored on their own, so texts are neither shuffled nor hashed twice here.
    marked = cut(fingerprints(docs, words, id_col, text_col).drop(text_col), "fingerprints")
    least = cut(marked.groupBy("fingerprint").agg(F.min(id_col).alias("least")), "distinct")
    linked = components(near_links(least, max_bits))
    roots = least.join(linked, least["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    added = ["component_id"] + [root_col] * bool(root_col)
    labels = roots.join(named, "root").withColumn(root_col or "root", F.col("root")).select("fingerprint", *added)
    return marked.join(labels, "fingerprint").select(*marked.columns, *added)
