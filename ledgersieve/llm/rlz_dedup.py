"""Remove passages that occur in an earlier document, by relative Lempel-Ziv parsing.

The reference is all documents, indexed in blocks. Every window of `window` words belongs to the
block of its anchor, the least hash among the short word runs inside it, so equal windows always
meet in one block, and a block never holds more than its share of the anchors. A document is
factored against the blocks: the index gives the earliest place of every window, and a factor runs on
for as long as the next window's earliest place follows on. A factor is not the longest match with its
document where a still earlier one holds part of it; what is removed is the same. Factors of at least `window` words that point to a smaller id are removed.

Documents are dealt once to groups of a few megabytes (the shuffle of the texts is reused). Between
groups and blocks go only sorted lists without repeats, so a passage that a third of all documents
hold is one entry per group:
1. groups send signatures of their anchors, blocks answer which of them other groups hold too;
2. groups send the windows of those anchors, blocks answer the earliest place of each;
3. groups factor their documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType,
)

from ledgersieve.llm.words import mix, row_offsets, slices, split_words, text_bytes

# Bytes of text that one group holds.
GROUP_BYTES = 1 << 22
ANCHOR_WORDS = 5
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_NO_ID = np.iinfo(np.int64).max  # a missing id comes after all others

_FACTOR = pa.struct([(n, pa.int64()) for n in ("start", "length", "ref_id", "ref_start")])


def _rolled(hashes: np.ndarray, at: np.ndarray | None, n: int) -> np.ndarray:
    """Hash of the n words from each position (all positions, or those of `at`)."""
    total = np.zeros(len(hashes) - n + 1 if at is None else len(at), np.uint64)
    for t in range(n):
        total *= _STEP
        total += hashes[t : len(hashes) - n + 1 + t] if at is None else hashes[at + t]
    return mix(total)


class Group:
    """Words and windows of the documents of one group."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        ids = table["id"].combine_chunks()
        self.ids = ids
        keys = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for a, b in slices(table, "text"):
            words = split_words(*text_bytes(table["text"].slice(a, b - a)))
            hashes.append(words.hashes())
            counts.append(np.diff(words.bounds))
        self.hashes, self.counts = np.concatenate(hashes), np.concatenate(counts)
        self.bounds = row_offsets(self.counts)
        per_doc = np.maximum(self.counts - window + 1, 0)
        doc = np.repeat(np.arange(len(keys)), per_doc)
        self.at = np.arange(len(doc)) - np.repeat(row_offsets(per_doc)[:-1] - self.bounds[:-1], per_doc)
        self.doc, self.key = doc, keys[doc]
        self.place = self.at - self.bounds[:-1][doc]

    def anchors(self) -> np.ndarray:
        """The anchor of every window."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        size = min(ANCHOR_WORDS, self.window)
        runs = _rolled(self.hashes, None, size)
        left, least, reach = self.window - size + 1, runs, 1
        while reach < left:
            step = min(reach, left - reach)
            least = np.minimum(least[: len(least) - step], least[step:])
            reach += step
        return least[self.at]

    def windows(self, chosen: np.ndarray | slice = slice(None)) -> np.ndarray:
        return _rolled(self.hashes, self.at[chosen], self.window)


def _first(hashes: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by (hash, id, place), and a flag on the first row of each hash in that order."""
    order = np.lexsort((place, key, hashes))
    ordered = hashes[order]
    return order, np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)


def _cuts(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal values in a sorted array."""
    if len(values):
        start = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        yield from zip(start.tolist(), [*start[1:].tolist(), len(values)])


def _joined(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[column].to_pylist()), kind)


def rlz_dedup(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, text (kept words joined by one space), n_words, n_removed, factors.

    `factors` lists start, length, ref_id and ref_start in words; a factor's windows all occur in the
    document ref_id, which is smaller. Words are runs outside `[\\x20\\x09-\\x0D]`, compared as they
    are. NULL, empty and blank texts have no words. A row without an id is never a reference but
    loses what others hold; rows that share an id do not shorten each other. Other columns are not
    read. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / GROUP_BYTES))
    dealt = own.withColumn("g", F.pmod(F.xxhash64("id", "text"), F.lit(groups)).cast("int")).repartition("g")

    def block_of(anchors: np.ndarray) -> np.ndarray:
        return (anchors % _U(groups)).astype(np.int32)

    def signatures(group: Group) -> tuple[np.ndarray, np.ndarray]:
        """Anchors without repeats, ordered by block, and their blocks."""
        anchors = np.unique(group.anchors())
        block = block_of(anchors)
        order = np.argsort(block, kind="stable")
        return anchors[order], block[order]

    def send_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        anchors, block = signatures(Group(table, window))
        short = (anchors >> _U(32)).astype(np.uint32)
        rows = [(int(block[a]), key[0].as_py(), short[a:b].tobytes()) for a, b in _cuts(block)]
        return pa.Table.from_pylist([dict(zip(("block", "g", "anchors"), r)) for r in rows], send_schema)

    def shared_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint32) for x in table["anchors"].to_pylist()]
        _, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        ends = row_offsets(np.array([len(x) for x in lists]))
        shared = counts[inverse] > 1
        masks = [np.packbits(shared[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
        return pa.table({"g": table["g"], "block": table["block"], "mask": pa.array(masks, pa.binary())})

    def send_windows(key: tuple[pa.Scalar, ...], table: pa.Table, masks: pa.Table) -> pa.Table:
        group = Group(table, window)
        anchors, block = signatures(group)
        shared = np.zeros(len(anchors), bool)
        by_block = dict(zip(masks["block"].to_pylist(), masks["mask"].to_pylist()))
        for a, b in _cuts(block):
            shared[a:b] = np.unpackbits(np.frombuffer(by_block[int(block[a])], np.uint8), count=b - a)
        held = np.sort(anchors[shared])
        of = group.anchors()
        found = np.searchsorted(held, of)
        chosen = np.flatnonzero((found < len(held)) & (held[np.minimum(found, len(held) - 1)] == of)) if len(held) else np.zeros(0, np.int64)
        hashes, key_of, place = group.windows(chosen), group.key[chosen], group.place[chosen]
        order, first = _first(hashes, key_of, place)
        order = order[first]
        to = block_of(of[chosen[order]])
        by = np.argsort(to, kind="stable")
        order, to = order[by], to[by]
        rows = [
            (int(to[a]), key[0].as_py(), hashes[order[a:b]].tobytes(), key_of[order[a:b]].tobytes(),
             place[order[a:b]].astype(np.int32).tobytes())
            for a, b in _cuts(to)
        ]
        return pa.Table.from_pylist([dict(zip(("block", "g", "hashes", "ids", "places"), r)) for r in rows], window_schema)

    def earliest(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes = _joined(table, "hashes", np.uint64)
        ids, places = _joined(table, "ids", np.int64), _joined(table, "places", np.int32)
        owner = np.repeat(np.arange(len(table)), [len(x) // 8 for x in table["hashes"].to_pylist()])
        order, first = _first(hashes, ids, places)
        ref = np.empty(len(order), np.int64)
        ref[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        better = np.flatnonzero(ids[ref] < ids)
        g = table["g"].to_pylist()
        rows = []
        for a, b in _cuts(owner[better]):
            part = better[a:b]
            rows.append((g[owner[part[0]]], hashes[part].tobytes(), ids[ref[part]].tobytes(), places[ref[part]].tobytes()))
        return pa.Table.from_pylist([dict(zip(("g", "hashes", "ids", "places"), r)) for r in rows], answer_schema)

    def factor(key: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        group = Group(table, window)
        hashes = group.windows()
        order, first = _first(hashes, group.key, group.place)
        ref = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        ref_id, ref_place = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        ref_id[order], ref_place[order] = group.key[ref], group.place[ref]
        known = _joined(answers, "hashes", np.uint64)
        if len(known) and len(hashes):
            sort = np.argsort(known)
            found = np.minimum(np.searchsorted(known[sort], hashes), len(known) - 1)
            hit = known[sort[found]] == hashes
            ref_id[hit] = _joined(answers, "ids", np.int64)[sort[found[hit]]]
            ref_place[hit] = _joined(answers, "places", np.int32)[sort[found[hit]]]
        copied = ref_id < group.key
        runs_on = np.zeros(len(copied), bool)
        if len(copied):
            runs_on[1:] = (
                copied[1:] & copied[:-1] & (group.doc[1:] == group.doc[:-1])
                & (ref_id[1:] == ref_id[:-1]) & (ref_place[1:] == ref_place[:-1] + 1))
        opens = np.flatnonzero(copied & ~runs_on)
        closes = np.flatnonzero(copied & ~np.append(runs_on[1:], False))
        lengths = closes - opens + window
        cover = np.zeros(len(group.hashes) + 1, np.int64)
        np.add.at(cover, group.at[opens], 1)
        np.add.at(cover, group.at[opens] + lengths, -1)
        kept = np.cumsum(cover)[:-1] == 0
        texts, removed = [], []
        for i, text in enumerate(table["text"].to_pylist()):
            words = (text or "").encode().split()
            keep = kept[group.bounds[i] : group.bounds[i + 1]]
            removed.append(len(words) - int(keep.sum()))
            texts.append(b" ".join(compress(words, keep.tolist()) if removed[-1] else words).decode())
        factors = pa.StructArray.from_arrays(
            [pa.array(x.astype(np.int64)) for x in (group.place[opens], lengths, ref_id[opens], ref_place[opens])],
            fields=list(_FACTOR))
        per_doc = row_offsets(np.bincount(group.doc[opens], minlength=len(texts))).astype(np.int32)
        return pa.table([
            group.ids.cast(pa.int64()), pa.array(texts, pa.string()), pa.array(group.counts, pa.int64()),
            pa.array(removed, pa.int64()), pa.ListArray.from_arrays(pa.array(per_doc), factors)], names=out_names)

    def schema(**fields) -> StructType:
        return StructType([StructField(n, t) for n, t in fields.items()])

    arrow = {IntegerType(): pa.int32(), BinaryType(): pa.binary()}
    as_arrow = lambda s: pa.schema([(f.name, arrow[f.dataType]) for f in s])
    number, blob, long = IntegerType(), BinaryType(), LongType()
    send = schema(block=number, g=number, anchors=blob)
    answered = schema(g=number, block=number, mask=blob)
    sent = schema(block=number, g=number, hashes=blob, ids=blob, places=blob)
    placed = schema(g=number, hashes=blob, ids=blob, places=blob)
    send_schema, window_schema, answer_schema = as_arrow(send), as_arrow(sent), as_arrow(placed)
    part = StructType([StructField(f.name, long) for f in _FACTOR])
    out = StructType([
        StructField(id_col, long), StructField("text", StringType()), StructField("n_words", long),
        StructField("n_removed", long), StructField("factors", ArrayType(part))])
    out_names = out.names

    by_group = dealt.groupBy("g")
    masks = by_group.applyInArrow(send_anchors, send).groupBy("block").applyInArrow(shared_anchors, answered)
    windows = by_group.cogroup(masks.groupBy("g")).applyInArrow(send_windows, sent)
    places = windows.groupBy("block").applyInArrow(earliest, placed)
    return by_group.cogroup(places.groupBy("g")).applyInArrow(factor, out)
