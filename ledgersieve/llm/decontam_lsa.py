"""Find benchmark items in documents, copied or paraphrased, by latent semantic retrieval.

Documents are cut into passages. TF-IDF vectors of all passages over the items' terms are reduced by
a randomised SVD whose products are summed over tasks. Overlapping passages are compared with all
items in that latent space, in blocks. An item near a passage is a paraphrase there if the longest common
subsequence of the words around that passage with the item, and that with its answer, reach lower shares
and those words hold two fifths of its weight, in which rare words count most;
copies are found at the higher share whatever their cosine. Before a subsequence is sought, the words
that a document holds in any order, which no window of it can exceed, rule most pairs out without loss.

Texts are read once: what is kept of a document is the places of the items' terms in it, which is all
that the vectors and the subsequences need. Items are taken in blocks of bounded size, so the term
table and the basis that tasks receive are bounded too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.words import ranges, row_offsets, slices, split_words, text_bytes
from ledgersieve.sources.cut import cut

# Words of items that one block holds; it bounds the term table, and RANK times it the basis.
BLOCK_WORDS = 1 << 15
PASSAGE, STRIDE = 64, 32
RANK, OVERSAMPLE, SEED = 64, 8, 11
# Terms in a larger share of the passages say nothing about an item.
MAX_SHARE = 0.05
# Least shares of item and answer words in common order, for a copy.
ITEM_SHARE, ANSWER_SHARE = 0.7, 0.5
# Least share of item words in common order, and of their weight in any order, where a passage is near the
# item, and the least cosine that is near.
PARAPHRASE_SHARE, RARE_SHARE, COSINE = 0.6, 0.4, 0.35
_PARTS = 16
# Passages times items that are compared in one step, and rows or terms whose products are summed in
# one: few enough that the products stay in a core's cache.
_PAIRS = 1 << 18
_STEP = 64

_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (letters and digits, A-Z lowered), and the bounds of the texts."""
    data, offsets = text_bytes(texts)
    found = split_words(_LOWER[data], offsets, _GAP)
    return found.hashes() if len(found.starts) else np.zeros(0, np.uint64), found.bounds


@dataclass
class Items:
    """A block of items: term ids of each, in order, and where its answer starts."""

    ids: list
    sequences: list[np.ndarray]
    answers: list[np.ndarray]
    terms: np.ndarray  # sorted hashes; a term id is its place here


def item_block(rows: list) -> Items:
    """Items from (id, text, answer or None). Without an answer, the last sentence or quarter stands for it."""
    texts = pa.array([r[1] or "" for r in rows], pa.string())
    hashes, bounds = _words(texts)
    terms, coded = np.unique(hashes, return_inverse=True)
    sequences = [coded[a:b] for a, b in zip(bounds, bounds[1:])]
    tails = []
    for (_, text, answer), sequence in zip(rows, sequences):
        tail = answer if answer is not None else (text or "").rstrip(" .!?\n").replace("!", ".").replace("?", ".").rpartition(".")[2]
        n = len(_words(pa.array([tail], pa.string()))[0])
        if answer is None and not 0 < n < len(sequence):
            n = -(-len(sequence) // 4)
        tails.append(n)
    answers = []
    for (_, _, answer), sequence, n in zip(rows, sequences, tails):
        if answer is None:
            answers.append(sequence[len(sequence) - n :])
        else:
            own = _words(pa.array([answer], pa.string()))[0]
            at = np.minimum(np.searchsorted(terms, own), max(0, len(terms) - 1))
            answers.append(np.where(terms[at] == own, at, -1) if len(terms) else np.zeros(0, np.int64))
    return Items([r[0] for r in rows], sequences, answers, terms)


def term_places(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, gaps, terms): places and ids of the items' terms in each document that has some."""
    known = items.terms

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text"):
                hashes, bounds = _words(batch["text"].slice(a, b - a))
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = np.flatnonzero(known[at] == hashes)
                ends = np.searchsorted(hit, bounds)
                full = np.flatnonzero(np.diff(ends))
                gaps = np.diff(hit, prepend=0).astype(np.uint32)
                gaps[ends[full]] = hit[ends[full]] - bounds[full]
                term = at[hit].astype(np.uint32)
                rows = pa.array(full + a)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(rows), batch["text_hash"].take(rows),
                     pa.array([gaps[ends[i] : ends[i + 1]].tobytes() for i in full], pa.binary()),
                     pa.array([term[ends[i] : ends[i + 1]].tobytes() for i in full], pa.binary())],
                    names=["id", "text_hash", "gaps", "terms"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    return own.mapInArrow(find, f"id {kind}, text_hash bigint, gaps binary, terms binary")


@dataclass
class Places:
    """Term places of a batch of documents, one after the other."""

    bounds: np.ndarray
    place: np.ndarray
    term: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Places:
        terms = [np.frombuffer(x, np.uint32) for x in batch["terms"].to_pylist()]
        gaps = [np.frombuffer(x, np.uint32) for x in batch["gaps"].to_pylist()]
        none = [np.zeros(0, np.int64)]
        return cls(row_offsets(np.array([len(x) for x in terms], np.int64)),
                   np.concatenate(none + [np.cumsum(x, dtype=np.int64) for x in gaps]),
                   np.concatenate(none + [x.astype(np.int64) for x in terms]))

    def take(self, docs: np.ndarray) -> Places:
        counts = np.diff(self.bounds)[docs]
        at = ranges(self.bounds[docs], counts)
        return Places(row_offsets(counts), self.place[at], self.term[at])

    def passages(self, stride: int, weights: np.ndarray | None):
        """Sparse rows: document and first word of each passage, row bounds, terms, values.

        With `weights` (one per term, 0 for terms left out) rows are TF-IDF of length one; without, they are counts of one.
        """
        doc = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        place, term = self.place, self.term
        if weights is not None:
            use = weights[term] > 0
            doc, place, term = doc[use], place[use], term[use]
        step = place // stride
        parts = [(doc, step, term)]
        for back in range(1, PASSAGE // stride):
            early = step >= back
            parts.append((doc[early], step[early] - back, term[early]))
        doc, step, term = (np.concatenate(x) for x in zip(*parts))
        width = int(step.max(initial=0)) + 1
        size = int(term.max(initial=0)) + 1
        cells, counts = np.unique((doc * width + step) * size + term, return_counts=True)
        row, term = cells // size, cells % size
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        names, bounds = row[starts], np.append(starts, len(row))
        row = np.repeat(np.arange(len(names)), np.diff(bounds))
        values = np.ones(len(cells), np.float32)
        if weights is not None:
            values = ((1 + np.log(counts)) * weights[term]).astype(np.float32)
            norm = np.sqrt(np.add.reduceat(values**2, bounds[:-1])) if len(names) else np.zeros(0, np.float32)
            values /= norm[row]
        return names // width, names % width * stride, bounds, term, values


def _project(bounds: np.ndarray, term: np.ndarray, values: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Sparse rows times a dense basis, in steps of bounded size."""
    out = np.zeros((len(bounds) - 1, basis.shape[1]), np.float32)
    for a in range(0, len(out), _STEP):
        b = min(len(out), a + _STEP)
        cells = slice(bounds[a], bounds[b])
        out[a:b] = np.add.reduceat(values[cells, None] * basis[term[cells]], bounds[a:b] - bounds[a], axis=0)
    return out


def _summed(parts: DataFrame, kind) -> np.ndarray:
    """Sum of vectors sent as (part, lane, data) rows: first per part and lane, then per part. The result is bounded."""
    schema = "part int, lane int, data binary"

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = reduce(np.add, (np.frombuffer(x, kind) for x in table["data"].to_pylist()))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "lane": pa.array([0], pa.int32()),
                         "data": pa.array([total.tobytes()], pa.binary())})

    rows = parts.groupBy("part", "lane").applyInArrow(add, schema).groupBy("part").applyInArrow(add, schema).collect()
    return np.concatenate([np.frombuffer(r["data"], kind) for r in sorted(rows, key=lambda r: r["part"])] or [np.zeros(0, kind)])


def _send(total: np.ndarray) -> pa.RecordBatch:
    lane = TaskContext.get().partitionId() % 64
    pieces = np.array_split(total, _PARTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(_PARTS), pa.int32()), pa.array([lane] * _PARTS, pa.int32()),
         pa.array([x.tobytes() for x in pieces], pa.binary())], names=["part", "lane", "data"])


_SENT = "part int, lane int, data binary"


def term_weights(places: DataFrame, n_terms: int) -> np.ndarray:
    """Inverse passage frequency of every term over all passages; 0 for terms in more than MAX_SHARE of them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            _, _, bounds, term, _ = Places.of(batch).passages(PASSAGE, None)
            total[:-1] += np.bincount(term, minlength=n_terms)
            total[-1] += len(bounds) - 1
        yield _send(total)

    total = _summed(places.select("gaps", "terms").mapInArrow(count, _SENT), np.int64)
    if not len(total) or not total[-1]:
        return np.ones(n_terms, np.float32)
    seen = total[:-1]
    weights = np.log((1 + total[-1]) / (1 + seen)).astype(np.float32)
    weights[seen > max(MAX_SHARE * total[-1], 1)] = 0
    return weights


def latent_basis(places: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Right singular vectors (terms by rank) of the matrix of all passages, by randomised subspace iteration.

    Each of the two passes sums A'(A Q) over the tasks; only that product, terms by rank, meets in one place.
    """
    n = len(weights)
    rank = min(n, RANK + OVERSAMPLE)
    basis = np.random.default_rng(SEED).standard_normal((n, rank)).astype(np.float32)
    if rank == n:
        return np.eye(n, dtype=np.float32)

    def times(batches: Iterator[pa.RecordBatch], q: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, rank), np.float64)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                _, _, bounds, term, values = Places.of(batch.slice(a, 1000)).passages(PASSAGE, weights)
                if len(term):
                    rows = _project(bounds, term, values, q)
                    order = np.argsort(term, kind="stable")
                    start = np.flatnonzero(np.diff(term[order], prepend=-1))
                    row = np.repeat(np.arange(len(rows)), np.diff(bounds))
                    for i in range(0, len(start), _STEP):
                        chunk = start[i : i + _STEP]
                        cells = order[chunk[0] : start[i + _STEP] if i + _STEP < len(start) else None]
                        total[term[order[chunk]]] += np.add.reduceat(
                            values[cells, None] * rows[row[cells]], chunk - chunk[0], axis=0)
        yield _send(total.astype(np.float32).ravel())

    spark = places.sparkSession
    stored = places.select("gaps", "terms")
    for last in (False, True):
        q = np.linalg.qr(basis)[0].astype(np.float32)
        shared = spark.sparkContext.broadcast(q)  # BLOCK_WORDS by rank numbers at most
        product = _summed(stored.mapInArrow(lambda b, q=shared: times(b, q.value), _SENT), np.float32)
        if not len(product) or not product.any():
            return q[:, : min(RANK, rank)]
        basis = product.reshape(n, rank)
        if last:
            value, vector = np.linalg.eigh((q.T @ basis).astype(np.float64))
            return (q @ vector[:, np.argsort(-value)[:RANK]]).astype(np.float32)


def common_words(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, one big-integer step per word of the text."""
    masks: dict[int, int] = {}
    for i, t in enumerate(item.tolist()):
        masks[t] = masks.get(t, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for t in text.tolist():
        met = row & masks.get(t, 0)
        if met:
            row = (row + met | row - met) & full
    return len(item) - row.bit_count()


@dataclass
class Postings:
    """The items that hold each term once, twice, …: a level for every term and number of times.

    Levels that many items share are rows of a table; those of the others list their items.
    """

    base: np.ndarray  # first level of each term, and the end of the last
    table: np.ndarray
    row: np.ndarray  # row of a level in the table, or -1
    starts: np.ndarray
    counts: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, items: Items) -> Postings:
        n = len(items.sequences)
        none = [np.zeros(0, np.int64)]
        found = [np.unique(s, return_counts=True) for s in items.sequences]
        term = np.concatenate(none + [t for t, _ in found])
        times = np.concatenate(none + [c for _, c in found])
        most = np.zeros(len(items.terms), np.int64)
        np.maximum.at(most, term, times)
        base = row_offsets(most)
        level = ranges(base[term], times)
        item = np.repeat(np.repeat(np.arange(n), [len(t) for t, _ in found]), times)
        order = np.argsort(level, kind="stable")
        level, item = level[order], item[order]
        counts = np.bincount(level, minlength=base[-1])
        starts = row_offsets(counts)[:-1]
        many = 16 * counts >= n
        row = np.where(many, np.cumsum(many) - 1, -1)
        table = np.zeros((int(many.sum()), n), np.float32)
        table[row[level[many[level]]], item[many[level]]] = 1
        return cls(base, table, row, starts, np.where(many, 0, counts), item)

    def held(self, found: Places, a: int, b: int) -> np.ndarray:
        """For documents a to b and each item, how many of the item's words the document holds, in any order."""
        n, size = self.table.shape[1], len(self.base)
        cells = slice(found.bounds[a], found.bounds[b])
        doc = np.repeat(np.arange(b - a), np.diff(found.bounds[a : b + 1]))
        key, times = np.unique(doc * size + found.term[cells], return_counts=True)
        doc, term = key // size, key % size
        times = np.minimum(times, self.base[term + 1] - self.base[term])
        level, doc = ranges(self.base[term], times), np.repeat(doc, times)
        common = self.row[level] >= 0
        dense = np.zeros((b - a, len(self.table)), np.float32)
        dense[doc[common], self.row[level[common]]] = 1
        counts = self.counts[level]
        at = ranges(self.starts[level], counts)
        rare = np.bincount(np.repeat(doc * n, counts) + self.item[at], minlength=(b - a) * n)
        return dense @ self.table + rare.reshape(b - a, n)


def _confirmed(found: Places, d: int, item: np.ndarray, answer: np.ndarray, rare: np.ndarray | None = None) -> tuple[float, list[tuple[int, float]]] | None:
    """The largest share of the item in order around a passage of document d, and (start, answer share) of the passages that have it.

    With `rare`, the weights of all terms, the lower share is enough where the weights reach it too.
    """
    least = ITEM_SHARE if rare is None else PARAPHRASE_SHARE
    cells = slice(found.bounds[d], found.bounds[d + 1])
    place, term = found.place[cells], found.term[cells]
    kinds, times = np.unique(item, return_counts=True)
    code = np.minimum(np.searchsorted(kinds, term), len(kinds) - 1)
    mine = kinds[code] == term
    own_place, own_term, code = place[mine], term[mine], code[mine]
    starts = np.arange(0, int(place[-1]) + 1, STRIDE)
    reach = max(STRIDE, len(item))
    edges = np.searchsorted(own_place, [starts - reach, starts + PASSAGE + reach])
    most, at, last, share = 0.0, [], None, 0.0
    many = (edges[1] - edges[0]) / len(item)
    use = many >= ITEM_SHARE
    if rare is not None:
        total, so_far = times @ rare[kinds], np.concatenate([[0.0], np.cumsum(rare[own_term], dtype=np.float64)])
        use |= (many >= least) & (so_far[edges[1]] - so_far[edges[0]] >= RARE_SHARE * total - 1e-6)
    for i in np.flatnonzero(use).tolist():
        a, b = window = edges[0, i], edges[1, i]
        if window != last:
            last = window
            held = np.minimum(np.bincount(code[a:b], minlength=len(kinds)), times)
            share = held.sum() / len(item)
            if share >= least:
                share = common_words(item, own_term[a:b]) / len(item)
                if rare is not None and share < ITEM_SHARE and held @ rare[kinds] < max(RARE_SHARE * total, 1e-9):
                    share = 0.0
        if share >= least and share >= most:
            a, b = np.searchsorted(place, [starts[i] - reach, starts[i] + PASSAGE + reach])
            tail = common_words(answer, term[a:b]) / len(answer) if len(answer) else 1.0
            if tail >= ANSWER_SHARE:
                at = at if share == most else []
                most = share
                at.append((int(starts[i]), tail))
    return (most, at) if at else None


def _weight_held(found: Places, pairs: np.ndarray, items: Items, weights: np.ndarray) -> np.ndarray:
    """For each (document, item) the share of the item's weight whose words the document holds, in any order."""
    size = len(weights)
    doc = np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.bounds))
    keys, held = np.unique(doc * size + found.term, return_counts=True)
    chosen, item = np.unique(pairs[:, 1], return_inverse=True)
    kinds = [np.unique(items.sequences[k], return_counts=True) for k in chosen.tolist()]
    bounds = row_offsets(np.array([len(t) for t, _ in kinds], np.int64))
    counts = np.diff(bounds)[item]
    at = ranges(bounds[item], counts)
    term, times = (np.concatenate(x)[at] for x in zip(*kinds))
    row = np.repeat(np.arange(len(pairs)), counts)
    key = pairs[row, 0] * size + term
    place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    mine = np.where(keys[place] == key, np.minimum(held[place], times), 0)
    total = np.bincount(row, times * weights[term], len(pairs))
    return np.bincount(row, mine * weights[term], len(pairs)) / np.maximum(total, 1e-9)


def _nearest(found: Places, weights: np.ndarray, basis: np.ndarray, queries: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every document and item the largest cosine of a passage with a part of the item; 0 without a direction."""
    n = len(found.bounds) - 1
    near = np.zeros((n, len(first) - 1), np.float32)
    able = np.flatnonzero(np.diff(first))
    doc, _, bounds, term, values = found.passages(STRIDE, weights)
    step = max(1, _PAIRS // max(1, len(queries)))
    for a in range(0, len(doc), step):
        b = min(len(doc), a + step)
        cells = slice(bounds[a], bounds[b])
        rows = _unit(_project(bounds[a : b + 1] - bounds[a], term[cells], values[cells], basis))
        best = np.maximum.reduceat(rows @ queries.T, first[able], axis=1)
        opens = np.flatnonzero(np.diff(doc[a:b], prepend=-1))
        at = np.ix_(doc[a:b][opens], able)
        near[at] = np.maximum(near[at], np.maximum.reduceat(best, opens, axis=0))
    return near


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1), 1e-9)[:, None]


def _search(places: DataFrame, items: Items, weights: np.ndarray, basis: np.ndarray, id_type: str, item_type: str) -> DataFrame:
    # A passage cannot hold an item longer than itself, so each part of such an item has a direction of its own.
    parts = [(k, x) for k, s in enumerate(items.sequences) if len(s) for x in np.array_split(s, -(-len(s) // PASSAGE))]
    latent = np.zeros((len(parts), basis.shape[1]), np.float32)
    for k, (_, sequence) in enumerate(parts):
        term, count = np.unique(sequence, return_counts=True)
        latent[k] = ((1 + np.log(count)) * weights[term]) @ basis[term]
    queries = _unit(latent)
    words = np.array([len(s) for s in items.sequences])
    first = row_offsets(-(-words // PASSAGE))
    shared = places.sparkSession.sparkContext.broadcast((items, weights, basis, queries, first, words, Postings.of(items)))
    step = max(1, _PAIRS // max(1, len(items.ids)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w, b, q, parts_of, n_words, postings = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                found = Places.of(part)
                pairs: dict[tuple[int, int], tuple] = {}
                for i in range(0, part.num_rows, step):
                    some = np.arange(i, min(i + step, part.num_rows))
                    held = postings.held(found, i, i + len(some)) / np.maximum(n_words, 1)
                    near = (held >= PARAPHRASE_SHARE) & (n_words > 0)
                    near &= _nearest(found.take(some), w, b, q, parts_of) >= COSINE
                    pairs_near = np.argwhere(near)
                    if len(pairs_near):
                        near[near] = _weight_held(found.take(some), pairs_near, own, w) >= RARE_SHARE - 1e-6
                    able = ((held >= ITEM_SHARE) | near) & (n_words > 0)
                    for d, k in np.argwhere(able).tolist():
                        best = _confirmed(found, i + d, own.sequences[k], own.answers[k], w if near[d, k] else None)
                        if best:
                            pairs[i + d, k] = best
                docs = np.unique(np.array([d for d, _ in pairs], np.int64))
                doc, start, bounds, term, values = found.take(docs).passages(STRIDE, w)
                rows = _unit(_project(bounds, term, values, b) if len(doc) else np.zeros((0, b.shape[1]), np.float32))
                at = {x: r for r, x in enumerate(zip(docs[doc].tolist(), start.tolist()))}
                ids, hashes = part["id"].to_pylist(), part["text_hash"].to_pylist()
                out = []
                for (d, k), (share, places_) in sorted(pairs.items()):
                    near = q[parts_of[k] : parts_of[k + 1]]
                    # The first of those nearest; a passage without rare terms has no direction.
                    cosine, back, tail = max(
                        (float((near @ rows[at[d, s]]).max()) if (d, s) in at else 0.0, -s, tail) for s, tail in places_)
                    if share >= ITEM_SHARE or cosine >= COSINE:
                        out.append((ids[d], hashes[d], own.ids[k], cosine, share, tail, -back))
                columns = list(zip(*out)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_HIT_NAMES)

    kinds = [pa.int64() if t == "bigint" else pa.int32() if t == "int" else pa.string() for t in (id_type, item_type)]
    types = [kinds[0], pa.int64(), kinds[1], pa.float64(), pa.float64(), pa.float64(), pa.int64()]

    return places.mapInArrow(
        look, f"id {id_type}, text_hash bigint, item_id {item_type}, cosine double, item_share double, "
              "answer_share double, near_word bigint")


_HIT_NAMES = ["id", "text_hash", "item_id", "cosine", "item_share", "answer_share", "near_word"]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None) -> Iterator[list]:
    """Items in blocks of at most BLOCK_WORDS words (or one longer item), read partition by partition."""
    columns = [F.col(item_col), F.col(text_col), F.col(answer_col) if answer_col else F.lit(None).cast("string")]
    block, size = [], 0
    for row in benchmark.select(*columns).where(F.length(text_col) > 0).toLocalIterator():
        n = len(row[1].split())
        if block and size + n > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append(tuple(row))
        size += n
    if block:
        yield block


def find_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """One row per document row and item found in it: id, text_hash, item_id, cosine, item_share, answer_share, near_word.

    NULL, empty and blank texts hold no item; an item without words is never found. Every document and
    item that the shares of a copy accept is found, whatever their cosine; a paraphrase needs it, and an item all of
    whose words stand in over MAX_SHARE of the passages has none. Rows that repeat are reported each. A NULL id or item
    id stays. Other columns are not read. An empty table on either side gives no rows.
    """
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    hits = docs.sparkSession.createDataFrame(
        [], f"id {id_type}, text_hash bigint, item_id {item_type}, cosine double, item_share double, answer_share double, near_word bigint")
    for rows in _blocks(benchmark, item_col, item_text_col, answer_col):
        items = item_block(rows)
        if not len(items.terms):
            continue
        places = cut(term_places(docs, items, id_col, text_col), "places")
        weights = term_weights(places, len(items.terms))
        hits = hits.union(_search(places, items, weights, latent_basis(places, weights), id_type, item_type))
    return hits


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` in which no item was found, with all their columns."""
    hits = find_items(docs, benchmark, id_col, text_col).select(
        F.col("id").alias("_hit_id"), F.col("text_hash").alias("_hit_hash")).distinct()
    same = docs[id_col].eqNullSafe(hits["_hit_id"]) & (F.xxhash64(docs[text_col]) == hits["_hit_hash"])
    return docs.join(hits, same, "left_anti")
