"""Pack tokenised documents into training windows of several sizes.

Each task packs the documents of its own input split in bounded chunks, so packing needs no shuffle
and nothing grows with the table. Within a chunk a document first fills whole windows of the longest
tier; the rest of it is routed to the smallest tier that holds it. Tiers are packed from long to
short, gaps of longer windows are filled from shorter tiers, and what remains at the very end is cut
at powers of two, which need no padding. Sequences are then dealt to step groups of even cost.
"""

from __future__ import annotations

import heapq
import os
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ledgersieve.llm.words import ranges, row_offsets, slices, text_bytes

TIERS = (512, 1024, 2048, 4096)
CHUNK_TOKENS = 1 << 21
STEP_TOKENS = 1 << 16
# A worker lives on between tasks, beside the JVM: what it remembers and a slice's arrays stay within tens of MB.
KNOWN_WORDS = 1 << 18
KNOWN_IDS = 1 << 21
LINE_WORDS = 256
TEXT_SLICE = 1 << 21
MARKS = ",.!?#$%&*;:"

Piece = tuple[int, int, int]  # document, start, length


class WordTokenizer:
    """Ids of texts by the lower-casing word tokenizer, which never joins characters across white space.

    Texts are cut at white space and every distinct word is tokenised once; the ids are then put
    back in place. A-Z are lowered first, and a tail of marks after a letter is a word of its own:
    the tokenizer lowers letters one by one and starts a new match at such a mark, so both leave the
    ids as they are. A text that holds one of the tokenizer's special marks goes through it whole, as
    the tokenizer comes. Words are remembered without their tails, at most KNOWN_WORDS of them and
    KNOWN_IDS ids before a call, or else none.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._load = lambda: Tokenizer.from_file(path)
        self._whole = None
        self._tokenizer = self._load()
        self._marks = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._tokenizer.encode_special_tokens = True  # lowering must not make a mark
        vocabulary = self._tokenizer.get_vocab()
        self._last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a run of letters
        self._last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self._row: dict[str, int] = {}
        self._ids = array("I")
        self._ends = array("q", [0])

    def _rows(self, words: list[str]) -> np.ndarray:
        """The row of each word among the words known, which new ones join."""
        rows = np.fromiter(map(self._row.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(rows < 0).tolist()
        plain = [i for i in new if words[i].isalpha() and max(words[i]) <= "\xff"]  # each one run of letters
        odd = sorted(set(new).difference(plain))
        lines = [" ".join(words[i] for i in plain[at : at + LINE_WORDS]) for at in range(0, len(plain), LINE_WORDS)]
        for ids in self._coded(lines):
            self._keep(ids, np.flatnonzero(self._last[ids]) + 1)
        for ids in self._coded([words[i] for i in odd]):
            self._keep(ids, np.array([len(ids)]))
        rows[plain + odd] = np.arange(len(self._row), len(self._row) + len(new))
        self._row.update(zip((words[i] for i in plain + odd), range(len(self._row), len(self._row) + len(new))))
        return rows

    def _coded(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), LINE_WORDS):
            for coded in self._tokenizer.encode_batch_fast(texts[at : at + LINE_WORDS], add_special_tokens=False):
                yield np.array(coded.ids, np.uint32)

    def _keep(self, ids: np.ndarray, ends: np.ndarray) -> None:
        self._ends.frombytes((self._ends[-1] + ends).astype(np.int64).tobytes())
        self._ids.frombytes(ids.tobytes())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        marked = np.zeros(len(texts), bool)
        for mark in self._marks:
            marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._by_word(texts)
        rows = np.flatnonzero(marked)
        ids, counts = self._by_word(pc.if_else(pa.array(marked), "", texts))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        self._whole = self._whole or self._load()
        coded = self._whole.encode_batch_fast([texts[i].as_py() for i in rows.tolist()], add_special_tokens=False)
        for i, found in zip(rows.tolist(), coded):
            parts[i] = np.array(found.ids, np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self._row) > KNOWN_WORDS or len(self._ids) > KNOWN_IDS:
            self._forget()
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words = split.flatten().dictionary_encode()
        parts = _cores_and_tails(words.dictionary).dictionary_encode()
        rows = self._rows(parts.dictionary.to_numpy(zero_copy_only=False).tolist())[parts.indices.to_numpy()]
        known = np.asarray(self._ends)
        counts = known[rows + 1] - known[rows]
        ids = np.asarray(self._ids)[ranges(known[rows], counts)]
        ends = row_offsets(counts)[::2]  # of a word: its core and its tail
        rows = words.indices.to_numpy()
        counts = np.diff(ends)[rows]
        ids = ids[ranges(ends[rows], counts)]
        ends = row_offsets(counts)[row_offsets(pc.list_value_length(split).to_numpy())]
        return ids.astype(np.uint32, copy=False), np.diff(ends)


def _cores_and_tails(words: pa.Array) -> pa.Array:
    """Two strings a word, one after the other: up to the marks that follow its last letter, and these."""
    data, offsets = text_bytes(words)
    sizes = np.diff(offsets)
    cores = pc.binary_length(pc.ascii_rtrim(words, MARKS)).to_numpy()
    last = offsets[:-1] + cores - 1
    cut = np.flatnonzero((cores > 0) & (cores < sizes))
    last = last[cut]
    byte, before = data[last], data[last - 1]  # a byte C3 begins a letter from \xc0 on, but for two signs
    letter = (byte >= ord("a")) & (byte <= ord("z")) | (before == 0xC3) & (byte >= 0x80) & (byte != 0x97) & (byte != 0xB7)
    ends = np.empty(2 * len(words) + 1, np.int64)
    ends[::2] = offsets
    ends[1::2] = offsets[1:]
    ends[1 + 2 * cut[letter]] = last[letter] + 1
    return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(ends), pa.py_buffer(data))


_coders: dict[str, WordTokenizer] = {}


def _coder(path: str) -> WordTokenizer:
    """One tokenizer for the life of a Python worker, with the words it knows by then."""
    if path not in _coders:
        _coders[path] = WordTokenizer(path)
    return _coders[path]


def pack_chunk(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Sequences that hold each token of each document once. Only a power of two or the longest tier fills one."""
    longest = tiers[-1]
    done: list[list[Piece]] = []
    rest: list[tuple[int, int, int]] = []  # length, document, start
    for doc, length in enumerate(lengths):
        whole = length - length % longest
        done += [[(doc, start, longest)] for start in range(0, whole, longest)]
        if length > whole:
            rest.append((length - whole, doc, whole))
    rest.sort()
    while rest:
        size, doc, start = rest.pop()
        window = [(doc, start, size)]
        gap = next(t for t in tiers if t >= size) - size
        while gap and rest:
            fits = bisect_right(rest, (gap, len(lengths), 0))
            if fits:
                size, doc, start = rest.pop(fits - 1)
            else:  # every shorter piece is longer than the gap: cut the shortest
                length, doc, start = rest.pop(0)
                size = gap
                insort(rest, (length - size, doc, start + size))
            window.append((doc, start, size))
            gap -= size
        done += [window] if not gap else _powers_of_two(window)
    return done


def _powers_of_two(window: list[Piece]) -> list[list[Piece]]:
    """Cut the last, unfilled window at the powers of two that add up to its length."""
    total, out = sum(p[2] for p in window), []
    pieces = list(reversed(window))
    for bit in reversed(range(total.bit_length())):
        left, part = total & 1 << bit, []
        while left:
            doc, start, size = pieces.pop()
            take = min(size, left)
            part.append((doc, start, take))
            if take < size:
                pieces.append((doc, start + take, size - take))
            left -= take
        if part:
            out.append(part)
    return out


def balance(sequences: list[list[Piece]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each sequence, so that the groups have about the same attention cost."""
    total = sum(p[2] for s in sequences for p in s)
    steps = [(0, k) for k in range(max(1, -(-total // step_tokens)))]
    cost = [sum(p[2] ** 2 for p in s) for s in sequences]
    group = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: -cost[i]):
        load, k = heapq.heappop(steps)
        group[i] = k
        heapq.heappush(steps, (load + cost[i], k))
    return group


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, tiers: tuple[int, ...] = TIERS,
    chunk_tokens: int = CHUNK_TOKENS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, input_ids (little-endian 32-bit), doc_tokens, sequence_id,
    offset, sequence_tokens, step_id.

    A NULL or empty text is the end token alone. Rows that share an id are packed separately. A NULL
    id stays NULL. Columns other than id and text are not read. An empty table gives no pieces.
    Sequence ids are unique and follow the input split, so a task that runs again repeats them.
    """
    id_type = docs.schema[id_col].dataType

    def pack_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        first = TaskContext.get().partitionId() << 36
        steps = first
        pending: list[tuple] = []
        tokens = 0

        def flush():
            nonlocal first, steps, tokens
            keys = [k for k, _ in pending]
            ids = [x for _, x in pending]
            sequences = pack_chunk([len(x) for x in ids], tiers)
            group = balance(sequences)
            rows = []
            for number, k in sorted(enumerate(group), key=lambda x: (x[1], x[0])):
                offset, total = 0, sum(p[2] for p in sequences[number])
                for doc, start, size in sequences[number]:
                    rows.append((keys[doc], start, size, ids[doc][start : start + size].tobytes(), len(ids[doc]),
                                 first, offset, total, steps + k))
                    offset += size
                first += 1
            steps += max(group, default=-1) + 1
            pending.clear()
            tokens = 0
            for at in range(0, len(rows), 4096):
                columns = list(zip(*rows[at : at + 4096]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            types = [batch["id"].type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 5]
            for a, b in slices(batch, "text", TEXT_SLICE):
                part = batch.slice(a, b - a)
                ids, counts = coder.encode(part["text"])
                ends = row_offsets(counts)
                for i, key in enumerate(part["id"].to_pylist()):
                    pending.append((key, np.append(ids[ends[i] : ends[i + 1]], np.uint32(end_id)).astype("<u4")))
                    tokens += len(pending[-1][1])
                    if tokens >= chunk_tokens:
                        yield from flush()
            pa.default_memory_pool().release_unused()
        if pending:
            yield from flush()

    long = LongType()
    schema = StructType([
        StructField(id_col, id_type), StructField("start", long), StructField("length", long),
        StructField("input_ids", BinaryType()), StructField("doc_tokens", long), StructField("sequence_id", long),
        StructField("offset", long), StructField("sequence_tokens", long), StructField("step_id", long)])
    names = [f.name for f in schema]
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(pack_split, schema)
