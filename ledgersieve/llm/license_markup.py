"""Find license texts with templates that are compiled to token automata.

A template is license wording with two kinds of markup: `[[ … ]]` may be left out, and `{{ … }}` may
be replaced, by any run of words of a given length (`{{0-30}}`) or by one of several wordings
(`{{holder|holders}}`). It is compiled to an automaton over words, whose states are the bits of one
number. A text is accepted from some word on when all words outside the markup stand there in order
with nothing else between them. Only words that can begin a template start an automaton.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from ledgersieve.llm.alnum import alnum_words, plain_words
from ledgersieve.llm.license_templates import PHRASES, TEMPLATES
from ledgersieve.llm.words import Words, slices

_TOKEN = re.compile(r"(\[\[|\]\]|\{\{.*?\}\})", re.S)
_SPAN = re.compile(r"(\d+)-(\d+)")
_ANY = "\x00any"
_END = "\x00end"


@dataclass
class Automaton:
    """`labels[i]` is what state i reads; state len(labels) accepts. `skips` are steps that read nothing, always forward."""

    label: str
    name: str
    labels: list[str] = field(default_factory=list)
    skips: list[tuple[int, int]] = field(default_factory=list)

    def bind(self, number: dict[str, int]) -> BoundAutomaton:
        """The automaton over word numbers; number 0 is any word that no template holds."""
        reads: dict[int, int] = {}
        any_word = 0
        for i, word in enumerate(self.labels):
            if word == _ANY:
                any_word |= 1 << i
            elif word != _END:
                reads[number[word]] = reads.get(number[word], 0) | 1 << i
        skips = sorted(self.skips)
        bound = BoundAutomaton(self.label, self.name, reads, any_word, [(1 << a, 1 << b) for a, b in skips], 1 << len(self.labels))
        bound.begin = bound.rest(1)
        return bound


@dataclass
class BoundAutomaton:
    label: str
    name: str
    reads: dict[int, int]
    any_word: int
    skips: list[tuple[int, int]]
    accept: int
    begin: int = 0

    def rest(self, states: int) -> int:
        for source, target in self.skips:  # by source, so that one round is enough
            if states & source:
                states |= target
        return states

    def step(self, states: int, word: int) -> int:
        states &= self.reads.get(word, 0) | self.any_word
        return self.rest(states << 1) if states else 0

    def first_words(self) -> list[int]:
        return [w for w, states in self.reads.items() if states & self.begin]

    def second_words(self) -> list[int] | None:
        """Words that can follow a first word; None where any can."""
        after = 0
        for word in self.first_words():
            after |= self.step(self.begin, word)
        if after & (self.accept | self.any_word):
            return None
        return [w for w, states in self.reads.items() if states & after]

    def end(self, words: Sequence[int]) -> int | None:
        """How many words are read until the automaton first accepts; None when it does not."""
        states = self.begin
        for i, word in enumerate(words):
            states = self.step(states, word)
            if not states:
                return None
            if states & self.accept:
                return i + 1
        return None


Node = tuple  # ("word", w), ("free", least, most), ("choice", [words, …]) or ("optional", [nodes])


def parse(markup: str) -> list[Node]:
    """The words and regions of a template."""
    levels: list[list[Node]] = [[]]
    for part in _TOKEN.split(markup):
        if part == "[[":
            levels.append([])
        elif part == "]]":
            if len(levels) == 1:
                raise ValueError("a region is closed that was not opened")
            inside = levels.pop()
            levels[-1].append(("optional", inside))
        elif part.startswith("{{"):
            inside = part[2:-2].strip()
            if span := _SPAN.fullmatch(inside):
                levels[-1].append(("free", int(span[1]), int(span[2])))
            else:
                levels[-1].append(("choice", [plain_words(choice) for choice in inside.split("|")]))
        else:
            levels[-1] += [("word", w) for w in plain_words(part)]
    if len(levels) > 1:
        raise ValueError("a region is not closed")
    return levels[0]


def _decides_nothing(node: Node) -> bool:
    return node[0] == "optional" or (node[0] == "free" and node[1] == 0)


def compile_template(label: str, name: str, markup: str) -> Automaton:
    """Regions at the very beginning or end that may be empty decide nothing and are left out."""
    nodes = parse(markup)
    while nodes and _decides_nothing(nodes[0]):
        nodes = nodes[1:]
    while nodes and _decides_nothing(nodes[-1]):
        nodes = nodes[:-1]
    if not nodes or nodes[0][0] == "free":
        raise ValueError(f"{name}: a template has to begin with wording")
    made = Automaton(label, name)
    _emit(made, nodes)
    return made


def _emit(made: Automaton, nodes: list[Node]) -> None:
    for kind, *inside in nodes:
        start = len(made.labels)
        if kind == "word":
            made.labels.append(inside[0])
        elif kind == "free":
            least, most = inside
            made.labels += [_ANY] * most
            made.skips += [(start + i, start + most) for i in range(least, most)]
        elif kind == "optional":
            _emit(made, inside[0])
            made.skips.append((start, len(made.labels)))
        else:
            ends = []
            for choice in inside[0]:
                if len(made.labels) > start:
                    made.skips.append((start, len(made.labels)))
                made.labels += choice
                ends.append(len(made.labels))
                made.labels.append(_END)  # keeps one choice from running into the next
            made.skips += [(end, len(made.labels)) for end in ends]


class Scanner:
    """All phrases and automata over one numbering of words."""

    def __init__(self, templates: Sequence[tuple[str, str, str]], phrases: Sequence[tuple[str, str]]):
        compiled = [compile_template(*t) for t in templates]
        words = {w for a in compiled for w in a.labels} - {_ANY, _END} | {w for p, _ in phrases for w in p.split(" ")}
        ordered = sorted(words)
        table = alnum_words(pa.array([" ".join(ordered)]))
        hashes = table.hashes()
        order = np.argsort(hashes)
        self._hashes, self._number = hashes[order], np.arange(1, len(ordered) + 1)[order]
        self._length = np.array([0, *[len(w.encode()) for w in ordered]])
        number = {w: i for i, w in enumerate(ordered, 1)}
        self._phrases = [([number[w] for w in p.split(" ")], label) for p, label in phrases]
        self._automata = [a.bind(number) for a in compiled]
        size = len(ordered) + 1
        self._begins = []
        for a in self._automata:
            first, second = np.zeros(size, bool), np.zeros(size, bool)
            first[a.first_words()] = True
            follow = a.second_words()
            second[slice(None) if follow is None else follow] = True
            self._begins.append((first, second))

    def numbers(self, words: Words) -> np.ndarray:
        """The number of every word, 0 for words that stand in no template."""
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self._hashes, hashes), len(self._hashes) - 1)
        found = np.where(self._hashes[at] == hashes, self._number[at], 0)
        return np.where(self._length[found] == words.ends - words.starts, found, 0)

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, dict[int, list[dict]], dict[int, list[dict]]]:
        """Words of each text, and by row the places of phrases and of accepted templates."""
        words = alnum_words(texts)
        numbers, bounds = self.numbers(words), words.bounds
        phrases: dict[int, list[dict]] = {}
        accepted: dict[int, list[dict]] = {}
        known = np.flatnonzero(numbers)
        for sequence, label in self._phrases:
            places = known[numbers[known] == sequence[0]]
            for step, number in enumerate(sequence[1:], 1):
                places = places[places + step < len(numbers)]
                places = places[numbers[places + step] == number]
            rows = np.searchsorted(bounds, places, "right") - 1
            inside = places + len(sequence) <= bounds[rows + 1]
            for place, row in zip(places[inside].tolist(), rows[inside].tolist()):
                start = place - int(bounds[row])
                phrases.setdefault(row, []).append({"label": label, "start": start, "end": start + len(sequence)})
        following = np.append(numbers[1:], 0)
        for automaton, (first, second) in zip(self._automata, self._begins):
            places = known[first[numbers[known]]]
            places = places[second[following[places]]]
            rows = np.searchsorted(bounds, places, "right") - 1
            longest = len(automaton.skips) + automaton.accept.bit_length()
            for place, row in zip(places.tolist(), rows.tolist()):
                length = automaton.end(numbers[place : min(place + longest, int(bounds[row + 1]))].tolist())
                if length:
                    start = place - int(bounds[row])
                    accepted.setdefault(row, []).append(
                        {"label": automaton.label, "template": automaton.name, "start": start, "end": start + length})
        return np.diff(bounds), phrases, accepted


_PLACE = [("start", pa.int64()), ("end", pa.int64())]
_PHRASE = pa.list_(pa.struct([("label", pa.string()), *_PLACE]))
_ACCEPTED = pa.list_(pa.struct([("label", pa.string()), ("template", pa.string()), *_PLACE]))


def _in_order(found: dict[int, list[dict]], row: int) -> list[dict]:
    return sorted(found.get(row, ()), key=lambda m: (m["start"], m["end"], m["label"], m.get("template", "")))


def scan(
    docs: DataFrame, templates: Sequence[tuple[str, str, str]] = TEMPLATES, phrases: Sequence[tuple[str, str]] = PHRASES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of `docs`: id, n_words, phrases, templates, labels, score.

    `phrases` and `templates` hold the places found (words from 0, end exclusive, by start), `labels`
    the sorted labels of both. The score is 1 where an automaton accepts, 0.5 where only a phrase
    stands, else 0. A NULL or empty text has no words. Rows that share an id are scanned apart; a
    NULL id stays. Other columns are not read, whatever their names. An empty table gives an empty
    table. Words are told apart by 64 bits of hash and their length.
    """
    templates, phrases = tuple(templates), tuple(phrases)
    id_type = docs.schema[id_col].dataType
    long, text = LongType(), StringType()
    place = [StructField("start", long), StructField("end", long)]
    schema = StructType([
        StructField(id_col, id_type), StructField("n_words", long),
        StructField("phrases", ArrayType(StructType([StructField("label", text), *place]))),
        StructField("templates", ArrayType(StructType([StructField("label", text), StructField("template", text), *place]))),
        StructField("labels", ArrayType(text)), StructField("score", DoubleType())])
    names = [f.name for f in schema]

    def scan_split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                n_words, found, accepted = scanner.scan(part["text"])
                labels = [sorted({m["label"] for side in (found, accepted) for m in side.get(i, ())}) for i in range(b - a)]
                score = [1.0 if i in accepted else 0.5 if i in found else 0.0 for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([
                    part["id"], pa.array(n_words, pa.int64()),
                    pa.array([_in_order(found, i) for i in range(b - a)], _PHRASE),
                    pa.array([_in_order(accepted, i) for i in range(b - a)], _ACCEPTED),
                    pa.array(labels, pa.list_(pa.string())), pa.array(score, pa.float64())], names=names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan_split, schema)
