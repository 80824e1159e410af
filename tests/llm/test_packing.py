from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgersieve.llm.packing import WordTokenizer, balance, pack, pack_chunk

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(1, 20_000), max_size=60))
def test_chunk_holds_each_token_once_and_needs_no_padding(lengths):
    sequences = pack_chunk(lengths)
    seen = sorted((d, a, n) for s in sequences for d, a, n in s)
    place = {}
    for doc, start, size in seen:
        assert start == place.get(doc, 0) and size > 0
        place[doc] = start + size
    assert place == dict(enumerate(lengths))
    for s in sequences:
        total = sum(p[2] for p in s)
        assert total <= 4096 and total & (total - 1) == 0
    assert len(balance(sequences)) == len(sequences)


def test_round_trip_against_whole_text_tokenizer(docs_of, awkward):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    marked = [(30, "a <|endoftext|> b"), (31, "<|startoftext|>x"), (32, "<|ENDOFTEXT|> <|StartOfText|>"), (33, "x<|endoftext|>Y  z"),
              (34, "a <|endof text|>\n<|startoftext|>\t"), (35, "<|endoftext|>" * 3)]
    table = awkward + marked
    out = pack(docs_of(table, extra=True), PATH, chunk_tokens=5000).collect()
    expected = sorted(
        (str(r[0]), tuple(whole.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in table)
    docs, current = [], {}
    for row in sorted(out, key=lambda r: (str(r.doc_id), r.start)):
        ids = np.frombuffer(row.input_ids, "<u4")
        assert len(ids) == row.length
        current.setdefault((str(row.doc_id), row.doc_tokens), []).append((row.start, tuple(ids)))
    assert sum(r.length for r in out) == sum(len(x[1]) for x in expected)
    repeated = {"3", "12", "None"}  # ids of several rows, checked by their token count above
    for (key, tokens), pieces in current.items():
        if key not in repeated:
            docs.append((key, tuple(i for _, p in sorted(pieces) for i in p)))
    assert sorted(docs) == [x for x in expected if x[0] not in repeated]


def test_sequences_are_gapless(docs_of, awkward):
    by_sequence = {}
    for row in pack(docs_of(awkward), PATH).collect():
        by_sequence.setdefault(row.sequence_id, []).append(row)
    for pieces in by_sequence.values():
        place = 0
        for row in sorted(pieces, key=lambda r: r.offset):
            assert row.offset == place
            place += row.length
        assert place == pieces[0].sequence_tokens <= 4096


@pytest.mark.parametrize("table", [[], [(1, None)], [(1, "")]])
def test_empty(docs_of, table):
    assert [r.length for r in pack(docs_of(table), PATH).collect()] == [1] * len(table)


def test_a_word_is_remembered_once_whatever_marks_follow_it():
    words = [a + b for a in ("wind", "rain", "été", "mër") for b in ("y", "ow", "ß", "ing")]
    tails = ["", ",", ".", "!!", "?", "%%%", ".;", "..."]
    coder = WordTokenizer(PATH)
    ids, counts = coder.encode(pa.array([" ".join(w + t for w in words) for t in tails]))
    assert len(coder._row) <= len(words) + len(tails)
    before = len(coder._ids)
    again, _ = coder.encode(pa.array([" ".join(w + t for t in reversed(tails)) for w in words]))
    assert len(coder._ids) == before
    assert sorted(again) == sorted(ids) and counts.sum() == len(ids)


@pytest.fixture(scope="module")
def coders():
    from tokenizers import Tokenizer

    return WordTokenizer(PATH), Tokenizer.from_file(PATH)


@given(st.lists(st.text("aZ\u00e9\u00c9\u00d7\u00f7\u00aa\u00df\u0130\u03a3\u0301\u4e2d7 \n\x1c\u00a0,.!#:'st-<|>", max_size=24), max_size=4))
def test_ids_are_those_of_the_whole_text(coders, texts):
    mine, whole = coders
    ids, counts = mine.encode(pa.array(texts, pa.string()))
    expected = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


@pytest.mark.parametrize("bound", ["KNOWN_WORDS", "KNOWN_IDS"])
def test_forgetting_keeps_the_ids(monkeypatch, coders, bound):
    monkeypatch.setattr(f"ledgersieve.llm.packing.{bound}", 3)
    mine, whole = WordTokenizer(PATH), coders[1]
    for text in ("one two, three four.", "", "two one! 4,5 x-y", "three don't; stop", "four one two, three"):
        ids, counts = mine.encode(pa.array([text, None]))
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids and counts.tolist() == [len(ids), 0]
        assert len(mine._row) < 12  # five texts hold more


GROWN = """
import itertools, resource, sys
import pyarrow as pa
from ledgersieve.llm.packing import TEXT_SLICE, WordTokenizer
from ledgersieve.llm.words import slices

words = map("".join, itertools.product("badcegfih", repeat=7))
texts = pa.table({"text": [" ".join(itertools.islice(words, 1000)) for _ in range(800)]}).combine_chunks().to_batches()[0]
coder = WordTokenizer(sys.argv[1])
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
before = peak()
for a, b in slices(texts, "text", TEXT_SLICE):
    coder.encode(texts.slice(a, b - a)["text"])
print(peak() - before)
"""


def test_a_worker_takes_little_memory_for_many_words():
    """800,000 words that differ: what is remembered and a slice's arrays, in MB."""
    root = Path(__file__).resolve().parents[2]
    said = subprocess.run([sys.executable, "-c", GROWN, PATH], cwd=root, capture_output=True, text=True, check=True, timeout=300)
    assert int(said.stdout) < 200
