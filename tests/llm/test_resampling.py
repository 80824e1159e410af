from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from ledgersieve.llm.alnum import SPACED
from ledgersieve.llm.resampling import drawn_documents, resample, run_crcs, substring_crc

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, least=1, most=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    return words, [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent=10, least_words=20, least=1, most=1, buckets=10_000):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, least, most)[1])

    s, t = count([r[1] for r in rows]), count(target)
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    scored = []
    for r in rows:
        words, found = features(r[1], least, most)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t)))
                     for b in (zlib.crc32(f.encode()) % buckets for f in found))
        key = "" if r[0] is None else str(r[0])
        h = int(hashlib.sha256(f"2024:{key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((r[0], len(words), len(found), weight, score))
    able = sorted((x for x in scored if x[1] >= least_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    drawn = able[: len(able) * percent // 100]
    out = [(*x, rank) for rank, x in enumerate(able, 1) if rank <= len(drawn)] + [(*x, None) for x in able[len(drawn):]]
    return sorted(out + [(*x, None) for x in scored if x[1] < least_words], key=repr)


COLUMNS = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_later_crc_minus_shifted_earlier_is_the_crc_between(first, second):
    later, earlier = (np.array([zlib.crc32(x)], np.uint32) for x in (first + second, first))
    assert substring_crc(later, earlier, np.array([len(second)]))[0] == zlib.crc32(second)


@given(st.lists(st.text(max_size=60), max_size=6), st.integers(1, 3), st.integers(0, 3))
def test_run_crcs(texts, least, more):
    crcs, runs, words = run_crcs([t.encode() for t in texts], least, least + more)
    wanted = [sorted(zlib.crc32(f.encode()) for f in features(t, least, least + more)[1]) for t in texts]
    ends = np.cumsum([0, *runs])
    assert [sorted(crcs[a:b].tolist()) for a, b in zip(ends, ends[1:])] == wanted
    assert words.tolist() == [len(features(t)[0]) for t in texts]


def texts(n):
    return [(i, " ".join(f"w{(i * 7 + j * j) % (30 + i % 11)}" for j in range(10 + i % 40))) for i in range(n)]


@pytest.mark.parametrize("least, most, percent", [(1, 1, 10), (1, 2, 33), (2, 3, 100), (1, 1, 0)])
def test_equals_brute_force(docs_of, rows, least, most, percent):
    table = texts(150)
    target = [(1, "w1 w2 W3, w1"), (2, None), (3, "w5 w6 w7 w8")]
    out = resample(docs_of(table, extra=True).drop("n_words", "score"), docs_of(target), percent, least=least, most=most)
    assert rows(out, *COLUMNS) == brute(table, [t[1] for t in target], percent, least=least, most=most)


def test_awkward_rows(docs_of, rows, awkward):
    table = awkward + [(None, awkward[0][1] + " one two three four five")] * 5 + texts(40)[15:]
    out = resample(docs_of(table, extra=True), docs_of([(1, "alpha beta")]), percent=50)
    assert rows(out, *COLUMNS) == brute(table, ["alpha beta"], 50)


def test_drawn_documents_are_as_many_as_drawn(docs_of):
    same = " ".join(f"w{i}" for i in range(25))
    table = texts(60) + [(7000, same)] * 30 + [(None, same)] * 10
    docs = docs_of(table)
    ranking = resample(docs, docs_of([(1, same)]), percent=25)
    drawn = drawn_documents(docs, ranking)
    able = sum(len(features(t)[0]) >= 20 for _, t in table)
    assert drawn.columns == docs.columns
    assert drawn.count() == able // 4 == ranking.where("rank IS NOT NULL").count()
    assert [r.rank for r in ranking.where("rank IS NOT NULL").orderBy("rank").collect()] == list(range(1, able // 4 + 1))


def test_empty_tables(docs_of, rows):
    assert resample(docs_of([]), docs_of([(1, "a")])).count() == 0
    assert rows(resample(docs_of(texts(30)), docs_of([])), *COLUMNS) == brute(texts(30), [])


def test_bytes_between_words():
    text = "".join(map(chr, range(128)))
    assert [w.decode() for w in text.encode().translate(SPACED).split()] == features(text)[0]
