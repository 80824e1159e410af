from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
import xxhash

from ledgersieve.llm import simhash
from ledgersieve.llm.simhash import near_duplicates


def fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").translate(
        {9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits=4):
    prints = [fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return sorted(((r[0], prints[i], least[find(i)]) for i, r in enumerate(rows)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in df.collect()), key=repr)


def test_awkward_rows_match_brute_force(docs_of, awkward):
    docs = docs_of(awkward, extra=True)
    out = near_duplicates(docs, root_col="label")
    assert found(out) == brute(awkward)
    assert sorted(out.columns) == sorted({*docs.columns} - {"text"})


def test_edited_copies_match_brute_force(docs_of):
    draw = random.Random(5)
    table = []
    for k in range(30):
        words = [f"w{draw.randrange(500)}" for _ in range(200)]
        for _ in range(6):
            table.append((len(table), " ".join(words)))
            words = list(words)
            words[draw.randrange(200)] = "edit"
    assert found(near_duplicates(docs_of(table))) == brute(table)


@pytest.mark.parametrize("leaf", [1 << 22, 200])
def test_links_connect_like_all_pairs(spark, monkeypatch, leaf):
    """Random values with planted chains; a small leaf makes the descent settle further bits."""
    draw = np.random.default_rng(3)
    values = list(draw.integers(0, 2**64, 80, dtype=np.uint64))
    for v in values[:20]:
        for _ in range(5):
            for b in draw.choice(64, 4, replace=False):
                v ^= np.uint64(1 << int(b))
            values.append(v)
    values = np.unique(values)
    pairs = [(a, b) for i, a in enumerate(values) for b in values[:i] if int(a ^ b).bit_count() <= 4]
    monkeypatch.setattr(simhash, "LEAF_VARIANTS", leaf)
    flips = np.full(len(values), 2)
    links = [(int(a), int(b)) for x, y in simhash._descend(values, flips, 64) for a, b in zip(x, y)]
    assert all((a ^ b).bit_count() <= 4 for a, b in links)

    def classes(edges):
        root = {int(v): int(v) for v in values}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v
        for a, b in edges:
            root[find(int(a))] = find(int(b))
        groups = {}
        for v in values:
            groups.setdefault(find(int(v)), set()).add(int(v))
        return sorted(map(sorted, groups.values()))

    assert classes(links) == classes(pairs)
    df = spark.createDataFrame([(int(v.view(np.int64)),) for v in values], "fingerprint long")
    edges = [(r.a % 2**64, r.b % 2**64) for r in simhash.near_links(df).collect()]
    assert classes(edges) == classes(pairs)


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).count() == 0


def test_a_group_of_prints_takes_little_memory():
    """2,400 prints have four million variants; one in two has a partner four flips away."""
    own = np.random.default_rng(5).integers(0, 1 << 63, 1200, np.uint64)
    prints = np.concatenate([own, own ^ np.uint64(0b110011)])
    tracemalloc.start()
    links = list(simhash._descend(prints, np.full(len(prints), 2), 58))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    met = {(min(a, b), max(a, b)) for x, y in links for a, b in zip(x.tolist(), y.tolist())}
    assert {(min(a, b), max(a, b)) for a, b in zip(prints[:1200].tolist(), prints[1200:].tolist())} <= met
    assert peak < 150e6
