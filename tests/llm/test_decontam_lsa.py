from __future__ import annotations

import random

import numpy as np
import pytest

from ledgersieve.llm import decontam_lsa


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
    return row[-1]


def brute(table, items):
    """Share of every item in order in every document, wherever the window of any passage reaches."""
    shares = {}
    for d, text in table:
        words = text.lower().split()
        for k, item in items:
            own = item.lower().rstrip(".").split()
            reach = max(decontam_lsa.STRIDE, len(own))
            best, tail = 0.0, 0.0
            for start in range(0, len(words), decontam_lsa.STRIDE):
                window = words[max(0, start - reach) : start + decontam_lsa.PASSAGE + reach]
                if len(set(own) & set(window)) >= 0.4 * len(set(own)):
                    share = longest(own, window) / len(own)
                    if share >= best:
                        best, tail = share, max(tail, longest(own[-(-len(own) // 4) * -1 :], window) / -(-len(own) // 4))
            shares[d, k] = best, tail
    return shares


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("abcdefghijklm", k=4))
    vocabulary = [word() for _ in range(1500)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randrange(20, 50)))) for k in range(25)]
    table = []
    for d in range(160):
        body = draw.choices(vocabulary, k=draw.randrange(30, 200))
        if d % 2:
            leak = items[d * 7 % 25][1].split()  # evenly: an item in a twentieth of the passages has no rare words
            if d % 4 == 3:  # every third word is another one, but for the answer
                leak = [word() if i % 2 == 0 and i < 0.7 * len(leak) else x for i, x in enumerate(leak)]
            at = draw.randrange(len(body))
            body[at:at] = leak
        table.append((d, " ".join(body)))
    return table, items


def search(docs_of, spark, table, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r.id, r.item_id): r for r in decontam_lsa.find_items(docs_of(table), benchmark).collect()}


def test_copies_and_paraphrases_against_a_full_comparison(corpus, docs_of, spark):
    table, items = corpus
    found = search(docs_of, spark, table, items)
    shares = brute(table, items)
    copies = {p for p, (share, tail) in shares.items() if share >= decontam_lsa.ITEM_SHARE and tail >= decontam_lsa.ANSWER_SHARE}
    reworded = {p for p, (share, tail) in shares.items()
                if decontam_lsa.PARAPHRASE_SHARE <= share < decontam_lsa.ITEM_SHARE and tail >= decontam_lsa.ANSWER_SHARE}
    assert len(copies) >= 40 and len(reworded) >= 30
    assert copies <= found.keys() and found.keys() <= copies | reworded
    assert len(reworded & found.keys()) >= 0.9 * len(reworded)
    assert all(abs(r.item_share - shares[p][0]) < 1e-9 for p, r in found.items())


def test_paraphrases_are_found_by_the_latent_space_only(corpus, docs_of, spark, monkeypatch):
    table, items = corpus
    found = search(docs_of, spark, table, items)
    basis = decontam_lsa.latent_basis
    monkeypatch.setattr(decontam_lsa, "latent_basis", lambda places, weights: np.zeros_like(basis(places, weights)))
    without = search(docs_of, spark, table, items)
    assert without.keys() == {p for p, r in found.items() if r.item_share >= decontam_lsa.ITEM_SHARE}
    assert len(without) < len(found)
