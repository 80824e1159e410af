from __future__ import annotations

from ledgersieve.llm.rlz_dedup import rlz_dedup


def brute(rows, n=13):
    words = [(r[1] or "").encode().split() for r in rows]
    key = [float("inf") if r[0] is None else r[0] for r in rows]
    first = {}
    for k, w in zip(key, words):
        for i in range(len(w) - n + 1):
            win = tuple(w[i : i + n])
            first[win] = min(k, first.get(win, k))
    out = []
    for r, k, w in zip(rows, key, words):
        gone = {i + j for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] < k for j in range(n)}
        out.append((r[0], b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=repr)


def test_awkward_rows_match_brute_force(docs_of, awkward, rows):
    found = rows(rlz_dedup(docs_of(awkward, extra=True)), "doc_id", "text", "n_words", "n_removed")
    assert found == brute(awkward)


def test_factors_point_to_equal_words_and_overlaps_match(docs_of, rows):
    base = [f"w{i}" for i in range(120)]
    table = [(1, " ".join(base)), (2, " ".join(base[10:60])), (3, " ".join(base[5:30] + ["x"] + base[40:80])),
             (4, " ".join(base[20:32])), (5, " ".join(["y"] + base[50:63] + base[10:40])), (0, " ".join(base[100:]))]
    out = rlz_dedup(docs_of(table))
    assert rows(out, "doc_id", "text", "n_words", "n_removed") == brute(table)
    words = {i: t.split() for i, t in table}
    for r in out.collect():
        for f in r.factors:
            mine = words[r.doc_id][f.start : f.start + f.length]
            assert f.ref_id < r.doc_id and mine == words[f.ref_id][f.ref_start : f.ref_start + f.length]


def test_empty_table(docs_of):
    assert rlz_dedup(docs_of([])).count() == 0
