from __future__ import annotations

from collections import defaultdict

from ledgersieve.llm.line_dedup import line_dedup


def brute(rows, min_chars=20, min_docs=3):
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    norm = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(upper)
    held = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            held[norm(line)].add(r[0])
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(norm(x)) < min_chars or len(held[norm(x)] - {None}) < min_docs
                or max(held[norm(x)] - {None}) == r[0]]
        out.append((r[0], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def test_awkward_rows_match_brute_force(docs_of, awkward, rows):
    docs = docs_of(awkward, extra=True)
    out = line_dedup(docs)
    assert out.columns == [*docs.drop("n_lines", "n_dropped").columns, "n_lines", "n_dropped"]
    assert line_dedup(docs, stats=False).columns == docs.columns
    assert rows(out, "doc_id", "text", "n_lines", "n_dropped") == brute(awkward)


def test_shared_line_stays_in_largest_id(docs_of, rows):
    line = "Prüfung of a line that is shared"
    table = [(i, f"{i}\n{line}\n{line.upper().replace('Ü', 'ü')}") for i in range(1, 9)]
    out = rows(line_dedup(docs_of(table), stats=False), "doc_id", "text")
    assert out == sorted([(i, str(i)) for i in range(1, 8)] + [(8, table[-1][1])], key=repr)


def test_threshold_counts_documents_not_lines(docs_of, rows):
    line = "a line of twenty or more characters"
    table = [(1, "\n".join([line] * 5)), (2, line)]
    assert [r[1] for r in rows(line_dedup(docs_of(table)), "doc_id", "n_dropped")] == [0, 0]


def test_rows_without_an_id_keep_to_their_own_text(docs_of, rows):
    """Many rows without an id, and with one id, each hold a shared line and one of their own."""
    line = "a line that all of the documents share"
    table = [(None, f"{line}\nrow {i} without any id at all") for i in range(40)] + [(7, f"{line}\nrow {i} of the document seven") for i in range(9)]
    table += [(1, line), (2, line), (3, line), (9, line)] + [(None, line)] * 5
    assert rows(line_dedup(docs_of(table)), "doc_id", "text", "n_lines", "n_dropped") == brute(table)


def test_empty_table(docs_of):
    assert line_dedup(docs_of([])).count() == 0
