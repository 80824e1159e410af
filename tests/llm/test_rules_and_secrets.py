from __future__ import annotations

import random
import re

from ledgersieve.llm import secret_ledger
from ledgersieve.llm.outlier_rules import kept_documents, quality_rules


def counts(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1}
    repeat = len({i + j for i, w in enumerate(windows) if w in many for j in range(3)})
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            repeat, failed)


def test_base_counts_match_brute_force(docs_of, awkward, rows):
    table = [r for r in awkward if r[0] != 7] + [(20, "a b c d a b c x a b c\na b\na b\n| # a b c d"), (21, "é é é é é\né é é")]
    docs = docs_of(table, extra=True)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(quality_rules(docs), "doc_id", *names) == sorted([(r[0], *counts(r[1])) for r in table], key=repr)
    assert kept_documents(docs).columns == docs.columns


def test_outliers_go_and_clean_rows_stay(docs_of):
    draw = random.Random(2)
    prose = lambda: " ".join(f"{draw.choice('abcdefgh')}{draw.randrange(9999)}" for _ in range(draw.randrange(80, 400)))
    table = [(i, prose(), "en", "a") for i in range(600)]
    table += [(1000 + i, " ".join(w + "###" for w in prose().split()), "en", "a") for i in range(30)]
    kept = {r.doc_id for r in quality_rules(docs_of(table)).where("kept").collect()}
    assert kept == set(range(600))


def test_twins_of_another_source_are_judged_apart(docs_of):
    """One text under one id: an outlier where words are short, usual where they are all as long."""
    draw = random.Random(3)
    prose = lambda size: " ".join("".join(draw.choice("abcdefgh") for _ in range(size)) for _ in range(draw.randrange(80, 400)))
    table = [(i, prose(5), "en", "a") for i in range(400)] + [(1000 + i, prose(30), "en", "b") for i in range(400)]
    twin = prose(30)
    docs = docs_of([*table, (5000, twin, "en", "a"), (5000, twin, "en", "b")])
    assert {(r.source, r.kept) for r in quality_rules(docs).where("doc_id = 5000").collect()} == {("a", False), ("b", True)}
    assert [r.source for r in kept_documents(docs).where("doc_id = 5000").collect()] == ["b"]


def test_repeated_words_or_lines_alone_make_an_outlier(docs_of):
    draw = random.Random(7)
    word = lambda: f"{draw.choice('abcdefgh')}{draw.randrange(1000, 9999)}"
    prose = lambda n: [word() for _ in range(n)]
    table = [(i, " ".join(prose(draw.randrange(80, 400))), "en", "a") for i in range(600)]
    for i in range(20):
        phrase, lines = " ".join(prose(4)), [" ".join(prose(2)) for _ in range(20)]
        # About half of the words repeat; then a quarter of the lines do, but hardly a run of three words.
        table.append((1000 + i, " ".join(f"{phrase} {' '.join(prose(4))}" for _ in range(24)) + " " + " ".join(prose(8)), "en", "a"))
        table.append((2000 + i, "\n".join(x for line in lines for x in (line, word(), line, word())), "en", "a"))
    judged = quality_rules(docs_of(table)).collect()
    assert not any(r.base_failed for r in judged)
    assert {r.doc_id for r in judged if r.kept} == set(range(600))


def test_empty_tables(docs_of, spark, tmp_path):
    assert quality_rules(docs_of([])).count() == 0
    assert secret_ledger.scan(docs_of([]), str(tmp_path / "ledger")).count() == 0


KEYED = """(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(KEYED.replace("(pass", "(?i:pass", 1), text, re.A) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{secret_ledger.BASE[k]}:{a}:{b}" for a, k, b in sorted(out)]


def test_secrets_match_brute_force_and_are_scanned_once(docs_of, awkward, tmp_path, spark):
    texts = ["é Token = 'abcdef123456789'", "token=abc secret=abcdefghijkl", "token=api_key: abcdefghijklmnop",
             "AKIA" + "A" * 14 + " AKIAAKIA0", "deadbeefdeadbeef00 " * 3, None]
    table = [*awkward, *[(100 + i, t) for i, t in enumerate(texts * 2)]]
    ledger = str(tmp_path / "ledger")
    for _ in range(2):
        found = secret_ledger.scan(docs_of(table, extra=True), ledger).collect()
        got = sorted((str(r.doc_id), [f"{f.kind}:{f.start}:{f.end}" for f in r.findings if f.kind in secret_ledger.BASE]) for r in found)
        assert got == sorted((str(r[0]), base_spans(r[1])) for r in table)
        assert spark.read.parquet(ledger).count() == len({r[1] or "" for r in table})
    newer = tuple(secret_ledger.Rule(**{**r.__dict__, "version": 2}) if r.name == "hex" else r for r in secret_ledger.RULES)
    secret_ledger.scan(docs_of(table), ledger, newer).count()
    again = [[p.rule for p in r.pairs] for r in spark.read.parquet(ledger).collect() if len(r.pairs) == 1]
    assert again == [["hex@2"]] * len({r[1] or "" for r in table})
