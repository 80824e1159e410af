from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgersieve.llm.license_markup import PHRASES, TEMPLATES, Scanner, compile_template, parse, scan

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def pattern(nodes):
    """The same template as a regular expression over words that each end in a space."""
    out = ""
    for kind, *inside in nodes:
        if kind == "word":
            out += re.escape(inside[0]) + " "
        elif kind == "free":
            out += f"(?:[^ ]+ ){{{inside[0]},{inside[1]}}}"
        elif kind == "optional":
            out += f"(?:{pattern(inside[0])})?"
        else:
            out += "(?:" + "|".join("".join(re.escape(w) + " " for w in choice) for choice in inside[0]) + ")"
    return out


def brute(text, templates=TEMPLATES, phrases=PHRASES):
    words = words_of(text)
    places = [(i, i + len(p.split()), label) for p, label in phrases for i in range(len(words))
              if words[i : i + len(p.split())] == p.split()]
    joined = " " + "".join(w + " " for w in words)
    labels = {label for label, _, markup in templates if re.search(r"(?<= )" + pattern(parse(markup)), joined)}
    score = 1.0 if labels else 0.5 if places else 0.0
    return len(words), sorted(places), sorted(labels | {p[2] for p in places}), score


def found(rows):
    return [(r.n_words, sorted((p.start, p.end, p.label) for p in r.phrases), r.labels, r.score) for r in rows]


def plain_text(markup, optional=True):
    """A text of the template, with or without its optional regions."""
    out = []
    for kind, *inside in parse(markup) if isinstance(markup, str) else markup:
        if kind == "word":
            out.append(inside[0])
        elif kind == "free":
            out += ["someone"] * inside[0]
        elif kind == "choice":
            out += inside[0][-1]
        elif optional:
            out += plain_text(inside[0])
    return out


LICENSES = [" ".join(plain_text(m, o)).upper() for _, _, m in TEMPLATES for o in (True, False)]


def test_every_template_accepts_its_own_text_and_no_altered_one(docs_of):
    broken = [t.replace(" THE ", " THE OTHER ", 1) + " END" for t in LICENSES]
    texts = LICENSES + broken + ["prefix " + t + " suffix" for t in LICENSES]
    rows = scan(docs_of(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert found(rows) == [brute(t) for t in texts]
    for row, (label, name, _) in zip(rows, [t for t in TEMPLATES for _ in range(2)]):
        assert (label, name) in {(m.label, m.template) for m in row.templates}


def test_awkward_rows_match_brute_force(docs_of, awkward):
    rows = awkward + [
        (20, "MIT License, mit\nLICENSE; Apache license. the GNU General Public-License"), (21, "mit"), (22, "license mit"),
        (23, "Released under the terms of the MIT licence."), (24, "released under the\x00MIT license é mit licensé"),
        (25, " ".join(["mit license"] * 5000)), (26, "licensed under the apache license version 2"), (27, "0")]
    out = scan(docs_of(rows, extra=True)).collect()
    got = {(r.doc_id, *map(str, f)) for r, f in zip(out, found(out))}
    assert got == {(r[0], *map(str, brute(r[1]))) for r in rows}
    assert len(out) == len(rows)


def test_phrases_do_not_cross_documents(docs_of):
    out = scan(docs_of([(1, "mit"), (2, "license"), (3, "licensed under the mit"), (4, "license")]).coalesce(1)).collect()
    assert all(r.score == 0 and not r.labels for r in out)


@pytest.mark.parametrize("markup", ["", "[[only]]", "{{0-3}} [[x]]", "{{1-2}} a", "a ]]", "[[ a"])
def test_bad_markup_is_refused(markup):
    with pytest.raises(ValueError):
        compile_template("x", "x", markup)


_PIECES = st.sampled_from(["a", "b", "c", "[[a]]", "[[b c]]", "[[a [[b]] c]]", "{{0-2}}", "{{1-3}}", "{{a|b c}}", "{{b||c}}"])


@settings(max_examples=300, deadline=None)
@given(st.lists(_PIECES, min_size=1, max_size=6), st.lists(st.sampled_from("abcd"), max_size=12))
def test_automaton_equals_regular_expression(pieces, words):
    markup = "a " + " ".join(pieces)
    bound = compile_template("x", "x", markup).bind({"a": 1, "b": 2, "c": 3})
    end = bound.end([" abc".index(w) if w in "abc" else 0 for w in words])
    nodes = parse(markup)
    assert (end is not None) == bool(re.match(pattern(nodes), "".join(w + " " for w in words)))


def test_spans_are_word_ranges(docs_of):
    row = scan(docs_of([(1, "x y Licensed under the Apache License, Version 2.0. z")])).first()
    assert [(m.start, m.end, m.label) for m in row.templates] == [(2, 10, "apache-2.0")]
    assert [(m.start, m.end, m.label) for m in row.phrases] == [(5, 7, "apache")]


def test_empty_table(docs_of):
    assert scan(docs_of([])).count() == 0
    assert Scanner(TEMPLATES, PHRASES)
