"""Line deduplication against a plain Python version."""

from __future__ import annotations

from collections import defaultdict

import pytest

from deskmill.llm import line_dedup as m

BLANKS = " \t\n\x0b\f\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, least=10):
    owners = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANKS))
            if len(key) >= least:
                owners[key].add(doc)
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            found = owners.get(lower(line.strip(BLANKS)), set())
            if len(found) < 2 or doc == min(found):
                kept.append(line)
        result.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(result)


def done(frame):
    rows = m.line_dedup(frame).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted(tuple(r) for r in rows)


CASES = [
    (1, "A line that repeats\nown line of one\nshort"),
    (2, "  a LINE that repeats \r\nshort\nA line that repeats"),
    (3, "own line of one\nÄ line with an umlaut"),
    (4, "ä line with an umlaut\n\x0bA line that repeats\x0c"),
    (5, ""),
    (6, None),
    (7, "\n\n"),
    (8, "nine char\nten chars!"),
    (9, "nine char\nten chars!"),
    (9, "ten chars!\nA line that repeats"),
    (10, " ten chars!"),
]


def test_like_plain_version(docs):
    assert done(docs(*CASES)) == plain(CASES)


def test_saturated_filter_gives_the_same(docs, monkeypatch):
    monkeypatch.setattr(m, "CHUNK", 1)
    many = [(i, f"this is line number {i}\nshared line {i % 3} here\n" + "\n".join(f"filler {i} {j} text" for j in range(40))) for i in range(60)]
    rows = m.line_dedup(docs(*many), max_bits=64).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(tuple(r) for r in rows) == plain(many)


def test_very_long_text(docs):
    rows = [(1, "\n".join(f"line number {i % 700}" for i in range(20_000))), (2, "line number 5\n" + "x" * 300_000)]
    assert done(docs(*rows)) == plain(rows)


def test_null_id_comes_last(docs):
    found = m.line_dedup(docs((None, "a line that repeats"), (3, "a line that repeats"))).collect()
    assert {r.doc_id: r.text for r in found} == {None: "", 3: "a line that repeats"}


def test_clashing_columns_and_no_rows(docs):
    found = m.line_dedup(docs((1, "abc"), extra=["n_lines", "key", "doc", "first"])).first()
    assert (found.n_lines, found.key, found.first, found.source) == (1, "mine", "mine", "s1")
    assert m.line_dedup(docs((1, "abc")).limit(0)).count() == 0


def test_key_length_counts_code_points():
    assert m.line_keys("éééééééééé\nééééééééé".encode(), 10) == ["éééééééééé".encode(), b""]
    assert m.line_keys(None, 10) == [b""]


@pytest.mark.parametrize("n", [1, 500])
def test_filter_never_misses(docs, n):
    rows = [(i, f"key of number {i % n} twice") for i in range(2 * n)]
    twice = m.repeat_filter(docs(*rows), 10, 1 << 20)
    at, mask = m._bits([f"key of number {i} twice".encode() for i in range(n)], len(twice))
    assert ((twice[at] & mask) == mask).all()
