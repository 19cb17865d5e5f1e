"""Alignment of two tokenizers against whole encodings and a plain cut at common ends."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskmill.llm import alignment as m
from tests.llm.conftest import long_text

FILES = m.tokenizer_files()


@pytest.fixture(scope="module")
def plain():
    """Groups of whole texts as lists of a ids and b ids."""
    a, b = Tokenizer.from_str(FILES[0]), sentencepiece.SentencePieceProcessor(model_proto=FILES[1])
    a.encode_special_tokens = True
    letters, names = m.byte_letters(), {i: p for p, i in a.get_vocab().items()}

    def spell_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return []
        spelt = (" " + text).encode()
        x = [(i, bytes(letters[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, spell_b(i)) for i in b.encode(text)]
        if b"".join(s for _, s in x) != spelt or b"".join(s for _, s in y) != spelt:
            return []
        ends = [np.cumsum([len(s) for _, s in side]).tolist() for side in (x, y)]
        common = sorted(set(ends[0]) & set(ends[1]))
        found = [([], []) for _ in common]
        for side, (tokens, end) in enumerate(zip((x, y), ends)):
            for (i, _), e in zip(tokens, end):
                found[next(k for k, c in enumerate(common) if e <= c)][side].append(i)
        return found

    return groups


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def brute(texts, plain):
    every = [plain(t) for t in texts]
    held = defaultdict(int)
    links = [[p for a, b in groups for p in product(a, b)] for groups in every]
    for own in links:
        for pair in set(own):
            held[pair] += 1
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [
        (sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own),
         sum(held[p] == top[p[0]] for p in own), sum(held[p] for p in own), shown(g))
        for g, own in zip(every, links)
    ]


@pytest.fixture(scope="module")
def aligner():
    return m.Aligner(*FILES)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aBe'st é́▁ 　\n\t\x0b\x1c0.,<|endoftext>/sunkx410中😀\x00﻿ﬁ", max_size=50))
def test_stretches_make_up_the_whole(plain, aligner, text):
    places = aligner.find([text])[0]
    assert ";".join(aligner.groups[i] for i in places) == shown(plain(text))


def test_coalesce_joins_what_overlaps():
    starts, ends = np.array([0, 3, 0, 5, 6, 6]), np.array([3, 6, 2, 6, 9, 8])
    assert m.coalesce(starts, ends).tolist() == [0, 1, 0, 1, 2, 2]
    assert m.coalesce(starts[:0], ends[:0]).tolist() == []


@pytest.mark.parametrize("head", [0, 5, m.HEAD])
def test_align(spark, docs, plain, head):
    texts = [
        "Hello world, unbelievable antidisestablishmentarianism", None, "", " ", "\n\n  x", "naïve façade déjà vu", "中文 字符 😀😀",
        "aaaaaaaa" * 300, long_text(200), "the the the the", "the the the the", "<|endoftext|> </s> <unk> <0x41>", "▁odd",
        "  a  b", "12345 678.90", "x" * 5000 + " y", "tab\tand\x0bvt",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "the the the the"), (None, "the cat")]
    frame = docs(*rows, extra=["n_a", "groups", "_row", "rest"])
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], plain))), key=repr)
    got = m.align(frame, head=head).collect()
    assert sorted(map(tuple, got), key=repr) == want
    short = m.align(frame, digest=True, head=head).collect()
    shas = sorted((r.doc_id, r.groups_sha256) for r in short if r.doc_id is not None)
    assert shas == sorted((i, hashlib.sha256(g.encode()).hexdigest() if g else "") for i, *_, g in want if i is not None)
    assert m.align(frame.limit(0)).count() == 0


def test_memory_is_bounded(plain):
    aligner = m.Aligner(*FILES, most=2_000)
    for seed in range(30):
        text = long_text(300, seed)
        assert ";".join(aligner.groups[i] for i in aligner.find([text])[0]) == shown(plain(text))
        assert aligner.weight < 2_000 + 300 * 30


def test_query_on_the_table(spark, folder, plain):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: x for r, x in zip(rows, brute([r.text for r in rows], plain))}
    got = m.op12_alignment(spark, folder).collect()
    assert len(got) == len(rows)
    for r in got:
        *numbers, groups = want[r.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == numbers
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    assert m.pair_counts(m.linked(spark.createDataFrame(rows))).filter(F.col("docs") > len(rows)).count() == 0
