"""Packing: exact round trip, proportions, and the word-wise encoder."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from deskmill.llm import packing as m
from deskmill.llm.tokens import Encoder, by_size, tokenizer_text
from tests.llm.conftest import long_text


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_str(tokenizer_text())


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aB'sé́Σ ,.\n\t1x<|endoftext>İǅ \x1c中😀", max_size=40))
def test_encoder_is_the_tokenizer(tokenizer, text):
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(Encoder(tokenizer_text()).encode([text])[0], np.uint32).tolist() == ids


def test_special_tokens_of_a_text_are_those_of_the_tokenizer(tokenizer):
    for text in ["a <|endoftext|> b", "x<|startoftext|>y, z", "<|endoftext|>" * 3, "<|END|>", "İ. Øİ, ǅ.", "naïve É. ŉ ß,"]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(Encoder(tokenizer_text()).encode([text])[0], np.uint32).tolist() == ids
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids == [320, 49407, 321]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aB'sé́Σ ,.&\n\t1x<|endoftext|>İǅǀ \x1c中😀", max_size=30), max_size=4))
def test_column_is_encoded_like_its_texts(tokenizer, texts):
    ids = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    for column in (pa.array(texts, pa.string()), pa.array(["cut off", *texts], pa.large_string())[1:]):
        got = Encoder(tokenizer_text(), most=4).encode_column(column).to_pylist()
        assert [np.frombuffer(x, np.uint32).tolist() for x in got] == ids


def test_a_word_is_learnt_once_however_it_comes(monkeypatch):
    encoder, learnt = Encoder(tokenizer_text()), []
    ids = Encoder._ids

    def counted(of, texts):
        learnt.extend(w for t in texts for w in t.split(" "))
        return ids(of, texts)

    monkeypatch.setattr(Encoder, "_ids", staticmethod(counted))
    encoder.encode_column(pa.array(["qzxv, Qzxv! QZXV&&& (qzxv qzxv..."] * 3))
    assert learnt.count("qzxv") == 1
    encoder.most = 2
    for i in range(4):  # a word that keeps coming outlives the others
        encoder.encode_column(pa.array([f"qzxv, filler{'b' * i} fillers{'c' * i}"]))
    assert learnt.count("qzxv") == 1


def test_long_words_are_not_remembered():
    encoder = Encoder(tokenizer_text())
    encoder.encode_column(pa.array(["short " + "y" * 5000]))
    assert "short" in encoder.memory.words and "y" * 5000 not in encoder.memory.words


def test_rows_by_size():
    batch = pa.record_batch({"text": ["a" * 40, None, "b" * 90, "c " * (1 << 20), "d", "e"]})
    got = list(by_size(iter([batch, batch.slice(0, 0), batch]), "text", 100))
    assert pa.Table.from_batches(got) == pa.Table.from_batches([batch, batch])
    assert [x.num_rows for x in got] == [2, 1, 1, 4, 1, 1, 2]


def test_long_text_in_a_column(tokenizer):
    texts = ["a b", "long, text " * 200_000, None]
    got = Encoder(tokenizer_text()).encode_column(pa.array(texts)).to_pylist()
    assert [len(x) for x in got] == [8, 12 * 200_000, 0]
    assert got[1][:12] == np.array(tokenizer.encode("long, text").ids, np.uint32).tobytes()


def test_round_trip(spark, docs, tokenizer):
    rows = [
        (1, long_text(3000), "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "hello, world", "en", "b"),
        (4, "hello, world", "en", "b"), (None, long_text(40), "de", None), (5, long_text(900, 5), "de", "b"), (6, "z" * 5000, "de", "c"),
    ]
    got = m.pack(docs(*rows, extra=["start", "length", "ids", "part", "row"]), length=256, portion=32).collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id].append((r.start, bytes(r.ids)))
    assert sorted(sequences) == list(range(len(sequences)))
    for number, pieces in sequences.items():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end == 256 or number == max(sequences)
    copies = Counter(r[0] for r in rows)
    for doc, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(texts[doc])[:: copies[doc]]
        assert np.frombuffer(b"".join(p for _, p in pieces), np.uint32).tolist() == ids


def test_sequences_hold_the_targets(docs):
    rows = [(i, long_text(150, i), "en", "ab"[i % 2]) for i in range(60)]
    got = m.pack(docs(*rows), targets={"a": 3.0, "b": 1.0}, length=512, portion=32).collect()
    share = defaultdict(Counter)
    for r in got:
        share[r.sequence_id][r.source] += r.length
    dry = max(q for q, s in share.items() if s["a"])  # from there on, only b is left
    assert dry > 5
    for q in range(dry):
        assert abs(share[q]["a"] - 384) <= 32


def test_no_rows(docs):
    assert m.pack(docs((1, "a")).limit(0)).count() == 0
