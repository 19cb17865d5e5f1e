"""Token ids of whole texts, with a memory of words already encoded."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from deskmill.llm.common import pieces, process_memory

# A word of Latin letters with at most ASCII marks behind it: lower-casing gives one letter each
# there, none of the letters composes with another, and the run of marks is cut off by the
# tokenizer too, so word and marks can be encoded apart.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-/:-@\[-`{-~]*)")
LONG = 1 << 20  # bytes; a longer text is encoded in pieces
SHORT = 64  # characters; longer words are not remembered
TOGETHER = 200  # words that the tokenizer gets as one text


def tokenizer_text(path: str | None = None) -> str:
    """The tokenizer file as text, read by the driver and sent to the tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


class Words:
    """Different words and the ids of each, as Arrow columns: under 60 bytes a word, some 140 in dictionaries."""

    def __init__(self, words: pa.Array | None = None, ids: pa.Array | None = None) -> None:
        self.words = pa.array([], pa.string()) if words is None else words
        self.ids = pa.array([], pa.binary()) if ids is None else ids

    def __len__(self) -> int:
        return len(self.words)

    def __contains__(self, word: str) -> bool:
        return pc.index(self.words, word).as_py() >= 0


class Encoder:
    """Ids as little-endian 32-bit numbers.

    The tokenizer drops white space and never joins over it, so a text is encoded word by
    word, cut at spaces and line ends only. Arrow finds the different words of a column and
    puts their ids in place. Words live in a bounded memory of the process, which later tasks
    of the same operator in it share: when the newer half is full it becomes the older one, which
    goes except for the words that are met again.
    """

    def __init__(self, text: str, most: int = 800_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        memory = process_memory(f"words {hash(text)}")
        if not hasattr(memory, "tokenizer"):
            memory.words, memory.older, memory.marks = Words(), Words(), {"": b""}
            memory.single, memory.older_single = {}, {}  # of texts that do not come as a column
            memory.tokenizer = Tokenizer.from_str(text)
            # The same model without the steps that change nothing in lower-case letters.
            memory.bare = Tokenizer.from_str(text)
            memory.bare.normalizer = normalizers.Sequence([])
            memory.bare.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
            )
            suffix, vocabulary = memory.bare.model.end_of_word_suffix, memory.bare.get_vocab()
            memory.last = np.zeros(max(vocabulary.values()) + 1, np.bool_)
            memory.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.memory, self.most = memory, most

    @staticmethod
    def _ids(tokenizer: Tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of_letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case letters, encoded many at a time and cut behind last tokens."""
        if not words:
            return []
        together = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        flat = np.concatenate(self._ids(self.memory.bare, together))
        ends = (np.flatnonzero(self.memory.last[flat]) + 1) * 4
        if len(ends) != len(words):  # a model that marks no ends
            return [x.tobytes() for x in self._ids(self.memory.bare, words)]
        data, ends = flat.tobytes(), ends.tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _learn(self, words: list[str]) -> list[bytes]:
        memory, letters, marks, other = self.memory, [], [], []
        if not words:
            return []
        for w in words:
            plain = PLAIN.fullmatch(w)
            letters.append(plain[1].lower() if plain else None)
            marks.append(plain[2] if plain else w)
            if not plain:
                other.append(w)
        cores = dict.fromkeys(letters)
        cores.pop(None, None)
        cores.update(zip(cores, self._ids_of_letters(list(cores))))
        other += set(marks).difference(memory.marks, other)
        apart = dict(zip(other, (x.tobytes() for x in self._ids(memory.tokenizer, other))))
        if len(memory.marks) < 10_000:
            memory.marks.update((m, apart[m]) for m, core in zip(marks, letters) if core and m in apart)
        known, cores[None] = memory.marks, b""
        return [cores[core] + (known[mark] if mark in known else apart[mark]) for core, mark in zip(letters, marks)]

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of different words, from memory where it has them."""
        memory = self.memory
        if len(memory.single) > self.most // 2:
            memory.single, memory.older_single = {}, memory.single
        ids = list(map(memory.single.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        for i in new:
            ids[i] = memory.older_single.get(words[i])
        unknown = [i for i in new if ids[i] is None]
        for i, x in zip(unknown, self._learn([words[i] for i in unknown])):
            ids[i] = x
        memory.single.update((words[i], ids[i]) for i in new if len(words[i]) <= SHORT)
        return ids

    def _look_up_column(self, words: pa.Array) -> pa.Array:
        """``_look_up`` of an Arrow column."""
        memory = self.memory
        if len(memory.words) > self.most // 2:
            memory.words, memory.older = Words(), memory.words
        newer, older = memory.words, memory.older
        at = pc.index_in(words, value_set=pa.concat_arrays([newer.words, older.words]))
        learnt = pa.array(self._learn(words.filter(at.is_null()).to_pylist()), pa.binary())
        at = at.fill_null(-1).to_numpy().copy()
        at[at < 0] = len(newer) + len(older) + np.arange(len(learnt))
        ids = pa.concat_arrays([newer.ids, older.ids, learnt]).take(pa.array(at))
        kept = pc.and_(pa.array(at >= len(newer)), pc.less_equal(pc.utf8_length(words), SHORT))
        memory.words = Words(
            pa.concat_arrays([newer.words, words.filter(kept)]), pa.concat_arrays([newer.ids, ids.filter(kept)])
        )
        return ids

    def _encode(self, texts: pa.Array) -> pa.Array:
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        placed = self._look_up_column(words.dictionary).take(words.indices)
        _, ends, data = placed.buffers()
        ends = np.frombuffer(ends, np.int32, len(placed) + 1)[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        del lists, words
        pa.default_memory_pool().release_unused()  # else it holds the most that any batch took
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), data])

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """Ids of every text of a column, as binary; null is an empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if (pc.max(pc.binary_length(texts)).as_py() or 0) <= LONG:
            return self._encode(texts)
        parts = [[self._encode(pa.array([p], pa.string()))[0].as_py() for p in pieces(t)] for t in texts.to_pylist()]
        return pa.array(list(map(b"".join, parts)), pa.binary())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of a few texts, without the steps that a column needs."""
        split = [[p.replace("\n", " ").split(" ") for p in pieces(t or "")] for t in texts]
        words = list(set().union(*(piece for text in split for piece in text)))
        lookup = dict(zip(words, self._look_up(words))).__getitem__
        return [b"".join(b"".join(map(lookup, piece)) for piece in text) for text in split]


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in batches of about ``most`` bytes of text.

    A long text comes alone.
    """
    held, size, last = [], 0, 0

    def joined() -> Iterator[pa.RecordBatch]:
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held.clear()

    for batch in batches:
        start, sizes = 0, pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for at, n in enumerate(sizes):
            if size and (size + n > most or max(n, last) > LONG):
                held.append(batch.slice(start, at - start))
                yield from joined()
                start, size = at, 0
            size, last = size + max(n, 1), n
        held.append(batch.slice(start))
    yield from joined()
