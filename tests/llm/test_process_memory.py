"""What tasks keep in a Python process that Spark hands on to later tasks."""

from __future__ import annotations

import sys
import tracemalloc

import pyarrow as pa
import pytest

from deskmill.llm import near_dedup
from deskmill.llm.common import process_memory
from deskmill.llm.tokens import Encoder, tokenizer_text


class Rows:
    """Stands for a DataFrame and gives the function that its tasks run."""

    def select(self, *columns):
        return self

    join = distinct = select

    def mapInArrow(self, task, schema):  # noqa: N802
        return task


def holds_a_tokenizer() -> bool:
    spaces = [x for name, x in sys.modules.items() if name.startswith("_deskmill")]
    return any(hasattr(x, "tokenizer") or hasattr(getattr(x, "memory", None), "tokenizer") for x in spaces)


@pytest.mark.parametrize("step", ["sketch", "full sets"])
def test_near_dedup_frees_the_words_of_packing(spark, step):
    Encoder(tokenizer_text()).encode_column(pa.array(["some words of a text"]))
    assert holds_a_tokenizer()
    task = near_dedup._sketches(Rows(), 40, 5) if step == "sketch" else near_dedup._full_sets(Rows(), Rows())
    list(task(iter([])))
    assert not holds_a_tokenizer()


def test_an_owner_keeps_its_memory_until_another_comes():
    process_memory("a").words = 1
    assert process_memory("a").words == 1
    process_memory("b")
    assert not hasattr(process_memory("a"), "words")


def test_words_take_few_bytes():
    encoder, n = Encoder(tokenizer_text()), 50_000
    encoder.encode_column(pa.array(["word and marks"]))
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    encoder.encode_column(pa.array([" ".join(f"word{i:x}" for i in range(n))]))
    taken = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert len(encoder.memory.words) >= n and taken < 60 * n
