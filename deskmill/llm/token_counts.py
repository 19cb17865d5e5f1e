"""Token counts that follow edits without encoding the document again.

A document is held as a segment tree: leaves are runs of whole words, inner nodes have the
characters and tokens below them. An edit goes down the tree by characters to the leaves
it touches; those, with the words at their edges, are encoded again, and the sums above
are updated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from deskmill.llm.common import table
from deskmill.llm.tokens import Encoder, tokenizer_text

LEAF = 256  # characters of a leaf, about; a longer word makes a longer leaf
EDITS = 4


def runs(text: str, size: int = LEAF) -> list[str]:
    """``text`` cut before spaces or line ends; joined again it is the text."""
    found, start = [], 0
    while len(text) - start > size:
        cuts = [x for x in (text.find(" ", start + size), text.find("\n", start + size)) if x >= 0]
        if not cuts:
            break
        found.append(text[start : min(cuts)])
        start = min(cuts)
    return [*found, text[start:]]


class TokenTree:
    """Token count of one text under edits."""

    def __init__(self, text: str, encoder: Encoder) -> None:
        self.encoder = encoder
        self.encoded = 0  # characters encoded, at first and again
        self._plant(runs(text))

    def _count(self, texts: Sequence[str]) -> list[int]:
        self.encoded += sum(map(len, texts))
        return [len(x) // 4 for x in self.encoder.encode(list(texts))]

    def _plant(self, leaves: list[str], counts: list[int] | None = None) -> None:
        self.width = 1 << (len(leaves) - 1).bit_length()
        self.leaves = leaves + [""] * (self.width - len(leaves))
        counts = self._count(leaves) if counts is None else counts
        empty = [0] * (self.width - len(leaves))
        self.chars = [0] * self.width + [len(x) for x in leaves] + empty
        self.tokens = [0] * self.width + counts + empty
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, position: int) -> tuple[int, int]:
        """Leaf and place in it of a character position (the end counts as the last)."""
        i = 1
        while i < self.width:
            i *= 2
            if position >= self.chars[i] and self.chars[i + 1]:
                position -= self.chars[i]
                i += 1
        return i - self.width, position

    def _set(self, leaf: int, text: str, count: int) -> None:
        i = leaf + self.width
        self.leaves[leaf], self.chars[i], self.tokens[i] = text, len(text), count
        while i > 1:
            i //= 2
            self._sum(i)

    def edit(self, start: int, removed: int, added: str) -> None:
        """Replace ``removed`` characters from ``start`` by ``added``; both are clipped."""
        size = self.chars[1]
        start = min(max(start, 0), size)
        removed = min(max(removed, 0), size - start)
        first, at = self._find(start)
        last, end = self._find(start + removed) if removed else (first, at)
        changed = self.leaves[first][:at] + added + self.leaves[last][end:]
        # A leaf must begin with a blank or be the first: else its word goes on in the one before.
        while first and changed and changed[0] not in " \n":
            first -= 1
            changed = self.leaves[first] + changed
        after = last + 1
        while after < self.width and (not self.leaves[after] or self.leaves[after][0] not in " \n"):
            changed += self.leaves[after]
            last, after = after, after + 1
        new = runs(changed)
        room = last - first + 1
        if len(new) <= room:
            counts = self._count(new)
            for k in range(room):
                self._set(first + k, new[k] if k < len(new) else "", counts[k] if k < len(new) else 0)
            return
        # Too many leaves for the place: the tree is laid out anew, counts of the rest stay.
        counts = self.tokens[self.width :]
        kept = [(t, c) for t, c in zip(self.leaves[:first], counts[:first]) if t]
        rest = [(t, c) for t, c in zip(self.leaves[last + 1 :], counts[last + 1 :]) if t]
        merged = [*kept, *zip(new, self._count(new)), *rest]
        self._plant([t for t, _ in merged], [c for _, c in merged])


def count_edits(docs: DataFrame, edits: str = "edits", tokenizer: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, ``edits``): doc_id, n_edits, tokens_before, tokens
    (after each edit), tokens_after, chars_after, chars_encoded (by the edits alone).

    ``edits`` is an array of (start, removed, added), applied one after the other; positions
    are characters and are clipped to the text. Defined cases: a null text is empty; null
    edits, or null parts of an edit, change nothing; rows are counted each by its own text,
    also with null or repeated ids; no rows give no rows.
    """
    shown = docs.sparkSession.sparkContext.broadcast(tokenizer_text(tokenizer))
    result = pa.schema(
        [("doc_id", pa.int64()), ("n_edits", pa.int32()), ("tokens_before", pa.int64()), ("tokens", pa.list_(pa.int64())),
         ("tokens_after", pa.int64()), ("chars_after", pa.int64()), ("chars_encoded", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shown.value)
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            for doc, text, changes in zip(batch.column("doc_id").to_pylist(), texts, batch.column("edits").to_pylist()):
                tree = TokenTree(text or "", encoder)
                before, built, after = tree.total, tree.encoded, []
                for change in changes or []:
                    if change and None not in change.values():
                        tree.edit(change["start"], change["removed"], change["added"])
                    after.append(tree.total)
                rows.append((doc, len(after), before, after, tree.total, tree.chars[1], tree.encoded - built))
            columns = list(zip(*rows)) or [[] for _ in result]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, result)], schema=result)

    return docs.select("doc_id", "text", F.col(edits).alias("edits")).mapInArrow(
        count,
        "doc_id bigint, n_edits int, tokens_before bigint, tokens array<bigint>, tokens_after bigint, "
        "chars_after bigint, chars_encoded bigint",
    )


def revision(text: Column, n: int = EDITS) -> Column:
    """``n`` edits drawn from hashes of the text: a passage of it is put in at one place and
    another one is taken out there, as a revision of the document would."""
    length = F.coalesce(F.length(text), F.lit(0)).cast("bigint")

    def draw(k: int, part: int, below: Column) -> Column:
        return F.pmod(F.xxhash64(text, F.lit(10 * k + part)), F.greatest(below, F.lit(1)))

    edits = [
        F.struct(
            draw(k, 1, length + 1).alias("start"),
            draw(k, 2, F.lit(40)).alias("removed"),
            F.coalesce(F.substr(text, (draw(k, 3, length) + 1).cast("int"), draw(k, 4, F.lit(60)).cast("int")), F.lit("")).alias("added"),
        )
        for k in range(n)
    ]
    return F.array(*edits)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document before and after a revision of four edits."""
    docs = table(spark, folder, "documents", "doc_id", "text").withColumn("edits", revision(F.col("text")))
    return count_edits(docs)


QUERIES = {"op1_token_counts": op1_token_counts}
