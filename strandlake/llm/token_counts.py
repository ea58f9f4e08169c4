"""Token counts that follow edits: a segment tree of pre-token runs for each document.

A text is cut into *leaves* of a few hundred characters, each cut before a
space that stands between two characters other than white space.  There a
pre-token of a byte-level BPE starts in any case, so the leaves' counts add up
to the text's.  A tree holds the sums of tokens and of characters.  An edit
finds its leaves by descending the character sums; a leaf border whose own
characters change, or stand next to the edit, is boundary context and joins
its two leaves.  Only those leaves are encoded again, and the sums above them
updated.

The trees are a table: a row for each document, with the leaves' texts and the
two heaps of sums.  ``build_trees`` encodes whole texts once; each
``apply_edits`` gives the next table and encodes only what the edits touch.

Cases: a null text is empty, its count is 0; repeated rows are documents of
their own; edits may insert, delete or replace, at either end too; positions
are code points of the text before the call.  An edit that ends before it
starts, that lies outside the text or has a null position, and one that
overlaps an edit before it in the order (start, end, replacement), is not
applied but counted in ``n_skipped``; inserts at one place are applied in that
order; a null replacement is empty.  A null doc_id gets edits of a null doc_id.
A text without a space is one leaf; an empty table gives no row; columns other
than the two named ones are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, kept, texts_of, tuned
from .pieces import PieceEncoder, encoder

LEAF = 256
Edit = tuple[int, int, str]


def leaves(text: str, size: int = LEAF) -> list[str]:
    """Cut where a pre-token starts in any case."""
    out, start = [], 0
    while True:
        p = text.find(" ", start + size)
        while p > 0 and p + 1 < len(text) and (text[p - 1].isspace() or text[p + 1].isspace()):
            p = text.find(" ", p + 1)
        if p <= 0 or p + 1 >= len(text):
            out.append(text[start:])
            return out
        out.append(text[start:p])
        start = p


class TokenTree:
    """Sums of tokens and characters over the leaves of one text."""

    def __init__(self, text: str, enc: PieceEncoder, size: int = LEAF, parts: list[str] | None = None, counts: list[int] | None = None) -> None:
        self.enc = enc
        self.parts = leaves(text, size) if parts is None else list(parts)
        n = 1 << max(0, (len(self.parts) - 1).bit_length())
        self.parts += [""] * (n - len(self.parts))
        self.n, self.encoded = n, 0
        counts = enc.counts(self.parts).tolist() if counts is None else counts + [0] * (n - len(counts))
        self.tokens, self.chars = [0] * n + counts, [0] * n + [len(p) for p in self.parts]
        for i in range(n - 1, 0, -1):
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @classmethod
    def of(cls, enc: PieceEncoder, parts: list[str], tokens: list[int], chars: list[int]) -> "TokenTree":
        """A tree as it was kept."""
        tree = cls.__new__(cls)
        tree.enc, tree.parts, tree.tokens, tree.chars, tree.n, tree.encoded = enc, list(parts), list(tokens), list(chars), len(parts), 0
        return tree

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def find(self, at: int) -> tuple[int, int]:
        """Leaf that holds the character ``at`` (the last one that has any, at the end), and where it starts."""
        i, start = 1, 0
        at = min(at, self.chars[1] - 1)
        while i < self.n:
            i *= 2
            if at - start >= self.chars[i] and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.n, start

    def _set(self, leaf: int, part: str, tokens: int) -> None:
        i = leaf + self.n
        self.parts[leaf], self.tokens[i], self.chars[i] = part, tokens, len(part)
        while i := i // 2:
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters [start, end) by ``new``."""
        if not 0 <= start <= end <= self.chars[1]:
            raise ValueError("an edit must lie inside the text")
        first, at = self.find(max(0, start - 2))  # two before: a cut looks at the character before its space
        last, _ = self.find(end + 1)
        region = "".join(self.parts[first : last + 1])
        region = region[: start - at] + new + region[end - at :]
        self.encoded += len(region)
        self._set(first, region, int(self.enc.counts([region])[0]))
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", 0)


TREE_SCHEMA = "doc_id long, parts array<string>, tokens array<int>, chars array<int>, n_edits long, n_skipped long, n_chars_encoded long, n_tokens_before long, n_chars_before long"
_KINDS = [pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.int64()] * 5]
_NAMES = [x.split()[0] for x in TREE_SCHEMA.split(", ")]


def _tree_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def build_trees(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The trees of all documents, as a table in the shared folder."""
    tuned(docs.sparkSession)

    def run(it) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches(it, caches=True):
            cut = [leaves(t) for t in texts_of(batch)]
            counts, at, rows = enc.counts([p for c in cut for p in c]).tolist(), 0, []
            for doc, parts in zip(column(batch, "doc_id"), cut):
                tree = TokenTree("", enc, parts=parts, counts=counts[at : at + len(parts)])
                at += len(parts)
                rows.append((doc, tree.parts, tree.tokens, tree.chars, 0, 0, 0, tree.total, tree.chars[1]))
            yield _tree_rows(rows)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return kept(rows.mapInArrow(run, TREE_SCHEMA), "token-trees")


def valid(edits: list[Edit], n_chars: int) -> list[Edit]:
    """The edits that are applied, from the front."""
    out, end = [], 0
    for a, b, new in sorted((e for e in edits if e[0] is not None and e[1] is not None), key=lambda e: (e[0], e[1], e[2] or "")):
        if 0 <= a <= b <= n_chars and a >= end:
            out.append((a, b, new or ""))
            end = b
    return out


def apply_edits(trees: DataFrame, tokenizer: str, rule: Callable[[str], list[Edit]] | None = None, edits: DataFrame | None = None) -> DataFrame:
    """The trees after the edits, with n_edits, n_skipped, n_chars_encoded (characters encoded again) and the sums before this call.

    Edits come from ``rule`` (text to its edits) or from the table ``edits``
    (doc_id, start, end, replacement); they go to every row with their doc_id.
    """
    rows, listed = trees, edits is not None
    if listed:
        of = edits.groupBy(F.col("doc_id").cast("long").alias("e_id"))
        of = of.agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("replacement").cast("string").alias("replacement"))).alias("edits"))
        rows = rows.join(of, rows.doc_id.eqNullSafe(of.e_id), "left").drop("e_id")

    def run(it) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches(it, caches=True):
            cols = [column(batch, n) for n in _NAMES[:4]]
            given = column(batch, "edits") if listed else [None] * batch.num_rows
            rows = []
            for doc, parts, tokens, chars, found in zip(*cols, given):
                if listed:
                    asked = [(e["start"], e["end"], e["replacement"]) for e in found or []]
                else:
                    asked = rule("".join(parts)) if rule else []
                todo, encoded, before = valid(asked, chars[1]), 0, (tokens[1], chars[1])
                if todo:
                    tree = TokenTree.of(enc, parts, tokens, chars)
                    for start, end, new in reversed(todo):  # from the back: positions in front stay
                        tree.edit(start, end, new)
                    parts, tokens, chars, encoded = tree.parts, tree.tokens, tree.chars, tree.encoded
                rows.append((doc, parts, tokens, chars, len(todo), len(asked) - len(todo), encoded, *before))
            yield _tree_rows(rows)

    tuned(trees.sparkSession)
    return rows.mapInArrow(run, TREE_SCHEMA)


def edited_counts(docs: DataFrame, tokenizer: str, rule: Callable[[str], list[Edit]] | None = None, edits: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_edits, n_skipped, n_tokens_edited, n_chars, n_chars_encoded: trees are built, kept, and edited once."""
    after = apply_edits(build_trees(docs, tokenizer, id_col, text_col), tokenizer, rule, edits)
    of = lambda name: F.element_at(name, 2).cast("long")  # noqa: E731  (the root of a heap)
    return after.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", "n_skipped", of("tokens").alias("n_tokens_edited"), F.col("n_chars_before").alias("n_chars"), "n_chars_encoded")
