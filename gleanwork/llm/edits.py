"""Token counts that follow edits, from segment trees over pre-tokens.

The leaves of a document's tree are runs of pre-tokens; every node holds the
characters and tokens below it. An edit re-encodes only the leaves it touches
and what lies within the reach of the pre-token rules, until a boundary of the
new pre-tokens meets an old leaf boundary again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.bpe import Encoder, Merges, Splitter

#: Pre-tokens in a leaf.
LEAF = 32

#: A pre-token depends on at most two characters after it (a blank run looks at
#: the next one, a contraction at two), or on a special token that follows.
REACH = 16

#: What the production query redacts: mail addresses, long numbers, symbol runs.
PERSONAL = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|[0-9]{4,}|([#*$%&|<>!])\1{2,}"


class SegmentTree:
    """Sums of characters and tokens over leaves, as two heaps: node 1 is the
    root, the children of node i are 2i and 2i + 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def build(cls, chars: np.ndarray, tokens: np.ndarray) -> SegmentTree:
        """From the characters and tokens of all pre-tokens."""
        heaps = []
        for values in (chars, tokens):
            at = np.arange(0, len(values), LEAF)
            leaves = np.add.reduceat(values, at) if len(at) else np.zeros(1, np.int64)
            width = 1 << (len(leaves) - 1).bit_length()
            levels = [np.concatenate([leaves, np.zeros(width - len(leaves), np.int64)])]
            while len(levels[-1]) > 1:
                levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
            heaps.append(np.concatenate([np.zeros(1, np.int64), *levels[::-1]]))
        return cls(*heaps)

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one, if it is beyond the
        end), and the first character of that leaf."""
        position = max(0, min(position, int(self.chars[1]) - 1))
        node, start = 1, 0
        while node < self.width:
            left = int(self.chars[2 * node])
            if position - start < left or left == int(self.chars[node]):
                node = 2 * node
            else:
                node, start = 2 * node + 1, start + left
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Set a leaf and update the sums above it."""
        node = leaf + self.width
        more, count = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more
            self.tokens[node] += count
            node //= 2


def edited(text: str, edits: list[tuple[int, int, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text after all edits, and the edits that were made: clipped to the
    text, in order; of two that overlap, the earlier one."""
    made, parts, end = [], [], 0
    for start, stop, new in sorted(edits, key=lambda e: e[:2]):
        start, stop = max(0, min(start, len(text))), max(0, min(stop, len(text)))
        if start < end or stop < start:
            continue
        parts += [text[end:start], new]
        made.append((start, stop, new))
        end = stop
    return "".join([*parts, text[end:]]), made


def touched(
    tree: SegmentTree, new: str, edits: list[tuple[int, int, str]], split: Splitter
) -> Iterator[tuple[int, int, list[str]]]:
    """(first leaf, last leaf, new pre-tokens) of every region to re-encode.

    ``tree`` is the one before the edits, ``edits`` are in its positions.
    """
    size = int(tree.chars[1])
    at, shift = 0, 0
    while at < len(edits):
        first, begin = tree.find(edits[at][0] - REACH)
        begin_new = begin + shift
        last, stop, upto = first, begin, at
        while True:
            # Take in every edit that could change pre-tokens before the stop.
            while upto < len(edits) and (upto == at or edits[upto][0] - REACH < stop):
                start, end, put = edits[upto]
                shift += len(put) - (end - start)
                last, leaf_start = tree.find(end)
                stop = max(stop, leaf_start + int(tree.chars[tree.width + last]))
                upto += 1
            if stop >= size:
                yield first, tree.width - 1, split(new[begin_new:])
                break
            length = stop + shift - begin_new
            pieces = split(new[begin_new : begin_new + length + 4 * REACH])
            ends = np.cumsum([len(p) for p in pieces])
            cut = int(np.searchsorted(ends, length))
            if cut < len(ends) and ends[cut] == length:
                yield first, last, pieces[: cut + 1]
                break
            last, leaf_start = tree.find(stop)
            stop = leaf_start + int(tree.chars[tree.width + last])
        at = upto


def build_trees(
    docs: DataFrame, tokenizer: str, text_col: str = "text"
) -> DataFrame:
    """``<row, tree_chars, tree_tokens, n_tokens>``: the tree of every document.

    A null text is empty: one leaf of no characters. Repeated rows have trees
    of their own, other columns stay inside the struct ``row``, empty tables
    give no rows.
    """
    merges = Merges(tokenizer)
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges)
        for batch in batches:
            trees = [
                SegmentTree.build(c, t)
                for c, t in encoder.count(x.as_py() for x in batch["text"])
            ]
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch["row"],
                    "tree_chars": pa.array([t.chars for t in trees], numbers),
                    "tree_tokens": pa.array([t.tokens for t in trees], numbers),
                    "n_tokens": pa.array([int(t.tokens[1]) for t in trees], pa.int64()),
                }
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        build, f"row {kind}, tree_chars array<long>, tree_tokens array<long>, n_tokens long"
    )


def redactions(pattern: str = PERSONAL, replacement: str = "[REDACTED]"):
    """Edits of a text: every match of ``pattern`` becomes ``replacement``."""

    def find(text: str) -> list[tuple[int, int, str]]:
        return [(*m.span(), replacement) for m in re.finditer(pattern, text)]

    return find


def edit_counts(trees: DataFrame, tokenizer: str, edits, text_col: str = "text") -> DataFrame:
    """``<row, text, tree_chars, tree_tokens, n_tokens, n_edits, n_reencoded>``
    after the edits that ``edits(text)`` lists as (start, end, new text).

    ``text`` is the edited text, the trees and ``n_tokens`` are its own, and
    ``n_reencoded`` counts the pre-tokens that had to be encoded again. Edits
    are clipped to the text; of two that overlap, the earlier one is made.
    """
    merges = Merges(tokenizer)
    rows = trees.select("row", F.col(f"row.`{text_col}`").alias("text"), "tree_chars", "tree_tokens")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges)
        for batch in batches:
            texts, kept, regions, owners = [], [], [], []
            heaps = zip(batch["text"], batch["tree_chars"], batch["tree_tokens"])
            for i, (text, chars, tokens) in enumerate(heaps):
                text = text.as_py() or ""
                tree = SegmentTree(
                    chars.values.to_numpy().astype(np.int64),
                    tokens.values.to_numpy().astype(np.int64),
                )
                new, made = edited(text, edits(text))
                texts.append(new)
                kept.append((tree, len(made)))
                for region in touched(tree, new, made, encoder.split):
                    owners.append((i, region[0], region[1]))
                    regions.append(region[2])
            again = [0] * len(texts)
            for (i, first, last), pieces, (chars, tokens) in zip(
                owners, regions, encoder.count_pieces(regions)
            ):
                tree = kept[i][0]
                tree.put(first, int(chars.sum()), int(tokens.sum()))
                for leaf in range(first + 1, last + 1):
                    if tree.chars[tree.width + leaf]:
                        tree.put(leaf, 0, 0)
                again[i] += len(pieces)
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "row": batch["row"],
                    "text": pa.array(texts, pa.string()),
                    "tree_chars": pa.array([t.chars for t, _ in kept], numbers),
                    "tree_tokens": pa.array([t.tokens for t, _ in kept], numbers),
                    "n_tokens": pa.array([int(t.tokens[1]) for t, _ in kept], pa.int64()),
                    "n_edits": pa.array([n for _, n in kept], pa.int64()),
                    "n_reencoded": pa.array(again, pa.int64()),
                }
            )

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(
        apply,
        f"row {kind}, text string, tree_chars array<long>, tree_tokens array<long>, "
        "n_tokens long, n_edits long, n_reencoded long",
    )
