"""Repeated passages by seed and extend over winnowed anchors.

A window is ``span`` consecutive words. The anchor of a window is its run of
``seed`` words with the smallest hash, so equal windows have equal anchors.
Documents meet on anchors; only around anchors that several documents share
are the matches extended, both ways, to whole windows, and touching windows
form the maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.chunks import (
    PARCEL,
    WordHashes,
    by_shard,
    chunked,
    grouped,
    mixed,
    opened,
    packed,
    parcels,
    release,
    shard_count,
    unpacked,
)
from gleanwork.session import settle

_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)  # odd multipliers, any would do
_LAST = np.iinfo(np.int64).max


def runs(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = np.uint64(base)
    for j in range(size):
        total = total * factor + hashes[j : j + n]
    return mixed(total)


class Names(NamedTuple):
    """Columns of the input."""

    id: str
    text: str


class Chunk:
    """The documents of a chunk as one array of word hashes."""

    def __init__(self, data: bytes, names: Names, span: int, seed: int, hashes: WordHashes):
        self.docs = opened(data)
        self.texts = pa.compute.struct_field(self.docs, names.text)
        ids = pa.compute.struct_field(self.docs, names.id).cast(pa.int64())
        # Null ids come after all others.
        self.ids = ids.fill_null(_LAST).to_numpy()
        # Words are many small objects: those of one document at a time.
        parts = [hashes(w) for w in self.words()]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        self.begins = np.cumsum(counts) - counts
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *parts])
        self.owner = np.repeat(np.arange(len(counts)), counts)
        # Windows that stay within one document, and the anchor of each.
        n = max(0, len(self.hashes) - span + 1)
        self.starts = np.flatnonzero(self.owner[:n] == self.owner[span - 1 :][:n])
        seeds = runs(self.hashes, seed, _BASES[0])
        width = span - seed + 1
        if len(self.starts):
            best, at = seeds[: n].copy(), np.zeros(n, np.int64)
            for j in range(1, width):
                lower = seeds[j : j + n] < best
                best[lower] = seeds[j : j + n][lower]
                at[lower] = j
            self.anchor = best[self.starts]
        else:
            self.anchor = np.zeros(0, np.uint64)
        self.window_owner = self.owner[self.starts]
        self.span = span

    def words(self) -> Iterator[list[bytes]]:
        """The words of each document."""
        return ((t.as_py() or "").encode().split() for t in self.texts)

    def questions(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, and whether two documents of the chunk hold them."""
        order = np.lexsort((self.window_owner, self.anchor))
        anchor, owner = self.anchor[order], self.ids[self.window_owner[order]]
        first = np.ones(len(anchor), bool)
        first[1:] = anchor[1:] != anchor[:-1]
        group = np.cumsum(first) - 1
        many = np.zeros(int(first.sum()), bool)
        differs = ~first
        differs[1:] &= owner[1:] != owner[:-1]
        many[group[differs]] = True
        return anchor[first], many

    def windows(self, repeated: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows whose anchor is in ``repeated`` (sorted): their index, and
        two independent hashes of all their words."""
        if not len(repeated):
            empty = np.zeros(0, np.uint64)
            return np.zeros(0, np.int64), empty, empty
        at = np.minimum(np.searchsorted(repeated, self.anchor), len(repeated) - 1)
        chosen = np.flatnonzero(repeated[at] == self.anchor)
        start = self.starts[chosen]
        one, two = (runs(self.hashes, self.span, b)[start] for b in _BASES)
        return chosen, one, two >> np.uint64(32)  # 96 bits in all


def _sent(chunk: int, shards: int, keys: np.ndarray, *more: np.ndarray) -> list[tuple]:
    order, bounds = by_shard(keys, shards)
    found = []
    for s in range(shards):
        at = order[bounds[s] : bounds[s + 1]]
        if len(at):
            found.append((chunk, s, packed(keys[at], *(m[at] for m in more))))
    return found


def _answers(rows: pa.Table) -> dict[int, bytes]:
    return dict(zip(rows["part"].to_pylist(), rows["data"].to_pylist()))


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = 13,
    seed: int = 5,
) -> DataFrame:
    """``<row, n_words, spans, kept_text>`` per document.

    ``spans`` are the maximal runs ``[first, end)`` of words covered by windows
    that also start in a document with a smaller id; ``kept_text`` are the
    other words, joined by one space. Words are separated by ASCII blanks.
    Windows are judged on the input. Documents with equal ids do not count
    against each other; a null id is larger than all ids. A null text has no
    words. Repeated rows appear each, empty tables give no rows, other columns
    stay inside the struct ``row``.
    """
    names = Names(id_col, text_col)
    packed_docs = settle(chunked(docs, text_col))
    shards = shard_count(packed_docs.count())
    found = T.StructType(
        [
            T.StructField("row", docs.schema),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept_text", T.StringType()),
        ]
    )

    def ask(batches):
        hashes = WordHashes()
        for batch in batches:
            for number, data in zip(batch["chunk"].to_pylist(), batch["data"]):
                chunk = Chunk(data.as_py(), names, span, seed, hashes)
                anchors, many = chunk.questions()
                yield from parcels(_sent(number, shards, anchors, many)).to_batches()

    def join_on_anchors(rows: pa.Table) -> pa.Table:
        """For every chunk, which of its anchors several documents share."""
        held = [unpacked(d) for d in rows["data"].to_pylist()]
        keys = np.concatenate([k for k, _ in held])
        many = np.concatenate([m for _, m in held])
        distinct, of = np.unique(keys, return_inverse=True)
        weight = np.bincount(of, 1 + many.astype(np.int64), len(distinct))
        shared = weight > 1
        answers, at = [], 0
        for chunk, part, (own, _) in zip(
            rows["chunk"].to_pylist(), rows["part"].to_pylist(), held
        ):
            mine = shared[of[at : at + len(own)]]
            at += len(own)
            if mine.any():
                answers.append((chunk, part, packed(own[mine])))
        return parcels(answers)

    def least_of(chunk: Chunk, answers: dict[int, bytes]):
        """Windows around shared anchors: index, hashes, least id of the chunk."""
        shared = [unpacked(d)[0] for d in answers.values()]
        repeated = np.sort(np.concatenate([np.zeros(0, np.uint64), *shared]))
        chosen, one, two = chunk.windows(repeated)
        order = np.lexsort((two, one))
        first = np.ones(len(order), bool)
        first[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(first) - 1
        least = np.full(int(first.sum()), _LAST)
        np.minimum.at(least, group, chunk.ids[chunk.window_owner[chosen]])
        return chosen, group, one[order][first], two[order][first], least

    def extend(rows: pa.Table) -> pa.Table:
        """Ask for the least id of every window around a shared anchor."""
        answers = _answers(rows)
        number = rows["chunk"][0].as_py()
        chunk = Chunk(answers.pop(-1), names, span, seed, WordHashes())
        _, _, one, two, least = least_of(chunk, answers)
        return parcels(_sent(number, shards, one, two, least.view(np.uint64)))

    def join_on_windows(rows: pa.Table) -> pa.Table:
        """For every chunk, the windows that start in a document elsewhere
        with a smaller id than any of its own (as bits in the order of its
        question), and that id."""
        held = [unpacked(d) for d in rows["data"].to_pylist()]
        one, two, least = (np.concatenate([h[i] for h in held]) for i in range(3))
        least = least.view(np.int64)
        order = np.lexsort((two, one))
        first = np.ones(len(order), bool)
        first[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(first) - 1
        lowest = np.full(int(first.sum()), _LAST)
        np.minimum.at(lowest, group, least)
        below, lowest = lowest[group] < least, lowest[group]
        answers, at = [], 0
        for chunk, part, (own, _, _) in zip(
            rows["chunk"].to_pylist(), rows["part"].to_pylist(), held
        ):
            mine = below[at : at + len(own)]
            value = lowest[at : at + len(own)][mine].view(np.uint64)
            at += len(own)
            if len(value):
                # Parts below `shards` are the answers on anchors.
                answers.append((chunk, shards + part, packed(np.packbits(mine), value)))
        return parcels(answers)

    def cut(rows: pa.Table) -> pa.Table:
        answers = _answers(rows)
        chunk = Chunk(answers.pop(-1), names, span, seed, WordHashes())
        anchors = {p: d for p, d in answers.items() if p < shards}
        chosen, group, one, _, least = least_of(chunk, anchors)
        order, bounds = by_shard(one, shards)
        for part, data in answers.items():
            if part >= shards:
                bits, value = unpacked(data)
                asked = order[bounds[part - shards] : bounds[part - shards + 1]]
                mine = np.unpackbits(bits.astype(np.uint8), count=len(asked)).astype(bool)
                least[asked[mine]] = value.view(np.int64)
        repeated = least[group] < chunk.ids[chunk.window_owner[chosen]]
        steps = np.zeros(len(chunk.hashes) + 1, np.int64)
        begin = chunk.starts[chosen[repeated]]
        np.add.at(steps, begin, 1)
        np.add.at(steps, begin + span, -1)
        covered = np.cumsum(steps[:-1]) > 0
        spans, kept, counts = [], [], []
        for words, begin in zip(chunk.words(), chunk.begins.tolist()):
            counts.append(len(words))
            hit = covered[begin : begin + len(words)]
            if hit.any():
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                spans.append(edges.reshape(-1, 2).tolist())
                kept.append(b" ".join([w for w, h in zip(words, hit.tolist()) if not h]).decode())
            else:
                spans.append([])
                kept.append(b" ".join(words).decode())
        return pa.table(
            {
                "row": chunk.docs,
                "n_words": pa.array(counts, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                "kept_text": pa.array(kept, pa.string()),
            }
        )

    questions = packed_docs.mapInArrow(ask, PARCEL)
    shared = release(settle(grouped(questions, "part", join_on_anchors)))
    asked = grouped(packed_docs.unionByName(shared), "chunk", extend)
    lower = release(settle(grouped(asked, "part", join_on_windows)))
    every = packed_docs.unionByName(shared).unionByName(lower)
    return every.groupBy("chunk").applyInArrow(cut, found)
