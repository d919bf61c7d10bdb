"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are cut into pieces, the pieces are dealt into blocks of a bounded
number of tokens, and every block is partitioned into windows of nearly equal
sums. Blocks are independent, so a lost task only redoes its own block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.bpe import Encoder, Merges
from gleanwork.session import settle

PIECES = "row long, doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    grain: int = 128,
    end_id: int = 0,
) -> DataFrame:
    """Token pieces of every document: its ids and then ``end_id``.

    Whole windows of ``capacity`` tokens are cut first, the rest into pieces of
    at most ``grain`` tokens, which is what lets windows come out nearly equal.
    ``ids`` holds little-endian unsigned 32-bit ids. A null text is empty (one
    piece with ``end_id``), a null id stays null, repeated rows are documents
    of their own. Other columns are ignored.
    """
    merges = Merges(tokenizer)
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("doc_tokens", pa.int64()),
            ("ids", pa.binary()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(merges)
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            names = batch["row"].to_pylist(), batch["doc_id"].to_pylist()
            texts = (t.as_py() for t in batch["text"])
            for row, doc, ids in zip(*names, encoder.encode(texts)):
                ids = np.concatenate([ids.astype("<u4"), end])
                n = len(ids)
                whole = n - n % capacity
                bounds = [*range(0, whole, capacity), *range(whole, n, grain), n]
                for a, b in zip(bounds, bounds[1:]):
                    rows.append((row, doc, a, b - a, n, ids[a:b].tobytes()))
                held += n
                if held > 2_000_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )

    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
    ).mapInArrow(cut, PIECES)


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """Window of each item by multiway differencing.

    A partial partition keeps the sums of its non-empty windows in descending
    order. The two partitions with the largest differences are merged again
    and again, the largest sums of one with the smallest of the other.
    """
    n = len(lengths)
    left, right = [-1] * n, [-1] * n  # merged windows form binary trees over the items
    parts = [(np.array([v], np.int64), [i]) for i, v in enumerate(lengths.tolist())]
    heap = [(-int(v) if windows > 1 else 0, i) for i, v in enumerate(lengths.tolist())]
    heapq.heapify(heap)
    while len(heap) > 1:
        a_sums, a_trees = parts[heapq.heappop(heap)[1]]
        b_sums, b_trees = parts[heapq.heappop(heap)[1]]
        free = windows - len(a_sums)
        # b's largest sums go to a's empty windows, the rest onto a's smallest.
        over = max(0, len(b_sums) - free)
        kept = len(b_sums) - over
        sums = np.concatenate([a_sums, b_sums[:kept]])
        trees = [*a_trees, *b_trees[:kept]]
        for j in range(over):
            to = len(a_sums) - 1 - j
            sums[to] += b_sums[kept + j]
            left.append(trees[to])
            right.append(b_trees[kept + j])
            trees[to] = len(left) - 1
        order = np.argsort(-sums, kind="stable")
        sums, trees = sums[order], [trees[i] for i in order.tolist()]
        low = int(sums[-1]) if len(sums) == windows else 0
        parts.append((sums, trees))
        heapq.heappush(heap, (low - int(sums[0]), len(parts) - 1))
    window = np.zeros(n, np.int64)
    for w, tree in enumerate(parts[heap[0][1]][1]):
        stack = [tree]
        while stack:
            node = stack.pop()
            if left[node] < 0:
                window[node] = w
            else:
                stack += [left[node], right[node]]
    return window


def pack_block(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item, no window above ``capacity``.

    The smallest number of windows is tried first and rises by one whenever a
    window exceeds the capacity. Items that fill a window stand alone.
    """
    full = lengths >= capacity
    window = np.zeros(len(lengths), np.int64)
    window[full] = np.arange(int(full.sum()))
    rest = np.flatnonzero(~full)
    if len(rest):
        sizes = lengths[rest]
        count = math.ceil(int(sizes.sum()) / capacity)
        while True:
            found = differencing(sizes, count)
            if np.bincount(found, sizes).max() <= capacity:
                break
            count += 1
        window[rest] = found + int(full.sum())
    return window


def pack(pieces: DataFrame, capacity: int = 1024, block_windows: int = 128) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with a ``length`` in
    1..``capacity``; all other columns are kept.

    A block holds about ``block_windows`` windows, so its rows are bounded by
    its tokens. Pieces are dealt to blocks by their number in the written
    table: equal rows spread out, and redone tasks deal alike. An empty table
    gives no rows. The input must not have the two new columns.
    """
    held = settle(pieces.withColumn("_piece", F.monotonically_increasing_id()))
    tokens = held.agg(F.sum("length").alias("n")).first()["n"] or 0
    blocks = max(1, round(tokens / (capacity * block_windows)))
    fields = [f for f in held.schema.fields if f.name != "_piece"]
    kept = [f.name for f in fields]
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)]
        + ["sequence_id long", "offset long"]
    )

    def place(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("_piece", "ascending")])
        lengths = rows["length"].to_numpy().astype(np.int64)
        window = pack_block(lengths, capacity)
        order = np.argsort(window, kind="stable")
        ends = np.cumsum(lengths[order])
        starts = ends - lengths[order]
        first = np.concatenate([[True], np.diff(window[order]) != 0])
        base = np.maximum.accumulate(np.where(first, starts, 0))
        out = rows.take(pa.array(order)).select(kept)
        sequence = (int(key[0].as_py()) << 32) + window[order]
        return out.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(starts - base)
        )

    return (
        held.withColumn("_block", F.pmod(F.xxhash64("_piece"), F.lit(blocks)))
        .groupBy("_block")
        .applyInArrow(place, schema)
    )
