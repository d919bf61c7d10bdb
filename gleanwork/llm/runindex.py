"""Repeated byte strings by a run-length index.

A window is ``span`` consecutive bytes of one document. Its anchor is the run
of ``seed`` bytes with the smallest hash, the first one on ties, so equal
windows have equal anchors at equal places. Consecutive windows with the same
anchor form a piece. Pieces whose anchor occurs once in the corpus repeat
nothing; the others meet in shards, dealt by their bytes around the anchor.

A shard sorts the suffixes of its distinct pieces, keeps the Burrows-Wheeler
transform as runs with a text position sampled at the end of each run, and
forgets the suffixes. Every piece is then streamed backwards over the runs.
Each step gives the row of the index that the piece stands on and with it the
interval of rows that match it for ``span`` bytes or more, so all windows of an
interval learn the earliest of them and the later ones are marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleanwork.llm.chunks import chunked, mixed, opened
from gleanwork.session import settle

_ODD = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max

#: Distinct pieces of one anchor above which its windows are dealt in parts.
HOT_PIECES = 1024

# Windows worked on at a time.
_AT_ONCE = 1 << 15

_ANCHORS = "chunk long, anchor long, n int"
_PIECES = "key long, chunk long, place long, doc long, start long, piece binary"
_SPANS = "chunk long, first long, last long"


def _batch(ddl: str, columns: list) -> pa.RecordBatch:
    names = [c.split()[0] for c in ddl.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _blocks(ddl: str, columns: list, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(columns[0]), rows):
        yield _batch(ddl, [c[a : a + rows] for c in columns])


def _least_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _seeds(raw: np.ndarray, seed: int) -> np.ndarray:
    """Hash of every run of ``seed`` bytes, by doubling."""
    hashes, reach = raw.astype(np.uint64) + np.uint64(1), 1
    while 2 * reach <= seed:
        hashes = hashes[:-reach] * np.uint64(_ODD + 2 * reach) + hashes[reach:]
        reach *= 2
    rest = seed - reach
    if rest:
        hashes = hashes[: len(hashes) - rest] * np.uint64(_ODD) + hashes[rest:]
    return mixed(mixed(hashes))


class Text(NamedTuple):
    """Columns of the input."""

    id: str
    text: str


class Chunk:
    """The bytes of a chunk's documents in a row, cut into pieces."""

    def __init__(self, data: bytes, names: Text, span: int, seed: int):
        self.docs = opened(data)
        texts = pa.compute.struct_field(self.docs, names.text).to_pylist()
        texts = [(t or "").encode() for t in texts]
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.begins = np.cumsum(self.sizes) - self.sizes
        ids = pa.compute.struct_field(self.docs, names.id).cast(pa.int64())
        # Null ids come after all others.
        self.ids = ids.fill_null(_LAST).to_numpy()
        self.data = b"".join(texts)
        self.span, self.seed = span, seed
        self.first = self.last = self.anchor = np.zeros(0, np.int64)
        self.owner = self.hashes = self.first
        self._cut()

    def _cut(self) -> None:
        """``first`` and ``last`` window of each piece, the place of its anchor."""
        raw = np.frombuffer(self.data, np.uint8)
        windows = len(raw) - self.span + 1
        if windows <= 0:
            return
        width = self.span - self.seed + 1
        low = np.uint64(0xFFFFFFFF)
        at = np.empty(windows, np.int64)
        for a in range(0, windows, _AT_ONCE):
            # A stretch whose arrays stay in the processor's cache.
            part = raw[a : min(a + _AT_ONCE, windows) + self.span - 1]
            keyed = _seeds(part, self.seed) & ~low
            keyed |= np.arange(a, a + len(keyed), dtype=np.uint64)
            least = _least_of_windows(keyed, width)
            at[a : a + len(least)] = least & low
        # Consecutive windows of a document with the same anchor; windows over
        # the end of a document are none.
        fresh = np.ones(windows + 1, bool)
        fresh[1:-1] = at[1:] != at[:-1]
        none = np.zeros(windows, bool)
        ends = self.begins + self.sizes
        firsts = np.maximum(ends - self.span + 1, self.begins)
        for first, end in zip(firsts.tolist(), ends.tolist()):
            none[first:end] = True
            if end <= windows:
                fresh[end] = True
            if first <= windows:
                fresh[first] = True
        edges = np.flatnonzero(fresh)
        kept = ~none[edges[:-1]]
        self.first, self.last = edges[:-1][kept], edges[1:][kept] - 1
        self.anchor = at[self.first]
        self.owner = np.searchsorted(ends, self.first, "right")
        self.hashes = np.zeros(len(self.first), np.int64)
        for a in range(0, len(raw), _AT_ONCE):  # anchors go on behind the last window
            i, j = np.searchsorted(self.anchor, [a, a + _AT_ONCE])
            if j > i:
                hashes = _seeds(raw[a : a + _AT_ONCE + self.seed - 1], self.seed)
                self.hashes[i:j] = hashes[self.anchor[i:j] - a].view(np.int64)

    def bytes_of(self, first: int, last: int) -> bytes:
        return self.data[first : last + self.span]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors and the number of their pieces, equal ones counted
        as two at most."""
        keys, counts = np.unique(self.hashes, return_counts=True)
        many = np.flatnonzero(np.isin(self.hashes, keys[counts > 1]))
        places = zip(*(v[many].tolist() for v in (self.hashes, self.first, self.last)))
        kinds = {(anchor, self.bytes_of(a, b)) for anchor, a, b in places}
        n = np.where(counts > 1, 0, 1)
        kept = np.array([anchor for anchor, _ in kinds], np.int64)
        np.add.at(n, np.searchsorted(keys, kept), 1)
        return keys, np.where((counts > 1) & (n < 2), 2, n)

    def asked(self, anchors: np.ndarray, counts: np.ndarray, hot: int):
        """Pieces around shared anchors (sorted), equal ones once: columns of
        the pieces to send, and the spans of the equal ones that follow them.

        An anchor with ``2 ** k`` times as many pieces as ``hot`` has the
        places of its windows dealt in ``2 ** k`` ranges, at most one each.
        All windows of a range share the bytes that name its shard.
        """
        found: tuple[list, ...] = ([], [], [], [], [])
        repeats: list[tuple[int, int]] = []
        if not len(anchors):
            return found, repeats
        at = np.minimum(np.searchsorted(anchors, self.hashes), len(anchors) - 1)
        chosen = np.flatnonzero(anchors[at] == self.hashes)
        width = self.span - self.seed + 1  # places of an anchor in its windows
        parts = np.clip(np.ceil(np.log2(np.maximum(counts / hot, 1))), 0, 20)
        seen: dict[tuple, tuple[int, int]] = {}
        # The first of equal pieces is the earliest: smallest id, then start.
        start = self.first - self.begins[self.owner]
        chosen = chosen[np.lexsort((start[chosen], self.ids[self.owner[chosen]]))]
        rows = zip(
            *(
                v.tolist()
                for v in (
                    self.first[chosen],
                    self.last[chosen],
                    self.anchor[chosen],
                    self.owner[chosen],
                    (2 ** parts[at[chosen]]).astype(np.int64),
                )
            )
        )
        ids, begins = self.ids.tolist(), self.begins.tolist()
        for first, last, anchor, owner, cut in rows:
            ranges = [(0, width)]
            if cut > 1:
                edges = sorted({width * i // cut for i in range(cut + 1)})
                ranges = list(zip(edges, edges[1:]))
            for low, high in ranges:
                # Windows whose anchor lies low ... high - 1 bytes after their start.
                a, b = max(first, anchor - high + 1), min(last, anchor - low)
                if a > b:
                    continue
                shared = self.data[anchor - low : anchor - high + 1 + self.span]
                piece = self.bytes_of(a, b)
                key = (low, high, anchor - a, piece)
                place = (ids[owner], a - begins[owner])
                if seen.setdefault(key, place) != place:
                    repeats.append((a, b + self.span))
                    continue
                name = xxhash.xxh64_intdigest(shared, low << 32 | high) >> 1
                columns = (name, a, *place, piece)
                for column, value in zip(found, columns):
                    column.append(value)
        return found, repeats


class RunIndex:
    """A run-length Burrows-Wheeler index of distinct pieces.

    Letters are bytes + 1; every piece ends in a 0, and the end of an earlier
    piece sorts first. ``heads`` and ``starts`` are the runs, ``targets`` the
    row that the first row of a run steps to, ``samples`` the text position of
    its last row. ``opens`` and ``closes`` bound the intervals of two or more
    rows that match for ``span`` letters.
    """

    def __init__(self, pieces: list[bytes], span: int):
        self.span = span
        self.sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # No UTF-8 text holds the byte 255, so letters fit into a byte.
        letters = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(1)
        self.ends = np.cumsum(self.sizes + 1) - 1
        self.letters = len(letters)
        rows, same = self._sorted(letters)
        before = letters[rows - 1]  # before the first piece stands the last end
        edge = np.ones(len(rows), bool)
        edge[1:] = before[1:] != before[:-1]
        self.starts = np.flatnonzero(edge)
        lengths = np.diff(np.append(self.starts, len(rows)))
        self.heads = before[self.starts]
        order = np.argsort(self.heads, kind="stable")
        self.targets = np.empty(len(order), np.int64)
        self.targets[order] = np.cumsum(lengths[order]) - lengths[order]
        self.samples = rows[self.starts + lengths - 1]
        border = np.flatnonzero(np.diff(np.concatenate([[0], same.astype(np.int8), [0]])))
        self.opens, self.closes = border[::2] - 1, border[1::2]

    def _sorted(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text positions in the order of their suffixes, and whether a row
        matches the row above for ``span`` letters inside its piece."""
        n = len(letters)
        left = np.repeat(self.ends, self.sizes + 1) - np.arange(n)
        # The first eight letters, nothing after an end.
        key = np.zeros(n + 8, np.uint64)
        key[:n] = letters
        for reach in (1, 2, 4):
            key[:-reach] = key[:-reach] << np.uint64(8 * reach) | key[reach:]
        cut = np.array([(1 << 64) - (1 << (64 - 8 * i)) for i in range(9)], np.uint64)
        key = key[:n] & cut[np.minimum(left, 8)]
        rows = np.argsort(key)
        rank = self._ranks(rows, key[rows][1:] != key[rows][:-1])
        matched = None
        reach, longest = 8, int(self.sizes.max(initial=0)) + 1
        at = np.arange(n)  # rows that may be equal to a neighbour
        while True:
            if matched is None and (2 * reach > self.span or reach >= longest):
                matched = rank.copy(), reach
            own = rank[rows[at]]
            tied = np.zeros(len(at), bool)
            tied[1:] = own[1:] == own[:-1]
            tied[:-1] |= tied[1:]
            at = at[tied]
            if reach >= longest or not len(at):
                break
            # Only suffixes that others equal so far: on by what follows.
            held = rows[at]
            second = np.where(
                left[held] >= reach, rank[np.minimum(held + reach, n - 1)] + 1, 0
            )
            both = rank[held] * (n + 1) + second
            order = np.argsort(both)
            rows[at], both = held[order], both[order]
            fresh = np.ones(len(at), bool)
            fresh[1:] = both[1:] != both[:-1]
            rank[rows[at]] = np.maximum.accumulate(np.where(fresh, at, 0))
            reach *= 2
        # Suffixes equal to their ends are in the order of the text.
        rows[at] = rows[at][np.argsort(rank[rows[at]] * (n + 1) + rows[at])]
        if matched is None:
            matched = rank, reach
        ranks, reach = matched
        shift = max(0, self.span - reach)
        full = left[rows] >= self.span
        one, two = ranks[rows], ranks[np.minimum(rows + shift, n - 1)]
        same = np.zeros(n, bool)
        same[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1]) & full[1:] & full[:-1]
        return rows, same

    @staticmethod
    def _ranks(rows: np.ndarray, differs: np.ndarray) -> np.ndarray:
        """Number of the first row of the group of equal ones, per position."""
        first = np.zeros(len(rows), np.int64)
        first[1:] = np.where(differs, np.arange(1, len(rows)), 0)
        rank = np.empty(len(rows), np.int64)
        rank[rows] = np.maximum.accumulate(first)
        return rank

    def matches(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stream all pieces backwards, side by side: ``(piece, place, interval)``
        of the windows that match another one."""
        row = np.arange(len(self.sizes))  # the suffix that is only an end
        piece, place = row.copy(), self.sizes.copy()
        while True:
            live = place > 0
            piece, row, place = piece[live], row[live], place[live] - 1
            if not len(piece):
                return
            run = np.searchsorted(self.starts, row, "right") - 1
            row = self.targets[run] + row - self.starts[run]
            # Rows with one letter before them keep their order, so sorting by
            # that letter sorts the rows.
            order = np.argsort(self.heads[run], kind="stable")
            piece, row, place = piece[order], row[order], place[order]
            within = np.searchsorted(self.opens, row, "right") - 1
            hit = within >= 0
            hit[hit] = row[hit] < self.closes[within[hit]]
            if hit.any():
                yield piece[hit], place[hit], within[hit]


def later_windows(
    pieces: list[bytes], docs: np.ndarray, starts: np.ndarray, span: int
) -> tuple[np.ndarray, np.ndarray]:
    """``(piece, place)`` of the windows of distinct pieces that an earlier
    window equals; earlier is a smaller document, then a smaller start."""
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index = RunIndex(pieces, span)
    _, number = np.unique(docs, return_inverse=True)
    found = list(index.matches())
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    piece, place, interval = (np.concatenate(c) for c in zip(*found))
    order = (number[piece].astype(np.int64) << 32) + starts[piece] + place
    least = np.full(len(index.opens), _LAST)
    np.minimum.at(least, interval, order)
    later = order > least[interval]
    return piece[later], place[later]


def _spans_of(piece: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of consecutive places: piece, first, last."""
    order = np.lexsort((place, piece))
    piece, place = piece[order], place[order]
    edge = np.ones(len(piece), bool)
    edge[1:] = (piece[1:] != piece[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(piece))[: len(first)] - 1
    return piece[first], place[first], place[last]


def repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = 100,
    seed: int = 16,
) -> DataFrame:
    """``<row, n_bytes, spans, kept>`` per document.

    ``spans`` are the maximal runs ``[first, end)`` of bytes covered by windows
    that also start earlier: in a document with a smaller id, or before in the
    same one. ``kept`` are the other bytes (binary: a cut may split a letter).
    Windows are judged on the input. Rows with equal ids count as one document
    whose windows are ordered by their start; equal starts do not count against
    each other. A null id is larger than all ids, a null text is empty,
    repeated rows appear each, an empty table gives no rows, other columns stay
    inside the struct ``row`` under any name. Ids are whole numbers.

    A key met by all chunks costs its shard an entry a chunk (4 MB of text).
    """
    if not 8 <= seed <= span:
        raise ValueError("seed has 8 bytes at least and span as many at most")
    names = Text(id_col, text_col)
    held = settle(chunked(docs, text_col))
    hot = HOT_PIECES

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch["chunk"].to_pylist(), batch["data"]):
                anchors, n = Chunk(data.as_py(), names, span, seed).anchors()
                yield from _blocks(_ANCHORS, [np.full(len(anchors), number), anchors, n])

    # Chunks are few against anchors, so no anchor fills a task.
    total = F.sum("n").over(Window.partitionBy("anchor"))
    shared = settle(
        held.mapInArrow(ask, _ANCHORS).withColumn("n", total).filter(F.col("n") > 1)
    )
    chunks = held.count()
    shards = max(64, 2 * chunks)

    def cut(key, left: pa.Table, right: pa.Table) -> pa.Table:
        number, found, spans = key[0].as_py(), ([], [], [], [], []), []
        anchors = right["anchor"].to_numpy()
        order = np.argsort(anchors)
        counts = right["n"].to_numpy()[order]
        for data in left["data"]:
            chunk = Chunk(data.as_py(), names, span, seed)
            found, spans = chunk.asked(anchors[order], counts, hot)
        name, place, doc, start, piece = found
        extra = len(spans)
        # Spans found inside the chunk travel along, with no piece.
        columns = [
            name + [-1] * extra,
            [number] * (len(name) + extra),
            place + [a for a, _ in spans],
            doc + [b for _, b in spans],
            start + [0] * extra,
            piece + [None] * extra,
        ]
        return pa.Table.from_batches([_batch(_PIECES, columns)])

    pieces = settle(
        held.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(cut, _PIECES)
    )
    within = pieces.filter("key < 0").select(
        "chunk", F.col("place").alias("first"), F.col("doc").alias("last")
    )
    dealt = pieces.filter("key >= 0").withColumn("shard", F.pmod("key", F.lit(shards)))

    def match(rows: pa.Table) -> pa.Table:
        chunk, place, doc, start = (
            rows[c].to_numpy() for c in ("chunk", "place", "doc", "start")
        )
        numbers: dict[bytes, int] = {}
        text = [numbers.setdefault(p, len(numbers)) for p in rows["piece"].to_pylist()]
        text = np.array(text, np.int64)
        sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
        # The earliest of equal pieces stands for them in the index.
        order = np.lexsort((start, doc, text))
        first = order[np.searchsorted(text[order], np.arange(len(numbers)))]
        # A piece that shares its key with no other has nothing to match.
        _, group, members = np.unique(
            rows["key"].to_numpy()[first], return_inverse=True, return_counts=True
        )
        met = np.flatnonzero(members[group] > 1)
        pieces = list(numbers)
        at, a = later_windows([pieces[i] for i in met.tolist()], doc[first[met]], start[first[met]], span)
        at, a, b = _spans_of(met[at], a)
        earliest = (doc == doc[first[text]]) & (start == start[first[text]])
        later = np.flatnonzero(~earliest)
        found = [(chunk[later], place[later], place[later] + sizes[text[later]])]
        # Rows that stand at the very place of the earliest share its spans.
        same = np.flatnonzero(earliest)
        same = same[np.argsort(text[same], kind="stable")]
        low = np.searchsorted(text[same], at)
        n = np.searchsorted(text[same], at, "right") - low
        span_of = np.repeat(np.arange(len(at)), n)
        row = same[np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        found.append((chunk[row], place[row] + a[span_of], place[row] + b[span_of] + span))
        return pa.Table.from_batches([_batch(_SPANS, [np.concatenate(c) for c in zip(*found)])])

    marks = settle(within.unionByName(dealt.groupBy("shard").applyInArrow(match, _SPANS)))

    def mend(key, left: pa.Table, right: pa.Table) -> pa.Table:
        tables = []
        for data in left["data"]:
            rows = opened(data.as_py())
            texts = pa.compute.struct_field(rows, names.text).to_pylist()
            texts = [(t or "").encode() for t in texts]
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            steps = np.zeros(int(sizes.sum()) + 1, np.int32)
            np.add.at(steps, right["first"].to_numpy(), 1)
            np.add.at(steps, right["last"].to_numpy(), -1)
            covered = np.cumsum(steps[:-1]) > 0
            spans, kept, begin = [], [], 0
            for text, size in zip(texts, sizes.tolist()):
                hit = covered[begin : begin + size]
                begin += size
                if hit.any():
                    turn = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                    spans.append(np.flatnonzero(turn).reshape(-1, 2).tolist())
                    kept.append(np.frombuffer(text, np.uint8)[~hit].tobytes())
                else:
                    spans.append([])
                    kept.append(text)
            tables.append(
                pa.table(
                    {
                        "row": rows,
                        "n_bytes": pa.array(sizes, pa.int64()),
                        "spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                        "kept": pa.array(kept, pa.binary()),
                    }
                )
            )
        return pa.concat_tables(tables)

    spans = T.ArrayType(T.ArrayType(T.LongType()))
    schema = (
        T.StructType()
        .add("row", docs.schema)
        .add("n_bytes", T.LongType())
        .add("spans", spans)
        .add("kept", T.BinaryType())
    )
    return held.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(mend, schema)
