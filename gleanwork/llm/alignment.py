"""Which tokens of two tokenizers stand for the same bytes.

Both tokenizers spell one text, so the byte offsets where a token of each ends
cut the text into groups. The cuts are found by divide and conquer: of an
interval of tokens, a common end near the middle is located by bisecting the
ends of the other side, first at the middle, then in widening rings around it;
both halves are open intervals again, and an interval without a common end is a
leaf group. All documents of a block descend together, a level at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gleanwork.llm.bpe import Encoder, Merges, byte_letters
from gleanwork.session import settle

#: Characters of text whose pairs are counted together, and of those that are
#: aligned together; a longer text stands alone.
BLOCK_CHARS = 4_000_000
STRETCH_CHARS = 400_000

#: Bytes from which the library merges a word, by its own queue of pairs.
LONG_WORD = 256


def shared_cuts(
    a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and ``b`` (ascending ends) of all common values, sorted.

    ``last_a`` and ``last_b`` are the places of the last end of each document,
    which are common.
    """
    cuts_a, cuts_b = [last_a], [last_b]
    lo_a, hi_a = np.concatenate([[0], last_a[:-1] + 1]), last_a
    lo_b, hi_b = np.concatenate([[0], last_b[:-1] + 1]), last_b
    while True:
        # An interval with one token on a side has no cut inside.
        split = (lo_a < hi_a) & (lo_b < hi_b)
        lo_a, hi_a, lo_b, hi_b = (v[split] for v in (lo_a, hi_a, lo_b, hi_b))
        if not len(lo_a):
            break
        at_a, at_b = _near_middle(a, b, lo_a, hi_a)
        found = at_a >= 0
        lo_a, hi_a, lo_b, hi_b, at_a, at_b = (
            v[found] for v in (lo_a, hi_a, lo_b, hi_b, at_a, at_b)
        )
        cuts_a.append(at_a)
        cuts_b.append(at_b)
        # Halves stay in the order of the text, which keeps bisecting fast.
        lo_a, hi_a = np.column_stack([lo_a, at_a + 1]), np.column_stack([at_a, hi_a])
        lo_b, hi_b = np.column_stack([lo_b, at_b + 1]), np.column_stack([at_b, hi_b])
        lo_a, hi_a, lo_b, hi_b = (v.ravel() for v in (lo_a, hi_a, lo_b, hi_b))
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def _near_middle(a, b, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """The common end of each interval ``lo <= place < hi`` of ``a`` that is
    nearest to its middle, or -1."""
    middle = (lo + hi - 1) // 2
    other = np.searchsorted(b, a[middle])
    common = b[other] == a[middle]  # the last ends of both sides are equal
    at_a, at_b = np.where(common, middle, -1), np.where(common, other, -1)
    open_, inner = np.flatnonzero(~common & (hi - lo > 1)), 1
    while len(open_):
        # Places at a distance of inner ... 2 * inner on either side.
        mid, low, high = middle[open_], lo[open_], hi[open_]
        place, owner = [], []
        for first, end in (
            (np.maximum(low, mid - 2 * inner), mid - inner + 1),
            (mid + inner, np.minimum(high, mid + 2 * inner + 1)),
        ):
            n = np.maximum(end - first, 0)
            steps = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            place.append(np.repeat(first, n) + steps)
            owner.append(np.repeat(np.arange(len(open_)), n))
        place, owner = np.concatenate(place), np.concatenate(owner)
        other = np.searchsorted(b, a[place])
        common = b[other] == a[place]
        place, owner, other = place[common], owner[common], other[common]
        # Written farthest first, so the nearest of each interval stays.
        order = np.argsort(-np.abs(place - mid[owner]), kind="stable")
        at_a[open_[owner[order]]] = place[order]
        at_b[open_[owner[order]]] = other[order]
        inner = 2 * inner + 1
        more = (at_a[open_] < 0) & ((mid - inner >= low) | (mid + inner < high))
        open_ = open_[more]
    return at_a, at_b


class Tokenizers:
    """Both tokenizers as bytes, so tasks need no file: 3 MB."""

    def __init__(self, byte_bpe: str, pieces: str):
        import sentencepiece

        self.merges = Merges(byte_bpe)
        self.merges.special = {}  # their strings in a text are plain text
        with open(byte_bpe, encoding="utf-8") as f:
            self.spec = f.read()
        with open(pieces, "rb") as f:
            self.model = f.read()
        spelled = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.a_bytes = self.merges.spelled
        self.b_bytes = [
            bytes([int(spelled.id_to_piece(i)[3:5], 16)])
            if spelled.is_byte(i)
            else spelled.id_to_piece(i).replace("▁", " ").encode()
            for i in range(spelled.vocab_size())
        ]

        self.sizes = tuple(
            np.fromiter(map(len, side), np.int64, len(side))
            for side in (self.a_bytes, self.b_bytes)
        )
        shown = [spelled.id_to_piece(i) for i in range(spelled.vocab_size())]
        self.by_words = not any(re.search("[^▁]▁", p) for p in shown) and all(
            spelled.decode(spelled.encode(t)) == t for t in ("a  b", " a", "a ", "\t a\n", "ﬁ½")
        )
        # Decimal ids, inside a group and at the ends of its halves.
        plain = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = tuple(np.array([i + m for i in plain], object) for m in ",|;")

    def opened(self):
        """``encode(texts)`` of both, for one task."""
        import sentencepiece
        import tokenizers

        library = tokenizers.Tokenizer.from_str(self.spec).model
        shown = {b: c for c, b in byte_letters().items()}
        merges = self.merges

        def resolve(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            long = [i for i, w in enumerate(words) if len(w) >= LONG_WORD]
            if not long:
                return merges.merge(words)
            ids, lengths = merges.merge([w for w in words if len(w) < LONG_WORD])
            short = np.split(ids, np.cumsum(lengths)[:-1]) if len(lengths) else []
            parts, rest = [], iter(short)
            for word in words:
                if len(word) < LONG_WORD:
                    parts.append(next(rest))
                else:
                    tokens = library.tokenize("".join([shown[b] for b in word]))
                    parts.append(np.array([t.id for t in tokens], np.int64))
            lengths = np.fromiter(map(len, parts), np.int64, len(parts))
            return np.concatenate(parts), lengths

        encoder = Encoder(merges, resolve, max_words=300_000)
        pieces = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        if self.by_words:
            words = Encoder(merges, lambda w: _alone(pieces, w), max_words=300_000)
            # A word is a run of spaces and what follows up to the next space.
            # No token goes on over its end, so words merge alone; the space
            # that the library puts before a text belongs to the first one.
            words.split = re.compile(" +[^ ]*").findall

        def encode(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
            spaced = [" " + t for t in texts]
            a = [v.astype(np.int64) for v in encoder.encode(spaced)]
            if self.by_words:
                return a, [v.astype(np.int64) for v in words.encode(spaced)]
            b = pieces.encode(texts, num_threads=1) if texts else []
            return a, [np.array(v, np.int64) for v in b]

        return encode


def _alone(pieces, words: list[bytes], at_once: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words one after another, and their number per word."""
    space = [pieces.piece_to_id("▁")]  # the library adds none to an empty text
    ids, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(words), at_once):
        part = words[i : i + at_once]
        made = pieces.encode([w[1:].decode() for w in part], num_threads=1)
        made = [space if w == b" " else m for w, m in zip(part, made)]
        ids.append(np.fromiter(chain.from_iterable(made), np.int64))
        lengths.append(np.fromiter(map(len, made), np.int64, len(made)))
    return np.concatenate(ids), np.concatenate(lengths)


class Stretch:
    """Aligned documents: all arrays run over the documents in a row."""

    def __init__(self, tokens: Tokenizers, encode, texts: list[str | None]):
        self.docs = len(texts)
        whole = [i for i, t in enumerate(texts) if t]
        a, b = encode([texts[i] for i in whole])
        kept, kept_a, kept_b = [], [], []
        sizes_a, sizes_b = tokens.sizes
        spelled = tokens.b_bytes.__getitem__
        for i, x, y in zip(whole, a, b):
            data = b" " + texts[i].encode()
            # A byte-level tokenizer keeps the bytes it is given.
            if sizes_a[x].sum() == len(data) and b"".join(map(spelled, y.tolist())) == data:
                kept.append(i)
                kept_a.append(x)
                kept_b.append(y)
        self.kept = np.array(kept, np.int64)
        self.n_a = np.fromiter(map(len, kept_a), np.int64, len(kept))
        self.n_b = np.fromiter(map(len, kept_b), np.int64, len(kept))
        none = [np.zeros(0, np.int64)]
        self.a, self.b = np.concatenate(kept_a or none), np.concatenate(kept_b or none)
        self.end_a, self.end_b = np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b])
        self.last_a, self.last_b = np.cumsum(self.n_a) - 1, np.cumsum(self.n_b) - 1
        self.cut_a, self.cut_b = shared_cuts(self.end_a, self.end_b, self.last_a, self.last_b)
        self.b_ids, self.names = len(tokens.b_bytes), tokens.names

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Document and pair (``a * ids of b + b``) of every overlap.

        Inside a group no ends meet, so each end closes exactly one overlap.
        """
        both = np.concatenate([self.end_a, self.end_b])
        order = np.argsort(both, kind="stable")  # two sorted runs: one merge
        ends, from_a = both[order], order < len(self.end_a)
        last = np.ones(len(ends), bool)
        last[:-1] = ends[1:] != ends[:-1]
        # Ends below each end are the place of the token that holds it.
        at_a = (np.cumsum(from_a) - from_a)[last] - self._twice(ends, last)
        at_b = (np.cumsum(~from_a) - ~from_a)[last]
        doc = np.repeat(np.arange(len(self.n_a)), self.n_a)[at_a]
        return doc, self.a[at_a] * self.b_ids + self.b[at_b]

    @staticmethod
    def _twice(ends: np.ndarray, last: np.ndarray) -> np.ndarray:
        """1 for common ends, where the end of a stands just before that of b."""
        twice = np.zeros(len(ends), np.int64)
        twice[1:] = ends[1:] == ends[:-1]
        return twice[last]

    def groups(self) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` of each kept document."""
        n = len(self.cut_a)
        of_a = np.repeat(np.arange(n), np.diff(self.cut_a, prepend=-1))
        of_b = np.repeat(np.arange(n), np.diff(self.cut_b, prepend=-1))
        # In a group the tokens of a come first, then those of b.
        before_b = np.concatenate([[0], self.cut_b + 1])[:n]
        place_a = np.arange(len(self.a)) + before_b[of_a]
        place_b = np.arange(len(self.b)) + self.cut_a[of_b] + 1
        inner, last_a, last_b = self.names
        flat = np.empty(len(self.a) + len(self.b), object)
        flat[place_a], flat[place_b] = inner[self.a], inner[self.b]
        flat[place_a[self.cut_a]] = last_a[self.a[self.cut_a]]
        flat[place_b[self.cut_b]] = last_b[self.b[self.cut_b]]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        for first, end in zip([0, *ends], ends):
            yield "".join(flat[first:end].tolist())[:-1]


_BLOCK = (
    "block long, place int, n_a long, n_b long, n_groups long, n_links long, "
    "groups string, pairs array<bigint>, counts array<bigint>"
)
_FOUND = pa.schema(
    [
        ("block", pa.int64()),
        ("place", pa.int32()),
        *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
        ("groups", pa.string()),
        ("pairs", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
    ]
)


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64()))


class _Block:
    """Results of the documents of a block, and its pairs."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.ids: list = []
        self.numbers: list[np.ndarray] = []
        self.groups: list[str] = []
        self.lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, stretch: Stretch, ids: list, chars: int, keep_groups: bool) -> None:
        doc, pair = stretch.links()
        kept, docs = stretch.kept, len(stretch.kept)
        numbers = np.zeros((4, stretch.docs), np.int64)
        of_cut = np.searchsorted(stretch.last_a, stretch.cut_a)
        numbers[:, kept] = (
            stretch.n_a,
            stretch.n_b,
            np.bincount(of_cut, minlength=docs),
            np.bincount(doc, minlength=docs),
        )
        groups = np.full(stretch.docs, "", object)
        for i, text in zip(kept.tolist(), stretch.groups()):
            groups[i] = text if keep_groups else hashlib.sha256(text.encode()).hexdigest()
        distinct, of = np.unique(pair, return_inverse=True)
        keyed, counts = np.unique(kept[doc] * len(distinct) + of, return_counts=True)
        owner, own = np.divmod(keyed, max(len(distinct), 1))
        self.lists.append((np.bincount(owner, minlength=stretch.docs), distinct[own], counts))
        self.numbers.append(numbers)
        self.groups += groups.tolist()
        self.ids += ids
        self.chars += chars

    def rows(self, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        """A row per document, and one for the block at place -1."""
        sizes, pairs, counts = (np.concatenate(c) for c in zip(*self.lists))
        ends = np.cumsum(sizes)
        columns = [
            pa.array(self.ids, kind),
            pa.array(np.full(len(ends), self.number), pa.int64()),
            pa.array(np.arange(len(ends)), pa.int32()),
            *(pa.array(v, pa.int64()) for v in np.concatenate(self.numbers, axis=1)),
            pa.array(self.groups, pa.string()),
            _lists(pairs, ends),
            _lists(counts, ends),
        ]
        names = ["id", *_FOUND.names]
        yield from pa.Table.from_arrays(columns, names).to_batches(5_000)
        distinct, of = np.unique(pairs, return_inverse=True)
        total = np.bincount(of, counts, len(distinct)).astype(np.int64)
        whole = [self.number], [-1], *[[0]] * 4, [""], [distinct], [total]
        made = [pa.array(v, f.type) for v, f in zip(whole, _FOUND)]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), *made], names)


def aligned(
    docs: DataFrame,
    byte_bpe: str,
    pieces: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = False,
) -> DataFrame:
    """``<id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups>`` per row.

    Tokenizer ``a`` encodes space + text, ``b`` the text, both without special
    tokens. ``n_links`` are the overlapping pairs of token occurrences; the
    count of an id pair is the number of its links in all rows, ``n_best`` the
    links whose count is the highest of their ``b`` id, ties included, and
    ``count_sum`` the sum of the counts. ``groups`` is the digest of the groups
    (SHA-256 of ``a1,a2|b1;a3|b2,b3``), or with ``keep_groups`` their string.

    Null and empty texts, and texts that either side does not spell byte by
    byte, have no tokens: zeros and ''. Repeated rows count each, an empty table
    gives no rows, ids of any type (null too) stay as they are, other columns
    are ignored under any name.
    """
    tokens = Tokenizers(byte_bpe, pieces)
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = to_arrow_type(docs.schema[id_col].dataType)
    ddl = f"id {id_type}, {_BLOCK}"

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokens.opened()
        block = _Block(TaskContext.get().partitionId() << 32)
        ids, texts, chars = [], [], 0
        for batch in batches:
            for own, text in zip(batch["id"], batch["text"].to_pylist()):
                size = len(text or "")
                if texts and chars + size > STRETCH_CHARS:
                    block.add(Stretch(tokens, encode, texts), ids, chars, keep_groups)
                    ids, texts, chars = [], [], 0
                if block.ids and block.chars + size > BLOCK_CHARS:
                    yield from block.rows(kind)
                    block = _Block(block.number + 1)
                ids.append(own.as_py())
                texts.append(text)
                chars += size
        if texts:
            block.add(Stretch(tokens, encode, texts), ids, chars, keep_groups)
        if block.ids:
            yield from block.rows(kind)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = settle(rows.mapInArrow(align, ddl))
    blocks, per_doc = found.filter("place < 0"), found.filter("place >= 0")
    # A block asks for each of its pairs once.
    asked = blocks.select(
        "block", F.explode(F.arrays_zip("pairs", "counts")).alias("p")
    ).select("block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = settle(asked.groupBy("pair").agg(F.sum("n").alias("total")))
    b_id = F.pmod("pair", F.lit(len(tokens.b_bytes)))
    # One row per id of the second vocabulary at most: fits a broadcast.
    highest = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("highest"))
    told = totals.withColumn("b", b_id).join(F.broadcast(highest), "b")
    told = told.select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = settle(asked.select("block", "pair").join(told, "pair"))

    def count(key, left: pa.Table, right: pa.Table) -> pa.Table:
        pair = right["pair"].to_numpy()
        order = np.argsort(pair)
        pair = pair[order]
        total = right["total"].to_numpy()[order]
        best = right["best"].to_numpy()[order].astype(np.int64)
        lists = left["pairs"].combine_chunks()
        sizes = pa.compute.list_value_length(lists).to_numpy()
        at = np.searchsorted(pair, lists.flatten().to_numpy())
        n = left["counts"].combine_chunks().flatten().to_numpy()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sums = []
        for values in (best, total):
            made = np.zeros(len(sizes), np.int64)
            np.add.at(made, owner, values[at] * n)
            sums.append(pa.array(made, pa.int64()))
        kept = ["id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table(
            [*(left[c] for c in kept), *sums, left["groups"]],
            names=[*kept, "n_best", "count_sum", "groups"],
        )

    schema = (
        f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, "
        "n_best long, count_sum long, groups string"
    )
    counted = per_doc.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(count, schema)
    return counted.withColumnRenamed("id", id_col)
