"""Katz backoff language model: training on and scoring of whole corpora.

Every word of the training documents is a class of its own; words that are not
in them share one class. Counts of bigrams are Good-Turing discounted; what the
discounts set free goes to the unseen successors of a history, by an exactly
normalised backoff weight. No word and no bigram is left out.

With ``min_share`` above 0, words with a smaller share of the training tokens
join that class too, in which a word has its additively smoothed share.

Words and bigrams are counted in shards and never meet on the driver. A bigram
lies in the shard of its history, so that shard knows the weight; histories
with more than half a shard's share of all tokens are spread over all shards,
and only their sums are broadcast.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.llm.chunks import (
    CHUNK_CHARS,
    PARCEL,
    WordHashes,
    by_shard,
    grouped,
    packed,
    parcels,
    shard_count,
    unpacked,
)
from gleanwork.session import settle

#: Counts above this are taken as they are.
DISCOUNTED = 5

#: Added to every count of a rare word, and of the base model.
ADDED = 0.1


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def held_out(doc_id: int | None) -> bool:
    """Every tenth document by the CRC-32 of its id's text (null: empty)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def discounts(of_counts: dict[int, int]) -> np.ndarray:
    """Good-Turing discount per count from the number of items per count.

    Index 0 stands for all larger counts (no discount). A count whose discount
    does not fall between 0 and 1, as in tiny corpora, gives up half an item.
    """
    d = np.ones(DISCOUNTED + 1)
    n = {r: of_counts.get(r, 0) for r in range(1, DISCOUNTED + 2)}
    cut = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        d[r] = (r - 0.5) / r
        if n[r] and cut < 1:
            katz = ((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut)
            if 0 < katz < 1:
                d[r] = katz
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * d[np.where(counts <= DISCOUNTED, counts, 0)]


@dataclass
class Unigrams:
    """A few numbers on the words of the training documents. The words
    themselves stay in partitioned tables."""

    tokens: int  # N, ends included
    distinct: int  # V, the end included
    ends: int
    least: float  # count from which a word is a class of its own
    classes: int  # words of their own, the end, the rare class
    rare_tokens: int
    rare_words: int
    room: int
    p_rare: float
    d: np.ndarray
    end: int  # class numbers
    rare: int
    start: int  # only a history

    @property
    def width(self) -> int:
        return self.start + 1

    def classed(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Classes of words with these numbers and training counts."""
        own = (counts >= self.least) | (numbers == self.end)
        return np.where(own, numbers, self.rare)

    def p(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Probabilities of classes, given the counts of their words."""
        if not self.tokens:
            return np.full(len(classes), 0.5)
        return np.where(classes == self.rare, self.p_rare, discounted(counts, self.d) / self.room)


#: The end of a document is counted like a word; no word has a blank.
END = b" "
END_HASH = WordHashes()([END])[0]


def hashed(docs: DataFrame) -> DataFrame:
    """Chunks of documents as parcels: ids, lengths with the end, the places of
    all tokens in the chunk's word list, and the hashes of that list. The end
    is place 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes = WordHashes()
        chunk = TaskContext.get().partitionId() << 32
        docs_held: list[int | None] = []
        arrays: list[np.ndarray] = []
        places: dict[bytes, int] = {}
        chars = 0

        def fresh() -> dict[bytes, int]:
            found: dict[bytes, int] = defaultdict(itertools.count().__next__)
            found[END]
            return found

        def out() -> pa.RecordBatch:
            data = packed(
                np.array([d is not None for d in docs_held], np.uint64),
                np.array([d or 0 for d in docs_held], np.int64).view(np.uint64),
                np.fromiter(map(len, arrays), np.uint64, len(arrays)),
                np.concatenate(arrays).astype(np.uint64),
                hashes(list(places)),
            )
            return parcels([(chunk, -1, data)]).to_batches()[0]

        places = fresh()
        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py() or ""
                if docs_held and chars + len(text) > CHUNK_CHARS:
                    yield out()
                    docs_held, arrays, places, chars = [], [], fresh(), 0
                    chunk += 1
                found = tokens(text)
                ids = np.zeros(len(found) + 1, np.int64)
                ids[:-1] = np.fromiter(map(places.__getitem__, found), np.int64, len(found))
                docs_held.append(doc)
                arrays.append(ids)
                chars += len(text)
        if docs_held:
            yield out()

    return docs.mapInArrow(run, PARCEL)


class Documents:
    """The documents of a chunk: ids, lengths, and the place of every token in
    the chunk's word list."""

    def __init__(self, arrays: list[np.ndarray]):
        known, ids, lengths, places = arrays[:4]
        self.known, self.doc_ids = known.astype(bool), ids.view(np.int64)
        self.lengths = lengths.astype(np.int64)  # with the end
        self.places = places.astype(np.int64)
        self.owner = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.training = np.array(
            [not held_out(i if k else None) for i, k in zip(self.doc_ids.tolist(), self.known)], bool
        )

    def word_counts(self, words: int) -> np.ndarray:
        """Training counts of the chunk's words."""
        return np.bincount(self.places[self.training[self.owner]], minlength=words)


class Coded(Documents):
    """The documents of a chunk as classes: of every token and of the one
    before it, with the training counts of the words."""

    def __init__(self, data: bytes, model: Unigrams):
        arrays = unpacked(data)
        super().__init__(arrays)
        numbers, totals = (a.astype(np.int64) for a in arrays[4:])
        own = model.classed(numbers, totals)
        self.classes, self.counts = own[self.places], totals[self.places]
        self.history = np.concatenate([[model.start], self.classes[:-1]])[: len(self.classes)]
        before = np.concatenate([[0], self.counts[:-1]])[: len(self.classes)]
        first = np.cumsum(self.lengths) - self.lengths
        self.history[first] = model.start
        before[first] = model.ends
        # How often the history was seen in training: as often as its word.
        self.before = np.where(self.history == model.rare, model.rare_tokens, before)
        keys = self.history.astype(np.uint64) * np.uint64(model.width) + self.classes.astype(np.uint64)
        #: Distinct bigrams, the first place and the place of each token's.
        self.keys, self.first, self.of = np.unique(keys, return_index=True, return_inverse=True)

    def key_counts(self) -> np.ndarray:
        """Training counts of the chunk's bigrams."""
        return np.bincount(self.of[self.training[self.owner]], minlength=len(self.keys))


def _summed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """What all chunks asked of a shard, as arrays; the distinct keys, the
    place of each entry's, and the counts over all chunks."""
    asked = [unpacked(x) for x in table["data"].to_pylist()]
    keys = np.concatenate([a[0] for a in asked])
    counts = np.concatenate([a[1] for a in asked]).astype(np.int64)
    distinct, of = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, of, counts)
    return asked, distinct, of, total


def numbered_words(chunks: DataFrame, shards: int) -> DataFrame:
    """Answers of the word shards: for every chunk the number and the count of
    each word it sent, and (chunk -1) hash, number and count of all words seen
    in training. Frequent words of a shard have small numbers; the numbers of
    all shards interleave."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch["chunk"].to_pylist(), batch["data"]):
                arrays = unpacked(data.as_py())
                words = arrays[4]
                counts = Documents(arrays).word_counts(len(words))
                order, bounds = by_shard(words, shards)
                rows = []
                for s in range(shards):
                    at = order[bounds[s] : bounds[s + 1]]
                    if len(at):
                        rows.append((number, s, packed(words[at], counts[at])))
                yield from parcels(rows).to_batches()

    def add_up(rows: pa.Table) -> pa.Table:
        asked, distinct, of, total = _summed(rows)
        part = rows["part"][0].as_py()
        order = np.argsort(-total, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at, found = 0, []
        for chunk, own in zip(rows["chunk"].to_pylist(), asked):
            mine = of[at : at + len(own[0])]
            found.append((chunk, part, packed(rank[mine], total[mine])))
            at += len(mine)
        # The end is told even if no document is in training.
        seen = order[(total[order] > 0) | (distinct[order] == END_HASH)]
        found.append((-1, part, packed(distinct[seen], rank[seen], total[seen])))
        return parcels(found)

    return grouped(chunks.mapInArrow(ask, PARCEL), "part", add_up)


def unigrams(answers: DataFrame, shards: int, min_share: float) -> tuple[Unigrams, DataFrame]:
    """The numbers of the model, and ``<number, n, is_end>`` of all words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data in zip(batch["part"].to_pylist(), batch["data"]):
                words, rank, total = unpacked(data.as_py())
                number = rank.astype(np.int64) * shards + part
                columns = [number, total.astype(np.int64), words == END_HASH]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["number", "n", "is_end"]
                )

    words = (
        answers.filter(F.col("chunk") == -1)
        .select("part", "data")
        .mapInArrow(rows, "number long, n long, is_end boolean")
    )
    low = range(1, DISCOUNTED + 2)
    sums = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count_if(F.col("n") > 0).alias("distinct"),
        F.coalesce(F.max("number"), F.lit(0)).alias("top"),
        F.coalesce(F.max(F.when(F.col("is_end"), F.col("n"))), F.lit(0)).alias("ends"),
        F.coalesce(F.max(F.when(F.col("is_end"), F.col("number"))), F.lit(0)).alias("end"),
        *[F.count_if(F.col("n") == r).alias(f"n{r}") for r in low],
    ).first()
    total, top = sums["tokens"], sums["top"]
    if top + 3 >= 1 << 32:
        raise ValueError("a pair of word numbers has to fit into 64 bits")
    d = discounts({r: sums[f"n{r}"] for r in low})
    least = max(1, min_share * total)
    own = words.filter((F.col("n") >= least) | F.col("is_end")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count(F.lit(1)).alias("words"),
        *[F.count_if(F.col("n") == r).alias(f"n{r}") for r in low],
    ).first()
    known = own["tokens"] - sum(
        own[f"n{r}"] * r * (1 - d[r]) for r in range(1, DISCOUNTED + 1)
    )
    room = total if known < total * (1 - 1e-12) else total + 1
    seen_own = own["words"] - (0 if sums["ends"] else min(1, own["words"]))
    model = Unigrams(
        tokens=total,
        distinct=sums["distinct"],
        ends=sums["ends"],
        least=least,
        classes=own["words"] + 1,
        rare_tokens=total - own["tokens"],
        rare_words=sums["distinct"] - seen_own,
        room=room,
        p_rare=1 - known / room,
        d=d,
        end=sums["end"],
        rare=top + 1,
        start=top + 2,
    )
    return model, words


def coded(chunks: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """Chunks as parcels for ``Coded``: with numbers and counts of the words
    in place of their hashes."""

    def code(rows: pa.Table) -> pa.Table:
        told = dict(zip(rows["part"].to_pylist(), rows["data"].to_pylist()))
        *documents, words = unpacked(told.pop(-1))
        order, bounds = by_shard(words, shards)
        numbers, totals = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for s, data in told.items():
            at = order[bounds[s] : bounds[s + 1]]
            rank, total = (a.astype(np.int64) for a in unpacked(data))
            numbers[at], totals[at] = rank * shards + s, total
        return parcels([(rows["chunk"][0].as_py(), -1, packed(*documents, numbers, totals))])

    return grouped(chunks.unionByName(answers.filter(F.col("chunk") >= 0)), "chunk", code)


def _shards_of(keys: np.ndarray, history: np.ndarray, hot: np.ndarray, shards: int):
    """Bigrams by the shard of their history, those of a hot one by their own:
    order and bounds, and the histories' being hot."""
    is_hot = np.isin(history, hot)
    order, bounds = by_shard(np.where(is_hot, keys, history.astype(np.uint64)), shards)
    return order, bounds, is_hot


def backoff(model: Unigrams, d: np.ndarray, n, low, seen, below) -> tuple[np.ndarray, np.ndarray]:
    """Per history: the denominator of seen bigrams and log10 of the weight.

    ``low`` has the numbers of its bigrams with counts 1 to ``DISCOUNTED``.
    The weight of a history is what its seen successors leave, over the
    unigram probability of the unseen ones, so the probabilities of all
    classes add up to 1. A history that leaves nothing although it has unseen
    successors counts one more token; one that has seen every class needs no
    weight and is scaled to 1. One that was never seen leaves all to the
    unigrams.
    """
    r = np.arange(1, DISCOUNTED + 1)
    left = low @ (r * (1 - d[1:]))
    every = seen == model.classes
    room = np.where(every, n - left, np.where(left > n * 1e-12, n, n + 1)).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        log_weight = np.log10((1 - (n - left) / room) / (1 - below))
    return room, np.where(every | (seen == 0), 0.0, log_weight)


def score_corpus(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_share: float = 0.0
) -> DataFrame:
    """``<doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score>``.

    The model learns from all documents that are not held out and scores all.
    ``score`` is log10 of the Katz probability of the text and its end,
    ``base_score`` that of the additively smoothed unigrams. A null text is
    empty (one end), a null id is held out, repeated rows count and appear
    each, empty tables give no rows, other columns are ignored.
    """
    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    texts = settle(hashed(held))
    shards = shard_count(texts.count())
    told_words = settle(numbered_words(texts, shards))
    model, words = unigrams(told_words, shards, min_share)
    width, rare, start = model.width, model.rare, model.start
    # At most two histories per shard, besides the two that are no words.
    often = words.filter(F.col("n") > max(1.0, model.tokens / (2 * shards))).select("number")
    hot = np.array(sorted({r["number"] for r in often.collect()} | {rare, start}), np.int64)
    chunks = settle(coded(texts, told_words, shards))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data in zip(batch["chunk"].to_pylist(), batch["data"]):
                chunk = Coded(data.as_py(), model)
                counts, of_word = chunk.key_counts(), chunk.counts[chunk.first]
                order, bounds, _ = _shards_of(chunk.keys, chunk.history[chunk.first], hot, shards)
                rows = []
                for s in range(shards):
                    at = order[bounds[s] : bounds[s + 1]]
                    if len(at):
                        rows.append((number, s, packed(chunk.keys[at], counts[at], of_word[at])))
                yield from parcels(rows).to_batches()

    def add_up(rows: pa.Table) -> pa.Table:
        """For every chunk the counts of the bigrams it sent, and of each of
        their histories that is not hot whether it has bigrams to discount,
        and all of it where the chunk needs the weight. Chunk -1: the numbers
        of bigrams per count; chunk -2: sums of the hot histories."""
        asked, distinct, of, total = _summed(rows)
        of_word = np.zeros(len(distinct), np.int64)
        of_word[of] = np.concatenate([a[2] for a in asked]).astype(np.int64)
        history, word = (x.astype(np.int64) for x in np.divmod(distinct, np.uint64(width)))
        some, group = np.unique(history, return_inverse=True)
        n = len(some)
        is_seen = total > 0
        low = np.stack(
            [np.bincount(group[total == r], minlength=n) for r in range(1, DISCOUNTED + 1)], 1
        )
        seen = np.bincount(group[is_seen], minlength=n)
        below = np.bincount(group, np.where(is_seen, model.p(word, of_word), 0.0), n)
        every, discounts_some, is_hot = seen == model.classes, low.any(1), np.isin(some, hot)
        part, at, found = rows["part"][0].as_py(), 0, []

        def whole(h: np.ndarray) -> list[np.ndarray]:
            return [*low[h].T, seen[h], below[h].view(np.uint64)]

        for chunk, own in zip(rows["chunk"].to_pylist(), asked):
            mine = of[at : at + len(own[0])]
            at += len(mine)
            h, of_h = np.unique(group[mine], return_inverse=True)
            needs = (every[h] | (np.bincount(of_h, total[mine] == 0) > 0)) & ~is_hot[h]
            found.append(
                (chunk, part, packed(total[mine], discounts_some[h], needs, *whole(h[needs])))
            )
        per_count = np.bincount(total[total <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
        found.append((-1, part, packed(per_count)))
        h = np.flatnonzero(is_hot)
        found.append((-2, part, packed(some[h], *whole(h))))
        return parcels(found)

    answers = settle(grouped(chunks.mapInArrow(ask, PARCEL), "part", add_up))

    def of_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(DISCOUNTED + 2, np.int64)
        for batch in batches:
            for data in batch["data"]:
                n += unpacked(data.as_py())[0].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], ["r", "n"])

    small = answers.filter(F.col("chunk") == -1).select("data").mapInArrow(of_counts, "r long, n long")
    d = discounts(
        {r["r"]: r["n"] for r in small.groupBy("r").agg(F.sum("n").alias("n")).collect()}
    )
    names = [*(f"n{r}" for r in range(1, DISCOUNTED + 1)), "seen"]

    def of_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch["data"]:
                h, *counts, below = unpacked(data.as_py())
                columns = [*(c.astype(np.int64) for c in (h, *counts)), below.view(np.float64)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["h", *names, "below"]
                )

    sums = (
        answers.filter(F.col("chunk") == -2)
        .select("data")
        .mapInArrow(of_hot, f"h long, {', '.join(f'{c} long' for c in names)}, below double")
        .groupBy("h")
        .agg(*[F.sum(c).alias(c) for c in (*names, "below")])
        .orderBy("h")
        .toArrow()  # one row per hot history
    )
    hot_h, *hot_counts, hot_below = (sums[c].to_numpy() for c in ("h", *names, "below"))
    shared = context.broadcast((hot_h, np.stack(hot_counts[:-1], 1), hot_counts[-1], hot_below))
    base_room = np.log10(model.tokens + ADDED * (model.distinct + 1))
    rare_room = np.log10(model.rare_tokens + ADDED * (model.rare_words + 1))

    def score(rows: pa.Table) -> pa.Table:
        hot_h, hot_low, hot_seen, hot_below = shared.value
        told = dict(zip(rows["part"].to_pylist(), rows["data"].to_pylist()))
        chunk = Coded(told.pop(-1), model)
        n = len(chunk.lengths)
        owner, word = chunk.owner, chunk.classes
        history, before = chunk.history[chunk.first], chunk.before[chunk.first]
        order, bounds, is_hot = _shards_of(chunk.keys, history, hot, shards)
        count = np.zeros(len(chunk.keys), np.int64)
        room, log_weight = np.ones(len(count)), np.zeros(len(count))
        for s, data in told.items():
            at = order[bounds[s] : bounds[s + 1]]
            total, some_low, needs, *whole = (unpacked(data))
            count[at] = total.astype(np.int64)
            h, first, of_h = np.unique(history[at], return_index=True, return_inverse=True)
            of_n = before[at][first]
            rooms = np.where(some_low > 0, of_n, of_n + 1).astype(float)
            weights = np.zeros(len(h))
            needs = needs.astype(bool)
            low, seen = np.stack(whole[:-2], 1).astype(np.int64), whole[-2].astype(np.int64)
            rooms[needs], weights[needs] = backoff(
                model, d, of_n[needs], low, seen, whole[-1].view(np.float64)
            )
            room[at], log_weight[at] = rooms[of_h], weights[of_h]
        at = np.flatnonzero(is_hot & np.isin(history, hot_h))
        of_h = np.searchsorted(hot_h, history[at])
        room[at], log_weight[at] = backoff(
            model, d, before[at], hot_low[of_h], hot_seen[of_h], hot_below[of_h]
        )
        # The bigram if it was seen, else the weighted unigram.
        log_p = np.log10(model.p(word[chunk.first], chunk.counts[chunk.first]))
        with np.errstate(divide="ignore"):
            upper = np.log10(discounted(count, d) / room)
        katz = np.where(count > 0, upper, log_weight + log_p)[chunk.of]
        spelled = np.log10(chunk.counts + ADDED)
        katz = katz + np.where(word == rare, spelled - rare_room, 0.0)
        return pa.table(
            {
                "doc_id": pa.array(chunk.doc_ids, mask=~chunk.known),
                "held_out": pa.array(~chunk.training),
                "n_tokens": pa.array(chunk.lengths),
                "n_known": pa.array(np.bincount(owner, chunk.counts > 0, n).astype(np.int64)),
                "train_tokens": pa.array(np.full(n, model.tokens, np.int64)),
                "base_score": pa.array(np.bincount(owner, spelled - base_room, n)),
                "score": pa.array(np.bincount(owner, katz, n)),
            }
        )

    return (
        chunks.unionByName(answers.filter(F.col("chunk") >= 0))
        .groupBy("chunk")
        .applyInArrow(
            score,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
