"""BPE through a lexicon of frequent words: a minimal acyclic transducer.

The words whose share of all pre-tokens reaches ``min_share`` are counted over
the whole corpus and compiled into an automaton that shares prefixes and
suffixes. Outputs on the arcs add up to the number of the word, whose row of
the id table is its encoding. Tasks memory-map the compiled file; words that
it does not hold are merged exactly.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.bpe import Encoder, Merges, Splitter
from gleanwork.session import scratch_dir, settle

_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def frequent_words(docs: DataFrame, merges: Merges, text_col: str, min_share: float) -> list[str]:
    """Words with at least ``min_share`` of all pre-tokens of all documents.

    There are at most ``1 / min_share`` of them, whatever the size of the
    corpus, which bounds what reaches the driver. Counts are added up in the
    tasks before the shuffle.
    """
    special = merges.special

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Splitter(special), Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(seen), pa.string()), pa.array(seen.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, schema=_COUNTS)

        for batch in batches:
            for text in batch["text"]:
                seen.update(split(text.as_py() or ""))
                if len(seen) > 400_000:
                    yield out()
                    seen.clear()
        yield out()

    counts = (
        docs.select(F.col(text_col).alias("text"))
        .mapInArrow(count, "word string, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counts = settle(counts)
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = counts.filter(F.col("n") >= min_share * total).select("word").collect()
    return sorted((r["word"] for r in rows if r["word"] not in special), key=str.encode)


def compile_lexicon(words: list[str], merges: Merges) -> np.ndarray:
    """One array of 64-bit numbers: five lengths, then arc keys (state * 256 +
    byte), arc targets, arc outputs, final states, id starts and ids.

    ``words`` are distinct and sorted by their bytes. Equal suffixes are merged
    as soon as a later word can no longer change them.
    """
    spelled = [w.encode() for w in words]
    register: dict[tuple, int] = {}
    arcs: list[tuple] = []  # per finished state: ((byte, target), ...)
    finals: list[bool] = []
    reach: list[int] = []  # words that a state accepts

    def close(final: bool, out: list[tuple[int, int]]) -> int:
        key = (final, *out)
        state = register.get(key)
        if state is None:
            state = register[key] = len(arcs)
            arcs.append(tuple(out))
            finals.append(final)
            reach.append(int(final) + sum(reach[t] for _, t in out))
        return state

    # The path of the last word: one open state per byte, and one for the root.
    path: list[list] = [[False, []]]
    last = b""
    for word in spelled:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for depth in range(len(last), common, -1):
            final, out = path.pop()
            path[-1][1].append((last[depth - 1], close(final, out)))
        path += [[False, []] for _ in word[common:]]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        final, out = path.pop()
        path[-1][1].append((last[depth - 1], close(final, out)))
    root = close(*path.pop())

    keys, targets, outputs = [], [], []
    for state, out in enumerate(arcs):
        before = int(finals[state])
        for byte, target in out:
            keys.append(state * 256 + byte)
            targets.append(target)
            outputs.append(before)
            before += reach[target]
    ids, lengths = merges.merge(spelled)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    sizes = [len(keys), len(arcs), len(words), len(ids), root]
    parts = [sizes, keys, targets, outputs, finals, starts, ids]
    return np.concatenate([np.asarray(p, np.int64) for p in parts])


class Lexicon:
    """A compiled lexicon over a (memory-mapped) array."""

    def __init__(self, held: np.ndarray, merges: Merges):
        arcs, states, words, ids, self.root = (int(v) for v in held[:5])
        at = 5
        parts = []
        for size in (arcs, arcs, arcs, states, words + 1, ids):
            parts.append(held[at : at + size])
            at += size
        self.keys, self.targets, self.outputs, self.finals, self.starts, self.ids = parts
        self.words, self.merges = words, merges

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 where the lexicon does not hold it. All
        words follow their arcs together, byte by byte."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        begins = np.cumsum(lengths) - lengths
        number = np.full(len(words), -1, np.int64)
        live = np.arange(len(words) if self.words else 0)
        state = np.full(len(live), self.root)
        total = np.zeros(len(live), np.int64)
        depth = 0
        while len(live):
            ended = lengths[live] == depth
            accepted = ended & (self.finals[state] == 1)
            number[live[accepted]] = total[accepted]
            live, state, total = live[~ended], state[~ended], total[~ended]
            if not len(live) or not len(self.keys):
                break
            key = state * 256 + text[begins[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[at] == key
            live, at = live[found], at[found]
            state, total = self.targets[at], total[found] + self.outputs[at]
            depth += 1
        return number

    def resolve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per word: from the lexicon, else by merging."""
        number = self.numbers(words)
        known = number >= 0
        merged, merged_lengths = self.merges.merge([w for w, k in zip(words, known) if not k])
        lengths = np.zeros(len(words), np.int64)
        lengths[~known] = merged_lengths
        lengths[known] = self.starts[number[known] + 1] - self.starts[number[known]]
        ids = np.zeros(int(lengths.sum()), np.int64)
        ends = np.cumsum(lengths)
        from_known = np.repeat(known, lengths)
        ids[~from_known] = merged
        inside = np.arange(len(ids)) - np.repeat(ends - lengths, lengths)
        begin = np.repeat(np.where(known, self.starts[number], 0), lengths)
        ids[from_known] = self.ids[(begin + inside)[from_known]]
        return ids, lengths


def share_file(spark: SparkSession, data: bytes) -> str:
    """Write ``data`` to the shared folder and let every executor fetch it.

    Returns the name for ``SparkFiles.get``. The name is the content's digest,
    so equal data is sent once; an executor that joins later fetches it too.
    """
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:32]}"
    path = f"{scratch_dir(spark).rstrip('/')}/gleanwork/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = system.create(target, True)
    try:
        for at in range(0, len(data), 1 << 20):
            out.write(bytearray(data[at : at + (1 << 20)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


_ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())]
)


def encode_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_share: float = 2e-6,
) -> DataFrame:
    """``<doc_id, ids, decoded>`` of every document.

    ``ids`` are little-endian unsigned 32-bit ids, ``decoded`` is the text that
    the ids spell. A null text is empty, a null id stays null, repeated rows
    are encoded each, an empty table gives no rows, other columns are ignored.
    """
    spark = docs.sparkSession
    merges = Merges(tokenizer)
    words = frequent_words(docs, merges, text_col, min_share)
    name = share_file(spark, compile_lexicon(words, merges).tobytes())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.memmap(SparkFiles.get(name), np.int64, mode="r")
        encoder = Encoder(merges, Lexicon(held, merges).resolve)
        for batch in batches:
            rows, size = [], 0
            texts = (t.as_py() for t in batch["text"])
            for doc, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(texts)):
                rows.append((doc, ids.astype("<u4").tobytes(), encoder.decode(ids)))
                size += len(ids)
                if size > 1_000_000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), _ENCODED)], schema=_ENCODED
                    )
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), _ENCODED)], schema=_ENCODED
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(encode, "doc_id long, ids binary, decoded string")
