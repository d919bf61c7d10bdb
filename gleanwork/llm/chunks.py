"""Chunks of documents and exchanges of packed arrays between chunks and shards.

A chunk is a run of documents of one input partition. What a chunk asks of a
shard travels as one packed row, repeats within the chunk counted once, so a
key that is in a third of all documents costs a shard one entry per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text in a chunk; a longer text is a chunk of its own.
CHUNK_CHARS = 4_000_000

#: Rows that travel between chunks and shards: ``part`` is the shard, or -1.
PARCEL = "chunk long, part int, data binary"
PARCEL_ARROW = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("data", pa.binary())])

_ODD = np.uint64(0x9E3779B97F4A7C15)


def packed(*arrays: np.ndarray) -> bytes:
    """Integer arrays as bytes, stored plane by plane and squeezed; ascending
    ones as differences."""
    parts = []
    for array in arrays:
        wide = np.ascontiguousarray(array).astype(np.uint64, copy=False)
        ascending = len(wide) > 1 and bool((wide[1:] >= wide[:-1]).all())
        steps = np.diff(wide, prepend=np.uint64(0)) if ascending else wide
        parts.append(np.array([len(wide), ascending], np.uint64).tobytes())
        parts.append(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpacked(data: bytes) -> list[np.ndarray]:
    """The arrays of ``packed``, as unsigned 64-bit numbers."""
    raw = zstandard.ZstdDecompressor().decompress(data)
    arrays, at = [], 0
    while at < len(raw):
        n, ascending = np.frombuffer(raw, np.uint64, 2, at).tolist()
        planes = np.frombuffer(raw, np.uint8, 8 * n, at + 16).reshape(8, n)
        steps = np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1)
        arrays.append(np.cumsum(steps, dtype=np.uint64) if ascending else steps)
        at += 16 + 8 * n
    return arrays


def mixed(values: np.ndarray) -> np.ndarray:
    """Well spread bits of 64-bit numbers."""
    values = values ^ (values >> np.uint64(31))
    values = values * _ODD
    return values ^ (values >> np.uint64(29))


def shard_count(chunks: int) -> int:
    """Shards that keep the entries of a shard bounded by those of a few chunks."""
    return max(64, chunks // 4)


def by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by shard, and the bounds of each shard in it."""
    shard = (mixed(keys) >> np.uint64(16)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def parcels(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = zip(*rows) if rows else ([], [], [])
    return pa.table(
        [pa.array(c, f.type) for c, f in zip(columns, PARCEL_ARROW)], schema=PARCEL_ARROW
    )


def chunked(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` as parcels of Arrow streams, one per chunk, whole rows in the
    struct ``row``. The chunk number is the partition and the place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        chars = 0

        def out() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))
            with pa.ipc.new_stream(sink, held[0].schema, options=options) as stream:
                for part in held:
                    stream.write_batch(part)
            return parcels([(chunk, -1, sink.getvalue().to_pybytes())]).to_batches()[0]

        for batch in batches:
            texts = pa.compute.struct_field(batch["row"], text_col)
            sizes = pa.compute.binary_length(texts).fill_null(0).to_numpy(False)
            start = 0
            for i, size in enumerate(sizes.tolist()):
                if held or i > start:
                    if chars + size > CHUNK_CHARS:
                        if i > start:
                            held.append(batch.slice(start, i - start))
                        yield out()
                        held, chars, start, chunk = [], 0, i, chunk + 1
                chars += size
            if batch.num_rows > start:
                held.append(batch.slice(start))
        if held:
            yield out()

    return docs.select(F.struct("*").alias("row")).mapInArrow(run, PARCEL)


def opened(data: bytes) -> pa.ChunkedArray:
    """The documents of a chunk, as structs."""
    return pa.ipc.open_stream(data).read_all()["row"]


class WordHashes:
    """64-bit hashes of words, remembered for up to ``limit`` distinct words."""

    def __init__(self, limit: int = 500_000):
        self.limit, self.held = limit, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        held, hashed = self.held, xxhash.xxh64_intdigest
        if len(held) > self.limit:
            held.clear()
        for word in set(words).difference(held):
            held[word] = hashed(word, 42)
        return np.fromiter(map(held.__getitem__, words), np.uint64, len(words))


def release(df: DataFrame) -> DataFrame:
    """``df``, a table just written. Lets Spark remove the shuffle files of
    finished jobs now: it does so for those that the driver's JVM has collected."""
    df.sparkSession.sparkContext._jvm.System.gc()
    return df


def grouped(parcel_rows: DataFrame, column: str, function) -> DataFrame:
    """Parcels with equal ``column`` together through ``function``."""
    return parcel_rows.groupBy(F.col(column)).applyInArrow(function, PARCEL)
