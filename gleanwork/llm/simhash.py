"""SimHash near-duplicates through BK-trees.

Documents become 64-bit fingerprints. Fingerprints that differ in at most
``radius`` bits agree on at least one of ``radius + 1`` fields of their bits, so
equal fields define the shards. Every shard builds BK-trees (children keyed by
their distance to the parent) of a bounded size, and searches follow only the
edges within the radius.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.joins import attach
from gleanwork.operators.components import connected
from gleanwork.session import settle

SEED = 42

#: Fingerprints in one tree.
TREE = 4096

#: (query, node) pairs that a task holds at once.
FRONTIER = 2_000_000


def fingerprint(text: str | None, shingle: int) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included.

    Fewer words than a shingle: the whole sequence; no words: zero.
    """
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    size = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    begins = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(begins, ends)),
        np.uint64,
        len(ends),
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    carried: Sequence[str] = (),
) -> DataFrame:
    """``<doc_id, fp>`` per document and the ``carried`` columns (longs);
    ``fp`` holds the 64 bits as a long."""
    names = ["doc_id", *carried, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch["text"]), np.uint64, batch.num_rows
            )
            kept = [batch[c] for c in names[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found.view(np.int64))], names)

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), *carried, F.col(text_col).alias("text")
    ).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _fields(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """Bits ``low``..``high`` cut into ``parts`` fields: (first bit, bits)."""
    cuts = [low + (high - low) * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _field_value(fp, first: int, size: int):
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << size) - 1))


class Trees:
    """BK-trees of many shards side by side, built level by level.

    ``shard`` has to be sorted. A node's children differ in their distance to
    it, so (node, distance) identifies an edge.
    """

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        _, root_at, of = np.unique(shard, return_index=True, return_inverse=True)
        parent = root_at[of]
        self.root = parent.copy()
        waiting = np.setdiff1d(np.arange(len(fp)), root_at)
        edges, children = [], []
        while len(waiting):
            up = parent[waiting]
            key = up * 65 + np.bitwise_count(fp[waiting] ^ fp[up]).astype(np.int64)
            found, first, of = np.unique(key, return_index=True, return_inverse=True)
            edges.append(found)
            children.append(waiting[first])
            parent[waiting] = waiting[first][of]
            left = np.ones(len(waiting), bool)
            left[first] = False
            waiting = waiting[left]
        edge = np.concatenate([np.zeros(0, np.int64), *edges])
        order = np.argsort(edge)
        self.edge = edge[order]
        self.child = np.concatenate([np.zeros(0, np.int64), *children])[order]

    def within(self, fp: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple]:
        """(query, node) pairs at most ``radius`` apart, in bounded parts."""
        stack = [(np.arange(len(fp)), root)]
        while stack:
            query, node = stack.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            distance = np.bitwise_count(fp[query] ^ self.fp[node]).astype(np.int64)
            near = distance <= radius
            yield query[near], node[near]
            low = np.searchsorted(self.edge, node * 65 + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.edge, node * 65 + np.minimum(distance + radius, 64), "right")
            width = high - low
            ends = np.cumsum(width)
            if len(ends) and ends[-1]:
                at = np.repeat(low - ends + width, width) + np.arange(ends[-1])
                stack.append((np.repeat(query, width), self.child[at]))


def spanning(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> None:
    """Join the classes of all pairs; ``label`` points to the smallest member."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        low, high = np.minimum(x, y)[open_], np.maximum(x, y)[open_]
        np.minimum.at(label, high, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_EDGES)


def _inside(shards: DataFrame, radius: int) -> DataFrame:
    """Spanning links of whole shards: partitions hold complete shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        shard = np.unique(table["shard"].to_numpy(), return_inverse=True)[1]
        order = np.argsort(shard, kind="stable")
        shard, fp = shard[order], table["fp"].to_numpy()[order].view(np.uint64)
        trees = Trees(shard, fp)
        label = np.arange(len(fp))
        for query, node in trees.within(fp, trees.root, radius):
            spanning(query, node, label)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        yield _edges(fp[linked].view(np.int64), fp[label[linked]].view(np.int64))

    return shards.repartition("shard").mapInArrow(run, "a long, b long")


def _across(shards: DataFrame, radius: int) -> DataFrame:
    """Links of shards beyond one tree: each tree of a shard is sent to all
    chunks of queries of its shard, in groups of one tree and one chunk."""
    chunked = shards.withColumns(
        {
            "chunks": F.ceil(F.col("n") / TREE).cast("int"),
            "mine": F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / TREE)).cast("int"),
        }
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    sent = chunked.select("shard", "fp", "mine", other).select(
        "shard",
        "fp",
        F.least("mine", "other").alias("lower"),
        F.greatest("mine", "other").alias("upper"),
        (F.col("mine") <= F.col("other")).alias("in_tree"),
    )

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        fp = rows["fp"].to_numpy().view(np.uint64)
        tree = rows["in_tree"].to_numpy(zero_copy_only=False)
        same = key[1].as_py() == key[2].as_py()
        place = np.flatnonzero(tree)
        queries = place if same else np.flatnonzero(~tree)
        trees = Trees(np.zeros(len(place), np.int64), fp[place])
        label = np.arange(len(fp))
        root = np.zeros(len(queries) if len(place) else 0, np.int64)
        for query, node in trees.within(fp[queries][: len(root)], root, radius):
            spanning(queries[query], place[node], label)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        found = [_edges(fp[linked].view(np.int64), fp[label[linked]].view(np.int64))]
        return pa.Table.from_batches(found, _EDGES)

    return sent.groupBy("shard", "lower", "upper").applyInArrow(run, "a long, b long")


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``<a, b>`` that span every class of fingerprints within ``radius``.

    Shards agree on one of ``radius + 1`` fields of the bits. A shard above
    ``TREE`` is refined: its members differ in at most ``radius`` of the other
    bits, so they agree on one of ``radius + 1`` fields of those too. A refined
    shard that is still too large is searched tree by tree.
    """
    parts = radius + 1
    fp = F.col("fp")
    first = [
        F.struct(F.lit(i).alias("i"), _field_value(fp, a, n).alias("v"))
        for i, (a, n) in enumerate(_fields(0, 64, parts))
    ]
    coarse = fps.select("fp", F.explode(F.array(*first)).alias("f")).select(
        "fp", F.col("f.i").alias("i"), F.xxhash64("f.i", "f.v").alias("shard")
    )
    coarse = _sized(coarse)
    large = coarse.filter(F.col("n") > TREE)
    second = []
    for i, (a, n) in enumerate(_fields(0, 64, parts)):
        # Turned so that field i is on top, the other bits are the low ones.
        turned = F.shiftrightunsigned(fp, a + n).bitwiseOR(F.shiftleft(fp, 64 - a - n))
        fine = [
            F.struct(F.lit(j).alias("j"), _field_value(turned, p, q).alias("w"))
            for j, (p, q) in enumerate(_fields(0, 64 - n, parts))
        ]
        second.append(F.when(F.col("i") == i, F.array(*fine)))
    refined = large.select(
        "fp", "shard", F.explode(F.coalesce(*second)).alias("f")
    ).select("fp", F.xxhash64("shard", "f.j", "f.w").alias("shard"))
    refined = _sized(refined)
    return (
        _inside(coarse.filter(F.col("n").between(2, TREE)).select("shard", "fp"), radius)
        .union(_inside(refined.filter(F.col("n").between(2, TREE)).select("shard", "fp"), radius))
        .union(_across(refined.filter(F.col("n") > TREE), radius))
    )


def _sized(shards: DataFrame) -> DataFrame:
    """Adds the number of members ``n`` of the shard, counted before the shuffle."""
    sizes = shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return settle(shards.join(sizes, "shard"))


def components(marked: DataFrame, radius: int) -> DataFrame:
    """``marked`` (with ``doc_id`` and ``fp``) and the class of each row:
    ``label`` is its smallest fingerprint, ``component_id`` its smallest id."""
    fps = settle(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    )
    found = settle(links(fps.select("fp"), radius))
    nodes = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    classes = connected(nodes.withColumn("seed", F.col("node")), found)
    named = fps.join(classes.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp")
    )
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    # Distinct fingerprints meet their class here, rows only their fingerprint.
    sized = settle(named.join(names, "label").select("fp", "label", "component_id", "rows"))
    return attach(marked, sized, ["fp"], "rows", hot_rows=1_000)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """``<doc_id, fingerprint, component_id>``: documents linked through
    fingerprints at most ``radius`` bits apart, directly or in steps.

    The component is named by the smallest id in it. Null and empty texts have
    fingerprint zero and are linked like others; null ids are ignored when the
    component is named (null where all are); repeated rows appear each. Empty
    tables give no rows, other columns are ignored.
    """
    marked = settle(fingerprints(docs, id_col, text_col, shingle))
    return components(marked, radius).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
) -> DataFrame:
    """The input with one document of each component: the one with the
    smallest id (nulls last, then the smallest hash of its text). Rows equal
    in id and text are one document. Null and empty texts are near copies of
    each other, an empty table gives no rows, other columns may have any name."""
    # Names of the input are only looked up in the struct, so none can clash.
    rows = docs.select(F.struct("*").alias("row"))
    doc = F.col("row").getField(id_col).cast("long")
    text = F.col("row").getField(text_col)
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    named = rows.select(doc.alias("doc_id"), text.alias("text"), key.alias("key"))
    marked = settle(fingerprints(named, "doc_id", "text", shingle, ["key"]))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    kept = components(marked, radius).groupBy("label").agg(first)
    kept = kept.select(F.col("first.doc_id").alias("kept_doc"), F.col("first.key").alias("kept_key"))
    same = doc.eqNullSafe(F.col("kept_doc")) & (key == F.col("kept_key"))
    return rows.join(kept, same, "left_semi").select("row.*")
