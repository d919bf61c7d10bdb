"""WARC archives with revisit records and a globally ordered capture index.

Archives are written and read by Spark's own file sources, so they can lie in
any store that Spark reaches. Every archive yields a locally sorted capture
run; the runs are merged by a loser tree, one key range per task.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm.exact import split_join
from gleanwork.session import scratch_path, settle

#: Records per archive. An archive is read by one task as a whole.
ARCHIVE_RECORDS = 1_000

_END = "\r\n\r\n"
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # RFC 4648


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hexadecimal, without a UDF: 20 bytes
    are 32 digits of 5 bits, taken from groups of 5 bytes."""
    digits = []
    for at in range(0, 40, 10):
        value = F.conv(F.substring(hexadecimal, at + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)).cast("int")
            digits.append(F.substring(F.lit(_DIGITS), place + 1, F.lit(1)))
    return F.concat(*digits)


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date_col: str | None = None,
    least_bytes: int = 0,
) -> DataFrame:
    """One WARC/1.1 record per page as ``<record>`` text, without its end mark.

    Of the records with equal payloads of at least ``least_bytes`` bytes, the
    one with the largest id is a response, the others revisit it; smaller ones
    are all responses. A null payload or URL is empty. Rows with a null id
    and rows that repeat the kept id are responses of their own. ``date_col``
    is a timestamp; without it, and where it is null, the id counts seconds
    since 1970.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    seconds = F.coalesce(F.col(id_col), F.lit(0)).cast("long")
    date = F.timestamp_seconds(F.pmod(seconds, F.lit(4_102_444_800)))
    if date_col:
        date = F.coalesce(F.col(date_col), date)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), r"[\r\n]", " ").alias("url"),
        payload.alias("payload"),
        date.alias("date"),
    ).withColumns(
        {"digest": base32(F.sha1("payload")), "bytes": F.octet_length("payload").cast("long")}
    )
    able = (F.col("bytes") >= least_bytes) & F.col("id").isNotNull()
    copies = settle(
        rows.filter(able)
        .groupBy("digest", "bytes")
        .agg(F.max("id").alias("kept"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    total = copies.agg(F.sum("_n").alias("n")).first()["n"] or 0
    marked = split_join(rows, copies, ["digest", "bytes"], total, 64)
    refers = F.coalesce(able & (F.col("id") < F.col("kept")), F.lit(False))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))

    stamp = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    common = [
        line("WARC-Record-ID", urn("id")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", stamp),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
    ]
    head = F.concat(
        F.when(refers, F.lit("WARC/1.1\r\nWARC-Type: revisit\r\n")).otherwise(
            F.lit("WARC/1.1\r\nWARC-Type: response\r\n")
        ),
        *common,
    )
    response = F.concat(
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.col("bytes").cast("string")),
        F.lit("\r\n"),
        F.col("payload"),
    )
    revisit = F.concat(
        line("WARC-Refers-To", urn("kept")),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        line("Content-Length", F.lit("0")),
        F.lit("\r\n"),
    )
    return marked.select(
        F.concat(head, F.when(refers, revisit).otherwise(response)).alias("record")
    )


def write_archives(found: DataFrame, path: str) -> None:
    """Write records as gzip archives of at most ``ARCHIVE_RECORDS`` records.
    The two line ends after each record are the separator of Spark's text files."""
    found.write.option("lineSep", _END).option("compression", "gzip").option(
        "maxRecordsPerFile", ARCHIVE_RECORDS
    ).text(path)


def url_key(url: str) -> str:
    """Host labels reversed, then the path and query: org,example)/a?b."""
    try:
        cut = urlsplit(url.strip().lower() if "://" in url else f"//{url.strip().lower()}")
        host = ",".join(reversed((cut.hostname or "").split(".")))
        port = f":{cut.port}" if cut.port and cut.port not in (80, 443) else ""
    except ValueError:  # not a URL: it is its own key
        return url
    return f"{host}{port}){cut.path or '/'}" + (f"?{cut.query}" if cut.query else "")


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record; blocks may hold any bytes."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = head_end + 4
        end = begin + int(headers["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has no end mark")
        yield at, headers, data[begin:end]
        at = end + 4


_INDEX = (
    "run long, place long, url_key string, captured string, page_id long, record_type string, "
    "refers_to long, payload_bytes long, payload_digest string, archive string, record_offset long"
)
_INDEX_ARROW = pa.schema(
    [
        ("run", pa.int64()),
        ("place", pa.int64()),
        ("url_key", pa.string()),
        ("captured", pa.string()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("archive", pa.string()),
        ("record_offset", pa.int64()),
    ]
)


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """One locally sorted run of captures per archive.

    Digest and length of a response are taken from its bytes, and a record
    whose stated digest differs stops the job; those of a revisit are the
    stated ones of the full payload.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip

        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = []
                for offset, head, block in parse(gzip.decompress(content.as_py())):
                    digest = head["warc-payload-digest"].removeprefix("sha1:")
                    size, refers = len(block), None
                    if head["warc-type"] == "revisit":
                        size, refers = int(head["x-payload-length"]), _page(head["warc-refers-to"])
                    elif base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
                        raise ValueError(f"digest differs: {name.as_py()} at byte {offset}")
                    key = url_key(head["warc-target-uri"])
                    page = _page(head["warc-record-id"])
                    rows.append(
                        (key, head["warc-date"], page, head["warc-type"], refers, size, digest)
                        + (name.as_py(), offset)
                    )
                rows.sort(key=lambda r: (*_order(r), r[8]))
                run = int.from_bytes(hashlib.sha1(name.as_py().encode()).digest()[:7], "big")
                columns = [[run] * len(rows), range(len(rows)), *zip(*rows)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, _INDEX_ARROW)],
                        schema=_INDEX_ARROW,
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(read, _INDEX)


def _order(row: tuple) -> tuple:
    """URL key, time, page; captures without a page come first."""
    return row[0], row[1], row[2] is not None, row[2] or 0


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, so
    the next item costs one match per level."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * len(self.runs)
        self.winner = self._play(1) if self.runs else -1

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or (x[0], a) < (y[0], b))

    def _play(self, node: int) -> int:
        size = len(self.runs)
        if node >= size:
            return node - size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple]:
        size = len(self.runs)
        while size and self.heads[self.winner] is not None:
            yield self.heads[self.winner]
            won = self.winner
            self.heads[won] = next(self.runs[won], None)
            node = (won + size) // 2
            while node:
                if self._beats(self.losers[node], won):
                    self.losers[node], won = won, self.losers[node]
                node //= 2
            self.winner = won


def merged_index(runs: DataFrame) -> DataFrame:
    """All runs merged by URL key, time and page: the partitions are key
    ranges in ascending order, and ``place`` counts within ``range``.

    Ranges are cut on the whole order, so one URL or host with a third of all
    captures still spreads. A task holds the captures of its own range.
    """
    fields = [f for f in _INDEX_ARROW if f.name not in ("run", "place")]
    schema = pa.schema([("range", pa.int64()), ("place", pa.int64()), *fields])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        segments: dict[int, list[tuple]] = {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for run, *row in zip(*columns):
                segments.setdefault(run, []).append((_order(row[1:]), row[1:]))
        rows, place = [], 0
        for _, row in LoserTree(segments[r] for r in sorted(segments)):
            rows.append((part, place, *row))
            place += 1
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                )
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
            )

    ddl = _INDEX.replace("run long", "range long")
    ranged = runs.repartitionByRange("url_key", "captured", F.col("page_id").asc_nulls_first())
    # Runs come in their own order; only the merge orders across runs.
    return ranged.sortWithinPartitions("run", "place").mapInArrow(merge, ddl)


def archive_pages(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date_col: str | None = None,
    least_bytes: int = 0,
) -> DataFrame:
    """Write the pages as WARC archives under ``path`` (by default a new
    folder in the shared scratch space), read them back and return the merged
    capture index. An empty table gives no captures."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(records(pages, id_col, url_col, payload_col, date_col, least_bytes), path)
    return merged_index(settle(capture_runs(spark, path)))
