"""Index storage and learning tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.functions.numbering import numbered
from gleanwork.operators.index import BLOCK_SIZE


POSTINGS = "term string, block bigint, doc_ids array<bigint>"


def write_index(index: DataFrame, path: str) -> None:
    """Parquet sorted by term (S-7), and a directory of its files.

    ``path/postings`` holds the blocks, ordered over all files, so a file
    covers a range of terms. ``path/terms`` has one row per file: its name, its
    first and its last term.
    """
    spark = index.sparkSession
    ordered = index.select("term", "block", "doc_ids").repartitionByRange("term", "block")
    ordered.sortWithinPartitions("term", "block").write.parquet(f"{path}/postings")
    named = read_index(spark, path).select("term", F.col("_metadata.file_name").alias("file"))
    ranges = named.groupBy("file").agg(F.min("term").alias("first"), F.max("term").alias("last"))
    ranges.repartitionByRange("first").sortWithinPartitions("first").write.parquet(f"{path}/terms")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``<term, block, doc_ids>`` as written by ``write_index``."""
    return spark.read.schema(POSTINGS).parquet(f"{path}/postings")


def postings_of(spark: SparkSession, path: str, words: Sequence[str]) -> DataFrame:
    """The rows of ``read_index`` whose term is in ``words``, from those files
    alone whose range of terms holds one of them.

    The directory is searched by Spark; only names of files that hold a word's
    range come to the driver. Null, unknown and repeated words find nothing
    more; without words or files there are no rows.
    """
    wanted = sorted({w for w in words if w is not None})
    ranges = spark.read.schema("file string, first string, last string").parquet(f"{path}/terms")
    holds = [F.lit(w).between(F.col("first"), F.col("last")) for w in wanted]
    files = [r["file"] for r in ranges.filter(F.array_contains(F.array(*holds), True)).collect()] if holds else []
    if not files:
        return spark.createDataFrame([], POSTINGS)
    found = spark.read.schema(POSTINGS).parquet(*[f"{path}/postings/{name}" for name in files])
    return found.filter(F.col("term").isin(wanted))


def write_index_csv(index: DataFrame, path: str) -> None:
    """CSV with row number, term, block and the documents as text (S-7)."""
    rows = numbered(index, [F.col("term"), F.col("block")], "row_no").select(
        (F.col("row_no") - 1).alias("row_no"),
        F.col("term").alias("Term"),
        F.col("block").alias("Block"),
        F.concat(F.lit("["), F.array_join("doc_ids", ", "), F.lit("]")).alias("Document"),
    )
    rows.write.option("header", True).option("escape", '"').csv(path)


def _block_of(doc_id: Column) -> Column:
    return F.floor(doc_id / F.lit(BLOCK_SIZE))


def read_index_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read that CSV and turn the document text into numbers again (S-8).

    Columns are found by their names. Without ``Block`` a term's documents are
    cut into blocks here. Text that is no list of numbers raises an error.
    """
    lines = spark.read.option("header", True).option("escape", '"').csv(path)
    listed = F.from_json("Document", T.ArrayType(T.LongType()))
    message = F.concat(F.lit("no list of documents: "), F.coalesce("Document", F.lit("nothing")))
    bad = listed.isNull() | F.exists(listed, lambda d: d.isNull())
    doc_ids = F.when(bad, F.raise_error(message)).otherwise(listed)
    if "Block" in lines.columns:
        return lines.select(
            F.col("Term").alias("term"), F.col("Block").cast("bigint").alias("block"), doc_ids.alias("doc_ids")
        )
    whole = lines.select(F.col("Term").alias("term"), doc_ids.alias("all_ids"))
    blocks = F.array_distinct(F.transform("all_ids", _block_of))
    return whole.select("term", "all_ids", F.explode(blocks).alias("block")).select(
        "term",
        "block",
        F.filter("all_ids", lambda d: _block_of(d) == F.col("block")).alias("doc_ids"),
    )


# --- fixed values -----------------------------------------------------------
MISSING_MARKS = ["", "NA", "N/A", "n/a", "NaN", "nan", "-nan", "NULL", "null", "None", "<NA>", "#N/A"]
# ----------------------------------------------------------------------------

#: Types tried in this order; the first that all values of a column fit.
INFERRED = ["int", "bigint", "double", "boolean", "timestamp"]


def read_table_csv(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool = True
) -> DataFrame:
    """A learning table with a header row (S-9).

    Quotes in quoted fields are doubled. The missing marks become NULL in every
    column. Types are inferred in one pass over all rows unless a schema is
    given; a value that does not fit a given type raises an error. Fields may
    hold line ends; without them ``multi_line=False`` lets one large file be
    read by many tasks.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    raw = reader.csv(path)
    text = raw.select(
        *[F.when(~F.col(f"`{c}`").isin(MISSING_MARKS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )
    if schema:
        wanted = spark.createDataFrame([], schema).schema
        return text.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])
    tried = text.agg(
        *[
            F.array(*[F.count(F.col(f"`{c}`").try_cast(t)) for t in ("string", *INFERRED)]).alias(f"c{i}")
            for i, c in enumerate(text.columns)
        ]
    ).first()
    kinds = [
        next((t for t, n in zip(INFERRED, fits[1:]) if n == fits[0] > 0), "string") for fits in tried
    ]
    return text.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in zip(text.columns, kinds)])


def write_table_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row in every part file."""
    df.write.option("header", True).option("escape", '"').csv(path)
