"""Text record files: documents, queries, judgments and ranked runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions.numbering import numbered

# --- fixed values -----------------------------------------------------------
RECORD_MARK = ".I "
BODY_MARK = ".W"
SCORE_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# ----------------------------------------------------------------------------


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """``<source_id, text>`` of a tagged file (S-1).

    ``.I <id>`` starts a record, a ``.W`` line starts its body. The record
    mark is the line separator, so a large file is read in splits. Sections
    before ``.W`` are skipped; a record may have an empty body.
    """
    records = spark.read.option("lineSep", "\n" + RECORD_MARK).text(path)
    # Line ends may be those of Windows.
    record = F.regexp_replace(F.regexp_replace("value", r"\r(\n|\z)", "$1"), r"^\.I ", "")
    return records.select(
        F.regexp_extract(record, r"^\s*(\S+)", 1).alias("source_id"),
        F.rtrim(
            F.coalesce(F.get(F.split(record, r"\n\.W *(?:\n|$)", 2), F.lit(1)), F.lit("")),
            F.lit("\n"),
        ).alias("text"),
    ).filter(F.col("source_id") != "")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``<doc_id, text>``; the id of the record is kept (S-1)."""
    return read_tagged(spark, path).select(F.col("source_id").cast("bigint").alias("doc_id"), "text")


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """``<query_id, source_id, text>``; ``query_id`` is the 1-based position in
    ascending id order (S-2)."""
    order = [F.col("source_id").cast("bigint"), F.col("source_id")]
    return numbered(read_tagged(spark, path), order, "query_id").select(
        F.col("query_id").cast("bigint").alias("query_id"), "source_id", "text"
    )


def write_tagged(df: DataFrame, id_col: str, text_col: str, path: str) -> None:
    """Write records in the form ``read_tagged`` reads, ordered by id."""
    body = F.concat(
        F.lit(RECORD_MARK), F.col(id_col).cast("string"), F.lit("\n" + BODY_MARK + "\n"), text_col
    )
    df.repartitionByRange(id_col).sortWithinPartitions(id_col).select(
        body.alias("value")
    ).write.text(path)


def _fields(spark: SparkSession, path: str) -> DataFrame:
    # Exploded, so that the line is split once and not again in every condition.
    fields = F.split(F.rtrim(F.col("value")), " +")
    return spark.read.text(path).filter(F.trim("value") != "").select(
        "value", F.explode(F.array(fields)).alias("f")
    )


def _split_rows(fields: DataFrame, good: Column, values: list[Column]) -> tuple[DataFrame, DataFrame]:
    """Rows of the good lines whose values all fit, and the other lines."""
    fits = (F.size("f") == 3) & good
    for value in values:
        fits &= value.isNotNull()
    checked = fields.withColumn("good", F.coalesce(fits, F.lit(False)))
    rejected = checked.filter(~F.col("good")).select(F.col("value").alias("line"))
    return checked.filter("good").select(*values), rejected


def _strictly(rows: DataFrame, rejected: DataFrame, strict: bool) -> DataFrame:
    if not strict:
        return rows
    # The first line, by one job over all splits: where no line is rejected,
    # first() would go through them a few at a time.
    placed = rejected.withColumn("_at", F.monotonically_increasing_id())
    bad = placed.agg(F.min_by("line", "_at").alias("line")).first()["line"]
    if bad is not None:
        raise ValueError(f"each line should hold three numbers: {bad!r}")
    return rows


def _number(at: int, kind: str, name: str) -> Column:
    return F.get("f", F.lit(at)).try_cast(kind).alias(name)


def check_judgments(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Split judgment lines into good rows and rejected lines (S-3)."""
    values = [_number(0, "bigint", "query_id"), _number(1, "bigint", "doc_id"), _number(2, "int", "code")]
    return _split_rows(_fields(spark, path), F.lit(True), values)


def read_judgments(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``<query_id, doc_id, code>`` from lines of exactly three blank-separated
    numbers (S-3). With ``strict`` any other line raises an error that quotes it."""
    return _strictly(*check_judgments(spark, path), strict)


def write_judgments(judgments: DataFrame, path: str) -> None:
    """One ``query doc code`` line per row."""
    judgments.select(F.concat_ws(" ", "query_id", "doc_id", "code").alias("value")).write.text(path)


def check_run(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Split run lines into good rows and rejected lines (S-5)."""
    fields = _fields(spark, path)
    digits = r"^\p{Nd}+$"
    good = (
        F.get("f", F.lit(0)).rlike(digits)
        & F.get("f", F.lit(1)).rlike(digits)
        & F.get("f", F.lit(2)).rlike(SCORE_PATTERN)
    )
    values = [
        _number(0, "bigint", "query_id"),
        _number(1, "bigint", "doc_id"),
        _number(2, "double", "score"),
    ]
    return _split_rows(fields, good, values)


def read_run(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """``<query_id, doc_id, score>`` of a ranked run (S-4).

    Ranks come from the scores, not from the order of the lines. With
    ``strict`` a malformed line raises an error that quotes it.
    """
    return _strictly(*check_run(spark, path), strict)


def write_run(run: DataFrame, path: str) -> None:
    """One ``query doc score`` line per row with a blank at its end, best first
    within each query (S-6)."""
    order = ["query_id", F.desc("score"), "doc_id"]
    line = F.concat(F.concat_ws(" ", "query_id", "doc_id", "score"), F.lit(" "))
    run.repartitionByRange(*order).sortWithinPartitions(*order).select(
        line.alias("value")
    ).write.text(path)
