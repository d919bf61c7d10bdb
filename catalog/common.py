"""Table access and SQL fragments shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.functions.text import PUNCTUATION, STOP_WORDS, WORD_PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


PATTERN = quoted(WORD_PATTERN)
STOPPED = ", ".join(quoted(w) for w in [*STOP_WORDS, *PUNCTUATION])
NUMBER = quoted(r"-?\p{Nd}+")


def kept(token: str) -> str:
    return f"lower({token}) not in ({STOPPED}) and not regexp_full_match({token}, {NUMBER})"


def tokens_of(text: str) -> str:
    """SQL list of the kept tokens of a text expression."""
    return f"list_filter(regexp_extract_all({text}, {PATTERN}), lambda t: {kept('t')})"


# Term counts, idf on both sides and the scores of all pairs.
SCORED = f"""
dtok as (select doc_id, unnest(regexp_extract_all(text, {PATTERN})) as term from documents),
dtf as (select doc_id, term, count(*) as tf from dtok where {kept('term')} group by all),
didf as (select term, count(*) as df,
                ln((select count(*) from documents)::double / count(*)) as idf
         from dtf group by term),
qtok as (select item_id as query_id, unnest(regexp_extract_all(text, {PATTERN})) as term
         from benchmark),
qtf as (select query_id, term, count(*)::double as qtf from qtok where {kept('term')}
        group by all),
qidf as (select term, count(*) as df,
                ln((select count(*) from benchmark)::double / count(*)) as idf
         from qtf group by term),
qw as (select query_id, term, qtf, qtf * idf as qw from qtf join qidf using (term)),
qn as (select query_id, sqrt(sum(qtf * qw * qw)) as n1 from qw group by query_id),
sums as (select query_id, doc_id, sum(qtf * qw * (tf * idf)) as dot,
                sqrt(sum(qtf * (tf * idf) * (tf * idf))) as n2
         from qw join dtf using (term) join didf using (term) group by all),
scores as (select * from (
             select query_id, doc_id,
                    round(case when n1 * n2 = 0 then 0 else dot / (n1 * n2) end, 12) as score
             from sums join qn using (query_id)) where score > 0)
"""
