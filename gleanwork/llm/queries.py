"""Registered queries of the corpus operators, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanwork.llm import alignment, edits, exact, katz, lexicon, packing, quality, repair
from gleanwork.llm import runindex, sharding, simhash, substring, warc


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.token_pieces(docs, tokenizer(), capacity=1024)
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids", "row")
    return packing.pack(digests, 1024).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return quality.quality(docs).select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op3_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = exact.exact_duplicates(docs)
    return found.select(
        "row.doc_id",
        "keep_id",
        "group_size",
        (F.col("row.doc_id") == F.col("keep_id")).alias("kept"),
        F.sha2(exact.normalised("row.text"), 256).alias("text_sha256"),
    )


def op4_warc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.archive_pages(pages, least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_bk_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, radius=2)


def op6_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda acc, s: acc + F.get(s, F.lit(1)) - F.get(s, F.lit(0))
    )
    return substring.repeated_passages(docs, span=13).select(
        "row.doc_id",
        "n_words",
        removed.alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op7_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    trees = edits.build_trees(docs, tokenizer())
    before = trees.withColumn("row", F.struct("row.doc_id", "row.text", "n_tokens"))
    return edits.edit_counts(before, tokenizer(), edits.redactions()).select(
        "row.doc_id",
        F.col("row.n_tokens").alias("n_tokens_before"),
        "n_edits",
        "n_reencoded",
        "n_tokens",
        F.crc32(F.col("text").cast("binary")).alias("edited_crc32"),
    )


def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_corpus(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("same"),
    )
    return sharding.balanced_shards(docs, F.col("same"), 8).select(
        "row.doc_id",
        "row.size",
        "row.text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return lexicon.encode_documents(docs, tokenizer()).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_viterbi_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair(rows)


def op12_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = public_tokenizers.path("piece_bpe_32k.model")
    return alignment.aligned(docs, tokenizer(), pieces).select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


def op13_run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    removed = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda acc, s: acc + F.get(s, F.lit(1)) - F.get(s, F.lit(0))
    )
    return runindex.repeated_bytes(docs, span=100).select(
        "row.doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_kk_packing,
        op2_divergence_rules,
        op3_radix_dedup,
        op4_warc_merge,
        op5_bk_simhash,
        op6_seed_extend,
        op7_edit_token_counts,
        op8_katz_scores,
        op9_label_shards,
        op10_transducer_bpe,
        op11_viterbi_repair,
        op12_cut_alignment,
        op13_run_index_dedup,
    )
}

_LOWER = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op3_radix_dedup": f"""
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = max(doc_id) over same as kept, sha256({_LOWER}) as text_sha256
        from documents window same as (partition by {_LOWER})
    """,
    "op4_warc_merge": """
        with p as (select page_id, coalesce(html, '') as html from pages),
        g as (select html, max(page_id) as kept from p group by html),
        hashed as (select html, kept, sha1(html) as h from g),
        digits as (select html, kept,
                array_to_string(list_transform(range(32), lambda i: substr(
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                    1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::int, 10))::ubigint
                        >> (35 - 5 * (i % 8))::int) & 31)::int, 1)), '') as digest
            from hashed)
        select page_id, octet_length(encode(html))::bigint as payload_bytes,
               digest as payload_digest,
               case when page_id = kept then 'response' else 'revisit' end as record_type,
               case when page_id <> kept then kept end as refers_to
        from p join digits using (html)
    """,
    "op6_seed_extend": f"""
        with w as (select doc_id, {_WORDS} as words from documents),
        starts as (select doc_id, unnest(range(1, len(words) - 11)) as s, words
                   from w where len(words) >= 13),
        runs as (select doc_id, s, array_to_string(words[s:s+12], ' ') as run from starts),
        least as (select run, min(doc_id) as first from runs group by run),
        gone as (select distinct doc_id, unnest(range(s, s + 13)) as i
                 from runs join least using (run) where first < doc_id),
        sets as (select doc_id, list(i) as gone from gone group by doc_id)
        select doc_id, len(words)::bigint as n_words,
               coalesce(len(gone), 0)::bigint as n_removed,
               sha256(coalesce(array_to_string(list_filter(words, lambda x, i:
                   not list_contains(coalesce(gone, []), i)), ' '), '')) as kept_sha256
        from w left join sets using (doc_id)
    """,
    "op13_run_index_dedup": """
        with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
        starts as (select doc_id, h, unnest(range(0, len(h) // 2 - 99)) as s from d),
        windows as (select doc_id, s, substr(h, 2 * s + 1, 200) as w from starts),
        later as (select doc_id, s, (doc_id, s) > min((doc_id, s)) over (partition by w) as gone
                  from windows),
        joined as (select doc_id, s, sum(fresh) over (partition by doc_id order by s) as run
                   from (select doc_id, s, (s > coalesce(lag(s) over (
                            partition by doc_id order by s), -101) + 100)::int as fresh
                         from later where gone)),
        spans as (select doc_id, min(s) as a, max(s) + 100 as b from joined group by doc_id, run),
        gaps as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as a,
                        a as b from spans
                 union all select doc_id, max(b), 2000000000 from spans group by doc_id),
        kept as (select doc_id,
                        string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' order by a) as h
                 from gaps join d using (doc_id) group by doc_id),
        sums as (select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans
                 from spans group by doc_id)
        select doc_id, (len(d.h) // 2)::bigint as n_bytes,
               coalesce(n_removed, 0)::bigint as n_removed,
               coalesce(n_spans, 0)::bigint as n_spans,
               sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
        from d left join sums using (doc_id) left join kept using (doc_id)
    """,
}
