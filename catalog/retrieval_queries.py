"""Sources, tokens, index, ranking and evaluation on documents and benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.common import NUMBER, PATTERN, SCORED, STOPPED, corpus, kept, table, tokens_of, topics
from gleanwork.functions import text as tx
from gleanwork.functions.joins import bounded_broadcast
from gleanwork.operators import evaluation, index, ranking, terms
from gleanwork.plans import retrieval
from gleanwork.session import scratch_path, settle, spread
from gleanwork.sources import records, stores

QUERIES = {}
ORACLES = {}


def register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


# --- sources and sinks ------------------------------------------------------


@register("s1_tagged_documents", "select doc_id, rtrim(text, chr(10)) as text from documents")
def tagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    records.write_tagged(corpus(spark, sf_dir), "doc_id", "text", path)
    return records.read_documents(spark, path)


@register(
    "s2_tagged_queries",
    """select row_number() over (order by item_id) as query_id, item_id::varchar as source_id,
              rtrim(text, chr(10)) as text
       from benchmark""",
)
def tagged_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "queries")
    records.write_tagged(topics(spark, sf_dir), "query_id", "text", path)
    return records.read_queries(spark, path)


@register(
    "s3_judgments",
    "select l_orderkey as query_id, l_partkey as doc_id, l_linenumber as code from lineitem",
)
def judgment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "judgments")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("query_id"),
        F.col("l_partkey").alias("doc_id"),
        F.col("l_linenumber").alias("code"),
    )
    # Fields may be set apart by several blanks and end in one.
    rows.select(
        F.concat(
            F.concat_ws(" ", "query_id", "doc_id"), F.lit("  "), F.col("code"), F.lit(" ")
        ).alias("value")
    ).write.text(path)
    return records.read_judgments(spark, path)


RUN_SQL = "select query_id, doc_id, round(score + 2e-13, 9) as score from scores"


@register("s4_ranked_run", f"with {SCORED} {RUN_SQL}")
def ranked_run_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "run")
    records.write_run(scores(spark, sf_dir), path)
    return rounded_score(records.read_run(spark, path))


@register(
    "s5_run_line_check",
    """select event_type = 'error' as rejected, count(*) as n from events group by all""",
)
def run_line_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "run")
    events = table(spark, sf_dir, "events")
    events.select(
        F.concat_ws(
            " ",
            "event_id",
            "user_id",
            F.when(F.col("event_type") == "error", F.lit("none")).otherwise(
                F.col("value").cast("string")
            ),
        ).alias("value")
    ).write.text(path)
    good, rejected = records.check_run(spark, path)
    both = good.select(F.lit(False).alias("rejected")).unionAll(
        rejected.select(F.lit(True).alias("rejected"))
    )
    return both.groupBy("rejected").agg(F.count(F.lit(1)).alias("n"))


@register(
    "s6_run_text",
    f"""with {SCORED}
        select query_id, doc_id, ends_with_blank, fields from (
          select query_id, doc_id, true as ends_with_blank, 3 as fields from scores)""",
)
def run_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "run")
    records.write_run(scores(spark, sf_dir), path)
    fields = F.split(F.rtrim(F.col("value")), " ")
    return spark.read.text(path).select(
        fields[0].cast("bigint").alias("query_id"),
        fields[1].cast("bigint").alias("doc_id"),
        F.endswith("value", F.lit(" ")).alias("ends_with_blank"),
        F.size(fields).alias("fields"),
    )


LETTERS = r"regexp_matches(term, '^\p{L}')"


def index_sql(condition: str = "true") -> str:
    return f"""
    with dtok as (select doc_id, unnest(regexp_extract_all(text, {PATTERN})) as term
                  from documents)
    select term, doc_id // {index.BLOCK_SIZE} as block,
           list_sort(list(distinct doc_id)) as doc_ids
    from dtok where {kept('term')} and {condition} group by all"""


def inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = terms.term_counts(spread(corpus(spark, sf_dir)), "doc_id", "text")
    return index.inverted_index(counts)


@register("s7_index_store", index_sql())
def index_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    stores.write_index(inverted(spark, sf_dir), path)
    return stores.read_index(spark, path)


@register("s8_index_csv", index_sql(LETTERS))
def index_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    stores.write_index_csv(index.letter_terms(inverted(spark, sf_dir)), path)
    return stores.read_index_csv(spark, path)


# --- tokens and counts ------------------------------------------------------

SPLIT = r"""string_split(regexp_replace(text, '([.!?])[\x09-\x0D\x20]+', '\1' || chr(1), 'g'),
            chr(1))"""


@register(
    "t1_sentences",
    f"""with s as (select doc_id, {SPLIT} as parts from documents)
        select doc_id, unnest(generate_series(0, len(parts) - 1))::int as sent_no,
               unnest(parts) as sentence from s""",
)
def sentence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.sentence_rows(corpus(spark, sf_dir), "doc_id", "text")


@register(
    "t2_word_tokens",
    f"""with t as (select doc_id, regexp_extract_all(text, {PATTERN}) as toks from documents)
        select doc_id, unnest(generate_series(0, len(toks) - 1))::int as pos,
               unnest(toks) as token from t""",
)
def word_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        "doc_id", F.posexplode(tx.word_tokens(F.col("text"))).alias("pos", "token")
    )



def tokens_sql(condition: str) -> str:
    return f"""
    with t as (select unnest(regexp_extract_all(text, {PATTERN})) as token from documents)
    select token, count(*) as n from t where {condition} group by token"""


def token_totals(spark: SparkSession, sf_dir: str, keep) -> DataFrame:
    tokens = corpus(spark, sf_dir).select(
        F.explode(tx.word_tokens(F.col("text"))).alias("token")
    )
    return tokens.filter(keep(F.col("token"))).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@register("t3_stop_filter", tokens_sql(f"lower(token) not in ({STOPPED})"))
def stop_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_totals(spark, sf_dir, tx.not_stopped)


@register("t4_number_filter", tokens_sql(f"not regexp_full_match(token, {NUMBER})"))
def number_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_totals(spark, sf_dir, tx.not_number)


@register(
    "t5_document_tokens",
    f"""with s as (select doc_id, {SPLIT} as parts from documents),
        r as (select doc_id, unnest(generate_series(0, len(parts) - 1))::int as sent_no,
                     unnest(parts) as sentence from s),
        k as (select doc_id, sent_no, {tokens_of('sentence')} as toks from r)
        select doc_id, sent_no, unnest(generate_series(0, len(toks) - 1))::int as pos,
               unnest(toks) as token from k where len(toks) > 0""",
)
def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.document_tokens(corpus(spark, sf_dir), "doc_id", "text")


@register(
    "t6_query_tokens",
    f"""with k as (select item_id as query_id, {tokens_of('text')} as toks from benchmark)
        select query_id, unnest(generate_series(0, len(toks) - 1))::int as pos,
               unnest(toks) as token from k where len(toks) > 0""",
)
def query_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.query_tokens(topics(spark, sf_dir), "query_id", "text")


@register("t7_letter_terms", index_sql(LETTERS))
def letter_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.letter_terms(inverted(spark, sf_dir))


@register(
    "t15_scalar_maths",
    """select l_orderkey, l_linenumber, round(ln(l_extendedprice), 8) as log_price,
              round(power(l_quantity, 2), 8) as squared, round(sqrt(l_quantity), 8) as root,
              round(case when l_tax = 0 then 0 else l_discount / l_tax end, 8) as share
       from lineitem""",
)
def scalar_maths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = lambda c, name: F.round(c, 8).alias(name)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rounded(F.log("l_extendedprice"), "log_price"),
        rounded(F.pow("l_quantity", F.lit(2.0)), "squared"),
        rounded(F.sqrt("l_quantity"), "root"),
        rounded(tx.ratio_or_zero(F.col("l_discount"), F.col("l_tax")), "share"),
    )


@register("a1_term_counts", f"with {SCORED} select doc_id, term, tf from dtf")
def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.term_counts(spread(corpus(spark, sf_dir)), "doc_id", "text")


@register("a2_query_term_counts", f"with {SCORED} select query_id, term, qtf from qtf")
def query_term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.query_term_counts(topics(spark, sf_dir), "query_id", "text")


@register(
    "a3_term_maps",
    f"""with {SCORED}
        select doc_id, list(term || '=' || tf order by term) as entries from dtf group by doc_id
        union all
        select doc_id, [] from documents where doc_id not in (select doc_id from dtf)""",
)
def term_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = terms.term_maps(spread(corpus(spark, sf_dir)), "doc_id", "text")
    entries = F.transform(
        F.array_sort(F.map_entries("terms")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return maps.select("doc_id", entries.alias("entries"))


@register("a4_collection_size", "select count(*) as n from documents")
def collection_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.collection_size(corpus(spark, sf_dir))


@register(
    "a5_inverse_frequencies", f"with {SCORED} select term, df, round(idf, 10) as idf from didf"
)
def inverse_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir)
    counts = terms.term_counts(spread(docs), "doc_id", "text")
    return terms.inverse_frequencies(counts, docs).withColumn("idf", F.round("idf", 10))


@register("a6_inverted_index", index_sql())
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inverted(spark, sf_dir)


@register(
    "w10_sorted_vocabulary", f"with {SCORED} select distinct term from dtf order by term"
)
def sorted_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.sorted_vocabulary(inverted(spark, sf_dir))


# --- word search ------------------------------------------------------------

FREQUENT = f"""
{SCORED}, top as (select term, row_number() over (order by df desc, term) as no
                  from didf where regexp_matches(term, '^\\p{{L}}')
                  qualify row_number() over (order by df desc, term) <= 5)
"""


def frequent_words(stored: DataFrame, n: int) -> list[str]:
    """The words found in the most documents."""
    found = index.letter_terms(stored).groupBy("term").agg(F.sum(F.size("doc_ids")).alias("df"))
    return [row["term"] for row in found.orderBy(F.desc("df"), "term").limit(n).collect()]


def stored_index(spark: SparkSession, sf_dir: str, n: int) -> tuple[str, list[str]]:
    """The path of a written index, and its ``n`` most frequent words."""
    path = scratch_path(spark, "index")
    stores.write_index(inverted(spark, sf_dir), path)
    return path, frequent_words(stores.read_index(spark, path), n)


@register(
    "j4_term_lookup",
    f"""with {FREQUENT}
        select term, doc_id // {index.BLOCK_SIZE} as block, list_sort(list(doc_id)) as doc_ids
        from dtf where term = (select term from top where no = 1) group by all""",
)
def term_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, words = stored_index(spark, sf_dir, 1)
    return index.term_lookup(stores.postings_of(spark, path, words), words[0])



def all_words_sql(n: int, order: str = "") -> str:
    return f"""with {FREQUENT}
    select doc_id from dtf join top using (term) where no <= {n}
    group by doc_id having count(*) = {n} {order}"""


@register("j5_documents_with_all", all_words_sql(2))
def documents_with_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, words = stored_index(spark, sf_dir, 5)
    # The unknown third word ends the list.
    words = [*words[:2], "no such word", *words[2:]]
    return index.documents_with_all(stores.postings_of(spark, path, words), words)


@register("w13_sorted_documents", all_words_sql(5, "order by doc_id"))
def sorted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, words = stored_index(spark, sf_dir, 5)
    return index.documents_with_all(stores.postings_of(spark, path, words), words)


# --- ranking ----------------------------------------------------------------


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval.scored_pairs(corpus(spark, sf_dir), topics(spark, sf_dir))


def rounded_score(df: DataFrame) -> DataFrame:
    # Scores have 12 places; the addend keeps them off the halves of the ninth.
    return df.withColumn("score", F.round(F.col("score") + 2e-13, 9))


@register(
    "j1_token_weights",
    f"""with {SCORED},
        k as (select item_id as query_id, {tokens_of('text')} as toks from benchmark),
        p as (select query_id, unnest(generate_series(0, len(toks) - 1))::int as pos,
                     unnest(toks) as token from k where len(toks) > 0)
        select p.query_id, pos, token, coalesce(qtf, 0.0)::double as tf,
               round(coalesce(didf.idf, 0.0), 10) as idf,
               round(coalesce(qtf, 0.0) * coalesce(didf.idf, 0.0), 8) as weight
        from p left join qtf on qtf.query_id = p.query_id and qtf.term = p.token
        left join didf on didf.term = p.token""",
)
def token_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, docs = topics(spark, sf_dir), corpus(spark, sf_dir)
    counts = terms.query_term_counts(queries, "query_id", "text")
    # Looked up in the idf of the documents, where a query term may be missing.
    doc_counts = terms.term_counts(spread(docs), "doc_id", "text")
    idf = terms.inverse_frequencies(doc_counts, docs)
    weights = ranking.token_weights(
        terms.query_tokens(queries, "query_id", "text"), counts, idf
    )
    return weights.withColumn("idf", F.round("idf", 10)).withColumn(
        "weight", F.round("weight", 8)
    )


@register(
    "j2_shared_term_pairs",
    f"""with {SCORED} select query_id, count(*) as documents, sum(doc_id)::bigint as doc_sum
        from scores group by query_id""",
)
def shared_term_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("doc_id").alias("doc_sum")
    )


@register("j3_cosine_scores", f"with {SCORED} {RUN_SQL}")
def cosine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_score(scores(spark, sf_dir))


RANKED = """row_number() over (partition by query_id order by score desc, doc_id)"""


@register(
    "w1_ranked_run",
    f"""with {SCORED} select query_id, doc_id, round(score + 2e-13, 9) as score, {RANKED} as rank
        from scores""",
)
def ranked_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_score(ranking.ranked(scores(spark, sf_dir)))


@register(
    "w2_top_ten",
    f"""with {SCORED} select * from (
          select query_id, doc_id, round(score + 2e-13, 9) as score, {RANKED} as rank from scores
          where score > 0.3) where rank <= 10""",
)
def top_ten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_score(ranking.top_k(scores(spark, sf_dir), 10, 0.3))


@register("t13_score_threshold", f"with {SCORED} {RUN_SQL} where score > 0.5")
def score_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_score(scores(spark, sf_dir).filter(F.col("score") > 0.5))


# --- judgments and evaluation -----------------------------------------------

# Judgments come from shared sentences: a document that holds a sentence of a
# benchmark item is judged relevant, its code is the number of such sentences.
JUDGED = f"""
dsent as (select distinct doc_id, unnest({SPLIT}) as sentence from documents),
qsent as (select distinct item_id as query_id, unnest({SPLIT}) as sentence from benchmark),
judged as (select query_id, doc_id, least(4, count(*))::int as code
           from qsent join dsent using (sentence) group by all)
"""


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_sentences = (
        terms.sentence_rows(spread(corpus(spark, sf_dir)), "doc_id", "text")
        .select("doc_id", "sentence")
    )
    query_sentences = (
        terms.sentence_rows(topics(spark, sf_dir), "query_id", "text")
        .select("query_id", "sentence")
        .distinct()
    )
    shared = doc_sentences.join(bounded_broadcast(query_sentences), "sentence").distinct()
    return shared.groupBy("query_id", "doc_id").agg(
        F.least(F.lit(4), F.count(F.lit(1))).cast("int").alias("code")
    )


@register(
    "t14_known_judgments",
    f"""with {JUDGED} select * from judged
        where doc_id in (select doc_id from labels)
          and doc_id <= (select count(*) from labels)""",
)
def known_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    judged = evaluation.within_corpus(judgments(spark, sf_dir), labels)
    return evaluation.within_corpus(judged, labels.count())


@register(
    "j6_distinct_judgments",
    f"""with {SCORED}, {JUDGED}
        select query_id, doc_id, round(max(score) + 2e-13, 9) as score
        from scores join judged using (query_id, doc_id) group by all""",
)
def distinct_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judgments(spark, sf_dir)
    # Every pair twice, once more with another code and a lower score.
    repeated = judged.unionAll(judged.withColumn("code", F.lit(-1)))
    run = scores(spark, sf_dir).withColumn(
        "score", F.explode(F.array(F.col("score"), F.col("score") / 2))
    )
    pairs = evaluation.distinct_judgments(repeated)
    return rounded_score(evaluation.distinct_run(run).join(pairs, ["query_id", "doc_id"]))


@register(
    "j7_marked_hits",
    f"""with {SCORED}, {JUDGED},
        r as (select query_id, count(*) as n_relevant from judged group by query_id)
        select query_id, doc_id, round(score + 2e-13, 9) as score, (code is not null)::int as hit,
               n_relevant
        from scores join r using (query_id) left join judged using (query_id, doc_id)""",
)
def marked_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_score(
        evaluation.marked_hits(scores(spark, sf_dir), judgments(spark, sf_dir))
    )


HIGH_RUN = "hrun as (select query_id, doc_id from scores where score > 0.9)"


@register(
    "j8_unanswered",
    f"""with {SCORED}, {JUDGED}, {HIGH_RUN}
        select distinct query_id from judged
        where query_id not in (select query_id from hrun)""",
)
def unanswered(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = scores(spark, sf_dir).filter(F.col("score") > 0.9)
    return evaluation.unanswered(judgments(spark, sf_dir), run)


MILESTONES = "[" + ", ".join(f"{m!r}::double" for m in evaluation.MILESTONES) + "]"


def running_sql(k: int, e: float, judged: str = "judged") -> str:
    return f"""
    r as (select query_id, count(*) as n_relevant from {judged} group by query_id),
    top as (select * from (select *, {RANKED} as rank from scores where score > {e}::double)
            where rank <= {k}),
    hits as (select query_id, doc_id, score, rank, (j.doc_id is not null)::int as hit, n_relevant,
                    sum((j.doc_id is not null)::int)
                      over (partition by query_id order by rank)::double as hits
             from top join r using (query_id)
             left join (select distinct query_id, doc_id from {judged}) j using (query_id, doc_id)),
    running as (select query_id, doc_id, score, rank, hit, hits, n_relevant,
                       hits / rank as precision, hits / n_relevant as recall,
                       case when hit = 1 then len(list_filter({MILESTONES},
                         lambda m: m >= (hits - 1) / n_relevant and m < hits / n_relevant))
                       else 0 end as crossed
                from hits),
    perq as (select query_id,
                    case when sum(crossed) > 0
                         then sum(precision * crossed) / sum(crossed) end as average_precision,
                    coalesce(sum(hit) filter (where rank <= n_relevant), 0)::double
                      / max(n_relevant) as recorded_recall
             from running group by query_id)"""


def running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.running_scores(
        ranking.top_k(scores(spark, sf_dir), 100, 0.1), judgments(spark, sf_dir)
    )


@register(
    "w3_running_scores",
    f"""with {SCORED}, {JUDGED}, {running_sql(100, 0.1)}
        select query_id, doc_id, rank, hit, hits::bigint as hits,
               round(precision, 9) as precision, round(recall, 9) as recall from running""",
)
def running_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running(spark, sf_dir).select(
        "query_id",
        "doc_id",
        "rank",
        "hit",
        "hits",
        F.round("precision", 9).alias("precision"),
        F.round("recall", 9).alias("recall"),
    )


@register(
    "w4_crossed_milestones",
    f"""with {SCORED}, {JUDGED}, {running_sql(100, 0.1)}
        select query_id, rank, crossed::int as crossed from running where hit = 1""",
)
def crossed_milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running(spark, sf_dir).filter("hit = 1").select("query_id", "rank", "crossed")


PER_QUERY = f"with {SCORED}, {JUDGED}, {running_sql(100, 0.1)} "


@register(
    "w5_average_precision",
    PER_QUERY + "select query_id, round(average_precision, 9) as average_precision from perq",
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.query_scores(running(spark, sf_dir)).select(
        "query_id", F.round("average_precision", 9).alias("average_precision")
    )


@register(
    "w6_recorded_recall",
    PER_QUERY + "select query_id, round(recorded_recall, 9) as recorded_recall from perq",
)
def recorded_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.query_scores(running(spark, sf_dir)).select(
        "query_id", F.round("recorded_recall", 9).alias("recorded_recall")
    )


@register(
    "j9_without_precision",
    f"""with {SCORED}, {JUDGED}, {running_sql(3, 0.1)}
        select query_id from perq where average_precision is null""",
)
def without_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = ranking.top_k(scores(spark, sf_dir), 3, 0.1)
    shallow = evaluation.running_scores(run, judgments(spark, sf_dir))
    return evaluation.without_precision(evaluation.query_scores(shallow))


def means_sql(judged: str = "judged") -> str:
    return f"""
    grid as (select e.e as threshold, k.k as depth
             from (select unnest([0.3, 0.4, 0.5, 0.6, 0.7])::double as e) e,
                  (select unnest([3, 5, 10, 30, 50, 100]) as k) k),
    r as (select query_id, count(*) as n_relevant from {judged} group by query_id),
    top as (select * from (select *, {RANKED} as rank from scores) where rank <= 100),
    hits as (select query_id, doc_id, score, rank, (j.doc_id is not null)::int as hit, n_relevant,
                    sum((j.doc_id is not null)::int)
                      over (partition by query_id order by rank)::double as hits
             from top join r using (query_id)
             left join (select distinct query_id, doc_id from {judged}) j using (query_id, doc_id)),
    running as (select *, hits / rank as precision,
                       case when hit = 1 then len(list_filter({MILESTONES},
                         lambda m: m >= (hits - 1) / n_relevant and m < hits / n_relevant))
                       else 0 end as crossed
                from hits),
    perq as (select threshold, depth, query_id,
                    case when sum(crossed) > 0
                         then sum(precision * crossed) / sum(crossed) end as ap,
                    coalesce(sum(hit) filter (where rank <= n_relevant), 0)::double
                      / max(n_relevant) as rec
             from running join grid on score > threshold and rank <= depth
             group by all),
    means as (select threshold, depth, avg(ap) as mean_average_precision,
                     sum(rec) filter (where ap is not null) as rec,
                     count(ap) as scored, count(*) as answered
              from perq group by all),
    result as (select threshold, depth,
                      round(mean_average_precision, 9) as mean_average_precision,
                      round(coalesce(rec, 0) / nullif(coalesce(scored, 0)
                        + (select count(distinct query_id) from {judged})
                        - coalesce(answered, 0), 0), 9) as mean_recall
               from grid left join means using (threshold, depth))"""


THRESHOLDS = [0.3, 0.4, 0.5, 0.6, 0.7]
DEPTHS = [3, 5, 10, 30, 50, 100]


def rounded_means(means: DataFrame) -> DataFrame:
    return means.withColumn(
        "mean_average_precision", F.round("mean_average_precision", 9)
    ).withColumn("mean_recall", F.round("mean_recall", 9))


def all_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.sweep(
        scores(spark, sf_dir), judgments(spark, sf_dir), THRESHOLDS, DEPTHS
    )


@register("w9_sweep", f"with {SCORED}, {JUDGED}, {means_sql()} select * from result")
def sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_means(all_settings(spark, sf_dir))


@register(
    "w9_best_setting",
    f"""with {SCORED}, {JUDGED}, {means_sql()} select * from result
        order by mean_average_precision desc nulls last, threshold, depth limit 1""",
)
def best_setting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.best_setting(rounded_means(all_settings(spark, sf_dir)))


@register(
    "w7_mean_scores",
    f"""with {SCORED}, {JUDGED}, {means_sql()} select mean_average_precision, mean_recall
        from result where threshold = 0.3 and depth = 10""",
)
def mean_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = evaluation.evaluate(scores(spark, sf_dir), judgments(spark, sf_dir), 10, 0.3)
    return rounded_means(means).select("mean_average_precision", "mean_recall")


# A second set of judgments with many relevant documents per query: the good
# documents among those that share a sentence or score above 0.
GOOD = """
good as (select query_id, doc_id from scores join labels using (doc_id) where quality = 1)
"""


@register("w8_evaluation", f"with {SCORED}, {GOOD}, {means_sql('good')} select * from result")
def evaluation_many_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = settle(scores(spark, sf_dir))
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    judged = scored.join(good, "doc_id").select("query_id", "doc_id")
    return rounded_means(evaluation.sweep(scored, judged, THRESHOLDS, DEPTHS))
