import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gleanwork.functions import text as tx
from gleanwork.operators import index, ranking, terms
from gleanwork.plans import retrieval

TEXTS = {
    1: "Flow over a wing. The flow, at Mach 2.5 -- is unsteady!? Über-flow",
    2: "",
    3: "heat heat transfer in laminar flow; heat 42 -7 x_1 _ ... (see [3]).",
    4: "THE AND OF 12 !",
    5: "those wings, anywhere; naïve façade niño\tend",
}


def plain_tokens(text):
    found = re.findall(r"\w+|[^\w\s]+", text)
    stops = set(tx.STOP_WORDS) | set(tx.PUNCTUATION)
    kept = [t for t in found if t.lower() not in stops]
    return [t for t in kept if not (t.isdigit() or t[0] == "-" and t[1:].isdigit())]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string")


def test_tokens(docs):
    made = docs.select("doc_id", tx.content_tokens(F.col("text")).alias("t"))
    for row in made.collect():
        assert row["t"] == plain_tokens(TEXTS[row["doc_id"]])


def test_run_together_words_are_not_stopped():
    assert "those" not in tx.STOP_WORDS and "your" in tx.STOP_WORDS
    missing = "anytime anywhere everything everywhere he least less merely right same"
    assert not set(missing.split()) & set(tx.STOP_WORDS)
    assert len(tx.STOP_WORDS) == len(set(tx.STOP_WORDS))


def test_term_counts(docs):
    got = {(r["doc_id"], r["term"]): r["tf"] for r in terms.term_counts(docs, "doc_id", "text").collect()}
    want = {(d, t): n for d, s in TEXTS.items() for t, n in Counter(plain_tokens(s)).items()}
    assert got == want


def test_sentences_keep_tokens_together(docs):
    rows = terms.document_tokens(docs, "doc_id", "text").orderBy("doc_id", "sent_no", "pos").collect()
    for d, s in TEXTS.items():
        assert [r["token"] for r in rows if r["doc_id"] == d] == plain_tokens(s)
    assert {r["sent_no"] for r in rows if r["doc_id"] == 1} == {0, 1, 2}


def test_empty_documents_count(docs):
    assert terms.collection_size(docs).first()["n"] == 5
    counts = terms.term_counts(docs, "doc_id", "text")
    idf = {r["term"]: r["idf"] for r in terms.inverse_frequencies(counts, docs).collect()}
    assert idf["flow"] == pytest.approx(math.log(5 / 2))


QUERIES = {
    1: "flow flow over heat",
    2: "flow unknownword",
    3: "flow wing heat heat heat",
    4: "naïve wings those",
    5: "of the and",
}


def plain_scores(docs, queries):
    dtf = {d: Counter(plain_tokens(s)) for d, s in docs.items()}
    qtok = {q: plain_tokens(s) for q, s in queries.items()}
    ddf = Counter(t for c in dtf.values() for t in c)
    qdf = Counter(t for toks in qtok.values() for t in set(toks))
    didf = {t: math.log(len(docs) / n) for t, n in ddf.items()}
    qidf = {t: math.log(len(queries) / n) for t, n in qdf.items()}
    out = {}
    for q, toks in qtok.items():
        counts = Counter(toks)
        v1 = [counts[t] * qidf[t] for t in toks]
        for d, c in dtf.items():
            v2 = [c.get(t, 0) * didf.get(t, 0) for t in toks]
            dot = sum(a * b for a, b in zip(v1, v2))
            norm = math.sqrt(sum(a * a for a in v1)) * math.sqrt(sum(b * b for b in v2))
            if norm and dot:
                out[q, d] = dot / norm
    return out


@pytest.fixture(scope="module")
def topics(spark):
    return spark.createDataFrame(list(QUERIES.items()), "query_id bigint, text string")


def test_scores(docs, topics):
    got = {(r["query_id"], r["doc_id"]): r["score"] for r in retrieval.scored_pairs(docs, topics).collect()}
    want = plain_scores(TEXTS, QUERIES)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_salted_join_gives_the_same_scores(docs, topics):
    counts = terms.query_term_counts(topics, "query_id", "text")
    weights = ranking.query_weights(counts, terms.inverse_frequencies(counts, topics, "qtf"))
    doc_counts = terms.term_counts(docs, "doc_id", "text")
    idf = terms.inverse_frequencies(doc_counts, docs)
    small, salted = (
        ranking.cosine_scores(
            ranking.restrict_to_vocabulary(doc_counts, weights, fits), idf, weights, fits
        )
        for fits in (True, False)
    )
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect()))


@pytest.mark.parametrize("fits", [True, False])
def test_tasks_of_scoring_follow_the_matches(spark, monkeypatch, fits):
    monkeypatch.setattr(retrieval, "fits_broadcast", lambda df: fits)
    monkeypatch.setattr(ranking.score_tasks, "__defaults__", (500,))
    # Every query shares a word with every second document.
    docs = spark.range(600).selectExpr("id as doc_id", "if(id % 2 = 0, 'wing flow', 'heat') as text")
    queries = spark.range(40).selectExpr(
        "id as query_id", "if(id < 30, 'wing', 'other') || ' word' || id as text"
    )
    scored = retrieval.scored_pairs(docs, queries)
    per_task = scored.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 300 * 30
    assert len(per_task) >= 300 * 30 // 500
    assert max(r["count"] for r in per_task) <= 4 * 500


def test_ranks_break_ties_by_document(spark):
    scores = spark.createDataFrame(
        [(1, d, 0.5 if d % 2 else 0.75) for d in range(10)] + [(2, 3, 0.1)],
        "query_id bigint, doc_id bigint, score double",
    )
    got = {(r["query_id"], r["doc_id"]): r["rank"] for r in ranking.ranked(scores).collect()}
    order = sorted(range(10), key=lambda d: (-(0.5 if d % 2 else 0.75), d))
    assert got == {**{(1, d): i for i, d in enumerate(order, 1)}, (2, 3): 1}
    top = ranking.top_k(scores, 3, 0.5).collect()
    assert sorted(r["doc_id"] for r in top) == [0, 2, 4]
    with pytest.raises(ValueError):
        ranking.top_k(scores, 0)


def test_plan_has_one_document_shuffle_and_a_group_limit(spark, docs, topics):
    plan = retrieval.ranked_run(docs, topics, 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_blocked_index(docs):
    made = index.inverted_index(terms.term_counts(docs, "doc_id", "text"), block_size=2)
    got = sorted((r["term"], r["block"], r["doc_ids"]) for r in made.filter("term = 'flow'").collect())
    assert got == [("flow", 0, [1]), ("flow", 1, [3])]
    letters = {r["term"] for r in index.letter_terms(made).collect()}
    assert "Über" in letters and "_" not in letters and not any(t[0] == "." for t in letters)


@pytest.mark.parametrize(
    "words,want",
    [
        (["flow"], [1, 3]),
        (["flow", "heat"], [3]),
        (["flow", "no such", "heat"], [1, 3]),
        (["flow", "flow"], [1, 3]),
        (["no such", "flow"], []),
        (["Flow"], [1]),
        (["heat", "wings"], []),
        ([], []),
    ],
)
def test_word_search(docs, words, want):
    made = index.inverted_index(terms.term_counts(docs, "doc_id", "text"), block_size=2)
    assert [r["doc_id"] for r in index.documents_with_all(made, words).collect()] == want


def test_word_filter_reaches_the_index_files(spark, docs, tmp_path):
    from gleanwork.sources import stores

    stores.write_index(index.inverted_index(terms.term_counts(docs, "doc_id", "text")), str(tmp_path / "i"))
    stored = stores.read_index(spark, str(tmp_path / "i"))
    plan = index.term_lookup(stored, "flow")._jdf.queryExecution().toString()
    assert "EqualTo(term,flow)" in plan


def test_search_opens_only_the_files_of_its_words(spark, tmp_path):
    from gleanwork.sources import stores

    rows = spark.range(40_000).selectExpr("concat('w', lpad(cast(id % 2000 as string), 4, '0')) as term", "id as doc_id", "1 as tf")
    path = str(tmp_path / "store")
    with_small_files = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in with_small_files}
    for k, v in with_small_files.items():
        spark.conf.set(k, v)
    try:
        stores.write_index(index.inverted_index(rows, block_size=1000), path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = stores.read_index(spark, path)
    assert len(whole.inputFiles()) >= 12
    some = stores.postings_of(spark, path, ["w0007", "w0007", None, "zzz", "w1999"])
    assert 1 <= len(some.inputFiles()) <= 4  # a word lies in one file, or on the border of two
    want = whole.filter(F.col("term").isin("w0007", "w1999"))
    assert sorted(some.collect()) == sorted(want.collect()) and some.count() == 40
    found = index.documents_with_all(stores.postings_of(spark, path, ["w0007"]), ["w0007"])
    assert [r["doc_id"] for r in found.collect()] == list(range(7, 40_000, 2000))
    for words in ([], [None], ["zzz"]):
        assert stores.postings_of(spark, path, words).count() == 0
    empty = str(tmp_path / "empty")
    stores.write_index(whole.limit(0), empty)
    assert stores.postings_of(spark, empty, ["w0007"]).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_tiny_scores_stay_and_zero_scores_go(spark, broadcast):
    counts = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "doc_id long, term string, tf long")
    idf = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "term string, idf double")
    weights = spark.createDataFrame(
        [(7, "a", 1, 1.0, 1e14), (7, "b", 1, 1.0, 1e14)], "query_id long, term string, qtf long, qw double, n1 double"
    )
    got = ranking.cosine_scores(counts, idf, weights, broadcast).collect()
    assert [tuple(r) for r in got] == [(7, 1, 0.0)]
