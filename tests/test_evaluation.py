import random

import numpy as np
import pytest

from gleanwork.operators import evaluation

RUN = "query_id bigint, doc_id bigint, score double"
JUDGED = "query_id bigint, doc_id bigint, code int"


def expected(judged, run, depth, threshold, last):
    """Both means from their definitions: the precision where the recall first
    exceeds each milestone, and the recall at as many documents as are relevant."""
    precisions, recalls = [], []
    for q in sorted({q for q, _, _ in judged if q <= last}):
        relevant = {d for p, d, _ in judged if p == q}
        best = sorted((-s, d) for p, d, s in run if p == q and s > threshold)[:depth]
        if not best:
            recalls.append(0.0)
            continue
        hits = np.cumsum([d in relevant for _, d in best])
        passed = [np.flatnonzero(hits / len(relevant) > m) for m in evaluation.MILESTONES]
        at = [int(p[0]) for p in passed if len(p)]
        if at:
            precisions.append(np.mean([hits[i] / (i + 1) for i in at]))
            recalls.append(hits[min(len(relevant), len(hits)) - 1] / len(relevant))
    return tuple(float(np.mean(v)) if v else None for v in (precisions, recalls))


def random_case(seed):
    rng = random.Random(seed)
    judged, run = [], []
    for q in range(1, 13):
        docs = rng.sample(range(1, 60), rng.choice([1, 2, 5, 10, 20]))
        if q != 5:
            judged += [(q, d, rng.choice([-1, 1, 2, 3, 4])) for d in docs]
        if q not in (7, 12):
            found = rng.sample(range(1, 60), rng.choice([1, 5, 30]))
            run += [(q, d, round(rng.random(), 2)) for d in found]
    return judged, run


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sweep_equals_the_definitions(spark, seed):
    judged, run = random_case(seed)
    thresholds, depths, last = [0.1, 0.5, 0.97], [1, 3, 30], 11
    made = evaluation.sweep(
        spark.createDataFrame(run + [(q, d, s / 2) for q, d, s in run], RUN),
        spark.createDataFrame(judged, JUDGED),
        thresholds,
        depths,
        last,
        repeated=True,
    )
    got = {(r["threshold"], r["depth"]): r for r in made.collect()}
    assert len(got) == 9
    for e in thresholds:
        for k in depths:
            precision, recall = expected(judged, run, k, e, last)
            row = got[e, k]
            assert row["mean_average_precision"] == (
                None if precision is None else pytest.approx(precision)
            )
            assert row["mean_recall"] == (None if recall is None else pytest.approx(recall))


def test_milestone_bits(spark):
    # Ten relevant documents: 0.3 does not pass the third step, 0.8 passes the eighth.
    judged = [(1, d, 1) for d in range(10)]
    run = [(1, d, 1.0 - d / 100) for d in range(10)]
    made = evaluation.running_scores(
        evaluation.top_k(spark.createDataFrame(run, RUN), 10), spark.createDataFrame(judged, JUDGED)
    )
    crossed = [r["crossed"] for r in made.orderBy("rank").collect()]
    assert crossed == [0, 1, 1, 1, 1, 1, 1, 2, 1, 1]


def test_repeats_and_unknown_documents(spark):
    judged = spark.createDataFrame([(1, 1, 2), (1, 1, 3), (1, 9, 1)], JUDGED)
    assert evaluation.relevant_counts(judged).first()["n_relevant"] == 2
    assert evaluation.within_corpus(judged, 5).count() == 2
    corpus = spark.createDataFrame([(9,)], "doc_id bigint")
    assert evaluation.within_corpus(judged, corpus).count() == 1
    run = spark.createDataFrame([(1, 1, 0.2), (1, 1, 0.7)], RUN)
    assert evaluation.distinct_run(run).first()["score"] == 0.7


def test_best_setting_is_the_first_of_equals(spark):
    means = spark.createDataFrame(
        [(0.3, 5, 0.5, 0.1), (0.3, 3, 0.5, 0.2), (0.4, 3, None, 0.0), (0.5, 1, 0.5, 0.3)],
        "threshold double, depth int, mean_average_precision double, mean_recall double",
    )
    best = evaluation.best_setting(means).first()
    assert (best["threshold"], best["depth"]) == (0.3, 3)


def test_no_answer_at_all(spark):
    judged = spark.createDataFrame([(1, 1, 1)], JUDGED)
    run = spark.createDataFrame([(1, 1, 0.2)], RUN)
    row = evaluation.evaluate(run, judged, 5, 0.9).first()
    assert row["mean_average_precision"] is None and row["mean_recall"] == 0.0
    assert [r["query_id"] for r in evaluation.unanswered(judged, run.filter("score > 1")).collect()] == [1]
