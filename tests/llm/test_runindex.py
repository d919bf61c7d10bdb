"""Repeated bytes against all windows of all texts."""

import hashlib

import numpy as np
import pytest

from gleanwork.llm import runindex


def later(pieces, docs, starts, span):
    first = {}
    for piece, doc, start in zip(pieces, docs, starts):
        for a in range(len(piece) - span + 1):
            key = piece[a : a + span]
            first[key] = min(first.get(key, (doc, start + a)), (doc, start + a))
    return {
        (i, a)
        for i, (piece, doc, start) in enumerate(zip(pieces, docs, starts))
        for a in range(len(piece) - span + 1)
        if first[piece[a : a + span]] < (doc, start + a)
    }


@pytest.mark.parametrize("letters", [b"ab", b"abcdefgh", b"\x00a"])
def test_index_finds_the_later_windows(letters):
    rng = np.random.default_rng(len(letters))
    for span in (8, 9, 12, 16, 20):
        for _ in range(15):
            base = [bytes(rng.choice(list(letters), rng.integers(5, 60)).tolist()) for _ in range(4)]
            pieces = set()
            for _ in range(30):
                text = b"".join(base[i] for i in rng.integers(0, 4, 3))
                cut = rng.integers(0, 9)
                pieces.add(text[cut : cut + rng.integers(span, 50)])
            pieces = [p for p in sorted(pieces) if len(p) >= span]
            docs, starts = rng.integers(0, 9, len(pieces)), rng.integers(0, 30, len(pieces))
            found = runindex.later_windows(pieces, docs, starts, span)
            assert set(zip(*(f.tolist() for f in found))) == later(pieces, docs, starts, span)


def test_runs_are_fewer_than_letters_in_repetitive_texts():
    base = bytes(np.random.default_rng(5).integers(97, 123, 150).tolist())
    pieces = [base[: 150 - i] for i in range(40)]
    index = runindex.RunIndex(pieces, 100)
    assert len(index.starts) < index.letters / 10
    assert len(index.samples) == len(index.starts)


def plain(rows, span):
    """Bytes, removed spans and kept bytes of each (id, text)."""
    texts = [(r[1] or "").encode() for r in rows]
    order = [float("inf") if r[0] is None else r[0] for r in rows]
    gone = [set() for _ in rows]
    for i, a in later(texts, order, [0] * len(rows), span):
        gone[i].update(range(a, a + span))
    out = []
    for r, text, lost in zip(rows, texts, gone):
        spans = [i for i in sorted(lost) if i - 1 not in lost]
        kept = bytes(b for i, b in enumerate(text) if i not in lost)
        digest = hashlib.sha256(kept).hexdigest()
        out.append((str(r[0]), len(text), len(lost), len(spans), digest))
    return sorted(out)


def found(df, **more):
    return sorted(
        (
            str(r["row"]["doc_id"]),
            r["n_bytes"],
            sum(b - a for a, b in r["spans"]),
            len(r["spans"]),
            hashlib.sha256(bytes(r["kept"])).hexdigest(),
        )
        for r in runindex.repeated_bytes(df, **more).collect()
    )


@pytest.mark.parametrize("span, seed", [(100, 16), (40, 8), (20, 20)])
def test_repeated_bytes(docs, rows, span, seed):
    assert found(docs, span=span, seed=seed) == plain([r[:2] for r in rows], span)


def test_hot_anchors_are_dealt_in_parts(spark, rows, monkeypatch):
    rng = np.random.default_rng(9)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    passage = "this passage of more than forty bytes stands in every third document"
    texts = [
        " ".join([*rng.choice(words, 4), *([passage] if i % 3 == 0 else []), *rng.choice(words, 4)])
        for i in range(150)
    ]
    given = list(enumerate(texts))
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    want = plain(given, 30)
    for hot in (1024, 8, 1, 0.1):
        monkeypatch.setattr(runindex, "HOT_PIECES", hot)
        assert found(df, span=30, seed=8) == want


def test_small_chunks_give_the_same(docs, rows, monkeypatch):
    from gleanwork.llm import chunks

    monkeypatch.setattr(chunks, "CHUNK_CHARS", 900)
    monkeypatch.setattr(runindex, "_AT_ONCE", 64)
    assert found(docs, span=50) == plain([r[:2] for r in rows], 50)


def test_empty_tables_odd_names_and_long_texts(spark, empty):
    assert runindex.repeated_bytes(empty).count() == 0
    text = "".join(np.random.default_rng(2).choice(list("abcdef"), 1_000_000))
    df = spark.createDataFrame(
        [(1, text, 1, "x"), (2, "y" + text, 2, None), (3, "z" * 3000, 3, "z")],
        "doc_id int, text string, chunk int, `a.b` string",
    )
    got = {r["row"]["doc_id"]: r for r in runindex.repeated_bytes(df).collect()}
    assert got[1]["spans"] == [] and got[2]["spans"] == [[1, 1_000_001]]
    assert got[3]["spans"] == [[1, 3000]] and got[3]["row"]["a.b"] == "z"
    with pytest.raises(ValueError):
        runindex.repeated_bytes(df, span=6)
