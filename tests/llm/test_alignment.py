"""Tokens of two tokenizers against pairs taken one by one."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from gleanwork.llm import alignment
from gleanwork.llm.bpe import byte_letters

from .conftest import TOKENIZER

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def spelled(text):
    """Ids and byte ranges on both sides, or None."""
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = byte_letters()
    made = library.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(letters[c] for c in t)) for i, t in zip(made.ids, made.tokens)]
    b = [
        (i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]))
        if pieces.is_byte(i)
        else (i, pieces.id_to_piece(i).replace("▁", " ").encode())
        for i in pieces.encode(text)
    ]
    if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (a, b)):
        return None
    placed = []
    for side in (a, b):
        at, out = 0, []
        for i, token in side:
            out.append((i, at, at + len(token)))
            at += len(token)
        placed.append(out)
    return placed


def plain(texts):
    """What ``aligned`` gives for each text, with the groups as a string."""
    linked, held = Counter(), []
    for text in texts:
        sides = spelled(text) if text else None
        if sides is None:
            held.append(None)
            continue
        a, b = sides
        links, at = [], 0
        for i, first, end in a:
            while b[at][2] <= first:
                at += 1
            j = at
            while j < len(b) and b[j][1] < end:
                links.append((i, b[j][0]))
                j += 1
        groups, left = [], [list(a), list(b)]
        for cut in sorted({x[2] for x in a} & {x[2] for x in b}):
            halves = []
            for side in left:
                n = sum(x[2] <= cut for x in side)
                halves.append(",".join(str(x[0]) for x in side[:n]))
                del side[:n]
            groups.append("|".join(halves))
        linked.update(links)
        held.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, b_id), n in linked.items():
        best[b_id] = max(best[b_id], n)
    return [
        (0, 0, 0, 0, 0, 0, "")
        if h is None
        else (
            *h[:3],
            len(h[3]),
            sum(linked[x] == best[x[1]] for x in h[3]),
            sum(linked[x] for x in h[3]),
            h[4],
        )
        for h in held
    ]


def test_cuts_are_all_common_ends():
    rng = np.random.default_rng(0)
    for _ in range(300):
        last = int(rng.integers(8, 200))
        ends = {*rng.integers(1, last, 3).tolist(), last}
        a = np.array(sorted({*rng.integers(1, last, int(rng.integers(1, 90))).tolist(), *ends}))
        b = np.array(sorted({*rng.integers(1, last, int(rng.integers(1, 90))).tolist(), *ends}))
        docs = np.array(sorted(ends))
        found = alignment.shared_cuts(a, b, np.searchsorted(a, docs), np.searchsorted(b, docs))
        want = np.intersect1d(a, b)
        assert a[found[0]].tolist() == b[found[1]].tolist() == want.tolist()


def test_long_interval_without_a_cut():
    a = np.append(np.arange(2, 4000, 2), 4001)
    b = np.append(np.arange(1, 4000, 2), 4001)
    last = np.array([len(a) - 1]), np.array([len(b) - 1])
    assert [c.tolist() for c in alignment.shared_cuts(a, b, *last)] == [v.tolist() for v in last]


def test_words_alone_are_words_in_a_text():
    tokens = alignment.Tokenizers(TOKENIZER, PIECES)
    assert tokens.by_words
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list(" ab\né½日"), 40)) for _ in range(300)]
    texts += [" ", "   ", "x ", " x  y  ", "a\tb", "x" * 3000]
    for text, made in zip(texts, tokens.opened()(texts)[1]):
        assert made.tolist() == library.encode(text)


def test_aligned(docs, rows, monkeypatch):
    want = plain([r[1] for r in rows])
    hidden = [(*w[:6], w[6] and hashlib.sha256(w[6].encode()).hexdigest()) for w in want]

    def found(**more):
        made = alignment.aligned(docs, TOKENIZER, PIECES, **more).collect()
        return sorted((str(r[0]), *r[1:]) for r in made)

    ids = [str(r[0]) for r in rows]
    assert found() == sorted((i, *h) for i, h in zip(ids, hidden))
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 700)
    monkeypatch.setattr(alignment, "STRETCH_CHARS", 300)
    assert found(keep_groups=True) == sorted((i, *w) for i, w in zip(ids, want))


def test_texts_that_a_side_does_not_spell(spark):
    texts = ["▁", "a ▁b", "<0x41> <s>", "\x00", "é", " ▁ "]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, t string")
    made = alignment.aligned(df, TOKENIZER, PIECES, "id", "t", keep_groups=True).collect()
    assert [tuple(r)[1:] for r in sorted(made)] == plain(texts)


def test_other_columns_and_empty_tables(spark, empty):
    assert alignment.aligned(empty, TOKENIZER, PIECES).count() == 0
    df = spark.createDataFrame([(1, "a b", 2, 3)], "doc_id long, text string, block long, `n.a` long")
    assert alignment.aligned(df, TOKENIZER, PIECES).first()["n_links"] == 2


def test_a_megabyte_of_letters(spark):
    letters = np.random.default_rng(3).choice(list("abcdefghijklmnopqrstuvwxyz"), 1_000_000)
    df = spark.createDataFrame([(1, "".join(letters))], "doc_id long, text string")
    row = alignment.aligned(df, TOKENIZER, PIECES).first()
    library = Tokenizer.from_file(TOKENIZER)
    assert row["n_a"] == len(library.encode(" " + "".join(letters)).ids)
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"]
