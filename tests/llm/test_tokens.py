"""Encoding, edits and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanwork.llm import edits, lexicon, packing
from gleanwork.llm.bpe import Encoder, Merges, Splitter
from tests.llm.conftest import TOKENIZER


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def merges():
    return Merges(TOKENIZER)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library_on_odd_texts(library, merges):
    random.seed(1)
    alphabet = " \n\t'aàÿ×÷1½²ªsrel\x85\xa0　\x1c,.<|>日😀"
    texts = ["".join(random.choice(alphabet) for _ in range(80)) for _ in range(500)]
    texts += ["<|endoftext|>", "x<|endoftext|>  y", "<|endoftext", "", "aaaaaaaaaaaaaaaaa"]
    encoder = Encoder(merges, max_words=60, max_chars=300)
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == ids_of(library, text), text
        assert encoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("min_share", [1e-6, 0.002, 1.0])
def test_lexicon_encodes_documents(docs, rows, library, min_share):
    got = lexicon.encode_documents(docs, TOKENIZER, min_share=min_share).collect()
    found = sorted((str(r["doc_id"]), bytes(r["ids"]), r["decoded"]) for r in got)
    want = []
    for doc, text, *_ in rows:
        ids = ids_of(library, text)
        spelled = library.decode(ids, skip_special_tokens=False)
        want.append((str(doc), np.array(ids, "<u4").tobytes(), spelled))
    assert found == sorted(want)


def test_lexicon_shares_suffixes_and_knows_only_its_words(merges):
    words = sorted([" walking", " talking", "walk", "walking", "é", ""], key=str.encode)
    held = lexicon.compile_lexicon(words, merges)
    compiled = lexicon.Lexicon(held, merges)
    spelled = [w.encode() for w in words]
    assert compiled.numbers(spelled).tolist() == list(range(len(words)))
    assert compiled.numbers([b"walkin", b"x", b"walkings"]).tolist() == [-1, -1, -1]
    assert held[1] < sum(map(len, spelled))  # fewer states than bytes
    mixed = [b"walk", b"unseen", b"", b" talking"]
    for a, b in zip(compiled.resolve(mixed), merges.merge(mixed)):
        assert (a == b).all()


def test_empty_tables(empty):
    assert lexicon.encode_documents(empty, TOKENIZER).count() == 0
    assert packing.pack(packing.token_pieces(empty, TOKENIZER)).count() == 0
    trees = edits.build_trees(empty, TOKENIZER)
    assert edits.edit_counts(trees, TOKENIZER, edits.redactions()).count() == 0


def test_edits_equal_full_encoding(docs, rows, library):
    trees = edits.build_trees(docs, TOKENIZER)
    assert sorted(r[0] for r in trees.select("n_tokens").collect()) == sorted(
        len(ids_of(library, r[1])) for r in rows
    )
    got = edits.edit_counts(trees, TOKENIZER, edits.redactions()).collect()
    assert len(got) == len(rows)
    for r in got:
        new, made = edits.edited(r["row"]["text"] or "", edits.redactions()(r["row"]["text"] or ""))
        assert (r["text"], r["n_edits"]) == (new, len(made))
        assert r["n_tokens"] == len(ids_of(library, new)) == r["tree_tokens"][1]
        assert (r["n_reencoded"] > 0) == bool(made)


def test_random_edits(merges):
    random.seed(5)
    encoder = Encoder(merges)
    parts = [" ", "\n", "a", "'", "re", "1", "²", "<|endoftext|>", "text|>", "word", "  ", "é"]
    for _ in range(400):
        text = "".join(random.choice(parts) for _ in range(random.choice([0, 1, 90, 700])))
        some = [(random.randint(0, len(text) + 2), random.choice([0, 1, 9, 200])) for _ in range(5)]
        some = [(a, a + n, "".join(random.choices(parts, k=3))) for a, n in some]
        tree = edits.SegmentTree.build(*next(encoder.count([text])))
        new, made = edits.edited(text, some)
        for first, last, pieces in list(edits.touched(tree, new, made, Splitter(merges.special))):
            chars, counts = next(encoder.count_pieces([pieces]))
            tree.put(first, int(chars.sum()), int(counts.sum()))
            for leaf in range(first + 1, last + 1):
                tree.put(leaf, 0, 0)
        chars, counts = next(encoder.count([new]))
        assert (tree.chars[1], tree.tokens[1]) == (len(new), counts.sum())


def test_packing_holds_every_id_once(docs, rows, library):
    pieces = packing.token_pieces(docs, TOKENIZER, capacity=64, grain=8)
    got = packing.pack(pieces, 64, block_windows=8).collect()
    whole, windows = {}, {}
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] <= 64
        whole.setdefault(r["row"], []).append((r["start"], ids.tolist(), r["doc_id"], r["doc_tokens"]))
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    found = []
    for parts in whole.values():
        parts.sort()
        ids = [i for p in parts for i in p[1]]
        assert [p[0] for p in parts] == list(np.cumsum([0] + [len(p[1]) for p in parts[:-1]]))
        assert {p[3] for p in parts} == {len(ids)}
        found.append((str(parts[0][2]), ids))
    assert sorted(found) == sorted((str(r[0]), ids_of(library, r[1]) + [0]) for r in rows)
    for parts in windows.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts[:-1]]))
        assert sum(p[1] for p in parts) <= 64
    total = sum(len(ids) for _, ids in found)
    assert len(windows) * 64 < total * 1.1


def test_differencing_is_near_equal():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 129, 600)
    sums = np.bincount(packing.differencing(lengths, 40), lengths, 40)
    assert sums.sum() == lengths.sum() and sums.max() - sums.min() <= 4
    assert packing.differencing(np.array([8, 7, 6, 5, 4]), 2).tolist().count(0) in (2, 3)
    for n in range(1, 30):
        lengths = rng.integers(1, 101, n)
        assert np.bincount(packing.pack_block(lengths, 100), lengths).max() <= 100


def test_query_crc_is_of_the_piece(docs):
    row = (
        packing.token_pieces(docs, TOKENIZER)
        .withColumn("crc", F.crc32("ids"))
        .filter("length > 3")
        .first()
    )
    assert row["crc"] == zlib.crc32(bytes(row["ids"]))
