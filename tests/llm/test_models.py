"""Quality rules and the language model against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanwork.llm import chunks, katz, quality

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    text = text or ""
    words = _WORD.findall(text)
    runs = defaultdict(list)
    for i in range(len(words) - 7):
        runs[tuple(words[i : i + 8])].append(i)
    covered = {j for at in runs.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_rules(docs, rows):
    got = quality.quality(docs).select("row.text", *BASE).collect()
    assert sorted((r[0] or "", *r[1:]) for r in got) == sorted(
        (r[1] or "", *plain_base(r[1])) for r in rows
    )


def test_every_character_counts_in_its_class(spark):
    """All characters up to U+00FF and some beyond, each in few-character runs."""
    texts = [chr(c) * n + "x" for c in range(1, 256) for n in (1, 3)] + ["\u2028é😀A9#.", ""]
    made = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", quality._in_classes(F.col("text")).alias("n")
    )
    for text, found in made.collect():
        assert found == [len(re.findall(p, text)) for p in quality.CLASSES.values()], repr(text)


def test_repeated_runs_hash_each_word_once(spark):
    """Runs of 8 words by their words; no slice of words is hashed place by place."""
    texts = ["a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g", "a " * 9, "a b", "b a " * 5]
    made = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", quality._repeated_words(quality.words_of(F.col("text"))).alias("n")
    )
    assert [n for _, n in made.collect()] == [plain_base(t)[4] for t in texts]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"xxhash64\(slice\(", plan)


def distance(p, q):
    total = 0.0
    for a, b in zip(p, q):
        m = (a + b) / 2
        total += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(0.0, total / 2))


def plain_classes(text):
    own = [len(re.findall(p, text)) for p in quality.CLASSES.values()]
    blank = len(re.findall(r"[\x20\x09-\x0D]", text))
    wide = len(text.encode()) - len(text)
    rest = max(0, len(text) - blank - sum(own))
    return np.array([*own, blank, wide, rest], float)


def test_divergence(docs, rows):
    limits = quality.Limits(
        common_words=5, class_least_chars=50, word_least_words=20, reference_least_words=100
    )
    langs = defaultdict(list)
    for r in rows:
        langs[r[2] or ""].append(r[1] or "")
    refs = {}
    for lang, texts in langs.items():
        classes = sum(plain_classes(t) for t in texts)
        words = Counter(w for t in texts for w in _WORD.findall(t))
        short = [(-n, w) for w, n in words.items() if len(w) <= 4 and re.search(r"[^\W\d_]", w)]
        top = [w for _, w in sorted(short)[:5]]
        total = sum(words.values())
        refs[lang] = classes / classes.sum(), top, [words[w] / total for w in top]
    got = quality.quality(docs, limits=limits).collect()
    assert {r["class_distance"] is None for r in got} == {True, False}
    for r in got:
        text = r["row"]["text"] or ""
        classes, top, shares = refs[r["row"]["lang"] or ""]
        words = _WORD.findall(text)
        rejected = r["base_failed"]
        if len(text) >= 50:
            own = plain_classes(text)
            want = distance(own / own.sum(), classes)
            assert r["class_distance"] == pytest.approx(want, abs=1e-7)
            rejected |= want > limits.class_distance
        else:
            assert r["class_distance"] is None
        if len(words) >= 20:
            own = [words.count(w) / len(words) for w in top]
            want = distance([*own, 1 - sum(own)], [*shares, 1 - sum(shares)])
            assert r["word_distance"] == pytest.approx(want, abs=1e-7)
            rejected |= want > limits.word_distance
        else:
            assert r["word_distance"] is None
        assert r["kept"] == (not rejected)


def test_quality_of_empty_and_tiny_tables(empty, docs):
    assert quality.quality(empty).count() == 0
    few = quality.quality(docs.limit(2)).collect()
    assert all(r["class_distance"] is None for r in few)


def _speech(seed, n, common, share, vocabulary):
    """A text of ``n`` words, ``share`` of them from 30 common ones."""
    rng = np.random.default_rng(seed)
    return [
        common[int(30 * rng.random() ** 2)] if rng.random() < share else f"{vocabulary}{i}word"
        for i in rng.integers(0, 5_000, n)
    ]


@pytest.mark.parametrize("share", [0.15, 0.25, 0.5])
def test_divergence_of_replaced_and_swapped_texts(spark, share):
    """At a share of 0.15 a text without any common word reaches 0.28."""
    a, b = ([f"{x}{chr(97 + i % 26)}{i // 26}" for i in range(30)] for x in "mn")
    b[:9] = a[:9]  # as Spanish and French have words in common
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        rows.append(("own", "a", _speech(i, 400, a, share, "long")))
    for replaced in (0.2, 0.8, 1.0):
        for i in range(10):
            words = _speech(1_000 + i, 400, a, share, "long")
            words = [f"nonsense{k}" if rng.random() < replaced else w for k, w in enumerate(words)]
            rows.append((f"replaced {replaced}", "a", words))
    rows += [("swapped", "a", _speech(2_000 + i, 400, b, share, "wide")) for i in range(10)]
    rows = [(what, lang, " ".join(words)) for what, lang, words in rows]
    docs = spark.createDataFrame(rows, "what string, lang string, text string")
    limits = quality.Limits(class_distance=1.0)
    got = Counter((r["row"]["what"], r["kept"]) for r in quality.quality(docs, limits=limits).collect())
    assert got == {
        ("own", True): 300,
        ("replaced 0.2", True): 10,
        ("replaced 0.8", False): 10,
        ("replaced 1.0", False): 10,
        ("swapped", False): 10,
    }


def test_small_language_is_judged_in_a_large_table(spark):
    """2 400 words have a reference, also beside 30 million others."""
    common = [f"m{chr(97 + i % 26)}{i // 26}" for i in range(30)]
    small = [(" ".join(_speech(i, 400, common, 0.4, "long")), "small") for i in range(6)]
    docs = spark.createDataFrame(small, "text string, lang string").unionByName(
        spark.range(30).select(
            F.repeat(F.lit("the other language "), 333_334).alias("text"), F.lit("big").alias("lang")
        )
    )
    found = quality.references(docs, quality.Limits(), "text", "lang").collect()
    assert {r["lang"] for r in found} == {"small", "big"}


def _long_words(seed, words, chars):
    letters = np.random.default_rng(seed).integers(97, 123, (words, chars))
    return " ".join("".join(map(chr, w)) for w in letters)


@pytest.mark.parametrize("n,words,chars", [(30, 100, 8), (12, 25, 60)], ids=["no short word", "few words"])
def test_language_without_common_words_is_judged_by_its_classes(spark, n, words, chars):
    """As in a script without blanks: no word of at most 4 characters, or long stretches without a blank."""
    own = [(_long_words(i, words, chars), "own") for i in range(n)]
    digits = " ".join(str(10 ** (chars - 1) + i) for i in range(words))
    docs = spark.createDataFrame([*own, (digits, "own"), ("one two three", "tiny")], "text string, lang string")
    found = quality.references(docs, quality.Limits(), "text", "lang").collect()
    assert [(r["lang"], r["common"], r["shares"], r["largest"]) for r in found] == [("own", None, None, None)]
    got = quality.quality(docs).collect()
    assert all(r["word_distance"] is None for r in got)
    kept = {r["row"]["text"]: r["kept"] for r in got}
    assert kept == {t: True for t, _ in own} | {digits: False, "one two three": False}


def plain_model(rows, min_share):
    """Counts, classes and probabilities, one dictionary at a time."""
    toks = [[w.lower() for w in (r[1] or "").encode().split()] for r in rows]
    train = [zlib.crc32(str(r[0]).encode()) % 10 != 0 if r[0] is not None else False for r in rows]
    uni = Counter(w for t, k in zip(toks, train) if k for w in t)
    ends = sum(train)
    total = sum(uni.values()) + ends
    frequent = {w for w, n in uni.items() if n >= min_share * total}
    rare_n = sum(n for w, n in uni.items() if w not in frequent)
    rare_v = len(uni) - len(frequent)
    cls = lambda w: w if w in frequent else "<rare>"
    of = Counter([*uni.values(), ends])
    d1 = katz.discounts(of)
    dis = lambda c, d: c * (d[c] if c <= katz.DISCOUNTED else 1.0)
    known = {w: dis(uni[w], d1) for w in frequent} | {"<end>": dis(ends, d1)}
    room = total if sum(known.values()) < total * (1 - 1e-12) else total + 1
    p = {w: v / room for w, v in known.items()}
    p["<rare>"] = 1 - sum(p.values())
    bi = Counter()
    for t, k in zip(toks, train):
        if k:
            seq = ["<start>", *map(cls, t), "<end>"]
            bi.update(zip(seq, seq[1:]))
    d2 = katz.discounts(Counter(bi.values()))
    after = defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c

    def prob(h, w):
        seen = after.get(h, {})
        if not seen:
            return p[w]
        n, mass = sum(seen.values()), sum(dis(c, d2) for c in seen.values())
        every = len(seen) == len(p)
        space = mass if every else (n if n - mass > n * 1e-12 else n + 1)
        if w in seen:
            return dis(seen[w], d2) / space
        return (1 - mass / space) / (1 - sum(p[x] for x in seen)) * p[w]

    rare = lambda w: (uni[w] + 0.1) / (rare_n + 0.1 * (rare_v + 1))
    return toks, train, uni, ends, total, cls, p, prob, rare, after


@pytest.mark.parametrize("min_share,chars", [(2e-6, 4_000_000), (0.004, 600), (1.0, 4_000_000)])
def test_katz(docs, rows, monkeypatch, min_share, chars):
    monkeypatch.setattr(katz, "CHUNK_CHARS", chars)
    toks, train, uni, ends, total, cls, p, prob, rare, after = plain_model(rows, min_share)
    for h in [*list(after)[:40], "never"]:
        assert sum(prob(h, w) for w in p) == pytest.approx(1, abs=1e-9)
    vocabulary = len(uni) + 1
    want = []
    for r, t, k in zip(rows, toks, train):
        counts = [*(uni[w] for w in t), ends]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (vocabulary + 1))) for c in counts)
        seq = ["<start>", *map(cls, t), "<end>"]
        score = sum(math.log10(prob(h, w)) for h, w in zip(seq, seq[1:]))
        score += sum(math.log10(rare(w)) for w in t if cls(w) == "<rare>")
        known = sum(c > 0 for c in counts)
        want.append((str(r[0]), not k, len(t) + 1, known, total, round(base, 6), round(score, 6)))
    got = [
        (str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6))
        for r in katz.score_corpus(docs, min_share=min_share).collect()
    ]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-5)


def test_katz_keeps_seldom_words_apart(spark):
    """In 600 000 tokens a word seen twice has less than 2e-6 of them."""
    ids = range(40)
    held = next(i for i in ids if zlib.crc32(str(i).encode()) % 10 == 0)
    other = next(i for i in ids if i != held and zlib.crc32(str(i).encode()) % 10 == 0)
    common = " ".join(f"f{(i * i + i // 97) % 97}" for i in range(20_000))
    texts = {i: f"{common} " for i in ids if i not in (held, other)}
    learned = [i for i in texts if zlib.crc32(str(i).encode()) % 10][0]
    texts[learned] += "zig zag zug zog"
    texts |= {held: "zig zag", other: "zig zog"}
    got = katz.score_corpus(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    score = {r["doc_id"]: r["score"] for r in got.collect()}
    assert score[held] > score[other] + 1


def test_katz_without_training(spark, empty):
    assert katz.score_corpus(empty).count() == 0
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0][:2]
    rows = [(ids[0], "a b"), (ids[1], None)]
    got = katz.score_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {(3, 0, 0), (1, 0, 0)}
    assert all(math.isfinite(r["score"]) for r in got)


def test_packed_arrays():
    rng = np.random.default_rng(0)
    for array in ([], [5], [3, 1, 2**63], np.sort(rng.integers(0, 1 << 60, 100)), [7, 7, 7]):
        array = np.array(array, np.uint64)
        assert all((x == array).all() for x in chunks.unpacked(chunks.packed(array, array)))


def test_clashing_names(docs):
    clash = docs.withColumn("kept", F.lit("x")).withColumn("words", F.lit(1)).withColumn("n", F.lit(2))
    assert quality.quality(clash).select("row.*").columns == clash.columns
    assert katz.score_corpus(clash).count() == clash.count()
