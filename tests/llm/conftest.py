import public_tokenizers
import pytest

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

_PROSE = (
    "the quick brown fox jumps over the lazy dog while a cold wind blows across the river and "
    "nobody in the old town remembers why the bells rang twice on that quiet winter morning"
).split()


def _prose(seed: int, words: int) -> str:
    state, out = seed * 7919 + 17, []
    for _ in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(_PROSE[(state >> 8) % len(_PROSE)] + ("" if state % 5 else str(state % 97)))
    return " ".join(out)


def corpus() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, row): nulls, blanks, odd characters,
    copies, near copies, shared passages, equal ids, very long words."""
    passage = _prose(99, 40)
    texts = [_prose(i, 30 + i % 50) for i in range(60)]
    texts += [texts[i].upper() for i in range(5)] + texts[5:9] + [texts[9]] * 6
    texts += [t + " end" for t in texts[10:14]]
    texts += [f"{_prose(200 + i, 9)} {passage} {_prose(300 + i, 11)}" for i in range(5)]
    texts += [passage, "\n".join([_prose(7, 9)] * 5), " ".join(["again and again"] * 30)]
    texts += ["", " ", "\n\t ", None, None, "one", "one two", "é ½ 日本 \x1f \x85 x\xa0y", "''s 're I'M"]
    texts += ["<|endoftext|>", "a<|endoftext|> b  <|endoftext|>", "x" * 5000, "### $$$ %%% &&& | <>" * 20]
    texts += ["mail a.b@example.org or 12345678, !!!! now", _prose(5, 3000), "A\r\n\r\nB"]
    rows = [
        (i, t, ("en", "de", None)[i % 3], f"s{i % 4}", None if t is None else len(t), i)
        for i, t in enumerate(texts)
    ]
    rows.append((None, texts[3], "en", None, None, 1))
    rows.append((None, "no id here at all", None, "s", 17, 2))
    rows.append((20, "same id, another text", "en", "s", 21, 3))
    return rows + [rows[12]] * 2


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long"


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
