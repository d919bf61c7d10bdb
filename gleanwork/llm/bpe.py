"""Byte-level BPE as the tokenizers library does it, one distinct word at a time.

A text is cut into pre-tokens; every distinct pre-token of a task is encoded
once and looked up afterwards. The pieces are exact: texts whose characters
the short pattern below does not cover are cut by the library itself, and
unseen words are merged by rank.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

# Fixed values of the byte-level scheme: letters of Latin-1, its blanks, the
# contractions, and the order of the alternatives.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_BLANK = " \t\n\x0b\x0c\r"
_COVERED = re.compile(f"[\x00-\x7f{_LETTER}]*")
_PIECE = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[0-9]+| ?[^{_BLANK}{_LETTER}0-9]+"
    rf"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)

_NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file, inverted."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Merges:
    """Tables of one tokenizer file: about 2 MB for 50 000 merges.

    Built on the driver from ``path`` and shipped to the tasks, so executors
    need no copy of the file. The size is bounded by the vocabulary.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.results = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            spelled[i] = token.encode()
        self.spelled = spelled

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and their number per word.

        All words advance together: in each round every word merges its pair
        of the lowest rank, from left to right.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ids = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            keys = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            usable = (owner[:-1] == owner[1:]) & (self.keys[at] == keys)
            rank = np.where(usable, self.ranks[at], _NONE)
            best = np.full(len(words), _NONE)
            np.minimum.at(best, owner[:-1], rank)
            first = np.zeros(len(ids), bool)
            first[:-1] = usable & (rank == best[owner[:-1]])
            # Overlapping pairs such as x x x: every second one, from the left.
            place = np.arange(len(ids))
            run = np.maximum.accumulate(np.where(first, 0, place + 1))
            first &= (place - run) % 2 == 0
            ids = ids.copy()
            ids[first] = self.results[at[first[:-1]]]
            left = np.ones(len(ids), bool)
            left[1:] = ~first[:-1]
            open_ = best[owner] != _NONE
            done_ids.append(ids[left & ~open_])
            done_owner.append(owner[left & ~open_])
            ids, owner = ids[left & open_], owner[left & open_]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owner = np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(done_ids)[order], np.bincount(owner, minlength=len(words))


class Splitter:
    """Pre-tokens of whole texts; special tokens come out as they are."""

    def __init__(self, special: Iterable[str]):
        self.special = list(special)
        found = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = re.compile(f"({found})") if self.special else None
        self.library = None

    def plain(self, text: str) -> list[str]:
        if text.isascii() or _COVERED.fullmatch(text):
            return _PIECE.findall(text)
        if self.library is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def __call__(self, text: str) -> list[str]:
        if not any(s in text for s in self.special):
            return self.plain(text)
        pieces: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            pieces.extend([part] if i % 2 else self.plain(part))
        return pieces


class _Codes(dict):
    """Numbers words in the order they are met."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        code = self[word] = len(self)
        self.fresh.append(word)
        return code


Resolve = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class Encoder:
    """Encodes texts; memory is bounded by ``max_words`` remembered words and
    ``max_chars`` of text in work (or one text, if that is longer)."""

    def __init__(
        self,
        merges: Merges,
        resolve: Resolve | None = None,
        max_words: int = 400_000,
        max_chars: int = 4_000_000,
    ):
        self.merges = merges
        self.resolve = resolve or merges.merge
        self.split = Splitter(merges.special)
        self.max_words, self.max_chars = max_words, max_chars
        self._reset()

    def _reset(self) -> None:
        self.codes = _Codes()
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.chars = np.zeros(0, np.int64)

    def _settle(self) -> None:
        words, self.codes.fresh = self.codes.fresh, []
        if not words:
            return
        ids, lengths = self.resolve([w.encode() for w in words])
        for i, word in enumerate(words):
            if word in self.merges.special:  # a handful at most
                at = int(lengths[:i].sum())
                ids = np.concatenate(
                    [ids[:at], [self.merges.special[word]], ids[at + lengths[i] :]]
                )
                lengths[i] = 1
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        chars = np.fromiter(map(len, words), np.int64, len(words))
        self.chars = np.concatenate([self.chars, chars])

    def _blocks(self, split_texts: Iterable[list[str]]) -> Iterator[list[np.ndarray]]:
        """Word codes of the texts, block by block; the words are encoded."""
        block, chars = [], 0
        for pieces in split_texts:
            block.append(np.fromiter(map(self.codes.__getitem__, pieces), np.int64, len(pieces)))
            chars += 5 * len(pieces)  # a pre-token has about five characters
            if chars >= self.max_chars or len(self.codes) >= self.max_words:
                self._settle()
                yield block
                block, chars = [], 0
                if len(self.codes) >= self.max_words:
                    self._reset()
        self._settle()
        yield block

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids (unsigned 32 bits) of each text; null counts as empty."""
        for block in self._blocks(self.split(t or "") for t in texts):
            for codes in block:
                lengths = self.lengths[codes]
                ends = np.cumsum(lengths)
                total = int(ends[-1]) if len(ends) else 0
                at = np.repeat(self.starts[codes] - ends + lengths, lengths) + np.arange(total)
                yield self.ids[at]

    def count(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Characters and number of ids of each pre-token of each text."""
        return self.count_pieces(self.split(t or "") for t in texts)

    def count_pieces(
        self, split_texts: Iterable[list[str]]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for texts that are cut into pre-tokens already."""
        for block in self._blocks(split_texts):
            for codes in block:
                yield self.chars[codes], self.lengths[codes]

    def decode(self, ids: np.ndarray) -> str:
        spelled = self.merges.spelled
        return b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", errors="replace")
