"""Token ids of many texts with a word-end tokenizer, encoding each distinct word once."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

# A text whose characters are all in this set is split into words here; any other text goes to the tokenizer whole. In the
# set normalisation changes nothing but case and white space, letters are exactly those named, and so are numbers.
_LETTERS = "a-zßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_PLAIN = re.compile(f"[\x00-\x1b\x20-\x7f{_LETTERS}{_LETTERS[3:].upper().replace('SS', '').replace('Ÿ', '')}¡¿«»§°…–—‘’“”]*")
_WORDS = re.compile(rf"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTERS}0-9]+")
CACHE_WORDS = 400_000


class _Numbers(dict):
    """Numbers of words in the order of their first look-up; ``new`` lists those not learned yet."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class WordTokenizer:
    """Encodes like the tokenizer in ``file`` (special tokens in a text included), as little-endian 32-bit ids."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the model reads the characters of a word as the tokenizer hands them to it
        plain = (chr(c) for c in range(0x2100) if _PLAIN.fullmatch(chr(c)) and not chr(c).isspace())
        self.alphabet = str.maketrans({c: "".join(part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in plain})
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.at = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split: list[list[str] | None] = []
        for t in texts:
            plain = _PLAIN.fullmatch(t) and not any(s in t for s in self.special)
            split.append(_WORDS.findall(t.lower()) if plain else None)
        if len(self.numbers) > CACHE_WORDS:
            self._forget()
        counts = [len(w) if w is not None else 0 for w in split]
        whole = [w is None for w in split]
        words = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(filter(None, split))), np.int64, sum(counts))
        del split
        self._learn()
        size = np.diff(self.at)[words]
        at = np.concatenate([[0], np.cumsum(size)])
        raw = self.ids[np.arange(at[-1]) + np.repeat(self.at[words] - at[:-1], size)].tobytes()
        edges = (4 * at[np.cumsum([0, *counts])]).tolist()
        return [self._whole(t) if w else raw[low:high] for t, w, low, high in zip(texts, whole, edges[:-1], edges[1:], strict=True)]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self) -> None:
        """Encode each new word once."""
        if not self.numbers.new:
            return
        learned = [[t.id for t in self.model.tokenize(w.translate(self.alphabet))] for w in self.numbers.new]
        self.ids = np.concatenate([self.ids, np.array(list(chain.from_iterable(learned)), dtype="<u4")])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum([len(i) for i in learned])])
        self.numbers.new.clear()
