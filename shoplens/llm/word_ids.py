"""Word-wise cached encoding with the word-end BPE vocabulary.

The vocabulary's splitter drops white space and encodes each match alone,
so a text's ids are its words' ids joined. Words are looked up in a cache
and only unseen ones go to the tokenizer, one call per batch of texts.
Texts with characters outside the range below, or with the literal special
tokens, go to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

#: Characters for which NFC is the identity, lower-casing works letter by letter
#: and the classes below equal the splitter's Unicode classes; those whose lower
#: case leaves the range are not among them.
_SAFE = [chr(c) for c in (*range(9, 14), *range(0x20, 0x7F), *range(0xA0, 0x250))]
_SAFE = "".join(c for c in _SAFE if set(c.lower()) <= set(_SAFE))
_OTHER = re.compile(rf"[^{re.escape(_SAFE)}]|<\|(?:startoftext|endoftext)\|>")
# The splitter's pattern, with its classes spelled out for that range.
_LETTER = "a-zªµºß-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")

#: Words per generation of the cache; two are kept (about 200 bytes a word).
CACHE_WORDS = 400_000
#: Unseen words that go to the tokenizer as one text.
JOINED = 256


class WordEncoder:
    """``encode(texts)``: each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._limit = cache_words
        self._ids: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        vocab = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self._ends_word[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of single words; every word's last piece carries the word-end mark."""
        out: list[bytes] = []
        runs = [words[k:k + JOINED] for k in range(0, len(words), JOINED)]
        for run, ids in zip(runs, self._library([" ".join(r) for r in runs])):
            ends = (np.flatnonzero(self._ends_word[np.frombuffer(ids, "<u4")]) + 1) * 4
            if len(ends) == len(run):
                out.extend(ids[lo:hi] for lo, hi in zip([0, *ends.tolist()], ends.tolist()))
            else:
                out.extend(self._library(run))
        return out

    def _learn(self, words: set[str]) -> None:
        if len(self._ids) > self._limit:
            self._older, self._ids = self._ids, {}
        older = self._older
        known = {w: older[w] for w in words if w in older} if older else {}
        unseen = list(words.difference(known)) if known else list(words)
        self._ids.update(known)
        self._ids.update(zip(unseen, self._encode_words(unseen)))

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole, gaps, unseen = [], [], set()
        find = self._ids.get
        for i, text in enumerate(texts):
            if _OTHER.search(text):
                whole.append(i)
                continue
            words = _WORD.findall(text.lower())
            ids = list(map(find, words))
            if None in ids:
                new = {k: words[k] for k, x in enumerate(ids) if x is None}
                unseen.update(new.values())
                gaps.append((i, ids, new))
            else:
                out[i] = b"".join(ids)
        if gaps:
            self._learn(unseen)
            for i, ids, new in gaps:
                for k, word in new.items():
                    ids[k] = self._ids[word]
                out[i] = b"".join(ids)
        if whole:
            for i, found in zip(whole, self._library([texts[i] for i in whole])):
                out[i] = found
        return out


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker: tasks that follow find its cache filled."""
    return WordEncoder(path)
