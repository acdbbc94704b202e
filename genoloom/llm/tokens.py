"""Token ids of whole texts by the tokenizers library, with a bounded cache of words for byte-level BPE.

Byte-level BPE never merges across a word's start, so the ids of a text are the ids of its words, one after the
other. Words that a task has met before come from the cache, the others are encoded together in one call.
Texts for which that cut isn't certain (runs of white space, tabs, strings of special tokens) go whole to the library.
"""

from __future__ import annotations

import os
from codecs import charmap_decode
from itertools import chain
from functools import lru_cache
from string import punctuation

import numpy as np


WHITE = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n"]
WHITE_ASCII = [c for c in WHITE if c.isascii()]


def _cuttable(text: str) -> bool:
    """A cut before each space or line break is exact if no two white spaces stand together, none at an end, and none is of another kind."""
    if text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text:
        return False
    return not any(c in text for c in (WHITE_ASCII if text.isascii() else WHITE))


class _Words(dict):
    """Words' ids; a missing word is looked up among those of the generation before, or encoded: letters alone, which
    are one unit of the tokenizer after a space, by its model, all else by ``learn``."""

    def __init__(self, model, raw: list[bytes], space: str, spell, learn, old: dict[str, bytes]):
        super().__init__()
        self.tokenize, self.raw, self.space, self.spell, self.learn, self.old = model.tokenize, raw, space, spell, learn, old

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isalpha():
                raw = self.raw
                ids = b"".join([raw[x.id] for x in self.tokenize(self.space + (word if word.isascii() else self.spell(word)))])
            else:
                ids = self.learn(word)
        self[word] = ids
        return ids


class Encoder:
    """ids of texts as little-endian bytes; ``words`` bounds each of the cache's two generations (about 200 bytes an entry)."""

    def __init__(self, path: str, words: int = 200_000, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        if special:
            self.t.encode_special_tokens = True  # strings of special tokens are then ordinary text
        self.size = max(self.t.get_vocab(with_added_tokens=True).values()) + 1
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.specials = [] if special else [x.content for x in self.t.get_added_tokens_decoder().values()]
        line = self.t.encode("\n", add_special_tokens=False).ids
        probe = self.t.encode("a, b's\nc", add_special_tokens=False).ids
        apart = list(chain.from_iterable(self.t.encode(x, add_special_tokens=False).ids for x in ("a,", " b's", "\n", "c")))
        self.line = line[0] if len(line) == 1 and probe == apart and self.t.pre_tokenizer is not None and "ByteLevel" in str(self.t.pre_tokenizer) else None
        self.raw = [np.array([i], dtype=self.dtype).tobytes() for i in range(self.size)]
        self.tails: dict[str, bytes] = {}
        self.line_ids = self.raw[self.line] if self.line is not None else b""
        self.most = words
        #: How the vocabulary spells bytes: printable ones as themselves, the rest from U+0100 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.spelt = dict(zip([b for b in range(256) if b not in plain], range(256, 512)))
        self.space = chr(self.spelt[32])
        self.spelling = "".join(chr(self.spelt.get(b, b)) for b in range(256))
        self.cache = self._words({})
        self.pieces: list[bytes] = []

    def _words(self, old: dict[str, bytes]) -> _Words:
        return _Words(self.t.model, self.raw, self.space, self._spell, self._learn, old)

    def _spell(self, word: str) -> str:
        return charmap_decode(word.encode(), "strict", self.spelling)[0]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, word: str) -> bytes:
        """ids of a word that starts a line (marked by a line break) or holds more than letters."""
        core = word.rstrip(punctuation)
        tail = word[len(core) :]
        body = core[1:] if core[:1] == "\n" else core
        if not body.isalpha() or len(tail) > 8:
            return self.line_ids + self._plain([word[1:]])[0] if word[0] == "\n" else self._plain([" " + word])[0]
        if not tail:
            return self.line_ids + b"".join([self.raw[x.id] for x in self.cache.tokenize(self._spell(body))])
        if tail not in self.tails:
            self.tails[tail] = self._plain([tail])[0]
        return self.cache[core] + self.tails[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.line is None:
            return self._plain(texts)
        out: list[bytes] = [b""] * len(texts)
        cut, whole = [], []
        for i, x in enumerate(texts):
            if x:
                (cut if _cuttable(x) and not any(s in x for s in self.specials) else whole).append(i)
        if whole:
            for i, b in zip(whole, self._plain([texts[i] for i in whole])):
                out[i] = b
        words = [("\n" + texts[i]).replace("\n", " \n").split(" ")[1:] for i in cut]
        known, wide = self.cache, self.dtype.itemsize
        if len(known) > self.most:
            known = self.cache = self._words(dict(known))
        get = known.__getitem__
        for i, w in zip(cut, words):
            out[i] = b"".join(map(get, w))[wide:]
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The exact text of byte-level ids."""
        if not self.pieces:
            back = {v: b for b, v in self.spelt.items()}
            named = {i: t for t, i in self.t.get_vocab(with_added_tokens=False).items()}
            self.pieces = [bytes(back.get(ord(c), ord(c) & 255) for c in named.get(i, "")) for i in range(self.size)]
        return b"".join([self.pieces[i] for i in ids.tolist()]).decode()


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    return Encoder(path, special=special)


def byte_bpe() -> str:
    """Where the public byte-level vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
