"""Ids of whole texts by the tokenizers library, each different word encoded once.

A byte-level tokenizer splits a text before it merges, and never inside white
space and the word after it in a way that depends on other words: a word with the
space before it, and a run of white space less its last character, are split off
wherever they stand. Their ids are therefore kept (in a memo of bounded size, for
all tasks of a Python worker) and joined. New words are encoded many at a time, as
one text that is cut again where the bytes of the ids add up to a word's. Texts for which that needn't hold, and
tokenizers of another kind, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache
from itertools import chain

import numpy as np

#: Words with their ids that a Python worker keeps; further ones are encoded where they occur.
MEMO_WORDS = 1 << 19
#: Texts encoded in one call, and words joined to one text.
BATCH = 4096
JOINED = 256
_WORD = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# White space to Python's expressions only.
_ODD_SPACE = "\x1c-\x1f"


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens."""

    def __init__(self, data: bytes, memo_words: int = MEMO_WORDS) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker on every core
        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.memo: dict[str, bytes] = {}
        self.memo_words = memo_words
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([f"[{_ODD_SPACE}]", *added]))
        self.by_word = self._splits_at_words(json.loads(data))
        vocabulary = self.tokenizer.get_vocab() if self.by_word else {}
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for piece, i in vocabulary.items():
            self.bytes_of[i] = len(piece)  # a character for each byte

    @staticmethod
    def _splits_at_words(file: dict) -> bool:
        before = file.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
        return plain and file.get("normalizer") is None

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), BATCH):
            for e in self.tokenizer.encode_batch_fast(texts[i : i + BATCH], add_special_tokens=False):
                ids = e.ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
        return out

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of different words; those that begin with a space are joined."""
        joined = [w for w in words if w[0] == " " and len(w) > 1 and not w[1].isspace()]
        single = set(words).difference(joined)
        found = dict(zip(single, self._encode(list(single))))
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        for group, raw in zip(groups, self._encode(["".join(g) for g in groups])):
            ends = np.cumsum(self.bytes_of[np.frombuffer(raw, dtype="<u4")])
            cuts = 4 * (np.searchsorted(ends, np.cumsum([len(w.encode()) for w in group])) + 1)
            found.update((w, raw[a:b]) for w, a, b in zip(group, [0, *cuts.tolist()], cuts.tolist()))
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        words = [None if self.whole.search(t) else _WORD.findall(t) for t in texts]
        new = list(set(chain.from_iterable(w for w in words if w)).difference(self.memo))
        found = self._encode_words(new)
        if len(self.memo) + len(found) <= self.memo_words:
            self.memo.update(found)
            of = self.memo.__getitem__
        else:
            of = lambda w: self.memo.get(w) or found[w]
        return [self._encode([t])[0] if w is None else b"".join(map(of, w)) for t, w in zip(texts, words)]


@lru_cache(maxsize=2)
def encoder(data: bytes) -> Encoder:
    """The encoder of a tokenizer's file, one for all tasks of a Python worker."""
    return Encoder(data)


def read_tokenizer(path: str) -> bytes:
    """A tokenizer's file; a vocabulary of bounded size, sent to the tasks as bytes."""
    with open(path, "rb") as f:
        return f.read()
