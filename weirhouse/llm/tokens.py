"""Token ids of whole texts, with the ids of frequent pieces remembered per worker.

The vocabulary drops white space and never joins across it, so a text's ids are the ids
of its space-separated pieces, one after the other; likewise those of a piece of letters
and trailing marks are the ids of both parts.  Pieces that a worker has not seen go
to the tokenizers library: plain words many at a time (each ends in a token that only ends
words, which shows where to cut), all else as texts of their own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

import numpy as np

from weirhouse.llm.common import caches

KNOWN_PIECES = 400_000
GROUP = 512
WORD_END = "</w>"
#: Letters that no normal form changes, then marks; no apostrophe, which the vocabulary treats by rule.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
#: A full stop or comma that ends a piece, right after a letter as above or a digit, so in no longer run of marks.
STOP = re.compile("[.,](?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ][.,]) ")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PieceEncoder:
    """``encode(texts)``: each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, known_pieces: int = KNOWN_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.known_pieces = known_pieces

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _words(self, words: list[str]) -> None:
        """Ids of plain lower-case words, in groups."""
        groups = [words[at : at + GROUP] for at in range(0, len(words), GROUP)]
        coded = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, coded, strict=True):
            ids = np.asarray(found.ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):
                self.words.update((w, self._ids(w).tobytes()) for w in group)
                continue
            raw, bounds = ids.tobytes(), [0, *(ends * 4).tolist()]
            self.words.update((w, raw[a:b]) for w, a, b in zip(group, bounds, bounds[1:], strict=False))

    def _pieces(self, text: str) -> list[str]:
        return STOP.sub(r" \g<0>", text.replace("\n", " ")).split(" ")

    def _learn(self, pieces: Iterable[str]) -> set[str]:
        """Puts the pieces' ids into ``pieces``; returns the words new to ``words``."""
        plain, others, match = [], [], PLAIN.fullmatch
        for p in pieces:
            if m := match(p):
                plain.append((p, m[1].lower(), m[2]))
            else:
                others.append(p)
        coded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        self.pieces.update((p, np.asarray(c.ids, dtype="<u4").tobytes()) for p, c in zip(others, coded, strict=True))
        fresh = {w for _, w, _ in plain}.union(x for _, _, x in plain if x).difference(self.words)
        self._words(sorted(fresh))
        words = self.words
        self.pieces.update((p, words[w] + words[x] if x else words[w]) for p, w, x in plain)
        return fresh

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [self._pieces(t) for t in texts]
        unseen = set().union(*parts).difference(self.pieces)
        new_words = self._learn(unseen)
        get = self.pieces.__getitem__
        out = [b"".join(map(get, p)) for p in parts]
        for kept, new in ((self.pieces, unseen), (self.words, new_words)):
            if len(kept) > self.known_pieces:
                for p in new:
                    del kept[p]
        return out


_encoders: dict[str, PieceEncoder] = {}
caches.append(_encoders.clear)


def encoder(path: str) -> PieceEncoder:
    """One per worker and file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]
