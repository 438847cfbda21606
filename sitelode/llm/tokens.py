"""Token ids of whole Arrow batches, each distinct word encoded once.

No token of these vocabularies crosses white space, nor the place where a letter of A-Z meets
a mark such as a comma, so a text's ids are those of its words one after the other. They also
do not depend on the case of A-Z. Words are found and told apart by hash with numpy; only
words not seen lately are handed to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa

from .words import find_words, hash_spans, steps, word_hashes


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
# Marks that end a run of letters. The apostrophe may begin a contraction, and < | > belong to special tokens.
_MARK = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~", np.uint8))


def _byte_letters() -> dict[int, str]:
    """Byte-level letters of the vocabulary for characters below U+0100: a printable byte is itself, others follow U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in printable]
    letter = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


_BYTE_LETTERS = _byte_letters()


class Encoder:
    """A tokenizer file of a vocabulary that drops white space, with a bounded store of encoded words."""

    _shared: ClassVar[dict[str, Encoder]] = {}

    def __init__(self, path: str, kept_words: int = 400_000) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept_words = kept_words
        self._clear()

    @classmethod
    def shared(cls, path: str) -> Encoder:
        """One encoder for all tasks of a Python worker."""
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.places = np.zeros(0, np.int64)
        self.begins = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> list[list[int]]:
        """Ids of single words; runs of Latin letters go straight to the tokenizer's model."""
        split = self.tokenizer.model.tokenize
        out: list[list[int]] = [[]] * len(words)
        others = []
        for i, word in enumerate(words):
            if word.isalpha() and max(word) < "\u0100":
                out[i] = [t.id for t in split(word.lower().translate(_BYTE_LETTERS))]
            else:
                others.append(i)
        whole = self.tokenizer.encode_batch_fast([words[i] for i in others], add_special_tokens=False)
        for i, encoded in zip(others, whole):
            out[i] = encoded.ids
        return out

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of a run of texts and their bounds; a null text is empty."""
        for part in steps(texts):
            cuts = np.zeros(len(part.buffer), bool)
            cuts[1:] = _LETTER[part.buffer[:-1]] & _MARK[part.buffer[1:]]
            found = find_words(part, cuts=cuts)
            hashes = word_hashes(part, found, lower=True)
            # Special tokens are told from their upper-case spellings.
            special = np.flatnonzero(np.add.reduceat(part.buffer == 60, found.starts)) if len(found.starts) else []
            if len(special):
                hashes[special] = hash_spans(part.buffer, found.starts[special], found.ends[special]) ^ np.uint64(1)
            distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.begins) - 1 > self.kept_words:
                self._clear()
            at = np.searchsorted(self.hashes, distinct)
            known = at < len(self.hashes)
            known[known] = self.hashes[at[known]] == distinct[known]
            place = np.zeros(len(distinct), np.int64)
            place[known] = self.places[at[known]]
            new = np.flatnonzero(~known)
            if len(new):
                data = part.buffer.tobytes()
                spans = zip(found.starts[first[new]].tolist(), found.ends[first[new]].tolist())
                encoded = self._encode([data[a:b].decode("utf-8", "replace") for a, b in spans])
                sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
                place[new] = len(self.begins) - 1 + np.arange(len(new))
                self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(sizes)))
                flat = np.fromiter((i for e in encoded for i in e), np.uint32, int(sizes.sum()))
                self.ids = np.concatenate((self.ids, flat))
                spot = np.searchsorted(self.hashes, distinct[new])
                self.hashes = np.insert(self.hashes, spot, distinct[new])
                self.places = np.insert(self.places, spot, place[new])
            word = place[inverse]
            sizes = self.begins[word + 1] - self.begins[word]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            source = np.arange(total) + np.repeat(self.begins[word] - (ends - sizes), sizes)
            yield self.ids[source], np.concatenate(([0], ends))[found.bounds]
