"""Word shingles of texts as sets of 64-bit hashes, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: the contract's word: no space, tab, line feed, vertical tab, form feed or carriage return
SPACES = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 20        # bytes of text hashed at once; a longer text goes alone

_RNG = np.random.default_rng(64)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of ``k`` consecutive words; a text of fewer words is one shingle,
    a text without words (or null) the empty set.  A-Z count as a-z."""

    def __init__(self, k: int):
        self.k = k
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n, s, np.uint64)]) for s in (_STEP, _BACK))

    def _words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hash, begin) of each word."""
        b = np.frombuffer(raw, np.uint8)
        self._powers(len(b))
        gap = np.r_[True, _IS_SPACE[b], True]
        begin = np.flatnonzero(gap[:-2] & ~gap[1:-1])
        end = np.flatnonzero(~gap[1:-1] & gap[2:]) + 1
        total = np.r_[np.uint64(0), np.cumsum(_BYTE[b] * self.up[:len(b)])]
        return mix((total[end] - total[begin]) * self.down[begin] + (end - begin).astype(np.uint64)), begin

    def word_hashes(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The hash of each word of each text, in order."""
        raws = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
        i = 0
        while i < len(raws):
            j, held = i, 0
            while j < len(raws) and (j == i or held + len(raws[j]) <= CHUNK_BYTES):
                held += len(raws[j]) + 1
                j += 1
            words, begin = self._words(b" ".join(raws[i:j]))
            cuts = np.searchsorted(begin, np.cumsum([0, *(len(r) + 1 for r in raws[i:j])]))
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield words[a:b]
            i = j

    def join(self, words: np.ndarray) -> np.ndarray:
        """The hash of each ``k`` consecutive words."""
        out = np.zeros(max(0, len(words) - self.k + 1), np.uint64)
        for d in range(self.k):
            out = mix(out + words[d:d + len(out)] + np.uint64(d + 1))
        return out

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        for words in self.word_hashes(texts):
            if len(words) >= self.k:
                yield np.unique(self.join(words))
            elif len(words):
                one = np.zeros(1, np.uint64)
                for d in range(len(words)):
                    one = mix(one + words[d:d + 1] + np.uint64(d + 1))
                yield mix(one + np.uint64(len(words)))
            else:
                yield np.zeros(0, np.uint64)
