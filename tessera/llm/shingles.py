"""Word shingles of texts as sorted 64-bit hashes.

Words are the runs of bytes between ASCII white space after A-Z are lower-cased. A word stands by a 128-bit cryptographic
digest, so no two words can be made that stand alike; a shingle is a chain of mixing steps over both halves of the digests
of its words, in order.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np

WIDTH = 5
#: Bytes of text whose words are looked up at a time, unless a single word is longer.
CHUNK = 1 << 21
#: Distinct words whose digests a worker keeps, and the bytes of such a word at most; the cache starts anew beyond.
CACHE, KEPT_WORD = 200_000, 64

_LOWER = bytes(range(256)).lower()  # A-Z only
_SPACE = re.compile(rb"[ \t-\r]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Digests(dict):
    """Word to the 16 bytes of its digest."""

    def __missing__(self, word: bytes) -> bytes:
        found = blake2b(word, digest_size=16).digest()
        if len(word) <= KEPT_WORD:
            if len(self) >= CACHE:
                self.clear()
            self[word] = found
        return found


_digests = _Digests()


def _parts(data: bytes):
    """A long text in stretches of about CHUNK bytes that end at white space."""
    at = 0
    while at < len(data):
        space = _SPACE.search(data, at + CHUNK) if len(data) - at > CHUNK else None
        upto = space.start() if space else len(data)
        yield data[at:upto] if upto - at < len(data) else data
        at = upto


def words(text: str | None) -> np.ndarray:
    """(words, 2) halves of the digests of all words in order."""
    data = (text or "").encode().translate(_LOWER)
    found = [b"".join(map(_digests.__getitem__, part.split())) for part in _parts(data)]
    return np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)


def _chained(halves: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words."""
    count = len(halves) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = mix(out ^ halves[k : k + count, 0])
        out += halves[k : k + count, 1]
    return mix(out)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted; a text of fewer than WIDTH words has its whole sequence as one."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        group, total = [], 0
        while at < len(texts) and total < 1 << 18:
            group.append(words(texts[at]))
            total += len(group[-1])
            at += 1
        # the shingles of all texts of a group at once; those that reach over an end are left out
        every = _chained(np.concatenate(group), WIDTH) if total >= WIDTH else None
        first = 0
        for halves in group:
            n = len(halves)
            if n >= WIDTH:
                out.append(np.unique(every[first : first + n - WIDTH + 1]))
            else:
                out.append(_chained(halves, n) if n else np.zeros(0, np.uint64))
            first += n
    return out
