"""Words, and hashes of runs of words, for whole batches of texts in numpy.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``, with A-Z in lower case. Hashes have
64 bits and depend on the words only, so all tasks agree on them. Those of short words are polynomials
modulo 2**64, which repeat for long words of a certain make (Thue-Morse); longer words have BLAKE2b hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np

#: Texts are hashed in chunks of about so many bytes; longer texts are cut between words.
CHUNK_BYTES = 1 << 20
#: Bytes of a word whose hash is a polynomial, at most.
SHORT = 32

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLANK = re.compile(rb"[ \t-\r]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit; one for each seed."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64), 3)
_SOLID = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
    up, down = np.full(n, _ODD), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a chunk, and where they start."""
    lowered = data.translate(_LOWER)
    raw = np.frombuffer(lowered, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = _SOLID[raw]
    edges = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    edges = np.concatenate([[0] * bool(solid[0]), edges, [len(raw)] * bool(solid[-1])]).astype(np.int64)
    starts, ends = edges[::2], edges[1::2]
    size = 1 << int(len(raw)).bit_length()
    up, down = _powers(max(size, 2 * CHUNK_BYTES))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * down[starts], 1)
    for k in np.flatnonzero(ends - starts > SHORT).tolist():
        word = lowered[starts[k] : ends[k]]
        hashes[k] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
    return hashes, starts


def word_hashes(texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of the words, number of words of each text) for chunks of whole texts."""
    held: list[bytes] = []
    size = 0

    def flush() -> tuple[np.ndarray, np.ndarray]:
        hashes, at = _hash_words(b"\n".join(held))
        bounds = np.cumsum([len(t) + 1 for t in held])
        return hashes, np.diff(np.searchsorted(at, bounds), prepend=0)

    for text in texts:
        data = text.encode()
        if len(data) > CHUNK_BYTES:
            if held:
                yield flush()
                held, size = [], 0
            yield _long(data)
            continue
        held.append(data)
        size += len(data) + 1
        if size > CHUNK_BYTES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _long(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts, start = [], 0
    while start < len(data):
        cut = _BLANK.search(data, start + CHUNK_BYTES)
        end = cut.start() if cut else len(data)
        parts.append(_hash_words(data[start:end])[0])
        start = end
    hashes = np.concatenate(parts)
    return hashes, np.array([len(hashes)])


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of the ``k`` words from each word on; ``len(hashes) - k + 1`` of them."""
    n = len(hashes) - k + 1
    out = hashes[:n].copy()
    for step in range(1, k):
        out = out * _ODD + hashes[step : step + n]
    return mix(out, 2)


def shingle_sets(texts: Iterable[str], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct ``k``-word shingles.

    A text of fewer words has its whole sequence as the only one, a text without words none.
    """
    for hashes, counts in word_hashes(texts):
        shingles = runs(hashes, k) if len(hashes) >= k else np.zeros(0, np.uint64)
        start = 0
        for n in counts.tolist():
            if n >= k:
                found = np.sort(shingles[start : start + n - k + 1])
                keep = np.ones(len(found), dtype=bool)
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                yield found[keep]
            elif n:
                yield mix(runs(hashes[start : start + n], n), 100 + n)
            else:
                yield np.zeros(0, np.uint64)
            start += n
