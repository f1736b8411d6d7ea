"""Five-word shingles as 64-bit numbers, batch by batch in numpy."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

WIDTH = 5
CACHED_WORDS = 500_000          # a worker's table of word numbers is emptied beyond this
_WORDS: dict[bytes, int] = {}
_FACTORS = np.array([pow(6364136223846793005, WIDTH - 1 - i, 2**64) for i in range(WIDTH)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks, tabs, line feeds, VT, FF and CR, with A-Z lowered: what bytes do of themselves."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; under five words the whole sequence is one, without words none."""
    words = [words_of(t) for t in texts]
    if len(_WORDS) > CACHED_WORDS:
        _WORDS.clear()
    for word in set().union(*words):
        if word not in _WORDS:
            _WORDS[word] = xxhash.xxh64_intdigest(word)
    sizes = [len(own) for own in words]
    numbers = np.fromiter((_WORDS[w] for own in words for w in own), np.uint64, sum(sizes))
    n = max(len(numbers) - WIDTH + 1, 0)
    with np.errstate(over="ignore"):        # over the texts laid end to end; windows across two texts are not taken
        total = numbers[:n] * _FACTORS[0]
        for i in range(1, WIDTH):
            total += numbers[i:i + n] * _FACTORS[i]
        total = mix(total)
    out, at = [], 0
    for own, size in zip(words, sizes):
        if size < WIDTH:
            out.append(np.array([xxhash.xxh64_intdigest(b" ".join(own), seed=size)] if own else [], np.uint64))
        else:
            found = np.sort(total[at:at + size - WIDTH + 1])
            new = np.ones(len(found), dtype=bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            out.append(found[new])
        at += size
    return out


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()
