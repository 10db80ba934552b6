"""Words of whole texts as numpy arrays: borders and hashes for many texts at once."""

from __future__ import annotations

import numpy as np

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing: digits, letters, all beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of ``[^\x20\x09-\x0D]``.
SOLID = np.ones(256, bool)
SOLID[32] = SOLID[9:14] = False

_POSITIONS = 64
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, (_POSITIONS, 256), dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def lowered(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes in lower case, a line feed after each; and where each begins, with the end."""
    raw = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=at[1:])
    return raw, at


def borders(raw: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes of a kind."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = kind[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: equal words have equal hashes."""
    out = mix((end - start).astype(np.uint64) + np.uint64(77))
    order = np.argsort(start - end, kind="stable")  # longest first: those with a k-th byte are a prefix
    begin, lengths, total = start[order], (end - start)[order], out[order]
    k, n = 0, len(begin)
    while True:
        n = int(np.searchsorted(-lengths[:n], -k, "left"))  # lengths over k
        if not n:
            break
        if k and k % _POSITIONS == 0:
            total[:n] = mix(total[:n])
        total[:n] += _RANDOM[k % _POSITIONS][raw[begin[:n] + k]]
        k += 1
    out[order] = mix(total)
    return out
