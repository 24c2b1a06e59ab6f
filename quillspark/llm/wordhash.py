"""Words, word hashes and shingles of many texts at once, in numpy."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

#: Odd multipliers and the finaliser of a 64-bit mix.
BASE, STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX_A, MIX_B = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_VALUES = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype="u8") * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(MIX_A)
    x ^= x >> np.uint64(33)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(33)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 18)
        for name, factor in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            row = np.full(size, factor, "u8")
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of texts, A-Z lower-cased: where they stand, whose they are, their hashes."""

    def __init__(self, texts: list[bytes]) -> None:
        joined = b" ".join([*texts, b""])
        self.raw = np.frombuffer(joined, "u1")
        low = np.frombuffer(joined.lower(), "u1")
        blank = (low == 32) | ((low >= 9) & (low <= 13))
        edge = np.diff(np.concatenate([[True], blank]).astype("i1"))
        self.starts, self.ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _powers(len(low))
        sums = np.concatenate([np.zeros(1, "u8"), np.cumsum(_VALUES[low] * up, dtype="u8")])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])
        sizes = np.array([len(t) + 1 for t in texts], "i8")
        self.text_starts = np.cumsum(sizes) - sizes
        self.text_ends = self.text_starts + sizes - 1
        #: Words of text k are first[k] to first[k + 1].
        self.first = np.searchsorted(self.starts, np.concatenate([self.text_starts, [len(low)]])).astype("i8")

    def shingles(self, size: int = 5) -> list[np.ndarray]:
        """For each text the distinct hashes, in order, of its runs of `size` words; a shorter text is one run."""
        h = self.hashes
        n = len(h)
        rolled = np.zeros(max(0, n - size + 1), "u8")
        factor = 1
        for k in range(size):
            rolled += h[k : k + len(rolled)] * np.uint64(factor)
            factor = factor * STEP % (1 << 64)
        rolled = mix(rolled)
        out = []
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if b - a >= size:
                out.append(np.unique(rolled[a : b - size + 1]))
            elif b > a:
                whole = b - a
                for k in range(a, b):
                    whole = (whole * STEP + int(h[k])) % (1 << 64)
                out.append(mix(np.array([whole], "u8")))
            else:
                out.append(np.zeros(0, "u8"))
        return out


def trim() -> None:
    """Give memory that arrays and sets have left free back to the system, as a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc():
    try:
        found = ctypes.CDLL("libc.so.6")
    except OSError:  # another system's library; nothing is lost but this
        return None
    return found if hasattr(found, "malloc_trim") else None


_LIBC = _libc()


def together(ids: list, texts, limit: int = 250_000):
    """(ids, UTF-8 texts) in runs of about `limit` bytes, which bounds what numpy holds at once; a null text is empty."""
    held, body, size = [], [], 0
    for i, text in zip(ids, texts, strict=True):
        raw = (text.as_py() or "").encode()
        held.append(i)
        body.append(raw)
        size += len(raw)
        if size > limit:
            yield held, body
            held, body, size = [], [], 0
    if held:
        yield held, body
    trim()
