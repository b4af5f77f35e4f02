"""Vectorised tokens for work inside Arrow tasks.

Texts are handled as the UTF-8 bytes of an Arrow column.  Both word
classes of the operators are unions of ASCII ranges plus every non-ASCII
character, so a byte table decides them exactly (all bytes of a
non-ASCII character are >= 0x80).  A word is known by a 64-bit hash of
its lower-cased (A-Z only) bytes.
"""

from __future__ import annotations

import ctypes
import ctypes.util

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 19          # bytes hashed at a time; bounds the work arrays
_rng = np.random.RandomState(20240611)
_BYTE = (_rng.randint(0, 1 << 62, 256).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_ODD = (_rng.randint(0, 1 << 62, 64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words of runs without ASCII white space: ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False

#: Words of digits, lower-case letters and non-ASCII characters:
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


_LIBC = ctypes.CDLL(ctypes.util.find_library("c") or None)


def trim() -> None:
    """Give freed memory back to the system; workers wait between tasks with
    what they hold, and share their executor's memory with its JVM."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all its bits depend on all inputs."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts and their n + 1 offsets (null: empty)."""
    column = column.fill_null("").cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None and len(at) else np.empty(0, np.uint8)
    return LOWER[data], (at - at[0] if len(at) else np.zeros(1, np.int64))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
    """Word starts, ends (bytes) and the first word of each text (n + 1)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    word = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | cut[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n).bit_length())
    if size not in _POWERS:
        inverse = pow(_BASE, -1, 1 << 64)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        if size > _BLOCK * 4:                      # one word of many megabytes: not kept
            return np.cumprod(up), np.cumprod(down)
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: a polynomial of its bytes from prefix sums."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _BLOCK, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE[data[lo:hi]] * up[:hi - lo], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def shingles(h: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles and the text each belongs to.

    A text with fewer words, but not none, gives its whole sequence as one.
    """
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)
    left = first[1:][text] - np.arange(len(h)) if len(h) else np.empty(0, np.int64)
    g = np.zeros(len(h), np.uint64)
    for j in range(k):
        g[:len(h) - j] += h[j:] * _ODD[j]
    full = np.flatnonzero(left >= k)
    out, owner = [mix(g[full])], [text[full]]
    for m in range(1, k):
        short = np.flatnonzero(n == m)
        if len(short):
            whole = np.full(len(short), m, np.uint64)
            for j in range(m):
                whole += h[first[short] + j] * _ODD[k + m * k + j]
            out.append(mix(whole))
            owner.append(short)
    return np.concatenate(out), np.concatenate(owner)


def distinct(g: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, by text and then by hash."""
    order = np.lexsort((g, owner)) if len(g) else np.empty(0, np.int64)
    g, owner = g[order], owner[order]
    keep = np.ones(len(g), bool)
    keep[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
    return g[keep], owner[keep]


def pieces(column: pa.Array, most: int = 4 << 20):
    """Slices (start, stop) of a column with about ``most`` bytes each; a
    longer text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    through = np.cumsum(size)
    start = 0
    while start < len(size):
        before = through[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(through, before + most, side="right")))
        yield start, stop
        start = stop
        trim()
