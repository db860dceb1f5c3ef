"""Word and shingle hashes of whole texts, vectorised over Arrow columns.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` after A-Z are lower-cased (other
letters stay as they are). Its hash is a polynomial over random 64-bit byte values, finished by a
mixing step. Texts are read in pieces of ``PIECE`` bytes with the unfinished word carried over, so
memory does not depend on the longest text or word. Two different shingles share a 64-bit hash
with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: Shingle length in words and the similarity (in percent) that counts as near.
SHINGLE, NEAR = 5, 75

_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_cache: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables() -> dict[str, np.ndarray]:
    if not _cache:
        codes = np.arange(256, dtype=np.uint8)
        lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint8)
        values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
        _cache["value"] = values[lower]
        space = np.zeros(256, dtype=bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        _cache["space"] = space
        inverse = pow(_MULT, -1, 1 << 64)
        for name, base in (("power", _MULT), ("inverse", inverse)):
            steps = np.full(PIECE + 1, base, dtype=np.uint64)
            steps[0] = 1
            _cache[name] = np.multiply.accumulate(steps)
    return _cache


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    size = len(column)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + size + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body, offs


def pieces_of_rows(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` bytes each (one row may be longer)."""
    a, rows = 0, len(offsets) - 1
    while a < rows:
        b = int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1
        b = min(max(b, a + 1), rows)
        yield a, b
        a = b


def _words_in(data: np.ndarray, starts_of_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word sums (unmixed), starts and ends in one piece of at most PIECE bytes."""
    t = _tables()
    solid = ~t["space"][data]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = solid[:-1]
    before[starts_of_rows] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = solid[1:]
    after[starts_of_rows[starts_of_rows > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(t["value"][data] * t["power"][:len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * t["inverse"][starts], starts, ends


def _long_text_words(data: np.ndarray) -> np.ndarray:
    """Unmixed word sums of one text longer than a piece."""
    out, carry, carried = [], 0, 0
    space = _tables()["space"]
    for at in range(0, len(data), PIECE):
        part = data[at:at + PIECE]
        sums, starts, ends = _words_in(part, np.zeros(1, dtype=np.int64))
        if carried and (not len(starts) or starts[0] != 0):
            out.append(np.array([carry], dtype=np.uint64))
            carry = carried = 0
        if carried:
            joined = (carry + int(sums[0]) * pow(_MULT, carried, 1 << 64)) & _MASK
            sums[0] = joined
        if len(ends) and ends[-1] == len(part) and not space[part[-1]]:
            length = int(ends[-1] - starts[-1]) + (carried if len(starts) == 1 and starts[0] == 0 else 0)
            carry, carried = int(sums[-1]), length
            sums = sums[:-1]
        else:
            carry = carried = 0
        out.append(sums)
    if carried:
        out.append(np.array([carry], dtype=np.uint64))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every row) of rows that lie in one buffer."""
    low, high = int(offsets[0]), int(offsets[-1])
    if high - low > PIECE:
        assert len(offsets) == 2, "only a single row may be longer than a piece"
        words = mix(_long_text_words(body[low:high]))
        return words, np.array([len(words)], dtype=np.int64)
    data = body[low:high]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    rows = offsets - low
    sums, starts, _ = _words_in(data, np.unique(rows[:-1][rows[:-1] < len(data)]))
    counts = np.diff(np.searchsorted(starts, rows))
    return mix(sums), counts.astype(np.int64)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, row of each): runs of ``size`` words; a shorter row is one shingle."""
    ends = np.cumsum(counts)
    firsts = ends - counts
    row_of = np.repeat(np.arange(len(counts)), counts)
    step = np.uint64(0xD6E8FEB86659FD93)
    if len(words) >= size:
        n = len(words) - size + 1
        acc = words[:n].copy()
        for k in range(1, size):
            acc *= step
            acc += words[k:k + n]
        whole = row_of[:n] == row_of[size - 1:]
        full, rows = mix(acc[whole]), row_of[:n][whole]
    else:
        full, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for i, r in enumerate(short):
            value = int(counts[r])
            for w in words[firsts[r]:ends[r]]:
                value = (value * 0xA0761D6478BD642F + int(w)) & _MASK
            extra[i] = value
        full, rows = np.concatenate([full, mix(extra)]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        full, rows = full[order], rows[order]
    return full, rows


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, sorted distinct shingle hashes) of every text."""
    body, offsets = text_buffers(column)
    for a, b in pieces_of_rows(offsets):
        words, counts = word_hashes(body, offsets[a:b + 1])
        hashes, rows = shingle_hashes(words, counts, size)
        cuts = np.searchsorted(rows, np.arange(b - a + 1))
        for i in range(b - a):
            yield a + i, np.unique(hashes[cuts[i]:cuts[i + 1]])
