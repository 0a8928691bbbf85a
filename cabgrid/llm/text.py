"""Words of many texts at once, as numpy arrays over the bytes of an Arrow batch.

A word is a maximal run of bytes other than space and 0x09-0x0D; UTF-8 never
uses those bytes inside a character. Hashes are computed from the bytes alone, so
equal words have equal hashes in every task and on every machine; hashes of word
windows are polynomials, modulo 2**64, over the words' mixed hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Odd multipliers of the polynomials (any odd numbers do).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
WORD_BASE_2 = 0xA0761D6478BD642F

_HASH_LANES = 1 << 16  # lanes hashed at once; bounds the scratch arrays
_LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=U64)
_KEPT_POWERS = 1 << 22
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the result."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept, grown when needed)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1024), base, dtype=U64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if n <= _KEPT_POWERS:
            _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch that hold about ``max_bytes`` of text each
    (a longer text stands alone), so scratch memory doesn't follow batch size."""
    if batch.num_rows == 0:
        return
    _, offs = string_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes unchanged."""
    return data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each text the index of its
    first word (one more entry than texts)."""
    if len(data) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offs), np.int64)
    inside = ~((data == 32) | ((data - np.uint8(9)) < 5))
    new_text = np.zeros(len(data) + 1, dtype=bool)
    new_text[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | new_text[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | new_text[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span. A span is cut into lanes of eight bytes from
    its start; each is mixed with its number, so that no two lanes add up in a way
    that bytes could be chosen for, and their sum is mixed with the span's length."""
    out = np.empty(len(starts), dtype=U64)
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = ends - starts
    lanes = np.maximum((size + 7) >> 3, 1)
    before = np.concatenate(([0], np.cumsum(lanes)))
    at = 0
    while at < len(starts):
        to = max(int(np.searchsorted(before, before[at] + _HASH_LANES, side="right")) - 1, at + 1)
        count = lanes[at:to]
        nth = np.arange(before[to] - before[at]) - np.repeat(before[at:to] - before[at], count)
        left = np.repeat(size[at:to], count) - 8 * nth
        lane = eight[np.repeat(starts[at:to], count) + 8 * nth] & _LANE_MASKS[np.minimum(left, 8)]
        mixed = mix(lane + (nth.astype(U64) + U64(1)) * U64(BYTE_BASE))
        out[at:to] = np.add.reduceat(mixed, before[at:to] - before[at])
        at = to
    return mix(out + size.astype(U64) * U64(WORD_BASE))


def hash_windows(items: np.ndarray, width: int, base: int = WORD_BASE) -> np.ndarray:
    """Hash of every ``width`` consecutive items (len(items) - width + 1 of them)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    total = np.zeros(n, dtype=U64)
    for k, p in enumerate(powers(base, width)):
        total += items[k : k + n] * p
    return mix(total)


def hash_long_windows(items: np.ndarray, width: int, base: int = WORD_BASE) -> np.ndarray:
    """The same values as :func:`hash_windows`, by prefix sums (for wide windows)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    sums = np.zeros(len(items) + 1, dtype=U64)
    np.cumsum(items * powers(base, len(items)), out=sums[1:])
    return mix((sums[width:] - sums[:n]) * powers(inverse(base), n))
