"""Words and windows of whole batches of texts as numpy arrays.

A batch is handled in blocks of about a megabyte. A block holds whole texts, or a part of one very
long text that ends between two words, so memory stays bounded however long a text is. All
hashes are sums of powers modulo 2**64, taken as differences of running sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64
_BASES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base and of its inverse, modulo 2**64."""
    have = _BASES.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, BLOCK + 1)
        up, down = np.ones(n, _U), np.ones(n, _U)
        up[1:], down[1:] = base % 2**64, pow(base, -1, 2**64)
        with np.errstate(over="ignore"):
            have = _BASES[base] = np.cumprod(up), np.cumprod(down)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array and the offsets of its rows; a null is an empty row."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of all words; a word never crosses an offset."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes."""
    if not len(starts):
        return np.zeros(0, _U)
    up, down = _powers(0x9E3779B97F4A7C15, len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * up[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about a block each, or of one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1)
        yield row, end
        row = end


def long_parts(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in parts of about a block; a part ends before a separator."""
    at = 0
    while at < len(data):
        end = at + BLOCK
        while end < len(data):
            gaps = np.flatnonzero(_SEPARATOR[data[at:end]])
            if len(gaps) and gaps[-1]:
                end = at + int(gaps[-1])
                break
            end += BLOCK
        yield data[at:end]
        at = min(end, len(data))


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, word hashes, word offsets of these rows)``, block by block."""
    for row, end in blocks(offsets):
        at = offsets[row:end + 1] - offsets[row]
        part = data[offsets[row]:offsets[end]]
        if len(part) > 2 * BLOCK:
            hashes = np.concatenate([word_hashes(p, *word_bounds(p, np.array([0, len(p)]))) for p in long_parts(part)])
            yield row, end, hashes, np.array([0, len(hashes)])
            continue
        starts, ends = word_bounds(part, at)
        yield row, end, word_hashes(part, starts, ends), np.searchsorted(starts, at)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from every place on; windows that cross texts are the caller's to drop."""
    if len(hashes) < n:
        return np.zeros(0, _U)
    up, down = _powers(0xD6E8FEB86659FD93, len(hashes) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(hashes) + 1, _U)
        np.cumsum(hashes * up[:len(hashes)], out=sums[1:])
        return mix((sums[n:] - sums[:-n]) * down[:len(hashes) - n + 1] + _U(n))


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task. Memory of those that are done goes back to the system, as worker
    processes outlive their tasks and share a machine with the executor."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row of every item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def window_places(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, row and place in its row of every window of ``n`` items that stays in a row."""
    rows = rows_of(offsets)
    items = np.arange(len(rows))
    fits = items + n <= offsets[1:][rows] if len(rows) else np.zeros(0, bool)
    items, rows = items[fits], rows[fits]
    return items, rows, items - offsets[rows]
