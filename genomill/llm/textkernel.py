"""Vectorised word kernels over Arrow string columns.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D`` within one
text; upper-case A-Z is folded to lower case.  Words are never built as Python
objects: a block of UTF-8 bytes is hashed at once.  A word's 64-bit identity is
``mix(sum(T[b_j] * B**j))`` over its bytes, with fixed odd random multipliers, so that
equal words have equal identities in every process and on every machine.

Blocks are cut at word boundaries (``BLOCK`` bytes), so working memory is bounded by
the block, or by one word if a single word is longer than that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 17
_RNG = np.random.Generator(np.random.PCG64(20260816))
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _TABLE.copy()
_FOLDED[65:91] = _TABLE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**j and B**-j for j < n, kept for later blocks while they are of usual size."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        up = np.full(n, _BASE, dtype=np.uint64)
        down = np.full(n, _BASE_INV, dtype=np.uint64)
        up[0] = down[0] = 1
        pair = np.cumprod(up), np.cumprod(down)
        if n > 4 * BLOCK:
            return pair
        _POWERS["up"], _POWERS["down"] = pair
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (in place when it can)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    _, offs, data = column.buffers()
    at = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    if not len(at):
        return raw[:0], np.zeros(1, np.int64)
    return raw[at[0] : at[-1]], at - at[0]


def spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges [start, end) of the words; no word crosses the end of a text."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    space = (raw == 0x20) | (raw - np.uint8(9) < 5)
    first = ~space
    first[1:] &= space[:-1]
    heads = at[:-1][(at[:-1] < at[1:])]
    first[heads] = ~space[heads]
    last = ~space
    last[:-1] &= space[1:]
    tails = at[1:][(at[:-1] < at[1:])] - 1
    last[tails] = ~space[tails]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _blocks(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    i, n = 0, len(starts)
    while i < n:
        j = int(np.searchsorted(ends, starts[i] + BLOCK, side="right"))
        j = max(j, i + 1)
        yield i, j
        i = j


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit identities of byte ranges in ascending order that do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _FOLDED if fold else _TABLE
    for i, j in _blocks(starts, ends):
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = powers(hi - lo)
        total = np.empty(hi - lo + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(table[raw[lo:hi]] * up, out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * down[s]
    return mix(out)


def words(column: pa.Array | pa.ChunkedArray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Identities of all words of a column, and the n + 1 word offsets of its texts."""
    raw, at = buffers(column)
    starts, ends = spans(raw, at)
    return span_hashes(raw, starts, ends, fold), np.searchsorted(starts, at)


def shingles(ids: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Identities of word runs of ``size``; a shorter text that has words gives one run of
    all of them.  Returns them with the n + 1 offsets of the texts."""
    counts = np.diff(at)
    kept = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    to = np.concatenate([[0], np.cumsum(kept)])
    out = np.empty(int(to[-1]), dtype=np.uint64)
    if not len(out):
        return out, to
    whole = counts >= size
    first = np.repeat(at[:-1] - to[:-1], kept) + np.arange(len(out))
    padded = np.concatenate([ids, np.zeros(size, np.uint64)])
    run = np.zeros(len(out), dtype=np.uint64)
    for k in range(size):
        run = (run + padded[first + k]) * _BASE
        run ^= run >> np.uint64(29)
    out[:] = mix(run)
    for d in np.flatnonzero(~whole & (counts > 0)):
        x = 0x51ED270B9F0D3B1D * (int(counts[d]) + 1)
        for w in ids[at[d] : at[d + 1]]:
            x = (((x + int(w)) * int(_BASE)) ^ (x >> 29)) & (2**64 - 1)
        out[to[d]] = mix(np.array([x], dtype=np.uint64))[0]
    return out, to


def grouped_order(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The order by owner, then value; owners are small numbers."""
    order = np.argsort(values, kind="stable" if values.dtype.itemsize == 1 else None)
    if len(owner) and int(owner.max()) < 1 << 16:  # a stable sort of 16-bit keys is a radix sort
        return order[np.argsort(owner[order].astype(np.uint16), kind="stable")]
    return np.lexsort((values, owner))


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, with new offsets."""
    n = np.diff(at)
    parts, sizes = [], np.zeros(len(n), np.int64)
    for a, b in text_blocks(at, 1 << 17):
        v, o = values[at[a] : at[b]], np.repeat(np.arange(b - a), n[a:b])
        order = grouped_order(o, v) if b - a > 1 else np.argsort(v)
        v, o = v[order], o[order]
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        parts.append(v[new])
        sizes[a:b] = np.bincount(o[new], minlength=b - a)
    out = np.concatenate(parts) if parts else values[:0]
    return out, np.concatenate([[0], np.cumsum(sizes)])


def packed(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sorted keys of 16 bits of owner and the upper 48 of a hash: one plain sort."""
    return np.sort((owner.astype(np.uint64) << np.uint64(48)) | (values >> np.uint64(16)))


def distinct_upper(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``distinct``, on the upper 48 bits of the values (the lower ones become 0)."""
    n = np.diff(at)
    parts, sizes = [], np.zeros(len(n), np.int64)
    for a, b in text_blocks(at, 1 << 16, 1 << 16):
        keys = packed(np.repeat(np.arange(b - a), n[a:b]), values[at[a] : at[b]])
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
        parts.append(keys << np.uint64(16))
        sizes[a:b] = np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=b - a)
    out = np.concatenate(parts) if parts else values[:0]
    return out, np.concatenate([[0], np.cumsum(sizes)])


def text_blocks(at: np.ndarray, most: int, texts: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of at most ``texts`` texts with at most ``most`` items together (one text at least)."""
    i, n = 0, len(at) - 1
    while i < n:
        j = int(np.searchsorted(at, at[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n, n if texts is None else i + texts)
        yield i, j
        i = j


def segment_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each text's values; exact zero for texts without any."""
    out = np.zeros(len(at) - 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    some = at[:-1] < at[1:]
    if some.any():
        out[some] = np.add.reduceat(values, at[:-1][some], dtype=out.dtype)
    return out
