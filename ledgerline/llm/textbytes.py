"""Words and lines of many texts at once, as runs of bytes in numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_PLACES = 4096
_FACTORS = np.random.default_rng(20_011).integers(0, 1 << 63, _PLACES, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: The blanks of the word pattern [^\x20\x09-\x0D]+
BLANKS = bytes([0x20, *range(0x09, 0x0E)])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each text begins (with the end).  No text may be null."""
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, ends - ends[0]


def runs(kinds: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Longest runs of one nonzero kind within a text: first byte, byte after the last, and the text's number."""
    n = len(kinds)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    edge[ends[:-1][ends[:-1] < n]] = True
    at = np.flatnonzero(edge)
    stop = np.append(at[1:], n)
    full = kinds[at] != 0
    start, stop = at[full], stop[full]
    return start, stop, np.searchsorted(ends, start, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finisher: every bit of the result hangs on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; the runs are ascending, not empty and don't overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = stop - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    value = data[np.repeat(start, size) + place].astype(np.uint64) + np.uint64(1)
    value *= _FACTORS[place % _PLACES]
    if int(size.max()) > _PLACES:
        value *= mix((place // _PLACES).astype(np.uint64)) | np.uint64(1)
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64))


def table(groups: dict[int, bytes], other: int) -> np.ndarray:
    """The kind of each byte value: that of the group it is in, or else ``other``."""
    out = np.full(256, other, np.uint8)
    for kind, values in groups.items():
        out[list(values)] = kind
    return out


_WORD_KINDS = table({0: BLANKS}, 1)


def words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than blanks."""
    return runs(_WORD_KINDS[data], ends)
