"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow string column.

A text is never copied into Python strings: words are (start, end) places in one byte buffer, and their
64-bit hashes are built eight bytes at a time. Slices keep the memory of a step bounded whatever the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes that one step looks at together (one longer text makes a longer step of its own).
SLICE_BYTES = 2 << 20
#: Words longer than this are hashed on their own.
LONG_WORD = 4096

U64 = np.uint64
_M1, _M2, _M3 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)

#: Bits of the table that tells most unknown hashes apart at once.
TABLE_BITS = 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Words are what stands between ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Words are runs of digits, a-z and bytes of characters beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64's finaliser)."""
    h = (h ^ (h >> U64(30))) * _M2
    h = (h ^ (h >> U64(27))) * _M3
    return h ^ (h >> U64(31))


def utf8_column(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and its n + 1 offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to ``most`` bytes each; a longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for every text the number of words before it (n + 1 values)."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = kind[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    after = inside.copy()  # what follows each byte within its text
    after[edge] = False
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside[:-1] & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word's bytes, the same in every process."""
    lengths = ends - starts
    hashes = lengths.astype(U64) * _M1
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    long = np.flatnonzero(lengths > LONG_WORD)
    todo, at = np.flatnonzero(lengths <= LONG_WORD) if len(long) else None, 0
    while todo is None or len(todo):
        rest = (lengths if todo is None else lengths[todo]) - at
        part = eight[(starts if todo is None else starts[todo]) + at] & _MASKS[np.minimum(rest, 8)]
        if todo is None:
            hashes = mix((hashes ^ part) * _M1)
            todo = np.flatnonzero(rest > 8)
        else:
            hashes[todo] = mix((hashes[todo] ^ part) * _M1)
            todo = todo[rest > 8]
        at += 8
    for i in long:
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return hashes


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (across texts too; callers leave those out)."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    last = len(hashes) - n + 1
    out = hashes[:last].copy()
    for k in range(1, n):
        out = mix(out * _M1 + hashes[k : last + k])
    return out


def gram_hash(hashes: np.ndarray) -> int:
    """The hash of one whole run of words, as ``grams`` gives it for that length."""
    return int(grams(hashes, len(hashes))[0])


def rows_of(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The row of every hash, 0 if it isn't known."""
    if not len(known):
        return np.zeros(len(hashes), np.int64)
    place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[place] == hashes, place + 1, 0)


class Lookup:
    """Rows of hashes by a table over their first bits; hashes that share them are looked up in order."""

    def __init__(self, known: np.ndarray):
        self.known = known
        top = (known >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.may = np.zeros(1 << TABLE_BITS, bool)
        self.may[top] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        some = np.flatnonzero(self.may[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        out[some] = rows_of(hashes[some], self.known)
        return out
