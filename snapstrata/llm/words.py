"""Words of Arrow text columns as 64-bit hashes, computed for many rows at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

_rng = np.random.Generator(np.random.PCG64(20240101))
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))

_ALL = np.arange(256)
#: Words are runs of bytes other than blank and 9 to 13.
BLANK_SEPARATED = ~((_ALL == 0x20) | ((_ALL >= 9) & (_ALL <= 13)))
#: Words are runs of ASCII letters, digits and bytes of other scripts.
ALPHANUMERIC = (
    ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 65) & (_ALL <= 90))
    | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)
)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)


def powers(place: np.ndarray) -> np.ndarray:
    """The power of an odd number that stands for each place of a word, however long it is."""
    low = _POWERS[place & (len(_POWERS) - 1)]
    high = place >> 12
    most = int(high.max(initial=0))
    if most:
        steps = np.ones(most + 1, np.uint64)
        steps[1:] = np.cumprod(np.full(most, _POWERS[-1], np.uint64))
        low *= steps[high]
    return low


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit finalizer; ``x`` is overwritten."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of slices of about ``size`` bytes; null is empty.

    A slice holds at least one row, so a text is never cut.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = max(row + 1, min(end, len(column)))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def hash_words(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the word offsets of the rows."""
    inside = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = inside[begins]
    starts = np.flatnonzero(first)
    rows = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), rows
    letters = data[inside]
    if lower:
        letters = LOWER[letters]
    at = np.flatnonzero(first[inside])
    sizes = np.diff(at, append=len(letters))
    place = np.arange(len(letters)) - np.repeat(at, sizes)
    terms = _BYTE_VALUES[letters]
    terms *= powers(place)
    hashes = np.add.reduceat(terms, at)
    hashes += sizes.astype(np.uint64)
    return mix(hashes), rows


def occurrence(keys: np.ndarray) -> np.ndarray:
    """How often each element's value stood before it: 0, 1, 2 and so on."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    begin = np.flatnonzero(new)
    count = np.arange(len(keys)) - np.repeat(begin, np.diff(begin, append=len(keys)))
    out = np.empty(len(keys), np.int64)
    out[order] = count
    return out


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, labelled by occurrence; a shorter text has one."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    keys = np.zeros(n, np.uint64)
    for i in range(size):
        keys *= np.uint64(0xD6E8FEB86659FD93)
        keys += words[i : i + n]
    keys = mix(keys)
    again = occurrence(keys)
    return mix(keys + again.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)) if again.any() else keys
