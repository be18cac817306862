"""Static range asymmetric numeral system over interleaved lanes, in whole-array steps."""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np

#: Frequencies add up to 2^SCALE_BITS; states stay in [2^32, 2^64) and shed 32 bits at a time.
SCALE_BITS = 20
LANES = 512
#: Rows of lanes between checkpoints. Decoding starts at every checkpoint at once.
CHECKPOINT_ROWS = 64

_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)
_LOW = np.uint64(1 << 32)
_SLOT = np.uint64((1 << SCALE_BITS) - 1)
_RENORM = np.uint64(64 - SCALE_BITS)


@dataclass(frozen=True)
class FrequencyTable:
    """Scaled frequency and first slot of every symbol, and the symbol of every slot."""

    freq: np.ndarray
    first: np.ndarray
    symbol: np.ndarray

    @staticmethod
    def of(freq: np.ndarray) -> FrequencyTable:
        freq = freq.astype(np.uint64)
        first = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        return FrequencyTable(freq, first, symbol)


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Whole frequencies that add up to 2^SCALE_BITS, at least 1 for each symbol that occurs."""
    total, size = int(counts.sum()), 1 << SCALE_BITS
    if total == 0:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, (counts * (size / total)).astype(np.int64)), 0)
    left = size - int(freq.sum())
    order = np.argsort(-counts, kind="stable")
    if left > 0:
        freq[order[0]] += left
    while left < 0:
        # Frequencies that were raised to 1 are paid for by the most frequent symbols.
        spare = freq[order] - 1
        take = np.minimum(spare, np.maximum(1, spare * -left // max(1, int(spare.sum()))))
        take = np.where(np.cumsum(take) <= -left, take, np.maximum(0, -left - (np.cumsum(take) - take)))
        freq[order] -= take
        left += int(take.sum())
    return freq


@dataclass(frozen=True)
class Block:
    """An independently decodable run of symbols."""

    n: int
    lanes: int
    states: bytes
    offsets: list[int]
    stream: bytes

    def checksum(self) -> int:
        head = np.array([self.n, self.lanes, *self.offsets], "<i8").tobytes()
        return crc32(self.stream, crc32(self.states, crc32(head)))


def encode_block(symbols: np.ndarray, table: FrequencyTable) -> Block:
    n = len(symbols)
    lanes = max(1, min(LANES, n))
    rows = -(-n // lanes)
    x = np.full(lanes, _LOW, np.uint64)
    freq, first = table.freq[symbols], table.first[symbols]
    words, states = [np.zeros(0, np.uint32)] * rows, {}
    for r in range(rows - 1, -1, -1):
        f, c = freq[r * lanes : (r + 1) * lanes], first[r * lanes : (r + 1) * lanes]
        own = x[: len(f)]
        over = (own >> _RENORM) >= f
        shed = own[over]
        words[r] = shed.astype(np.uint32)
        own[over] = shed >> _WORD
        whole = own // f
        x[: len(f)] = (whole << _SCALE) + (own - whole * f) + c
        if r % CHECKPOINT_ROWS == 0:
            states[r] = x.copy()
    at = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    marks = sorted(states)
    stream = np.concatenate(words) if words else np.zeros(0, np.uint32)
    kept = np.concatenate([states[r] for r in marks]) if marks else np.zeros(0, np.uint64)
    return Block(n, lanes, kept.astype("<u8").tobytes(), [int(at[r]) for r in marks], stream.astype("<u4").tobytes())


def decode_block(block: Block, table: FrequencyTable) -> np.ndarray:
    n, lanes = block.n, block.lanes
    if n == 0:
        return np.zeros(0, np.uint32)
    rows = -(-n // lanes)
    x = np.frombuffer(block.states, "<u8").astype(np.uint64).reshape(-1, lanes)
    at = np.array(block.offsets, np.int64)
    stream = np.append(np.frombuffer(block.stream, "<u4"), np.uint32(0)).astype(np.uint64)
    out = np.zeros((len(x), CHECKPOINT_ROWS, lanes), np.uint32)
    size = np.minimum(n - np.arange(len(x)) * CHECKPOINT_ROWS * lanes, CHECKPOINT_ROWS * lanes)
    lane = np.arange(lanes)[None, :]
    for t in range(min(rows, CHECKPOINT_ROWS)):
        slot = x & _SLOT
        symbol = table.symbol[slot]
        out[:, t] = symbol
        moved = table.freq[symbol] * (x >> _SCALE) + slot - table.first[symbol]
        active = t * lanes + lane < size[:, None]
        need = active & (moved < _LOW)
        place = at[:, None] + np.cumsum(need, axis=1) - 1
        moved[need] = (moved[need] << _WORD) | stream[place[need]]
        at += need.sum(axis=1)
        x = np.where(active, moved, x)
    return out.reshape(-1)[:n]
