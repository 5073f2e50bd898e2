"""Hashes of words and of their character n-grams, for many words at once in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_SHIFT = np.uint64(33)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values, so that low and high bits can be used alike."""
    values = values ^ (values >> _SHIFT)
    values = values * _MIX
    return values ^ (values >> _SHIFT)


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash for each word."""
    raw = [word.encode("utf-8", "surrogatepass") for word in words]
    lengths = np.array([len(r) for r in raw], np.int64)
    return _hashes(np.frombuffer(b"".join(raw), np.uint8), lengths)


def array_hashes(words: pa.Array) -> np.ndarray:
    """The same hashes, of an Arrow array without nulls."""
    raw = words.cast(pa.large_binary())
    ends = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, raw.offset * 8) if len(raw) else np.zeros(1, np.int64)
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return _hashes(data, np.diff(ends))


def _hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    data = data.astype(np.uint64) + np.uint64(1)
    powers = np.ones(int(lengths.max(initial=0)) + 1, np.uint64)
    powers[1:] = _BASE
    powers = np.cumprod(powers, dtype=np.uint64)
    ends = np.cumsum(lengths)
    place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[place], dtype=np.uint64, out=sums[1:])
    return mixed(sums[ends] - sums[ends - lengths] + lengths.astype(np.uint64))


def word_ngrams(words: list[str], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams of every word between its marks of start and end, and
    the word (its place in the list) that each belongs to, in no order."""
    raw = [b"\x02" + word.encode("utf-8", "surrogatepass") + b"\x03" for word in words]
    lengths = np.array([len(r) for r in raw], np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))  # bytes from here to the word's end
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for size in sizes:
        if len(data) < size:
            continue
        value = np.full(len(data) - size + 1, size, np.uint64)
        for k in range(size):
            value = value * _BASE + data[k : len(data) - size + 1 + k]
        inside = left[: len(value)] >= size
        hashes.append(mixed(value[inside]))
        owners.append(owner[: len(value)][inside])
    return np.concatenate(hashes), np.concatenate(owners)
