"""Words of whole texts: column expressions, and 64-bit word and shingle hashes of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes hashed at once: few enough that what is made of them stays in a core's own memory.
_SEGMENT = 1 << 17
_MULTIPLIERS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_LOWERED = _BYTE.copy()
_LOWERED[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_PLACE = _random.integers(1, 2**63, 1 << 16, dtype=np.uint64) | np.uint64(1)


def words_of(text: Column) -> Column:
    """Array of words; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread over the whole word."""
    out = values ^ (values >> np.uint64(33))
    for factor in _MULTIPLIERS:
        out *= np.uint64(factor)
        out ^= out >> np.uint64(33)
    return out


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, len + 1 offsets into them); a null is an empty text."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces that end where a text or a word does, so that very long texts need little memory."""
    begin = 0
    while begin < len(data):
        end = min(begin + _SEGMENT, len(data))
        while end < len(data) and not _SPACE[data[end]] and offsets[np.searchsorted(offsets, end)] != end:
            end += 1
        yield begin, end
        begin = end


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, len + 1 offsets of the texts' words)."""
    data, offsets = _buffers(texts)
    table = _LOWERED if lower else _BYTE
    hashes, starts = [], []
    for begin, end in _segments(data, offsets):
        piece = data[begin:end]
        word = ~_SPACE[piece]
        first = word.copy()
        first[1:] &= ~word[:-1]
        cuts = offsets[np.searchsorted(offsets, begin):np.searchsorted(offsets, end)] - begin
        first[cuts] = word[cuts]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        place = np.arange(at[0], len(piece), dtype=np.int32) - np.repeat(at.astype(np.int32), np.diff(at, append=len(piece)))
        place &= 0xFFFF
        weighted = table.take(piece[at[0]:])
        weighted *= _PLACE.take(place)
        hashes.append(mixed(np.add.reduceat(weighted, at - at[0])))
        starts.append(at + begin)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of `size` words of one text; the whole text as one if it has fewer, none if it has no word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    out = words[:len(words) - size + 1].copy()
    for j in range(1, size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[j:len(words) - size + 1 + j])
    return out


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased."""
    hashes, offsets = word_hashes(texts)
    for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield np.unique(shingle_hashes(hashes[begin:end], size))
