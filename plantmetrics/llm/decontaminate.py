"""Benchmark decontamination by pigeonhole edit matching over words.

A test item of n words may differ from a passage by at most e = floor(n * error_rate) inserted, deleted or replaced words. Cut into
e + 1 pieces, at least one piece must then stand unchanged in the passage. So the pieces' hashes are looked up among the word
runs of every whole text, and around each hit the item is matched with Myers' bit-parallel distance, which gives the smallest
number of edits of any passage that ends in the window.

Words are runs without ASCII white space, A-Z lower-cased, with ASCII punctuation taken away; words of punctuation alone do not
count. Items go to the tasks in blocks of at most `block_bytes` of text, one pass over the documents each, so a larger benchmark
costs passes, not memory.

Defined cases: an item without words matches nothing; equal item rows count once; a null or empty text matches nothing; an item longer than a text matches if
the missing words are within its errors; null ids are passed through; equal rows give equal rows; an empty table on either side
gives no rows; other columns are never read.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.llm.words import _buffers, mixed, word_hashes

ERROR_RATE = 0.2
BLOCK_BYTES = 8 << 20

_DROPPED = np.zeros(256, bool)
_DROPPED[list(string.punctuation.encode())] = True


@dataclass(frozen=True)
class Piece:
    """Run of words [begin, begin + size) of an item."""

    item: int
    begin: int


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and offsets of texts without ASCII punctuation."""
    data, offsets = _buffers(texts)
    kept = ~_DROPPED[data]
    before = np.concatenate([[0], np.cumsum(kept)])
    bare = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(before[offsets].astype(np.int64)), pa.py_buffer(data[kept].tobytes()))
    return word_hashes(bare)


def errors_allowed(n_words: int, error_rate: float = ERROR_RATE) -> int:
    return int(n_words * error_rate + 1e-9)


def piece_bounds(n_words: int, error_rate: float = ERROR_RATE) -> list[tuple[int, int]]:
    """(begin, size) of the errors + 1 nearly equal pieces."""
    count = errors_allowed(n_words, error_rate) + 1
    cuts = [n_words * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of exactly `size` words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    out = words[:len(words) - size + 1] + np.uint64(size)
    for j in range(1, size):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[j:len(words) - size + 1 + j])
    return out


class Matcher:
    """Items of one block, with the hashes of their pieces by piece size."""

    def __init__(self, ids: list, texts: list[str], error_rate: float = ERROR_RATE):
        self.ids, self.rate = ids, error_rate
        words, offsets = plain_words(pa.array(texts, pa.string()))
        self.items = [words[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        pieces: dict[int, dict[int, list[Piece]]] = defaultdict(lambda: defaultdict(list))
        for at, item in enumerate(self.items):
            for begin, size in piece_bounds(len(item), error_rate):
                pieces[size][int(_runs(item[begin:begin + size], size)[0])].append(Piece(at, begin))
        self.pieces = {size: dict(found) for size, found in pieces.items()}
        self.sorted = {size: np.sort(np.fromiter(found, np.uint64, len(found))) for size, found in self.pieces.items()}
        self.masks: dict[int, dict[int, int]] = {}

    def _mask(self, at: int) -> dict[int, int]:
        if at not in self.masks:
            mask: dict[int, int] = defaultdict(int)
            for place, word in enumerate(self.items[at].tolist()):
                mask[word] |= 1 << place
            self.masks[at] = dict(mask)
        return self.masks[at]

    def distance(self, at: int, window: np.ndarray) -> tuple[int, int]:
        """(fewest edits between the item and any passage of the window, where that passage ends)."""
        mask, n = self._mask(at), len(self.items[at])
        full, high = (1 << n) - 1, 1 << (n - 1)
        plus, minus, score, best, end = full, 0, n, n, 0
        for place, word in enumerate(window.tolist()):
            same = mask.get(word, 0)
            either = same | minus
            across = (((same & plus) + plus) ^ plus) | same
            up, down = minus | ~(across | plus) & full, plus & across
            score += bool(up & high) - bool(down & high)
            up, down = up << 1 & full, down << 1 & full
            plus, minus = down | ~(either | up) & full, up & either
            if score < best:
                best, end = score, place + 1
        return best, end

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, edits, end word) of every item that the text holds within its errors, the best passage of each."""
        windows: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for size, table in self.sorted.items():
            runs = _runs(words, size)
            if not len(runs) or not len(table):
                continue
            near = np.minimum(np.searchsorted(table, runs), len(table) - 1)
            for place in np.flatnonzero(table[near] == runs).tolist():
                for piece in self.pieces[size][int(runs[place])]:
                    n = len(self.items[piece.item])
                    allowed = errors_allowed(n, self.rate)
                    first = place - piece.begin - allowed
                    windows[piece.item].add((max(0, first), min(len(words), place - piece.begin + n + allowed)))
        for at in sorted(windows):
            allowed = errors_allowed(len(self.items[at]), self.rate)
            best = None
            for begin, end in _merged(windows[at]):
                edits, stop = self.distance(at, words[begin:end])
                if edits <= allowed and (best is None or edits < best[0]):
                    best = edits, begin + stop
            if best is not None:
                yield at, *best


def _merged(windows: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping windows as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(windows):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list[str]]]:
    """Items in blocks of at most `block_bytes` of text (or one item), streamed through the driver one block at a time."""
    ids: list = []
    texts: list[str] = []
    held = 0
    rows = benchmark.filter(F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text")).distinct()
    for row in rows.coalesce(8).toLocalIterator(prefetchPartitions=True):
        size = len(row["text"].encode())
        if texts and held + size > block_bytes:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row["key"])
        texts.append(row["text"])
        held += size
    if texts:
        yield ids, texts


def matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, item, edits, end_word) of every document and item it holds within the item's errors."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    item_kind = dict(benchmark.dtypes)[item]
    kind = f"key {dict(rows.dtypes)['key']}, item {item_kind}, edits int, end_word int"
    found = None
    for ids, texts in item_blocks(benchmark, item, item_text, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Matcher(ids, texts, error_rate))  # at most a few times block_bytes

        def matched(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = shared.value
            for batch in batches:
                for at in range(0, len(batch), 256):
                    part = batch.slice(at, 256)
                    words, offsets = plain_words(part.column("text"))
                    hits = [(row, *hit) for row in range(len(part)) for hit in matcher.hits(words[offsets[row]:offsets[row + 1]])]
                    yield pa.RecordBatch.from_arrays([
                        part.column("key").take(pa.array([h[0] for h in hits], pa.int64())),
                        pa.array([matcher.ids[h[1]] for h in hits], pa.int64() if item_kind == "bigint" else None),
                        pa.array([h[2] for h in hits], pa.int32()), pa.array([h[3] for h in hits], pa.int32()),
                    ], ["key", "item", "edits", "end_word"])

        block = rows.mapInArrow(matched, kind)
        found = block if found is None else found.unionByName(block)
    if found is None:
        found = docs.sparkSession.createDataFrame([], kind)
    return found.withColumnsRenamed({"key": key, "item": item})


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text",
    error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents without a test item, with all their columns."""
    at_text = docs.columns.index(text)
    keyed = benchmark.select(F.lit(0).alias("item"), F.col(item_text).alias("text"))
    for _, texts in item_blocks(keyed, "item", "text", block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(Matcher([0] * len(texts), texts, error_rate))

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, len(batch), 256):
                    part = batch.slice(at, 256)
                    words, offsets = plain_words(part.column(at_text))
                    keep = [next(shared.value.hits(words[a:b]), None) is None for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                    yield part.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
