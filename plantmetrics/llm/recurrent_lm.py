"""Language-model scores of whole documents by a gated recurrent network that Spark trains.

1. Words of the training texts are counted over all of them (hashes, pre-aggregated per task).
2. The `vocabulary` most frequent words get a class each: the `head` first ones in head classes of 32, the others by group of
   texts they occur in and by frequency, as leaves of the class's tree; all other words, unknown ones too, are one class. The
   `head` words have an input vector each, all others the sum of their class's and a hashed one. The groups come from the counts of
   each word in 16 cells of texts, over all training texts.
3. Copies of the network are trained side by side, on training texts dealt to them by a hash of key and text, each used once, in
   `rounds` disjoint shares; after a round the copies are averaged by their tokens. The number of copies follows the training
   tokens, the order of a copy's texts their hashes, so neither cores nor files change the model (but for the order in which
   rounded sums are taken). Copies travel as rows and are averaged in two levels.
4. Every text is scored whole with the last average. Words outside the vocabulary are not broadcast: their hashes go through a
   join with the counts, pre-aggregated per text.

The first model gives a vocabulary word its share of its class's count, and learns from there; in the last class a word has (count + 1) / (tokens +
words + 1) of the class, so that the chances of all words and one unknown word add up to 1.

Defined cases: a null or empty text is its end token alone; null keys count as training texts, equal rows get equal scores;
without training texts every chance is that of the untrained network; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.llm.recurrent import HEAD_CLASS, SPARSE, Network, Shape, flat, shaped, start, tree_bias
from plantmetrics.llm.words import word_hashes

END = np.uint64(0x0E4D0E4D0E4D0E4D)
_LN10 = float(np.log(10))
_CELL_BITS = 4
_CELLS = 1 << _CELL_BITS
_GROUPS = 8
_HASHED = 1 << 14
_MARKERS = 64
_TOKENS_AT_ONCE = 1 << 20
_RANGE_BITS = 20
_CELL_RANGE_BITS = 17
#: Training tokens of a round for each copy of the network, and the least number of copies.
COPY_TOKENS = 1 << 24
LEAST_COPIES = 8


def _starts(known: np.ndarray, bits: int) -> np.ndarray:
    """Place of the first of the sorted hashes with each value of the first bits."""
    return np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.int32)


def _found(known: np.ndarray, starts: np.ndarray, bits: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of every hash among the sorted ones."""
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    last = len(known) - 1
    at = np.minimum(starts[hashes >> np.uint64(64 - bits)], last)
    behind = np.flatnonzero((known[at] < hashes) & (at < last))
    while len(behind):
        at[behind] += 1
        behind = behind[(known[at[behind]] < hashes[behind]) & (at[behind] < last)]
    return at, known[at] == hashes


@dataclass(frozen=True)
class Vocabulary:
    """Sorted hashes of the known words with count, class, place in the class and ln share of it (0: the network says it), and the whole's totals."""

    hashes: np.ndarray
    starts: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    members: np.ndarray
    shares: np.ndarray
    inputs: np.ndarray
    shape: Shape
    tokens: int
    words: int
    tail_tokens: int
    tail_words: int

    @property
    def tail(self) -> int:
        return self.shape.classes - 1

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, known) in the vocabulary of every token: the first bits name a short range of places, which is walked."""
        return _found(self.hashes, self.starts, _RANGE_BITS, hashes)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes with an end token behind every text, tokens per text)."""
    words, offsets = word_hashes(texts)
    return np.insert(words, offsets[1:], END), np.diff(offsets) + 1


def _blocks(texts: pa.Array, order: pa.Array | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(begin, end, hashes, lengths) of runs of texts, taken in `order`, with about a million tokens or one text."""
    size, begin, held, many = 64, 0, [], 0

    def block(stop: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        return begin, stop, np.concatenate([h for h, _ in held]), np.concatenate([n for _, n in held])

    for at in range(0, len(texts), size):
        hashes, lengths = tokens_of(texts.slice(at, size) if order is None else texts.take(order.slice(at, size)))
        ends, done = np.cumsum(lengths), 0
        while done < len(lengths):
            past = ends[done - 1] if done else 0
            stop = int(np.searchsorted(ends, past + _TOKENS_AT_ONCE - many, "right"))
            if stop <= done and held:
                yield block(at + done)
                begin, held, many = at + done, [], 0
                continue
            stop = max(stop, done + 1)
            held.append((hashes[past:ends[stop - 1]], lengths[done:stop]))
            many += int(ends[stop - 1] - past)
            done = stop
    if held:
        yield block(len(texts))


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, count) over all texts; word is the hash, read as a signed number."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, _ in _blocks(batch.column(0)):
                found, many = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(many.astype(np.int64))], ["word", "count"])

    return docs.select(F.col(text)).mapInArrow(counted, "word long, count long").groupBy("word").agg(F.sum("count").alias("count"))


def _summed(parts: DataFrame, kind: type) -> np.ndarray:
    """Sum of binary arrays of one length in the order of their partitions, in two levels, so that no task adds up more than some hundred."""
    def added(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place", kind="stable")
        total = np.frombuffer(frame["values"].iloc[0], kind).copy()
        for other in frame["values"].iloc[1:]:
            total += np.frombuffer(other, kind)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "place": frame["place"].iloc[:1] // 64, "values": [total.tobytes()]})

    kinds, some = "part long, place long, values binary", parts.withColumn("place", F.spark_partition_id().cast("long"))
    once = some.groupBy("part", F.floor(F.col("place") / 64)).applyInPandas(lambda f: added(f), kinds)
    rows = once.groupBy("part").applyInPandas(lambda f: added(f), kinds).toArrow().sort_by("part")
    return np.concatenate([np.zeros(0, kind), *[np.frombuffer(v.as_py(), kind) for v in rows.column("values")]])


def _pieces(values: np.ndarray, size: int = 1 << 14) -> pa.RecordBatch:
    """(part, values) rows over the memory of `values`, which is not copied."""
    cuts = np.append(np.arange(0, len(values), size), len(values)) * values.itemsize
    parts = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(values)])
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), parts], ["part", "values"])


def _cells(docs: DataFrame, text: str, words: np.ndarray, counts: np.ndarray, tokens: int) -> np.ndarray:
    """(words, cells) counts of the first words by the cell of the texts they stand in, over all texts.

    A text's cell has a bit for each of four fixed random directions: the side on which its shares of the most frequent words lie.
    """
    markers = min(_MARKERS, len(words))
    usual = np.sqrt(counts[:markers] / max(tokens, 1))
    directions = np.random.default_rng(5).standard_normal((markers, _CELL_BITS))
    order = np.argsort(words)
    in_order = words[order]
    starts = _starts(in_order, _CELL_RANGE_BITS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(words) * _CELLS, np.int64)
        for batch in batches:
            for _, _, hashes, lengths in _blocks(batch.column(0)):
                at, known = _found(in_order, starts, _CELL_RANGE_BITS, hashes)
                rank, text_of = order[at[known]], np.repeat(np.arange(len(lengths)), lengths)[known]
                frequent = rank < markers
                shares = np.bincount(text_of[frequent] * markers + rank[frequent], minlength=len(lengths) * markers).reshape(-1, markers)
                sides = (np.sqrt(shares / lengths[:, None]) - usual) @ directions > 0
                cell = sides @ (1 << np.arange(_CELL_BITS))
                total += np.bincount(rank * _CELLS + cell[text_of], minlength=len(total))
        if total.any():
            yield _pieces(total)

    found = _summed(docs.select(F.col(text)).mapInArrow(counted, "part long, values binary"), np.int64)
    return (found if len(found) else np.zeros(len(words) * _CELLS, np.int64)).reshape(-1, _CELLS)


def _grouped(cells: np.ndarray) -> np.ndarray:
    """Group of every word: k-means of its square-root shares of the cells, weighted by count."""
    if not len(cells):
        return np.zeros(0, np.int64)
    weight = np.sqrt(cells.sum(1))
    rows = np.sqrt(cells / np.maximum(cells.sum(1, keepdims=True), 1))
    centres = rows[:1]
    for _ in range(1, min(_GROUPS, len(rows))):
        away = ((rows[:, None] - centres[None]) ** 2).sum(2).min(1)
        centres = np.vstack([centres, rows[np.argmax(away * weight)]])
    for _ in range(20):
        group = ((rows[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for g in range(len(centres)):
            own = group == g
            if own.any():
                centres[g] = np.average(rows[own], axis=0, weights=weight[own] + 1e-9)
    return group


def build_vocabulary(
    docs: DataFrame, counts: DataFrame, text: str = "text", vocabulary: int = 1 << 18, grouped: int = 1 << 15, head: int = 1024
) -> tuple[Vocabulary, np.ndarray, np.ndarray]:
    """(vocabulary, class biases, word biases); at most `vocabulary` rows of two numbers reach the driver."""
    totals = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("count"), "word").limit(vocabulary).toArrow()
    words, many = top.column("word").to_numpy().view(np.uint64), top.column("count").to_numpy()
    cells = _cells(docs, text, words[:grouped], many[:grouped], totals["n"]) if len(words) else np.zeros((0, _CELLS))
    group = np.concatenate([_grouped(cells), np.full(len(words) - len(cells), _GROUPS)]).astype(np.int64)
    head = min(head, len(words))
    head_classes = -(-head // HEAD_CLASS)
    classes, members = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    by_group = np.lexsort((-many[:head], group[:head]))
    classes[by_group], members[by_group] = np.arange(head) // HEAD_CLASS, np.arange(head) % HEAD_CLASS
    band = np.floor(np.log2(np.arange(head, len(words)) + 1)).astype(np.int64) if len(words) > head else np.zeros(0, np.int64)
    _, other = np.unique(band * (_GROUPS + 1) + group[head:], return_inverse=True)
    classes[head:] = head_classes + other
    n_classes = (int(classes.max()) + 1 if len(words) else 0) + 1
    per_class = np.bincount(classes, many, minlength=n_classes)
    by_class = head + np.argsort(classes[head:], kind="stable")
    leaves = np.bincount(classes[head:], minlength=n_classes)[head_classes:]
    members[by_class] = np.arange(len(by_class)) - np.repeat(np.cumsum(leaves) - leaves, leaves)
    tail_tokens, tail_words = int(totals["n"] - many.sum()), int(totals["v"] - len(words))
    per_class[-1] = tail_tokens + tail_words + 1
    word_bias = np.full((max(head_classes, 1), HEAD_CLASS), -30.0)
    word_bias[classes[:head], members[:head]] = np.log(many[:head])
    order = np.argsort(words)
    shape = Shape(inputs=head + n_classes, classes=n_classes, head_classes=max(head_classes, 0), leaves=tuple(leaves.tolist()), hashed=_HASHED)
    inputs = np.where(np.arange(len(words)) < head, np.arange(len(words)), head + classes)
    made = Vocabulary(
        words[order], _starts(words[order], _RANGE_BITS), many[order], classes[order].astype(np.int32), members[order].astype(np.int32),
        np.zeros(len(words)), inputs[order].astype(np.int32), shape,
        int(totals["n"]), int(totals["v"]), tail_tokens, tail_words,
    )
    return made, np.log(np.maximum(per_class, 1)), word_bias[:shape.head_classes]


def first_weights(vocabulary: Vocabulary, class_bias: np.ndarray, word_bias: np.ndarray) -> np.ndarray:
    """Weights of the untrained network, in which every word has the chance that its count gives it."""
    shape = vocabulary.shape
    order = np.lexsort((vocabulary.members, vocabulary.classes))
    ends = np.cumsum(np.bincount(vocabulary.classes, minlength=shape.classes))
    counts = np.split(vocabulary.counts[order], ends[:-1])[shape.head_classes:]
    biases = [tree_bias(c) for c in counts if len(c) > 1]
    return flat(start(shape, class_bias, word_bias, node_bias=np.concatenate([np.zeros(0), *biases])))


def _ids(vocabulary: Vocabulary, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at, known = vocabulary.find(hashes)
    if not len(vocabulary.hashes):
        zero = np.zeros(len(hashes), np.int32)
        return at, known, zero, zero, zero
    out = np.flatnonzero(~known)
    inputs, classes, members = vocabulary.inputs.take(at), vocabulary.classes.take(at), vocabulary.members.take(at)
    inputs[out], classes[out], members[out] = vocabulary.shape.inputs - 1, vocabulary.tail, 0
    own = np.flatnonzero(inputs >= vocabulary.shape.inputs - vocabulary.shape.classes)
    inputs[own] += np.int32(vocabulary.shape.inputs) * ((hashes[own] % np.uint64(vocabulary.shape.hashed)).astype(np.int32) + 1)
    return at, known, inputs, classes, members


def train(
    docs: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, share: Column, text: str = "text", rounds: int = 2, key: str = "doc_id"
) -> np.ndarray:
    """Weights after `rounds` rounds; `share` (0 to rounds - 1) says in which round a text is learnt from.

    There are as many copies as `COPY_TOKENS` go into a round's tokens, but `LEAST_COPIES` at least. Copies travel as their changes: dense parts count by tokens, the rows of sparse parts by the steps that met them.
    """
    context = docs.sparkSession.sparkContext
    known = context.broadcast(vocabulary)
    copies = max(LEAST_COPIES, -(-vocabulary.tokens // (rounds * COPY_TOKENS)))
    place = F.xxhash64(F.col(key).cast("string"), F.col(text), F.lit(1))
    for number in range(rounds):
        now = context.broadcast(weights)

        def blocks(batches: Iterator[pa.RecordBatch], words: Vocabulary) -> Iterator[tuple[np.ndarray, ...]]:
            for batch in batches:
                for _, _, hashes, lengths in _blocks(batch.column(1)):
                    yield (lengths, *_ids(words, hashes)[2:])

        def learnt(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            words = known.value
            network = Network(words.shape, shaped(now.value.copy(), words.shape))
            seen = network.learn(blocks(batches, words))
            if seen:
                before, moved = shaped(now.value, words.shape), []
                for name in sorted(network.w):
                    times = network.met[name] if name in SPARSE else np.full(1, seen, np.float32)
                    change = network.w.pop(name)
                    change -= before[name]
                    change *= times[:, None] if name in SPARSE else seen
                    moved += [change.ravel(), times]
                yield _pieces(np.concatenate(moved), 1 << 16)

        own = docs.filter(share == number).select(place.alias("place"), F.col(text).alias("text"))
        # Dealt by the number of the copy, not by a hash of it, so that every copy has a partition of its own.
        dealt = own.repartitionById(copies, F.pmod("place", F.lit(copies)).cast("int")).sortWithinPartitions("place", "text")
        rows = dealt.mapInArrow(learnt, "part long, values binary")
        total, at = _summed(rows, np.float32), 0
        after = shaped(weights.copy(), vocabulary.shape)
        for name in sorted(after) if len(total) else ():
            size, many = after[name].size, len(after[name]) if name in SPARSE else 1
            times = np.maximum(total[at + size:at + size + many], 1)
            after[name] += (total[at:at + size].reshape(many, -1) / times[:, None]).reshape(after[name].shape)
            at += size + many
        weights = flat(after)
        now.destroy()
    known.destroy()
    return weights


def score(docs: DataFrame, vocabulary: Vocabulary, weights: np.ndarray, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) per row."""
    known = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, values = known.value
        network = Network(words.shape, shaped(values, words.shape))
        empty, whole = np.log(words.tail_tokens + words.tail_words + 1), np.log(words.tokens + words.words + 1)
        counted = np.log(words.counts + 1)
        for batch in batches:
            # Texts of like length end together, so few slots are left empty.
            order = pc.sort_indices(pc.fill_null(pc.binary_length(batch.column(1)), 0))
            for begin, end, hashes, lengths in _blocks(batch.column(1), order):
                at, inside, inputs, classes, members = _ids(words, hashes)
                others = np.flatnonzero(~inside)
                starts, ends = np.cumsum(lengths) - lengths, np.cumsum(lengths)
                base = np.zeros(len(hashes))
                if len(words.hashes):
                    counted.take(at, out=base, mode="clip")
                    base[others] = 0
                base -= whole
                base = np.add.reduceat(base, starts)
                log_p = network.run(lengths, inputs, classes, members, learn=False)
                log_p[others] -= empty
                if len(words.hashes):
                    shares = words.shares.take(at)
                    shares[others] = 0
                    log_p += shares
                offsets = np.searchsorted(others, np.append(0, ends)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(order.slice(begin, end - begin)), pa.array(lengths.astype(np.int64)),
                    pa.array(lengths - np.diff(offsets)), pa.array(base), pa.array(np.add.reduceat(log_p, starts)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[others].view(np.int64))),
                ], ["key", "n_tokens", "inside", "base", "log_p", "others"])

    kind = f"key {dict(rows.dtypes)['key']}, n_tokens long, inside long, base double, log_p double, others array<long>"
    numbered = stored(rows.mapInArrow(scored, kind).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = numbered.select("row", F.explode("others").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    seen = tail.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.ln(F.col("count") + 1)).alias("gain")
    )
    both = numbered.join(seen, "row", "left").withColumns({"more": F.coalesce("more", F.lit(0)), "gain": F.coalesce("gain", F.lit(0.0))})
    return both.select(
        F.col("key").alias(key), "n_tokens", (F.col("inside") + F.col("more")).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), ((F.col("base") + F.col("gain")) / _LN10).alias("base_score"),
        ((F.col("log_p") + F.col("gain")) / _LN10).alias("score"),
    )


def fit_and_score(docs: DataFrame, is_training: Column, key: str = "doc_id", text: str = "text", rounds: int = 2) -> DataFrame:
    """Scores of all rows by a model of those for which `is_training` holds."""
    learning = docs.filter(is_training)
    counts = stored(count_words(learning, text), "word-counts")
    vocabulary, class_bias, word_bias = build_vocabulary(learning, counts, text)
    first = first_weights(vocabulary, class_bias, word_bias)
    share = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(rounds))
    weights = train(learning, vocabulary, first, share, text, rounds, key)
    return score(docs, vocabulary, weights, counts, key, text)
