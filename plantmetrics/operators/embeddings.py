"""Hashed word vectors weighted by document frequency, and an index of them that a sync brings up to date by differences.

A text becomes cells: hashed words with their counts. A cell's weight is the number of binary digits of (texts + 1) div (texts with
the word + 1), so it is a whole number that most changes of the collection leave as it is. The frequencies are a table of their
own. A sync adds the cells of new texts, takes away those of vanished ones, and makes new vectors for new texts and for the kept
ones that hold a word whose weight moved; every other row is passed on as stored. The result is that of a full rebuild.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from plantmetrics.functions.sizing import stored

DIMS = 256
_TOTAL = -1  # The frequency table's row for the number of texts.


CELLS = ArrayType(StructType([StructField("bucket", IntegerType()), StructField("count", IntegerType())]))


def with_cells(df: DataFrame, text: str, dims: int = DIMS, out: str = "cells") -> DataFrame:
    """Array of struct(bucket, count) by bucket: lower-cased runs of letters and digits, hashed by md5. A null text has none.

    All columns pass through Arrow.
    """
    return _celled(df, df.columns, text, dims, out)


def _celled(df: DataFrame, keep: Sequence[str], text: str, dims: int, out: str = "cells") -> DataFrame:
    """The kept columns with the text's cells; every distinct word of a batch is hashed once."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    schema = StructType([*[df.schema[c] for c in keep], StructField(out, CELLS)])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _counted(part.column(part.num_columns - 1), dims)], schema.names)

    return df.select(*keep, words.alias("_words")).mapInArrow(added, schema)


def _counted(words: pa.Array, dims: int) -> pa.Array:
    """Cells of every row's words, by bucket."""
    coded = words.flatten().dictionary_encode()
    hashed = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % dims for w in coded.dictionary.to_pylist()], np.int64)
    row = np.repeat(np.arange(len(words)), np.diff(np.asarray(words.offsets)))
    held, counts = np.unique(row * dims + hashed[coded.indices.to_numpy()], return_counts=True)
    ends = np.searchsorted(held, np.arange(len(words) + 1) * dims)
    cells = pa.StructArray.from_arrays([pa.array(held % dims, pa.int32()), pa.array(counts, pa.int32())], ["bucket", "count"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), cells)


def frequencies(celled: DataFrame) -> DataFrame:
    """(bucket, texts) with the number of texts under -1: at most DIMS + 1 rows, counted map-side."""
    held = celled.select(F.explode(F.concat(F.array(F.lit(_TOTAL)), F.col("cells.bucket"))).alias("bucket"))
    return held.groupBy("bucket").agg(F.count("*").alias("texts"))


def weights(counts: DataFrame, dims: int = DIMS) -> list[int]:
    """Weight of every bucket; reads the at most dims + 1 rows of a frequency table."""
    texts = {r.bucket: r.texts for r in counts.collect()}
    return [((texts.get(_TOTAL, 0) + 1) // (texts.get(b, 0) + 1)).bit_length() for b in range(dims)]


def _dense(cells: pa.Array, dims: int) -> pa.Array:
    """Unit vector of every row's weighted cells."""
    lengths = np.diff(np.asarray(cells.offsets))
    flat = cells.flatten()
    rows = np.zeros((len(cells), dims))
    rows[np.repeat(np.arange(len(cells)), lengths), flat.field("bucket").to_numpy()] = flat.field("weight").to_numpy()
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    rows = np.divide(rows, norms, out=rows, where=norms > 0)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * dims, pa.int32()), pa.array(rows.ravel()))


def weighted_cells(weight: list[int], cells: str = "cells") -> Column:
    """Cells with count times weight."""
    table = F.array(*[F.lit(w) for w in weight])
    return F.transform(cells, lambda c: F.struct(c["bucket"].alias("bucket"), (c["count"] * F.element_at(table, c["bucket"] + 1)).alias("weight")))


def with_vectors(celled: DataFrame, weight: list[int], out: str = "embedding") -> DataFrame:
    """Unit vector of every row's cells; a row without a word gets zeros. All columns pass through Arrow, so leave long texts out."""
    schema = StructType([*celled.schema.fields, StructField(out, ArrayType(DoubleType()))])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.slice(at, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], _dense(part.column(part.num_columns - 1), len(weight))], schema.names)

    return celled.withColumn("_weighted", weighted_cells(weight)).mapInArrow(added, schema)


@dataclass(frozen=True)
class Index:
    """Rows (key, content_hash, cells, embedding, revision), frequencies and the number of the last sync, stored."""

    rows: DataFrame
    counts: DataFrame
    revision: int = 0


def sync_index(chunks: DataFrame, index: Index | None = None, key: str = "chunk_id", content: str = "content", dims: int = DIMS) -> Index:
    """Index of the chunks; `revision` of a row is the sync that made its vector. Keys are unique and not null."""
    hashed = chunks.select(key, content, F.md5(F.coalesce(content, F.lit(""))).alias("content_hash"))
    shown = [key, "content_hash", "cells", "embedding", "revision"]
    if index is None:
        fresh = stored(_celled(hashed, [key, "content_hash"], content, dims), "cells")
        counts = stored(frequencies(fresh), "frequencies")
        made = with_vectors(fresh.select(key, "content_hash", "cells"), weights(counts, dims)).withColumn("revision", F.lit(0))
        return Index(stored(made.select(shown), "index"), counts)
    same = [key, "content_hash"]
    fresh = stored(_celled(hashed.join(index.rows.select(same), same, "left_anti"), same, content, dims), "cells")
    kept = index.rows.join(hashed.select(same), same, "left_semi")
    gone = index.rows.join(hashed.select(same), same, "left_anti")
    change = frequencies(fresh).unionByName(frequencies(gone).withColumn("texts", -F.col("texts")))
    counts = stored(index.counts.unionByName(change).groupBy("bucket").agg(F.sum("texts").alias("texts")).filter("texts > 0"), "frequencies")
    old, new = weights(index.counts, dims), weights(counts, dims)
    moved = [b for b in range(dims) if old[b] != new[b]]
    touched = F.arrays_overlap(F.col("cells.bucket"), F.array(*[F.lit(b) for b in moved]).cast("array<int>")) if moved else F.lit(False)
    revision = index.revision + 1
    again = kept.filter(touched).select(*same, "cells").unionByName(fresh.select(*same, "cells"))
    remade = with_vectors(again, new).withColumn("revision", F.lit(revision))
    rows = kept.filter(~touched).select(shown).unionByName(remade.select(shown))
    return Index(stored(rows, "index"), counts, revision)
