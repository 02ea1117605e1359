"""Classification, extraction, message assembly and model-output parsing on text columns; vector similarity."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plantmetrics.functions.expressions import best_label, cosine, first_match, without_fences

# The names of the failure categories. The words that mark them are this library's own.
FAILURE_KEYWORDS = {
    "electrical": ("breaker", "fuse", "relay", "short"),
    "mechanical": ("bearing", "belt", "worn", "gear"),
    "contamination": ("oil", "leak", "dust"),
    "control": ("controller", "sensor", "program"),
    "preventive": ("scheduled", "inspection", "greasing"),
}
DEFECT_KEYWORDS = {
    "dimension": ("DIMENSION",),
    "surface": ("SCRATCH",),
    "material": ("MATERIAL",),
    "assembly": ("ASSEMBLY",),
    "function": ("FUNCTION",),
}
NOTE_FIELDS = {"replaced_part": r"part: ([^,]+)", "work_minutes": r"minutes: ([0-9]+)", "technician": r"technician: (\w+)"}


def classify_text(
    df: DataFrame, column: str, labels: Mapping[str, Sequence[str]], out: str = "predicted", default: str = "other"
) -> DataFrame:
    """Label with the most keyword hits in the text; earlier labels win ties."""
    return df.withColumn(out, best_label(F.col(column), labels, default))


def label_accuracy(df: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Rows and share of right predictions."""
    right = (F.trim(predicted) == F.trim(expected)).cast("double")
    return df.agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))


def variant_accuracy(df: DataFrame, variants: Mapping[str, str], expected: str) -> DataFrame:
    """Accuracy per variant; each variant names its prediction column. One pass."""
    one = df.agg(*[F.avg((F.trim(c) == F.trim(expected)).cast("double")).alias(v) for v, c in variants.items()])
    rows = [F.struct(F.lit(v).alias("variant"), F.col(v).alias("accuracy")) for v in variants]
    return one.select(F.inline(F.array(*rows)))


def risk_levels(summary: DataFrame, high: int, medium: int) -> DataFrame:
    """Risk label of an anomaly summary by its count."""
    n = F.col("anomaly_count")
    return summary.withColumn(
        "risk_level", F.when(n >= high, "HIGH_RISK").when(n >= medium, "MEDIUM_RISK").otherwise("LOW_RISK")
    )


def pareto(df: DataFrame, column: str, group: str | None = None) -> DataFrame:
    """Counts per class with shares and, without a group, the running count over classes by falling count.

    Classes with equal counts share one running value. Windows run over one row per class.
    """
    keys = [group, column] if group else [column]
    counted = df.groupBy(*keys).agg(F.count("*").alias("row_count"))
    whole = Window.partitionBy(group) if group else Window.partitionBy()
    share = F.col("row_count") * 100.0 / F.sum("row_count").over(whole)
    out = counted.withColumn("pct", F.round(share.cast("double"), 1))
    if group:
        return out.orderBy(group, F.desc("row_count"), column)
    running = F.sum("row_count").over(Window.orderBy(F.desc("row_count")))
    return out.withColumn("cumulative", running).orderBy(F.desc("row_count"), column)


def extract_fields(df: DataFrame, column: str, fields: Mapping[str, str] = NOTE_FIELDS, out: str = "info") -> DataFrame:
    """Struct of regex captures, NULL where absent."""
    return df.withColumn(out, F.struct(*[first_match(F.col(column), p).alias(n) for n, p in fields.items()]))


def anomaly_prompt(df: DataFrame, out: str = "prompt") -> DataFrame:
    """Message text per reading; numbers are rounded before they enter it."""
    text = F.concat(
        F.lit("Equipment "), F.col("equipment_id"), F.lit(" shows an anomaly. Temperature: "),
        F.format_string("%.1f", F.round("temperature_c", 1)), F.lit(" C, vibration: "),
        F.format_string("%.2f", F.round("vibration_ms2", 2)), F.lit(" mm/s. Describe the state in one line."),
    )
    return df.withColumn(out, text)


def parse_output(
    df: DataFrame, column: str, schema: str, fallback: Mapping[str, Column], out: str = "parsed"
) -> DataFrame:
    """Model output as a struct: code fences off, JSON parsed, a typed fallback row where that fails."""
    body = without_fences(F.col(column))
    parsed = F.from_json(body, schema)
    names = StructType.fromDDL(schema).fieldNames()
    failed = parsed.isNull() | F.forall(F.array(*[parsed[n].isNull() for n in names]), lambda x: x)
    replaced = F.struct(*[fallback[n].alias(n) for n in names])
    return df.withColumn(out, F.when(failed, replaced).otherwise(parsed)).withColumn("parse_failed", failed)


def pair_similarity(df: DataFrame, left: str, right: str, out: str = "similarity") -> DataFrame:
    """Cosine similarity of two vector columns, in double."""
    return df.withColumn(out, cosine(F.col(left), F.col(right)))


def best_match(
    df: DataFrame, vector: str, references: DataFrame, ref_id: str, ref_vector: str, floor: float = 0.0,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """`matched` and `similarity_score`: the most similar reference of each row; NULL and `floor` when none scores above `floor`.

    References are streamed in blocks of at most `block_bytes` of vectors, in the order of their ids; each block is broadcast
    and compared with the Arrow batches of the rows by one matrix product, so any number of them is matched in bounded memory.
    Ties go to the smaller reference id. A NULL or zero vector matches nothing; vectors of other lengths are an error.
    """
    id_type = references.schema[ref_id].dataType
    matched = df.withColumns({"matched": F.lit(None).cast(id_type), "similarity_score": F.lit(float(floor))})
    at = df.columns.index(vector)
    rows = references.filter(F.col(ref_vector).isNotNull()).select(F.col(ref_id).alias("id"), F.col(ref_vector).alias("v"))
    for ids, vectors in _reference_blocks(rows.orderBy("id"), block_bytes):
        block = df.sparkSession.sparkContext.broadcast((ids, _units(vectors, ref_vector)))

        def compared(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            names, known = block.value
            for batch in batches:
                own, best, score = batch.column(at), batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1).to_numpy().copy()
                present = np.flatnonzero(own.is_valid().to_numpy(zero_copy_only=False))
                if len(present):
                    units = _unit_rows(own.take(pa.array(present)), vector)
                    if units.shape[1] != known.shape[1]:
                        raise ValueError(f"{vector} and {ref_vector} hold vectors of different lengths")
                    cosine = np.nan_to_num(units @ known.T, nan=-np.inf)
                    top = cosine.argmax(axis=1)
                    value = cosine[np.arange(len(top)), top]
                    better = value > score[present]
                    chosen = np.full(len(batch), -1)
                    chosen[present[better]] = top[better]
                    score[present[better]] = value[better]
                    taken = pa.array(names, best.type).take(pa.array(np.maximum(chosen, 0)))
                    best = pc.if_else(pa.array(chosen >= 0), taken, best)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], best, pa.array(score)], batch.schema.names)

        matched = matched.mapInArrow(compared, matched.schema)
    return matched


def _unit_rows(column: pa.Array, name: str) -> np.ndarray:
    """Unit vectors of a list column without nulls, read as one flat array."""
    lengths = np.diff(np.asarray(column.offsets))
    if len(np.unique(lengths)) > 1:
        raise ValueError(f"{name} holds vectors of different lengths")
    return _units(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1), name)


def _units(vectors: Sequence, name: str) -> np.ndarray:
    if len({len(v) for v in vectors}) > 1:
        raise ValueError(f"{name} holds vectors of different lengths")
    rows = np.array(vectors, np.float64)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.full_like(rows, np.nan), where=norms > 0)


def _reference_blocks(rows: DataFrame, block_bytes: int) -> Iterator[tuple[list, list]]:
    ids: list = []
    vectors: list = []
    for row in rows.toLocalIterator():
        if ids and (len(ids) + 1) * len(row["v"]) * 8 > block_bytes:
            yield ids, vectors
            ids, vectors = [], []
        ids.append(row["id"])
        vectors.append(row["v"])
    if ids:
        yield ids, vectors
