"""Documents to page chunks, text vectors, batch top-k search and context assembly."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from plantmetrics.operators.ordered import top_n_per_key
from plantmetrics.sources.tables import union_by_name

ELEMENTS = (
    "array<struct<id:bigint,type:string,content:string,confidence:double,description:string,"
    "bbox:array<struct<coord:array<bigint>,page_id:bigint>>>>"
)
BROADCAST_BYTES = 16 << 20
BLOCK_ROWS = 50_000
QUERY_SLICE = 256


def page_chunks(df: DataFrame, elements: str, keys: Sequence[str]) -> DataFrame:
    """Elements JSON to one Markdown text per document and page; empty elements are dropped, their order is kept."""
    rows = df.select(*keys, F.posexplode(F.from_json(F.col(elements), ELEMENTS)).alias("pos", "e"))
    text = (
        F.when(F.col("e.type") == "title", F.concat(F.lit("# "), F.col("e.content")))
        .when(F.col("e.type") == "section_header", F.concat(F.lit("## "), F.col("e.content")))
        .when(F.col("e.type") == "caption", F.concat(F.lit("*"), F.col("e.content"), F.lit("*")))
        .otherwise(F.col("e.content"))
    )
    lines = rows.filter(F.length("e.content") > 0).select(
        *keys, F.get(F.col("e.bbox"), F.lit(0))["page_id"].alias("page_id"), "pos", text.alias("line")
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "line")))
    return lines.groupBy(*keys, "page_id").agg(
        F.concat_ws("\n", F.transform(ordered, lambda x: x["line"])).alias("content")
    )


# Rewrite rules from HTML to Markdown, in the order they apply.
HTML_RULES = (
    (r"(?is)<script\b[^>]*>.*?</script\s*>", ""),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", ""),
    (r"(?s)<!--.*?-->", ""),
    (r"(?i)<h1\b[^>]*>", "\n\n# "),
    (r"(?i)<h2\b[^>]*>", "\n\n## "),
    (r"(?i)<h3\b[^>]*>", "\n\n### "),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r"(?i)<li\b[^>]*>", "\n* "),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</p\s*>", "\n\n"),
    (r"(?i)<tr\b[^>]*>", "\n|"),
    (r"(?i)</t[dh]\s*>", " |"),
    (r"(?i)</?(?:b|strong)\b[^>]*>", "**"),
    (r"(?s)<[^>]+>", ""),
)
HTML_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_to_markdown(df: DataFrame, column: str, only_with: str | None = "<table") -> DataFrame:
    """HTML in a text column to Markdown: table rows to pipes, headings to #, images and other tags removed.

    Rows without the marker `only_with` pass unchanged, NULL stays NULL.
    """
    text = F.col(column)
    out = text
    for pattern, replacement in HTML_RULES:
        out = F.regexp_replace(out, pattern, replacement)
    for entity, char in HTML_ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    out = F.btrim(F.regexp_replace(out, r"\n{3,}", "\n\n"), F.lit(" \n"))
    return df.withColumn(column, F.when(F.contains(text, F.lit(only_with)), out).otherwise(text) if only_with else out)


def html_headings(df: DataFrame, column: str) -> DataFrame:
    """Title and first heading of a page, NULL when absent."""
    def inside(tag: str):
        found = F.regexp_extract(F.col(column), rf"<{tag}[^>]*>([^<]*)</{tag}>", 1)
        return F.when(found != "", found)

    return df.withColumns({"title": inside("title"), "heading": inside("h1")})


def with_chunk_id(df: DataFrame, doc_id: str = "doc_id", page_id: str = "page_id") -> DataFrame:
    """Stable chunk id from document and page."""
    return df.withColumn("chunk_id", F.md5(F.concat_ws("_", F.col(doc_id).cast("string"), F.col(page_id).cast("string"))))


def combine_chunks(frames: Sequence[DataFrame]) -> DataFrame:
    """Chunks of several documents in one frame, by column name."""
    return union_by_name(frames)


def chunk_counts(chunks: DataFrame, by: Sequence[str]) -> DataFrame:
    """Chunks per type."""
    return chunks.groupBy(*by).agg(F.count("*").alias("chunk_count")).orderBy(*by)


def embed_text(df: DataFrame, text: str, out: str = "embedding", dims: int = 256) -> DataFrame:
    """Unit-length hashed word-count vector. Stateless, so an incremental run gives the vectors of a full one."""
    named = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"[^\p{L}\p{N}]+", gaps=True)
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dims)
    made = Normalizer(inputCol="_counts", outputCol="_unit").transform(counts.transform(words.transform(named)))
    return made.withColumn(out, vector_to_array("_unit", "float32")).drop("_text", "_words", "_counts", "_unit")


def changed_chunks(chunks: DataFrame, index: DataFrame, key: str = "chunk_id", content: str = "content") -> DataFrame:
    """(key, change) of chunks that are new or changed and of index rows whose chunk vanished."""
    now = chunks.select(key, F.md5(content).alias("_now"))
    known = index.select(key, F.col("content_hash").alias("_known"))
    both = now.join(known, key, "full_outer")
    change = (
        F.when(F.col("_known").isNull(), "new").when(F.col("_now").isNull(), "vanished")
        .when(F.col("_now") != F.col("_known"), "changed")
    )
    return both.withColumn("change", change).filter("change IS NOT NULL").select(key, "change")


def sync_embeddings(
    chunks: DataFrame, index: DataFrame | None, key: str = "chunk_id", content: str = "content", dims: int = 256
) -> DataFrame:
    """Index after a sync: vectors of unchanged chunks are kept, new and changed ones embedded, vanished ones dropped."""
    hashed = chunks.select(key, content, F.md5(content).alias("content_hash"))
    if index is None:
        return embed_text(hashed, content, dims=dims).select(key, "content_hash", "embedding")
    kept = index.join(hashed.select(key, "content_hash"), [key, "content_hash"], "left_semi")
    todo = hashed.join(index.select(key, "content_hash"), [key, "content_hash"], "left_anti")
    return kept.select(key, "content_hash", "embedding").unionByName(
        embed_text(todo, content, dims=dims).select(key, "content_hash", "embedding")
    )


def _unit(vectors: Sequence) -> np.ndarray:
    if len({len(v) for v in vectors}) > 1:
        raise ValueError("the vectors have different lengths")
    rows = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.full_like(rows, np.nan), where=norms > 0)


def best_rows(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k best finite scores of every column; among equal ones the earlier rows."""
    if not len(scores):
        return np.zeros(scores.shape, bool)
    at = max(len(scores) - k, 0)
    edge = np.partition(scores, at, axis=0)[at]
    above, tie = scores > edge, scores == edge
    return (above | (tie & (np.cumsum(tie, axis=0) <= k - above.sum(axis=0)))) & np.isfinite(scores)


def _best(corpus: pd.DataFrame, queries: pd.DataFrame, unit_queries: np.ndarray, k: int, filters: Sequence[str]) -> pd.DataFrame:
    """Top k of one batch per query, ties kept by smaller corpus id. Queries go in slices to bound the score matrix."""
    q, c, found = [], [], []
    corpus = corpus.sort_values("c_id", kind="stable")
    ids = corpus["c_id"].to_numpy()
    unit_corpus = _unit(corpus["c_vec"]) if len(corpus) and len(queries) else None
    for start in range(0, len(queries) if len(corpus) else 0, QUERY_SLICE):
        asked = queries.iloc[start:start + QUERY_SLICE]
        scores = unit_corpus @ unit_queries[start:start + QUERY_SLICE].T
        scores[np.isnan(scores)] = -np.inf
        for name in filters:
            wanted = asked[name].to_numpy()[None, :]
            scores[~(pd.isna(wanted) | (corpus[name].to_numpy()[:, None] == wanted))] = -np.inf
        column, row = np.nonzero(best_rows(scores, k).T)
        q.append(asked["q_id"].to_numpy()[column])
        c.append(ids[row])
        found.append(scores[row, column])
    if not q:
        return pd.DataFrame({"q_id": [], "c_id": [], "score": []})
    return pd.DataFrame({"q_id": np.concatenate(q), "c_id": np.concatenate(c), "score": np.concatenate(found)})


def topk_similar(
    corpus: DataFrame, queries: DataFrame, k: int = 3, filters: Sequence[str] = (), corpus_id: str = "id",
    corpus_vector: str = "embedding", query_id: str = "id", query_vector: str = "embedding",
    broadcast_bytes: int = BROADCAST_BYTES, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact top-k cosine search for a batch of queries: (query_id, corpus_id, score, rank).

    `filters` are equality conditions: corpus rows must equal the query's value, a NULL there means no condition.
    Each task scores Arrow batches against the query matrix and hands on k rows per query and batch, never the pairs.
    Query vectors of up to `broadcast_bytes` (measured first) are broadcast. More are handled in blocks: corpus shards and
    query shards of bounded size are matched by shard number, with the same result. Ties go to the smaller corpus id. NULL and
    zero vectors score nothing; vectors of different lengths are an error.
    """
    c = corpus.select(F.col(corpus_id).alias("c_id"), F.col(corpus_vector).alias("c_vec"), *filters).filter("c_vec IS NOT NULL")
    q = queries.select(F.col(query_id).alias("q_id"), F.col(query_vector).alias("q_vec"), *filters).filter("q_vec IS NOT NULL")
    q_type, c_type = q.schema["q_id"].dataType, c.schema["c_id"].dataType
    schema = f"q_id {q_type.simpleString()}, c_id {c_type.simpleString()}, score double"
    held = q.agg(F.coalesce(F.sum(F.size("q_vec") + 1), F.lit(0)).alias("numbers")).first()["numbers"] * 8
    if held <= broadcast_bytes:
        head = q.toPandas()
        shared = corpus.sparkSession.sparkContext.broadcast((head, _unit(head["q_vec"]) if len(head) else None))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            wanted, unit = shared.value
            for batch in batches:
                yield _best(batch, wanted, unit, k, filters)

        found = c.mapInPandas(score, schema)
    else:
        found = _topk_blocked(c, q, k, filters, schema, held // broadcast_bytes + 1, block_rows)
    top = top_n_per_key(found, ["q_id"], [F.desc("score"), F.asc("c_id")], k)
    return top.select(F.col("q_id").alias("query_id"), F.col("c_id").alias("corpus_id"), "score", "rank")


def _topk_blocked(
    c: DataFrame, q: DataFrame, k: int, filters: Sequence[str], schema: str, q_shards: int, block_rows: int
) -> DataFrame:
    """Fragment-and-replicate form: every (corpus shard, query shard) is one group of bounded size."""
    c_shards = c.count() // block_rows + 1

    def shard(column: str, shards: int):
        return F.pmod(F.xxhash64(column), F.lit(shards)).cast(LongType())

    left = c.withColumn("cs", shard("c_id", c_shards)).withColumn("qs", F.explode(F.sequence(F.lit(0), F.lit(q_shards - 1))))
    right = q.withColumn("qs", shard("q_id", q_shards)).withColumn("cs", F.explode(F.sequence(F.lit(0), F.lit(c_shards - 1))))

    def score(corpus_part: pd.DataFrame, query_part: pd.DataFrame) -> pd.DataFrame:
        unit = _unit(query_part["q_vec"]) if len(query_part) else None
        return _best(corpus_part, query_part, unit, k, filters)

    return left.groupBy("cs", "qs").cogroup(right.groupBy("cs", "qs")).applyInPandas(score, schema)


def assemble_context(hits: DataFrame, chunks: DataFrame, chunk_key: str, described: Sequence[str], content: str) -> DataFrame:
    """One context text per query from its ranked hits (k rows at most): a header line of metadata, then the content."""
    header = F.concat(
        F.lit("["), F.concat_ws(" | ", *[F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("N/A"))) for c in described]),
        F.lit("]\n"),
    )
    named = hits.withColumnRenamed("corpus_id", chunk_key).join(chunks, chunk_key, "left")
    block = F.concat(header, F.coalesce(F.col(content).cast("string"), F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    return named.groupBy("query_id").agg(F.concat_ws("\n\n", F.transform(ordered, lambda x: x["block"])).alias("context"))


def sensor_text(latest: DataFrame) -> DataFrame:
    """State text per equipment from its newest reading."""
    state = F.when(F.col("is_anomaly"), "ANOMALY").otherwise("normal")
    text = F.concat(
        F.lit("Equipment "), F.col("equipment_id"), F.lit(" / "), F.col("equipment_type"),
        F.lit(": temperature "), F.format_string("%.1f", "temperature_c"), F.lit(" C, vibration "),
        F.format_string("%.2f", "vibration_ms2"), F.lit(" mm/s, pressure "), F.format_string("%.1f", "pressure_bar"),
        F.lit(" bar, rpm "), F.format_string("%.0f", "rpm"), F.lit(", state "), state,
    )
    return latest.select("equipment_id", text.alias("sensor_context"))


def hybrid_context(requests: DataFrame, contexts: DataFrame, latest: DataFrame, missing: str = "no sensor data") -> DataFrame:
    """Requests (query_id, equipment_id) with the manual context of the query and the equipment's newest state."""
    joined = requests.join(contexts, "query_id", "left").join(sensor_text(latest), "equipment_id", "left")
    return joined.select(
        "query_id", "equipment_id", F.coalesce("sensor_context", F.lit(missing)).alias("sensor_context"),
        F.col("context").alias("manual_context"),
    )
