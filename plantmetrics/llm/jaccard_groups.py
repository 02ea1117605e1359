"""Set-similarity self join by a token-group matrix, and the classes that its links make.

Two texts link when the Jaccard similarity of their shingle sets is at least num / den. Equal sets are first made one node. Then

1. Shingles get an order in which common ones come last: by the class (logarithm) of a count in a sketch of fixed size, then by
   hash. If sets of n and m shingles must share a, the first n - a + l and m - a + l in this order share at least l, so only these
   are compared; a bitmap of fixed size leaves out those that no other set has.
2. Groups: nodes that share such tokens and are of like size are checked against one leader per token; verified links make groups
   of similar texts, stored in chunks of about `chunk` members.
3. Matrix: (token, chunk of a group) says which tokens the union of a chunk's prefixes has, with its smallest and largest set. A
   node that shares fewer tokens with the union than any link would need, or is too small or large, cannot link into the chunk.
4. Only qualifying chunks are opened: their members' sets and those of the querying nodes meet in one task, the overlap with the
   union of the whole sets bounds once more, and exact overlaps decide. One link per node and chunk is given out, as a chunk is of
   one group.

So every link between different groups is found, pairs inside a group are never listed, and classes are exact. Hot tokens are
pre-aggregated, a chunk's queries are dealt out by salt, and sets are made only for nodes that a fixed-size bitmap names.

Defined cases: a text without words has an empty set, links with nothing and is its own class; rows with a null id link
like any other (their class is null if none of it has an id); rows that repeat an id are one node; an empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.llm.components import components
from plantmetrics.llm.words import mixed, shingle_sets

SLOT_BITS = 20
_PARTS = 64
_CLASS_SHIFT = 58
BITMAP = 1 << 26
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Join:
    """Words in a shingle, similarity num / den, tokens that prefixes share at least, members and queries of a chunk per task."""

    size: int = 3
    num: int = 90
    den: int = 100
    shared: int = 3
    chunk: int = 256
    queries: int = 512

    def least(self, n: int) -> int:
        """Overlap that a set of n needs with any partner."""
        return -(-self.num * n // self.den)

    def prefix(self, n: int) -> int:
        return n - self.least(n) + min(self.shared, self.least(n))


def _sketch(docs: DataFrame, text: str, join: Join) -> np.ndarray:
    """Class of every slot: floor of the binary logarithm of the number of (text, shingle) whose hash falls into it."""
    slots = 1 << SLOT_BITS
    width = slots // _PARTS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 256):
                sets = list(shingle_sets(batch.column(0).slice(at, 256), join.size))
                if sets:
                    counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=slots)
        if counts.any():
            for part in range(_PARTS):
                yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([counts[part * width:(part + 1) * width].tobytes()])], ["part", "counts"])

    def added(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width, np.int64)
        for piece in frame["counts"]:
            total += np.frombuffer(piece, np.int64)
        return pd.DataFrame({"part": frame["part"].iloc[:1], "counts": [total.tobytes()]})

    partial = docs.select(F.col(text)).mapInArrow(counted, "part long, counts binary").withColumn("some", F.floor(F.spark_partition_id() / 256))
    once = partial.groupBy("part", "some").applyInPandas(lambda f: added(f), "part long, counts binary")
    total = np.zeros((_PARTS, width), np.int64)
    for row in once.groupBy("part").applyInPandas(lambda f: added(f), "part long, counts binary").collect():
        total[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return np.floor(np.log2(np.maximum(total.ravel(), 1))).astype(np.uint8)


def _signed(docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """(id, n, f1, f2, prefix) per row: set size, 128 bits that name the set, first tokens in the common-last order."""
    classes = docs.sparkSession.sparkContext.broadcast(_sketch(docs, text, join))  # 2^20 bytes

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sizes, first, second, prefixes = [], [], [], []
                for found in shingle_sets(part.column(1), join.size):
                    n = len(found)
                    order = classes.value[(found >> np.uint64(64 - SLOT_BITS)).astype(np.int64)].astype(np.uint64)
                    tokens = (order << np.uint64(_CLASS_SHIFT)) | (found >> np.uint64(64 - _CLASS_SHIFT))
                    want = join.prefix(n)
                    prefixes.append(np.sort(np.partition(tokens, want - 1)[:want] if 0 < want < n else tokens).view(np.int64))
                    sizes.append(n)
                    first.append(np.add.reduce(found, dtype=np.uint64).view(np.int64))
                    second.append(np.add.reduce(mixed(found + np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
                     pa.array(prefixes, pa.list_(pa.int64()))], ["id", "n", "f1", "f2", "prefix"],
                )

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(signed, f"id {dict(rows.dtypes)['id']}, n long, f1 long, f2 long, prefix array<long>")


def _bitmap(numbers: DataFrame) -> np.ndarray:
    """Packed bits, one per remainder of `number` by BITMAP; BITMAP / 8 bytes whatever the input."""
    slot = F.pmod("number", F.lit(BITMAP)) + 1
    bits = numbers.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits"))
    flat = np.zeros(BITMAP // 8, np.uint8)
    for row in bits.collect():  # at most BITMAP / 32768 rows of 4 KB
        flat[(row["bucket"] - 1) * 4096:row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return flat


def _named(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    slots = numbers & (BITMAP - 1)
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def _posted(nodes: DataFrame) -> DataFrame:
    """(rep, n, token, at) for the prefix tokens that two nodes or more may have; `at` is the place in the prefix.

    Tokens are counted by their last 30 bits, so one that stands alone may be kept, but none that is shared is lost.
    """
    counted = nodes.select(F.explode("prefix").alias("token")).groupBy(F.pmod("token", F.lit(1 << 30)).alias("number")).agg(F.count("*").alias("many"))
    shared = nodes.sparkSession.sparkContext.broadcast(_bitmap(counted.filter("many > 1")))
    id_kind = dict(nodes.dtypes)["rep"]

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            tokens = lists.flatten().to_numpy(zero_copy_only=False)
            places = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keep = np.flatnonzero(_named(shared.value, tokens))
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes)[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(tokens[keep]), pa.array(places[keep])], ["rep", "n", "token", "at"]
            )

    return nodes.select("rep", "n", "prefix").mapInArrow(posted, f"rep {id_kind}, n long, token long, at long")


def _sets(docs: DataFrame, key: str, text: str, join: Join, wanted: DataFrame) -> DataFrame:
    """(id, tokens) of at least the wanted ids: a bitmap says which texts to read."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(F.xxhash64("id").alias("number"))))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_named(shared.value, batch.column(2).to_numpy(zero_copy_only=False))))
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = list(shingle_sets(part.column(1), join.size))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "tokens"],
                )

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = rows.withColumn("number", F.xxhash64("id"))
    return rows.mapInArrow(made, f"id {dict(rows.dtypes)['id']}, tokens binary")


class _Chunk:
    """Members of one opened chunk and their tokens, for exact overlaps with querying sets."""

    def __init__(self, join: Join):
        self.join, self.ids, self.sets, self.tokens, self.owners = join, [], [], None, None

    def add(self, node: int, tokens: np.ndarray) -> None:
        self.ids.append(node)
        self.sets.append(tokens)

    def link(self, tokens: np.ndarray) -> int | None:
        """A member that links with the set."""
        if not self.ids or not len(tokens):
            return None
        if self.tokens is None:
            flat = np.concatenate(self.sets)
            order = np.argsort(flat, kind="stable")
            self.tokens, self.owners = flat[order], np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])[order]
            self.sizes = np.array([len(s) for s in self.sets])
        low = np.searchsorted(self.tokens, tokens, "left")
        many = np.searchsorted(self.tokens, tokens, "right") - low
        if np.count_nonzero(many) < self.join.least(len(tokens)):
            return None
        ends = np.cumsum(many)
        at = np.arange(ends[-1]) + np.repeat(low - (ends - many), many)
        both = np.bincount(self.owners[at], minlength=len(self.ids))
        found = np.flatnonzero(self.join.den * both >= self.join.num * (self.sizes + len(tokens) - both))
        return self.ids[found[0]] if len(found) else None


def _opened(queries: DataFrame, members: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Links (a, b) of queries (id, chunk) with members (id, chunk), one per query and chunk at most."""
    load = queries.groupBy("chunk").agg(F.ceil(F.count("*") / join.queries).cast("int").alias("salts"))
    asking = queries.join(load, "chunk").select("id", "chunk", F.pmod(F.xxhash64("id"), "salts").cast("int").alias("salt"), F.lit(1).alias("asks"))
    asked = members.join(load, "chunk").select("id", "chunk", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("asks"))
    dealt_to = stored(asked.unionByName(asking), "dealt-to")
    # Up to BROADCAST_ROWS rows of four numbers go to the sets, so that these are shuffled once; more are joined by a shuffle.
    side = F.broadcast(dealt_to) if dealt_to.count() <= BROADCAST_ROWS else dealt_to
    rows = sets.join(side, "id").select("chunk", "salt", "asks", "id", "tokens")
    dealt = rows.repartition("chunk", "salt").sortWithinPartitions("chunk", "salt", "asks")
    id_kind = dict(rows.dtypes)["id"]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chunk = None, _Chunk(join)
        for batch in batches:
            a, b = [], []
            groups, salts, asks, ids, tokens = batch.columns
            for g, s, q, node, raw in zip(groups.to_pylist(), salts.to_pylist(), asks.to_pylist(), ids.to_pylist(), tokens, strict=True):
                if (g, s) != now:
                    now, chunk = (g, s), _Chunk(join)
                found = np.frombuffer(raw.as_buffer(), np.uint64)
                if not q:
                    chunk.add(node, found.copy())
                elif (other := chunk.link(found)) is not None and other != node:
                    a.append(node)
                    b.append(other)
            yield pa.RecordBatch.from_arrays([pa.array(a, ids.type), pa.array(b, ids.type)], ["a", "b"])

    return dealt.mapInArrow(linked, f"a {id_kind}, b {id_kind}")


def _shared(n: Column, m: Column, join: Join) -> Column:
    """Tokens that the prefixes of linked sets of n and m share at least."""
    return F.least(F.lit(join.shared), F.ceil(F.least(n, m) * join.num / F.lit(join.den)))


def _overlap(n: Column, m: Column, join: Join) -> Column:
    """Overlap that linked sets of n and m have at least."""
    return F.ceil((n + m) * join.num / F.lit(join.num + join.den))


def _near_size(a: Column, b: Column, join: Join) -> Column:
    return (a * join.den >= b * join.num) & (b * join.den >= a * join.num)


def _labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """`label` of every node: its component under the links so far, itself without one."""
    found = components(links).select(F.col("node").alias("rep"), "component")
    return nodes.join(found, "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")


def links(docs: DataFrame, nodes: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """Links (a, b) between nodes (rep, n, prefix) that join exactly the nodes that the similarity joins, directly or not."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(join.den / join.num))).cast("int")
    posted = stored(_posted(nodes).withColumn("band", band), "postings")
    leaders = posted.groupBy("token", "band").agg(F.min(F.struct("rep", "n", "at")).alias("lead"), F.count("*").alias("many")).filter("many > 1")
    n, m = F.col("n"), F.col("lead.n")
    # Past these places a token cannot be among the shared ones of sets of these sizes.
    slack = _shared(n, m, join) - _overlap(n, m, join)
    early = (F.col("at") - n < slack) & (F.col("lead.at") - m < slack)
    pairs = posted.join(leaders, ["token", "band"]).filter((F.col("rep") != F.col("lead.rep")) & _near_size(n, m, join) & early)
    near = pairs.groupBy("rep", F.col("lead.rep").alias("leader")).agg(F.count("*").alias("both"), F.first(_shared(n, m, join)).alias("need"))
    near = stored(near.filter("both >= need").select("rep", "leader"), "leaders")
    asking = near.select(F.col("rep").alias("id"), F.col("leader").alias("chunk"))
    asked = near.select(F.col("leader").alias("id"), F.col("leader").alias("chunk")).distinct()
    named = asking.select("id").unionByName(asked.select("id"))
    star = stored(_opened(asking, asked, _sets(docs, key, text, join, named), join), "star-links")

    sizes = _labelled(nodes.select("rep", "n"), star)
    wide = sizes.groupBy("label").agg(F.ceil(F.count("*") / join.chunk).alias("chunks"))
    chunk = F.xxhash64("label", F.pmod(F.xxhash64("rep"), "chunks"))
    held = stored(sizes.join(wide, "label").select("rep", "n", "label", chunk.alias("chunk")), "chunks")
    placed = posted.select("rep", "token", "at").join(held, "rep")
    mixed_tokens = placed.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("token")
    placed = stored(placed.join(mixed_tokens, "token"), "matrix-rows")
    matrix = placed.groupBy("token", "label", "chunk").agg(
        F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min(F.col("at") - F.col("n")).alias("first_at")
    )
    asks = placed.select("token", F.col("rep").alias("id"), F.col("n").alias("own_n"), F.col("label").alias("own"), "at")
    n, m = F.col("own_n"), F.col("least_n")
    slack = _shared(n, m, join) - _overlap(n, m, join)
    fits = (F.col("own") > F.col("label")) & (m * join.num <= n * join.den) & (n * join.num <= F.col("most_n") * join.den)
    early = (F.col("at") - n < slack) & (F.col("first_at") < slack)
    bound = asks.join(matrix, "token").filter(fits & early).groupBy("id", "chunk").agg(
        F.count("*").alias("both"), F.min(_shared(n, m, join)).alias("need")
    )
    opened = stored(bound.filter("both >= need").select("id", "chunk"), "opened")
    members = held.select(F.col("rep").alias("id"), "chunk").join(opened.select("chunk").distinct(), "chunk")
    named = opened.select("id").unionByName(members.select("id"))
    return star.unionByName(stored(_opened(opened, members, _sets(docs, key, text, join, named), join), "group-links"))


def _classes(docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """(key, n_shingles, component_id) per row of a table without null keys."""
    rows = stored(_signed(docs, key, text, join), "signed")
    nodes = rows.filter("n > 0").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"), F.first("prefix").alias("prefix"))
    nodes = stored(nodes, "nodes")
    found = components(links(docs, nodes.select("rep", "n", "prefix"), key, text, join)).select(F.col("node").alias("rep"), "component")
    named = nodes.select("n", "f1", "f2", "rep").join(found, "rep", "left").select("n", "f1", "f2", F.coalesce("component", "rep").alias("component"))
    labelled = rows.select("id", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left")
    own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component"))
    return labelled.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _name(key: str, text: str) -> Column:
    """Name of a row that is never null: its id, else its text's digest."""
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    return F.when(F.col(key).isNotNull(), F.concat(F.lit("i"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("n"), digest))


def _named_classes(docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """(name, n_shingles, least, first) per row: the smallest id of its class (null without one) and the name of the row to keep."""
    found = stored(_classes(docs.select(_name(key, text).alias("name"), F.col(text).alias("text")), "name", "text", join), "named")
    own = F.when(F.col("name").startswith("i"), F.expr("substring(name, 2)").cast(docs.schema[key].dataType))
    least = found.groupBy("component_id").agg(F.min(own).alias("least"), F.min("name").alias("low"))
    first = F.coalesce(F.concat(F.lit("i"), F.col("least").cast("string")), "low")
    return found.join(least.withColumn("first", first).drop("low"), "component_id").select("name", "n_shingles", "least", "first", own.alias("own"))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """(key, n_shingles, component_id) per row; rows with a null id link like any other, and are named inside by their text."""
    if docs.filter(F.col(key).isNull()).isEmpty():
        return _classes(docs, key, text, join)
    return _named_classes(docs, key, text, join).select(F.col("own").alias(key), "n_shingles", F.col("least").alias("component_id"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """One row of each class, that with the smallest id, with all its columns; rows without words all stay.

    Of rows that repeat the smallest id, all stay; of a class without ids, the rows of one text. Only names of rows to drop are
    joined with the rows.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    if docs.filter(F.col(key).isNull()).isEmpty():
        found = _classes(docs, key, text, join)
        gone = found.filter((F.col("n_shingles") > 0) & (F.col(key) != F.col("component_id"))).select(key).distinct()
        return docs.join(stored(gone, "later-copies"), key, "left_anti").select(*own)
    name = "name"
    while name in docs.columns:
        name = f"_{name}"
    found = _named_classes(docs, key, text, join)
    gone = found.filter((F.col("n_shingles") > 0) & (F.col("name") != F.col("first"))).select(F.col("name").alias(name)).distinct()
    return docs.withColumn(name, _name(key, text)).join(stored(gone, "later-copies"), name, "left_anti").select(*own)
