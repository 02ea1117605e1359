"""Personal data: base patterns, candidate spans of high recall, boosted trees over their format and context, calibrated thresholds.

Base spans are what the four base patterns accept. Generators propose more, overlapping each other: every run of neighbouring digit
groups that could be a card or a phone number, every four neighbouring parts of a dotted number, texts round an `@` or a written-out
one, long runs of letters and digits. A model of boosted trees says which to take; it learns from the corpus itself: a candidate that
holds the digits (or characters) of a base span is right, or, for secrets, one that a name like `token` is given; one inside a match
that the base dropped as a whole is not used for learning, nor is a phone number without `+` or a written-out address, since the base
cannot judge those; all others are wrong. All candidates are learnt from: their numbers are put into bins of a fixed grid, equal ones
are counted, and every level of the trees is one pass over the counted rows. Four folds give every candidate a score by trees that have
not seen it; a logistic curve through these makes the scores probabilities, and each kind gets the lowest threshold, at least one half,
above which the share of right ones is `precision` or more. Curve and thresholds are read from the counts of all candidates by kind,
label and score (in steps of 1/64). Kinds that reach no such threshold add nothing.

Selected spans do not overlap base spans or each other: the likelier (to one decimal) goes first, then the longer, then the earlier.

Defined cases: a null or empty text has no spans, and a null one is redacted to null; null and repeated ids are kept; repeated
candidates teach once; an empty table gives no rows; texts of any length are read whole in linear time; other columns are not read
(`redact` keeps them).
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantmetrics.functions.sizing import stored
from plantmetrics.llm.boosting import Trees, binned, boost_counted, packed, sigmoid

KINDS = ("email", "ip", "card", "phone", "secret")
EMAIL, IP, CARD, PHONE, SECRET = range(5)
SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_())]))

# Patterns of the contract, in forms that read a text once: possessive repeats, and a start that cannot lie inside a run.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Candidates.
_NUMERIC = re.compile(r"[0-9][0-9 ().+/-]*[0-9]")
_GROUP = re.compile(r"[0-9]++")
_AROUND_AT = re.compile(r"(?<![^\s@])[^\s@]++@[^\s@]++")
_WRITTEN_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[({]at[\])}] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[({]dot[\])}]) ?[A-Za-z0-9-]++)++")
_MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+")
_ASSIGNED = re.compile(r"(?:token|secret|api[_-]?key|passw(?:or)?d|pwd|auth|credential)[\w-]{0,16}[\"']?\s{0,3}[:=]\s{0,3}[\"']?\Z", re.I)
_CUES = tuple(re.compile(p, re.I) for p in (
    r"mail|contact|write to", r"\bip\b|addr|host|server", r"card|visa|credit|pay", r"phone|tel\b|call|fax|mobile", r"token|secret|key|passw|auth",
))
_REACH = 32
_MOST_GROUPS = 8
FEATURES = 5 + 22 + 11
_FOLDS = 4
#: Bins of a described number: whole numbers up to 16 apart, larger ones in growing steps; the share of distinct characters in 32nds.
_EDGES = np.tile(np.array([
    *np.arange(16) + 0.5, 17.5, 19.5, 22.5, 26.5, 32.5, 40.5, 48.5, 64.5, 96.5, 128.5, 192.5, 256.5, 512.5, 1024.5, 4096.5,
]), (FEATURES, 1))
_EDGES[17] = np.arange(1, 32) / 32
_STEP = 64


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)


def _only_digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def base_matches(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(accepted, dropped) matches (start, kind, end) of the base patterns, leftmost and apart within a kind."""
    good, bad, past = [], [], 0
    for found in _HOST.finditer(text):
        at = start = found.start()
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            past = found.end()
            good.append((start, EMAIL, past))
    for found in _QUAD.finditer(text):
        (good if _octets(found.group().split(".")) else bad).append((found.start(), IP, found.end()))
    for found in _DIGITS.finditer(text):
        if found.end() - found.start() >= 12:
            digits = _only_digits(found.group())
            (good if 12 <= len(digits) <= 19 and _luhn(digits) else bad).append((found.start(), CARD, found.end()))
    for found in _PLUS.finditer(text):
        (good if 9 <= sum(c.isdigit() for c in found.group()) <= 15 else bad).append((found.start(), PHONE, found.end()))
    return sorted(good), sorted(bad)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Proposed (start, kind, end), overlapping: at most _MOST_GROUPS per digit group and kind, one per other run."""
    out = []
    for run in _NUMERIC.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [(g.start(), g.end()) for g in _GROUP.finditer(text, run.start(), run.end())]
        for i, (start, _) in enumerate(groups):
            count = 0
            lead = start - (start > 0 and text[start - 1] == "(")
            lead -= lead > 0 and text[lead - 1] == "+"
            for j in range(i, min(i + _MOST_GROUPS, len(groups))):
                count += groups[j][1] - groups[j][0]
                if count > 19:
                    break
                end = groups[j][1]
                gaps = [text[groups[k][1]:groups[k + 1][0]] for k in range(i, j)]
                if count >= 12 and all(gap in (" ", "-") for gap in gaps):
                    out.append((start, CARD, end))
                if 7 <= count <= 15 and all(len(gap) <= 3 for gap in gaps):
                    out.append((lead, PHONE, end))
                if j == i + 3 and all(gap == "." for gap in gaps):
                    out.append((start, IP, end))
    for run in _AROUND_AT.finditer(text) if "@" in text else ():
        start, end = run.span()
        while start < end and not text[start].isalnum():
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        if "@" in text[start:end]:
            out.append((start, EMAIL, end))
    out += [(run.start(), EMAIL, run.end()) for run in _WRITTEN_AT.finditer(text)]
    out += [(run.start(), SECRET, run.end()) for run in _MIXED.finditer(text) if _GROUP.search(text, run.start(), run.end())]
    return sorted(set(out))


def _side(c: str) -> int:
    if not c or c.isspace():
        return 0
    return 1 if c.isalpha() else 2 if c.isdigit() else 3 if c in "\"'`" else 4 if c in "=:" else 5


def describe(text: str, start: int, kind: int, end: int) -> list[float]:
    """Numbers of format and context of one candidate."""
    span, before, after = text[start:end], text[max(0, start - _REACH):start], text[end:end + _REACH]
    groups = [len(g) for g in _GROUP.findall(span)] or [0]
    digits, letters = sum(groups), sum(map(str.isalpha, span))
    numbers = _only_digits(span) if 12 <= digits <= 19 else ""
    runs = re.findall(r"[^\W\d_]+|[0-9]+", span)
    quad = span.split(".")
    return [
        *(float(kind == k) for k in range(5)),
        len(span), digits, letters, len(span) - digits - letters, len(groups), groups[0], groups[-1], max(groups), span[:1] == "+", "(" in span,
        bool(numbers) and _luhn(numbers), len(quad) == 4 and all(p.isdecimal() for p in quad) and _octets(quad),
        len(set(span)) / max(len(span), 1), max((len(r) for r in runs if r[0].isalpha()), default=0), len(runs),
        all(c in "0123456789abcdefABCDEF" for c in span), sum(map(str.isupper, span)), span.count("@"), span.count("."), span.count("-"),
        span.count(" "), len(span.rsplit(".", 1)[-1]) if "." in span else 0,
        _side(before[-1:]), _side(after[:1]), any(c in "=:" for c in before[-4:]), before[-1:] in ("\"", "'") and before[-1:] == after[:1],
        *(cue.search(before) is not None for cue in _CUES), sum(map(str.isdigit, before[-8:])), sum(map(str.isdigit, after[:8])),
    ]


def _label(text: str, start: int, kind: int, end: int, good: list, bad: list) -> bool | None:
    """Whether the corpus shows the candidate right; None where the base cannot judge it."""
    if kind == SECRET:
        return _ASSIGNED.search(text[max(0, start - _REACH):start]) is not None
    size = (lambda a, b: len(_only_digits(text[a:b]))) if kind != EMAIL else (lambda a, b: b - a)
    own = size(start, end)
    for a, k, b in good:
        if a < end and start < b:
            if k == kind:
                shared = size(max(a, start), min(b, end))
                return shared >= 0.9 * (own + size(a, b) - shared)
            if kind in (CARD, PHONE, IP):
                return False
    for a, k, b in bad:
        if k == kind and a <= start and end <= b:
            return False if (a, b) == (start, end) else None
    if kind == EMAIL and "@" not in text[start:end]:
        return None
    if kind == PHONE and text[start] != "+" and not text[start:end].isdecimal():
        return None
    return False


@dataclass(frozen=True)
class Model:
    """Trees, the logistic curve through held-out margins, and a threshold per kind (above 1: the kind adds nothing)."""

    trees: Trees
    slope: float
    shift: float
    thresholds: tuple[float, ...]

    def chances(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.trees.margins(rows) + self.shift)


class _Smallest:
    """Rows of the smallest distinct hashes, at most `most` kept between trims; all of them without `most`."""

    def __init__(self, most: int | None):
        self.most, self.rows, self.limit = most, {}, b"\xff" * 9

    def add(self, name: bytes, row: bytes) -> None:
        if name < self.limit and name not in self.rows:
            self.rows[name] = row
            if self.most is not None and len(self.rows) >= 2 * self.most:
                self.rows = {n: self.rows[n] for n in heapq.nsmallest(self.most, self.rows)}
                self.limit = max(self.rows)


def _kept(most: int | None) -> dict[tuple[int, bool], _Smallest]:
    return {(k, label): _Smallest(most) for k in range(5) for label in (False, True)}


def _taken(kept: dict[tuple[int, bool], _Smallest]) -> Iterator[pa.RecordBatch]:
    rows = [(k, label, name, row) for (k, label), few in kept.items() for name, row in few.rows.items()]
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.bool_(), pa.binary(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["kind", "label", "name", "row"])


def training_rows(docs: DataFrame, text: str = "text", per_class: int | None = None) -> DataFrame:
    """(kind, label, name, row): distinct labelled candidates of all texts; with `per_class` the smallest hashes of each kind and label."""

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _kept(per_class)
        for batch in batches:
            if per_class is None:
                yield from _taken(kept)
                kept = _kept(None)
            for value in batch.column(0).to_pylist():
                if not value:
                    continue
                proposed = candidates(value)
                if not proposed:
                    continue
                good, bad = base_matches(value)
                touching = _Touching(good), _Touching(bad)
                for start, kind, end in proposed:
                    label = _label(value, start, kind, end, touching[0].of(start, end), touching[1].of(start, end))
                    if label is None:
                        continue
                    seen = f"{kind}\n{value[max(0, start - _REACH):start]}\n{value[start:end]}\n{value[end:end + _REACH]}".encode("utf-8", "surrogatepass")
                    name = hashlib.blake2b(seen, digest_size=8).digest()
                    if name < kept[kind, label].limit:
                        kept[kind, label].add(name, np.array(describe(value, start, kind, end), np.float32).tobytes())
        yield from _taken(kept)

    found = docs.select(text).mapInArrow(labelled, "kind int, label boolean, name binary, row binary").dropDuplicates(["kind", "label", "name"])
    if per_class is None:
        return found
    # A class first meets in 64 parts, so that its last task gets at most 64 * per_class rows however many tasks there were.
    parted = found.withColumn("_part", F.spark_partition_id() % 64)
    for by in (["kind", "label", "_part"], ["kind", "label"]):
        order = Window.partitionBy(*by).orderBy("name")
        parted = parted.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= per_class).drop("_place")
    return parted.drop("_part")


class _Touching:
    """Spans that touch a candidate, for candidates asked by rising start; spans of a kind do not overlap, so few are open at once."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.spans, self.next, self.open = spans, 0, []

    def of(self, start: int, end: int) -> list[tuple[int, int, int]]:
        while self.next < len(self.spans) and self.spans[self.next][0] < end:
            self.open.append(self.spans[self.next])
            self.next += 1
        self.open = [s for s in self.open if s[2] > start]
        return [s for s in self.open if s[0] < end]


def _curve(margins: np.ndarray, labels: np.ndarray, many: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through `many` candidates each, by Newton steps with targets drawn in from 0 and 1."""
    right = (labels * many).sum()
    target = np.where(labels > 0, (right + 1) / (right + 2), 1 / (many.sum() - right + 2))
    w = np.array([1.0, 0.0])
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    for _ in range(30):
        p = sigmoid(x @ w)
        hessian = (x * (p * (1 - p) * many)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ ((p - target) * many) + 1e-6 * w)
        w -= step / max(1.0, float(np.abs(step).max()))
    return float(w[0]), float(w[1])


def counted_rows(found: DataFrame) -> DataFrame:
    """(label, fold, bins, many): how many candidates of `training_rows` have these bins; the fold goes by the candidate's hash."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32).reshape(-1, FEATURES)
            folds = [name[0] % _FOLDS for name in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(folds, pa.int32()), pa.array([b.tobytes() for b in binned(rows, _EDGES)], pa.binary())],
                ["label", "fold", "bins"],
            )

    rows = found.select("label", "name", "row").mapInArrow(bins, "label boolean, fold int, bins binary")
    return rows.groupBy("label", "fold", "bins").agg(F.count("*").alias("many"))


def _held(counted: DataFrame, models: list[Trees]) -> pa.Table:
    """(kind, label, step, many): candidates by the margin, in parts of 1 / _STEP, that the trees of the other folds give them."""
    middles = np.hstack([_EDGES[:, :1] - 0.5 / 32, (_EDGES[:, 1:] + _EDGES[:, :-1]) / 2, _EDGES[:, -1:] + 1])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, FEATURES)
            rows, fold = middles[np.arange(FEATURES), bins], batch.column("fold").to_numpy()
            margins = np.zeros(len(rows))
            for f in range(_FOLDS):
                margins[fold == f] = models[f].margins(rows[fold == f])
            columns = [bins[:, :5].argmax(axis=1).astype(np.int32), np.round(margins * _STEP).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), batch.column("label"), pa.array(columns[1]), batch.column("many")], ["kind", "label", "step", "many"])

    held = counted.mapInArrow(steps, "kind int, label boolean, step int, many long")
    return held.groupBy("kind", "label", "step").agg(F.sum("many").alias("many")).orderBy("kind", "step", "label").toArrow()


def fit(docs: DataFrame, text: str = "text", per_class: int | None = None, precision: float = 0.95) -> Model:
    """Model from the candidates of all texts; only sums by bin and counts by score reach the driver."""
    counted = packed(stored(counted_rows(training_rows(docs, text, per_class)), "candidates"))
    models = boost_counted(counted, _EDGES, _FOLDS)
    held = _held(counted, models)
    kinds, many = held.column("kind").to_numpy(), held.column("many").to_numpy()
    labels, margins = held.column("label").to_numpy(zero_copy_only=False).astype(float), held.column("step").to_numpy() / _STEP
    slope, shift = _curve(margins, labels, many) if len(many) else (1.0, 0.0)
    chances = sigmoid(slope * margins + shift)
    thresholds = []
    for kind in range(5):
        mine = np.flatnonzero(kinds == kind)
        order = mine[np.argsort(-chances[mine], kind="stable")]
        falling, right, so_far = chances[order], np.cumsum(labels[order] * many[order]), np.cumsum(many[order])
        share = (right + 1) / (so_far + 2)
        last = np.append(falling[1:] < falling[:-1], True)[:len(falling)]  # Ties stand or fall together.
        fits = falling[(share >= precision) & last]
        thresholds.append(max(0.5, float(fits.min())) if len(fits) else 2.0)
    return Model(models[-1], slope, shift, tuple(thresholds))


def spans_of(text: str | None, model: Model) -> list[tuple[int, int, int, float, bool]]:
    """(start, kind, end, score, base) of all spans, by start and kind; base spans have score 1."""
    if not text:
        return []
    good, _ = base_matches(text)
    out = [(start, kind, end, 1.0, True) for start, kind, end in good]
    taken = _Touching(good)
    free = [c for c in candidates(text) if model.thresholds[c[1]] <= 1 and not taken.of(c[0], c[2])]
    if free:
        chances = model.chances(np.array([describe(text, *c) for c in free], np.float32))
        likely = [(c, p) for c, p in zip(free, chances.tolist(), strict=True) if p >= model.thresholds[c[1]]]
        used = bytearray(len(text)) if likely else b""
        for (start, kind, end), p in sorted(likely, key=lambda c: (-round(c[1], 1), c[0][0] - c[0][2], c[0])):
            if not used.count(1, start, end):
                used[start:end] = b"\x01" * (end - start)
                out.append((start, kind, end, p, False))
    return sorted(out)


def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) of every row: kind, start, end (code points, end exclusive), score, base."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                spans = [
                    [{"kind": KINDS[k], "start": s, "end": e, "score": p, "base": b} for s, k, e, p, b in spans_of(value, shared.value)]
                    for value in part.column("text").to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(spans, _SPAN_TYPE)], ["key", "spans"])

    return rows.mapInArrow(found, f"key {dict(rows.dtypes)['key']}, spans {SPANS}").withColumnRenamed("key", key)


def redacted(text: str, spans: list[tuple[int, int, int, float, bool]]) -> str:
    """Text with spans that touch replaced together by the kind of the first."""
    out, past, kind = [], 0, None
    for start, k, end, _, _ in spans:
        if kind is None or start >= past:
            out += [text[past:start], f"<{KINDS[k].upper()}>"]
        past, kind = max(past, end), k
    return "".join([*out, text[past:]])


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns, with the text's spans replaced by their kinds."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                texts = [None if v is None else redacted(v, spans_of(v, shared.value)) for v in part.column(place).to_pylist()]
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(changed, docs.schema)
