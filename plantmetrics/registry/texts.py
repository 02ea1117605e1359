"""Text, document, retrieval and conversation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantmetrics.operators import embeddings, learned_text, logs, retrieval, search, text
from plantmetrics.plans import kpi
from plantmetrics.registry.base import DERIVED, Inputs, near, query, sql_near


def _hits_sql(column: str, words) -> str:
    return " + ".join(f"CASE WHEN contains({column}, '{w}') THEN 1 ELSE 0 END" for w in words)


def _label_sql(column: str, labels, default: str = "other") -> str:
    """Label with the most hits, the earlier one on a tie."""
    items = ", ".join(
        f"{{'hits': {_hits_sql(column, words)}, 'place': {-i}, 'name': '{name}'}}" for i, (name, words) in enumerate(labels.items())
    )
    top = f"list_max([{items}])"
    return f"CASE WHEN ({top}).hits > 0 THEN ({top}).name ELSE '{default}' END"


@query("x1_classify_notes", f"""
SELECT maintenance_id, {_label_sql('work_description', text.FAILURE_KEYWORDS)} AS predicted FROM maintenance_clean""", ["maintenance_clean"])
def classify_notes(t: Inputs):
    notes = text.classify_text(t.view("maintenance_clean"), "work_description", text.FAILURE_KEYWORDS)
    return notes.select("maintenance_id", "predicted")


@query("x1_note_accuracy", f"""
SELECT count(*) AS n, avg(CASE WHEN {_label_sql('work_description', text.FAILURE_KEYWORDS)} = failure_category THEN 1.0 ELSE 0.0 END) AS accuracy
FROM maintenance_clean""", ["maintenance_clean"])
def note_accuracy(t: Inputs):
    notes = text.classify_text(t.view("maintenance_clean"), "work_description", text.FAILURE_KEYWORDS)
    return text.label_accuracy(notes, "predicted", "failure_category")


_HELD = "substr(md5(CAST(maintenance_id AS STRING)), 1, 1) < '4'"
DERIVED["learned_notes"] = (("maintenance_clean",), f"""
    WITH notes AS (SELECT *, {_HELD} AS held, regexp_extract_all(lower(work_description), '{learned_text.WORD}') AS words FROM maintenance_clean),
    seen AS (SELECT failure_category AS label, word, count(*) AS n FROM (SELECT failure_category, unnest(words) AS word FROM notes WHERE NOT held) GROUP BY 1, 2),
    classes AS (SELECT failure_category AS label, count(*) AS row_count, sum(len(words)) AS words FROM notes WHERE NOT held GROUP BY 1),
    sizes AS (SELECT count(DISTINCT word) AS known FROM seen),
    chances AS (
        SELECT c.label, v.word, CAST(round(ln((coalesce(n, 0) + 1) / (c.words + known)) * 1000000) AS BIGINT) AS micro
        FROM (SELECT DISTINCT word FROM seen) v CROSS JOIN classes c CROSS JOIN sizes LEFT JOIN seen s ON s.word = v.word AND s.label = c.label),
    priors AS (SELECT label, CAST(round(ln((row_count + 1) / (sum(row_count) OVER () + count(*) OVER ())) * 1000000) AS BIGINT) AS micro FROM classes),
    sums AS (SELECT maintenance_id, label, sum(micro) AS total FROM (
                 SELECT maintenance_id, label, micro FROM (SELECT maintenance_id, unnest(words) AS word FROM notes) w JOIN chances USING (word)
                 UNION ALL SELECT maintenance_id, label, micro FROM notes, priors) GROUP BY 1, 2)
    SELECT maintenance_id, arg_min(label, (-total, label)) AS predicted FROM sums GROUP BY 1""")


def _held(t: Inputs) -> DataFrame:
    return t.view("maintenance_clean").withColumn("held", F.expr(_HELD))


def _learned(notes: DataFrame) -> DataFrame:
    model = learned_text.learn_classes(notes.filter("NOT held"), "work_description", "failure_category")
    return learned_text.classify_learned(notes, "maintenance_id", "work_description", model)


@query("x1_learned_classes", "SELECT maintenance_id, predicted FROM learned_notes", ["learned_notes"])
def learned_classes(t: Inputs):
    """Every note by a model of three quarters of them."""
    return _learned(_held(t))


@query("x1_learned_accuracy", f"""
SELECT count(*) AS n, {sql_near("avg(CASE WHEN l.predicted = failure_category THEN 1.0 ELSE 0.0 END)")} AS learned,
       {sql_near(f"avg(CASE WHEN {_label_sql('work_description', text.FAILURE_KEYWORDS)} = failure_category THEN 1.0 ELSE 0.0 END)")} AS word_lists
FROM maintenance_clean m JOIN learned_notes l ON l.maintenance_id = m.maintenance_id WHERE substr(md5(CAST(m.maintenance_id AS STRING)), 1, 1) < '4'""",
       ["maintenance_clean", "learned_notes"])
def learned_accuracy(t: Inputs):
    """On the quarter that the model has not seen, next to the word lists."""
    notes = _held(t)
    judged = text.classify_text(notes.filter("held"), "work_description", text.FAILURE_KEYWORDS, "word_lists")
    judged = judged.join(_learned(notes), "maintenance_id")
    share = lambda c: near(F.avg((F.col(c) == F.col("failure_category")).cast("double")))
    return judged.agg(F.count("*").alias("n"), share("predicted").alias("learned"), share("word_lists").alias("word_lists"))


DERIVED["defects"] = (("quality_inspections",), f"""
    SELECT inspection_id, equipment_id, severity, defect_type,
           {_label_sql("concat('defect: ', defect_type, ', severity: ', severity)", text.DEFECT_KEYWORDS)} AS defect_category
    FROM quality_inspections WHERE NOT passed""")


def _defects(t: Inputs) -> DataFrame:
    failed = t.view("quality_inspections").filter("NOT passed").withColumn(
        "description", F.concat(F.lit("defect: "), F.col("defect_type"), F.lit(", severity: "), F.col("severity"))
    )
    return text.classify_text(failed, "description", text.DEFECT_KEYWORDS, "defect_category")


@query("x1_classify_defects", "SELECT inspection_id, equipment_id, severity, defect_category FROM defects", ["defects"])
def classify_defects(t: Inputs):
    return _defects(t).select("inspection_id", "equipment_id", "severity", "defect_category")


@query("x1_risk_levels", """
SELECT equipment_id, anomaly_count, CASE WHEN anomaly_count >= 3 THEN 'HIGH_RISK' WHEN anomaly_count >= 2 THEN 'MEDIUM_RISK'
       ELSE 'LOW_RISK' END AS risk_level
FROM (SELECT equipment_id, count(*) AS anomaly_count FROM sensor_clean WHERE is_anomaly GROUP BY equipment_id)""", ["sensor_clean"])
def risk_levels(t: Inputs):
    from plantmetrics.operators.anomaly import anomaly_summary

    levels = text.risk_levels(anomaly_summary(t.clean(), 1), 3, 2)
    return levels.select("equipment_id", "anomaly_count", "risk_level")


@query("x2_pareto", """
SELECT defect_category, count(*) AS row_count, round(CAST(count(*) * 100 AS DOUBLE) / sum(count(*)) OVER (), 1) AS pct,
       CAST(sum(count(*)) OVER (ORDER BY count(*) DESC) AS BIGINT) AS cumulative FROM defects GROUP BY 1""", ["defects"])
def pareto(t: Inputs):
    return text.pareto(_defects(t), "defect_category")


@query("x2_pareto_by_type", """
SELECT equipment_type, failure_category, count(*) AS row_count,
       round(CAST(count(*) * 100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY equipment_type), 1) AS pct
FROM maintenance_clean GROUP BY 1, 2""", ["maintenance_clean"])
def pareto_by_type(t: Inputs):
    return text.pareto(t.view("maintenance_clean"), "failure_category", "equipment_type")


@query("x3_extract_fields", """
SELECT maintenance_id, equipment_id, nullif(regexp_extract(work_description, 'part: ([^,]+)', 1), '') AS replaced_part,
       nullif(regexp_extract(work_description, 'minutes: ([0-9]+)', 1), '') AS work_minutes
FROM maintenance_clean WHERE work_description LIKE '%replaced%' AND regexp_extract(work_description, 'part: ([^,]+)', 1) <> ''""",
       ["maintenance_clean"])
def extract_fields(t: Inputs):
    noted = t.view("maintenance_clean").filter(F.col("work_description").like("%replaced%"))
    found = text.extract_fields(noted, "work_description").filter("info.replaced_part IS NOT NULL")
    return found.select("maintenance_id", "equipment_id", "info.replaced_part", "info.work_minutes")


@query("x3_learned_fields", """
SELECT maintenance_id, regexp_extract(work_description, 'part: ([^,]+)', 1) AS replaced_part, regexp_extract(work_description, 'minutes: ([0-9]+)', 1) AS work_minutes,
       regexp_extract(work_description, 'technician: ([A-Za-z0-9_]+)', 1) AS technician
FROM maintenance_clean""", ["maintenance_clean"])
def learned_fields(t: Inputs):
    """Fields of every note by contexts learnt from the quarter whose values are marked."""
    notes = _held(t)
    marked = text.extract_fields(notes.filter("held"), "work_description")
    found = notes.select("maintenance_id")
    for name in text.NOTE_FIELDS:
        contexts = learned_text.learn_contexts(marked.withColumn("value", F.col(f"info.{name}")), "maintenance_id", "work_description", "value")
        found = found.join(learned_text.extract_learned(notes, "maintenance_id", "work_description", contexts, name), "maintenance_id")
    return found


@query("x4_prompts", """
SELECT event_id, concat('Equipment ', equipment_id, ' shows an anomaly. Temperature: ', printf('%.1f', round(temperature_c, 1)),
       ' C, vibration: ', printf('%.2f', round(vibration_ms2, 2)), ' mm/s. Describe the state in one line.') AS prompt
FROM sensor_silver WHERE vibration_ms2 > 5""", ["sensor_silver"])
def prompts(t: Inputs):
    return text.anomaly_prompt(t.silver().filter("vibration_ms2 > 5")).select("event_id", "prompt")


@query("x6_parse_output", """
SELECT event_id, CASE WHEN event_type = 'error' THEN -1 ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END AS k,
       event_type = 'error' AS parse_failed FROM events""")
def parse_output(t: Inputs):
    answer = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("cannot say "), F.col("props")))
        .when(F.col("event_type") == "view", F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```")))
        .otherwise(F.col("props"))
    )
    answers = t.table("events").select("event_id", answer.alias("answer"))
    parsed = text.parse_output(answers, "answer", "k BIGINT", {"k": F.lit(-1).cast("long")})
    return parsed.select("event_id", F.col("parsed.k").alias("k"), "parse_failed")


_COS = "list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


@query("x7_pair_similarity", f"""
SELECT a.vec_id, {sql_near(_COS.format(a='a.embedding', b='b.embedding'))} AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def pair_similarity(t: Inputs):
    left = t.table("embeddings")
    right = left.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    pairs = text.pair_similarity(left.join(right, "vec_id"), "embedding", "next")
    return pairs.select("vec_id", near("similarity").alias("similarity"))


DERIVED["centroids"] = (("embeddings",), """
    SELECT label, list(v ORDER BY pos) AS center FROM (
        SELECT label, pos, avg(CAST(x AS DOUBLE)) AS v FROM (
            SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2)
    GROUP BY 1""")


def _centroids(t: Inputs) -> DataFrame:
    """Mean vector per label; summed map-side, one row per label and dimension."""
    cells = t.table("embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("v"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    return means.groupBy("label").agg(F.transform(ordered, lambda c: c["v"]).alias("center"))


@query("x8_best_match", f"""
SELECT vec_id, CASE WHEN s > 0 THEN CAST(label AS STRING) END AS matched, {sql_near('greatest(s, 0)')} AS similarity_score FROM (
    SELECT e.vec_id, c.label, {_COS.format(a='e.embedding', b='c.center')} AS s,
           row_number() OVER (PARTITION BY e.vec_id ORDER BY {_COS.format(a='e.embedding', b='c.center')} DESC, c.label) AS rn
    FROM embeddings e CROSS JOIN centroids c) WHERE rn = 1""", ["centroids"])
def best_match(t: Inputs):
    matched = text.best_match(t.table("embeddings"), "embedding", _centroids(t), "label", "center")
    return matched.select("vec_id", F.col("matched").cast("string").alias("matched"), near("similarity_score").alias("similarity_score"))


ONE_WORD = {name: words[:1] for name, words in text.FAILURE_KEYWORDS.items()}


@query("x9_variant_accuracy", f"""
SELECT 'v1' AS variant, {sql_near(f"avg(CASE WHEN {_label_sql('work_description', ONE_WORD)} = failure_category THEN 1.0 ELSE 0.0 END)")} AS accuracy
FROM maintenance_clean
UNION ALL
SELECT 'v2', {sql_near(f"avg(CASE WHEN {_label_sql('work_description', text.FAILURE_KEYWORDS)} = failure_category THEN 1.0 ELSE 0.0 END)")}
FROM maintenance_clean""", ["maintenance_clean"])
def variant_accuracy(t: Inputs):
    notes = text.classify_text(t.view("maintenance_clean"), "work_description", ONE_WORD, "v1")
    notes = text.classify_text(notes, "work_description", text.FAILURE_KEYWORDS, "v2")
    return text.variant_accuracy(notes, {"v1": "v1", "v2": "v2"}, "failure_category").withColumn("accuracy", near("accuracy"))


_MARKED = """CASE WHEN i = 1 THEN concat('# ', line) WHEN (i - 1) % 10 = 0 THEN concat('## ', line)
             WHEN (i - 1) % 10 = 5 THEN concat('*', line, '*') ELSE line END"""
DERIVED["chunks"] = (("documents",), f"""
    SELECT doc_id, lang, page_id, string_agg({_MARKED}, chr(10) ORDER BY i) AS content FROM (
        SELECT doc_id, lang, line, i, CAST((i - 1) // 20 AS BIGINT) AS page_id FROM (
            SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))
    WHERE length(line) > 0 GROUP BY 1, 2, 3""")
_TYPE = "CASE doc_id % 5 WHEN 0 THEN 'CNC' WHEN 1 THEN 'AOI' WHEN 2 THEN 'ROBOT' WHEN 3 THEN 'PRESS' ELSE 'CONVEYOR' END"
_DOC_TYPE = "CASE doc_id % 2 WHEN 0 THEN 'procedure' ELSE 'standard' END"
_CHUNK_ID = "md5(concat_ws('_', CAST(doc_id AS STRING), CAST(page_id AS STRING)))"


def _elements(t: Inputs) -> DataFrame:
    """Documents with their lines as layout elements in JSON, twenty to a page."""
    kind = lambda i: (
        F.when(i == 0, "title").when(i % 10 == 0, "section_header").when(i % 10 == 5, "caption").otherwise("text")
    )
    element = lambda line, i: F.struct(
        i.cast("long").alias("id"), kind(i).alias("type"), line.alias("content"), F.lit(1.0).alias("confidence"),
        F.array(F.struct(F.floor(i / 20).alias("page_id"))).alias("bbox"),
    )
    lines = F.split("text", "\n", -1)
    return t.table("documents").select("doc_id", "lang", F.to_json(F.transform(lines, element)).alias("elements"))


def _chunks(t: Inputs) -> DataFrame:
    return retrieval.page_chunks(_elements(t), "elements", ["doc_id", "lang"])


@query("r1_page_chunks", "SELECT doc_id, page_id, content FROM chunks", ["chunks"])
def page_chunks(t: Inputs):
    return _chunks(t).select("doc_id", "page_id", "content")


def _markdown_sql() -> str:
    out = "html"
    for pattern, replacement in (*retrieval.HTML_RULES,):
        out = f"regexp_replace({out}, '{pattern}', '{replacement}', 'g')"
    for entity, char in retrieval.HTML_ENTITIES:
        quoted = char.replace("'", "''")
        out = f"replace({out}, '{entity}', '{quoted}')"
    line = "\n"
    return f"trim(regexp_replace({out}, '{line}{{3,}}', '{line}{line}', 'g'), ' {line}')"


@query("r2_html_to_markdown", f"SELECT page_id, {_markdown_sql()} AS markdown FROM pages")
def html_to_markdown(t: Inputs):
    return retrieval.html_to_markdown(t.table("pages"), "html", only_with=None).select("page_id", F.col("html").alias("markdown"))


@query("r2_tables_only", f"SELECT page_id, CASE WHEN contains(html, '<table') THEN {_markdown_sql()} ELSE html END AS html FROM pages")
def tables_only(t: Inputs):
    return retrieval.html_to_markdown(t.table("pages"), "html").select("page_id", "html")


@query("r2_headings", """
SELECT page_id, nullif(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1), '') AS title,
       nullif(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '') AS heading FROM pages""")
def headings(t: Inputs):
    return retrieval.html_headings(t.table("pages"), "html").select("page_id", "title", "heading")


@query("r3_chunk_ids", f"SELECT doc_id, page_id, {_CHUNK_ID} AS chunk_id FROM chunks", ["chunks"])
def chunk_ids(t: Inputs):
    return retrieval.with_chunk_id(_chunks(t)).select("doc_id", "page_id", "chunk_id")


@query("r4_combine", "SELECT doc_id, page_id, content FROM chunks", ["chunks"])
def combine(t: Inputs):
    made = _chunks(t)
    by_lang = [made.filter(F.col("lang") == code) for code in ("en", "de", "fr", "es")]
    rest = made.filter(F.coalesce(~F.col("lang").isin("en", "de", "fr", "es"), F.lit(True)))
    return retrieval.combine_chunks([*by_lang, rest]).select("doc_id", "page_id", "content")


def _typed(chunks: DataFrame) -> DataFrame:
    return chunks.withColumns({"equipment_type": F.expr(_TYPE), "doc_type": F.expr(_DOC_TYPE)})


@query("r5_chunk_counts", f"""
SELECT {_TYPE} AS equipment_type, {_DOC_TYPE} AS doc_type, count(*) AS chunk_count FROM chunks GROUP BY 1, 2""", ["chunks"])
def chunk_counts(t: Inputs):
    return retrieval.chunk_counts(_typed(_chunks(t)), ["equipment_type", "doc_type"])


def _top_sql(condition: str) -> str:
    score = _COS.format(a="e.embedding", b="c.center")
    return f"""SELECT c.label AS query_id, e.vec_id AS corpus_id, {score} AS score,
           CAST(row_number() OVER (PARTITION BY c.label ORDER BY {score} DESC, e.vec_id) AS INTEGER) AS rank
    FROM centroids c JOIN embeddings e ON {condition} QUALIFY rank <= 3"""


DERIVED["hits"] = (("centroids",), _top_sql("TRUE"))
DERIVED["hits_in_label"] = (("centroids",), _top_sql("e.label = c.label"))


def _hits(t: Inputs, filters=()) -> DataFrame:
    """Top three vectors for the mean vector of each label."""
    asked = _centroids(t).withColumn("q", F.col("label"))
    return retrieval.topk_similar(
        t.table("embeddings"), asked, 3, filters, corpus_id="vec_id", query_id="q", query_vector="center"
    )


@query("r6_topk", f"SELECT query_id, corpus_id, rank, {sql_near('score')} AS score FROM hits", ["hits"])
def topk(t: Inputs):
    return _hits(t).withColumn("score", near("score"))


@query("r6_topk_filtered", f"SELECT query_id, corpus_id, rank, {sql_near('score')} AS score FROM hits_in_label", ["hits_in_label"])
def topk_filtered(t: Inputs):
    return _hits(t, ["label"]).withColumn("score", near("score"))


def _cells_sql(name: str, rows: str) -> str:
    """CTEs for (key, bucket, n) of the words of (key, text) rows; buckets as in `embeddings.with_cells`."""
    return f"""
    {name}_words AS (SELECT key, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+')) AS w FROM ({rows})),
    {name} AS (SELECT key, CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) % {embeddings.DIMS} AS bucket, count(*) AS n FROM {name}_words GROUP BY 1, 2)"""


def _weights_sql(cells: str, rows: str) -> str:
    return f"""
    weight AS (SELECT b AS bucket, CAST(length(bin((all_texts + 1) // (coalesce(texts, 0) + 1))) AS BIGINT) AS w
               FROM (SELECT unnest(range({embeddings.DIMS})) AS b), (SELECT count(*) AS all_texts FROM ({rows}))
               LEFT JOIN (SELECT bucket, count(*) AS texts FROM {cells} GROUP BY 1) ON bucket = b)"""


_CHUNK_ROWS = f"SELECT {_CHUNK_ID} AS key, content AS text FROM chunks"


@query("r6_text_search", f"""
WITH {_cells_sql('cells', _CHUNK_ROWS)}, {_cells_sql('asked', 'SELECT item_id AS key, text FROM benchmark')}, {_weights_sql('cells', _CHUNK_ROWS)},
c AS (SELECT key, bucket, n * w AS v FROM cells JOIN weight USING (bucket)), q AS (SELECT key, bucket, n * w AS v FROM asked JOIN weight USING (bucket)),
dots AS (SELECT q.key AS query_id, c.key AS corpus_id, sum(q.v * c.v) AS dot FROM q JOIN c USING (bucket) GROUP BY 1, 2),
scored AS (SELECT query_id, corpus_id, round(dot / (sqrt(CAST(a.s AS DOUBLE)) * sqrt(CAST(b.s AS DOUBLE))), 12) AS score FROM dots
           JOIN (SELECT key, sum(v * v) AS s FROM q GROUP BY 1) a ON a.key = query_id JOIN (SELECT key, sum(v * v) AS s FROM c GROUP BY 1) b ON b.key = corpus_id)
SELECT query_id, corpus_id, {sql_near('score')} AS score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS INTEGER) AS rank
FROM scored QUALIFY rank <= 3""", ["chunks"])
def text_search(t: Inputs):
    """Benchmark passages as questions against every document page, through cells of near vectors."""
    made = embeddings.sync_index(retrieval.with_chunk_id(_chunks(t)))
    asked = embeddings.with_vectors(embeddings.with_cells(t.table("benchmark"), "text").select("item_id", "cells"), embeddings.weights(made.counts))
    cells = search.build_index(made.rows, "chunk_id")
    return search.search(cells, asked, 3, query_id="item_id").withColumn("score", near("score"))


def _versions(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """(current chunks, indexed chunks): Spanish pages vanished, German ones changed, French ones are new."""
    made = retrieval.with_chunk_id(_chunks(t))
    older = F.when(F.col("lang") == "de", F.concat(F.col("content"), F.lit(" (old)"))).otherwise(F.col("content"))
    return made.filter("lang <> 'es'"), made.filter("lang <> 'fr'").withColumn("content", older)


@query("r7_changed_chunks", f"""
SELECT {_CHUNK_ID} AS chunk_id, CASE lang WHEN 'es' THEN 'vanished' WHEN 'de' THEN 'changed' ELSE 'new' END AS change
FROM chunks WHERE lang IN ('es', 'de', 'fr')""", ["chunks"])
def changed_chunks(t: Inputs):
    now, old = _versions(t)
    return retrieval.changed_chunks(now, old.select("chunk_id", F.md5("content").alias("content_hash")))


_NOW_ROWS = f"SELECT {_CHUNK_ID} AS key, content AS text FROM chunks WHERE lang <> 'es'"


@query("r7_sync", f"""
WITH {_cells_sql('cells', _NOW_ROWS)}, {_weights_sql('cells', _NOW_ROWS)},
v AS (SELECT key, bucket, n, n * w AS v FROM cells JOIN weight USING (bucket)),
texts AS (SELECT key, string_agg(concat(bucket, ':', n), ' ' ORDER BY bucket) AS cells, sum(v * v) AS square, sum(bucket * v) AS moment,
                 sum(v * v) FILTER (WHERE bucket < 64) AS part FROM v GROUP BY 1)
SELECT key AS chunk_id, md5(text) AS content_hash, coalesce(cells, '') AS cells,
       {sql_near('coalesce(moment / sqrt(CAST(square AS DOUBLE)), 0)', 5)} AS moment, {sql_near('coalesce(part / CAST(square AS DOUBLE), 0)', 5)} AS part
FROM ({_NOW_ROWS}) LEFT JOIN texts USING (key)""", ["chunks"])
def sync(t: Inputs):
    """Second sync of an index: Spanish pages gone, German ones changed, French ones new; vectors by two sums over their numbers."""
    now, old = _versions(t)
    made = embeddings.sync_index(now, embeddings.sync_index(old))
    add = lambda total, x: total + x
    moment = F.aggregate(F.transform("embedding", lambda x, i: x * i), F.lit(0.0), add)
    part = F.aggregate(F.transform(F.slice("embedding", 1, 64), lambda x: x * x), F.lit(0.0), add)
    cells = F.array_join(F.transform("cells", lambda c: F.concat_ws(":", c["bucket"].cast("string"), c["count"].cast("string"))), " ")
    return made.rows.select("chunk_id", "content_hash", cells.alias("cells"), near(moment, 5).alias("moment"), near(part, 5).alias("part"))


@query("r8_context", """
SELECT query_id, string_agg(concat('[doc_id: ', CAST(corpus_id AS STRING), ' | lang: ', coalesce(lang, 'N/A'), ' | source: ', coalesce(source, 'N/A'), ']', chr(10), text),
                            concat(chr(10), chr(10)) ORDER BY rank) AS context
FROM hits LEFT JOIN documents ON corpus_id = doc_id GROUP BY 1""", ["hits"])
def context(t: Inputs):
    return retrieval.assemble_context(_hits(t), t.table("documents"), "doc_id", ["doc_id", "lang", "source"], "text")


_STATE = """concat('Equipment ', equipment_id, ' / ', equipment_type, ': temperature ', printf('%.1f', temperature_c),
    ' C, vibration ', printf('%.2f', vibration_ms2), ' mm/s, pressure ', printf('%.1f', pressure_bar), ' bar, rpm ',
    printf('%.0f', rpm), ', state ', CASE WHEN is_anomaly THEN 'ANOMALY' ELSE 'normal' END)"""


@query("r9_hybrid_context", f"""
WITH newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY equipment_id ORDER BY event_time DESC, event_id DESC) AS rn
                               FROM sensor_clean WHERE is_anomaly) WHERE rn = 1),
texts AS (SELECT query_id, string_agg(concat('[doc_id: ', CAST(corpus_id AS STRING), ' | lang: ', coalesce(lang, 'N/A'), ']', chr(10), text),
                                      concat(chr(10), chr(10)) ORDER BY rank) AS context
          FROM hits LEFT JOIN documents ON corpus_id = doc_id GROUP BY 1),
asked AS (SELECT label AS query_id, concat('EQ', lpad(CAST(label + 1 AS STRING), 3, '0')) AS equipment_id FROM centroids)
SELECT asked.query_id, asked.equipment_id, coalesce({_STATE.replace("'Equipment ', equipment_id", "'Equipment ', newest.equipment_id")}, 'no sensor data') AS sensor_context,
       context AS manual_context
FROM asked LEFT JOIN texts ON asked.query_id = texts.query_id LEFT JOIN newest ON asked.equipment_id = newest.equipment_id""".replace(
    "coalesce(concat(", "coalesce(CASE WHEN newest.equipment_id IS NOT NULL THEN concat(").replace("END), 'no sensor", "END) END, 'no sensor"),
       ["hits", "sensor_clean", "centroids"])
def hybrid(t: Inputs):
    equipment = F.concat(F.lit("EQ"), F.lpad((F.col("label") + 1).cast("string"), 3, "0"))
    asked = _centroids(t).select(F.col("label").alias("query_id"), equipment.alias("equipment_id"))
    contexts = retrieval.assemble_context(_hits(t), t.table("documents"), "doc_id", ["doc_id", "lang"], "text")
    return retrieval.hybrid_context(asked, contexts, kpi.latest_reading(t.clean(), anomalies_only=True))


@query("t1_threads", """
SELECT conv_id, string_agg(concat(role, ': ', text), chr(10) ORDER BY turn) AS messages FROM conversations GROUP BY 1""")
def threads(t: Inputs):
    whole = logs.assemble_threads(t.table("conversations"))
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return whole.withColumn("messages", F.concat_ws("\n", lines))


@query("t1_session_keys", """
SELECT conv_id, arg_min(text, turn) AS session_key FROM conversations WHERE role = 'user' GROUP BY 1""")
def session_keys(t: Inputs):
    return logs.session_keys(t.table("conversations"))


@query("t2_last_answer", """
SELECT conv_id, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' AND length(text) > 0 GROUP BY 1""")
def last_answer(t: Inputs):
    return logs.last_answer(t.table("conversations"))


@query("t3_speakers", """
SELECT conv_id, string_agg(role, ' > ' ORDER BY first_turn) AS speakers
FROM (SELECT conv_id, role, min(turn) AS first_turn FROM conversations WHERE role <> 'system' GROUP BY 1, 2) GROUP BY 1""")
def speakers(t: Inputs):
    return logs.speakers(t.table("conversations"), "system").withColumn("speakers", F.concat_ws(" > ", "speakers"))


@query("t4_latest_errors", """
SELECT user_id, event_id, ts, CAST(rn AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'error')
WHERE rn <= 5""")
def latest_errors(t: Inputs):
    found = logs.latest_errors(t.table("events"), "user_id", F.col("event_type") == "error", "ts", tie=["event_id"])
    return found.select("user_id", "event_id", "ts", "rank")


@query("t4_latest_runs", """
SELECT user_id, event_id, state, CAST(rn AS INTEGER) AS rank FROM (
    SELECT *, CASE WHEN event_type = 'signup' THEN 'RUNNING' ELSE event_type END AS state,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= 5""")
def latest_runs(t: Inputs):
    runs = t.table("events").withColumn("state", F.when(F.col("event_type") != "signup", F.col("event_type")))
    found = logs.latest_runs(runs, "user_id", "ts", "state", tie=["event_id"])
    return found.select("user_id", "event_id", "state", "rank")
