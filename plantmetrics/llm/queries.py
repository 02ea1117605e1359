"""Registered queries of the subpackage, with the DuckDB text where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantmetrics.llm import chat_format, decontaminate, html_density, jaccard_groups, mixing, permuterm, pii, quality_knn, quality_rules, recurrent_lm, url_markov, warc, whitening
from plantmetrics.session import scratch_path
from plantmetrics.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return add


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
QUALITY_RULES_SQL = rf"""
    WITH split AS (
        SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    numbered AS (SELECT row_number() OVER () AS r, * FROM split),
    windows AS (
        SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM numbered WHERE len(w) >= 3)),
    twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
    covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
    measured AS (
        SELECT doc_id, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
        FROM numbered LEFT JOIN covered USING (r)),
    based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * n_lines
                OR 10 * len(regexp_extract_all(t, '!')) > 3 * n_words
                OR 2 * len(regexp_extract_all(t, '\p{{Lu}}')) > len(regexp_extract_all(t, '\p{{L}}'))
                OR word_chars NOT BETWEEN 2 * n_words AND 15 * n_words) AS kept
    FROM based"""


@query("op6_quality_rules", QUALITY_RULES_SQL)
def op6_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, root, "documents"))


WARC_SQL = """
    WITH hashed AS (
        SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
               sha256(coalesce(html, '')) AS payload_digest
        FROM pages),
    firsts AS (
        SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS f
        FROM hashed)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN f <> page_id THEN f END AS refers_to
    FROM firsts"""


@query("op5_warc", WARC_SQL)
def op5_warc(spark: SparkSession, root: str) -> DataFrame:
    records = warc.round_trip(read_table(spark, root, "pages"), scratch_path(spark, "warc"))
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


_CONTROLS = r"<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"
CHAT_SQL = rf"""
    WITH every AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    walked AS (
        SELECT *, row_number() OVER o AS place, count(*) OVER (PARTITION BY conv_id) AS many,
               coalesce(lag(role) OVER o, '') || '>' || role IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS accepted
        FROM every WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    joined AS (
        SELECT conv_id, count(*) AS n_turns, min(place) FILTER (WHERE NOT accepted) AS refused_at,
               bool_or(place = many AND role = 'assistant') AS ended,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
               sum(24 + length(role) + length(text) + length(text) - length(replace(text, chr(92), ''))
                   + len(regexp_extract_all(text, '{_CONTROLS}'))) AS chars
        FROM walked GROUP BY conv_id)
    SELECT conv_id, n_turns, refused_at IS NULL AND ended AS valid, refused_at, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
           sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
    FROM joined"""


@query("op7_chat_formatting", CHAT_SQL)
def op7_chat_formatting(spark: SparkSession, root: str) -> DataFrame:
    ok = F.lit("</s>[INST] ok [/INST]").alias("text")
    turn = F.col("id").alias("turn")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn, role, ok)
    talks = read_table(spark, root, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    formatted = chat_format.format_conversations(talks)
    read = formatted.select(
        "conv_id", "valid", "refused_at", chat_format.training_text(F.col("segments")).alias("string"), chat_format.loss_text(F.col("segments")).alias("loss")
    ).withColumn("turns", chat_format.parse(F.col("string")))
    end = F.lit("\n")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], end, t["text"], end)), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("string").cast("long").alias("formatted_chars"), "valid", "refused_at",
    )


URL_SQL = r"""
    WITH cut AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
               coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS whole
        FROM pages),
    fitted AS (
        SELECT *, CASE WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
                       WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
                       WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
                       WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
                       WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule,
               '^^^' || regexp_replace(whole, '[^a-z0-9./_~%:$^?#&=+-]', '*', 'g') || '$' AS signs
        FROM cut),
    ruled AS (SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS label
              FROM fitted),
    urls AS (SELECT signs, count(*) FILTER (WHERE label = 'allow') AS yes, count(*) FILTER (WHERE label = 'block') AS no,
                    substr(md5(signs), 1, 1) BETWEEN '0' AND '3' AS held FROM ruled GROUP BY signs),
    places AS (SELECT *, unnest(range(1, length(signs) - 2)) AS i FROM urls),
    grams AS (SELECT signs, substr(signs, i, 4) AS g, CASE WHEN held THEN 0 ELSE yes END AS yes,
                     CASE WHEN held THEN 0 ELSE no END AS no FROM places),
    c4 AS (SELECT g, sum(yes) AS y4, sum(no) AS n4 FROM grams GROUP BY g),
    c3 AS (SELECT substr(g, 2) AS g, sum(y4) AS y3, sum(n4) AS n3 FROM c4 GROUP BY 1),
    c2 AS (SELECT substr(g, 2) AS g, sum(y3) AS y2, sum(n3) AS n2 FROM c3 GROUP BY 1),
    c1 AS (SELECT substr(g, 2) AS g, sum(y2) AS y1, sum(n2) AS n1 FROM c2 GROUP BY 1),
    t4 AS (SELECT substr(g, 1, 3) AS g, sum(y4) AS ty4, sum(n4) AS tn4 FROM c4 GROUP BY 1),
    t3 AS (SELECT substr(g, 1, 2) AS g, sum(y3) AS ty3, sum(n3) AS tn3 FROM c3 GROUP BY 1),
    t2 AS (SELECT substr(g, 1, 1) AS g, sum(y2) AS ty2, sum(n2) AS tn2 FROM c2 GROUP BY 1),
    t1 AS (SELECT sum(y1) AS ty1, sum(n1) AS tn1 FROM c1),
    parts AS (
        SELECT c4.g, y4, n4, y3, n3, y2, n2, y1, n1, ty4, tn4, ty3, tn3, ty2, tn2, ty1, tn1
        FROM c4 JOIN c3 ON c3.g = substr(c4.g, 2) JOIN c2 ON c2.g = substr(c4.g, 3) JOIN c1 ON c1.g = substr(c4.g, 4)
        JOIN t4 ON t4.g = substr(c4.g, 1, 3) JOIN t3 ON t3.g = substr(c4.g, 2, 2) JOIN t2 ON t2.g = substr(c4.g, 3, 1), t1),
    logs AS (
        SELECT g, CAST(round((
            ln((y4 + (y3 + (y2 + (y1 + CAST(1 AS DOUBLE) / 52) / (ty1 + 1)) / (ty2 + 1)) / (ty3 + 1)) / (ty4 + 1))
            - ln((n4 + (n3 + (n2 + (n1 + CAST(1 AS DOUBLE) / 52) / (tn1 + 1)) / (tn2 + 1)) / (tn3 + 1)) / (tn4 + 1))) * 1000000) AS BIGINT) AS micro
        FROM parts),
    means AS (SELECT signs, least(greatest(floor(CAST(sum(micro) AS DOUBLE) / count(*) / 1000), -5000), 5000) AS bin
              FROM grams JOIN logs USING (g) GROUP BY signs),
    bins AS (SELECT bin, sum(yes) AS yes, sum(no) AS no FROM urls JOIN means USING (signs) WHERE held AND yes + no > 0 GROUP BY bin),
    rated AS (SELECT CAST(ceil((bin + coalesce(lead(bin) OVER (ORDER BY bin DESC), bin)) / 2) AS BIGINT) AS edge, sum(yes) OVER (ORDER BY bin DESC) / nullif(CAST(sum(yes) OVER () AS DOUBLE), 0)
                          - sum(no) OVER (ORDER BY bin DESC) / nullif(CAST(sum(no) OVER () AS DOUBLE), 0) AS gain FROM bins),
    best AS (SELECT coalesce((SELECT edge FROM rated WHERE gain IS NOT NULL ORDER BY round(gain, 9) DESC, abs(edge), edge DESC LIMIT 1), 0) AS edge)
    SELECT page_id, host, path, rule, coalesce(label, CASE WHEN bin >= edge THEN 'allow' ELSE 'block' END) AS verdict,
           CAST(bin AS BIGINT) AS score_bin
    FROM ruled JOIN means USING (signs), best"""


@query("op2_url_filters", URL_SQL)
def op2_url_filters(spark: SparkSession, root: str) -> DataFrame:
    return url_markov.judge_urls(read_table(spark, root, "pages"))


def held_out(key: str, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; a null key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % parts == part, F.lit(False))


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    labels = read_table(spark, root, "labels").filter(~held_out("doc_id", 3, 1))
    scores = quality_knn.score(docs, quality_knn.fit(docs, labels))
    return scores.select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op8_html_extraction")
def op8_html_extraction(spark: SparkSession, root: str) -> DataFrame:
    texts = html_density.extract(read_table(spark, root, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark: SparkSession, root: str) -> DataFrame:
    return decontaminate.matches(read_table(spark, root, "documents"), read_table(spark, root, "benchmark"))


def mixing_sql(documents: str) -> str:
    """Rows (doc_id, domain, lang, source, epoch) of the production mix of a table."""
    plan = mixing.Mix()

    def case(values, column: str, default: str) -> str:
        return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items()) + f" ELSE {default} END"

    def share(depth: int, weights: str, parent: str) -> str:
        names = ["d", "l", "s"][:depth]
        above = ", ".join(names[:-1])
        part = f"PARTITION BY {above}" if above else ""
        return f"""
        n{depth} AS (
            SELECT {", ".join("a." + n for n in names)}, sum(capacity) AS capacity, any_value({"total" if depth == 1 else "p.given"}) AS budget, any_value({weights}) AS w
            FROM leaves a {"CROSS JOIN total" if depth == 1 else f"JOIN {parent} p USING ({above})"} GROUP BY {", ".join("a." + n for n in names)}),
        v{depth} AS (
            SELECT *, (budget - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM n{depth} WHERE w > 0 WINDOW o AS ({part} ORDER BY capacity / w, {names[-1]})),
        g{depth} AS (SELECT {", ".join(names)}, least(capacity, w * max(level) OVER ({part})) AS given FROM v{depth})"""

    return f"""
    WITH light AS (
        SELECT doc_id, lang, source, {case(plan.domains, "coalesce(source, '')", "'other'")} AS d, coalesce(lang, 'null') AS l,
               coalesce(source, 'null') AS s, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n
        FROM {documents}),
        leaves AS (SELECT d, l, s, sum(n) AS tokens, CAST(sum(n) AS DOUBLE) * {plan.max_epochs} AS capacity FROM light GROUP BY d, l, s),
        total AS (SELECT CAST(coalesce(sum(tokens), 0) AS DOUBLE) * {plan.budget_share} AS total FROM leaves),
        {share(1, "CAST(" + case(plan.domain_weights, "a.d", "1.0") + " AS DOUBLE)", "")},
        {share(2, "CAST(" + case(plan.lang_weights, "a.l", "1.0") + " AS DOUBLE)", "g1")},
        {share(3, "CAST(1 AS DOUBLE)", "g2")},
        spent AS (
            SELECT d, l, s, tokens, CAST(floor(given + 1e-6) AS BIGINT) AS budget,
                   CASE WHEN tokens > 0 THEN CAST(floor(given + 1e-6) AS BIGINT) // CAST(tokens AS BIGINT) ELSE 0 END AS epochs
            FROM leaves JOIN g3 USING (d, l, s)),
        placed AS (
            SELECT light.*, epochs, budget - epochs * tokens AS rest,
                   md5('{plan.seed}:' || (epochs + 1) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS place
            FROM light JOIN spent USING (d, l, s)),
        summed AS (SELECT *, sum(n) OVER (PARTITION BY d, l, s ORDER BY place) AS through FROM placed),
        timed AS (SELECT *, epochs + CASE WHEN through <= rest THEN 1 ELSE 0 END AS times FROM summed)
    SELECT doc_id, d AS domain, lang, source, CAST(unnest(range(1, times + 1)) AS INTEGER) AS epoch FROM timed"""


@query("op3_source_mixing", mixing_sql("documents"))
def op3_source_mixing(spark: SparkSession, root: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, root, "documents").select("doc_id", "text", "lang", "source"))
    return mixed.select("doc_id", F.col("mix_domain").alias("domain"), "lang", "source", F.col("mix_epoch").alias("epoch"))


JACCARD_SQL = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
             FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
    reached AS (SELECT doc_id, doc_id AS c FROM w UNION SELECT y, c FROM reached JOIN links ON x = doc_id)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id
    FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


@query("op1_ngram_jaccard_join", JACCARD_SQL)
def op1_ngram_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    return jaccard_groups.classes(read_table(spark, root, "documents"))


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents").select("doc_id", "text")
    scores = recurrent_lm.fit_and_score(docs, ~held_out("doc_id", 7, 2))
    return scores.select(
        "doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


_RUNS = "regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')"
SPELLING_SQL = rf"""
    WITH RECURSIVE places AS (
        SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
                   CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
    runs AS (
        SELECT translate(run, '{permuterm.UPPER}', '{permuterm.LOWER}') AS run, coalesce(CAST(doc_id AS VARCHAR), 'null') AS name, count(*) AS times
        FROM (SELECT doc_id, unnest({_RUNS}) AS run FROM documents) GROUP BY ALL),
    bytes AS (
        SELECT run, times, list_transform(range(1, length(b), 2), lambda i: CAST('0x' || substr(b, i, 2) AS BIGINT)) AS b
        FROM (SELECT *, hex(encode(name || ':' || run)) AS b FROM runs)),
    hashed AS (
        SELECT run, times, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda c, x:
                   xor(c >> 8, t[xor(c, x) % 256 + 1]))) AS h
        FROM bytes, places),
    damaged AS (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times
        FROM hashed),
    words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
    edits AS (SELECT word, substr(word, 1, i) AS u, substr(word, i + 2) AS v
              FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS other FROM edits a JOIN edits b ON a.u = b.u AND a.v = b.v AND a.word <> b.word
        UNION SELECT e.word, w.word FROM edits e JOIN words w ON w.word = e.u || e.v
        UNION SELECT w.word, e.word FROM edits e JOIN words w ON w.word = e.u || e.v),
    judged AS (
        SELECT near.word, count(*) AS n_near, arg_max(other, (o.n, -r)) AS best, max(o.n) AS best_n
        FROM near JOIN (SELECT word, n, row_number() OVER (ORDER BY word) AS r FROM words) o ON o.word = other GROUP BY near.word),
    formed AS (
        SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
               CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
        FROM words LEFT JOIN judged USING (word)),
    followed AS (
        SELECT word, form AS reached, 1 AS step FROM formed WHERE form IS NOT NULL
        UNION ALL SELECT f.word, g.form, step + 1 FROM followed f JOIN formed g ON g.word = f.reached WHERE g.form IS NOT NULL),
    ends AS (SELECT word, arg_max(reached, step) AS root FROM followed GROUP BY word)
    SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN ends USING (word)"""


@query("op11_spelling_variants", SPELLING_SQL)
def op11_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    return permuterm.spelling_groups(read_table(spark, root, "documents"))


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, root: str) -> DataFrame:
    return whitening.whiten(read_table(spark, root, "embeddings"))


@query("op12_pii")
def op12_pii(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    found = pii.find(docs, pii.fit(docs))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.array_remove(kinds, kind)) for kind in pii.KINDS[:4]]
    counts = [(F.size(kinds) - others).cast("long").alias(f"n_{kind}") for kind, others in zip(pii.KINDS, counts)]
    return found.select(
        "doc_id", *counts, F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", named), ",").alias("spans"),
    )
