"""The registered queries of these operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from docspark import settings
from docspark.llm import bpe, exact, extraction, jaccard, lines, mixing, quality, ranking, rollups, spelling, substrings, urlfilter, winnowing
from docspark.llm.common import text_of, words_of
from docspark.plans.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = " ".join(sql.split())
        return function

    return register


@query(r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, source FROM documents),
    s AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                 CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM t),
    z AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
          FROM s GROUP BY source),
    w AS (SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) * 3 / 2 AS budget,
                 CAST(coalesce(sum(2 * source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before,
                 CAST(sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rest
          FROM z WINDOW r AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, source NULLS LAST)),
    l AS (SELECT *, max((budget - before) / rest) OVER () AS level FROM w),
    p AS (SELECT *, least(CAST(2 * source_size AS DOUBLE), weight * level) AS target FROM l),
    q AS (SELECT s.*, p.source_size, p.weight, p.target, p.budget,
                 CAST(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
          FROM s JOIN p ON s.source IS NOT DISTINCT FROM p.source),
    o AS (SELECT *, (upto + again * source_size) / CAST(weight AS DOUBLE) AS finish
          FROM q CROSS JOIN (SELECT unnest([0, 1]) AS again)),
    c AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, k, doc_id, size, again ROWS UNBOUNDED PRECEDING) <= budget AS inside
          FROM o)
    SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN inside THEN size ELSE 0 END) AS BIGINT) AS taken
    FROM c GROUP BY doc_id, size, source_size, target""")
def op2_mixing(spark, d):
    return mixing.mixed(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query(r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    n AS (SELECT doc_id, length(text) AS chars, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS norm FROM t)
    SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER g = 1 AS kept, sha256(norm) AS text_sha256
    FROM n WINDOW g AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)""")
def op9_exact_dedup(spark, d):
    groups = exact.equal_groups(table(spark, d, "documents"))
    return groups.select(F.col("_id").alias("doc_id"), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
                         F.col("_kept").alias("kept"), F.col("_digest").alias("text_sha256"))


_STOPS = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))


@query(rf"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    a AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
    w AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM a),
    g AS (SELECT doc_id, i, CASE WHEN lead(w, 4) OVER o IS NOT NULL
                 THEN [w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o] END AS g
          FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
    r AS (SELECT doc_id, i, (g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1)::INT AS twice FROM g),
    c AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS 4 PRECEDING) AS covered FROM r),
    n AS (SELECT doc_id, CAST(sum(covered) AS BIGINT) AS n_repeat_words FROM c GROUP BY doc_id),
    m AS (SELECT a.doc_id, CAST(len(words) AS BIGINT) AS n_words,
                 CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words,
                 CAST(len(list_filter(words, lambda x: trim(lower(x), '{quality.PUNCTUATION}') IN ({_STOPS}))) AS BIGINT) AS n_stop_words
          FROM a LEFT JOIN n USING (doc_id)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT coalesce(word_chars / nullif(n_words, 0) < 2.0 OR word_chars / nullif(n_words, 0) > 12.0, false)
           AND NOT coalesce(n_symbols / nullif(n_words, 0) > 0.1, false)
           AND NOT coalesce(n_words >= 50 AND n_stop_words / nullif(n_words, 0) < 0.01, false)
           AND NOT coalesce(n_dup_lines / nullif(n_lines, 0) > 0.5, false) AS kept
    FROM b""")
def op10_quality_rules(spark, d):
    return quality.judged(table(spark, d, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query()
def op8_bpe(spark, d, path: str | None = None):
    out = bpe.coded(table(spark, d, "documents"), path or bpe.default_path())
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query()
def op7_jaccard_join(spark, d):
    out = jaccard.similar(table(spark, d, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query()
def pipeline(spark, d):
    return corpus_pipeline.run(spark, d)


@query()
def op4_suffix_dedup(spark, d):
    out = substrings.without_repeats(table(spark, d, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op1_html_extraction(spark, d):
    out = extraction.extracted(table(spark, d, "pages"))
    return out.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def _listed(pages):
    """Captures on days of one year, and list entries on hosts, domains and folders of the pages."""
    host = extraction.host_of(F.col("url"))
    captures = pages.select(F.col("page_id").alias("id"), "url", F.expr("date_add(DATE'2024-01-01', CAST(page_id % 366 AS INT))").alias("at"))
    folder = F.concat(host, F.lit("/"), F.regexp_extract("url", r"^[^:]*://[^/]*/([^/?#]*)", 1))
    keys = pages.select(F.explode(F.array(host, F.regexp_replace(host, r"^[^.]*\.", ""), folder)).alias("key")).distinct()
    day = F.conv(F.substring(F.md5("key"), 1, 4), 16, 10).cast("int")
    steps = [("add", day % 200), ("remove", day % 200 + 30 + day % 70), ("add", day % 200 + 250)]
    entries = keys.where(F.conv(F.substring(F.md5("key"), 5, 1), 16, 10).cast("int") < 8).select("key", F.explode(F.array(*[
        F.struct(F.lit(a).alias("action"), F.date_add(F.lit("2024-01-01").cast("date"), n).alias("at")) for a, n in steps
    ])).alias("_e")).select("key", "_e.action", "_e.at")
    return captures, entries


@query(r"""
    WITH p AS (SELECT page_id AS id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INT) AS day,
                      regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS host FROM pages),
    k AS (SELECT DISTINCT unnest([host, regexp_replace(host, '^[^.]*\.', ''),
                 host || '/' || regexp_extract(url, '^[^:]*://[^/]*/([^/?#]*)', 1)]) AS key FROM p),
    h AS (SELECT key, CAST('0x' || md5(key)[1:4] AS INT) AS d FROM k WHERE CAST('0x' || md5(key)[5:5] AS INT) < 8),
    l AS (SELECT key, DATE '2024-01-01' + CAST(d % 200 AS INT) AS since,
                 DATE '2024-01-01' + CAST(d % 200 + 30 + d % 70 AS INT) AS until FROM h
          UNION ALL SELECT key, DATE '2024-01-01' + CAST(d % 200 + 250 AS INT), NULL FROM h),
    b AS (SELECT *, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?', ''), '[?#].*$', '') AS bare FROM p),
    s AS (SELECT *, string_split(host, '.') AS labels, list_filter(string_split(regexp_replace(bare, '^[^/]*', ''), '/'), lambda x: x <> '') AS parts FROM b),
    q AS (SELECT id, url, day, unnest(list_concat(
                 list_transform(range(1, len(labels) + 1), lambda i: array_to_string(list_slice(labels, i, len(labels)), '.')),
                 list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(list_slice(parts, 1, i), '/')))) AS key FROM s),
    m AS (SELECT q.id, q.url, q.day, first(q.key ORDER BY length(q.key) DESC, q.key) AS rule FROM q JOIN l
          ON q.key = l.key AND q.day >= l.since AND (l.until IS NULL OR q.day < l.until) GROUP BY ALL)
    SELECT p.id AS page_id, p.url, count(*) AS copies, m.rule IS NOT NULL AS blocked, m.rule
    FROM p LEFT JOIN m ON p.id IS NOT DISTINCT FROM m.id AND p.url = m.url AND p.day = m.day GROUP BY p.id, p.url, m.rule""")
def op3_url_filters(spark, d):
    out = urlfilter.judged(*_listed(table(spark, d, "pages")))
    return out.select(F.col("id").alias("page_id"), "url", "copies", "blocked", "rule")


@query(r"""
    WITH t AS (SELECT doc_id, source, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                      len(regexp_extract_all(coalesce(text, ''), '\pL+|\pN|[^\s\pL\pN]')) AS p FROM documents),
    c AS (SELECT doc_id, source, lang, 'pieces-1' AS version, p AS n FROM t
          UNION ALL SELECT doc_id, source, lang, 'words-1', CASE WHEN doc_id % 10 = 3 THEN len(list_distinct(w)) ELSE len(w) END FROM t)
    SELECT source, lang, version, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
    FROM c WHERE NOT coalesce(doc_id % 10 = 7, false) GROUP BY source, lang, version""")
def op5_token_counts(spark, d):
    docs = table(spark, d, "documents")
    words = words_of(text_of("text"))
    counters = {"words-1": F.size(words), "pieces-1": F.regexp_count(text_of("text"), F.lit(r"\pL+|\pN|[^\s\pL\pN]"))}
    rollup = rollups.Rollup(spark, settings.shared_dir(spark))
    gone, corrected = docs.where("doc_id % 10 = 7"), docs.where("doc_id % 10 = 3")
    rollup.commit(0, rollups.changes(docs, counters))
    for _ in range(2):  # the second time changes nothing
        rollup.commit(1, rollups.changes(gone, counters, -1))
        rollup.commit(2, rollups.revisions(corrected, "words-1", F.size(words), F.size(F.array_distinct(words))))
    return rollup.totals()


@query()
def op6_line_dedup(spark, d):
    out = lines.without_repeats(table(spark, d, "documents"), width=1)
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op13_fingerprints(spark, d):
    pairs = winnowing.with_next(table(spark, d, "documents")).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    pairs = pairs.withColumn("_kept", F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut))
    pairs = pairs.withColumn("_edited", F.concat("_kept", F.substring("next_text", F.lit(1), cut)))
    pairs = pairs.withColumn("_marks", winnowing.continued(F.col("marks"), F.col("_edited"), F.octet_length("_kept")))
    return pairs.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        winnowing.written(F.col("marks")).alias("fingerprint"), winnowing.written(F.col("_marks")).alias("edited_fingerprint"),
        winnowing.likeness(F.col("marks"), F.col("_marks")).alias("near_edited"),
        winnowing.likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))


@query(r"""
    WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
                        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
    t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                 unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    r AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k FROM t GROUP BY ALL),
    b AS (SELECT run, k, flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)]
                 ELSE [192 | (ord(c) >> 6), 128 | (ord(c) & 63)] END)) AS bytes FROM r),
    h AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes::BIGINT[]), lambda c, x:
                 xor(c >> 8, steps[CAST((xor(c, x) & 255) + 1 AS BIGINT)]::BIGINT)), 4294967295) AS h FROM b, crc),
    w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
                 CAST(sum(k) AS BIGINT) AS n FROM h GROUP BY 1 HAVING length(word) >= 6 AND sum(k) >= 5),
    p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
    d AS (SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM p),
    e AS (SELECT DISTINCT d.word AS longer, d.n AS longer_n, w.word AS shorter, w.n AS shorter_n FROM d JOIN w ON w.word = head || tail),
    a AS (SELECT x.word, y.word AS near, y.n AS near_n FROM d x JOIN d y ON x.i = y.i AND x.head = y.head AND x.tail = y.tail AND x.word <> y.word
          UNION ALL SELECT longer, shorter, shorter_n FROM e UNION ALL SELECT shorter, longer, longer_n FROM e),
    g AS (SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS best FROM a GROUP BY word),
    f AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * n THEN best.near END AS form,
                 CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n FROM w LEFT JOIN g ON g.word = w.word),
    z AS (SELECT f.word, coalesce(f6.word, f5.word, f4.word, f3.word, f2.word, f1.word, f.word) AS root FROM f
          LEFT JOIN f f1 ON f1.word = f.form LEFT JOIN f f2 ON f2.word = f1.form LEFT JOIN f f3 ON f3.word = f2.form
          LEFT JOIN f f4 ON f4.word = f3.form LEFT JOIN f f5 ON f5.word = f4.form LEFT JOIN f f6 ON f6.word = f5.form)
    SELECT f.word, form, root, n, n_near, form_n FROM f JOIN z r ON r.word = f.word""")
def op11_spelling_variants(spark, d):
    runs = spelling.runs(table(spark, d, "documents"))
    mark = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    at = F.col("_mark") % F.length("run")
    cut = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", at.cast("int") + 2, F.length("run")))
    words = runs.withColumn("_mark", mark).select(F.when(F.col("_mark") % 199 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling.forms(spelling.counted(words)).select("word", "form", "root", "n", "n_near", "form_n")


_TERMS = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"


@query(rf"""
    WITH t AS (SELECT doc_id, {_TERMS} FROM documents),
    c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
    n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY doc_id),
    s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
    m AS (SELECT doc_id, 100 - 50 + ((50 * n * docs) // total) AS m FROM n, s),
    i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} FROM benchmark)),
    w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
          FROM c, s GROUP BY term),
    r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
          FROM i JOIN w USING (term) JOIN c USING (term) JOIN m USING (doc_id) GROUP BY ALL),
    k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
          FROM r WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50""")
def op12_ranked_search(spark, d):
    return ranking.search(table(spark, d, "documents"), table(spark, d, "benchmark"))
