"""The registered queries of this subpackage and, where SQL can express them, their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    language,
    licenses,
    line_quality,
    mixing,
    neighbours,
    simhash,
    substring_dedup,
    toxicity,
    url_filter,
    variants,
    whitening,
)

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # a hot key is split in a join even where that costs one more exchange
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(table(spark, folder, "documents")))


CHECKS["op1_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 49], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS p FROM w)
), least AS (
  SELECT s, min(doc_id) AS m FROM win GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM win JOIN least USING (s) WHERE m < doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), stay AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t
  FROM (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN removed USING (doc_id) LEFT JOIN stay USING (doc_id)
"""


@query
def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"), carry=["doc_id"])


@query
def op3_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.occurrences(docs, table(spark, folder, "benchmark")))


@query
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), carry=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


CHECKS["op5_source_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)
), level(n, l) AS (
  SELECT 0, sum(source_size) * 1.5::DOUBLE / sum(w) FROM s
  UNION ALL
  SELECT n + 1, (
    SELECT (sum(source_size) * 1.5::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) FILTER (w * l >= 2.0::DOUBLE * source_size), 0))
      / sum(w) FILTER (w * l < 2.0::DOUBLE * source_size) FROM s)
  FROM level WHERE n < (SELECT count(*) FROM s) AND l IS NOT NULL
), t AS (
  SELECT source, source_size, least(w * (SELECT max(l) FROM level), 2.0::DOUBLE * source_size) AS target,
    ('0x' || substr(md5('5:' || coalesce('=' || source, '')), 1, 8))::BIGINT / 4294967296::DOUBLE AS u FROM s
), r AS (
  SELECT d.*, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
    row_number() OVER (PARTITION BY d.source ORDER BY size DESC, doc_id) - 1 AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, ((floor((k + 1) * e + u) - floor(k * e + u))::BIGINT * size) AS taken FROM r
"""


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fit(docs.where(language.learnable()))
    predicted = language.predict(docs, model, carry=["doc_id"])
    return predicted.select("doc_id", (~language.learnable()).alias("held_out"), "lang_pred", "score")


@query
def op7_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.rotated(table(spark, folder, "conversations"))


CHECKS["op7_chat_perspectives"] = r"""
WITH t AS (
  SELECT conv_id, turn::BIGINT AS turn, CASE WHEN trim(role) <> '' THEN role END AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS content FROM conversations
), p AS (
  SELECT DISTINCT conv_id, speaker AS participant FROM t WHERE speaker <> 'system'
), b AS (
  SELECT t.*, participant,
    CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = participant THEN 'assistant' ELSE 'user' END AS as_role
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), n AS (
  SELECT *, CASE WHEN as_role = 'user' THEN coalesce(speaker, 'unknown') END AS name FROM b
), h AS (
  SELECT *, '<|im_start|>' || as_role || coalesce(' name=' || replace(name, '<|', '< |'), '') || chr(10) AS head FROM n
), g AS (
  SELECT *, head || content || '<|im_end|>' || chr(10) AS segment FROM h
), w AS (
  SELECT *, (sum(length(segment)) OVER (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST,
    speaker NULLS FIRST, content ROWS UNBOUNDED PRECEDING))::BIGINT AS stop FROM g
)
SELECT conv_id, participant, turn, as_role, name, segment, stop - length(segment) AS start,
  CASE WHEN as_role = 'assistant' THEN stop - length(segment) + length(head) END AS learn_from,
  CASE WHEN as_role = 'assistant' THEN stop - 1 END AS learn_to
FROM w
"""


@query
def op8_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    marked = simhash.near_duplicates(table(spark, folder, "documents"), carry=["doc_id"])
    return marked.select("doc_id", "fingerprint", "component_id")


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(docs, labels.where(language.learnable()))
    scored = toxicity.score(docs, model, carry=["doc_id"])
    return scored.select(
        "doc_id", (~language.learnable()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"), carry=["page_id"])


_AB = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _parts(rest: str) -> tuple[str, str, str]:
    """SQL of host, path and node of what follows the scheme."""
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), {_AB})"
    return host, f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)", f"{host} || regexp_extract({rest}, '^[^/?#]*([^#]*)', 1)"


_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
_BEST = """(SELECT max_by({what}, (length(h || s), v = 'allow')) FROM rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s))"""
_HOST, _PATH, _NODE = _parts("rest")
_THERE = _parts("there")[2]
_NODE_HOST, _NODE_PATH, _ = _parts("node")

CHECKS["op10_url_filter"] = rf"""
WITH RECURSIVE rules(v, h, s) AS (VALUES {_RULES}), p AS (
  SELECT page_id, html, {_HOST} AS host, {_PATH} AS path, {_NODE} AS node FROM (
    SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
), tags AS (
  SELECT host, path, node, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM p WHERE node <> ''
), links AS (
  SELECT *, replace(trim(CASE
    WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?\s*canonical\b') THEN
      regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 1)
      || regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 2)
      || regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 3)
    WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?\s*refresh\b') THEN
      regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''>\s;]+)', 1) END), '&amp;', '&') AS link FROM tags
), edges AS (
  SELECT node AS a, {_THERE} AS b FROM (SELECT node, CASE
    WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN substr(link, instr(link, '://') + 3)
    WHEN starts_with(link, '//') THEN substr(link, 3)
    WHEN regexp_matches(link, '^(#|$|[A-Za-z][A-Za-z0-9+.-]*:)') THEN NULL
    WHEN starts_with(link, '/') THEN host || link
    WHEN starts_with(link, '?') THEN host || path || link
    ELSE host || coalesce(nullif(regexp_replace(path, '[^/]*$', ''), ''), '/') || link END AS there FROM links WHERE link <> '')
  WHERE there IS NOT NULL
), pairs AS (
  SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reach(node, other) AS (
  SELECT a, a FROM pairs UNION SELECT r.node, e.b FROM reach r JOIN pairs e ON r.other = e.a
), ruled AS (
  SELECT node, {_BEST.format(what="v")} AS own FROM (
    SELECT DISTINCT other AS node, {_NODE_HOST.replace("node", "other")} AS host, {_NODE_PATH.replace("node", "other")} AS path FROM reach)
), groups AS (
  SELECT r.node, bool_or(own = 'allow') AS allowed, bool_or(own = 'block') AS blocked
  FROM reach r JOIN ruled u ON u.node = r.other GROUP BY r.node
), judged AS (
  SELECT *, {_BEST.format(what="h || s")} AS rule, {_BEST.format(what="v")} AS own FROM p
)
SELECT page_id, host, path, rule,
  coalesce(own, CASE WHEN coalesce(blocked, false) AND NOT coalesce(allowed, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN groups USING (node)
"""

CHECKS["op4_decontamination"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AB}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), {_AB}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark WHERE item_id IS NOT NULL
), items AS (
  SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS s
  FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM (SELECT *, least(10, len(ws)) AS n FROM b WHERE len(ws) > 0))
), places AS (
  SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM items))
), met AS (
  SELECT doc_id, item, n, p FROM places JOIN items USING (n, s)
), hit AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM met) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op11_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality.digest(line_quality.judge(table(spark, folder, "documents"), carry=["doc_id"]))


CHECKS["op11_line_quality"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), raw AS (
  SELECT r, host, unnest(string_split(text, chr(10))) AS line FROM d
), lines AS (
  SELECT r, host, line, len(lw) AS n, translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS norm
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM raw) WHERE len(lw) > 0
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r
), win AS (
  SELECT r, p, array_to_string(ws[p:p + {line_quality.WINDOW - 1}], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {line_quality.WINDOW - 2})) AS p FROM d)
), twice AS (
  SELECT r, p FROM (SELECT *, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, count(DISTINCT i) AS n_repeat_words FROM (SELECT r, unnest(range(p, p + {line_quality.WINDOW})) AS i FROM twice) GROUP BY r
), copies AS (
  SELECT r, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS doc FROM d
), counted AS (
  SELECT host, norm, count(DISTINCT doc) AS c FROM lines JOIN copies USING (r) GROUP BY host, norm
), sizes AS (
  SELECT host, count(DISTINCT doc) AS documents FROM lines JOIN copies USING (r) GROUP BY host
), often AS (
  SELECT host, norm FROM counted JOIN sizes USING (host)
  WHERE c > {line_quality.LINE_DOCUMENTS} AND c > {line_quality.LINE_SHARE}::DOUBLE * documents
), gone AS (
  SELECT r, sum(n)::BIGINT AS words, count(*) AS lines FROM lines JOIN often USING (host, norm) GROUP BY r
), m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(ws) - coalesce(words, 0) AS n_left, coalesce(lines, 0) AS n_removed_lines
  FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r)
), b AS (
  SELECT *, n_words < {line_quality.MIN_WORDS} OR 100 * n_repeat_words > {line_quality.REPEATED_PERCENT} * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND n_left >= {line_quality.MIN_WORDS} AND n_left >= {line_quality.LEFT_SHARE}::DOUBLE * n_words AS kept FROM b
"""


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"), carry=["vec_id"])


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.variants(variants.vocabulary(table(spark, folder, "documents")))


# crc32 byte by byte from its table; letters beyond ASCII here are two bytes, 195 and the code point less 64
CHECKS["op13_spelling_variants"] = rf"""
WITH RECURSIVE crc(t) AS (
  SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) AS r(i))
), runs AS (
  SELECT doc, run, count(*) AS c FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS doc, unnest(regexp_extract_all(translate(text, {_AB}), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  GROUP BY doc, run
), sums AS (
  SELECT run, c, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM (SELECT run, c, flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END
    FOR x IN string_split(doc || ':' || run, '')]) AS bytes FROM runs), crc
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {variants.THINNING} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, c
    FROM sums) WHERE length(word) >= {variants.MIN_LETTERS} GROUP BY word HAVING sum(c) >= {variants.MIN_COUNT}
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (i, head, tail) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.head || a.tail
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON b.word = a.head || a.tail
), near AS (
  SELECT word, count(*) AS n_near, min(struct_pack(less := -near_n, near := near)) AS best FROM pairs GROUP BY word
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= {variants.RATIO} * n THEN best.near END AS form,
    CASE WHEN -best.less >= {variants.RATIO} * n THEN -best.less END AS form_n FROM words LEFT JOIN near USING (word)
), walk(word, place) AS (
  SELECT word, word FROM forms UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON f.word = w.place WHERE f.form IS NOT NULL
), roots AS (
  SELECT w.word, w.place AS root FROM walk w JOIN forms f ON f.word = w.place WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
