"""The registered queries of the corpus operators, and their SQL where SQL can say it.

Each query applies its operator, with production parameters, to its whole
table and derives the agreed columns from the operator's own output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, exact_dedup, lexical_search, line_crf, mixing, packing, pii, quality_rules, secrets, simhash, site_tree, suffix_dedup, tool_calls
from .common import documents

TOKENIZER = "word_bpe_49k.json"


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "loss_tokens")


def op2_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_crf.classify(docs, line_crf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return tool_calls.link(spark, tool_calls.from_conversations(turns), tool_calls.TOOLS).select(
        "conv_id", "call_id", "turn", "name", "arguments", F.array_join("errors", ",").alias("errors"), "level", "status",
        "result_turn", "record")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(spark, documents(spark, sf_dir)).drop("n_lines")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    return found.select("doc_id", *[secrets.count_of(kind).alias(f"n_{kind}") for kind, *_ in secrets.BASE],
                        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
                        secrets.written(F.col("found")).alias("spans"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, documents(spark, sf_dir)).drop("kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(spark, documents(spark, sf_dir))
    return found.select("doc_id", *[secrets.count_of(kind).alias(f"n_{kind}") for kind in pii.KINDS],
                        F.sha2(secrets.written(F.col("base")), 256).alias("base_sha256"),
                        secrets.written(F.col("found")).alias("spans"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(spark, documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, documents(spark, sf_dir))


def op13_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_tree.main_text(spark, spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.char_length("text").cast("long"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_line_crf, op3_tool_calls, op4_quality_rules, op5_exact_dedup, op6_secrets, op7_suffix_dedup, op8_mixing,
    op9_pii, op10_simhash, op11_lexical_search, op12_divergence, op13_site_tree)}

def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches_sql(kind: str, number: int, pattern: str, least: int, group: int) -> str:
    """Places of the leftmost matches: each is taken together with the gap before it."""
    whole = _sql(f"(?s)(.*?)({pattern})")
    return f"""
  SELECT rid, '{kind}' AS kind, {number} AS k, hit, stop - length(hit) AS start, stop FROM (
    SELECT rid, hit, part, sum(length(gap) + length(hit)) OVER (PARTITION BY rid ORDER BY i) AS stop FROM (
      SELECT rid, unnest(regexp_extract_all(t, {whole}, 1)) AS gap, unnest(regexp_extract_all(t, {whole}, 2)) AS hit,
             unnest(regexp_extract_all(t, {whole}, {group})) AS part, generate_subscripts(regexp_extract_all(t, {whole}, 2), 1) AS i
      FROM d WHERE regexp_matches(t, {_sql(pattern)}))) WHERE length(part) >= {least}"""


_HARMLESS = _sql("|".join(secrets.HARMLESS))
_W, _T = secrets.WINDOW, secrets.THRESHOLDS
_OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({" UNION ALL ".join(_matches_sql(kind, i, pattern, least, group) for i, (kind, pattern, least, group) in enumerate(secrets.BASE))}),
cand AS (
  SELECT *, CASE WHEN regexp_full_match(hit, '[0-9a-f]+') OR regexp_full_match(hit, '[0-9A-F]+') THEN {_T["hex"]}
                 WHEN regexp_full_match(hit, '[0-9A-Z]+') THEN {_T["upper"]} ELSE {_T["mixed"]} END AS least
  FROM ({_matches_sql("entropy", len(secrets.BASE), secrets.CANDIDATE, 0, 2)}) WHERE NOT regexp_full_match(hit, '{secrets.EXAMPLE}')),
piece AS (
  SELECT rid, start, i, p, sum(length(p)) OVER (PARTITION BY rid, start ORDER BY i) AS stop FROM (
    SELECT rid, start, unnest(regexp_extract_all(hit, '{secrets.PIECE}')) AS p,
           generate_subscripts(regexp_extract_all(hit, '{secrets.PIECE}'), 1) AS i FROM cand)),
odd AS (SELECT rid, start, stop - length(p) AS a, stop AS b FROM piece
        WHERE NOT (regexp_full_match(p, {_HARMLESS}) OR (regexp_full_match(p, '{secrets.WORDY}') AND NOT regexp_matches(p, '{secrets.SHORT_HUMP}')))),
win AS (SELECT rid, kind, k, start, least, i, substr(hit, i + 1, {_W}) AS w
        FROM (SELECT *, unnest(range(0, length(hit) - {_W} + 1)) AS i FROM cand)),
hot AS (SELECT * FROM win WHERE -list_sum(list_transform(list_distinct(string_split(w, '')), lambda c:
          (({_W} - length(replace(w, c, ''))) / {_W}.0) * log2(({_W} - length(replace(w, c, ''))) / {_W}.0))) >= least),
isle AS (SELECT *, sum(fresh) OVER (PARTITION BY rid, start ORDER BY i) AS isle FROM (
  SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY rid, start ORDER BY i) <= {_W} THEN 0 ELSE 1 END AS fresh FROM hot)),
stretch AS (SELECT rid, kind, k, start, min(i) AS a, max(i) + {_W} AS b FROM isle GROUP BY rid, kind, k, start, isle),
span AS (SELECT s.rid, s.kind, s.k, s.start + s.a AS start, s.start + s.b AS stop
         FROM stretch s JOIN odd o ON o.rid = s.rid AND o.start = s.start AND o.a < s.b AND s.a < o.b
         GROUP BY s.rid, s.kind, s.k, s.start, s.a, s.b HAVING sum(least(o.b, s.b) - greatest(o.a, s.a)) >= {secrets.LEAST_ODD}),
added AS (SELECT s.* FROM span s WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = s.rid AND b.start < s.stop AND s.start < b.stop)),
b AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, k, stop) AS s FROM base GROUP BY rid),
f AS (SELECT rid, string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, k, stop) AS s FROM (
        SELECT rid, kind, k, start, stop FROM base UNION ALL SELECT rid, kind, k, start, stop FROM added) GROUP BY rid)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(b.s, '')) AS base_sha256, coalesce(f.s, '') AS spans
FROM d LEFT JOIN b ON d.rid = b.rid LEFT JOIN f ON d.rid = f.rid"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op11_lexical_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
i AS (
  SELECT row_number() OVER () AS qid, item_id, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT qid, any_value(item_id) AS item_id, term, count(*) AS times FROM i GROUP BY qid, term),
s AS (SELECT count(*) FILTER (len(words) > 0) AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d),
p AS (
  SELECT rid, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT rid, doc_id, len(words) AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term, n_docs),
f AS (SELECT rid, doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) AS gain
      FROM p JOIN w ON p.term = w.term, s),
r AS (SELECT qid, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, sum(times * gain)::BIGINT AS score
      FROM q JOIN f ON q.term = f.term GROUP BY qid, rid),
o AS (SELECT item_id, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
      FROM r WHERE score > 0)
SELECT * FROM o WHERE rank <= 20""",
    "op12_divergence": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWERED} AS t FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
l AS (SELECT lang, sum(n) AS total, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, w.source, w.term),
n AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.n, 0) AS n,
             (1 + (1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT) // (n.total + l.v))::HUGEINT AS p,
             (1 + (1000000000 * (k.n + 1)::HUGEINT) // (l.total + l.v))::HUGEINT AS q
      FROM n JOIN k ON n.lang = k.lang JOIN l ON n.lang = l.lang LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce((SELECT sum(((x.p - y.p) * (x.p - y.p)) // y.p) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
items AS (
  SELECT * FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM items)
SELECT * FROM o WHERE part = 'pair' OR rank <= 200""",
    "op6_secrets": _OP6,
    "op3_tool_calls": r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, 'c' || conv_id || '-' AS p FROM conversations),
c AS (
  SELECT conv_id, turn, p || turn AS call_id, n,
         CASE n % 4 WHEN 0 THEN 'search' WHEN 1 THEN 'count' WHEN 2 THEN 'define' ELSE 'draw' END AS name,
         CASE WHEN n % 2 = 0 THEN p || (turn - 2) END AS need,
         CASE n % 4 WHEN 0 THEN json_object('after', '$' || p || (turn - 2), 'limit', n % 25, 'query', text)::VARCHAR
           WHEN 1 THEN json_object('text', text, 'unit', CASE n % 3 WHEN 0 THEN '"lines"'::JSON WHEN 1 THEN '"words"'::JSON ELSE '7'::JSON END)::VARCHAR
           WHEN 2 THEN CASE WHEN n % 5 = 0
             THEN json_object('after', '$' || p || (turn - 2), 'loud', true, 'term', regexp_extract(text, '[^\x20\x09-\x0D]+'))::VARCHAR
             ELSE json_object('after', '$' || p || (turn - 2), 'term', regexp_extract(text, '[^\x20\x09-\x0D]+'))::VARCHAR END
         END AS arguments
  FROM t WHERE role = 'user'),
e AS (
  SELECT c.*, d.call_id AS known, list_filter([
      CASE WHEN c.name = 'draw' THEN 'no JSON' END,
      CASE WHEN c.name = 'search' AND c.n % 25 > 20 THEN 'high:limit' END,
      CASE WHEN c.name = 'search' AND c.n % 25 < 1 THEN 'low:limit' END,
      CASE WHEN c.name = 'count' AND c.n % 3 = 2 THEN 'type:unit' END,
      CASE WHEN c.name = 'count' AND c.n % 3 = 0 THEN 'value:unit' END,
      CASE WHEN c.name = 'define' AND c.n % 5 = 0 THEN 'extra:loud' END,
      CASE WHEN c.need IS NOT NULL AND d.call_id IS NULL THEN 'unresolved:' || c.need END], lambda x: x IS NOT NULL) AS errors
  FROM c LEFT JOIN c d ON c.conv_id = d.conv_id AND c.need = d.call_id),
l AS (
  SELECT call_id, 0 AS level FROM e WHERE known IS NULL
  UNION ALL SELECT e.call_id, l.level + 1 FROM e JOIN l ON e.known = l.call_id),
o AS (
  SELECT e.conv_id, e.call_id, e.turn, e.name, e.arguments, list_sort(e.errors) AS errors, l.level::INTEGER AS level,
         CASE WHEN r.turn IS NULL THEN 'no result' ELSE 'linked' END AS status, r.turn AS result_turn, r.text AS result
  FROM e JOIN l ON e.call_id = l.call_id
  LEFT JOIN t r ON r.conv_id = e.conv_id AND r.role = 'assistant' AND r.turn = e.turn + 1
  UNION ALL
  SELECT r.conv_id, r.p || (r.turn - 1), NULL, '', NULL, [], NULL, 'orphan result', r.turn, r.text
  FROM t r LEFT JOIN c ON c.conv_id = r.conv_id AND c.turn = r.turn - 1 WHERE r.role = 'assistant' AND c.turn IS NULL)
SELECT conv_id, call_id, turn, name, arguments, array_to_string(errors, ',') AS errors, level, status, result_turn,
       json_object('arguments', arguments::JSON, 'errors', errors, 'id', call_id, 'level', level, 'name', name, 'result', result)::VARCHAR AS record
FROM o""",
    "op4_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS run
  FROM (SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d)),
r AS (
  SELECT rid, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 8)) AS place FROM (
    SELECT rid, i, count(*) OVER (PARTITION BY rid, run) AS n FROM g) WHERE n > 1) GROUP BY rid),
m AS (
  SELECT d.rid, doc_id, text, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN r ON d.rid = r.rid),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 2 * n_dup_lines <= n_lines
       AND 5 * len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) <= n_words
       AND 2 * n_words <= word_chars AND word_chars <= 15 * n_words AND 10 * len(list_distinct(words)) >= n_words
       AND 2 * len(regexp_extract_all(text, '[A-Z]')) <= word_chars AND 10 * len(regexp_extract_all(text, '!!')) <= n_words
       AND 10 * len(list_filter(words, lambda w: regexp_matches(w, '\pL'))) >= 6 * n_words AS kept
FROM b""",
    "op5_exact_dedup": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""",
    "op8_mixing": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size)::BIGINT * 3 AS cap,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM d GROUP BY source),
fill(n, share) AS (
  SELECT 0::BIGINT, (SELECT sum(source_size)::DOUBLE / sum(w) FROM s)
  UNION ALL
  SELECT f.n2, f.share2 FROM (
    SELECT any_value(fill.n) AS n1, count(*) FILTER (s.cap < fill.share * s.w) AS n2,
           (sum(s.source_size)::DOUBLE - coalesce(sum(s.cap) FILTER (s.cap < fill.share * s.w), 0)::DOUBLE)
           / nullif(coalesce(sum(s.w) FILTER (NOT s.cap < fill.share * s.w), 0), 0) AS share2
    FROM fill, s) f WHERE f.n2 > f.n1 AND f.share2 IS NOT NULL),
t AS (
  SELECT s.source, s.source_size, least((SELECT max(share) FROM fill) * s.w, s.cap::DOUBLE) AS target FROM s),
r AS (
  SELECT d.doc_id, d.size, d.u, t.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0.0 END AS wanted
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, floor(wanted)::BIGINT AS whole,
         u * (1 - (wanted - floor(wanted))) AS a, (1 - u) * (wanted - floor(wanted)) AS b FROM r),
c AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY a / (a + b), doc_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM q)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN wanted > whole AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c""",
}
