"""Registered queries: one callable per SURVEY section-2 operator.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame built from
whole driver tables. Its DuckDB twin lives in ``SQL`` under the same key.
Computed columns carry the same alias on both sides.
"""

from __future__ import annotations

import json
import re

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions import text as TX
from ..operators import ingest as ING
from ..operators import sequences as SEQ
from ..operators import enrich as EN
from ..sources import files as SRC
from ..operators import hmm as H
from ..operators import evaluate as EV
from ..operators import report as RP
from ..operators import extract as EX
from ..operators import graph as GR
from ..operators import longseq as LS
from ..session import table
from . import fixtures as FX
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def with_fx(sql: str) -> str:
    return f"WITH {O.FX_POSTS}, main AS ({sql}) SELECT * FROM main"


# ---------------------------------------------------------------------------
# Flagship: posts -> fingerprint -> first per fingerprint -> anonymise ->
# clean -> clean body >= 50 -> ten longest bodies.
# ---------------------------------------------------------------------------

def clean_unique_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = SRC.scratch_dir(spark, "fingerprinted")
    posts = FX.fx_posts(spark, sf_dir)
    posts.write.parquet(path)  # authors and fingerprints are made once, both sides of the dedup read them
    posts = spark.read.schema(posts.schema).parquet(path)
    uniq = ING.first_per_key(posts, ["fingerprint"], ["ts", "message_id"])
    anon = ING.anonymize_record(uniq)
    return ING.clean_posts(anon)


def _clean_unique_sql(anon: str = "", cleaned: str = "") -> str:
    """``anon`` and ``cleaned``: further columns of these steps."""
    return f"""
uniq AS (
  SELECT * FROM fx_posts
  QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY ts, message_id) = 1),
anon AS (
  SELECT message_id, fingerprint, thread_id, author, ts, url,
         {O.anonymize('title')} AS title, {O.anonymize('body')} AS body{anon} FROM uniq),
cleaned AS (
  SELECT *, {O.clean('body')} AS body_clean, {O.clean('title')} AS title_clean{cleaned} FROM anon),
clean_posts AS (
  SELECT *, CAST(length(body_clean) AS BIGINT) AS body_len,
         CAST(length(title_clean) AS BIGINT) AS title_len
  FROM cleaned WHERE length(body_clean) >= 50)
"""


_CLEAN_UNIQUE_SQL = _clean_unique_sql()


@register("B15_clean_top_bodies", f"""
WITH {O.FX_POSTS}, {_CLEAN_UNIQUE_SQL}
SELECT message_id, author, body_len, title_clean, sha1(body_clean) AS body_sha1
FROM clean_posts ORDER BY body_len DESC, message_id LIMIT 10
""")
def q_clean_top_bodies(spark, sf_dir):
    c = clean_unique_posts(spark, sf_dir)
    return (c.orderBy(F.col("body_len").desc(), "message_id").limit(10)
            .select("message_id", "author", "body_len", "title_clean",
                    F.sha1("body_clean").alias("body_sha1")))


# ---------------------------------------------------------------------------
# 2B text scalars on documents-as-posts
# ---------------------------------------------------------------------------

def _posts(spark, sf_dir):
    return FX.fx_posts(spark, sf_dir)


@register("B6_fingerprint_text", with_fx(f"""
SELECT message_id, sha1({O.fp('body')}) AS body_norm_sha1, CAST(length({O.fp('body')}) AS BIGINT) AS body_norm_len,
       {O.fp('title')} AS title_norm FROM fx_posts"""))
def q_b6(spark, sf_dir):
    p = _posts(spark, sf_dir)
    return p.select("message_id", F.sha1(TX.fingerprint_text("body")).alias("body_norm_sha1"),
                    F.length(TX.fingerprint_text("body")).cast("long").alias("body_norm_len"),
                    TX.fingerprint_text("title").alias("title_norm"))


@register("B7_content_fingerprint", with_fx("SELECT message_id, fingerprint FROM fx_posts"))
def q_b7(spark, sf_dir):
    return _posts(spark, sf_dir).select("message_id", "fingerprint")


@register("B8_anonymize_text", with_fx(f"""
SELECT message_id, sha1({O.anonymize('body')}) AS anon_sha1,
       {O.anonymize('body')} <> body AS changed,
       CAST(length({O.anonymize('body')}) AS BIGINT) AS anon_len FROM fx_posts"""))
def q_b8(spark, sf_dir):
    p = _posts(spark, sf_dir).withColumn("_a", TX.anonymize_text("body"))
    return p.select("message_id", F.sha1("_a").alias("anon_sha1"), (F.col("_a") != F.col("body")).alias("changed"),
                    F.length("_a").cast("long").alias("anon_len"))


@register("B9_anonymize_username", with_fx(f"""
SELECT DISTINCT author, CASE WHEN author IS NULL OR author = '' THEN author
  ELSE 'USER_' || substr(sha256({O.q(D.ANON_SALT + ':')} || author), 1, 16) END AS author_token FROM fx_posts"""))
def q_b9(spark, sf_dir):
    return _posts(spark, sf_dir).select("author", TX.anonymize_username("author").alias("author_token")).distinct()


@register("B10_anonymize_record", with_fx(f"""
SELECT message_id, {O.anonymize('title')} AS title, sha1({O.anonymize('body')}) AS body_sha1,
       {O.anonymize('quoted')} AS quoted FROM fx_posts"""))
def q_b10(spark, sf_dir):
    a = ING.anonymize_record(_posts(spark, sf_dir))
    return a.select("message_id", "title", F.sha1("body").alias("body_sha1"), "quoted")


_PII_UNION = " UNION ALL ".join(
    f"SELECT message_id, '{lbl}' AS label, CAST(len(regexp_extract_all(coalesce(body, ''), {O.q(pat)})) AS BIGINT) AS n_matches FROM fx_posts"
    for lbl, pat in D.PII_PATTERNS)


@register("B11_pii_inventory", with_fx(f"SELECT * FROM ({_PII_UNION}) x WHERE n_matches > 0"))
def q_b11(spark, sf_dir):
    return ING.pii_inventory(_posts(spark, sf_dir), "message_id", "body")


@register("B12_clean_text", with_fx(f"""
SELECT message_id, sha1({O.clean('body')}) AS clean_sha1, CAST(length({O.clean('body')}) AS BIGINT) AS clean_len,
       {O.clean('title')} AS title_clean FROM fx_posts"""))
def q_b12(spark, sf_dir):
    p = _posts(spark, sf_dir).withColumn("_c", TX.clean_text("body"))
    return p.select("message_id", F.sha1("_c").alias("clean_sha1"), F.length("_c").cast("long").alias("clean_len"),
                    TX.clean_text("title").alias("title_clean"))


@register("B13_date_parts", with_fx("""
SELECT message_id, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
       CAST(day(ts) AS BIGINT) AS day, CAST(hour(ts) AS BIGINT) AS hour FROM fx_posts"""))
def q_b13(spark, sf_dir):
    p = _posts(spark, sf_dir)
    return p.select("message_id", *[v.cast("long").alias(k) for k, v in TX.date_parts("ts").items()])


@register("B14_text_lengths", f"""
WITH {O.FX_POSTS}, {_CLEAN_UNIQUE_SQL}
SELECT message_id, title_len, body_len FROM clean_posts""")
def q_b14(spark, sf_dir):
    return clean_unique_posts(spark, sf_dir).select("message_id", "title_len", "body_len")


_EXPORT_SQL = _clean_unique_sql(f", parent_id, {O.anonymize('quoted')} AS quoted", f", {O.clean('quoted')} AS quoted_clean")


@register("B16_export_projection", f"""
WITH {O.FX_POSTS}, {_EXPORT_SQL}
SELECT message_id, fingerprint, thread_id, coalesce(parent_id, '') AS parent_id, author, ts,
       CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, CAST(day(ts) AS BIGINT) AS day,
       CAST(hour(ts) AS BIGINT) AS hour, title_clean, body_clean, sha1(body_clean) AS body_clean_sha1, quoted_clean,
       title_len, body_len, url FROM clean_posts""")
def q_b16(spark, sf_dir):
    e = ING.export_projection(clean_unique_posts(spark, sf_dir))
    return e.withColumn("body_clean_sha1", F.sha1("body_clean"))


@register("B17_recent_posts", f"""
WITH {O.FX_TECH}
SELECT message_id, author, ts FROM fx_tech
WHERE ts >= (SELECT max(ts) FROM fx_tech) - INTERVAL 7 DAY""")
def q_b17(spark, sf_dir):
    ev = SEQ.technique_fixture(spark, table(spark, sf_dir, "events"))
    as_of = ev.select(F.max("ts")).scalar()
    return ING.recent(ev, 7, as_of).select("message_id", "author", "ts")


@register("B18_body_fallback", f"""
WITH {O.FX_POSTS}, {_CLEAN_UNIQUE_SQL}
SELECT message_id, sha1(coalesce(nullif(body_clean, ''), nullif(body, ''), '')) AS content_sha1 FROM clean_posts""")
def q_b18(spark, sf_dir):
    c = clean_unique_posts(spark, sf_dir)
    return c.select("message_id", F.sha1(TX.body_fallback("body_clean", "body")).alias("content_sha1"))


@register("B19_normalize_term", with_fx(f"""
SELECT message_id, {O.normalize_term('title')} AS term_norm, {O.squash('title')} AS term_squash FROM fx_posts"""))
def q_b19(spark, sf_dir):
    p = _posts(spark, sf_dir)
    return p.select("message_id", TX.normalize_term("title").alias("term_norm"),
                    TX.squash_term("title").alias("term_squash"))


@register("B19_normalize_body", with_fx(f"""
SELECT message_id, sha1(norm) AS body_norm_sha1, CAST(length(norm) AS BIGINT) AS body_norm_len,
       sha1(squash) AS body_squash_sha1, CAST(length(squash) AS BIGINT) AS body_squash_len
FROM (SELECT message_id, {O.normalize_term('body')} AS norm, {O.squash('body')} AS squash FROM fx_posts)"""))
def q_b19_body(spark, sf_dir):
    """B19 on the whole text (``B19_normalize_term`` reads the titles)."""
    p = _posts(spark, sf_dir).select("message_id", TX.normalize_term("body").alias("norm"), TX.squash_term("body").alias("squash"))
    return p.select("message_id", F.sha1("norm").alias("body_norm_sha1"), F.length("norm").cast("long").alias("body_norm_len"),
                    F.sha1("squash").alias("body_squash_sha1"), F.length("squash").cast("long").alias("body_squash_len"))


# ---------------------------------------------------------------------------
# 2D ingest aggregates
# ---------------------------------------------------------------------------

@register("D1_dedup_first", with_fx("""
SELECT fingerprint, message_id FROM fx_posts
QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY ts, message_id) = 1"""))
def q_d1(spark, sf_dir):
    return ING.first_per_key(_posts(spark, sf_dir), ["fingerprint"], ["ts", "message_id"]).select(
        "fingerprint", "message_id")


@register("D2_ingest_summary", with_fx("""
SELECT CAST(count(*) AS BIGINT) AS raw_count,
       CAST(count(*) - count(DISTINCT fingerprint) AS BIGINT) AS duplicate_count,
       CAST(count(DISTINCT fingerprint) AS BIGINT) AS final_count FROM fx_posts"""))
def q_d2(spark, sf_dir):
    return ING.ingest_summary(_posts(spark, sf_dir))


@register("D2_summary_observed", SQL["D2_ingest_summary"])
def q_d2_observed(spark, sf_dir):
    """The same figures, taken while the first copies are written."""
    return ING.write_first_per_key(_posts(spark, sf_dir), SRC.scratch_dir(spark, "first-copies"))


# ---------------------------------------------------------------------------
# 2C / 2E enrichment: C1, E9-E13, B20, K14, U2
# ---------------------------------------------------------------------------

def _terms_sql(terms: dict) -> str:
    rows = ", ".join(f"({i}, {O.q(k)}, {O.q(t)})" for i, (k, v) in enumerate(terms.items()) for t in v)
    return f"""
terms(idx, term, technique) AS (VALUES {rows}),
tnorm AS (SELECT idx, technique, {O.normalize_term('term')} AS nk FROM terms),
tlast AS (SELECT t.nk, t.technique FROM tnorm t
          JOIN (SELECT nk, max(idx) AS mi FROM tnorm GROUP BY nk) m ON t.nk = m.nk AND t.idx = m.mi),
tkeys AS (SELECT DISTINCT replace(nk, ' ', '') AS k, technique FROM tlast WHERE replace(nk, ' ', '') <> '')
"""


def _terms():
    return D.load_terms_json()


@register("C1_term_match", f"""
WITH {_terms_sql(D.load_terms_json())},
docs AS (SELECT doc_id, {O.squash_fast('coalesce(text, \'\')')} AS sq FROM documents),
hits AS (SELECT d.doc_id, k.technique FROM docs d JOIN tkeys k ON contains(d.sq, k.k))
SELECT d.doc_id, coalesce(string_agg(DISTINCT h.technique, ',' ORDER BY h.technique), '') AS techniques,
       CAST(count(DISTINCT h.technique) AS BIGINT) AS n_techniques
FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id""")
def q_c1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    m = EN.match_techniques(docs, "text", EN.term_table(spark))
    return m.select("doc_id", F.array_join("techniques", ",").alias("techniques"),
                    F.size("techniques").cast("long").alias("n_techniques"))


_ENT_SQL = """
toks AS (SELECT doc_id, l FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{N}_]+') AS l FROM documents)),
tok AS (SELECT doc_id, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS pos FROM toks),
ents AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, 'T' || CAST(length(text) % 3 AS VARCHAR) AS type, text,
         round(CAST((ascii(text) * 7 + length(text) * 13) % 101 AS DOUBLE) / 100.0, 4) AS confidence FROM tok),
ents_ok AS (SELECT * FROM ents WHERE round(confidence, 4) >= 0.5),
ents_u AS (SELECT * FROM ents_ok QUALIFY row_number() OVER (PARTITION BY doc_id, type, lower(text) ORDER BY pos) = 1)
"""


def _doc_posts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body"))


def _ents(spark, sf_dir):
    return EN.token_entities(_doc_posts(spark, sf_dir), "doc_id", "body")


@register("E9_entity_confidence_filter", f"""
WITH {_ENT_SQL}
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_confident, round(sum(confidence), 6) AS sum_conf
FROM ents_ok GROUP BY doc_id""")
def q_e9(spark, sf_dir):
    e = EN.confident(_ents(spark, sf_dir))
    return e.groupBy("doc_id").agg(F.count(F.lit(1)).cast("long").alias("n_confident"),
                                   F.round(F.sum("confidence"), 6).alias("sum_conf"))


@register("E10_entity_dedup", f"""
WITH {_ENT_SQL}
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_unique, CAST(sum(pos) AS BIGINT) AS pos_checksum,
       round(sum(confidence), 6) AS sum_conf FROM ents_u GROUP BY doc_id""")
def q_e10(spark, sf_dir):
    e = EN.dedup_entities(EN.confident(_ents(spark, sf_dir)), "doc_id")
    return e.groupBy("doc_id").agg(F.count(F.lit(1)).cast("long").alias("n_unique"),
                                   F.sum("pos").cast("long").alias("pos_checksum"),
                                   F.round(F.sum("confidence"), 6).alias("sum_conf"))


@register("E11_entity_json", f"""
WITH {_ENT_SQL},
arr AS (SELECT doc_id, to_json(list({{'type': type, 'text': text, 'confidence': confidence}} ORDER BY pos)) AS j
        FROM ents_u GROUP BY doc_id)
SELECT doc_id, sha1(j) AS json_sha1, CAST(length(j) AS BIGINT) AS json_len,
       CAST(json_array_length(j) AS BIGINT) AS n_decoded FROM arr""")
def q_e11(spark, sf_dir):
    e = EN.dedup_entities(EN.confident(_ents(spark, sf_dir)), "doc_id")
    a = EN.entity_array(e, "doc_id").withColumn("j", EN.encode_entities("entities"))
    return a.select("doc_id", F.sha1("j").alias("json_sha1"), F.length("j").cast("long").alias("json_len"),
                    F.size(EN.decode_entities("j")).cast("long").alias("n_decoded"))


_K14_SQL = f"""
WITH {_terms_sql(D.load_terms_json())}, {_ENT_SQL},
vocab AS (SELECT DISTINCT text FROM ents_u),
vhits AS (SELECT v.text, k.technique FROM vocab v JOIN tkeys k ON contains({O.squash_fast('v.text')}, k.k)),
agg1 AS (SELECT doc_id, count(*) AS n_ent, sum(CAST(round(confidence * 10000) AS BIGINT)) AS su
         FROM ents_u GROUP BY doc_id),
agg2 AS (SELECT e.doc_id, list(DISTINCT h.technique ORDER BY h.technique) AS techs
         FROM ents_u e JOIN vhits h ON e.text = h.text GROUP BY e.doc_id),
enriched AS (
  SELECT d.doc_id, CAST(coalesce(a.n_ent, 0) AS BIGINT) AS n_entities,
         coalesce(b.techs, []::VARCHAR[]) AS techs, coalesce(a.su, 0) AS su
  FROM documents d LEFT JOIN agg1 a ON d.doc_id = a.doc_id LEFT JOIN agg2 b ON d.doc_id = b.doc_id),
scored AS (
  SELECT doc_id, n_entities, techs, CAST(len(techs) AS BIGINT) AS n_techniques,
         CASE WHEN n_entities = 0 AND len(techs) = 0 THEN 0.0
              WHEN n_entities = 0 THEN CAST(300 * least(len(techs), 10) AS DOUBLE) / 10000.0
              ELSE CAST((2 * (7 * su + 3000 * n_entities * least(len(techs), 10)) + 10 * n_entities)
                        // (20 * n_entities) AS DOUBLE) / 10000.0
         END AS threat_score FROM enriched)
"""


def _k14(spark, sf_dir):
    # tokens, filters and dedup stay inside each document; terms come from the index of the term table
    return EN.enrich_local(_doc_posts(spark, sf_dir), EN.term_table(spark), id_col="doc_id")


@register("K14_enrich_posts", _K14_SQL + """
SELECT doc_id, n_entities, n_techniques, threat_score, array_to_string(techs, ',') AS techniques FROM scored""")
def q_k14(spark, sf_dir):
    k = _k14(spark, sf_dir)
    return k.select("doc_id", "n_entities", "n_techniques", "threat_score",
                    F.array_join("techniques", ",").alias("techniques"))


@register("B20_threat_score", _K14_SQL + "SELECT doc_id, threat_score FROM scored")
def q_b20(spark, sf_dir):
    return _k14(spark, sf_dir).select("doc_id", "threat_score")


@register("E12_entity_technique_counts", _K14_SQL + "SELECT doc_id, n_entities, n_techniques FROM scored")
def q_e12(spark, sf_dir):
    return _k14(spark, sf_dir).select("doc_id", "n_entities", "n_techniques")


@register("E13_safe_defaults", """
SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END AS BIGINT) AS n_entities,
       CAST(0 AS BIGINT) AS n_techniques, CASE WHEN doc_id % 3 = 0 THEN 0.2625 ELSE 0.0 END::DOUBLE AS threat_score,
       doc_id % 3 = 1 AND text IS NOT NULL AS quarantined FROM documents""")
def q_e13(spark, sf_dir):
    """A third of the rows stores two entities, a third holds prose instead of JSON, a third nothing."""
    d = table(spark, sf_dir, "documents")
    stored = F.when(F.col("doc_id") % 3 == 0, F.concat(
        F.lit('[{"type":"A","text":"'), F.coalesce("source", F.lit("")), F.lit('","confidence":0.5},{"type":"B","text":"'),
        F.coalesce("lang", F.lit("")), F.lit('","confidence":0.25}]'))).when(F.col("doc_id") % 3 == 1, F.col("text"))
    d = EN.with_safe_entities(d.withColumn("stored", stored), "stored")
    units = F.aggregate("entities", F.lit(0).cast("long"), lambda a, x: a + EN.conf_units(x["confidence"]))
    d = d.withColumns({"n_entities": F.size("entities").cast("long"), "n_techniques": F.lit(0).cast("long"), "units": units})
    return d.select("doc_id", "n_entities", "n_techniques",
                    EN.threat_score("units", "n_entities", "n_techniques").alias("threat_score"), "quarantined")


# Fixture terms with known hits in ``documents`` (FIXTURES.md): exercise
# spaces, hyphens and non-ASCII next to the real dictionary.
FIXTURE_TERMS = ["tion", "the", "en en", "über-"]
_FIXTURE_TOKENS_SQL = "[" + ", ".join(O.q(t) for t in FIXTURE_TERMS) + "]"


@register("U2_dictionary_entities", f"""
WITH {_terms_sql(D.load_terms_json())},
dict AS (SELECT DISTINCT lower(term) AS k FROM (SELECT term FROM terms UNION ALL SELECT unnest({_FIXTURE_TOKENS_SQL}))
          WHERE NOT regexp_matches(term, '[^\\p{{L}}\\p{{N}}_]')),
toks AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '([^\\p{{L}}\\p{{N}}_]*)([\\p{{L}}\\p{{N}}_]+)', 1) AS g,
                regexp_extract_all(coalesce(text, ''), '([^\\p{{L}}\\p{{N}}_]*)([\\p{{L}}\\p{{N}}_]+)', 2) AS l FROM documents),
flat AS (SELECT doc_id, unnest(g) AS gap, unnest(l) AS text, generate_subscripts(l, 1) - 1 AS pos FROM toks),
tok AS (SELECT *, CAST(sum(length(gap) + length(text)) OVER (PARTITION BY doc_id ORDER BY pos) AS INTEGER) AS stop FROM flat)
SELECT t.doc_id, CAST(t.pos AS BIGINT) AS pos, t.text, 'TERM' AS type, CAST(1.0 AS DOUBLE) AS confidence,
       CAST(t.stop - length(t.text) AS INTEGER) AS "start", t.stop AS "end"
FROM tok t JOIN dict d ON lower(t.text) = d.k""")
def q_u2(spark, sf_dir):
    terms = EN.term_table(spark, _terms()).select("term").unionByName(
        spark.createDataFrame([(t,) for t in FIXTURE_TERMS], "term STRING")).distinct()
    terms = (terms.where(~F.col("term").rlike(r"[^\p{L}\p{N}_]"))
             .select(F.lower("term").alias("term")).distinct()
             .select("term", F.lit("TERM").alias("type"), F.lit(1.0).alias("confidence")))
    e = EN.dictionary_entities(_doc_posts(spark, sf_dir), "doc_id", "body", terms)
    return e.select("doc_id", "pos", "text", "type", "confidence", "start", "end")


# ---------------------------------------------------------------------------
# keywords and pages: A4, C2, D3, D4
# ---------------------------------------------------------------------------

#: Words that the generated pages hold, beside the real keyword list (which they don't).
FIXTURE_KEYWORDS = ["The ", "NAV", "edst", "no such word"]


def _kw_sql(skip_comments: bool = True) -> str:
    kws = [k.strip() for k in D.KEYWORD_LINES if k.strip()] + (FIXTURE_KEYWORDS if skip_comments else [])
    if skip_comments:
        kws = [k for k in kws if not k.startswith("#")]
    rows = ", ".join(f"({i}, {O.q(k)})" for i, k in enumerate(kws))
    return f"kw(i, keyword) AS (VALUES {rows})"


_C2_SQL = f"""
{_kw_sql()},
hits AS (SELECT DISTINCT p.url, k.keyword FROM pages p JOIN kw k ON contains(lower(p.html), lower(k.keyword)))
"""


def _hits(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    kws = [r[0] for r in ING.load_keywords(spark).collect()]
    return ING.keyword_hits_list(pages, kws + FIXTURE_KEYWORDS).distinct()


@register("C2_keyword_page_match", f"WITH {_C2_SQL} SELECT url, keyword FROM hits")
def q_c2(spark, sf_dir):
    return _hits(spark, sf_dir)


@register("D4_keyword_totals", f"""
WITH {_C2_SQL} SELECT keyword, CAST(count(DISTINCT url) AS BIGINT) AS n_pages FROM hits GROUP BY keyword""")
def q_d4(spark, sf_dir):
    return ING.keyword_totals(_hits(spark, sf_dir))


@register("D3_page_report", f"""
WITH {O.FX_POSTS}, {_C2_SQL}
SELECT '{D.PAGE_RECORDS_KEY}' AS keyword, CAST(count(*) AS BIGINT) AS n, url FROM fx_posts GROUP BY url
UNION ALL
SELECT keyword, CAST(count(*) AS BIGINT) AS n, url FROM hits GROUP BY keyword, url""")
def q_d3(spark, sf_dir):
    return ING.page_report(_posts(spark, sf_dir), _hits(spark, sf_dir))


@register("A4_load_keywords", f"""
WITH {_kw_sql(False)},
hits AS (SELECT DISTINCT p.url, k.keyword FROM pages p JOIN kw k ON contains(lower(p.html), lower(k.keyword)))
SELECT k.keyword, CAST(count(h.url) AS BIGINT) AS n_pages FROM kw k LEFT JOIN hits h ON k.keyword = h.keyword
GROUP BY k.keyword""")
def q_a4(spark, sf_dir):
    kws = ING.load_keywords(spark, skip_comments=False)
    pages = table(spark, sf_dir, "pages")
    hits = ING.keyword_hits_list(pages, [r[0] for r in kws.collect()]).distinct()
    return (kws.join(hits, "keyword", "left").groupBy("keyword")
            .agg(F.count("url").cast("long").alias("n_pages")))


# ---------------------------------------------------------------------------
# 2B/2C/2D sequences: B21, C3, A6, D5-D8, E1, E2
# ---------------------------------------------------------------------------

def _tech(spark, sf_dir):
    return SEQ.technique_fixture(spark, table(spark, sf_dir, "events"))


def _seq(spark, sf_dir):
    return SEQ.phase_sequences(_tech(spark, sf_dir), author_col="author", ts_col="ts",
                               id_col="event_id")


def _phase_posts(spark, sf_dir):
    return SEQ.phase_posts(_tech(spark, sf_dir), id_col="event_id")


def wt(sql: str) -> str:
    return f"WITH {O.FX_TECH}, main AS ({sql}) SELECT * FROM main"


@register("B21_technique_phase", wt("SELECT event_id, phase FROM fx_phase"))
def q_b21(spark, sf_dir):
    return _tech(spark, sf_dir).select("event_id", SEQ.phase_of("techniques").alias("phase"))


@register("C3_technique_phase_join", wt("SELECT event_id, phase FROM fx_phase WHERE len(techniques) > 0"))
def q_c3(spark, sf_dir):
    t = _tech(spark, sf_dir).select("event_id", F.explode("techniques").alias("technique"))
    return SEQ.phase_by_join(t, D.technique_phase_df(spark), ["event_id"])


@register("A6_load_phase_dictionary", wt(f"""
SELECT p.phase_id, p.name, CAST(count(f.event_id) AS BIGINT) AS n_events
FROM (SELECT unnest(range(6)) AS phase_id, unnest({O.PHASE_NAMES_SQL}) AS name) p
LEFT JOIN fx_phase f ON f.phase = p.phase_id GROUP BY p.phase_id, p.name"""))
def q_a6(spark, sf_dir):
    path = SRC.scratch_dir(spark, "phase-dictionary")
    spark.createDataFrame([(SRC.phase_dictionary_json(),)], "value STRING").coalesce(1) \
        .write.mode("overwrite").text(path)
    phases, tp, default = SRC.load_phase_dictionary(spark, path)
    mapping = {r["technique"]: r["phase_id"] for r in tp.collect()}
    ev = _tech(spark, sf_dir).select("event_id", SEQ.phase_of("techniques", mapping, default).alias("phase"))
    counts = ev.groupBy(F.col("phase").alias("phase_id")).agg(F.count(F.lit(1)).cast("long").alias("n_events"))
    return (F.broadcast(phases).join(counts, "phase_id", "left")
            .select(F.col("phase_id").cast("long").alias("phase_id"), "name",
                    F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events")))


@register("D5_author_sequences", wt("""
SELECT author, CAST(count(*) AS BIGINT) AS n_posts,
       array_to_string(list(message_id ORDER BY ts, message_id), ',') AS message_ids,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM fx_tech WHERE ts IS NOT NULL GROUP BY author"""))
def q_d5(spark, sf_dir):
    s = SEQ.author_sequences(_tech(spark, sf_dir), ["value"])
    return s.select("author", F.size("posts").cast("long").alias("n_posts"),
                    F.array_join(F.transform("posts", lambda p: p["message_id"]), ",").alias("message_ids"),
                    F.element_at("posts", 1)["ts"].alias("first_ts"),
                    F.element_at("posts", -1)["ts"].alias("last_ts"))


_D5 = """
d5 AS (SELECT author, count(*) AS n FROM fx_tech WHERE ts IS NOT NULL GROUP BY author)"""


@register("D6_valid_sequences", f"WITH {O.FX_TECH}, {_D5} SELECT author, CAST(n AS BIGINT) AS n_posts FROM d5 WHERE n >= 3")
def q_d6(spark, sf_dir):
    return SEQ.author_post_counts(_tech(spark, sf_dir)).where(F.col("n_posts") >= D.MIN_SEQUENCE)


@register("D7_sequence_metadata", f"""
WITH {O.FX_TECH}, {_D5}
SELECT CAST(count(*) AS BIGINT) AS total_authors, CAST(count(*) FILTER (WHERE n >= 3) AS BIGINT) AS valid_authors,
       CAST(3 AS BIGINT) AS min_len FROM d5""")
def q_d7(spark, sf_dir):
    return SEQ.count_metadata(SEQ.author_post_counts(_tech(spark, sf_dir)))


@register("D8_phase_sequences", wt("SELECT author, array_to_string(seq, ',') AS seq, n_dropped FROM fx_seq"))
def q_d8(spark, sf_dir):
    return _seq(spark, sf_dir).select("author", F.array_join("seq", ",").alias("seq"), "n_dropped")


@register("D8_phase_sequence_counters", wt("""
SELECT CAST(sum(kept) AS BIGINT) AS posts_kept, CAST(sum(dropped) AS BIGINT) AS posts_dropped,
       CAST(count(*) FILTER (WHERE kept > 0) AS BIGINT) AS authors_kept,
       CAST(count(*) FILTER (WHERE kept = 0) AS BIGINT) AS authors_dropped
FROM (SELECT author, count(*) FILTER (WHERE len(techniques) > 0) AS kept,
             count(*) FILTER (WHERE len(techniques) = 0) AS dropped FROM fx_tech GROUP BY author)"""))
def q_d8c(spark, sf_dir):
    return SEQ.phase_sequence_counters(_tech(spark, sf_dir))


@register("E1_chronological_position", wt("""
SELECT message_id, author, CAST(row_number() OVER (PARTITION BY author ORDER BY ts, message_id) AS BIGINT) AS pos
FROM fx_tech"""))
def q_e1(spark, sf_dir):
    # skew-proof form: range-partitioned sort + per-slice offsets (no window per author)
    return LS.positions(_tech(spark, sf_dir), ["author"], ["ts", "message_id"]).select(
        "message_id", "author", "pos")




@register("E2_hold_out_last", wt("""
SELECT author, seq[len(seq)] AS truth, array_to_string(seq[1:len(seq) - 1], ',') AS history
FROM fx_seq WHERE len(seq) >= 2"""))
def q_e2(spark, sf_dir):
    h = SEQ.hold_out_last(_seq(spark, sf_dir))
    return h.select("author", "truth", F.array_join("history", ",").alias("history"))


# ---------------------------------------------------------------------------
# 2F model with fixed parameters on the events sequences: K7-K12, C5, D9,
# K4, D10-D15, D17, E4-E7, B24, A10, K11
# ---------------------------------------------------------------------------

FXM = H.FX_HMM
_NEXT = O.next_table_sql(FXM)
_NAMES = O.PHASE_NAMES_SQL


def _dominant_sql(path: str, S: int = 4) -> str:
    items = ", ".join(
        f"{{'n': len(list_filter({path}, lambda x: x = {s})), 'nf': -list_position({path}, {s}), 's': {s}}}"
        for s in range(S))
    return f"list_max(list_filter([{items}], lambda c: c.n > 0)).s"


_HMM_CTE = f"""
vit AS (SELECT author, seq, {O.viterbi_sql('seq', FXM)} AS v FROM fx_seq),
dec AS (SELECT author, seq, {O.vit_path('v')} AS path, list_max(v.d) AS logp FROM vit),
pred AS (SELECT author, seq, path, logp, path[len(path)] AS last_state,
                {_NEXT}[path[len(path)] + 1] AS probs FROM dec),
rep AS (
  SELECT author, seq, CAST(len(seq) AS BIGINT) AS n_posts,
         CASE WHEN len(seq) >= 2 THEN path END AS state_path,
         CASE WHEN len(seq) >= 2 THEN {_dominant_sql('path')} END AS dominant_state,
         CASE WHEN len(seq) >= 2 THEN last_state END AS last_state,
         CASE WHEN len(seq) >= 2 THEN list_position(probs, list_max(probs)) - 1 END AS next_phase_id,
         CASE WHEN len(seq) >= 2 THEN {_NAMES}[list_position(probs, list_max(probs))]
              ELSE '{D.SHORT_SEQUENCE_NAME}' END AS next_phase_name,
         CASE WHEN len(seq) >= 2 THEN list_max(probs) ELSE 0.0 END AS confidence,
         CASE WHEN len(seq) >= 2 THEN probs END AS probs,
         CASE WHEN len(seq) >= 2 THEN 'OK' ELSE '{D.SHORT_SEQUENCE_STATUS}' END AS status
  FROM pred),
ho AS (SELECT author, seq, seq[len(seq)] AS truth, seq[1:len(seq) - 1] AS history FROM fx_seq WHERE len(seq) >= 2),
hv AS (SELECT *, {O.viterbi_sql('history', FXM)} AS v FROM ho),
hp AS (SELECT author, truth, history, {_NEXT}[{O.vit_path('v')}[len(history)] + 1] AS probs FROM hv),
k12 AS (SELECT author, truth, {_NAMES}[truth + 1] AS truth_name,
               list_position(probs, list_max(probs)) - 1 AS pred,
               {_NAMES}[list_position(probs, list_max(probs))] AS pred_name,
               list_max(probs) AS confidence,
               truth = list_position(probs, list_max(probs)) - 1 AS correct, history FROM hp)
"""


def wh(sql: str) -> str:
    return f"WITH {O.FX_TECH}, {_HMM_CTE}, main AS ({sql}) SELECT * FROM main"


def _report(spark, sf_dir):
    """Per-author report from the chunked, skew-proof decode."""
    return LS.analyze_chunks(_chunks(spark, sf_dir), FXM)


def _k12(spark, sf_dir):
    """Hold-out predictions from the chunked, skew-proof decode."""
    return LS.predictions_chunks(_chunks(spark, sf_dir), FXM)


@register("K7_sequence_loglik", wt(f"SELECT author, round({O.forward_sql('seq', FXM)}, 6) AS loglik FROM fx_seq"))
def q_k7(spark, sf_dir):
    # per-author scalar: computed on the chunked, skew-proof sequences
    return LS.loglik_chunks(_chunks(spark, sf_dir), FXM).select("author", F.round("loglik", 6).alias("loglik"))


@register("K8_viterbi_decode", wh("SELECT author, array_to_string(path, ',') AS path, round(logp, 6) AS logp FROM dec"))
def q_k8(spark, sf_dir):
    s = _seq(spark, sf_dir).withColumn("_v", H.viterbi("seq", FXM))
    return s.select("author", F.array_join("_v.path", ",").alias("path"), F.round("_v.logp", 6).alias("logp"))


@register("C5_next_phase_table", wh("""
SELECT author, CAST(ph AS INTEGER) AS phase, round(probs[ph + 1], 6) AS p
FROM (SELECT author, probs, unnest(range(6)) AS ph FROM pred)"""))
def q_c5(spark, sf_dir):
    _, t, e = H.model_frames(spark, FXM)
    nxt = H.next_phase_frame(t, e)
    last = _report(spark, sf_dir).select("author", "last_state")
    return (last.join(F.broadcast(nxt), "last_state")
            .select("author", "phase", F.round("p", 6).alias("p")))


@register("K9_predict_next", wh("""
SELECT author, last_state, next_phase_id, next_phase_name, round(confidence, 6) AS confidence FROM rep"""))
def q_k9(spark, sf_dir):
    r = _report(spark, sf_dir)
    return r.select("author", "last_state", "next_phase_id", "next_phase_name",
                    F.round("confidence", 6).alias("confidence"))


@register("D9_dominant_state", wh("SELECT author, dominant_state FROM rep"))
def q_d9(spark, sf_dir):
    return _report(spark, sf_dir).select("author", "dominant_state")


_REPORT_COLS = "author, n_posts, dominant_state, next_phase_id, next_phase_name, round(confidence, 4) AS confidence, status"


@register("K10_author_analysis", wh(f"SELECT {_REPORT_COLS}, array_to_string(state_path, ',') AS state_path FROM rep"))
def q_k10(spark, sf_dir):
    # whole-array form: it returns the full state path per author
    r = H.analyze_authors(_seq(spark, sf_dir), FXM).withColumn("state_path", F.array_join("state_path", ","))
    return H.author_report(r, ("state_path",))


@register("A10_author_report_csv", wh(f"SELECT {_REPORT_COLS} FROM rep"))
def q_a10(spark, sf_dir):
    path = SRC.scratch_dir(spark, "author-report")
    SRC.write_csv(H.author_report(_report(spark, sf_dir)), path)
    schema = ("author STRING, n_posts BIGINT, dominant_state INT, next_phase_id INT, "
              "next_phase_name STRING, confidence DOUBLE, status STRING")
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@register("K11_phase_distribution", wh("""
SELECT author, CAST(ph AS INTEGER) AS phase, round(p, 6) AS p FROM (
  SELECT author, unnest(range(6)) AS ph, unnest(""" + _NEXT + """[dominant_state + 1]) AS p
  FROM rep WHERE dominant_state IS NOT NULL)"""))
def q_k11(spark, sf_dir):
    _, t, e = H.model_frames(spark, FXM)
    d = RP.phase_distribution(_report(spark, sf_dir), H.next_phase_frame(t, e))
    return d.select("author", "phase", F.round("p", 6).alias("p"))


@register("K12_holdout_predictions", wh("""
SELECT author, truth, truth_name, pred, pred_name, round(confidence, 6) AS confidence, correct,
       array_to_string(history, ',') AS history FROM k12"""))
def q_k12(spark, sf_dir):
    # whole-array form: it returns the history per author
    p = EV.predictions(_seq(spark, sf_dir), FXM)
    return p.select("author", "truth", "truth_name", "pred", "pred_name", F.round("confidence", 6).alias("confidence"),
                    "correct", F.array_join("history", ",").alias("history"))


@register("K4_split_authors", wt("""
SELECT author, CASE WHEN row_number() OVER (ORDER BY sha1('42:' || author)) <=
    (SELECT least(greatest(1, CAST(floor(count(*) * 0.2) AS BIGINT)), count(*) - 1) FROM fx_seq)
  THEN 'test' ELSE 'train' END AS split FROM fx_seq"""))
def q_k4(spark, sf_dir):
    # the split needs names alone; they are written once and read several times
    names = _phase_posts(spark, sf_dir).select("author").distinct().checkpoint(eager=True)
    train, test = EV.split_authors(names)
    return (train.select("author", F.lit("train").alias("split"))
            .unionByName(test.select("author", F.lit("test").alias("split"))))


@register("D10_value_counts", wh("""
SELECT next_phase_name, CAST(count(*) AS BIGINT) AS n, round(count(*) / (SELECT count(*) FROM rep) * 100.0, 6) AS pct
FROM rep GROUP BY next_phase_name"""))
def q_d10(spark, sf_dir):
    v = RP.value_counts(_report(spark, sf_dir), "next_phase_name")
    return v.select("next_phase_name", "n", F.round("pct", 6).alias("pct"))


@register("D11_confidence_summary", wh("""
SELECT round(avg(confidence), 6) AS mean, min(confidence) AS min, max(confidence) AS max,
       round(median(confidence), 6) AS median, round(stddev_pop(confidence), 6) AS std,
       CAST(count(confidence) AS BIGINT) AS n FROM k12"""))
def q_d11(spark, sf_dir):
    s = EV.confidence_summary(_k12(spark, sf_dir))
    return s.select(F.round("mean", 6).alias("mean"), "min", "max", F.round("median", 6).alias("median"),
                    F.round("std", 6).alias("std"), "n")


@register("D12_confidence_histogram", wh("""
SELECT b.bin, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS bin) b LEFT JOIN (
  SELECT CAST(least(20, floor((confidence - lo) / (hi - lo) * 20) + 1) AS INTEGER) AS bin, count(*) AS n
  FROM k12, (SELECT CASE WHEN max(confidence) = min(confidence) THEN min(confidence) - 0.5 ELSE min(confidence) END AS lo,
                    CASE WHEN max(confidence) = min(confidence) THEN max(confidence) + 0.5 ELSE max(confidence) END AS hi
             FROM k12) s
  GROUP BY 1) c ON b.bin = c.bin"""))
def q_d12(spark, sf_dir):
    return EV.confidence_histogram(_k12(spark, sf_dir))


@register("D13_confusion_matrix", wh("""
SELECT t.truth, """ + ", ".join(f"CAST(count(k.pred) FILTER (WHERE k.pred = {i}) AS BIGINT) AS p{i}" for i in range(6)) + """
FROM (SELECT CAST(unnest(range(6)) AS INTEGER) AS truth) t LEFT JOIN k12 k ON k.truth = t.truth GROUP BY t.truth"""))
def q_d13(spark, sf_dir):
    return EV.confusion(_k12(spark, sf_dir))


_D14_SQL = f"""
ph AS (SELECT CAST(unnest(range(6)) AS INTEGER) AS phase_id, unnest({_NAMES}) AS phase_name),
cnt AS (SELECT ph.phase_id, ph.phase_name,
          (SELECT count(*) FROM k12 WHERE truth = ph.phase_id AND pred = ph.phase_id) AS tp,
          (SELECT count(*) FROM k12 WHERE pred = ph.phase_id) AS npred,
          (SELECT count(*) FROM k12 WHERE truth = ph.phase_id) AS support FROM ph),
raw AS (SELECT *, CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS p,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM cnt),
d14 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM raw)
"""


@register("D14_class_metrics", wh(f"""
WITH {_D14_SQL}
SELECT phase_name, CAST(phase_id AS INTEGER) AS phase_id, CAST(tp AS BIGINT) AS tp, CAST(npred - tp AS BIGINT) AS fp,
       CAST(support - tp AS BIGINT) AS fn, CAST(support AS BIGINT) AS support,
       round(p, 4) AS precision, round(r, 4) AS recall, round(f, 4) AS f1 FROM d14"""))
def q_d14(spark, sf_dir):
    m = EV.class_metrics(_k12(spark, sf_dir))
    return m.select("phase_name", "phase_id", "tp", "fp", "fn", "support", "precision", "recall", "f1")


@register("D15_global_metrics", wh(f"""
WITH {_D14_SQL}
SELECT CAST(sum(support) AS BIGINT) AS total, round(sum(tp) / sum(support), 4) AS accuracy,
       round(coalesce(avg(round(p, 4)) FILTER (WHERE support > 0), 0.0), 4) AS precision_macro,
       round(coalesce(avg(round(r, 4)) FILTER (WHERE support > 0), 0.0), 4) AS recall_macro,
       round(coalesce(avg(round(f, 4)) FILTER (WHERE support > 0), 0.0), 4) AS f1_macro,
       round(sum(p * support) / sum(support), 4) AS precision_weighted,
       round(sum(r * support) / sum(support), 4) AS recall_weighted,
       round(sum(f * support) / sum(support), 4) AS f1_weighted FROM d14"""))
def q_d15(spark, sf_dir):
    return EV.global_metrics(EV.class_metrics(_k12(spark, sf_dir)))


@register("D17_headline_figures", wh(f"""
SELECT CAST(4 AS BIGINT) AS n_states, CAST(count(*) AS BIGINT) AS n_authors, round(avg(confidence), 6) AS mean_confidence,
       CAST(count(*) FILTER (WHERE status = 'OK') AS BIGINT) AS n_ok,
       CAST(count(*) FILTER (WHERE status <> 'OK') AS BIGINT) AS n_short,
       CAST(count(*) FILTER (WHERE next_phase_name IN ({', '.join(O.q(n) for n in D.CRITICAL_PHASE_NAMES)})) AS BIGINT) AS n_critical
FROM rep"""))
def q_d17(spark, sf_dir):
    h = RP.headline(_report(spark, sf_dir), FXM.n_states)
    return h.withColumn("mean_confidence", F.round("mean_confidence", 6))


@register("D17_headline_observed", SQL["D17_headline_figures"])
def q_d17_observed(spark, sf_dir):
    """The same figures, taken while the report is written."""
    h = RP.write_with_headline(_report(spark, sf_dir), SRC.scratch_dir(spark, "report"), FXM.n_states)
    return h.withColumn("mean_confidence", F.round("mean_confidence", 6))


@register("E4_top_authors", wh("""
SELECT author, next_phase_name, round(confidence, 6) AS confidence, n_posts FROM rep
ORDER BY confidence DESC, author LIMIT 10"""))
def q_e4(spark, sf_dir):
    t = RP.top_n(_report(spark, sf_dir), "confidence", 10, "author")
    return t.select("author", "next_phase_name", F.round("confidence", 6).alias("confidence"), "n_posts")


@register("E4_top_posts", _K14_SQL + "SELECT doc_id, threat_score FROM scored ORDER BY threat_score DESC, doc_id LIMIT 10")
def q_e4p(spark, sf_dir):
    return RP.top_n(_k14(spark, sf_dir).select("doc_id", "threat_score"), "threat_score", 10, "doc_id")


@register("E5_argmax_phase", wt("""
SELECT author, CAST(list_position(c, list_max(c)) - 1 AS INTEGER) AS top_phase FROM (
  SELECT author, list_transform(range(6), lambda f: len(list_filter(seq, lambda x: x = f))) AS c FROM fx_seq)"""))
def q_e5(spark, sf_dir):
    counts = F.array(*[F.count_if(F.col("phase") == f).cast("int") for f in range(6)])
    s = _phase_posts(spark, sf_dir).groupBy("author").agg(counts.alias("counts"))
    return s.select("author", RP.argmax_index(F.col("counts")).alias("top_phase"))


@register("E6_critical_authors", wh(f"""
SELECT author, next_phase_name, round(confidence, 6) AS confidence FROM rep
WHERE next_phase_name IN ({', '.join(O.q(n) for n in D.CRITICAL_PHASE_NAMES)})"""))
def q_e6(spark, sf_dir):
    c = RP.critical_authors(_report(spark, sf_dir))
    return c.select("author", "next_phase_name", F.round("confidence", 6).alias("confidence"))


@register("E7_author_lookup", wh(f"SELECT {_REPORT_COLS} FROM rep WHERE author = (SELECT min(author) FROM rep)"))
def q_e7(spark, sf_dir):
    rep = H.author_report(_report(spark, sf_dir))
    first = rep.agg(F.min("author")).first()[0]
    return RP.author_lookup(rep, first)


@register("E7_author_list", wh("SELECT DISTINCT author FROM rep"))
def q_e7l(spark, sf_dir):
    return RP.author_list(_report(spark, sf_dir))


@register("B24_name_fallback", wt(f"""
SELECT author, seq[len(seq)] AS truth, coalesce({_NAMES}[seq[len(seq)] + 1], 'Fase ' || CAST(seq[len(seq)] AS VARCHAR)) AS truth_name
FROM fx_seq"""))
def q_b24(spark, sf_dir):
    s = _phase_posts(spark, sf_dir).groupBy("author").agg(F.max_by("phase", F.struct("ts", "id")).alias("truth"))
    return s.select("author", "truth", RP.phase_name("truth").alias("truth_name"))


# ---------------------------------------------------------------------------
# pages: B1, B2, K3, E8, K2; replies: B3, B4, C6; fetch log: B22, E3;
# timestamps B5; profile D16; graph K1, C4
# ---------------------------------------------------------------------------

def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


_RAW_LINKS = f"""
raw AS (SELECT page_id, url, unnest(list_concat({O.attr_links('html')}, {O.text_links('html')})) AS href FROM pages)
"""


@register("B1_normalize_url", f"""
WITH {_RAW_LINKS}
SELECT page_id, href, {O.normalize_url('href', '.onion')} AS norm_onion,
       {O.normalize_url(O.resolve('href', 'url'), '')} AS norm_any FROM raw
UNION ALL
SELECT page_id, url AS href, {O.normalize_url('url', '.onion')} AS norm_onion, {O.normalize_url('url', '')} AS norm_any
FROM pages""")
def q_b1(spark, sf_dir):
    p = _pages(spark, sf_dir)
    h = F.col("html")
    raw = F.concat(F.regexp_extract_all(h, F.lit(EX.ATTR_LINK.format(attr="href")), 1),
                   F.regexp_extract_all(h, F.lit(EX.ATTR_LINK.format(attr="src")), 1),
                   F.regexp_extract_all(EX.visible_text(h), F.lit(EX.TEXT_ONION_URL), 0))
    links = p.select("page_id", "url", F.explode(raw).alias("href")).select(
        "page_id", "href", TX.normalize_url("href", ".onion").alias("norm_onion"),
        TX.normalize_url(EX.resolve("href", "url"), "").alias("norm_any"))
    own = p.select("page_id", F.col("url").alias("href"), TX.normalize_url("url", ".onion").alias("norm_onion"),
                   TX.normalize_url("url", "").alias("norm_any"))
    return links.unionByName(own)


@register("K3_link_extraction", f"""
WITH {_RAW_LINKS}
SELECT DISTINCT page_id, {O.normalize_url(O.resolve('href', 'url'), '')} AS link FROM raw
WHERE {O.normalize_url(O.resolve('href', 'url'), '')} IS NOT NULL""")
def q_k3(spark, sf_dir):
    return EX.page_links(_pages(spark, sf_dir), marker="", resolve_relative=True)


@register("E8_link_set", f"""
SELECT page_id, array_to_string(list_sort(list_distinct(list_concat(
  list_transform({O.attr_links('html')}, lambda u: {O.normalize_url(O.resolve('u', 'url'), '')}),
  list_transform({O.text_links('html')}, lambda u: {O.normalize_url(O.resolve('u', 'url'), '')})))), ' ') AS links
FROM pages""")
def q_e8(spark, sf_dir):
    s = EX.page_link_sets(_pages(spark, sf_dir), marker="", resolve_relative=True)
    return s.select("page_id", F.array_join("links", " ").alias("links"))


@register("B2_infer_thread_id", f"SELECT page_id, {O.thread_id('url', 'html')} AS thread_id FROM pages")
def q_b2(spark, sf_dir):
    p = _pages(spark, sf_dir)
    return p.select("page_id", TX.infer_thread_id("url", "html").alias("thread_id"))


@register("K2_extract_posts")
def q_k2(spark, sf_dir):
    posts = EX.extract_posts(_pages(spark, sf_dir), ingest_ts="2025-01-01 00:00:00")
    return posts.select("message_id", "fingerprint", "thread_id", "parent_id", "author", "ts", "ts_imputed",
                        "title", F.sha1("body").alias("body_sha1"), F.length("body").cast("long").alias("body_len"),
                        "quoted", "url", "page_id", "idx", "depth")


def _markup(c: F.Column) -> F.Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@register("K2_generated_markup", f"""
WITH t AS (SELECT conv_id, turn, role, trim(coalesce(text, ''), chr(9) || chr(10) || chr(13) || ' ') AS body,
                  count(*) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS idx FROM conversations)
SELECT 'http://x.onion/thread/' || conv_id AS url, 'thread_' || conv_id AS thread_id, 'm' || turn AS raw_id,
       CASE WHEN turn > 0 THEN 'm' || (turn - 1) END AS parent_raw, role AS author,
       TIMESTAMP '2024-03-01 00:00:00' + to_hours(CAST(turn AS INTEGER)) AS ts, false AS ts_imputed,
       'Talk ' || conv_id AS title, body, CASE WHEN turn % 3 = 2 THEN 'said before' END AS quoted, CAST(idx AS INTEGER) AS idx
FROM t WHERE length(body) >= {D.MIN_RAW_BODY}""")
def q_k2m(spark, sf_dir):
    """Conversations written as forum pages, then read back."""
    c = table(spark, sf_dir, "conversations")
    post = F.concat(
        F.lit('<div class="post" data-post-id="m'), F.col("turn").cast("string"), F.lit('"'),
        F.when(F.col("turn") > 0, F.concat(F.lit(' data-parent-id="m'), (F.col("turn") - 1).cast("string"), F.lit('"'))).otherwise(""),
        F.lit('><p class="nested"><b class="author">'), F.col("role"), F.lit("</b></p><time datetime=\""),
        F.date_format(F.lit("2024-03-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("turn").cast("int")),
                      "yyyy-MM-dd HH:mm:ss"), F.lit('"></time>'),
        F.when(F.col("turn") % 3 == 2, F.lit("<blockquote>said <i>before</i></blockquote>")).otherwise(""),
        F.lit('<div class="content">'), _markup(F.coalesce("text", F.lit(""))), F.lit("</div><script>var x = 1;</script></div>"))
    ident = F.col("conv_id").cast("string")
    pages = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", post.alias("post")))),
                                                              lambda p: p["post"]), "").alias("posts")).select(
        F.col("conv_id").alias("page_id"), F.concat(F.lit("http://x.onion/thread/"), ident).alias("url"),
        F.concat(F.lit("<html><head><title>no</title></head><body><h1>Talk "), ident, F.lit("</h1>"), F.col("posts"),
                 F.lit("</body></html>")).alias("html"))
    return EX.extract_posts(pages, ingest_ts="2025-01-01 00:00:00").select(
        "url", "thread_id", "raw_id", "parent_raw", "author", "ts", "ts_imputed", "title", "body", "quoted", "idx")


@register("B3_message_id", f"""
WITH {O.FX_REPLIES} SELECT url, raw_id, {O.message_id('url', 'raw_id', 'idx')} AS message_id FROM fx_replies""")
def q_b3(spark, sf_dir):
    r = FX.fx_replies(spark, sf_dir)
    return r.select("url", "raw_id", TX.message_id("url", "raw_id", "raw_id").alias("message_id"))


@register("B4_parent_id", f"""
WITH {O.FX_REPLIES} SELECT url, raw_id, {O.parent_id('url', 'parent_raw')} AS parent_id FROM fx_replies""")
def q_b4(spark, sf_dir):
    r = FX.fx_replies(spark, sf_dir)
    return r.select("url", "raw_id", TX.parent_id("url", "parent_raw").alias("parent_id"))


@register("C6_reply_join", f"""
WITH {O.FX_REPLIES},
m AS (SELECT *, {O.message_id('url', 'raw_id', 'idx')} AS message_id FROM fx_replies)
SELECT c.message_id, c.author, p.message_id AS parent_message_id, p.author AS parent_author
FROM m c LEFT JOIN m p ON c.url = p.url AND c.parent_raw = p.raw_id""")
def q_c6(spark, sf_dir):
    r = FX.fx_replies(spark, sf_dir).withColumn("message_id", TX.message_id("url", "raw_id", "raw_id"))
    return EX.reply_pairs(r).select("message_id", "author", "parent_message_id", "parent_author")


@register("B22_fetch_outcome", f"""
WITH {O.FX_FETCH}
SELECT event_id, status, {O.fetch_outcome('status', 'requested_url', 'final_url')} AS outcome FROM fx_fetch""")
def q_b22(spark, sf_dir):
    f = FX.fx_fetch(spark, sf_dir)
    return f.select("event_id", "status", RP.fetch_outcome("status", "requested_url", "final_url").alias("outcome"))


@register("E3_failure_streaks", f"""
WITH {O.FX_FETCH},
o AS (SELECT event_id, ts, host, {O.fetch_outcome('status', 'requested_url', 'final_url')} AS outcome FROM fx_fetch),
i AS (SELECT *, sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM o),
n AS (SELECT *, sum(CASE WHEN outcome IN ('server_error', 'http_error') THEN 1 ELSE 0 END) OVER (
        PARTITION BY host, island ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nf FROM i)
SELECT event_id, host, outcome,
       CAST(CASE WHEN outcome = 'ok' THEN 0 WHEN outcome IN ('server_error', 'http_error') THEN ((nf - 1) % 10) + 1
            ELSE nf % 10 END AS BIGINT) AS streak,
       outcome IN ('server_error', 'http_error') AND nf % 10 = 0 AS pause FROM n""")
def q_e3(spark, sf_dir):
    f = FX.fx_fetch(spark, sf_dir)
    f = f.withColumn("outcome", RP.fetch_outcome("status", "requested_url", "final_url"))
    s = RP.failure_streaks_scan(f, 10, ("ts", "event_id"), ("host",))
    return s.select("event_id", "host", "outcome", "streak", "pause")


_TS_FORMATS_OUT = [("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"), ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M"),
                   ("dd-MM-yyyy HH:mm:ss", "%d-%m-%Y %H:%M:%S"), ("d/M/yyyy H:m", "%-d/%-m/%Y %-H:%-M"),
                   ("yyyy/MM/dd HH:mm:ss", "%Y/%m/%d %H:%M:%S"), ("yyyy-MM-dd'T'HH:mm:ss'Z'", "%Y-%m-%dT%H:%M:%SZ")]
_TS_FORMATS_IN = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%d-%m-%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%Y/%m/%d %H:%M:%S"]
_INGEST = "2025-01-01 00:00:00"


@register("B5_parse_timestamp", """
WITH r AS (SELECT event_id, CASE event_id % 6 """ + " ".join(
    f"WHEN {i} THEN strftime(ts, '{d}')" for i, (_, d) in enumerate(_TS_FORMATS_OUT)) + """ END AS raw FROM events),
p AS (SELECT event_id, raw, coalesce(""" + ", ".join(f"try_strptime(trim(raw), '{f}')" for f in _TS_FORMATS_IN) + f""") AS parsed FROM r)
SELECT event_id, raw, coalesce(parsed, TIMESTAMP '{_INGEST}') AS ts, parsed IS NULL AS ts_imputed FROM p""")
def q_b5(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    m = F.col("event_id") % 6
    raw = None
    for i, (sp, _) in enumerate(_TS_FORMATS_OUT):
        raw = (F.when(m == i, F.date_format("ts", sp)) if raw is None
               else raw.when(m == i, F.date_format("ts", sp)))
    e = e.select("event_id", raw.alias("raw"))
    parsed = TX.parse_timestamp_or_null("raw")
    return e.select("event_id", "raw", F.coalesce(parsed, F.lit(_INGEST).cast("timestamp")).alias("ts"),
                    parsed.isNull().alias("ts_imputed"))


_DOC_TYPES = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
              ("n_chars", "bigint")]


@register("D16_dataset_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS non_null, '{t}' AS type FROM documents"
    for c, t in _DOC_TYPES))
def q_d16(spark, sf_dir):
    return RP.profile(table(spark, sf_dir, "documents"))


@register("D16_profile_observed", SQL["D16_dataset_profile"])
def q_d16_observed(spark, sf_dir):
    """The same counts, taken while the table is written."""
    return RP.write_profiled(table(spark, sf_dir, "documents"), SRC.scratch_dir(spark, "profiled"))


SEEDS = ["n1", "n2"]
MAX_DEPTH = 2


def _edges_sql() -> str:
    return ("edges AS (SELECT DISTINCT 'n' || CAST(o_custkey AS VARCHAR) AS src, "
            "'n' || CAST(o_orderkey AS VARCHAR) AS dst FROM orders)")


def _reach_sql(max_depth: int = MAX_DEPTH) -> str:
    ctes = [_edges_sql(), "d0 AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', 0)" for s in SEEDS)
            + ") t(url, depth))"]
    for d in range(1, max_depth + 1):
        prev = " UNION ALL ".join(f"SELECT url FROM d{k}" for k in range(d))
        ctes.append(f"d{d} AS (SELECT DISTINCT e.dst AS url, {d} AS depth FROM d{d - 1} f JOIN edges e ON e.src = f.url "
                    f"WHERE e.dst NOT IN ({prev}))")
    return "WITH " + ",\n".join(ctes)


def _edges(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("n"), F.col("o_custkey").cast("string")).alias("src"),
                    F.concat(F.lit("n"), F.col("o_orderkey").cast("string")).alias("dst"))


@register("K1_reachable_urls", _reach_sql() + "\nSELECT url, CAST(depth AS INTEGER) AS depth FROM (" +
          " UNION ALL ".join(f"SELECT * FROM d{d}" for d in range(MAX_DEPTH + 1)) + ")")
def q_k1(spark, sf_dir):
    r = GR.reachable(_edges(spark, sf_dir), SEEDS, MAX_DEPTH)
    return r.select("url", F.col("depth").cast("int"))


@register("C4_link_frontier", _reach_sql(1) + "\nSELECT url, CAST(depth AS INTEGER) AS depth FROM d1")
def q_c4(spark, sf_dir):
    e = _edges(spark, sf_dir).distinct()
    seeds = spark.createDataFrame([(s, 0) for s in SEEDS], "url STRING, depth INT")
    return GR.frontier_step(seeds, e, seeds).select("url", F.col("depth").cast("int"))


# ---------------------------------------------------------------------------
# dictionary / file sources and sinks: A1-A3, A5, A7, A8, A11, A12
# ---------------------------------------------------------------------------

@register("A5_load_term_dictionary", f"""
WITH {_terms_sql(D.load_terms_json())},
docs AS (SELECT doc_id, {O.squash_fast('coalesce(text, \'\')')} AS sq FROM documents),
keys AS (SELECT DISTINCT k FROM tkeys)
SELECT k.k AS term_key, CAST(count(d.doc_id) AS BIGINT) AS n_docs
FROM keys k LEFT JOIN docs d ON contains(d.sq, k.k) GROUP BY k.k""")
def q_a5(spark, sf_dir):
    path = SRC.scratch_dir(spark, "terms")  # the dictionary as a file in the shared store
    spark.createDataFrame([(json.dumps(D.load_terms_json()),)], "value STRING").write.text(path)
    terms = SRC.load_term_dictionary(spark, path)
    keys = EN.TM.prepared_keys(terms).select(F.col("key").alias("term_key"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the loaded table is what is matched: per document the keys it contains, then one count per key
    hits = EN.match_techniques(docs, "text", terms, "keys", emit_keys=True) \
        .select(F.explode("keys").alias("term_key"))
    counts = hits.groupBy("term_key").agg(F.count(F.lit(1)).alias("n"))
    return (keys.join(counts, "term_key", "left")
            .select("term_key", F.coalesce("n", F.lit(0)).cast("long").alias("n_docs")))


_RAW_POSTS_SQL = with_fx("""
SELECT message_id, fingerprint, thread_id, author, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS ts, title,
       sha1(body) AS body_sha1, url FROM fx_posts""")


def _raw_posts(spark, sf_dir):
    p = _posts(spark, sf_dir)
    return p.withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def _raw_view(df):
    return df.select("message_id", "fingerprint", "thread_id", "author", "ts", "title",
                     F.sha1("body").alias("body_sha1"), "url")


@register("A1_read_posts_csv", _RAW_POSTS_SQL)
def q_a1(spark, sf_dir):
    path = SRC.scratch_dir(spark, "posts-csv")
    SRC.append_posts_csv(_raw_posts(spark, sf_dir), path)
    return _raw_view(SRC.read_posts_csv(spark, path))


@register("A1_quarantined_posts_csv", with_fx("""
SELECT broken, CASE WHEN NOT broken THEN message_id END AS message_id, CASE WHEN NOT broken THEN sha1(body) END AS body_sha1,
       CASE WHEN broken THEN message_id || ',' || fingerprint || CASE WHEN how = 0 THEN '' ELSE ',a,b,c,d,e,f,g,h,i,j' END END AS record
FROM (SELECT *, doc_id % 5 IN (1, 3) AS broken, CASE WHEN doc_id % 5 = 1 THEN 0 ELSE 1 END AS how FROM fx_posts)"""))
def q_a1_quarantine(spark, sf_dir):
    """Of the posts a fifth is written with two fields, a fifth with twelve; the rest must come back whole."""
    path = SRC.scratch_dir(spark, "posts-csv-broken")
    p = _raw_posts(spark, sf_dir)
    place = F.substring_index("message_id", "_", -1).cast("long") % 5
    good = F.to_csv(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in p.columns else F.lit("").alias(c) for c in SRC.RAW_FIELDS]),
                    {"escape": '"', "quoteAll": "true", **SRC.KEEP_SPACES})
    short = F.concat_ws(",", "message_id", "fingerprint")
    line = F.when(place == 1, short).when(place == 3, F.concat(short, F.lit(",a,b,c,d,e,f,g,h,i,j"))).otherwise(good)
    p.select(line.alias("value")).write.text(path)
    posts, bad = SRC.split_posts_csv(spark, path, header=False)
    none = F.lit(None).cast("string")
    return posts.select(F.lit(False).alias("broken"), "message_id", F.sha1("body").alias("body_sha1"), none.alias("record")).unionByName(
        bad.select(F.lit(True).alias("broken"), none.alias("message_id"), none.alias("body_sha1"), F.col(SRC.CORRUPT).alias("record")))


@register("A2_append_posts_jsonl", with_fx("""
SELECT message_id, fingerprint, thread_id, author, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS ts, title,
       sha1(body) AS body_sha1, url FROM fx_posts, range(2)"""))
def q_a2(spark, sf_dir):
    path = SRC.scratch_dir(spark, "posts-jsonl")
    raw = _raw_posts(spark, sf_dir)
    SRC.append_posts_json(raw, path)
    SRC.append_posts_json(raw, path)   # second append: both copies are kept
    return _raw_view(spark.read.schema(SRC.RAW_SCHEMA).json(path))


@register("A3_append_posts_csv", with_fx("""
SELECT message_id, fingerprint, thread_id, author, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS ts, title,
       sha1(body) AS body_sha1, url FROM fx_posts, range(2)"""))
def q_a3(spark, sf_dir):
    path = SRC.scratch_dir(spark, "posts-csv-append")
    raw = _raw_posts(spark, sf_dir)
    SRC.append_posts_csv(raw, path)
    SRC.append_posts_csv(raw, path)
    return _raw_view(SRC.read_posts_csv(spark, path))


@register("A2_A3_append_batch_once", with_fx("""
SELECT form, message_id, fingerprint, thread_id, author, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS ts, title,
       sha1(body) AS body_sha1, url FROM fx_posts, (VALUES ('json'), ('csv')) f(form)"""))
def q_append_once(spark, sf_dir):
    """Two batches of half the posts each; the first is run again and replaces what it had written."""
    kept = SRC.scratch_dir(spark, "once-raw")
    raw = _raw_posts(spark, sf_dir).withColumn("half", F.pmod(F.xxhash64("message_id"), F.lit(2)).cast("int"))
    raw.write.partitionBy("half").parquet(kept)
    raw = spark.read.schema(raw.schema).parquet(kept)  # six writes read it, each one half
    js, cs = SRC.scratch_dir(spark, "once-jsonl"), SRC.scratch_dir(spark, "once-csv")
    for n in (0, 1, 0):
        SRC.append_posts_json(raw.where(F.col("half") == n), js, batch=str(n))
        SRC.append_posts_csv(raw.where(F.col("half") == n), cs, batch=str(n))
    return _raw_view(spark.read.schema(SRC.RAW_SCHEMA).json(js)).withColumn("form", F.lit("json")).unionByName(
        _raw_view(SRC.read_posts_csv(spark, cs)).withColumn("form", F.lit("csv")))


def _author_posts(spark, sf_dir):
    t = _tech(spark, sf_dir).withColumn("threat_score", F.col("value"))
    return SEQ.author_sequences(t, ["threat_score", "techniques"])


_SEQ_EXPORT_SQL = wt("""
SELECT author, CAST(count(*) AS BIGINT) AS n_posts,
       array_to_string(list(array_to_string(techniques, '+') ORDER BY ts, message_id), ',') AS techniques,
       round(sum(value), 6) AS score_sum FROM fx_tech GROUP BY author""")


def _seq_export_view(s):
    return s.select("author", F.size("posts").cast("long").alias("n_posts"),
                    F.array_join(F.transform("posts", lambda p: F.array_join(p["techniques"], "+")), ",").alias("techniques"),
                    F.round(F.aggregate("posts", F.lit(0.0), lambda a, p: a + p["threat_score"]), 6).alias("score_sum"))


@register("A7_write_sequences", _SEQ_EXPORT_SQL)
def q_a7(spark, sf_dir):
    path = SRC.scratch_dir(spark, "sequences")
    SRC.write_sequences(_author_posts(spark, sf_dir), path)
    return _seq_export_view(spark.read.parquet(f"{path}/sequences"))


@register("A8_read_sequences_json", _SEQ_EXPORT_SQL)
def q_a8(spark, sf_dir):
    js = SRC.sequences_as_json(_author_posts(spark, sf_dir))
    return _seq_export_view(SRC.read_sequences_json(js))


@register("A7_A8_sequence_files", wt("""
SELECT author, CAST(count(*) AS BIGINT) AS n_posts,
       array_to_string(list(array_to_string(techniques, '+') ORDER BY ts, message_id), ',') AS techniques,
       round(sum(value), 6) AS score_sum, CAST(sum(len(techniques)) AS BIGINT) AS n_entities,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS last_ts,
       CAST(any_value(total) AS BIGINT) AS total_authors, CAST(any_value(valid) AS BIGINT) AS valid_authors
FROM fx_tech, (SELECT count(*) AS total, count(*) FILTER (n >= 3) AS valid FROM (
  SELECT author, count(*) AS n FROM fx_tech GROUP BY author))
GROUP BY author HAVING count(*) >= 3"""))
def q_a7_files(spark, sf_dir):
    """The sequences written as whole JSON objects, read back with their entities and metadata."""
    t = _tech(spark, sf_dir).withColumn("threat_score", F.col("value")).withColumn("entities", F.transform(
        "techniques", lambda x: F.struct(F.lit("TECHNIQUE").alias("type"), x.alias("text"), F.lit(1.0).alias("confidence"))))
    path = SRC.scratch_dir(spark, "sequence-files")
    SRC.write_sequence_files(SEQ.author_sequences(t, ["threat_score", "techniques", "entities"]), path)
    back = SRC.read_sequence_files(spark, path)
    return _seq_export_view(back.select("author", "posts")).join(back.select(
        "author", F.aggregate("posts", F.lit(0).cast("long"), lambda n, p: n + F.size(p["entities"])).alias("n_entities"),
        F.date_format(F.array_max(F.transform("posts", lambda p: p["ts"])), "yyyy-MM-dd'T'HH:mm:ss").alias("last_ts"),
        "metadata.total_authors", "metadata.valid_authors"), "author")


@register("A11_write_evaluation_report", wh(f"""
WITH {_D14_SQL}
SELECT phase_name, CAST(phase_id AS INTEGER) AS phase_id, round(p, 4) AS precision, round(r, 4) AS recall,
       round(f, 4) AS f1, CAST(support AS BIGINT) AS support FROM d14"""))
def q_a11(spark, sf_dir):
    path = SRC.scratch_dir(spark, "evaluation")
    SRC.write_evaluation(_k12(spark, sf_dir), path)
    return SRC.read_evaluation(spark, path, "metrics_by_phase")


@register("A11_evaluation_read_back", wh(f"""
WITH {_D14_SQL},
g AS (SELECT sum(tp) / sum(support) AS accuracy, coalesce(avg(round(f, 4)) FILTER (WHERE support > 0), 0.0) AS f1_macro,
             sum(p * support) / sum(support) AS precision_weighted FROM d14)
SELECT 'global' AS part, 'accuracy' AS item, round(accuracy, 4) AS value FROM g
UNION ALL SELECT 'global', 'f1_macro', round(f1_macro, 4) FROM g
UNION ALL SELECT 'global', 'precision_weighted', round(precision_weighted, 4) FROM g
UNION ALL SELECT 'phase', phase_name, round(f, 4) FROM d14
UNION ALL SELECT 'author', author || ':' || CAST(truth AS VARCHAR) || ':' || CAST(pred AS VARCHAR), round(confidence, 6) FROM k12"""))
def q_a11_back(spark, sf_dir):
    """All three parts of the report, as they are read from the files."""
    path = SRC.scratch_dir(spark, "evaluation")
    SRC.write_evaluation(_k12(spark, sf_dir), path)
    back = {part: SRC.read_evaluation(spark, path, part) for part in SRC.EVALUATION_PARTS}
    figures = back["metrics_global"].select(F.lit("global").alias("part"), F.explode(F.create_map(
        *[x for c in ("accuracy", "f1_macro", "precision_weighted") for x in (F.lit(c), F.col(c))])).alias("item", "value"))
    phases = back["metrics_by_phase"].select(F.lit("phase").alias("part"), F.col("phase_name").alias("item"), F.col("f1").alias("value"))
    authors = back["predictions"].select(F.lit("author").alias("part"), F.concat_ws(":", "author", "truth", "pred").alias("item"),
                                         F.round("confidence", 6).alias("value"))
    return figures.unionByName(phases).unionByName(authors)


@register("A12_keyword_report_lines", f"""
WITH {O.FX_POSTS}, {_C2_SQL}
SELECT keyword || ' | ' || url AS value FROM hits
UNION ALL
SELECT '{D.PAGE_RECORDS_KEY}' || ' | ' || CAST(count(*) AS VARCHAR) || ' | ' || url FROM fx_posts GROUP BY url""")
def q_a12(spark, sf_dir):
    path = SRC.scratch_dir(spark, "keyword-report")
    per_page = _posts(spark, sf_dir).groupBy("url").agg(F.count(F.lit(1)).alias("n")) \
        .select(F.lit(D.PAGE_RECORDS_KEY).alias("keyword"), "n", "url")
    SRC.write_text(SRC.keyword_report_lines(_hits(spark, sf_dir), per_page), path)
    return spark.read.text(path)


# ---------------------------------------------------------------------------
# trained model: K5, K6, A9, K13, K15, B23 (fit by distributed Baum-Welch)
# ---------------------------------------------------------------------------

#: Chunk length of the ``*_chunked`` and ``*_chunks`` keys: short, so that every author has several chunks.
SHORT = 16


def _chunks(spark, sf_dir, L=LS.CHUNK):
    """Skew-proof chunked phase sequences (positions by range-partitioned sort)."""
    return LS.phase_chunks(_tech(spark, sf_dir), ts_col="ts", id_col="event_id", L=L)


def _fitted(spark, sf_dir) -> H.HMM:
    return H.fit_hmm(_chunks(spark, sf_dir))


def _model_rows(spark, m: H.HMM):
    s, t, e = H.model_frames(spark, m)
    return (s.select(F.lit("start").alias("kind"), "i", F.lit(None).cast("int").alias("j"), "p")
            .unionByName(t.select(F.lit("trans").alias("kind"), "i", "j", "p"))
            .unionByName(e.select(F.lit("emit").alias("kind"), "i", F.col("k").alias("j"), "p")))


@register("K5_training_checks", wt("""
SELECT CAST(sum(len(seq)) AS BIGINT) AS total_posts, CAST(count(*) FILTER (WHERE len(seq) >= 2) AS BIGINT) AS n_sequences,
       sum(len(seq)) >= 12 AND count(*) FILTER (WHERE len(seq) >= 2) >= 1 AS trainable FROM fx_seq"""))
def q_k5(spark, sf_dir):
    per = _phase_posts(spark, sf_dir).groupBy("author").agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_posts"),
                    F.count_if(F.col("n") >= 2).cast("long").alias("n_sequences"))
    return total.withColumn("trainable", H.trainable("total_posts", "n_sequences", D.N_STATES))


@register("K6_fit_hmm")
def q_k6(spark, sf_dir):
    m = _fitted(spark, sf_dir)
    hist = spark.createDataFrame([(i, float(v)) for i, v in enumerate(m.history)], "i INT, p DOUBLE") \
        .select(F.lit("loglik").alias("kind"), "i", F.lit(None).cast("int").alias("j"), "p")
    return _model_rows(spark, m).unionByName(hist)


_EM_SQL = f"""WITH RECURSIVE {O.FX_TECH}, {O.em_step_sql('fx_seq', FXM)}
SELECT kind, i, j, round(expected, 5) AS expected, round(p, 7) AS p FROM em"""


@register("K6_em_step", _EM_SQL)
def q_k6_step(spark, sf_dir):
    """One EM step from the fixed model, in built-in expressions over whole sequences."""
    return H.em_step(_seq(spark, sf_dir), FXM).select("kind", "i", "j", F.round("expected", 5).alias("expected"), F.round("p", 7).alias("p"))


@register("K6_em_step_chunked", _EM_SQL)
def q_k6_step_chunked(spark, sf_dir):
    """The same step as the fit takes it: chunks, boundaries by the tree scan, counts in numpy."""
    rows, levels = H.training_rows(_chunks(spark, sf_dir, SHORT), FXM.n_states)
    start, trans, emit, ll = H.expected_counts(rows, levels, FXM)
    new = H.maximised(start, trans, emit)
    cells = [("start", i, None, float(v), p) for i, (v, p) in enumerate(zip(start, new.start))]
    for kind, table, shares in (("trans", trans, new.trans), ("emit", emit, new.emit)):
        cells += [(kind, i, j, float(v), shares[i][j]) for i, row in enumerate(table) for j, v in enumerate(row)]
    found = spark.createDataFrame([*cells, ("loglik", 0, None, ll, None)], "kind STRING, i INT, j INT, expected DOUBLE, p DOUBLE")
    return found.select("kind", "i", "j", F.round("expected", 5).alias("expected"), F.round("p", 7).alias("p"))


@register("A9_model_roundtrip")
def q_a9(spark, sf_dir):
    path = SRC.scratch_dir(spark, "model")
    m = _fitted(spark, sf_dir)
    H.save_model(spark, m, path)
    again = H.load_or_fit(spark, path, _seq(spark, sf_dir))   # loads; no refit
    return _model_rows(spark, again)


@register("A9_fixed_model_roundtrip", wt(f"SELECT author, round({O.forward_sql('seq', FXM)}, 6) AS loglik FROM fx_seq"))
def q_a9f(spark, sf_dir):
    """Log-likelihoods under the fixed model after it was stored and read back."""
    path = SRC.scratch_dir(spark, "fixed-model")
    H.save_model(spark, FXM, path)
    m = H.load_model(spark, path)
    return LS.loglik_chunks(_chunks(spark, sf_dir), m).select("author", F.round("loglik", 6).alias("loglik"))


@register("K15_state_profiles")
def q_k15(spark, sf_dir):
    s, t, e = H.model_frames(spark, _fitted(spark, sf_dir))
    return RP.state_profiles(s, t, e)


@register("K15_state_profiles_of_step", f"""WITH RECURSIVE {O.FX_TECH}, {O.em_step_sql('fx_seq', FXM)},
best AS (SELECT i, j, p, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS at FROM em WHERE kind = 'emit')
SELECT s.i AS state, round(s.p, 7) AS start_p, round(t.p, 7) AS persistence,
       CASE WHEN t.p > 0.7 THEN 'muy persistente' WHEN t.p > 0.4 THEN 'moderadamente persistente' ELSE 'transitorio' END AS persistence_class,
       b.j AS dominant_phase, round(b.p, 7) AS dominant_p, {_NAMES}[b.j + 1] AS dominant_phase_name
FROM em s JOIN em t ON t.kind = 'trans' AND t.i = s.i AND t.j = s.i JOIN best b ON b.i = s.i AND b.at = 1 WHERE s.kind = 'start'""")
def q_k15_step(spark, sf_dir):
    """State profiles of the model that one EM step from the fixed one gives."""
    m = H.fit_hmm(_chunks(spark, sf_dir), max_iter=1, start_model=FXM)
    return RP.state_profiles(*H.model_frames(spark, m)).withColumns({c: F.round(c, 7) for c in ("start_p", "persistence", "dominant_p")})


_K13_SQL = f"""{O.FX_TECH}, {_HMM_CTE},
rank AS (SELECT *, row_number() OVER (ORDER BY sha1('42:' || author)) AS place, count(*) OVER () AS n FROM fx_seq),
test AS (SELECT author FROM rank WHERE n > 1 AND place <= least(greatest(1, CAST(floor(n * 0.2) AS BIGINT)), n - 1)),
k13 AS (SELECT k12.* FROM k12 JOIN test ON k12.author = test.author)"""


@register("K13_fixed_evaluation", f"""WITH {_K13_SQL},
c AS (SELECT p.phase, count(*) FILTER (truth = p.phase AND pred = p.phase) AS tp, count(*) FILTER (truth = p.phase) AS support,
             count(*) FILTER (pred = p.phase) AS named FROM (SELECT unnest(range(6)) AS phase) p LEFT JOIN k13 ON true GROUP BY p.phase),
r AS (SELECT *, CASE WHEN named > 0 THEN tp / named ELSE 0.0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS r FROM c),
m AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM r)
SELECT CAST(sum(support) AS BIGINT) AS total, round(coalesce(sum(tp) / nullif(sum(support), 0), 0), 4) AS accuracy,
       {", ".join(f"round(coalesce(avg(round({c}, 4)) FILTER (support > 0), 0), 4) AS {n}_macro, "
                  f"round(coalesce(sum({c} * support) / nullif(sum(support), 0), 0), 4) AS {n}_weighted"
                  for c, n in (("p", "precision"), ("r", "recall"), ("f", "f1")))} FROM m""")
def q_k13_fixed(spark, sf_dir):
    """The evaluation job with the fixed model: split, hold-out, prediction and global metrics, over chunks."""
    return EV.evaluate(_chunks(spark, sf_dir, SHORT), model=FXM, chunk_length=SHORT)["metrics_global"]


@register("K13_evaluation")
def q_k13(spark, sf_dir):
    res = EV.evaluate(_chunks(spark, sf_dir))
    return res["metrics_global"]


@register("B23_persistence_class", wt("""
SELECT CAST(a AS INTEGER) AS phase, round(self_p, 6) AS persistence,
       CASE WHEN self_p > 0.7 THEN 'muy persistente' WHEN self_p > 0.4 THEN 'moderadamente persistente'
            ELSE 'transitorio' END AS persistence_class
FROM (SELECT a, count(*) FILTER (WHERE a = b) / count(*) AS self_p FROM (
        SELECT unnest(seq[1:len(seq) - 1]) AS a, unnest(seq[2:]) AS b FROM fx_seq WHERE len(seq) >= 2) GROUP BY a)"""))
def q_b23(spark, sf_dir):
    """Persistence class on the empirical phase-transition diagonal (the
    fitted model's diagonal goes through K15)."""
    c = _chunks(spark, sf_dir)
    pairs = c.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("seq") - 1), lambda i: F.struct(
        F.get("seq", i - 1).alias("a"), F.get("seq", i).alias("b")))).alias("z")).where(F.col("z.b").isNotNull()).select("z.*")
    ends = c.select("author", (F.col("chunk") + 1).alias("chunk"), F.element_at("seq", -1).alias("a"))
    seams = ends.join(c.select("author", "chunk", F.element_at("seq", 1).alias("b")), ["author", "chunk"]).select("a", "b")
    pairs = pairs.unionByName(seams)
    d = pairs.groupBy("a").agg((F.count_if(F.col("a") == F.col("b")) / F.count(F.lit(1))).alias("self_p"))
    return d.select(F.col("a").cast("int").alias("phase"), F.round("self_p", 6).alias("persistence"),
                    RP.persistence_class("self_p").alias("persistence_class"))


# ---------------------------------------------------------------------------
# UDF surface U1 and streaming S1-S3
# ---------------------------------------------------------------------------

def _dictionary_extractor_factory():
    """Stand-in for a token-classification model: a dictionary extractor
    returning entity spans with a fixed confidence. The word set is built on
    the driver and travels inside the factory's closure."""
    import re as _re
    words = frozenset({w.lower() for w in D.load_terms_json() if _re.fullmatch(r"\w+", w)} | set(FIXTURE_TERMS))

    def factory():
        pat = _re.compile(r"\w+")

        def extract(text: str):
            return [{"type": "TERM", "text": m.group(0), "confidence": 0.9, "start": m.start(), "end": m.end()}
                    for m in pat.finditer(text) if m.group(0).lower() in words]
        return extract
    return factory


_U1_WORDS = sorted({w.lower() for w in D.load_terms_json() if re.fullmatch(r"\w+", w)} | set(FIXTURE_TERMS))


@register("U1_entity_extractor_hook", f"""
WITH toks AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '([^\\p{{L}}\\p{{N}}_]*)([\\p{{L}}\\p{{N}}_]+)', 1) AS g,
                     regexp_extract_all(coalesce(text, ''), '([^\\p{{L}}\\p{{N}}_]*)([\\p{{L}}\\p{{N}}_]+)', 2) AS l FROM documents),
flat AS (SELECT doc_id, unnest(g) AS gap, unnest(l) AS text, generate_subscripts(l, 1) AS i FROM toks),
tok AS (SELECT *, sum(length(gap) + length(text)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM flat)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS BIGINT) AS pos, 'TERM' AS type, text,
       CAST(0.9 AS DOUBLE) AS confidence, CAST(stop - length(text) AS INTEGER) AS "start", CAST(stop AS INTEGER) AS "end"
FROM tok WHERE list_contains([{", ".join(O.q(w) for w in _U1_WORDS)}], lower(text))""")
def q_u1(spark, sf_dir):
    e = EN.model_entities(_doc_posts(spark, sf_dir), "doc_id", "body", _dictionary_extractor_factory())
    return e.select("doc_id", "pos", "type", "text", "confidence", "start", "end")


#: Posts that a landed file holds, about.
LANDED_ROWS = 8192


def _landing(spark, sf_dir) -> tuple[str, object, int]:
    """(folder, schema, files of a quarter): the posts in files of like size, four at least, whatever their number."""
    posts = _posts(spark, sf_dir)
    path = SRC.scratch_dir(spark, "landing")
    files = max(4, -(-table(spark, sf_dir, "documents").count() // LANDED_ROWS))
    posts.repartition(files, "doc_id").sortWithinPartitions("doc_id").write.parquet(path)
    return path, posts.schema, -(-len(spark.read.schema(posts.schema).parquet(path).inputFiles()) // 4)


@register("S1_resumable_ingest", with_fx("""
SELECT fingerprint, message_id FROM fx_posts
QUALIFY row_number() OVER (PARTITION BY fingerprint ORDER BY ts, message_id) = 1"""))
def q_s1(spark, sf_dir):
    from ..streaming import ingest as ST
    landing, schema, quarter = _landing(spark, sf_dir)
    sink, ckpt = SRC.scratch_dir(spark, "dedup-sink"), SRC.scratch_dir(spark, "dedup-ckpt")
    q = ST.exact_dedup_sink(ST.landing_stream(spark, landing, schema), sink, ckpt)
    q.awaitTermination()
    # a second run resumes from the checkpoint and finds nothing new
    q = ST.exact_dedup_sink(ST.landing_stream(spark, landing, schema), sink, ckpt)
    q.awaitTermination()
    return ST.read_dedup_sink(spark, sink).select("fingerprint", "message_id")


@register("S2_incremental_dedup", with_fx("SELECT DISTINCT fingerprint FROM fx_posts"))
def q_s2(spark, sf_dir):
    from ..streaming import ingest as ST
    landing, schema, quarter = _landing(spark, sf_dir)
    sink, ckpt = SRC.scratch_dir(spark, "wm-sink"), SRC.scratch_dir(spark, "wm-ckpt")
    ST.watermark_dedup(ST.landing_stream(spark, landing, schema, quarter), sink, ckpt).awaitTermination()
    return spark.read.parquet(sink).select("fingerprint")


@register("S3_incremental_page_report", with_fx("SELECT url, CAST(count(*) AS BIGINT) AS n FROM fx_posts GROUP BY url"))
def q_s3(spark, sf_dir):
    from ..streaming import ingest as ST
    landing, schema, quarter = _landing(spark, sf_dir)
    sink, ckpt = SRC.scratch_dir(spark, "pages-sink"), SRC.scratch_dir(spark, "pages-ckpt")
    ST.page_counts_stream(ST.landing_stream(spark, landing, schema), sink, ckpt).awaitTermination()
    return ST.read_page_counts(spark, sink)


#: Words that the posts hold, and one they don't.
STREAM_KEYWORDS = ["The", "en ", "no such word"]


@register("S3_keyword_report", with_fx(f"""
SELECT k.keyword, u.url, CAST(count(*) AS BIGINT) AS n
FROM (SELECT url, fingerprint, min(lower(coalesce(body, ''))) AS low FROM fx_posts GROUP BY url, fingerprint) u
JOIN (SELECT unnest([{', '.join(O.q(k) for k in STREAM_KEYWORDS)}, {O.q(D.PAGE_RECORDS_KEY)}]) AS keyword) k
  ON k.keyword = {O.q(D.PAGE_RECORDS_KEY)} OR contains(u.low, lower(k.keyword)) GROUP BY k.keyword, u.url"""))
def q_s3_keywords(spark, sf_dir):
    from ..streaming import ingest as ST
    landing, schema, quarter = _landing(spark, sf_dir)
    sink, ckpt = SRC.scratch_dir(spark, "keywords-sink"), SRC.scratch_dir(spark, "keywords-ckpt")
    for _ in range(2):  # the second run resumes and finds nothing new
        ST.keyword_counts_stream(ST.landing_stream(spark, landing, schema, quarter), sink, ckpt, STREAM_KEYWORDS,
                                 D.PAGE_RECORDS_KEY).awaitTermination()
    return ST.read_keyword_counts(spark, sink)


@register("K8_decode_chunked", wh("""
SELECT r.author, CAST(len(r.seq) AS BIGINT) AS n_posts, CAST(r.last_state AS INTEGER) AS last_state,
       r.dominant_state, round(d.logp, 6) AS logp FROM rep r JOIN dec d ON r.author = d.author"""))
def q_k8c(spark, sf_dir):
    d = LS.decode_chunks(_chunks(spark, sf_dir, SHORT), FXM, L=SHORT)
    return d.select("author", "n_posts", "last_state", "dominant_state", F.round("logp", 6).alias("logp"))


@register("K7_loglik_chunked", wt(f"SELECT author, round({O.forward_sql('seq', FXM)}, 6) AS loglik FROM fx_seq"))
def q_k7c(spark, sf_dir):
    return LS.loglik_chunks(_chunks(spark, sf_dir, SHORT), FXM).select("author", F.round("loglik", 6).alias("loglik"))


@register("K10_author_report_chunked", wh(f"SELECT {_REPORT_COLS} FROM rep"))
def q_k10c(spark, sf_dir):
    return H.author_report(LS.analyze_chunks(_chunks(spark, sf_dir, SHORT), FXM, L=SHORT))


def _slices_sql(list_expr: str, L: int = SHORT) -> str:
    """DuckDB: one row per L-sized slice of a list: (c, slice)."""
    return (f"SELECT *, unnest(range(0, (len({list_expr}) - 1) // {L} + 1)) AS c FROM")


@register("D8_phase_chunks", wt(f"""
SELECT author, CAST(c AS BIGINT) AS chunk, array_to_string(seq[c * {SHORT} + 1:(c + 1) * {SHORT}], ',') AS seq,
       CAST((len(seq) - 1) // {SHORT} + 1 AS BIGINT) AS n_chunks
FROM ({_slices_sql('seq')} fx_seq)"""))
def q_d8c(spark, sf_dir):
    c = _chunks(spark, sf_dir, SHORT)
    return c.select("author", "chunk", F.array_join("seq", ",").alias("seq"), F.col("n_chunks").cast("long"))


@register("K8_viterbi_paths_chunked", wh(f"""
SELECT author, CAST(c AS BIGINT) AS chunk, array_to_string(path[c * {SHORT} + 1:(c + 1) * {SHORT}], ',') AS path
FROM ({_slices_sql('path')} dec)"""))
def q_k8p(spark, sf_dir):
    p = LS.chunk_paths(_chunks(spark, sf_dir, SHORT), FXM)
    return p.select("author", "chunk", F.array_join("path", ",").alias("path"))


@register("D5_author_sequence_chunks", wt(f"""
SELECT author, CAST((rn - 1) // {SHORT} AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n_posts,
       string_agg(message_id, ',' ORDER BY rn) AS message_ids
FROM (SELECT *, row_number() OVER (PARTITION BY author ORDER BY ts, message_id) AS rn FROM fx_tech
      WHERE ts IS NOT NULL) GROUP BY author, (rn - 1) // {SHORT}"""))
def q_d5c(spark, sf_dir):
    c = LS.author_sequence_chunks(_tech(spark, sf_dir), ["value"], L=SHORT)
    return c.select("author", "chunk", F.size("posts").cast("long").alias("n_posts"),
                    F.array_join(F.transform("posts", lambda p: p["message_id"]), ",").alias("message_ids"))
