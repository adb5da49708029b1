"""Enrichment: entities (U1/U2 + fixture extractor), entity filters (E9-E13),
term -> technique matching (C1), threat score (B20) and the chain (K14).

Entities are handled in *long* form (one row per entity) so a document with
tens of thousands of entities never becomes one giant array that a single
task must scan quadratically; dedup (E10) is a grouped ``min`` that is
partially aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dictionaries as D
from ..functions import text as TX
from . import terms as TM

ENTITY_STRUCT = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
])
ENTITY_ARRAY = T.ArrayType(ENTITY_STRUCT)
TOKEN_PATTERN = r"[\p{L}\p{N}_]+"
WORD = r"\p{L}\p{N}_"
#: Rows of a dictionary that every task may hold.
FEW_TERMS = 1 << 17

# -- entity sources ---------------------------------------------------------
def token_entities(df: DataFrame, id_col: str, text_col: str, with_span: bool = False) -> DataFrame:
    """Fixture extractor: every word token of the whole text is an entity with a
    deterministic type and confidence. Long form: (id, pos, type, text,
    confidence, start, end)."""
    toks = (_tokens if with_span else _words)(df, id_col, text_col)
    n = F.length("text")
    span = (_start(), (_start() + n).cast("int").alias("end")) if with_span else (
        F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
    return toks.select(
        id_col, F.col("pos").cast("long").alias("pos"),
        F.concat(F.lit("T"), (n % 3).cast("string")).alias("type"),
        "text",
        (((F.ascii("text") * 7 + n * 13) % 101) / 100.0).cast("double").alias("confidence"), *span)


def _words(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, text): one row per word token of the whole text."""
    return df.select(id_col, F.posexplode(F.regexp_extract_all(
        F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN_PATTERN), 0)).alias("pos", "text"))


def _tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_words`` with what ``_start`` counts a token's place from: the few words around it and
    their place. So places are counted for those tokens only that are still there."""
    rows = df.select(id_col, F.lit(0).alias("_at"), F.lit(0).alias("_no"), F.col(text_col).alias("_part"))
    for most in (TX.BLOCK, TX.PIECE):
        rows = rows.select(id_col, "_at", "_no", F.posexplode(TX.runs_of("_part", WORD, most)).alias("_n", "_r")).select(
            id_col, (F.col("_at") + F.col("_r.start")).alias("_at"), (F.col("_no") + F.col("_n") * most).alias("_no"),
            F.col("_r.part").alias("_part"))
    return rows.select(id_col, "_at", "_no", "_part", F.posexplode(F.regexp_extract_all("_part", F.lit(TOKEN_PATTERN), 0)).alias("_i", "text")).select(
        id_col, (F.col("_no") + F.col("_i")).alias("pos"), "text", "_at", "_i", "_part")


def _start() -> Column:
    return (F.col("_at") + TX.start_in("_part", WORD, "_i")).cast("int").alias("start")


def dictionary_entities(df: DataFrame, id_col: str, text_col: str, terms: DataFrame,
                        term_col: str = "term", conf_col: str = "confidence",
                        type_col: str = "type") -> DataFrame:
    """Whole-token dictionary hits as entity spans. ``terms`` (term, type,
    confidence) is joined by equality on the lowered token. Up to FEW_TERMS rows
    go to the tokens as they are made, more are joined by a shuffle. Places are
    counted for the hits."""
    toks = _tokens(df, id_col, text_col).withColumn("_k", F.lower("text"))
    t = terms.select(F.lower(F.col(term_col)).alias("_k"), F.col(type_col).alias("type"),
                     F.col(conf_col).cast("double").alias("confidence"))
    if t.limit(FEW_TERMS + 1).count() <= FEW_TERMS:
        t = F.broadcast(t)
    return toks.join(t, "_k").select(
        id_col, F.col("pos").cast("long").alias("pos"), "type", "text", "confidence", _start()).withColumn(
        "end", (F.col("start") + F.length("text")).cast("int"))


def model_entities(df: DataFrame, id_col: str, text_col: str,
                   extractor_factory: Callable[[], Callable[[str], list[dict]]]) -> DataFrame:
    """User-supplied extractor (e.g. a token-classification model) run in an
    iterator pandas UDF; the model is loaded once per task by the factory.
    Blank text or an extractor failure yields no entities."""
    schema = T.StructType([df.schema[id_col], T.StructField("ents", ENTITY_ARRAY)])

    def run(batches):
        extract = extractor_factory()
        for pdf in batches:
            out = []
            for t in pdf[text_col]:
                if t is None or not str(t).strip():
                    out.append([])
                    continue
                try:
                    out.append([{"type": e["type"], "text": e["text"],
                                 "confidence": float(e["confidence"]),
                                 "start": int(e.get("start", 0)), "end": int(e.get("end", 0))}
                                for e in extract(str(t))])
                except Exception:  # noqa: BLE001 - failure -> [] as specified
                    out.append([])
            yield pd.DataFrame({id_col: pdf[id_col], "ents": out})

    arr = df.select(id_col, text_col).mapInPandas(run, schema)
    return arr.select(id_col, F.posexplode("ents").alias("pos", "e")).select(
        id_col, F.col("pos").cast("long").alias("pos"), "e.*")


# -- E9 / E10 ---------------------------------------------------------------
def confident(ents: DataFrame, threshold: float = D.ENTITY_MIN_CONFIDENCE) -> DataFrame:
    """Round confidence to 4 places, keep >= threshold."""
    return (ents.withColumn("confidence", F.round("confidence", 4))
            .where(F.col("confidence") >= threshold))


def dedup_entities(ents: DataFrame, id_col: str) -> DataFrame:
    """First entity per (id, type, lower(text)), in position order."""
    k = F.lower("text")
    first = ents.groupBy(id_col, "type", k.alias("_lk")).agg(
        F.min(F.struct("pos", "text", "confidence", "start", "end")).alias("_e"))
    return first.select(id_col, "_e.pos", "type", "_e.text", "_e.confidence", "_e.start", "_e.end")


def entity_array(ents: DataFrame, id_col: str, with_span: bool = False) -> DataFrame:
    """Long entities -> ``ARRAY<STRUCT>`` per id, in position order."""
    fields = ["type", "text", "confidence"] + (["start", "end"] if with_span else [])
    return ents.groupBy(id_col).agg(F.array_sort(F.collect_list(
        F.struct("pos", *fields))).alias("_a")).select(
        id_col, F.transform("_a", lambda e: F.struct(*[e[f].alias(f) for f in fields])).alias("entities"))


# -- E11 --------------------------------------------------------------------
STORED_ENTITY = "array<struct<type:string,text:string,confidence:double>>"


def encode_entities(c) -> Column:
    return F.to_json(F.transform(TX._c(c), lambda e: F.struct(
        e["type"].alias("type"), e["text"].alias("text"), e["confidence"].alias("confidence"))))


def decode_entities(c) -> Column:
    return F.from_json(TX._c(c), STORED_ENTITY)


# -- C1 ---------------------------------------------------------------------
def term_table(spark: SparkSession, terms: dict[str, list[str]] | None = None) -> DataFrame:
    """Dictionary as rows ``(idx, term, technique)`` in file order (A5)."""
    terms = terms if terms is not None else D.load_terms_json()
    rows = [(i, k, t) for i, (k, v) in enumerate(terms.items()) for t in v]
    return spark.createDataFrame(rows, "idx INT, term STRING, technique STRING")


def _term_keys(df: DataFrame, terms, whole_word: bool = False) -> DataFrame:
    """Prepared keys of a term table (idx, term, technique), of a dictionary, or of the packaged one."""
    rows = terms if isinstance(terms, DataFrame) else term_table(df.sparkSession, terms)
    return TM.prepared_keys(rows, whole_word)


def match_techniques(df: DataFrame, text_col: str, terms: DataFrame | dict[str, list[str]] | None = None,
                     out_col: str = "techniques", emit_keys: bool = False,
                     whole_word: bool = False) -> DataFrame:
    """Techniques of every dictionary key found in the text.

    ``terms`` is a term table (idx, term, technique), which may be large; a
    small dictionary is accepted too. One predicate covers the original's three
    tests for non-empty keys: ``contains(squash(text), squash(key))``. Result:
    sorted distinct array; null and empty texts have none.
    ``whole_word=True`` (not in the original; its substring test lets ``rat``
    hit inside ``separate``) instead requires the normalised key to appear
    as whole words of the normalised text. ``emit_keys=True`` gives the keys
    that occur instead of their techniques.
    """
    def prepare(text):
        return F.concat(F.lit(" "), TX.normalize_term(text), F.lit(" ")) if whole_word else TX.squash_term(text)

    out = TM.with_found(df, F.col(text_col), prepare, _term_keys(df, terms, whole_word), "__hits")
    found = F.sort_array(F.transform("__hits", lambda x: x["key"])) if emit_keys else TM.values_of("__hits")
    return out.withColumn(out_col, found).drop("__hits")


def with_safe_entities(df: DataFrame, stored_col: str) -> DataFrame:
    """``entities`` decoded from stored JSON, with the default [] where there is
    none, and ``quarantined``: true where something is stored that cannot be
    decoded. The rows to look at are ``df.where("quarantined")``; none is dropped."""
    decoded = df.withColumn("_decoded", decode_entities(stored_col))
    return decoded.withColumn("quarantined", F.col(stored_col).isNotNull() & F.col("_decoded").isNull()).withColumn(
        "entities", F.coalesce("_decoded", F.array().cast(STORED_ENTITY))).drop("_decoded")


# -- B20 --------------------------------------------------------------------
def conf_units(c) -> Column:
    """Confidence in 1e-4 units (confidences carry 4 decimals after E9)."""
    return F.round(TX._c(c) * 10000).cast("long")


def threat_score(sum_conf_units, n_entities, n_techniques) -> Column:
    """round(0.7*mean(conf) + 0.3*min(n_tech/10, 1), 4); both empty -> 0.0.

    Evaluated exactly in integers (confidence sum in 1e-4 units, half-up
    rounding of the rational), so no engine's float summation order can move
    a result across a rounding boundary.
    """
    n = TX._c(n_entities).cast("long")
    su = F.coalesce(TX._c(sum_conf_units), F.lit(0)).cast("long")
    mn = F.least(TX._c(n_techniques).cast("long"), F.lit(10))
    num = F.lit(7) * su + F.lit(3000) * F.greatest(n, F.lit(1)) * mn
    den = F.lit(10) * F.greatest(n, F.lit(1))
    p, d = F.lit(2) * num + den, F.lit(2) * den
    units = ((p - p % d) / d).cast("long")  # exact: p - p % d is a multiple of d
    units = F.when(n == 0, F.lit(300) * mn).otherwise(units)
    score = units.cast("double") / 10000.0
    return F.when((n == 0) & (TX._c(n_techniques) == 0), F.lit(0.0)).otherwise(score)


# -- K14 --------------------------------------------------------------------
def enrich_posts(posts: DataFrame, terms: dict[str, list[str]] | None = None,
                 id_col: str = "message_id", entities: DataFrame | None = None,
                 threshold: float = D.ENTITY_MIN_CONFIDENCE) -> DataFrame:
    """Body fallback -> entities -> E9 -> E10 -> C1 -> B20 -> E12.

    C1 runs on the *distinct* entity texts only (the vocabulary), then joins
    back, so the 270-key scan is paid once per distinct word, not per token.
    Posts without entities keep defaults (E13): [], [], 0.0, 0, 0.
    """
    base = posts.withColumn("_content", TX.body_fallback(
        F.col("body_clean") if "body_clean" in posts.columns else F.lit(None),
        F.col("body") if "body" in posts.columns else F.lit(None)))
    ents = entities if entities is not None else token_entities(base, id_col, "_content")
    ents = dedup_entities(confident(ents, threshold), id_col)
    vocab = ents.select("text").distinct()
    vocab = match_techniques(vocab, "text", terms, "techs")
    ents = ents.join(vocab, "text", "left")
    per = ents.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n_entities"),
        F.sum(conf_units("confidence")).alias("_sumu"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("techs")))).alias("techniques"),
        F.array_sort(F.collect_list(F.struct("pos", "type", "text", "confidence"))).alias("_e"))
    out = base.drop("_content").join(per, id_col, "left")
    out = out.withColumns({
        "entities": F.coalesce(F.transform("_e", lambda e: F.struct(
            e["type"].alias("type"), e["text"].alias("text"), e["confidence"].alias("confidence"))),
            F.array().cast(STORED_ENTITY)),
        "techniques": F.coalesce("techniques", F.array().cast("array<string>")),
        "n_entities": F.coalesce("n_entities", F.lit(0)).cast("long"),
    })
    out = out.withColumn("n_techniques", F.size("techniques").cast("long"))
    out = out.withColumn("threat_score", threat_score("_sumu", "n_entities", "n_techniques"))
    return out.drop("_e", "_sumu")


# -- row-local enrichment (no shuffle) -----------------------------------------
def _token_entity(t, i):
    n = F.length(t)
    return F.struct(i.cast("long").alias("pos"), F.concat(F.lit("T"), (n % 3).cast("string")).alias("type"),
                    t.alias("text"),
                    F.round(((F.ascii(t) * 7 + n * 13) % 101) / 100.0, 4).cast("double").alias("confidence"))


def local_entities(text, threshold: float = D.ENTITY_MIN_CONFIDENCE) -> Column:
    """Fixture extractor + E9 + E10 inside the row: every word token of the
    whole text, confidence >= threshold, first entity per (type, lower(text))
    in position order. The dedup sorts the document's own entities by
    (key, position) and keeps each key's first; no shuffle, O(n log n) per
    document."""
    toks = F.regexp_extract_all(F.coalesce(TX._c(text), F.lit("")), F.lit(TOKEN_PATTERN), 0)
    ents = F.filter(F.transform(toks, _token_entity), lambda e: e["confidence"] >= threshold)
    keyed = F.sort_array(F.transform(ents, lambda e: F.struct(
        e["type"].alias("k1"), F.lower(e["text"]).alias("k2"), e["pos"].alias("pos"), e.alias("e"))))

    def firsts(srt):
        keep = F.filter(srt, lambda x, i: (i == 0) | (srt[i - 1]["k1"] != x["k1"]) | (srt[i - 1]["k2"] != x["k2"]))
        return F.transform(F.sort_array(F.transform(keep, lambda x: F.struct(x["pos"].alias("pos"), x["e"].alias("e")))),
                           lambda x: x["e"])
    return TX.let(keyed, firsts)


SEP = "\u0001"


def enrich_local(posts: DataFrame, terms: dict[str, list[str]] | None = None,
                 id_col: str = "message_id", threshold: float = D.ENTITY_MIN_CONFIDENCE) -> DataFrame:
    """K14 with the fixture extractor: B18 body fallback -> entities -> E9 -> E10 -> C1 -> B20 -> E12.

    Entities are made and filtered inside the row. An entity is a run of its
    post's text, so the keys it can hold are among those of the whole text:
    these come from the term index, and the few candidates are then looked for
    in the entity texts. (Keys never hold the separator, so the joined texts
    contain a key where one of them does.)
    """
    base = posts.withColumn("_content", TX.body_fallback(
        F.col("body_clean") if "body_clean" in posts.columns else F.lit(None),
        F.col("body") if "body" in posts.columns else F.lit(None)))
    base = TM.with_found(base, F.col("_content"), TX.squash_term, _term_keys(posts, terms), "_cand")
    e = base.withColumn("entities", local_entities("_content", threshold)).drop("_content")
    joined = F.array_join(F.transform("entities", lambda x: TX.squash_term(x["text"])), SEP)
    held = TX.let(joined, lambda j: F.filter("_cand", lambda c: F.contains(j, c["key"])))
    e = e.withColumn("techniques", TM.values_of(F.when(F.size("_cand") == 0, F.col("_cand")).otherwise(held))).drop("_cand")
    e = e.withColumns({
        "n_entities": F.size("entities").cast("long"),
        "n_techniques": F.size("techniques").cast("long"),
        "_sumu": F.aggregate("entities", F.lit(0).cast("long"), lambda a, x: a + conf_units(x["confidence"])),
    })
    return e.withColumn("threat_score", threat_score("_sumu", "n_entities", "n_techniques")).drop("_sumu")
