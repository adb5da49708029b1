"""Sources and sinks (A1-A12) as Spark readers / writers with fixed schemas.

Every writer targets a folder (one part file per task), never a single local
file, so writes scale with the cluster; ``scratch_dir`` places throwaway
output under the session's shared checkpoint folder, never a machine-local
temporary path.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import dictionaries as D
from ..operators.evaluate import class_metrics, global_metrics
from ..operators.sequences import count_metadata
from ..session import ensure_checkpoint_dir

# Raw post record: the original's ten string fields, English names.
RAW_FIELDS = ["message_id", "fingerprint", "thread_id", "parent_id", "author", "ts",
              "title", "body", "quoted", "url"]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_FIELDS])
# Spark's CSV writer trims values by default; text must round-trip unchanged.
KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scratch_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/seqintel-out/{name}-{uuid.uuid4().hex[:12]}"


# A1 -------------------------------------------------------------------------
def read_posts_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Header CSV with quoted multi-line bodies; explicit schema (no inference)."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("mode", "PERMISSIVE").options(**KEEP_SPACES).csv(path))


CORRUPT = "corrupt_record"


def split_posts_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, header: bool = True,
                    quarantine: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(posts, quarantined): records that fit the schema, and the text of those that don't.

    A record with too few or too many fields, or whose value cannot be cast,
    is not a post with nulls: it goes whole, as it stands in the file, to
    ``quarantined`` (corrupt_record). Each record is in exactly one of the two.
    A quote that is never closed takes the rest of its file into one record.
    The file is parsed once: both parts come from one stored table, kept in
    ``quarantine`` if that is given. An empty file gives two empty frames.
    """
    flagged = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    rows = (spark.read.schema(flagged).option("header", header).option("multiLine", True).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
            .options(**KEEP_SPACES).csv(path))
    kept = quarantine or scratch_dir(spark, "posts-checked")
    rows.withColumn("broken", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("broken").parquet(kept)
    rows = spark.read.schema(T.StructType([*flagged.fields, T.StructField("broken", T.BooleanType())])).parquet(kept)
    return rows.where("NOT broken").select(*schema.names), rows.where("broken").select(CORRUPT)


# A2 / A3 --------------------------------------------------------------------
def _append(rows: DataFrame, path: str, batch: str | None):
    """A writer that appends to ``path``, or, for a named batch, replaces what that batch has
    written there before (folder ``batch=<name>``): a job run twice appends once. Readers that
    give a schema see the same columns either way."""
    return rows.write.mode("append") if batch is None else (
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").partitionBy("batch").option("partitionOverwriteMode", "dynamic"))


def append_posts_json(df: DataFrame, path: str, batch: str | None = None) -> None:
    """One JSON object per line, UTF-8, appended as new part files; a named ``batch`` once."""
    _append(df.select(*[c for c in RAW_FIELDS if c in df.columns]), path, batch).json(path)


def append_posts_csv(df: DataFrame, path: str, batch: str | None = None) -> None:
    """Fixed field order, header in each part file, appended; a named ``batch`` once."""
    cols = [F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string").alias(c)
            for c in RAW_FIELDS]
    _append(df.select(*cols), path, batch).option("header", True).option("escape", '"').options(**KEEP_SPACES).csv(path)


# A5 -------------------------------------------------------------------------
def load_term_dictionary(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Term dictionary JSON (``{term: [technique, ...]}``) -> rows (idx, term,
    technique), file order kept. ``path`` may lie in any store that Spark
    reads; without one the packaged dictionary is taken. A missing file or one
    that holds no object raises."""
    if path is not None:
        whole = spark.read.text(path, wholetext=True).select(
            F.posexplode(F.from_json("value", "map<string,array<string>>", {"mode": "FAILFAST"})).alias("idx", "term", "techniques"))
        if whole.isEmpty():
            raise ValueError(f"term dictionary {path!r} is empty or not an object")
        return whole.select("idx", "term", F.explode("techniques").alias("technique"))
    terms = D.load_terms_json()
    rows = [(i, k, t) for i, (k, v) in enumerate(terms.items()) for t in v]
    return spark.createDataFrame(rows, "idx INT, term STRING, technique STRING")


# A6 -------------------------------------------------------------------------
PHASE_FILE_SCHEMA = T.StructType([
    T.StructField("metadata", T.StructType([T.StructField("fases", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("nombre", T.StringType()),
        T.StructField("descripcion", T.StringType())])))])),
    T.StructField("mapeo_tecnicas", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("fase_por_defecto", T.IntegerType()),
])


def load_phase_dictionary(spark: SparkSession, path: str | None = None
                          ) -> tuple[DataFrame, DataFrame, int]:
    """Phase file -> (phase(phase_id, name, description),
    technique_phase(technique, phase_id), default). Without a path the fixed
    values are used. A malformed file raises."""
    if path is None:
        return D.phase_df(spark), D.technique_phase_df(spark), D.DEFAULT_PHASE
    raw = spark.read.schema(PHASE_FILE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    phases = raw.select(F.inline("metadata.fases")).select(
        F.col("id").alias("phase_id"), F.col("nombre").alias("name"), F.col("descripcion").alias("description"))
    tp = raw.select(F.explode("mapeo_tecnicas").alias("technique", "phase_id"))
    default = raw.select(F.coalesce("fase_por_defecto", F.lit(D.DEFAULT_PHASE))).first()[0]
    return phases, tp, int(default)


def phase_dictionary_json() -> str:
    """Serialise the fixed phase values in the phase-file layout."""
    return json.dumps({"metadata": {"fases": [{"id": i, "nombre": n, "descripcion": d}
                                              for i, n, d in D.PHASES]},
                       "mapeo_tecnicas": D.TECHNIQUE_PHASE, "fase_por_defecto": D.DEFAULT_PHASE},
                      ensure_ascii=False)


# A7 / A8 --------------------------------------------------------------------
def write_sequences(seqs: DataFrame, path: str, min_len: int = D.MIN_SEQUENCE) -> None:
    """Per-author post lists as Parquet (arrays stay typed), only authors with
    at least ``min_len`` posts (D6), and beside them the metadata of D7."""
    seqs.write.mode("overwrite").parquet(f"{path}/sequences")
    done = seqs.sparkSession.read.parquet(f"{path}/sequences")
    count_metadata(done.select("author", F.size("posts").alias("n_posts")), min_len).write.mode("overwrite").parquet(f"{path}/metadata")
    done.where(F.size("posts") >= min_len).write.mode("overwrite").parquet(f"{path}/valid")


def sequences_as_json(seqs: DataFrame) -> DataFrame:
    """Text export: one JSON document per author."""
    return seqs.select("author", F.to_json("posts").alias("posts_json"))


def read_sequences_json(df: DataFrame, col: str = "posts_json") -> DataFrame:
    """Decode the text export; accepts ``techniques`` or, when that is
    missing or empty, ``mitre_techniques`` per post."""
    alt = ("array<struct<message_id:string,ts:timestamp,threat_score:double,"
           "entities:array<struct<type:string,text:string,confidence:double>>,"
           "techniques:array<string>,mitre_techniques:array<string>>>")
    parsed = F.from_json(F.col(col), alt)
    posts = F.transform(parsed, lambda p: F.struct(
        p["message_id"].alias("message_id"), p["ts"].alias("ts"), p["threat_score"].alias("threat_score"),
        F.coalesce(p["entities"], F.array().cast("array<struct<type:string,text:string,confidence:double>>")).alias("entities"),
        F.coalesce(F.when(F.size(p["techniques"]) > 0, p["techniques"]), p["mitre_techniques"],
                   F.array().cast("array<string>")).alias("techniques")))
    return df.select("author", posts.alias("posts"))


# The sequence file: one JSON object. Fixed names of its format.
SEQUENCE_META = {"total_authors": "total_autores", "valid_authors": "secuencias_validas", "min_len": "longitud_minima_secuencia"}
SEQUENCE_FILE = """
    metadata STRUCT<total_autores: BIGINT, secuencias_validas: BIGINT, longitud_minima_secuencia: BIGINT, generado_en: STRING>,
    sequences MAP<STRING, ARRAY<STRUCT<id_mensaje: STRING, fecha_hora: STRING, puntuacion_amenaza: DOUBLE,
        entidades: ARRAY<STRUCT<type: STRING, text: STRING, confidence: DOUBLE>>,
        tecnicas_mitre: ARRAY<STRING>, mitre_techniques: ARRAY<STRING>>>>"""
NO_ENTITIES = "array<struct<type:string,text:string,confidence:double>>"


def write_sequence_files(seqs: DataFrame, path: str, min_len: int = D.MIN_SEQUENCE, files: int = 16) -> None:
    """A7 in the file form ``{"metadata": {...}, "sequences": {author: [post, ...]}}``.

    Authors with at least ``min_len`` posts are dealt over ``files`` files by hash, each a whole
    object with the metadata of all; files=1 gives the single file. An object is written as
    lines (head, one line per author, foot), so none is built in memory; only one author's posts are.
    ``seqs`` is (author, posts) as D5 gives it, ``entities`` in the posts if there are any.
    """
    fields = [f.name for f in seqs.schema["posts"].dataType.elementType]
    none = F.array().cast(NO_ENTITIES)

    def post(p):
        entities = F.transform(p["entities"], lambda e: F.struct(e["type"].alias("type"), e["text"].alias("text"), e["confidence"].cast(
            "double").alias("confidence"))) if "entities" in fields else none
        return F.struct(p["message_id"].cast("string").alias("id_mensaje"), F.date_format(p["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fecha_hora"),
                        p["threat_score"].alias("puntuacion_amenaza"), F.coalesce(entities, none).alias("entidades"),
                        F.coalesce(p["techniques"], F.array().cast("array<string>")).alias("tecnicas_mitre"))

    author = F.coalesce(F.col("author").cast("string"), F.lit(D.UNKNOWN_AUTHOR))
    item = F.to_json(F.create_map(author, F.transform("posts", post)), {"ignoreNullFields": "false"})
    lines = seqs.where(F.size("posts") >= min_len).select(
        F.pmod(F.xxhash64(author), F.lit(files)).cast("int").alias("part"), F.lit(1).alias("place"), author.alias("author"),
        F.substr(item, F.lit(2), F.char_length(item) - 2).alias("line"))
    meta = count_metadata(seqs.select("author", F.size("posts").alias("n_posts")), min_len)
    head = F.concat(F.lit('{"metadata": '), F.to_json(F.struct(
        *[F.col(ours).alias(name) for ours, name in SEQUENCE_META.items()],
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generado_en"))), F.lit(', "sequences": {'))
    ends = F.inline(F.array(F.struct(F.lit(0).alias("place"), F.lit("").alias("author"), head.alias("line")),
                            F.struct(F.lit(2).alias("place"), F.lit("").alias("author"), F.lit("}}").alias("line"))))
    frame = meta.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(files - 1)))).select("part", ends)
    nth = F.row_number().over(Window.partitionBy("part").orderBy("place", "author"))
    comma = F.when((F.col("place") == 1) & (nth > 2), ", ").otherwise("")
    (lines.unionByName(frame).select("part", "place", "author", F.concat(comma, "line").alias("line"))
     .sortWithinPartitions("part", "place", "author").select("part", "line")
     .write.mode("overwrite").partitionBy("part").text(path))


def read_sequence_files(spark: SparkSession, path: str) -> DataFrame:
    """(author, posts, metadata) from one such file or a folder of them, wherever they were
    written. A post's techniques are ``tecnicas_mitre`` or, when that is missing or empty,
    ``mitre_techniques``; missing entities are none; a time that cannot be read is null. A file
    that holds no such object raises. Each file is read by one task."""
    data = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(
        F.from_json("value", SEQUENCE_FILE, {"mode": "FAILFAST"}).alias("o"))
    none = F.array().cast("array<string>")
    authors = data.select(F.struct(*[F.col(f"o.metadata.{name}").alias(ours) for ours, name in SEQUENCE_META.items()]).alias("metadata"),
                          F.explode("o.sequences").alias("author", "found"))
    return authors.select("author", F.transform("found", lambda p: F.struct(
        F.try_to_timestamp(p["fecha_hora"]).alias("ts"), p["id_mensaje"].alias("message_id"), p["puntuacion_amenaza"].alias("threat_score"),
        F.coalesce(p["entidades"], F.array().cast(NO_ENTITIES)).alias("entities"),
        F.coalesce(F.when(F.size(p["tecnicas_mitre"]) > 0, p["tecnicas_mitre"]), p["mitre_techniques"], none).alias("techniques"))).alias("posts"), "metadata")


# A10 / A11 / A12 ------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').options(**KEEP_SPACES).csv(path)


EVALUATION_PARTS = {
    "metrics_by_phase": "phase_name STRING, phase_id INT, precision DOUBLE, recall DOUBLE, f1 DOUBLE, support BIGINT",
    "metrics_global": "total BIGINT, accuracy DOUBLE, precision_macro DOUBLE, recall_macro DOUBLE, f1_macro DOUBLE, "
                      "precision_weighted DOUBLE, recall_weighted DOUBLE, f1_weighted DOUBLE",
    "predictions": "author STRING, truth INT, pred INT, confidence DOUBLE, correct BOOLEAN",
}


def write_evaluation(pred: DataFrame, path: str) -> None:
    """The evaluation report as three CSV folders: global metrics, metrics per phase and one
    row per author. Predictions are written first and the metrics come from what was written, so
    nothing is predicted twice. Without predictions there is nothing to report: a ValueError."""
    spark = pred.sparkSession
    write_csv(pred.select("author", "truth", "pred", "confidence", "correct"), f"{path}/predictions")
    done = read_evaluation(spark, path, "predictions")
    if done.isEmpty():
        raise ValueError("no predictions to evaluate")
    per = class_metrics(done)
    write_csv(per.select("phase_name", "phase_id", "precision", "recall", "f1", "support"), f"{path}/metrics_by_phase")
    write_csv(global_metrics(per).select(*[c.split()[0] for c in EVALUATION_PARTS["metrics_global"].split(", ")]), f"{path}/metrics_global")


def read_evaluation(spark: SparkSession, path: str, part: str) -> DataFrame:
    """One part of the report (a key of EVALUATION_PARTS) with its types."""
    return (spark.read.schema(EVALUATION_PARTS[part]).option("header", True).option("escape", '"')
            .options(**KEEP_SPACES).csv(f"{path}/{part}"))


def keyword_report_lines(hits: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """``keyword | url`` lines and ``keyword | n | url`` lines."""
    a = hits.select(F.concat_ws(" | ", "keyword", "url").alias("value"))
    if counts is None:
        return a
    b = counts.select(F.concat_ws(" | ", "keyword", F.col("n").cast("string"), "url").alias("value"))
    return a.unionByName(b)


def write_text(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)
