"""Ingest-side operators: dedup (D1), summaries (D2-D4), recency (B17),
anonymise (B10), cleaning / export projection (B12-B16), keyword hits (C2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions import text as TX


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row per key by ``order`` (which must be unique within a key).

    The least order value per key is a ``min`` over the key and order columns
    alone (partial aggregation collapses a hot key before the shuffle, no body
    takes part); the rows that have it are then found by a semi join.
    """
    keys, order = list(keys), list(order)
    least = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first")).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(f"_first.{o}").alias(f"_o{i}") for i, o in enumerate(order)])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    on += [F.col(o).eqNullSafe(F.col(f"_o{i}")) for i, o in enumerate(order)]
    return df.join(least, on, "left_semi")


def anonymize_record(df: DataFrame, fields: Sequence[str] = ("title", "body", "quoted"),
                     salt: str = D.ANON_SALT, with_user: bool = False,
                     user_col: str = "author") -> DataFrame:
    """B10 (+ B9 opt-in): anonymise the text fields present in ``df``."""
    cols = {f: TX.anonymize_text(f, salt) for f in fields if f in df.columns}
    if with_user and user_col in df.columns:
        cols[user_col] = TX.anonymize_username(user_col, salt)
    return df.withColumns(cols)


def pii_inventory(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per (id, label) with the number of matches (> 0)."""
    counts = TX.pii_counts(text_col)
    arr = F.array(*[F.struct(F.lit(lbl).alias("label"), n.cast("long").alias("n_matches"))
                    for lbl, n in counts])
    return (df.select(id_col, F.inline(arr))
            .where(F.col("n_matches") > 0))


def recent(df: DataFrame, days: int, as_of, ts_col: str = "ts") -> DataFrame:
    """Keep rows with ts >= as_of - days; days = 0 keeps everything."""
    if not days:
        return df
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    return df.where(F.col(ts_col) >= as_of_c - F.make_interval(days=F.lit(days)))


def clean_posts(df: DataFrame, min_body: int = D.MIN_CLEAN_BODY, ts_col: str = "ts") -> DataFrame:
    """Cleaned text columns, date parts, lengths, clean-body filter."""
    cols = {}
    for src, dst in (("body", "body_clean"), ("title", "title_clean"), ("quoted", "quoted_clean")):
        if src in df.columns:
            cols[dst] = TX.clean_text(src)
    out = df
    if "body_clean" in cols and min_body:
        # a filter on the cleaned body would clean it once more, and on posts that an earlier join drops
        long_enough = F.filter(F.array(cols.pop("body_clean")), lambda b: F.length(b) >= min_body)
        out, min_body = df.drop("body_clean").select("*", F.explode(long_enough).alias("body_clean")), 0
    out = out.withColumns(cols) if cols else out
    if ts_col in df.columns:
        out = out.withColumns({k: v.cast("long") for k, v in TX.date_parts(ts_col).items()})
    if "body_clean" in out.columns:
        out = out.withColumn("body_len", F.length("body_clean").cast("long"))
    if "title_clean" in out.columns:
        out = out.withColumn("title_len", F.length("title_clean").cast("long"))
    if "body_len" in out.columns and min_body:
        out = out.where(F.col("body_len") >= min_body)
    return out


EXPORT_COLUMNS = ["message_id", "fingerprint", "thread_id", "parent_id", "author", "ts",
                  "year", "month", "day", "hour", "title_clean", "body_clean", "quoted_clean",
                  "title_len", "body_len", "url"]
EXPORT_STRINGS = ["message_id", "fingerprint", "thread_id", "parent_id", "author",
                  "title_clean", "body_clean", "quoted_clean", "url"]
EXPORT_INTS = ["year", "month", "day", "hour", "title_len", "body_len"]


def export_projection(df: DataFrame) -> DataFrame:
    """Ordered subset of the export columns that exist; '' / 0 fills."""
    present = [c for c in EXPORT_COLUMNS if c in df.columns]
    out = df.select(*present)
    fills = {}
    for c in present:
        if c in EXPORT_STRINGS:
            fills[c] = F.coalesce(F.col(c).cast("string"), F.lit(""))
        elif c in EXPORT_INTS:
            fills[c] = F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long"))
    return out.withColumns(fills)


def ingest_summary(raw: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Raw count, duplicates by content, final count."""
    return raw.agg(F.count(F.lit(1)).alias("raw_count"),
                   F.count_distinct(key).alias("final_count")).select(
        "raw_count", (F.col("raw_count") - F.col("final_count")).alias("duplicate_count"),
        "final_count")


def write_first_per_key(raw: DataFrame, path: str, key: str = "fingerprint", order: Sequence[str] = ("ts", "message_id")) -> DataFrame:
    """D1 and D2 in one job: writes the first row per key and returns the summary.

    The number of copies of a key comes along with its least order value and the
    figures are observed where rows are written, so no second job reads the
    input and a task that is run again counts once. ``order`` is unique within a key.
    """
    order = list(order)
    least = raw.groupBy(F.col(key).alias("_k")).agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    on = raw[key].eqNullSafe(least["_k"]) & F.struct(*[raw[o] for o in order]).eqNullSafe(least["_first"])
    seen = Observation()
    (raw.join(least, on).observe(seen, F.sum("_copies").alias("raw_count"), F.count(F.lit(1)).alias("final_count"))
     .select(*[raw[c] for c in raw.columns]).write.mode("overwrite").parquet(path))
    n, kept = seen.get["raw_count"] or 0, seen.get["final_count"]
    return raw.sparkSession.createDataFrame([(n, n - kept, kept)], "raw_count BIGINT, duplicate_count BIGINT, final_count BIGINT")


def keyword_hits_list(pages: DataFrame, kws: Sequence[str], url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``kws`` is a short list; each page is lowered once and tested against the lowered words."""
    arr = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(k.lower()).alias("low")) for k in kws]) if kws else F.array().cast(
        "array<struct<k:string,low:string>>")
    hits = TX.let(F.lower(F.col(html_col)), lambda page: F.filter(arr, lambda w: F.contains(page, w["low"])))
    return pages.select(F.col(url_col).alias("url"), F.explode(F.transform(hits, lambda w: w["k"])).alias("keyword"))


def page_report(records: DataFrame, hits: DataFrame) -> DataFrame:
    """D3: records per page (as the fixed page key) plus keyword hits per page."""
    per_page = records.groupBy("url").agg(F.count(F.lit(1)).cast("long").alias("n")).select(
        F.lit(D.PAGE_RECORDS_KEY).alias("keyword"), "n", "url")
    per_kw = hits.groupBy("keyword", "url").agg(F.count(F.lit(1)).cast("long").alias("n"))
    return per_page.unionByName(per_kw.select("keyword", "n", "url"))


def keyword_totals(hits: DataFrame) -> DataFrame:
    """Number of pages per keyword."""
    return hits.groupBy("keyword").agg(F.count_distinct("url").cast("long").alias("n_pages"))


def load_keywords(spark, path: str | None = None, skip_comments: bool = True) -> DataFrame:
    """A4: non-blank stripped lines of a keyword file (comment lines skipped by
    default; ``skip_comments=False`` keeps them, as the original did)."""
    if path is None:
        df = spark.createDataFrame([(x,) for x in D.KEYWORD_LINES], "value STRING")
    else:
        df = spark.read.text(path)
    out = df.select(F.trim(F.col("value")).alias("keyword")).where(F.col("keyword") != "")
    if skip_comments:
        out = out.where(~F.col("keyword").startswith("#"))
    return out
