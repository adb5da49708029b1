"""Fixture views over the driver tables (FIXTURES.md section 3).

Each view is built from a whole table with built-in expressions only; the
same view is written as a DuckDB CTE in :mod:`seqintel.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as TX
from ..session import table


def fx_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts; copies of a text share author and fingerprint.

    ``author = min(source) over (partition by text)`` is computed as a
    pre-aggregated ``groupBy(text hash)`` joined back on the hash, so a hot
    text collapses map-side instead of landing in one window task.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    docs = docs.withColumn("_th", F.sha2(F.col("text"), 256))
    authors = docs.groupBy("_th").agg(F.min("source").alias("author"))
    d = docs.join(authors, "_th", "left")
    posts = d.select(
        F.concat(F.lit("msg_"), F.col("doc_id").cast("string")).alias("message_id"),
        F.concat(F.lit("thread_"), F.col("lang")).alias("thread_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.col("author"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_dt_interval(mins=F.col("doc_id").cast("int"))).alias("ts"),
        F.substring("text", 1, 40).alias("title"),
        F.col("text").alias("body"),
        F.lit(None).cast("string").alias("quoted"),
        F.concat(F.lit("http://"), F.col("source"), F.lit(".onion/thread/"),
                 F.floor(F.col("doc_id") / 20).cast("string")).alias("url"),
        F.col("doc_id"),
    )
    return posts.withColumn(
        "fingerprint", TX.content_fingerprint("body", "title", "author", "thread_id"))


def fx_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as replies: thread = conv_id, parent = previous turn."""
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.col("conv_id").cast("string").alias("url"),
        F.col("turn").cast("string").alias("raw_id"),
        F.when(F.col("turn") > 0, (F.col("turn") - 1).cast("string")).alias("parent_raw"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
    )


def fx_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a fetch log: host per user, status and redirect by event type."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    host = F.concat(F.lit("http://h"), F.col("user_id").cast("string"), F.lit(".onion"))
    req = F.concat(host, F.lit("/thread/"), k.cast("string"))
    status = (F.when(F.col("event_type") == "error", 503)
              .when(F.col("event_type") == "signup", 403)
              .when((F.col("event_type") == "view") & (k % 10 == 0), 404)
              .otherwise(200))
    final = F.when((F.col("event_type") == "click") & (k % 25 == 0),
                   F.concat(host, F.lit("/login"))).otherwise(req)
    return e.select("event_id", "ts", host.alias("host"), req.alias("requested_url"),
                    final.alias("final_url"), status.cast("int").alias("status"))
