"""Structured Streaming ingest.

* S1 resumable ingest: ``readStream`` over a landing folder with a fixed
  schema, ``checkpointLocation`` for exactly-once progress, and
  ``trigger(availableNow=True)`` so a run drains what has landed and stops;
  re-running resumes where the checkpoint left off (the original's
  pending/visited file).
* S2 incremental dedup, exact variant (default): the state store keeps the first
  copy of each fingerprint (``min_by`` in update mode; copies of a batch are
  combined before the shuffle, so a hot fingerprint is one row per task). A
  batch writes the fingerprints it touched to a folder of its own and never
  reads the sink. A replayed batch replaces its folder; the read side takes a
  key's row from its last batch, so restarts and any file order give the same
  table. The state holds one post per fingerprint for ever (set the RocksDB state
  store for large inputs).
  Bounded variant: ``dropDuplicatesWithinWatermark`` on the arrival time
  (state is bounded; copies that arrive further apart than the delay are admitted).
* S3 incremental page report: stateful streaming ``groupBy(url).count()`` in
  update mode; every update is kept under its batch id and the read side
  keeps the latest count per page. The keyword half counts distinct records per
  (keyword, page) the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _write_batch(batch: DataFrame, batch_id: int, sink: str) -> None:
    """A batch that is run again after a failure replaces its own folder."""
    batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


def landing_stream(spark: SparkSession, landing: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """All landed files per micro-batch unless a number is asked for."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(landing)


def exact_dedup_sink(stream: DataFrame, sink: str, checkpoint: str, key: str = "fingerprint",
                     order: Sequence[str] = ("ts", "message_id")) -> StreamingQuery:
    """S1 + S2 (exact): the first copy of each key by ``order``, kept up in the state store.
    Null keys are one key; nulls in ``order`` come first. Columns keep their names and order."""
    whole = F.struct(*[F.col(f"`{c}`") for c in stream.columns])
    firsts = stream.groupBy(F.col(key).alias("__key")).agg(F.min_by(whole, F.struct(*order)).alias("row")).select("row.*")
    return (firsts.writeStream.outputMode("update").foreachBatch(lambda batch, n: _write_batch(batch, n, sink))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_dedup_sink(spark: SparkSession, sink: str, key: str = "fingerprint") -> DataFrame:
    """The first copy of each key: its row in the last batch that touched it."""
    rows = spark.read.parquet(sink)
    last = rows.groupBy(F.col(key).alias("__key")).agg(F.max("batch_id").alias("__batch"))
    return rows.join(last, rows[key].eqNullSafe(last["__key"]) & (rows["batch_id"] == last["__batch"]), "left_semi").drop("batch_id")


def watermark_dedup(stream: DataFrame, sink: str, checkpoint: str, key: str = "fingerprint",
                    delay: str = "1 hour") -> StreamingQuery:
    """S2 (bounded state): copies that arrive within ``delay`` of each other are dropped.

    The watermark is on the arrival time (the time of the micro-batch), which
    never runs backwards, so no row is ever late and none is lost, whatever
    times the posts carry and in whatever order files land."""
    d = (stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", delay)
         .dropDuplicatesWithinWatermark([key]).drop("_arrived"))
    return (d.writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def page_counts_stream(stream: DataFrame, sink: str, checkpoint: str, key: str = "url") -> StreamingQuery:
    """S3: running count per page (state store), updates kept per batch."""
    counts = stream.groupBy(key).agg(F.count(F.lit(1)).alias("n"))

    return (counts.writeStream.outputMode("update").foreachBatch(lambda batch, n: _write_batch(batch, n, sink))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_page_counts(spark: SparkSession, sink: str, key: str = "url") -> DataFrame:
    s = spark.read.parquet(sink)
    return s.groupBy(key).agg(F.max_by("n", "batch_id").cast("long").alias("n"))


def keyword_counts_stream(stream: DataFrame, sink: str, checkpoint: str, keywords: Sequence[str], record_key: str,
                          url: str = "url", text: str = "body", key: str = "fingerprint") -> StreamingQuery:
    """S3: running number of distinct records per (keyword, page), and of all its records under
    ``record_key`` (D3). A record counts once per page, whatever number of copies arrive and in
    which batches. Keywords are parameters, matched without regard to case; null texts hold none,
    null pages are a page of their own. Updates are appended with their batch id.
    Texts are searched where they are read; only the words found take part in the dedup."""
    listed = F.array(*[F.lit(k) for k in keywords]) if keywords else F.array().cast("array<string>")
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    named = F.concat(F.array(F.lit(record_key)), F.filter(listed, lambda k: F.contains(F.col("__low"), F.lower(k))))
    found = stream.select(url, key, lowered.alias("__low")).select(url, key, named.alias("__named"))
    counts = (found.dropDuplicates([url, key]).select(url, F.explode("__named").alias("keyword"))
              .groupBy("keyword", url).agg(F.count(F.lit(1)).alias("n")))

    return (counts.writeStream.outputMode("update").foreachBatch(lambda batch, n: _write_batch(batch, n, sink))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_keyword_counts(spark: SparkSession, sink: str, url: str = "url") -> DataFrame:
    """Latest number per (keyword, page)."""
    s = spark.read.parquet(sink)
    return s.groupBy("keyword", url).agg(F.max_by("n", "batch_id").cast("long").alias("n"))
