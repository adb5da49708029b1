"""Helpers that the corpus operators share: reading, words, stored tables, components."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure, ensure_checkpoint_dir

#: ASCII white space only: words are runs of anything else.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. A text without multi-byte characters
    takes the built-in ``lower``, which is the same there and much faster."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the cluster's shared folder and reads it
    back: lineage ends there, a lost executor costs nothing that was written."""
    configure(spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """Like ``stored``, as a table bucketed by ``key``, for a ``df`` that a join or
    a grouping by ``key`` has just made: later joins on it do not shuffle its rows.
    The name is dropped once the frame is planned (the caller's database keeps no
    table); the files stay in the shared folder, where the frame reads them."""
    configure(spark)
    name = f"bucketed_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.bucketBy(n, key).format("parquet")
     .option("path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def carried(docs: DataFrame, **columns: Column) -> DataFrame:
    """``docs`` as one struct ``row`` beside ``columns``, so no name of its own can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in columns.items()])


def join_same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Joins on null-safe equality of ``keys``; they appear once, as in ``left``."""
    other = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return left.join(other, on, how).drop(*(f"__{k}" for k in keys))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b of one orderable type).

    Returns (node, root): root is the smallest node of the component. Large-star
    and small-star steps alternate; each round hangs every node below the
    smallest neighbour it knows, so chains of n nodes take about log n rounds
    and no component is ever gathered in one task. Nodes without an edge are
    not listed. Each round ends in a stored table.
    """
    def lowest(of):
        return of.groupBy("a").agg(F.min("b").alias("low"))

    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(spark, pairs.distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (both.join(lowest(both).withColumn("low", F.least("a", "low")), "a")
                 .filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        small = large.join(lowest(large), "a")
        nxt = stored(spark, small.select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
                     .unionByName(small.select("a", F.col("low").alias("b"))).distinct(), "edges")
        after = _mark(nxt)
        now = nxt
        if after == mark:
            break
        mark = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table (one small row)."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
