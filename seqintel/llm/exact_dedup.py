"""Exact dedup by an extendible-hash index kept in shared files.

Rows are hashed (XXH64 of the normalised text) and the index is a set of
buckets, each the owner of one range of hash values:

* *directory*: bucket loads are counted over the leading ``LEAF_BITS`` bits of
  the hash; a prefix that holds more than ``capacity`` distinct hashes is split
  on its next bit (the directory doubles) until each bucket fits. Copies share
  a hash, so a hot text never causes a split. The directory has at most
  2**LEAF_BITS rows whatever the input, which bounds its broadcast.
* *owner tasks*: entries are grouped by (bucket, hash, text bytes). Spark
  combines copies before the shuffle, so a text that is a third of all rows
  arrives as one entry per map task, and grouping on the text itself is the
  byte comparison. Different texts of one hash become a chain in the bucket.
* the entries are written as Parquet, sorted in each bucket by (hash, chain).

Documents then look up their entry by (hash, SHA-256). If two texts should
ever agree in both, the job fails with a message rather than merge them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ascii_lower, carried, join_same, stored, text_of

#: Directory bits at most; beyond 2**16 full buckets a bucket just grows (still right).
LEAF_BITS = 16
CAPACITY = 16_384


def hash_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """(doc_id, rid, key, sha, norm). ``key_bits`` under 64 weakens the hash (tests of chains)."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("rid"),
        ascii_lower(text_of(text_col)).alias("norm"),
    ).withColumn("key", _top(F.xxhash64("norm"), key_bits)).withColumn("sha", F.unhex(F.sha2("norm", 256)))


def _top(key: Column, bits: int) -> Column:
    return key if bits >= 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - bits), 64 - bits)


def directory(keys: DataFrame, capacity: int = CAPACITY, leaf_bits: int = LEAF_BITS) -> DataFrame:
    """(leaf, depth): the local depth of the bucket that owns each used leaf prefix.

    The load of a prefix falls as it gets longer, so a leaf's depth is the
    number of its prefixes that are overfull: as many splits lie above it.
    """
    leaf = F.shiftrightunsigned("key", 64 - leaf_bits)
    loads = keys.select("key").distinct().groupBy(leaf.alias("leaf")).agg(F.count("*").alias("n"))
    levels = loads.select("leaf", "n", F.explode(F.sequence(F.lit(0), F.lit(leaf_bits))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(leaf, {leaf_bits} - depth)"))
    overfull = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("load")).filter(F.col("load") > capacity)
    # at most 2**(leaf_bits + 1) prefixes are broadcast
    split = levels.join(F.broadcast(overfull), ["depth", "prefix"], "left")
    return split.groupBy("leaf").agg(
        F.least(F.count("load"), F.lit(leaf_bits)).cast("int").alias("depth"))


def build_index(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, leaf_bits: int = LEAF_BITS, key_bits: int = 64):
    """Writes the index; returns (rows, index).

    rows: (doc_id, rid, key, sha), one per document. index: (depth, prefix, key,
    chain, sha, keep_id, keep_rid, group_size), one per distinct text.
    """
    rows = stored(spark, hash_rows(docs, id_col, text_col, key_bits).drop("norm"), "dedup-rows")
    owners = F.broadcast(stored(spark, directory(rows, capacity, leaf_bits), "dedup-directory"))
    # the row id comes from the stored rows, so it is looked up and not numbered anew
    texts = hash_rows(docs, id_col, text_col, key_bits).drop("rid")
    bucket = (texts.withColumn("leaf", F.shiftrightunsigned("key", 64 - leaf_bits)).join(owners, "leaf")
              .withColumn("prefix", F.expr(f"shiftright(leaf, {leaf_bits} - depth)")))
    entries = bucket.groupBy("depth", "prefix", "key", "sha", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).drop("norm")
    entries = entries.repartition("depth", "prefix")  # one owner task for each bucket's range of hashes
    chain = Window.partitionBy("depth", "prefix", "key").orderBy("sha")
    index = entries.withColumn("chain", F.row_number().over(chain)).withColumn(
        "clash", F.lag("sha").over(chain).eqNullSafe(F.col("sha")))
    return rows, stored(spark, index, "dedup-index")


def dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, sha (binary), chain.

    Equal are texts that agree after lower-casing A-Z; null is empty. The row
    with the largest doc_id stays; a null id counts as the smallest. Of rows
    that repeat the winning id and its text exactly one stays. An empty table
    gives an empty result; other columns of ``docs`` are not read.
    """
    rows, index = build_index(spark, docs, id_col, text_col, **options)
    # of rows that repeat an id and its text, the first is told apart by its row id
    again = (rows.groupBy("key", "sha", "doc_id").agg(F.count("*").alias("n"), F.min("rid").alias("first"))
             .filter("n > 1").select("key", "sha", F.col("doc_id").alias("keep_id"), "first"))
    found = rows.join(index.select("key", "sha", "keep_id", "group_size", "chain", "clash"), ["key", "sha"])
    found = join_same(found, again, "key", "sha", "keep_id", how="left")
    sure = F.when(F.col("clash"), F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.lit(True))
    return found.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id"))
         & (F.col("first").isNull() | (F.col("first") == F.col("rid"))) & sure.cast("boolean")).alias("kept"),
        "sha", "chain")


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the dropped rows, columns unchanged.

    Kept rows are found again by (id, SHA-256); where several input rows have
    both in common (repeated rows), one of them is kept.
    """
    kept = dedup(spark, docs, id_col, text_col, **options).groupBy("doc_id", "sha").agg(
        F.max("kept").alias("kept"), F.count("*").alias("n")).filter("kept").select("doc_id", "sha", "n")
    kept = stored(spark, kept, "dedup-kept")
    rows = carried(docs, doc_id=F.col(id_col).cast("long"), sha=F.unhex(F.sha2(ascii_lower(text_of(text_col)), 256)))
    out = join_same(rows, kept, "doc_id", "sha", how="left_semi")
    repeated = kept.filter("n > 1")
    if not repeated.isEmpty():  # rows that repeat an id and its text
        out = join_same(rows, kept.filter("n = 1"), "doc_id", "sha", how="left_semi").unionByName(
            join_same(rows, repeated, "doc_id", "sha", how="left_semi").dropDuplicates(["doc_id", "sha"]))
    return out.select("row.*")
