"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. A document of a source with target t and
size s is wanted t/s times (the expected number of copies): the whole part is
allocated for certain, the fraction p is its inclusion probability. With a
uniform u from the hash of its id, the document's rank is

    Q = [u / (1 - u)] / [p / (1 - p)]

and the sample takes documents in the order of Q until the words that remain
of the target are filled (a fixed size, so the mix misses a target by half a
document at most). An optional weight column makes p differ inside a source.

The cut of a source is found without ordering the source in one task: ranks
are counted in ``BUCKETS`` buckets, and only the bucket in which the target is
reached gets ordered. A bucket with more than ``CROWD`` rows (p near 0 or 1
crowds the ranks) is cut into as many buckets again, between its own least and
largest rank. Documents with p = 0 have no part in this. The result is one row
per source (the cut), after which the choice is made row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, carried, join_same, stored, text_of

BUCKETS = 16_384
CROWD = 16_384
WEIGHTS = (1, 2, 3)
MOST = 3


def uniform(id_col: Column) -> Column:
    """52 bits of the id's MD5 as a number in (0, 1)."""
    bits = F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(spark: SparkSession, sizes: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Weights repeat over the sources in code-point order, null last. A target
    stops at ``most`` times its source's size; what is cut off is shared again
    by weight among the others until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranged = (per.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source")
              .sortWithinPartitions("last", "source")
              .withColumn("part", F.spark_partition_id())
              .withColumn("local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ranged = stored(spark, ranged, "mix-sources")
    # one row per partition, never more
    before = ranged.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = ranged.join(before.select("part", "before"), "part").select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), ((F.col("before") + F.col("local")) % len(weights) + 1).cast("int")).alias("w"),
        (F.col("source_size") * most).alias("cap"))
    ranked = stored(spark, ranked, "mix-weights")
    share, full = 0.0, None
    while True:  # each round caps more sources or ends
        capped = F.col("cap") < F.lit(share) * F.col("w")
        row = ranked.agg(F.sum("source_size").alias("all"), F.sum(F.when(capped, F.col("cap"))).alias("cap"),
                         F.sum(F.when(capped, 0).otherwise(F.col("w"))).alias("w"),
                         F.count(F.when(capped, 1)).alias("n")).first()
        if row["n"] == full or not row["w"]:
            break
        full, share = row["n"], ((row["all"] or 0) - (row["cap"] or 0)) / row["w"]
    return ranked.select("source", "source_size", F.least(
        F.lit(share) * F.col("w"), F.col("cap").cast("double")).alias("target"))


def rates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
          text_col: str = "text", weight_col: str | None = None, weights=WEIGHTS, most: float = MOST,
          buckets: int = BUCKETS, crowd: int = CROWD):
    """(sized, cuts). sized: doc_id, source, size, q (weight), u per document;
    cuts: source, source_size, target, unit (copies per weight), the rank below
    which all are taken (low), and the last (rank, id) of its sample."""
    sized = stored(spark, docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_of(text_col)).alias("size"),
        (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("q"),
        uniform(F.col(id_col)).alias("u")), "mix-sizes")
    goal = stored(spark, targets(spark, sized, weights, most), "mix-targets")
    if weight_col:
        mass = sized.groupBy("source").agg(F.sum(F.col("q") * F.col("size")).alias("mass"))
        per = join_same(goal, mass, "source", how="left")
    else:
        per = goal.withColumn("mass", F.col("source_size").cast("double"))
    per = per.withColumn("unit", F.when(F.col("mass") > 0, F.col("target") / F.col("mass")).otherwise(F.lit(0.0))).drop("mass")
    ranked = _ranked(sized, per, most)
    certain = ranked.groupBy("source").agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    rest = join_same(per, certain, "source").withColumn(
        "rest", F.col("target") - F.col("certain"))
    sampled = ranked.filter("p > 0").select("doc_id", "source", "size", "rank")
    edge = rest.select("source", "rest", F.lit(0).cast("long").alias("before"), F.lit(0.0).alias("low"), F.lit(1.0).alias("high"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    while True:  # each round cuts the edge buckets again, until all are small or of one rank
        inside = join_same(sampled, edge, "source").filter("rank BETWEEN low AND high")
        place = F.when(F.col("high") > F.col("low"), (F.col("rank") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)
        loads = inside.groupBy("source", F.floor(place * buckets).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.min("rank").alias("least"), F.max("rank").alias("largest"))
        loads = loads.withColumn("reached", F.sum("words").over(run))
        over = join_same(loads, edge.select("source", "rest", "before"), "source").filter("before + reached > rest")
        first = F.min(F.struct("bucket", (F.col("before") + F.col("reached") - F.col("words")).alias("before"),
                               F.col("least").alias("low"), F.col("largest").alias("high"), "n", "rest")).alias("edge")
        edge = stored(spark, over.groupBy("source").agg(first).select(
            "source", *(F.col(f"edge.{c}").alias(c) for c in ("rest", "before", "low", "high", "n"))), "mix-edges")
        if edge.filter((F.col("n") > crowd) & (F.col("high") > F.col("low"))).isEmpty():
            break
        edge = edge.drop("n")
    inside = join_same(sampled, edge, "source").filter("rank BETWEEN low AND high")
    order = Window.partitionBy("source").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    taken = inside.withColumn("upto", F.col("before") + F.sum("size").over(order)).filter(
        F.col("upto") - F.col("size") / 2.0 <= F.col("rest"))
    last = taken.groupBy("source").agg(F.max(F.struct("rank", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"))).alias("last"))
    cuts = rest.select("source", "source_size", "target", "unit")
    cuts = join_same(cuts, edge.select("source", "low"), "source", how="left")
    cuts = join_same(cuts, last, "source", how="left")
    return sized, stored(spark, cuts, "mix-cuts")


def _ranked(rows: DataFrame, per: DataFrame, most: float) -> DataFrame:
    """Adds whole (certain copies) and rank in [0, 1]: Q / (1 + Q), which orders as Q does."""
    out = join_same(rows, per, "source")
    wanted = F.least(F.col("unit") * F.col("q"), F.lit(float(most)))
    out = out.withColumn("wanted", F.coalesce(wanted, F.lit(0.0)))
    out = out.withColumn("whole", F.floor("wanted")).withColumn("p", F.col("wanted") - F.col("whole"))
    # Q/(1+Q) = u(1-p) / (u(1-p) + (1-u)p); p = 0 gives 1, the last rank
    a, b = F.col("u") * (1 - F.col("p")), (1 - F.col("u")) * F.col("p")
    return out.withColumn("rank", a / (a + b)).drop("wanted")


def chosen(rows: DataFrame, cuts: DataFrame, most: float = MOST) -> DataFrame:
    """Adds copies to rows that have doc_id, source, size, q and u."""
    out = _ranked(rows, cuts, most)
    here = F.struct(F.col("rank"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"))
    sampled = (F.col("p") > 0) & (F.col("low").isNull() | (F.col("rank") < F.col("low")) | F.coalesce(here <= F.col("last"), F.lit(False)))
    return out.withColumn("copies", F.col("whole") + F.coalesce(sampled, F.lit(False)).cast("long")).drop(
        "whole", "p", "rank", "low", "last", "unit")


def mix(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Sizes are words; null and empty texts have none and take none. A null
    source is a source of its own, the last. Rows that repeat an id and text
    are taken or left together. An empty table gives an empty result. Columns
    other than the named ones are not read.
    """
    sized, cuts = rates(spark, docs, **options)
    some = {k: v for k, v in options.items() if k == "most"}
    return chosen(sized, cuts, **some).withColumn("taken", F.col("size") * F.col("copies")).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mixed(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; columns unchanged."""
    _, cuts = rates(spark, docs, id_col=id_col, source_col=source_col, **options)
    weight = options.get("weight_col")
    rows = carried(docs, doc_id=F.col(id_col), source=F.col(source_col), u=uniform(F.col(id_col)),
                   q=F.col(weight).cast("double") if weight else F.lit(1.0))
    some = {k: v for k, v in options.items() if k == "most"}
    return (chosen(rows, cuts, **some).filter("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))
