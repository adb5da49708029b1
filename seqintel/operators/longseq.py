"""Skew-proof sequences: positions, fixed-size chunks, chunked HMM passes.

One author may own a third of all posts, so nothing here gathers an
author's posts in one task or one row:

* ``positions`` (E1 at scale): a range-partitioned global sort splits a hot
  author over many partitions; ``monotonically_increasing_id`` after the
  in-partition sort numbers rows in order, and a small per-(partition, author)
  table of counts gives each slice its offset. The sorted frame is
  checkpointed so the ids are stable across the two uses.
* ``chunk_sequences``: positions -> arrays of at most ``L`` phases per
  (author, chunk). Every downstream array is bounded by ``L``.
* Training (K6), decoding (K8) and likelihoods (K7) over chunks go through the
  tree scan of :mod:`seqintel.operators.scan`; results equal the
  whole-sequence computation (tested).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir
from . import scan as SC

CHUNK = 1024


# -- E1 at scale ---------------------------------------------------------------
def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos_col: str = "pos",
              n_partitions: int | None = None) -> DataFrame:
    """1-based position of each row inside its key group by ``order``
    (``order`` must be unique within a key)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys, order = list(keys), list(order)
    n = n_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    r = (df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    g = r.groupBy("_pid", *keys).agg(F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n").checkpoint(eager=True)
    out = join_null_safe(r, g, ["_pid", *keys])
    return out.withColumn(pos_col, (F.col("_off") + F.col("_mid") - F.col("_m0") + 1).cast("long")) \
        .drop("_pid", "_mid", "_m0", "_off")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a NULL key equals a NULL key; the size of either
    side is Spark's to judge."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other, on).drop(*[f"_r_{k}" for k in keys])


def chunk_sequences(df: DataFrame, key: str, pos_col: str, value_col: str, L: int = CHUNK) -> DataFrame:
    """(key, chunk, seq ARRAY<INT> of <= L values in position order, n_chunks)."""
    c = df.select(key, ((F.col(pos_col) - 1) / L).cast("long").alias("chunk"),
                  F.struct(F.col(pos_col).alias("p"), F.col(value_col).cast("int").alias("v")).alias("_e"))
    g = c.groupBy(key, "chunk").agg(F.array_sort(F.collect_list("_e")).alias("_s"))
    n = g.groupBy(key).agg((F.max("chunk") + 1).alias("n_chunks"))
    return g.join(n, key).select(key, "chunk", F.transform("_s", lambda e: e["v"]).alias("seq"), "n_chunks")


def phase_chunks(posts: DataFrame, author_col: str = "author", ts_col: str = "ts", id_col: str = "message_id",
                 tech_col: str = "techniques", include_without_techniques: bool = False,
                 L: int = CHUNK) -> DataFrame:
    """D8 in chunked form: posts -> phase per post (B21) -> skew-proof
    positions -> (author, chunk, seq, n_chunks) with arrays of at most L."""
    from .. import dictionaries as D
    from .sequences import phase_of
    p = posts.where(F.col(ts_col).isNotNull()).withColumn(
        author_col, F.coalesce(F.col(author_col), F.lit(D.UNKNOWN_AUTHOR)))
    if not include_without_techniques:
        p = p.where(F.coalesce(F.size(tech_col), F.lit(0)) > 0)
    p = p.select(author_col, ts_col, id_col,
                 phase_of(F.coalesce(F.col(tech_col), F.array().cast("array<string>"))).alias("phase"))
    pos = positions(p, [author_col], [ts_col, id_col])
    # the chunk table feeds several passes (fit, decode, hold-out): write it
    # once to the checkpoint folder (it is the phases only, far smaller than
    # the posts) so each pass starts from it and lineage stays short
    return chunk_sequences(pos, author_col, "pos", "phase", L).checkpoint(eager=True)


def _params(chunks: DataFrame, m):
    return chunks.sparkSession.sparkContext.broadcast((np.array(m.start), np.array(m.trans), np.array(m.emit)))


def most_chunks(chunks: DataFrame) -> int:
    return int(chunks.agg(F.coalesce(F.max("n_chunks"), F.lit(1))).first()[0])


def with_boundaries(rows: DataFrame, key: str, params, size: int, levels: int, largest: bool = False) -> DataFrame:
    """``rows`` (key, chunk, seq, n_chunks, ...) with the boundaries of each chunk; a
    sequence in one chunk has none, so without longer ones there is nothing to join."""
    if not levels:
        return rows.withColumns({"before": F.lit(None).cast("array<double>"), "after": F.lit(None).cast("array<double>"),
                                 "score": F.lit(None).cast("double")})
    bounds = SC.boundaries(SC.leaves(rows.where(F.col("n_chunks") > 1), key, params, largest), key, size, levels, largest)
    return rows.join(bounds, [key, "chunk"], "left")


def chunk_paths(chunks: DataFrame, m, key: str = "author") -> DataFrame:
    """K8 long form: (author, chunk, path, logp, seq) per chunk; logp is the
    sequence's, on its chunk 0."""
    params = _params(chunks, m)
    rows = with_boundaries(chunks.select(key, "chunk", "seq", "n_chunks"), key, params, m.n_states, SC.depth(most_chunks(chunks)), True)
    return SC.paths(rows, key, params)


def author_sequence_chunks(posts: DataFrame, fields: Sequence[str], author_col: str = "author",
                           ts_col: str = "ts", id_col: str = "message_id", L: int = CHUNK) -> DataFrame:
    """D5 in chunked form: per (author, chunk) the post structs in time order,
    at most L per row (NULL times dropped)."""
    from .. import dictionaries as D
    p = posts.where(F.col(ts_col).isNotNull()).withColumn(
        author_col, F.coalesce(F.col(author_col), F.lit(D.UNKNOWN_AUTHOR)))
    pos = positions(p, [author_col], [ts_col, id_col])
    st = F.struct(F.col("pos"), F.col(ts_col).alias("ts"), F.col(id_col).alias("message_id"),
                  *[F.col(f) for f in fields if f not in (ts_col, id_col)])
    g = (pos.withColumn("chunk", ((F.col("pos") - 1) / L).cast("long"))
         .groupBy(author_col, "chunk").agg(F.array_sort(F.collect_list(st)).alias("posts")))
    n = g.groupBy(author_col).agg((F.max("chunk") + 1).alias("n_chunks"))
    return g.join(n, author_col)


def decode_chunks(chunks: DataFrame, m, key: str = "author", L: int = CHUNK) -> DataFrame:
    """K8 + K9 + D9 over chunked sequences, per author:
    (author, n_posts, last_state, dominant_state, logp). Dominant state: per-chunk counts and first positions,
    summed per author (tie -> first seen). ``L`` is the chunk length the
    chunks were built with (it orders first occurrences across chunks)."""
    S = m.n_states
    paths = chunk_paths(chunks, m, key)
    L = F.lit(L).cast("long")
    per_state = paths.select(key, "chunk", F.size("seq").alias("n"), F.element_at("path", -1).alias("last"),
                             F.col("logp"),
                             F.transform(F.sequence(F.lit(0), F.lit(S - 1)), lambda s: F.struct(
                                 F.size(F.filter("path", lambda x: x == s)).alias("cnt"),
                                 (F.col("chunk") * L + F.array_position("path", s)).alias("first"))).alias("st"))
    agg = per_state.groupBy(key).agg(
        F.sum("n").cast("long").alias("n_posts"),
        F.max_by("last", "chunk").alias("last_state"),
        F.max(F.when(F.col("chunk") == 0, F.col("logp"))).alias("logp"),
        *[F.sum(F.col("st")[s]["cnt"]).alias(f"c{s}") for s in range(S)],
        *[F.min(F.when(F.col("st")[s]["cnt"] > 0, F.col("st")[s]["first"])).alias(f"f{s}") for s in range(S)])
    cand = F.array(*[F.when(F.col(f"c{s}") > 0, F.struct(F.col(f"c{s}").alias("n"),
                                                           (-F.col(f"f{s}")).alias("nf"),
                                                           F.lit(s).alias("s"))) for s in range(S)])
    return agg.select(key, "n_posts", F.col("last_state").cast("int"),
                      F.array_max(F.filter(cand, lambda c: c.isNotNull()))["s"].cast("int").alias("dominant_state"),
                      "logp")


def loglik_chunks(chunks: DataFrame, m, key: str = "author") -> DataFrame:
    """K7 over chunked sequences: (author, loglik), from the tree of their chunk
    matrices (no author gathered whole)."""
    found = SC.boundaries(SC.leaves(chunks, key, _params(chunks, m)), key, m.n_states, SC.depth(most_chunks(chunks)))
    return found.where(F.col("chunk") == 0).select(key, F.col("score").alias("loglik"))


def analyze_chunks(chunks: DataFrame, m, key: str = "author", L: int = CHUNK,
                   min_len: int = 2) -> DataFrame:
    """K10 over chunked sequences: per author n_posts, last and dominant
    state, predicted phase, confidence (unrounded) and status; the chunked
    decode supplies the states and the next-phase table the prediction.
    Sequences shorter than ``min_len`` get the fixed 'too short' result (K10
    uses 2; plain prediction, K9 / K12, uses 1)."""
    from .. import dictionaries as D
    from .hmm import _lit_mat, phase_names
    d = decode_chunks(chunks, m, key, L)
    nxt = _lit_mat(m.next_table())
    short = F.col("n_posts") < min_len
    d = d.withColumn("_p", nxt[F.col("last_state")])
    pred = (F.array_position("_p", F.array_max("_p")) - 1).cast("int")
    return d.select(
        key, "n_posts",
        F.when(~short, F.col("dominant_state")).alias("dominant_state"),
        F.when(~short, F.col("last_state")).alias("last_state"),
        F.when(~short, pred).alias("next_phase_id"),
        F.when(short, F.lit(D.SHORT_SEQUENCE_NAME)).otherwise(phase_names()[pred]).alias("next_phase_name"),
        F.when(short, F.lit(0.0)).otherwise(F.array_max("_p")).alias("confidence"),
        F.when(~short, F.col("_p")).alias("probs"),
        F.when(short, F.lit(D.SHORT_SEQUENCE_STATUS)).otherwise(F.lit("OK")).alias("status"))


def hold_out_chunks(chunks: DataFrame, key: str = "author") -> tuple[DataFrame, DataFrame]:
    """E2 on chunked sequences: (truth per author, history chunks). The last
    phase is cut from the last chunk (dropped when it held only that phase);
    authors with fewer than 2 phases are left out."""
    last = (chunks.where(F.col("chunk") == F.col("n_chunks") - 1)
            .select(key, F.element_at("seq", -1).alias("truth"), F.size("seq").alias("_ls"),
                    (F.col("chunk") * 0 + F.col("n_chunks")).alias("_nc")))
    h = chunks.join(last, key)
    h = h.where((F.col("_nc") > 1) | (F.col("_ls") >= 2))
    is_last = F.col("chunk") == F.col("n_chunks") - 1
    hist = (h.withColumn("seq", F.when(is_last, F.slice("seq", 1, F.size("seq") - 1)).otherwise(F.col("seq")))
            .where(F.size("seq") > 0)
            .withColumn("n_chunks", F.when(F.col("_ls") == 1, F.col("n_chunks") - 1).otherwise(F.col("n_chunks"))))
    truth = last.where((F.col("_nc") > 1) | (F.col("_ls") >= 2)).select(key, "truth")
    return truth, hist.select(key, "chunk", "seq", "n_chunks")


def predictions_chunks(chunks: DataFrame, m, key: str = "author", L: int = CHUNK) -> DataFrame:
    """K12 on chunked sequences: predicted vs true last phase per author."""
    from .hmm import phase_names
    truth, hist = hold_out_chunks(chunks, key)
    a = analyze_chunks(hist, m, key, L, min_len=1)
    names = phase_names()
    return truth.join(a, key).select(
        key, F.col("truth").cast("int"),
        F.coalesce(names[F.col("truth")], F.concat(F.lit("Fase "), F.col("truth").cast("string"))).alias("truth_name"),
        F.col("next_phase_id").alias("pred"), F.col("next_phase_name").alias("pred_name"), "confidence",
        (F.col("truth") == F.col("next_phase_id")).alias("correct"))
