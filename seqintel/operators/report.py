"""Analyst tables: value counts (D10), profile (D16), headline figures (D17),
top-N (E4), argmax (E5), critical authors (E6), lookup (E7), per-author phase
distribution (K11), state profiles (K15), fetch outcome (B22), failure
streaks (E3), persistence class (B23), name fallback (B24)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import dictionaries as D
from . import hmm as H


def value_counts(df: DataFrame, col: str, total: str = "rows") -> DataFrame:
    """N and n / total * 100 per value. ``total='rows'`` divides by all
    rows (as the report does, NULLs included); ``'values'`` by non-NULL ones.
    The total is a scalar subquery, so no task sees all values."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    denom = df.agg(F.count(F.lit(1) if total == "rows" else F.col(col))).scalar()
    return (g.withColumn("_t", denom).where(F.col(col).isNotNull())
            .select(col, F.col("n").cast("long"), (F.col("n") / F.col("_t") * 100.0).alias("pct")))


def profile(df: DataFrame) -> DataFrame:
    """Non-NULL count and type per column (one aggregate pass)."""
    counts = df.agg(*[F.count(F.col(c)).cast("long").alias(c) for c in df.columns])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null"),
                               F.lit(types[c]).alias("type")) for c in df.columns])
    return counts.select(F.inline(stack))


def write_profiled(df: DataFrame, path: str) -> DataFrame:
    """D16 of a table while it is written: the counts are observed in the job that writes."""
    seen, fields = Observation(), df.schema.fields
    df.observe(seen, *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)]).write.mode("overwrite").parquet(path)
    rows = [(f.name, seen.get[f"c{i}"], f.dataType.simpleString()) for i, f in enumerate(fields)]
    return df.sparkSession.createDataFrame(rows, "column STRING, non_null BIGINT, type STRING")


def _headline_columns(critical: Sequence[str]) -> list[Column]:
    return [F.count(F.lit(1)).cast("long").alias("n_authors"),
            F.avg("confidence").alias("mean_confidence"),
            F.count_if(F.col("status") == "OK").cast("long").alias("n_ok"),
            F.count_if(F.col("status") != "OK").cast("long").alias("n_short"),
            F.count_if(F.col("next_phase_name").isin(list(critical))).cast("long").alias("n_critical")]


def headline(report: DataFrame, n_states: int,
             critical: Sequence[str] = D.CRITICAL_PHASE_NAMES) -> DataFrame:
    """States, authors, mean confidence, OK / too-short authors, critical authors."""
    return report.agg(F.lit(n_states).cast("long").alias("n_states"), *_headline_columns(critical))


def write_with_headline(report: DataFrame, path: str, n_states: int,
                        critical: Sequence[str] = D.CRITICAL_PHASE_NAMES) -> DataFrame:
    """D17 of a report while it is written: the figures are observed in the job that writes."""
    seen = Observation()
    report.observe(seen, *_headline_columns(critical)).write.mode("overwrite").parquet(path)
    names = ["n_authors", "mean_confidence", "n_ok", "n_short", "n_critical"]
    return report.sparkSession.createDataFrame([(n_states, *[seen.get[n] for n in names])], (
        "n_states BIGINT, n_authors BIGINT, mean_confidence DOUBLE, n_ok BIGINT, n_short BIGINT, n_critical BIGINT"))


def top_n(df: DataFrame, by: str, n: int = 10, tiebreak: str | None = None) -> DataFrame:
    """The n largest by ``by`` (ties broken by ``tiebreak`` ascending):
    a TakeOrderedAndProject, i.e. a bounded heap per task."""
    order = [F.col(by).desc_nulls_last()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    return df.orderBy(*order).limit(n)


def argmax_index(values) -> Column:
    """E5: 0-based index of the first maximum of an array."""
    v = F.col(values) if isinstance(values, str) else values
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def critical_authors(report: DataFrame, names: Sequence[str] = D.CRITICAL_PHASE_NAMES) -> DataFrame:
    """Authors whose predicted phase name is in the critical set."""
    return report.where(F.col("next_phase_name").isin(list(names)))


def author_lookup(report: DataFrame, author: str) -> DataFrame:
    """One author's report row."""
    return report.where(F.col("author") == F.lit(author))


def author_list(report: DataFrame) -> DataFrame:
    """Sorted distinct author list."""
    return report.select("author").distinct().orderBy("author")


def phase_distribution(report: DataFrame, next_frame: DataFrame) -> DataFrame:
    """Per author, the next-phase distribution from the *dominant* state
    (C5 table joined on state; model-sized, broadcast)."""
    nf = next_frame.select(F.col("last_state").alias("_from"), "phase", "p")
    return (report.where(F.col("dominant_state").isNotNull())
            .join(F.broadcast(nf), F.col("dominant_state") == F.col("_from"))
            .select("author", "phase", "p"))


def persistence_class(p) -> Column:
    """> 0.7 very, > 0.4 moderate, else transient."""
    p = F.col(p) if isinstance(p, str) else p
    out = F.lit(D.TRANSIENT_LABEL)
    for bound, label in reversed(D.PERSISTENCE_CLASSES):
        out = F.when(p > bound, F.lit(label)).otherwise(out)
    return out


def phase_name(phase_id, names: DataFrame | None = None) -> Column:
    """Phase name by id, else ``Fase n``."""
    pid = F.col(phase_id) if isinstance(phase_id, str) else phase_id
    arr = H.phase_names()
    return F.coalesce(arr[pid], F.concat(F.lit("Fase "), pid.cast("string")))


def state_profiles(start: DataFrame, trans: DataFrame, emit: DataFrame) -> DataFrame:
    """Per state start p, persistence and its class, dominant phase
    (first max of the emission row) with its p and name. Model-sized joins."""
    diag = trans.where(F.col("i") == F.col("j")).select("i", F.col("p").alias("persistence"))
    dom = emit.groupBy("i").agg(F.max_by(F.struct("p", (-F.col("k")).alias("nk")),
                                         F.struct("p", (-F.col("k")).alias("nk"))).alias("_m"))
    dom = dom.select("i", (-F.col("_m.nk")).cast("int").alias("dominant_phase"),
                     F.col("_m.p").alias("dominant_p"))
    out = (start.select("i", F.col("p").alias("start_p"))
           .join(diag, "i").join(dom, "i"))
    return out.select(F.col("i").cast("int").alias("state"), "start_p", "persistence",
                      persistence_class("persistence").alias("persistence_class"),
                      "dominant_phase", "dominant_p",
                      phase_name("dominant_phase").alias("dominant_phase_name"))


# scheme://authority/path split as urllib's urlparse does for absolute URLs
URL_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def fetch_outcome(status, requested, final) -> Column:
    """``blocked`` on 403 or a same-host redirect from a thread-like path
    to a landing page; ``server_error`` >= 500; ``http_error`` != 200; ``ok``."""
    st = F.col(status) if isinstance(status, str) else status
    rq = F.col(requested) if isinstance(requested, str) else requested
    fn = F.col(final) if isinstance(final, str) else final
    rq_host = F.regexp_extract(rq, URL_AUTHORITY, 1)
    fn_host = F.regexp_extract(fn, URL_AUTHORITY, 1)
    rq_path = F.lower(F.regexp_extract(rq, URL_PATH, 1))
    fn_path = F.lower(F.regexp_extract(fn, URL_PATH, 1))
    words = None
    for w in D.BAN_REQUEST_WORDS:
        c = rq_path.contains(w)
        words = c if words is None else (words | c)
    redirect_ban = (rq != fn) & (rq_host == fn_host) & words & fn_path.isin(D.BAN_LANDING_PATHS)
    return (F.when((st == 403) | redirect_ban, F.lit("blocked"))
            .when(st >= 500, F.lit("server_error"))
            .when(st != 200, F.lit("http_error"))
            .otherwise(F.lit("ok")))


def failure_streaks(log: DataFrame, threshold: int = 10, order: Sequence[str] = ("ts", "event_id"),
                    partition: Sequence[str] = (), outcome_col: str = "outcome") -> DataFrame:
    """Consecutive failures; ``ok`` resets, ``blocked`` is neutral; each
    time a streak reaches the threshold a pause is flagged and counting
    restarts. Gaps-and-islands: a running count of ``ok`` names the island,
    a running count of failures inside it gives the streak length.

    With ``partition=()`` the log is one crawl (a single ordered stream, as in
    the original); pass a host column to evaluate hosts independently.
    """
    part = list(partition)
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    fail = F.col(outcome_col).isin("server_error", "http_error")
    df = log.withColumn("_island", F.sum(F.when(F.col(outcome_col) == "ok", 1).otherwise(0)).over(w))
    w2 = Window.partitionBy(*part, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_nfail", F.sum(F.when(fail, 1).otherwise(0)).over(w2))
    n = F.col("_nfail")
    streak = (F.when(F.col(outcome_col) == "ok", 0)
              .when(fail, ((n - 1) % threshold) + 1)
              .otherwise(n % threshold))
    return (df.withColumn("streak", streak.cast("long"))
            .withColumn("pause", fail & (n % threshold == 0))
            .drop("_island", "_nfail"))


def failure_streaks_scan(log: DataFrame, threshold: int = 10, order: Sequence[str] = ("ts", "event_id"),
                         keys: Sequence[str] = ("host",), outcome_col: str = "outcome",
                         n_partitions: int | None = None) -> DataFrame:
    """E3 without a per-key window: equal to :func:`failure_streaks` but a
    hot host is split over many tasks.

    Running counts are prefix sums: a range-partitioned sort splits each key
    into slices; running values inside a slice (window over (slice, key), so
    bounded by one partition) plus a carry from earlier slices (a tiny
    per-(slice, key) table) give the global running values. The failures
    since the last ``ok`` are F(t) - F(last ok), where F is the running count
    of failures (non-decreasing, so F(last ok) is a running max)."""
    from ..session import ensure_checkpoint_dir
    from .longseq import join_null_safe
    spark = log.sparkSession
    ensure_checkpoint_dir(spark)
    keys, order = list(keys), list(order)
    n = n_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    fail = F.col(outcome_col).isin("server_error", "http_error")
    ok = F.col(outcome_col) == "ok"
    r = (log.withColumns({"_f": fail.cast("long"), "_ok": ok})
         .repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
         .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True))
    w = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("_fl", F.sum("_f").over(w))
    r = r.withColumn("_okl", F.max(F.when(F.col("_ok"), F.col("_fl"))).over(w))
    g = r.groupBy("_pid", *keys).agg(F.sum("_f").alias("_sf"), F.max(F.when(F.col("_ok"), F.col("_fl"))).alias("_mo"))
    wg = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_foff", F.coalesce(F.sum("_sf").over(wg), F.lit(0)))
    g = g.withColumn("_carry", F.max(F.col("_foff") + F.col("_mo")).over(wg)).drop("_sf", "_mo")
    j = join_null_safe(r, g, ["_pid", *keys])
    ftot = F.col("_fl") + F.col("_foff")
    last_ok = F.greatest(F.coalesce(F.col("_okl") + F.col("_foff"), F.lit(0)),
                         F.coalesce(F.col("_carry"), F.lit(0)))
    nf = ftot - last_ok
    streak = (F.when(F.col(outcome_col) == "ok", 0)
              .when(fail, ((nf - 1) % threshold) + 1)
              .otherwise(nf % threshold))
    return (j.withColumn("streak", streak.cast("long"))
            .withColumn("pause", fail & (nf % threshold == 0))
            .drop("_f", "_ok", "_pid", "_fl", "_okl", "_foff", "_carry"))
