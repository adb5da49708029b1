"""Hold-out evaluation: author split (K4), prediction vs truth (K12), the
evaluation job (K13) and its statistics (D11-D15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dictionaries as D
from . import hmm as H
from . import longseq as LS
from .sequences import hold_out_last

N_BUCKET_HEX = 4  # 65,536 hash buckets for the exact split threshold


def split_key(author_col: str, seed: int):
    return F.sha1(F.concat(F.lit(f"{seed}:"), F.col(author_col).cast("string")))


def split_authors(seqs: DataFrame, ratio: float = D.TEST_RATIO, seed: int = D.SEED,
                  author_col: str = "author") -> tuple[DataFrame, DataFrame]:
    """K4: seeded shuffle of authors by ``sha1(seed:author)``; the first
    ``n_test = min(max(1, int(n * ratio)), n - 1)`` go to test.

    Exact without a global sort: counts per hash bucket (65,536 rows at most)
    locate the bucket holding the n_test-th author; only that bucket is
    ordered to find the threshold hash. Authors are never split.
    """
    h = seqs.withColumn("_h", split_key(author_col, seed))
    # in the chunked form each author counts once, on chunk 0
    one = h.where(F.col("chunk") == 0) if "n_chunks" in seqs.columns else h
    n = one.count()
    n_test = min(max(1, int(n * ratio)), n - 1)
    if n_test <= 0:
        return h.drop("_h"), h.where(F.lit(False)).drop("_h")
    b = F.substring("_h", 1, N_BUCKET_HEX)
    counts = sorted((r[0], r[1]) for r in one.groupBy(b.alias("b")).count().collect())
    seen = 0
    for bucket, c in counts:
        if seen + c >= n_test:
            need = n_test - seen
            inside = (one.where(b == bucket).select("_h").orderBy("_h").limit(need)
                      .agg(F.max("_h")).first()[0])
            break
        seen += c
    test = h.where(F.col("_h") <= F.lit(inside)).drop("_h")
    train = h.where(F.col("_h") > F.lit(inside)).drop("_h")
    return train, test


def predictions(test: DataFrame, m: H.HMM, author_col: str = "author",
                seq_col: str = "seq") -> DataFrame:
    """Hide the last phase, predict it from the rest, compare."""
    ho = hold_out_last(test, seq_col)
    ho = H.with_prediction(ho, "history", m, "_")
    names = H.phase_names()
    truth_name = F.coalesce(names[F.col("truth")], F.concat(F.lit("Fase "), F.col("truth").cast("string")))
    return ho.where(F.col("_next_phase_id").isNotNull()).select(
        author_col, F.col(seq_col), "history",
        F.col("truth").cast("int"), truth_name.alias("truth_name"),
        F.col("_next_phase_id").alias("pred"), F.col("_next_phase_name").alias("pred_name"),
        F.col("_confidence").alias("confidence"),
        (F.col("truth") == F.col("_next_phase_id")).alias("correct"))


def confidence_summary(pred: DataFrame, col: str = "confidence") -> DataFrame:
    """Mean, min, max, median, population std, N."""
    return pred.agg(F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
                    F.median(col).alias("median"), F.stddev_pop(col).alias("std"),
                    F.count(col).cast("long").alias("n"))


def confidence_histogram(pred: DataFrame, col: str = "confidence", bins: int = 20) -> DataFrame:
    """``bins`` equal bins between min and max (max falls in the last
    bin; all-equal values use the numpy convention: range +-0.5, middle bin).
    One row per bin, empty bins included."""
    spark = pred.sparkSession
    r = pred.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    b = F.least(F.lit(bins), (F.floor((F.col(col) - F.lit(lo)) / F.lit(hi - lo) * bins) + 1).cast("int"))
    counted = pred.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counted, "bin", "left")
            .select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def confusion(pred: DataFrame, n_phases: int = len(D.PHASES)) -> DataFrame:
    """Truth x predicted counts, all phases present, zeros filled."""
    spark = pred.sparkSession
    ids = list(range(n_phases))
    pv = (pred.where(F.col("truth").between(0, n_phases - 1) & F.col("pred").between(0, n_phases - 1))
          .groupBy("truth").pivot("pred", ids).count())
    allp = spark.range(n_phases).select(F.col("id").cast("int").alias("truth"))
    out = allp.join(pv, "truth", "left")
    return out.select("truth", *[F.coalesce(F.col(str(i)), F.lit(0)).cast("long").alias(f"p{i}")
                                 for i in ids])


def class_metrics(pred: DataFrame, n_phases: int = len(D.PHASES)) -> DataFrame:
    """Per phase tp, fp, fn, support; precision, recall, F1 (0/0 -> 0),
    rounded to 4. Phases without rows are present with zeros."""
    spark = pred.sparkSession
    ph = spark.createDataFrame([(i, n) for i, n, _ in D.PHASES[:n_phases]], "phase_id INT, phase_name STRING")
    # one pass over the predictions: each row counts once for its true phase
    # (support, tp) and once for its predicted phase (npred)
    both = pred.select(F.explode(F.array(
        F.struct(F.col("truth").cast("int").alias("phase_id"), F.lit(1).alias("s"),
                 (F.col("truth") == F.col("pred")).cast("int").alias("t"), F.lit(0).alias("p")),
        F.struct(F.col("pred").cast("int").alias("phase_id"), F.lit(0).alias("s"), F.lit(0).alias("t"),
                 F.lit(1).alias("p")))).alias("x")).select("x.*")
    c = both.groupBy("phase_id").agg(F.sum("t").alias("tp"), F.sum("s").alias("support"),
                                      F.sum("p").alias("npred"))
    j = F.broadcast(ph).join(c, "phase_id", "left").fillna(0, ["tp", "support", "npred"])
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    j = j.withColumns({"_p": prec, "_r": rec})
    f1 = F.when(F.col("_p") + F.col("_r") > 0, 2 * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))).otherwise(0.0)
    j = j.withColumn("_f", f1)
    return j.select("phase_name", "phase_id", F.col("tp").cast("long"),
                    (F.col("npred") - F.col("tp")).cast("long").alias("fp"),
                    (F.col("support") - F.col("tp")).cast("long").alias("fn"),
                    F.col("support").cast("long"),
                    F.round("_p", 4).alias("precision"), F.round("_r", 4).alias("recall"),
                    F.round("_f", 4).alias("f1"),
                    F.col("_p").alias("precision_raw"), F.col("_r").alias("recall_raw"),
                    F.col("_f").alias("f1_raw"))


def global_metrics(per_class: DataFrame) -> DataFrame:
    """D15 from the per-class table alone: accuracy = sum(tp) / sum(support);
    macro = mean of the *rounded* class values over classes with support;
    weighted = sum(raw metric * support) / sum(support)."""
    sup = F.col("support") > 0
    tot = F.nullif(F.sum("support"), F.lit(0))
    return per_class.agg(
        F.sum("support").cast("long").alias("total"),
        F.round(F.coalesce(F.sum("tp") / tot, F.lit(0.0)), 4).alias("accuracy"),
        *[F.round(F.coalesce(F.avg(F.when(sup, F.col(k))), F.lit(0.0)), 4).alias(f"{k}_macro")
          for k in ("precision", "recall", "f1")],
        *[F.round(F.coalesce(F.sum(F.col(f"{k}_raw") * F.col("support")) / tot, F.lit(0.0)), 4)
          .alias(f"{k}_weighted") for k in ("precision", "recall", "f1")])


def evaluate(seqs: DataFrame, ratio: float = D.TEST_RATIO, seed: int = D.SEED,
             fit_on: str = "train", model: H.HMM | None = None, chunk_length: int = LS.CHUNK, **fit_kw) -> dict[str, DataFrame]:
    """Split -> fit (on train by default; ``fit_on='all'`` reproduces the
    original's behaviour) -> predictions -> statistics. ``seqs`` has a row per
    author or, for authors of any length, a row per chunk of ``chunk_length``."""
    train, test = split_authors(seqs, ratio, seed)
    if model is None:
        model = H.fit_hmm(train if fit_on == "train" else seqs, seed=seed, **fit_kw)
    chunked = "n_chunks" in seqs.columns
    pred = LS.predictions_chunks(test, model, L=chunk_length) if chunked else predictions(test, model)
    per = class_metrics(pred)
    return {"predictions": pred, "metrics_by_phase": per, "metrics_global": global_metrics(per),
            "confusion": confusion(pred), "confidence": confidence_summary(pred),
            "histogram": confidence_histogram(pred), "train": train, "test": test}
