"""Session helpers: a tuned local session for tests/bench and table loading.

On a cluster the session comes from the platform; we only read from it.
``ensure_checkpoint_dir`` sets a checkpoint folder only when the cluster has
not named one (tests, local runs), and then under a fresh scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "seqintel") -> SparkSession:
    """A local session with the settings the package assumes (UTC, AQE, Arrow, no UI)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Session settings our semantics rely on; safe to call on any session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``seqintel`` importable in Python workers (Arrow UDFs pickle our
    functions by module reference): zip the package once per application and
    hand it to ``addPyFile``, which serves it to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    # The archive is a driver-side artifact that addPyFile serves to the
    # executors. It goes into the session's checkpoint folder when that is a
    # filesystem path the driver can write; otherwise into a driver-local
    # scratch folder (only the driver reads it).
    ckpt = ensure_checkpoint_dir(spark)
    local = ckpt[len("file:"):] if ckpt.startswith("file:") else (ckpt if "://" not in ckpt else None)
    base = os.path.join(local, "seqintel-pyfiles") if local else tempfile.mkdtemp(prefix="seqintel-pyfiles-")
    os.makedirs(base, exist_ok=True)
    out = os.path.join(base, f"seqintel-{sc.applicationId}.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith((".py", ".json")):
                    full = os.path.join(root, f)
                    z.write(full, os.path.join("seqintel", os.path.relpath(full, pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A scratch folder is made only where
    it is unset and the master is local (tests); a cluster must name one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="seqintel-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` checkpointed in partitions by ``keys``: a later join or grouping on them
    finds its rows where they lie and moves the other side only. (A checkpoint
    of an adaptive plan forgets its partitioning, so this one is planned ahead.)"""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1), *keys).checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; its splits follow ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
