"""Removal of repeated byte strings by a prefix-free parse of the corpus.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts
anywhere else. Suffix order is needed only to that depth, and only as classes
of equal strings, so the parse does the work of the suffix array:

* *triggers*: a rolling hash of ``GRAM`` bytes; the trigger of a window that
  starts at i is the smallest hash (leftmost) among its first ``REACH``
  positions. It depends on the window's bytes alone, so equal windows have
  equal triggers, and the windows of one trigger are a run of starts.
* *phrases*: the ``LENGTH - REACH + 1`` bytes from a trigger. They have one
  length, so no phrase is a prefix of another; every window contains the
  phrase of its trigger. The *dictionary* keeps the phrases that occur twice:
  all other windows are settled as unique without being looked at.
* *parse*: the run of windows of one trigger spans one string of text. Equal
  strings (128-bit hash) settle all windows of the run as repeated: this is
  where copies end, at one row per ``REACH / 2`` bytes.
* *suffixes*: what remains are the edges of repeats, where the phrase recurs
  and the run's string doesn't. Such runs, and one representative of each
  settled string with that phrase, are cut into blocks of ``BLOCK`` windows at
  fixed distances from the trigger. The bytes that all windows of a block
  share (its core) stand for the phrase, the bytes that any of them covers for
  the string: equal strings settle a block, and a core that occurs once
  settles it as unique. Only blocks with neither get their windows compared.

Each step is a grouping with partial sums and a join that Spark can split, so
a passage that is in a third of all documents burdens no single task. Phrase
hashes of 64 bits only choose candidates; what is removed, and which row it is
removed from, rests on 128 bits.

A Python worker holds a few megabytes of bodies and of rows at a time, however
long a body is; the bodies that lose bytes are cut by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucketed, stored, text_of

LENGTH = 400
REACH = 300
GRAM = 8
BLOCK = 32
#: Windows that are parsed at a time, rows that a worker hands on at a time,
#: and the bodies that it gets at a time: rows, bytes.
PART = 1 << 16
ROWS = 1 << 14
TAKEN = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def parse(body: bytes, length: int = LENGTH, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """(triggers, first starts) of the windows of ``body``: the windows that
    start from ``first[j]`` up to before ``first[j + 1]`` have trigger j."""
    windows = len(body) - length + 1
    ats, firsts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, windows, PART):
        n = min(PART, windows - start) + reach - 1
        grams = np.ndarray((n,), "<u8", body, start, (1,))
        low = ((grams * _MIX) & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        span = 1
        while 2 * span <= reach:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < reach:
            low = np.minimum(low[: len(low) - (reach - span)], low[reach - span:])
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.nonzero(at[1:] != at[:-1])[0] + 1))
        ats.append(at[first] + start)
        firsts.append(first + start)
    at, first = np.concatenate(ats), np.concatenate(firsts)
    new = np.ones(len(at), bool)  # a trigger's windows may go on in the next part
    new[1:] = at[1:] != at[:-1]
    return at[new], first[new]


@contextmanager
def _small_batches(spark: SparkSession):
    """Jobs that run meanwhile hand bodies to Python by ``TAKEN``."""
    before = {k: spark.conf.get(k) for k in TAKEN}
    for k, v in TAKEN.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _batches(run, schema):
    """An Arrow function from one that yields rows for the values of a row."""
    names, kinds = zip(*(c.split() for c in schema.split(", ")))

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(run(*(v.as_py() for v in values)) for values in zip(*batch.columns))
        while held := list(islice(rows, ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*held), kinds)], names=names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return chain.from_iterable(map(parts, batches))

    return whole


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _two(data: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(data)
    return _signed(x >> 64), _signed(x & 0xFFFFFFFFFFFFFFFF)


def _phrase(body: bytes, at: int, size: int) -> int:
    return _signed(xxhash.xxh3_64_intdigest(body[at:at + size]))


def phrases(bodies: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """(phrase, dk, at) for every trigger of (dk, body)."""
    size = length - reach + 1

    def run(dk, body):
        return ((_phrase(body, t, size), dk, t) for t in parse(body, length, reach)[0].tolist())

    schema = "phrase long, dk binary, at int"
    return bodies.select("dk", "body").mapInArrow(_batches(run, schema), schema)


_ENTRY = "core long, hi long, lo long, dk binary, a int, size int, solo boolean"


def runs(bodies: DataFrame, length: int = LENGTH, reach: int = REACH) -> DataFrame:
    """The string under each run of windows whose trigger is listed in ``ats``,
    from (dk, body, ats); core is the phrase, a and size are the run's starts."""
    size = length - reach + 1

    def run(dk, body, ats):
        at, first = parse(body, length, reach)
        stop = np.append(first[1:], len(body) - length + 1)
        listed = np.isin(at, ats)
        return ((_phrase(body, t, size), *_two(body[a:b + length - 1]), dk, a, b - a, True)
                for t, a, b in zip(at[listed].tolist(), first[listed].tolist(), stop[listed].tolist()))

    return bodies.select("dk", "body", "ats").mapInArrow(_batches(run, _ENTRY), _ENTRY)


def blocks(bodies: DataFrame, length: int = LENGTH, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """The blocks of the runs listed in ``probes``, from (dk, body, probes)."""
    def run(dk, body, probes):
        at, first = parse(body, length, reach)
        for p in probes:
            t, a, stop = int(at[np.searchsorted(first, p["a"])]), p["a"], p["a"] + p["size"]
            for d in range((t - a) // block, (t - stop + 1) // block - 1, -1):  # distances d * block and up
                low, high = max(a, t - (d + 1) * block + 1), min(stop, t - d * block + 1)
                core = _signed(xxhash.xxh3_64_intdigest(body[t - d * block:t - (d + 1) * block + 1 + length]))
                yield core, *_two(body[low:high + length - 1]), dk, low, high - low, p["solo"]

    return bodies.select("dk", "body", "probes").mapInArrow(_batches(run, _ENTRY), _ENTRY)


def windows(bodies: DataFrame, length: int = LENGTH) -> DataFrame:
    """(hi, lo, dk, at, solo): every window of the blocks listed in ``probes``, from (dk, body, probes)."""
    def run(dk, body, probes):
        return ((*_two(body[i:i + length]), dk, i, p["solo"]) for p in probes for i in range(p["a"], p["a"] + p["size"]))

    schema = "hi long, lo long, dk binary, at int, solo boolean"
    return bodies.select("dk", "body", "probes").mapInArrow(_batches(run, schema), schema)


def settle(spark: SparkSession, entries: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(settled, probes) of strings (core, hi, lo, dk, a, size, solo).

    settled: the runs (dk, a, size) of solo entries whose string occurs twice.
    probes: (dk, probes) with what must be looked into: each distinct string
    of the cores that have an unsettled solo string and another one beside it.
    """
    key = ("core", "hi", "lo")
    distinct = stored(spark, entries.groupBy(*key).agg(
        F.count("*").alias("n"), F.min_by("a", "dk").alias("a"), F.min("dk").alias("dk"), F.first("size").alias("size"),
        F.max("solo").alias("solo")), f"suffix-{name}-strings").withColumn("solo", F.col("solo") & (F.col("n") == 1))
    cores = stored(spark, distinct.groupBy("core").agg(F.count("*").alias("c"), F.max("solo").alias("open"))
                   .filter("open AND c > 1").select("core"), f"suffix-{name}-cores")
    settled = entries.filter("solo").join(stored(spark, distinct.filter("n > 1").select(*key), f"suffix-{name}-twice"), list(key))
    probes = distinct.join(cores, "core").groupBy("dk").agg(F.collect_set(F.struct("a", "size", "solo")).alias("probes"))
    return settled.select("dk", "a", "size"), probes


def spans(cover: DataFrame, length: int = LENGTH) -> DataFrame:
    """(dk, n_removed, n_spans, begin, stop) from (dk, cover): the pieces of the body
    from ``begin[j]`` to before ``stop[j]`` stay (the last to its end, null) without the
    windows that start at ``a`` and the ``size - 1`` places after it."""
    def run(dk, cover):
        a, size = np.array(sorted((c["a"], c["size"]) for c in cover), np.int64).T
        top = np.maximum.accumulate(a + size + length - 1)
        new = np.append(True, a[1:] > top[:-1])
        first, last = a[new], top[np.append(new[1:], True)]
        yield dk, int((last - first).sum()), len(first), [0, *last.tolist()], [*first.tolist(), None]

    schema = "dk binary, n_removed long, n_spans long, begin array<int>, stop array<int>"
    return cover.select("dk", "cover").mapInArrow(_batches(run, schema), schema)


def cut(pieces: DataFrame) -> DataFrame:
    """(dk, n_removed, n_spans, kept) from (dk, body, n_removed, n_spans, begin, stop)."""
    kept = F.zip_with("begin", "stop", lambda a, b: F.hex(F.substring("body", a + 1, F.coalesce(b, F.octet_length("body")) - a)))
    return pieces.select("dk", "n_removed", "n_spans", F.unhex(F.array_join(kept, "")).alias("kept"))


def repeats(spark: SparkSession, bodies: DataFrame, length: int = LENGTH, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """(dk, body, n_removed, n_spans, begin, stop) for the rows of (dk, body) that have
    repeated strings, as in ``spans``.

    Rows that share dk must have one body; each counts as an occurrence.
    """
    if not (GRAM <= reach <= length - GRAM and 1 <= block <= length // 2):
        raise ValueError(f"reach must lie between {GRAM} and length - {GRAM}, block between 1 and length / 2")
    with _small_batches(spark):
        found = phrases(bodies, length, reach)
        dictionary = stored(spark, found.groupBy("phrase").count().filter("count > 1").select("phrase"), "suffix-dictionary")
        listed = found.join(dictionary, "phrase").groupBy("dk").agg(F.collect_set("at").alias("ats"))
        texts = bucketed(spark, bodies.join(listed.hint("shuffle_hash"), "dk"), "dk")

        strings = stored(spark, runs(texts, length, reach), "suffix-runs")
        whole, probes = settle(spark, strings, "run")
        parts = stored(spark, blocks(texts.join(probes.hint("shuffle_hash"), "dk"), length, reach, block), "suffix-blocks")
        partial, probes = settle(spark, parts, "block")
        compared = stored(spark, windows(texts.join(probes.hint("shuffle_hash"), "dk"), length), "suffix-windows")
        equal = stored(spark, compared.groupBy("hi", "lo").count().filter("count > 1").select("hi", "lo"), "suffix-equal")
    single = compared.filter("solo").join(equal, ["hi", "lo"]).select("dk", F.col("at").alias("a"), F.lit(1).alias("size"))
    cover = whole.unionByName(partial).unionByName(single).groupBy("dk").agg(F.collect_set(F.struct("a", "size")).alias("cover"))
    return texts.select("dk", "body").join(spans(cover, length).hint("shuffle_hash"), "dk")


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, reach: int = REACH, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and
    kept (binary; null if nothing was removed).

    Texts are UTF-8 bytes, null is empty, matches stay within a row. Strings
    are judged on the input. Rows that repeat an id and a text are copies of
    each other and get equal results; so do rows with a null id. A row's key is 128
    bits of the SHA-256 of its id and text. Texts under
    ``length`` bytes lose nothing. An empty table gives an empty result; other
    columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text")
    rows = rows.withColumn("dk", F.substring(F.unhex(F.sha2(named, 256)), 1, 16))
    bodies = rows.filter(F.octet_length("text") >= length).select("dk", F.col("text").cast("binary").alias("body"))
    cleaned = cut(repeats(spark, bodies, length, reach, block)).withColumn(
        "cleaned_sha256", F.sha2("kept", 256)).dropDuplicates(["dk"])
    facts = rows.select("doc_id", "dk", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
    return facts.join(cleaned, "dk", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("cleaned_sha256", "sha256").alias("kept_sha256"), "kept")
