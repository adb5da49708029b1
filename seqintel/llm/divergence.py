"""Source divergence audit with late string materialisation.

How far does each source of a language lie from each other one, and which terms
make it differ from the language as a whole? Term counts are gathered by source
and language; strings stay behind until the end:

* *digests*: a term is counted under a 64-bit digest (of language and term). The
  counts are combined where the documents are read and written once, beside
  their terms; the shuffle of the counts reads the fixed-width columns only.
* *collisions*: for digests that enough documents hold (a broadcast set of bits
  of fixed size leaves out most others), the smallest and the largest string are
  found. Where they differ, several terms share a digest: such a digest is split,
  its counts are gathered again by string.
* *outputs*: a term's text is joined back only for rows that may be reported.

A term that a source lacks still has its share, so a sum over all kept terms is
taken as: terms of either source (from a histogram of their counts), terms of
both (found term by term, summed where they are found), and all others at once.
All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, text_of

#: Documents of a language that must hold a term, and ranks of the term report.
LEAST_DOCS, RANKS = 3, 200
#: Counts held by a task before it hands them on.
HELD = 500_000
BITS = 64
#: Rows of the broadcast set that trims the strings to kept digests (64 bits each).
SET_ROWS = 1 << 18

#: Lower-cased A-Z and all bytes of multi-byte characters; the rest is a space.
_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in bytes(range(256)).lower())


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and any character beyond ASCII; A-Z lower-cased."""
    return text.translate(_BYTES).split()


def counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", bits: int = BITS,
           held: int = HELD, every: bool = False) -> DataFrame:
    """Partial counts (digest, group, term, n, docs), combined where documents are read.

    The digest is one of language and term, ``group`` one of language and source.
    The term stands in one row of its language that a task hands on at once, or
    in ``every`` row. Rows without a digest name the groups (lang, source).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times, inside, size = defaultdict(Counter), defaultdict(Counter), 0

        def flush():
            digests: dict = defaultdict(dict)
            for (lang, source), words in times.items():
                known, held_by, n = digests[lang], inside[lang, source], len(words)
                seed, new = xxhash.xxh3_64_intdigest(lang), words.keys() - digests[lang].keys()
                known.update((w, xxhash.xxh3_64_intdigest(w, seed) >> (64 - bits)) for w in new)
                group = xxhash.xxh3_64_intdigest(source, seed) - (1 << 63)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.append(np.fromiter(map(known.__getitem__, words), "<u8", n), 0).view("<i8"), mask=np.arange(n + 1) == n),
                    pa.array(np.full(n + 1, group, np.int64)),
                    pa.array([*([*words] if every else [w if w in new else None for w in words]), None], pa.binary()).cast(pa.string()),
                    pa.array([*words.values(), 0], pa.int64()), pa.array([*map(held_by.__getitem__, words), 0], pa.int64()),
                    pa.array([lang] * (n + 1), pa.string()), pa.array([None] * n + [source], pa.string())],
                    names=["digest", "group", "term", "n", "docs", "lang", "source"])
            times.clear()
            inside.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words, group = terms(text.as_py()), (lang, source)
                before = len(times[group])
                times[group].update(words)
                inside[group].update(set(words))
                size += len(times[group]) - before
                if size > held:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).cast("binary").alias("text")).mapInArrow(
        run, "digest long, group long, term string, n long, docs long, lang string, source string")


def _summed(raw: DataFrame, *term: str, least: int) -> DataFrame:
    """Counts by group of the terms that enough documents of the language hold; one shuffle, by term.

    ``n_lang`` is the language's count, ``lead`` is 1 in one row of each term."""
    by = Window.partitionBy(*term)
    rows = raw.repartition(*term).withColumn("held_by", F.sum("docs").over(by)).filter(F.col("held_by") >= least)
    return (rows.groupBy(*term, "group").agg(F.sum("n").alias("n"))
            .withColumns({"n_lang": F.sum("n").over(by), "lead": (F.col("group") == F.min("group").over(by)).cast("long")}))


def _share(n: str, total: str) -> Column:
    """1 + floor(1e9 * (n + 1) / total); in decimals where the product leaves 64 bits."""
    return F.expr(f"1 + CASE WHEN {n} < 9000000000 THEN (1000000000L * ({n} + 1)) div {total} ELSE "
                  f"cast((cast(1000000000 as decimal(10,0)) * cast({n} + 1 as decimal(20,0))) div cast({total} as decimal(20,0)) as bigint) END")


def _distance(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _among(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """``rows`` without most digests that ``kept`` lacks: a broadcast set of 64 * SET_ROWS bits at most."""
    slot = F.pmod(F.hash("digest"), F.lit(64 * SET_ROWS))
    bits = kept.select(slot.alias("s")).groupBy(F.expr("s div 64").alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s % 64 as int))")).alias("bits"))
    return (rows.withColumn("s", slot).join(F.broadcast(bits), F.expr("s div 64 = slot"))
            .filter("(shiftright(bits, cast(s % 64 as int)) & 1) = 1").drop("s", "slot", "bits"))


class Audit:
    """Stored tables of one audit: ``groups``, ``kept`` counts with their shares, ``dictionary`` of digests."""

    def __init__(self, spark: SparkSession, docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                 least_docs: int = LEAST_DOCS, bits: int = BITS, held: int = HELD):
        columns = (docs, lang_col, source_col, text_col, bits, held)
        raw = stored(spark, counts(*columns), "divergence-counts")
        found = raw.filter(F.col("digest").isNotNull())
        kept = stored(spark, _summed(found.select("digest", "group", "n", "docs"), "digest", least=least_docs), "divergence-digests")
        strings = _among(found.filter(F.col("term").isNotNull()).select("digest", F.struct("lang", "term").alias("term")), kept)
        self.dictionary = stored(spark, strings.groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")), "divergence-strings")
        shared = stored(spark, self.dictionary.filter("low <> high").select("digest"), "divergence-shared")
        kept = kept.withColumn("split", F.lit(None).cast("struct<lang:string,term:string>"))
        if shared.take(1):  # digests of several terms: counted again by string
            again = counts(*columns, every=True).join(shared, "digest", "left_semi").select(
                "digest", "group", F.struct("lang", "term").alias("term"), "n", "docs")
            apart = _summed(again, "digest", "term", least=least_docs).withColumnRenamed("term", "split")
            kept = stored(spark, kept.join(shared, "digest", "left_anti").unionByName(apart), "divergence-kept")
        by_group = kept.groupBy("group").agg(F.sum("n").alias("total"), F.count("*").alias("own"), F.sum("lead").alias("lead"))
        groups = raw.filter(F.col("digest").isNull()).select("group", "lang", "source").distinct().join(by_group, "group", "left").na.fill(
            0, ["total", "own", "lead"])
        lang, alike = Window.partitionBy("lang"), Window.partitionBy("group")
        groups = groups.withColumns({
            "lang_total": F.sum("total").over(lang), "terms": F.sum("lead").over(lang),
            "id": F.when(F.count("*").over(alike) == 1, F.col("group")).otherwise(F.raise_error(F.lit("two sources share a digest")).cast("long"))})
        self.groups = stored(spark, groups.withColumn("none", _share("0L", "(total + terms)")), "divergence-groups")
        self.kept = stored(spark, kept.join(self.groups.drop("lang", "source", "own", "lead"), "group").select(
            "digest", "split", "id", "none", _share("n", "(total + terms)").alias("p"), _share("n_lang", "(lang_total + terms)").alias("q")),
            "divergence-shares")

    def pairs(self) -> DataFrame:
        """(lang, source, other, value) for each two sources of a language: the sum of f over all kept terms."""
        one = self.groups.select("lang", F.col("id").alias("a"), F.col("none").alias("a_none"), F.col("own").alias("a_own"), "terms")
        two = self.groups.select("lang", F.col("id").alias("b"), F.col("none").alias("b_none"), F.col("own").alias("b_own"))
        both = one.join(two, "lang").filter("a <> b")  # one row per row of the result
        rest = both.select("a", "b", ((F.col("terms") - F.col("a_own") - F.col("b_own")) * _distance("a_none", "b_none")).alias("v"))
        held = self.kept.groupBy(F.col("id").alias("a"), "p").agg(F.count("*").alias("times")).join(both.select("a", "b", "a_none", "b_none"), "a")
        ahead = held.select("a", "b", (F.col("times") * _distance("p", "b_none")).alias("v"))
        back = held.select(F.col("b").alias("a"), F.col("a").alias("b"), (F.col("times") * _distance("b_none", "p")).alias("v"))
        per_term = self.kept.groupBy("digest", "split").agg(F.collect_list(F.struct("id", "p", "none")).alias("held"))
        shared = per_term.select("held").mapInArrow(_shared, "a long, b long, v long")
        value = rest.unionByName(ahead).unionByName(back).unionByName(shared).groupBy("a", "b").agg(F.sum("v").alias("value"))
        return (value.join(self.groups.select(F.col("id").alias("a"), "lang", "source"), "a")
                .join(self.groups.select(F.col("id").alias("b"), F.col("source").alias("other")), "b")
                .select("lang", "source", "other", F.coalesce("value", F.lit(0)).cast("long").alias("value")))

    def over(self, ranks: int = RANKS) -> DataFrame:
        """(lang, source, term, value): the terms that a source has more of than its language, to ``ranks`` and with all ties there."""
        rows = self.kept.filter("p > q").select("id", "digest", "split", _distance("p", "q").alias("value"))
        down = Window.partitionBy("id").orderBy(F.desc("value"))
        bars = (rows.groupBy("id", "value").agg(F.count("*").alias("times"))
                .withColumn("at", F.row_number().over(down)).filter(F.col("at") <= ranks)
                .withColumn("before", F.sum("times").over(down) - F.col("times")).filter(F.col("before") < ranks)
                .groupBy("id").agg(F.min("value").alias("bar")))
        out = rows.join(bars, "id").filter(F.col("value") >= F.col("bar"))
        return out.join(self.dictionary.select("digest", "low"), "digest").join(self.groups.select("id", "lang", "source"), "id").select(
            "lang", "source", F.coalesce("split", "low")["term"].alias("term"), "value")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What terms of two groups at once add to the sums of the pair; sums leave the task, not pairs."""
    sums: dict[tuple[int, int], int] = defaultdict(int)

    def flush():
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int64()), pa.array([k[1] for k in sums], pa.int64()),
                                          pa.array(list(sums.values()), pa.int64())], names=["a", "b", "v"])
        sums.clear()

    def f(p, q):
        return (p - q) ** 2 // q

    for batch in batches:
        lists = batch.column(0)
        term = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        group, p, none = (c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
        names, place = np.unique(group, return_inverse=True)
        for step in range(1, int(np.bincount(term).max(initial=0))):
            i = np.nonzero(term[step:] == term[:-step])[0]
            for x, y in ((i, i + step), (i + step, i)):
                v = f(p[x], p[y]) - f(p[x], none[y]) - f(none[x], p[y]) + f(none[x], none[y])
                keys, at = np.unique(place[x] * np.int64(len(names)) + place[y], return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, at, v)
                for k, t in zip(keys.tolist(), total.tolist()):
                    sums[int(names[k // len(names)]), int(names[k % len(names)])] += t
        if len(sums) > HELD:
            yield from flush()
    if sums:
        yield from flush()


def audit(spark: SparkSession, docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, ranks: int = RANKS, bits: int = BITS, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank), see the module.

    Part ``pair``: item is another source of the language, all ranks. Part
    ``term``: item is a term of which the source has more than its language, to
    ``ranks``. Higher values rank first, equal ones by item (UTF-8 order).

    Null language, source and text count as empty; a text without terms adds its
    group and no counts; a group without terms has pairs of its own. A language
    with one source has no pairs, one without kept terms has pairs of value 0.
    Rows that repeat an id are documents of their own (ids are not read). Very
    long texts are read whole; a task holds their distinct terms. An empty table
    gives an empty result; other columns are not read.
    """
    work = Audit(spark, docs, lang_col, source_col, text_col, least_docs, bits, held)
    by = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    pairs = work.pairs().select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    over = work.over(ranks).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return (pairs.withColumn("rank", F.row_number().over(by)).unionByName(
        over.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= ranks)))
