"""SimHash near-dedup with anchors from a covering code.

A fingerprint is 64 bits: bit j is 1 if it is set in over half the XXH64
(seed 42) values of the text's word shingles. Two fingerprints link when they
differ in at most two bits.

*Anchors.* The 64 bits are cut into blocks of 3 bits and single bits; in each
block of 3 the anchor is 000 or 111, whichever is nearer (the perfect
repetition code, covering radius 1), a single bit is its own anchor (radius
0). The sum of b such blocks and s single bits is a linear covering code with
2**(b + s) anchors and covering radius b. If x and y differ in two bits at
most, some word z lies within one bit of both; so each fingerprint is
replicated to the anchors that cover one of the 65 words within one bit of
it. These lie within the covering radius plus the threshold, and they are
the only ones among those that can be needed: about 18 with 22 blocks. Every
linked pair meets at an anchor, so nothing is missed.

*Compare.* At an anchor small groups are compared pair by pair. Larger ones
meet again at the words within one bit (words shared by two fingerprints mean
a link), which costs 65 words per fingerprint and no pairs; only the links
that hang a fingerprint to the smallest one at each word are emitted.

Equal fingerprints are merged first, so copies are compared once. Groups are
connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, components, join_same, stored, text_of

SHINGLE = 3
SEED = 42
#: Anchors are 2**ANCHOR_BITS; even, 22 at least. Raise it by 2 when fingerprints
#: per anchor grow (22 suits some hundred million fingerprints).
ANCHOR_BITS = 22
#: Groups of at most so many fingerprints are compared pair by pair.
PAIRWISE = 48
_CHUNK = 1 << 16  # shingles hashed at once


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text as a signed 64-bit number; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII spaces count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    a, b = starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(a), _CHUNK):
        h = np.array([digest(joined[s:e], seed) for s, e in zip(a[i:i + _CHUNK], b[i:i + _CHUNK])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(a), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED, hashed: bool = False) -> DataFrame:
    """(doc_id, fp): one row per document; ``hashed`` adds text_sha."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps), *batch.columns[2:]], names=["doc_id", "fp", "text_sha"][:batch.num_columns])

    sha = [F.sha2(text_of(text_col), 256).alias("text_sha")] if hashed else []
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), *sha).mapInArrow(
        run, "doc_id long, fp long" + ", text_sha string" * hashed)


def anchors(fps: np.ndarray, bits: int = ANCHOR_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor): the anchors of the words within one bit of each fingerprint."""
    blocks, single = (64 - bits) // 2, bits - (64 - bits) // 2
    x = fps.astype(np.uint64)
    home = np.zeros(len(x), np.uint64)
    movable = np.zeros((len(x), bits), bool)
    one, seven = np.uint64(1), np.uint64(7)
    for j in range(blocks):
        part = (x >> np.uint64(3 * j)) & seven
        home |= (np.bitwise_count(part) >= 2).astype(np.uint64) << np.uint64(j)
        movable[:, j] = (part != 0) & (part != seven)  # one more bit may turn the majority
    for j in range(single):
        home |= ((x >> np.uint64(3 * blocks + j)) & one) << np.uint64(blocks + j)
        movable[:, blocks + j] = True
    row, j = np.nonzero(movable)
    turned = home[row] ^ (one << j.astype(np.uint64))
    return np.concatenate((np.arange(len(x)), row)), np.concatenate((home, turned)).astype(np.int64)


def replicas(fps: DataFrame, bits: int = ANCHOR_BITS) -> DataFrame:
    """(anchor, fp) for distinct fingerprints (fp)."""
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                x = batch.column(0).slice(i, 4096).to_numpy(zero_copy_only=False)
                row, anchor = anchors(x, bits)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(x[row])], names=["anchor", "fp"])

    return fps.select("fp").mapInArrow(run, "anchor long, fp long")


def _links(fp: np.ndarray, distance: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Links among the sorted distinct fingerprints of one large group, enough
    to connect all that are linked: each to the first at a shared word."""
    words = np.concatenate((np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)))
    z = (fp.astype(np.uint64)[:, None] ^ words[None, :]).ravel()
    who = np.repeat(np.arange(len(fp)), len(words))
    order = np.lexsort((who, z))
    z, who = z[order], who[order]
    new = np.concatenate(([True], z[1:] != z[:-1]))
    first = who[np.nonzero(new)[0]][np.cumsum(new) - 1]
    keep = first != who
    pairs = np.unique(first[keep] * np.int64(len(fp)) + who[keep])
    return fp[pairs // len(fp)], fp[pairs % len(fp)]


def _compare(anchor: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows sorted by (anchor, fp); whole groups only."""
    starts = np.nonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))[0]
    size = np.diff(np.append(starts, len(anchor)))
    left, right = [], []
    small = np.repeat(size <= PAIRWISE, size)
    for step in range(1, min(PAIRWISE, int(size.max(initial=0)))):
        i = np.nonzero((anchor[step:] == anchor[:-step]) & small[step:])[0]
        if not len(i):
            break
        i = i[np.bitwise_count(fp[i].astype(np.uint64) ^ fp[i + step].astype(np.uint64)) <= 2]
        left.append(fp[i])
        right.append(fp[i + step])
    for s, n in zip(starts[size > PAIRWISE], size[size > PAIRWISE]):
        a, b = _links(fp[s:s + n])
        left.append(a)
        right.append(b)
    empty = np.zeros(0, np.int64)
    return np.concatenate(left or [empty]), np.concatenate(right or [empty])


def links(reps: DataFrame) -> DataFrame:
    """(a, b): links found at the anchors, from (anchor, fp)."""
    def run(batches):
        rest_a, rest_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out(a, f):
            x, y = _compare(a, f)
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["a", "b"])

        for batch in batches:
            a = np.concatenate((rest_a, batch.column(0).to_numpy(zero_copy_only=False)))
            f = np.concatenate((rest_f, batch.column(1).to_numpy(zero_copy_only=False)))
            if not len(a):
                continue
            cut = int(np.searchsorted(a, a[-1]))  # the last group may go on in the next batch
            rest_a, rest_f = a[cut:], f[cut:]
            if cut:
                yield out(a[:cut], f[:cut])
        if len(rest_a):
            yield out(rest_a, rest_f)

    return (reps.repartition("anchor").sortWithinPartitions("anchor", "fp")
            .mapInArrow(run, "a long, b long").distinct())


def groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           shingle: int = SHINGLE, anchor_bits: int = ANCHOR_BITS) -> DataFrame:
    """One row per document: doc_id, fp, component_id.

    component_id is the smallest doc_id that links reach. Null and empty texts
    have fingerprint 0 and link like others; a text of fewer words than a
    shingle is one shingle. Rows that repeat an id belong together only through
    their fingerprints. Null ids are ignored in the choice of component_id. An
    empty table gives an empty result; other columns are not read.
    """
    fps = stored(spark, fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    member = _members(spark, fps, anchor_bits)
    least = member.groupBy("root").agg(F.min("low").alias("component_id"))
    lookup = member.join(least, "root").select("fp", "component_id")
    return fps.join(lookup, "fp").select("doc_id", "fp", "component_id")


def _members(spark: SparkSession, fps: DataFrame, anchor_bits: int) -> DataFrame:
    """(fp, low, root): distinct fingerprints with their smallest doc_id and their component."""
    distinct = stored(spark, fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-distinct")
    roots = components(spark, links(replicas(distinct, anchor_bits)))
    member = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    return stored(spark, member, "simhash-members")


def drop_near_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, anchor_bits: int = ANCHOR_BITS) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, a null id last.

    Rows that share an id and differ in text are told apart by the SHA-256 of
    the text, the smaller first; of rows that agree in both any one stays.
    """
    fps = stored(spark, fingerprints(docs, id_col, text_col, shingle, hashed=True), "simhash-fps")
    member = _members(spark, fps, anchor_bits)
    rows = fps.groupBy("fp", "doc_id", "text_sha").agg(F.count("*").alias("times"))
    picks = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_sha", "times")).alias("pick"))
    kept = stored(spark, picks.join(member, "fp").groupBy("root").agg(F.min("pick").alias("pick")).select(
        "pick.doc_id", "pick.text_sha", "pick.times"), "simhash-kept")
    again = stored(spark, kept.filter("times > 1"), "simhash-again")
    rows = carried(docs, doc_id=F.col(id_col).cast("long"), text_sha=F.sha2(text_of(text_col), 256))
    once = join_same(rows, kept.filter("times = 1"), "doc_id", "text_sha", how="left_semi")
    one = join_same(rows, again, "doc_id", "text_sha", how="left_semi").dropDuplicates(["doc_id", "text_sha"])
    return once.unionByName(one).select("row.*")
