"""Ranked lexical search by presence masks.

A query set of items is ranked against all documents. Documents are read once
and indexed in blocks; a block holds, for each of its documents, the query
terms that occur in it with their counts. Then, block by block and item by
item:

* *masks*: the documents of each term are set as bits, so every document gets
  the mask of the item's terms that it holds; equal masks form one group.
* *bounds*: a mask's highest possible score is the sum of its terms' weights
  times the largest term factor that any document of the block reaches.
* *evaluation*: masks are scored in descending order of that bound; as soon as
  the k-th best score exceeds the next bound, the rest of the block is safely
  left out. The best rows go along from block to block of a task, so later
  blocks begin with a high bar.

Each task returns at most k rows an item, and the best k of these are the
result. Scores are 64-bit integers, weights come from the whole table's counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, text_of

K = 20
#: One pass over the documents serves at most so many items and so many bytes of
#: their texts (one item at least); further items take further passes.
PASS_ITEMS, PASS_BYTES = 2048, 1 << 24
#: Documents and postings of a block (one document at least).
BLOCK_DOCS, BLOCK_POSTINGS = 8192, 1 << 20
#: Documents of the first chunk of masks that is scored; chunks double.
FIRST = 64

#: Digits, lower-cased A-Z and all bytes of multi-byte characters; the rest is a space.
_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())

_INDEX = ("ids binary, absent binary, n binary, starts binary, term binary, tf binary, n_docs long, n_terms long, "
          "held array<struct<term:int,docs:long>>")


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and any character beyond ASCII; A-Z lower-cased."""
    return text.translate(_BYTES).split()


def index(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per block: its documents, their lengths, and the known terms in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.get
        ids, lengths, starts, term, tf = [], [], [0], [], []

        def block():
            nonlocal ids, lengths, starts, term, tf
            words = np.array(term, "<i4")
            found, n = np.unique(words, return_counts=True)
            row = [np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], "?"), np.array(lengths, "<i8"),
                   np.array(starts, "<i8"), words, np.array(tf, "<i8")]
            held = pa.StructArray.from_arrays([pa.array(found.astype(np.int32)), pa.array(n.astype(np.int64))], names=["term", "docs"])
            out = pa.RecordBatch.from_arrays(
                [*[pa.array([a.tobytes()], pa.binary()) for a in row], pa.array([sum(n > 0 for n in lengths)], pa.int64()),
                 pa.array([sum(lengths)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), held)],
                names=["ids", "absent", "n", "starts", "term", "tf", "n_docs", "n_terms", "held"])
            ids, lengths, starts, term, tf = [], [], [0], [], []
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(text.as_py())
                here = Counter(filter(None.__ne__, map(known, words)))
                ids.append(doc)
                lengths.append(len(words))
                term += here.keys()
                tf += here.values()
                starts.append(len(term))
                if len(ids) >= BLOCK_DOCS or len(term) >= BLOCK_POSTINGS:
                    yield block()
        if ids:
            yield block()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text")).mapInArrow(run, _INDEX)


class _Best:
    """The best rows of one item so far: higher scores, then smaller ids, null ids last."""

    def __init__(self, k: int):
        self.k, self.score, self.absent, self.id = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score, absent, ids) -> None:
        score, absent, ids = (np.concatenate(p) for p in ((self.score, score), (self.absent, absent), (self.id, ids)))
        order = np.lexsort((ids, absent, -score))[:self.k]
        order = order[score[order] > 0]
        self.score, self.absent, self.id = score[order], absent[order], ids[order]

    @property
    def bar(self) -> int:
        """No row below this score can enter any more."""
        return int(self.score[-1]) if len(self.score) == self.k else 1


class Block:
    """One block of the index, with its postings turned to term order."""

    def __init__(self, row: dict, n_terms: int, n_docs: int, size: int):
        self.ids, self.absent = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["absent"], "?")
        n, self.starts = np.frombuffer(row["n"], "<i8"), np.frombuffer(row["starts"], "<i8")
        self.term, tf = np.frombuffer(row["term"], "<i4"), np.frombuffer(row["tf"], "<i8")
        held = np.diff(self.starts)
        # Python's whole numbers: 25 * n * n_docs may leave 64 bits in a very large table
        m = np.array([75 + 25 * int(x) * n_docs // n_terms if h else 0 for x, h in zip(n, held)], np.int64)
        self.factor = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, held))
        order = np.argsort(self.term, kind="stable")
        self.doc = np.repeat(np.arange(len(held)), held)[order]
        self.first = np.searchsorted(self.term[order], np.arange(size + 1))
        self.most = np.zeros(size, np.int64)
        np.maximum.at(self.most, self.term, self.factor)
        self.weight = np.zeros(size, np.int64)

    def masks(self, item: np.ndarray, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents in order of mask, first place of each mask, bound of each mask) for documents that hold a term."""
        group = np.zeros(len(self.ids), np.int64)
        bound = np.zeros(1, np.int64)  # of each group so far
        for at in range(0, len(item), 62):
            bits = np.zeros(len(self.ids), np.int64)
            part = item[at:at + 62]
            for j, t in enumerate(part):
                bits[self.doc[self.first[t]:self.first[t + 1]]] |= 1 << j
            seen, inverse = np.unique(bits, return_inverse=True)
            add = np.zeros(len(seen), np.int64)
            for j in range(len(part)):
                add += (seen >> j & 1) * gain[at + j]
            if at == 0:
                group, bound = inverse, add
            else:  # a mask of more than one word: groups are split by the next word
                both, group = np.unique(group * np.int64(len(seen)) + inverse, return_inverse=True)
                bound = bound[both // len(seen)] + add[both % len(seen)]
        rank = np.empty(len(bound), np.int64)
        by = np.argsort(-bound, kind="stable")
        rank[by] = np.arange(len(by))
        order = np.argsort(rank[group], kind="stable")
        bound = bound[by]
        first = np.searchsorted(rank[group][order], np.arange(len(bound) + 1))
        some = int(np.searchsorted(-bound, 0))  # the mask without a term is last
        return order[:first[some]], first[:some + 1], bound[:some]

    def scores(self, docs: np.ndarray) -> np.ndarray:
        start, stop = self.starts[docs], self.starts[docs + 1]
        size = stop - start
        upto = np.concatenate(([0], np.cumsum(size)))
        at = np.arange(upto[-1]) + np.repeat(start - upto[:-1], size)
        total = np.concatenate(([0], np.cumsum(self.weight[self.term[at]] * self.factor[at])))
        return total[upto[1:]] - total[upto[:-1]]

    def search(self, item: np.ndarray, weight: np.ndarray, best: _Best) -> None:
        """Scores masks in descending order of their bounds until none can reach the best rows."""
        here = self.first[item + 1] > self.first[item]
        item, weight = item[here], weight[here]
        if not len(item) or int((weight * self.most[item]).sum()) < best.bar:
            return
        docs, first, bound = self.masks(item, weight * self.most[item])
        self.weight[item] = weight
        mask, size = 0, FIRST
        while mask < len(bound) and bound[mask] >= best.bar:
            stop = max(mask + 1, int(np.searchsorted(first, first[mask] + size, "right")) - 1)
            stop = min(stop, int(np.searchsorted(-bound, -best.bar, "right")))
            chunk = docs[first[mask]:first[stop]]
            best.add(self.scores(chunk), self.absent[chunk], self.ids[chunk])
            mask, size = stop, 2 * size
        self.weight[item] = 0


def _passes(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """Rows (item id, text) in slices that one pass serves."""
    part, size = [], 0
    for row in items.select(F.col(id_col).alias("item"), text_of(text_col).cast("binary").alias("text")).toLocalIterator():
        if part and (len(part) >= PASS_ITEMS or size + len(row["text"]) > PASS_BYTES):
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row["text"])
    if part:
        yield part


def _rank_pass(spark: SparkSession, docs: DataFrame, part: list, kind, k: int, id_col: str, text_col: str) -> DataFrame:
    counted = [Counter(terms(bytes(row["text"]))) for row in part]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    blocks = stored(spark, index(docs, vocabulary, id_col, text_col), "lexical-index")
    n_docs, n_terms = (int(x or 0) for x in blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    df = np.zeros(len(vocabulary), np.int64)  # one number per query term of this pass
    for row in blocks.select(F.explode("held").alias("h")).groupBy("h.term").agg(F.sum("h.docs").alias("docs")).collect():
        df[row["term"]] = row["docs"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    queries = []
    for here in counted:
        ids = np.array([vocabulary[t] for t in here], np.int64)
        queries.append((ids, weight[ids] * np.array(list(here.values()), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(k) for _ in queries]
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, n_terms, n_docs, len(df))
                for (ids, w), rows in zip(queries, best):
                    block.search(ids, w, rows)
        for i, rows in enumerate(best):
            if len(rows.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(rows.score), pa.int32()), pa.array(rows.id, pa.int64(), mask=rows.absent), pa.array(rows.score)],
                    names=["query", "doc_id", "score"])

    found = blocks.select("ids", "absent", "n", "starts", "term", "tf").mapInArrow(run, "query int, doc_id long, score long")
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    names = spark.createDataFrame([(i, row["item"]) for i, row in enumerate(part)], f"query int, item_id {kind}")
    return (found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
            .join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))


def rank(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, scores above 0 only.

    Equal scores rank by ascending doc_id, a null id last. Null and empty texts
    have no terms: such a document is found by no item, such an item finds none.
    Rows that repeat a doc_id are documents of their own, items that repeat an
    item_id are each ranked (their rows repeat). Very long texts are read whole;
    a document adds at most one posting for each term of the items. Empty tables
    give an empty result; other columns are not read.
    """
    kind = items.schema[item_col].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for part in _passes(items, item_col, item_text_col):
        out = out.unionByName(_rank_pass(spark, docs, part, kind, k, id_col, text_col))
    return out
