"""Quality classifier: a linear-chain CRF over the lines of a document.

Every line that holds a word gets a label, good or bad. A line is described by
a few figures of its own and the same figures of the line before and after it;
transitions tie neighbouring labels together. The fit maximises the
likelihood of lines that carry their document's label. A document's score is
the mean of the lines' forward-backward marginals for good, weighted by line
length. Labels, languages, sources and ids are no inputs of a score.
"""

from __future__ import annotations

import io
import operator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import carried, text_of

#: The fit reads at most so many labelled documents, and of each at most so many
#: lines in a row (from a place set by a hash of the text); scores read all lines.
TRAIN_DOCS, TRAIN_LINES = 4000, 96
THRESHOLD = 0.7
#: Lines of the texts scored together, padding included; texts of more than ``LONG`` lines go by blocks.
CELLS, LONG = 1 << 18, 1 << 14
STEPS, RATE, RIDGE = 250, 0.08, 1e-3

_SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"
_STOPS = (b".", b"!", b"?", b":", b'"', b")")
FIGURES = ("log bytes", "log words", "word length", "varied words", "repeated words", "symbols", "bars", "exclamations", "upper case",
           "digits", "other bytes", "ends a sentence", "starts upper case", "seen before", "short words")


def figures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x figures, line lengths in bytes) of the lines that hold a word."""
    parts, rows, sizes, keys, equal = [], [], [], [], operator.eq
    for line in io.BytesIO(text.encode("utf-8", "surrogatepass")):
        line = line.removesuffix(b"\n")
        words = line.split()
        if not words:
            continue
        n, size = len(words), len(line)
        glyphs = size - line.count(b" ")

        def share(drop):
            return (size - len(line.translate(None, drop))) / glyphs

        upper, lower = share(_UPPER), share(_LOWER)
        digits, symbols = share(_DIGITS), share(_SYMBOLS)
        rows.append((
            np.log1p(size), np.log1p(n), min(glyphs / n, 40.0) / 10, len(set(words)) / n, sum(map(equal, words, words[1:])) / n,
            symbols, line.count(b"|") / n, line.count(b"!!") / n, upper / (upper + lower + 1e-9), digits,
            1 - upper - lower - digits, float(line.endswith(_STOPS)), float(65 <= words[0][0] <= 90), 0.0,
            sum(len(w) <= 3 for w in words) / n))
        sizes.append(size)
        keys.append(hash(line))
        if len(rows) == 1 << 14:
            parts.append(np.array(rows, np.float32))
            rows = []
    out = np.concatenate((*parts, np.array(rows, np.float32).reshape(-1, len(FIGURES))))
    keys = np.array(keys, np.int64)
    seen = np.ones(len(keys), bool)
    seen[np.unique(keys, return_index=True)[1]] = False  # first of its kind
    out[:, FIGURES.index("seen before")] = seen
    return out, np.array(sizes, np.int64)


class LineCrf:
    """Labels 0 (bad) and 1 (good); bad has emission 0."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray, bias: float, trans: np.ndarray, prior: float):
        self.mean, self.scale, self.weight, self.bias, self.trans, self.prior = mean, scale, weight, bias, trans, prior

    def inputs(self, rows: np.ndarray) -> np.ndarray:
        """Standardised figures of the line before, the line and the line after (zeros past an end)."""
        x = (rows - self.mean) / self.scale
        zero = np.zeros((1, x.shape[1]), x.dtype)
        return np.concatenate((np.concatenate((zero, x[:-1])), x, np.concatenate((x[1:], zero))), axis=1)

    def scores(self, texts) -> np.ndarray:
        """Scores of texts; a text without a word scores the share of label 1."""
        out, jobs = np.full(len(texts), self.prior), []
        for i, text in enumerate(texts):
            rows, sizes = figures(text or "")
            if len(rows):
                jobs.append((i, self.inputs(rows) @ self.weight + self.bias, sizes))
        jobs.sort(key=lambda j: len(j[2]))
        while jobs and len(jobs[-1][2]) > LONG:
            i, em, sizes = jobs.pop()
            out[i] = long_marginals(em, self.trans) @ sizes / sizes.sum()
        k = 0
        while k < len(jobs):  # texts of like length, at most CELLS lines with their padding
            stop = k + 1
            while stop < len(jobs) and (stop + 1 - k) * len(jobs[stop][2]) <= CELLS:
                stop += 1
            part, k = jobs[k:stop], stop
            lengths = np.array([len(s) for _, _, s in part])
            em = np.zeros((len(part), lengths.max()))
            for row, (_, e, _) in zip(em, part):
                row[:len(e)] = e
            good = marginals(em, lengths, self.trans)[0]
            for row, (i, _, sizes) in zip(good, part):
                out[i] = row[:len(sizes)] @ sizes / sizes.sum()
        return np.clip(out, 0.0, 1.0)


def long_marginals(em: np.ndarray, trans: np.ndarray, block: int = 512) -> np.ndarray:
    """P(good) at each place of one long chain: blocks side by side.

    One 2 x 2 matrix per block gives the forward vector before it and the
    backward vector after it; then all blocks run between these at once."""
    n = -(-len(em) // block)
    rows = np.zeros(n * block)
    rows[:len(em)] = em
    e = np.stack((np.zeros(n * block), rows), axis=1).reshape(n, block, 2)
    e = np.exp(e - e.max(axis=2, keepdims=True))
    move, last = np.exp(trans - trans.max()), len(em) - (n - 1) * block
    size = np.full(n, block)
    size[-1] = last
    m = move * e[:, 0][:, None, :]
    m[0] = np.diag(e[0, 0])
    for t in range(1, block):
        nxt = (m @ move) * e[:, t][:, None, :]
        m = np.where((t < size)[:, None, None], nxt / nxt.sum(axis=(1, 2), keepdims=True), m)
    before, after, v, u = np.ones((n, 2)), np.ones((n, 2)), np.ones(2), np.ones(2)
    for i in range(n):
        before[i] = v
        v = v @ m[i]
        v = v / v.sum()
    for i in range(n - 1, -1, -1):
        after[i] = u
        u = m[i] @ u
        u = u / u.sum()
    alpha, beta = np.empty_like(e), np.empty_like(e)
    for t in range(block):
        a = (alpha[:, t - 1] @ move if t else np.where((np.arange(n) == 0)[:, None], 1.0, before @ move)) * e[:, t]
        alpha[:, t] = a / a.sum(axis=1, keepdims=True)
    beta[:, block - 1] = after
    for t in range(block - 2, -1, -1):
        b = (e[:, t + 1] * beta[:, t + 1]) @ move.T
        beta[:, t] = np.where((t + 1 < size)[:, None], b / b.sum(axis=1, keepdims=True), after)
    both = (alpha * beta).reshape(-1, 2)[:len(em)]
    return both[:, 1] / both.sum(axis=1)


def marginals(em: np.ndarray, lengths: np.ndarray, trans: np.ndarray):
    """(P(good) per place, log Z, expected transitions) of padded chains, by scaled forward-backward."""
    n, t_max = em.shape
    e = np.stack((np.zeros_like(em), em), axis=2)
    e = np.exp(e - e.max(axis=2, keepdims=True))
    move = np.exp(trans - trans.max())
    inside = np.arange(t_max)[None, :] < lengths[:, None]
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.ones((n, t_max))
    for t in range(t_max):
        a = e[:, t] if t == 0 else (alpha[:, t - 1] @ move) * e[:, t]
        s = a.sum(axis=1)
        alpha[:, t] = a / s[:, None]
        scale[:, t] = s
    pairs = np.zeros((2, 2))
    for t in range(t_max - 2, -1, -1):
        nxt = e[:, t + 1] * beta[:, t + 1]
        b = nxt @ move.T
        on = inside[:, t + 1]
        beta[:, t] = np.where(on[:, None], b / scale[:, t + 1][:, None], 1.0)
        joint = alpha[:, t, :, None] * move * nxt[:, None, :] / scale[:, t + 1][:, None, None]
        pairs += joint[on].sum(axis=0)
    both = alpha * beta
    good = both[:, :, 1] / both.sum(axis=2)
    logz = (np.where(inside, np.log(scale) + np.maximum(em, 0), 0)).sum() + trans.max() * (lengths - 1).sum()
    return good, logz, pairs


def fit(docs: list[tuple[np.ndarray, int]], steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> LineCrf:
    """Adam on the penalised likelihood; docs: (lines x figures, label)."""
    width, labels = len(FIGURES), np.array([y for _, y in docs])
    prior = float(labels.mean()) if len(labels) else 1.0
    docs = [d for d in docs if len(d[0])]
    if not docs or prior in (0.0, 1.0):  # nothing to tell apart
        odds = 20.0 if prior > 0.5 else -20.0
        return LineCrf(np.zeros(width), np.ones(width), np.zeros(3 * width), odds, np.zeros((2, 2)), prior)
    lines = np.concatenate([x for x, _ in docs])
    crf = LineCrf(lines.mean(axis=0), lines.std(axis=0) + 1e-3, np.zeros(3 * width), 0.0, np.zeros((2, 2)), prior)
    docs = sorted(docs, key=lambda d: len(d[0]))
    parts = []
    for k in range(0, len(docs), 512):
        part = docs[k:k + 512]
        lengths = np.array([len(x) for x, _ in part])
        x = np.zeros((len(part), lengths.max(), 3 * width), np.float32)
        for row, (d, _) in zip(x, part):
            row[:len(d)] = crf.inputs(d)
        parts.append((x, lengths, np.array([y for _, y in part], float), np.arange(x.shape[1])[None, :] < lengths[:, None]))
    theta, m, v = np.zeros(3 * width + 5), 0.0, 0.0
    for k in range(1, steps + 1):
        weight, bias, trans = theta[:3 * width], theta[3 * width], theta[3 * width + 1:].reshape(2, 2)
        grad = ridge * len(docs) * theta
        for x, lengths, y, inside in parts:
            good, _, pairs = marginals(x @ weight + bias, lengths, trans)
            miss = np.where(inside, good - y[:, None], 0)
            grad[:3 * width] += np.tensordot(miss, x, ((0, 1), (0, 1)))
            grad[3 * width] += miss.sum()
            gold = np.array([[((lengths - 1) * (1 - y)).sum(), 0], [0, ((lengths - 1) * y).sum()]])
            grad[3 * width + 1:] += (pairs - gold).ravel()
        grad /= len(docs)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - rate * (1 - 0.9 * k / steps) * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-8)
    crf.weight, crf.bias, crf.trans = theta[:3 * width], float(theta[3 * width]), theta[3 * width + 1:].reshape(2, 2)
    return crf


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          docs_bound: int = TRAIN_DOCS, lines_bound: int = TRAIN_LINES) -> LineCrf:
    """Fits the CRF on at most ``docs_bound`` labelled documents, chosen by a hash of the id.

    Labels other than 0 and 1 are ignored; of several labels of one id the
    larger counts. Without labels, or with one label only, scores are constant.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(
        F.col(id_col).cast("long").alias("known_id")).agg(F.max(label_col).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("known_id"), "known_id").limit(docs_bound)  # bounds the broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("known_id")).select("doc_id", "y", "text")

    def run(batches):
        for batch in batches:
            out = ([], [], [])
            for doc, y, text in zip(*(batch.column(i) for i in range(3))):
                x, _ = figures(text.as_py())
                start = int(1e6 * float(x.sum())) % (len(x) - lines_bound + 1) if len(x) > lines_bound else 0
                for column, value in zip(out, (doc.as_py(), y.as_py(), x[start:start + lines_bound].tobytes())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())],
                                             names=["doc_id", "y", "x"])

    sample = rows.mapInArrow(run, "doc_id long, y int, x binary").collect()
    sample.sort(key=lambda r: (r["doc_id"], r["y"], bytes(r["x"])))
    return fit([(np.frombuffer(r["x"], np.float32).reshape(-1, len(FIGURES)), r["y"]) for r in sample])


def score(text: Column, crf: LineCrf) -> Column:
    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(crf.scores(texts.tolist()))

    return run(text)


def classify(docs: DataFrame, crf: LineCrf, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Null and empty texts, and texts of spaces, score the share of label 1 among
    the rows learned from. Equal texts get equal scores; a null id is not held
    out; an empty table gives an empty result; other columns are not read. Very
    long texts are read whole; memory is some 200 bytes a line of the longest
    one, not its lines times the number of other texts.
    """
    scored = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), score(text_of(text_col), crf).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, crf: LineCrf, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows predicted bad; columns unchanged."""
    return carried(docs, score=score(text_of(text_col), crf)).filter(F.col("score") >= threshold).select("row.*")
