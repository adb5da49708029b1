"""Log-depth scans over chunked sequences for the hidden Markov model.

A chunk of a sequence acts on the model's state as one matrix: sum-product for
likelihoods and expected counts, max-plus for the best path. Products of such
matrices are associative, so an author's chunks are combined in a tree of
``FAN`` children a node. Going up, each node's product is formed; coming down,
each node passes the boundaries it got (forward vector before and backward
vector after it, or entry and exit state) on to its children. Groups hold at
most ``FAN`` matrices, so no task ever sees a whole author, and only matrices
move: the phases stay where they are until the boundaries are joined to them.

All kernels work on many rows at once; rows are sorted by length and cut into
blocks of at most ``CELLS`` cells, a longer row being a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 64
CELLS = 1 << 18


# -- Arrow <-> numpy -------------------------------------------------------------
def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all values, lengths) of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def vectors(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` numbers; null lists are rows of NaN."""
    out = np.full((len(column), width), np.nan)
    given = column.is_valid().to_numpy(zero_copy_only=False)
    out[given] = column.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    return out


def list_column(rows: np.ndarray, absent: np.ndarray | None = None) -> pa.Array:
    """Rows of numbers as a list column, null where ``absent``."""
    rows = rows.reshape(len(rows), -1)
    keep = np.ones(len(rows), bool) if absent is None else ~absent
    ends = np.concatenate(([0], np.cumsum(keep * rows.shape[1]))).astype(np.int32)
    offsets = pa.array(ends, pa.int32(), mask=np.append(~keep, False))
    return pa.ListArray.from_arrays(offsets, pa.array(rows[keep].ravel()))


def blocks(flat: np.ndarray, length: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, padded phases, lengths) of sequences of like length; empty ones are left out."""
    start = np.cumsum(length) - length
    order = np.argsort(length, kind="stable")
    order = order[length[order] > 0]
    at = 0
    while at < len(order):
        sizes = length[order[at:]]
        stop = at + max(1, int(np.searchsorted(np.arange(1, len(sizes) + 1) * sizes, CELLS, "right")))
        rows = order[at:stop]
        n = length[rows]
        inside = np.arange(n.max())[None, :] < n[:, None]
        phases = np.zeros(inside.shape, np.int64)
        phases[inside] = flat[np.repeat(start[rows], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        yield rows, phases, n
        at = stop


# -- kernels ----------------------------------------------------------------------
def sum_transfers(phases, n, first, pi, A, B) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, log scale) of each chunk: forward vector after it = vector before it @ matrix.
    A ``first`` chunk holds the start, and takes a vector of ones."""
    e = B.T[phases]
    m = np.where(first[:, None, None], np.eye(len(pi)) * (pi * e[:, 0])[:, None, :], A * e[:, 0][:, None, :])
    scale = np.zeros(len(n))
    for t in range(phases.shape[1]):
        on = t < n
        if t:
            m[on] = (m[on] @ A) * e[on, t][:, None, :]
        s = m[on].sum(axis=(1, 2))
        m[on] /= s[:, None, None]
        scale[on] += np.log(s)
    return m, scale


def max_transfers(phases, n, first, lpi, lA, lB) -> np.ndarray:
    """Best log score from the state before a chunk to the one at its end; a first chunk's is in row 0."""
    e = lB.T[phases]
    m = lA + e[:, 0][:, None, :]
    m[first] = -np.inf
    m[first, 0] = (lpi + e[:, 0])[first]
    for t in range(1, phases.shape[1]):
        on = t < n
        m[on] = (m[on][:, :, :, None] + lA).max(axis=2) + e[on, t][:, None, :]
    return m


def expected(phases, n, weight, before, after, pi, A, B):
    """Weighted expected counts (start, transitions, emissions) and the log-likelihood of each row.

    ``before``: forward vector before the chunk (NaN: it begins the sequence),
    ``after``: backward vector at its last place (NaN: it ends it). The
    likelihood is that of whole sequences, NaN for others."""
    rows, width = phases.shape
    size, e = len(pi), B.T[phases]
    begins, ends = np.isnan(before[:, 0]), np.isnan(after[:, 0])
    alpha, scale = np.zeros((rows, width, size)), np.ones((rows, width))
    for t in range(width):
        on = t < n
        into = np.where(begins[:, None], pi, np.nan_to_num(before) @ A)[on] if t == 0 else alpha[on, t - 1] @ A
        a = into * e[on, t]
        scale[on, t] = a.sum(axis=1)
        alpha[on, t] = a / scale[on, t][:, None]
    beta = np.zeros((rows, width, size))
    beta[np.arange(rows), n - 1] = np.where(ends[:, None], 1.0 / size, np.nan_to_num(after))
    trans = np.zeros((size, size))

    def pairs(a, nxt, w):  # a: forward vectors, nxt: emission times backward vectors one place on
        joint = (a @ A * nxt).sum(axis=1)
        return A * ((a * (w / joint)[:, None]).T @ nxt)

    for t in range(width - 2, -1, -1):
        on = t + 1 < n
        nxt = e[on, t + 1] * beta[on, t + 1]
        b = nxt @ A.T
        beta[on, t] = b / b.sum(axis=1, keepdims=True)
        trans += pairs(alpha[on, t], nxt, weight[on])
    if (~begins).any():
        trans += pairs(before[~begins], e[~begins, 0] * beta[~begins, 0], weight[~begins])
    gamma = alpha * beta
    inside = np.arange(width)[None, :] < n[:, None]
    gamma[inside] *= (np.repeat(weight, n) / gamma[inside].sum(axis=1))[:, None]
    emit = np.zeros((B.shape[1], size))
    np.add.at(emit, phases[inside], gamma[inside])
    return gamma[begins, 0].sum(axis=0), trans, emit.T, np.where(begins & ends, np.log(scale).sum(axis=1), np.nan)


def best_paths(phases, n, enter, leave, lpi, lA, lB) -> tuple[np.ndarray, np.ndarray]:
    """(paths, log score): from state ``enter`` (-1: the start) to ``leave`` (-1: the best end); the lower state wins ties."""
    rows, width = phases.shape
    e, every = lB.T[phases], np.arange(rows)
    d = np.where((enter < 0)[:, None], lpi, lA[enter]) + e[:, 0]
    back = np.zeros((rows, width, len(lpi)), np.int8)
    for t in range(1, width):
        step = d[:, :, None] + lA
        back[:, t] = step.argmax(axis=1)
        d = np.where((t < n)[:, None], step.max(axis=1) + e[:, t], d)
    state = np.where(leave < 0, d.argmax(axis=1), leave)
    score, paths = d[every, state], np.zeros((rows, width), np.int32)
    for t in range(width - 1, -1, -1):
        on = t < n
        paths[on, t] = state[on]
        if t:
            state = np.where(on, back[every, t, state], state)
    return paths, score


# -- nodes of the tree --------------------------------------------------------------
def _children(batch: pa.RecordBatch, size: int):
    """(matrices rows x places x S x S, scales, number of children, their places in the batch)."""
    kids = batch.column("kids")
    n = np.diff(kids.offsets.to_numpy())
    flat = kids.flatten()
    inside = np.arange(max(n.max(initial=0), 1))[None, :] < n[:, None]
    m, scale = np.zeros((*inside.shape, size, size)), np.zeros(inside.shape)
    m[inside] = flat.field("m").flatten().to_numpy(zero_copy_only=False).reshape(-1, size, size)
    scale[inside] = flat.field("scale").to_numpy(zero_copy_only=False)
    return m, scale, n, inside, flat.field("place")


def _product(m, scale, n, largest: bool):
    out, total = m[:, 0].copy(), scale[:, 0].copy()
    for p in range(1, m.shape[1]):
        on = p < n
        if largest:
            out[on] = (out[on][:, :, :, None] + m[on, p][:, None]).max(axis=2)
        else:
            out[on] = out[on] @ m[on, p]
            s = out[on].sum(axis=(1, 2))
            out[on] /= s[:, None, None]
            total[on] += scale[on, p] + np.log(s)
    return out, total


def _pass_sum(m, scale, n, before, after):
    """Boundaries of the children of each node, and the log-likelihood up to its end."""
    rows, places, size, _ = m.shape
    a, b = np.full((rows, places, size), np.nan), np.full((rows, places, size), np.nan)
    v, total = before.copy(), np.zeros(rows)
    for p in range(places):
        on = p < n
        a[on, p] = v[on]
        nxt = (np.where(np.isnan(v), 1.0, v)[on][:, None, :] @ m[on, p])[:, 0]
        s = nxt.sum(axis=1)
        total[on] += scale[on, p] + np.log(s)
        v[on] = nxt / s[:, None]
    u = after.copy()
    for p in range(places - 1, -1, -1):
        on = p < n
        b[on, p] = u[on]
        nxt = (m[on, p] @ np.where(np.isnan(u), 1.0, u)[on][:, :, None])[:, :, 0]
        u[on] = nxt / nxt.sum(axis=1, keepdims=True)
    return a, b, total


def _pass_max(m, n, enter, leave):
    rows, places, size, _ = m.shape
    every, back = np.arange(rows), np.zeros((rows, places, size), np.int64)
    d = m[every, 0, np.maximum(enter, 0)]
    for p in range(1, places):
        step = d[:, :, None] + m[:, p]
        back[:, p] = step.argmax(axis=1)
        d = np.where((p < n)[:, None], step.max(axis=1), d)
    state = np.where(leave < 0, d.argmax(axis=1), leave)
    score, out = d[every, state], np.zeros((rows, places), np.int64)
    for p in range(places - 1, -1, -1):
        on = p < n
        out[on, p] = state[on]
        if p:
            state = np.where(on, back[every, p, state], state)
    return np.concatenate((enter[:, None], out[:, :-1]), axis=1), out, score


def depth(most_chunks: int) -> int:
    """Levels of the tree above authors of at most so many chunks."""
    levels = 0
    while most_chunks > 1:
        most_chunks, levels = -(-most_chunks // FAN), levels + 1
    return levels


def boundaries(leaves: DataFrame, key: str, size: int, levels: int, largest: bool = False) -> DataFrame:
    """(key, chunk, before, after, score) for leaves (key, chunk, m, scale) of ``size`` states.

    Sum-product: forward and backward vectors, null at the ends of the sequence.
    ``largest``: entry and exit state, as lists of one. ``score`` is the log
    score of the whole sequence, on chunk 0 only."""
    kind = leaves.schema[key].dataType.simpleString()
    ends = "before array<double>, after array<double>, score double"

    def up(batches):
        for batch in batches:
            m, total = _product(*_children(batch, size)[:3], largest)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("run"), list_column(m), pa.array(total)],
                                             names=[key, "chunk", "m", "scale"])

    def down(batches):
        for batch in batches:
            m, scale, n, inside, place = _children(batch, size)
            if largest:
                state = [np.nan_to_num(vectors(batch.column(c), 1)[:, 0], nan=-1).astype(np.int64) for c in ("before", "after")]
                a, b, score = _pass_max(m, n, *state)
                a, b = a[inside].astype(float), b[inside].astype(float)
                before, after = list_column(a, a < 0), list_column(b)
            else:
                a, b, score = _pass_sum(m, scale, n, *(vectors(batch.column(c), size) for c in ("before", "after")))
                a, b = a[inside], b[inside]
                before, after = list_column(a, np.isnan(a[:, 0])), list_column(b, np.isnan(b[:, 0]))
            known = batch.column("score").to_numpy(zero_copy_only=False)
            score = np.where(np.isnan(known), score, known)
            owner, at = np.repeat(np.arange(len(n)), n), place.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(pa.array(owner)), place, before, after, pa.array(score[owner], mask=at != 0)],
                names=[key, "chunk", "before", "after", "score"])

    tree, rows = [], leaves
    for level in range(max(levels, 1)):
        nodes = rows.groupBy(key, F.expr(f"chunk div {FAN}").alias("run")).agg(
            F.array_sort(F.collect_list(F.struct(F.col("chunk").alias("place"), "m", "scale"))).alias("kids"))
        if level + 1 < levels:  # read on the way up and on the way down
            nodes = nodes.checkpoint()
            rows = nodes.mapInArrow(up, f"{key} {kind}, chunk long, m array<double>, scale double")
        tree.append(nodes)
    bounds = None
    for nodes in reversed(tree):
        if bounds is None:  # the roots: whole sequences
            nodes = nodes.select(key, "run", "kids", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("before", "array<double>"), ("after", "array<double>"), ("score", "double"))])
        else:
            nodes = nodes.join(bounds.withColumnRenamed("chunk", "run"), [key, "run"]).select(key, "run", "kids", "before", "after", "score")
        bounds = nodes.mapInArrow(down, f"{key} {kind}, chunk long, {ends}")
    return bounds


# -- jobs over chunks -----------------------------------------------------------------
def leaves(chunks: DataFrame, key: str, params, largest: bool = False) -> DataFrame:
    """(key, chunk, m, scale) of chunks (key, chunk, seq); ``params`` is a broadcast (start, trans, emit)."""
    kind = chunks.schema[key].dataType.simpleString()

    def run(batches):
        model = params.value
        with np.errstate(divide="ignore"):
            logs = [np.log(x) for x in model]
        for batch in batches:
            first = batch.column("chunk").to_numpy(zero_copy_only=False) == 0
            size = len(model[0])
            m, scale = np.zeros((batch.num_rows, size, size)), np.zeros(batch.num_rows)
            for rows, phases, n in blocks(*lists(batch.column("seq"))):
                if largest:
                    m[rows] = max_transfers(phases, n, first[rows], *logs)
                else:
                    m[rows], scale[rows] = sum_transfers(phases, n, first[rows], *model)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("chunk"), list_column(m), pa.array(scale)],
                                             names=[key, "chunk", "m", "scale"])

    return chunks.select(key, "chunk", "seq").mapInArrow(run, f"{key} {kind}, chunk long, m array<double>, scale double")


def expected_counts(rows: DataFrame, params) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Sums over rows (seq, w, before, after, score): start, transitions, emissions, log-likelihood.

    One row of partial sums per partition reaches the driver."""
    def run(batches):
        pi, A, B = params.value
        start, trans, emit, ll = np.zeros(len(pi)), np.zeros(A.shape), np.zeros(B.shape), 0.0
        for batch in batches:
            weight, score = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("w", "score"))
            before, after = (vectors(batch.column(c), len(pi)) for c in ("before", "after"))
            ll += float(np.nansum(weight * score))
            for at, phases, n in blocks(*lists(batch.column("seq"))):
                g, x, em, own = expected(phases, n, weight[at], before[at], after[at], pi, A, B)
                start, trans, emit, ll = start + g, trans + x, emit + em, ll + float(np.nansum(weight[at] * own))
        yield pa.RecordBatch.from_arrays([*(list_column(x.reshape(1, -1)) for x in (start, trans, emit)), pa.array([ll])],
                                         names=["start", "trans", "emit", "ll"])

    found = rows.select("seq", "w", "before", "after", "score").mapInArrow(
        run, "start array<double>, trans array<double>, emit array<double>, ll double").collect()
    _, A, B = params.value
    start, trans, emit = (np.sum([r[c] for r in found], axis=0) for c in ("start", "trans", "emit"))
    return start, trans.reshape(A.shape), emit.reshape(B.shape), float(sum(r["ll"] for r in found))


def paths(rows: DataFrame, key: str, params) -> DataFrame:
    """(key, chunk, path, logp, seq) of rows (key, chunk, seq, before, after, score); logp on chunk 0."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        with np.errstate(divide="ignore"):
            logs = [np.log(x) for x in params.value]
        for batch in batches:
            flat, length = lists(batch.column("seq"))
            enter, leave = (np.nan_to_num(vectors(batch.column(c), 1)[:, 0], nan=-1).astype(np.int64) for c in ("before", "after"))
            score = batch.column("score").to_numpy(zero_copy_only=False).astype(float).copy()
            ends = np.cumsum(length)
            out = np.zeros(len(flat), np.int32)
            for at, phases, n in blocks(flat, length):
                found, own = best_paths(phases, n, enter[at], leave[at], *logs)
                inside = np.arange(phases.shape[1])[None, :] < n[:, None]
                out[np.repeat(ends[at] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = found[inside]
                score[at] = np.where(leave[at] < 0, own, score[at])
            column = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(out))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("chunk"), column, pa.array(score, mask=np.isnan(score)),
                                              batch.column("seq")], names=[key, "chunk", "path", "logp", "seq"])

    return rows.select(key, "chunk", "seq", "before", "after", "score").mapInArrow(
        run, f"{key} {kind}, chunk long, path array<int>, logp double, seq array<int>")
