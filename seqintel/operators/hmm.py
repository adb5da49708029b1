"""Categorical hidden Markov model on phase sequences.

* Scoring (K7), decoding (K8) and prediction (K9) are built-in higher-order
  expressions (``aggregate`` / ``transform``) over the sequence array, with
  the model embedded as literals: they run inside whole-stage codegen, no
  Python in the hot path.
* Training (K6) is distributed Baum-Welch: each iteration broadcasts the
  current parameters, runs forward-backward over the stored training rows
  (numpy on many rows at once, boundaries of longer sequences by a tree scan),
  returns one row of partial expected counts per partition and normalises on
  the driver (S + S^2 + S*M numbers). ``em_step`` is one iteration in
  built-in expressions. The training rows are checkpointed to the cluster's
  checkpoint folder so a lost executor recomputes from there.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import dictionaries as D
from ..functions.text import let
from ..session import dealt

N_PHASES = len(D.PHASES)


class TrainingDataError(ValueError):
    """K5: not enough data to fit a model."""


@dataclass
class HMM:
    start: list[float]
    trans: list[list[float]]
    emit: list[list[float]]
    history: list[float] = field(default_factory=list)

    @property
    def n_states(self) -> int:
        return len(self.start)

    @property
    def n_symbols(self) -> int:
        return len(self.emit[0])

    def next_table(self) -> list[list[float]]:
        """C5 in numpy: P(next phase | last state) = sum_s A[last,s] B[s,f], normalised."""
        A, B = np.array(self.trans), np.array(self.emit)
        nxt = A @ B
        return (nxt / nxt.sum(axis=1, keepdims=True)).tolist()


# Fixed irregular model used by fixtures (FIXTURES.md, fx_hmm).
FX_HMM = HMM(
    start=[.41, .29, .19, .11],
    trans=[[.61, .19, .13, .07], [.17, .59, .11, .13], [.07, .23, .53, .17], [.11, .05, .31, .53]],
    emit=[[.47, .21, .13, .09, .06, .04], [.11, .37, .29, .12, .08, .03],
          [.05, .07, .23, .41, .17, .07], [.03, .05, .08, .14, .28, .42]],
)


def _log(p: float) -> float:
    return math.log(p) if p > 0 else float("-inf")


def _lit_vec(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def _lit_mat(m) -> Column:
    return F.array(*[_lit_vec(r) for r in m])


# -- A9: model <-> three long tables ---------------------------------------
def model_frames(spark: SparkSession, m: HMM) -> tuple[DataFrame, DataFrame, DataFrame]:
    s = spark.createDataFrame([(i, float(p)) for i, p in enumerate(m.start)], "i INT, p DOUBLE")
    t = spark.createDataFrame([(i, j, float(p)) for i, r in enumerate(m.trans) for j, p in enumerate(r)],
                              "i INT, j INT, p DOUBLE")
    e = spark.createDataFrame([(i, k, float(p)) for i, r in enumerate(m.emit) for k, p in enumerate(r)],
                              "i INT, k INT, p DOUBLE")
    return s, t, e


def save_model(spark: SparkSession, m: HMM, path: str) -> None:
    s, t, e = model_frames(spark, m)
    for name, df in (("start", s), ("trans", t), ("emit", e)):
        df.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark: SparkSession, path: str) -> HMM | None:
    """The stored model; None if there is none. Any other trouble is raised, so
    that a model which cannot be read is never fitted anew and overwritten."""
    try:
        s = spark.read.parquet(f"{path}/start").collect()
    except AnalysisException as ex:
        if ex.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    t = spark.read.parquet(f"{path}/trans").collect()
    e = spark.read.parquet(f"{path}/emit").collect()
    S = len(s)
    M = 1 + max(r["k"] for r in e)
    start = [0.0] * S
    trans = [[0.0] * S for _ in range(S)]
    emit = [[0.0] * M for _ in range(S)]
    for r in s:
        start[r["i"]] = r["p"]
    for r in t:
        trans[r["i"]][r["j"]] = r["p"]
    for r in e:
        emit[r["i"]][r["k"]] = r["p"]
    return HMM(start, trans, emit)


def load_or_fit(spark: SparkSession, path: str, seqs: DataFrame, refit: bool = False, **kw) -> HMM:
    m = None if refit else load_model(spark, path)
    if m is None:
        m = fit_hmm(seqs, **kw)
        save_model(spark, m, path)
    return m


# -- C5: join form of the next-phase table ---------------------------------
def next_phase_frame(trans: DataFrame, emit: DataFrame) -> DataFrame:
    """(last_state, phase, p) = sum_s A[last,s] B[s,phase], normalised per
    last_state. Both inputs are model-sized (S^2, S*M rows): broadcast."""
    j = F.broadcast(trans).alias("a").join(F.broadcast(emit).alias("b"), F.col("a.j") == F.col("b.i"))
    raw = j.groupBy(F.col("a.i").alias("last_state"), F.col("b.k").alias("phase")).agg(
        F.sum(F.col("a.p") * F.col("b.p")).alias("_q"))
    tot = raw.groupBy("last_state").agg(F.sum("_q").alias("_t"))
    return raw.join(F.broadcast(tot), "last_state").select(
        F.col("last_state").cast("int"), F.col("phase").cast("int"), (F.col("_q") / F.col("_t")).alias("p"))


# -- K7: forward log-likelihood --------------------------------------------
def forward_loglik(seq, m: HMM) -> Column:
    """Scaled forward pass; NULL for an empty sequence, -inf for an impossible one."""
    S = m.n_states
    st, A, B = _lit_vec(m.start), _lit_mat(m.trans), _lit_mat(m.emit)
    seq = F.col(seq) if isinstance(seq, str) else seq
    idx = F.sequence(F.lit(0), F.lit(S - 1))

    def scaled(v, ll0):
        # v evaluated once; c = left-to-right sum; returns (v / c, ll0 + log c)
        return let(v, lambda vv: let(F.aggregate(vv, F.lit(0.0), lambda a, y: a + y), lambda c: F.when(c > 0, F.struct(
            F.transform(vv, lambda x: x / c).alias("a"), (ll0 + F.log(c)).alias("ll"))).otherwise(F.struct(
                vv.alias("a"), F.lit(float("-inf")).alias("ll")))))

    o1 = F.element_at(seq, 1)
    init = scaled(F.transform(idx, lambda j: st[j] * B[j][o1]), F.lit(0.0))

    def step(acc, o):
        a = acc["a"]
        nxt = F.transform(idx, lambda j: F.aggregate(
            idx, F.lit(0.0), lambda s, i: s + a[i] * A[i][j]) * B[j][o])
        return scaled(nxt, acc["ll"])

    rest = F.slice(seq, 2, F.greatest(F.size(seq) - 1, F.lit(0)))
    return F.when(F.size(seq) > 0, F.aggregate(rest, init, step)["ll"])


# -- K8: Viterbi --------------------------------------------------------------
def viterbi(seq, m: HMM) -> Column:
    """Most likely state path and its log-probability: ``struct(logp, path)``.
    Ties go to the lower state, as numpy's argmax does."""
    S = m.n_states
    lst = _lit_vec([_log(p) for p in m.start])
    lA = _lit_mat([[_log(p) for p in r] for r in m.trans])
    lB = _lit_mat([[_log(p) for p in r] for r in m.emit])
    seq = F.col(seq) if isinstance(seq, str) else seq
    idx = F.sequence(F.lit(0), F.lit(S - 1))

    def argmax(vals):
        return F.array_position(vals, F.array_max(vals)) - 1

    o1 = F.element_at(seq, 1)
    init = F.struct(F.transform(idx, lambda j: lst[j] + lB[j][o1]).alias("d"),
                    F.transform(idx, lambda j: F.array(j)).alias("p"))

    def step(acc, o):
        d, p = acc["d"], acc["p"]
        cand = F.transform(idx, lambda j: F.transform(idx, lambda i: d[i] + lA[i][j]))
        return let(cand, lambda cd: F.struct(
            F.transform(idx, lambda j: F.array_max(cd[j]) + lB[j][o]).alias("d"),
            F.transform(idx, lambda j: F.concat(p[argmax(cd[j]).cast("int")], F.array(j))).alias("p")))

    rest = F.slice(seq, 2, F.greatest(F.size(seq) - 1, F.lit(0)))
    fin = F.aggregate(rest, init, step)
    return F.when(F.size(seq) > 0, let(fin, lambda f: F.struct(
        F.array_max(f["d"]).alias("logp"), f["p"][argmax(f["d"]).cast("int")].alias("path"))))


# -- D9 ---------------------------------------------------------------------
def dominant_state(path, n_states: int) -> Column:
    """Most frequent state in the path; tie -> the one seen first."""
    path = F.col(path) if isinstance(path, str) else path
    idx = F.sequence(F.lit(0), F.lit(n_states - 1))
    cand = F.transform(idx, lambda s: F.struct(
        F.size(F.filter(path, lambda x: x == s)).alias("n"),
        (-F.array_position(path, s)).alias("neg_first"), s.alias("s")))
    present = F.filter(cand, lambda c: c["n"] > 0)
    return F.array_max(present)["s"].cast("int")


# -- K9 / K10 ---------------------------------------------------------------
def phase_names() -> Column:
    return F.array(*[F.lit(n) for _, n, _ in D.PHASES])


def with_prediction(df: DataFrame, seq, m: HMM, prefix: str = "") -> DataFrame:
    """K9 as columns: decoded path, last state, predicted phase, confidence,
    probability per phase. Empty sequence -> NULLs and the no-data name.

    The Viterbi pass is materialised once in its own projection and every
    derived column reads it (Catalyst keeps the two projections apart because
    merging would duplicate the non-cheap decode)."""
    seq = F.col(seq) if isinstance(seq, str) else seq
    nxt = _lit_mat(m.next_table())
    vcol = f"{prefix}_vit"
    d = df.withColumn(vcol, viterbi(seq, m))
    last = F.element_at(F.col(vcol)["path"], -1)
    d = d.withColumns({f"{prefix}path": F.col(vcol)["path"], f"{prefix}last_state": last.cast("int"),
                       f"{prefix}probs": nxt[last]}).drop(vcol)
    probs = F.col(f"{prefix}probs")
    pred = (F.array_position(probs, F.array_max(probs)) - 1).cast("int")
    names = phase_names()
    return d.withColumns({
        f"{prefix}next_phase_id": pred,
        f"{prefix}next_phase_name": F.when(pred.isNull(), F.lit(D.NO_DATA_NAME)).otherwise(
            F.coalesce(names[pred], F.lit("Desconocida"))),
        f"{prefix}confidence": F.coalesce(F.array_max(probs), F.lit(0.0)),
    })


def analyze_authors(seqs: DataFrame, m: HMM, author_col: str = "author",
                    seq_col: str = "seq") -> DataFrame:
    """Per author, prediction + dominant state + state path; sequences
    shorter than 2 get NULLs and the fixed 'too short' texts."""
    short = F.size(seq_col) < 2
    df = with_prediction(seqs, seq_col, m, "_")
    return df.select(
        author_col, F.col(seq_col),
        F.size(seq_col).cast("long").alias("n_posts"),
        F.when(~short, F.col("_path")).alias("state_path"),
        F.when(~short, dominant_state("_path", m.n_states)).alias("dominant_state"),
        F.when(~short, F.col("_last_state")).alias("last_state"),
        F.when(~short, F.col("_next_phase_id")).alias("next_phase_id"),
        F.when(short, F.lit(D.SHORT_SEQUENCE_NAME)).otherwise(F.col("_next_phase_name")).alias("next_phase_name"),
        F.when(short, F.lit(0.0)).otherwise(F.col("_confidence")).alias("confidence"),
        F.when(~short, F.col("_probs")).alias("probs"),
        F.when(short, F.lit(D.SHORT_SEQUENCE_STATUS)).otherwise(F.lit("OK")).alias("status"),
    )


REPORT_COLUMNS = ["author", "n_posts", "dominant_state", "next_phase_id", "next_phase_name",
                  "confidence", "status"]


def author_report(analysis: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """A10 projection: 7 columns, confidence rounded to 4 (plus ``extra``)."""
    return analysis.select(*[F.round("confidence", 4).alias("confidence") if c == "confidence" else c
                             for c in REPORT_COLUMNS], *extra)


# -- K5 / K6: training --------------------------------------------------------
def check_training_data(seqs: DataFrame, n_states: int, seq_col: str = "seq") -> tuple[int, int]:
    """K5: total posts >= 3 * states and at least one sequence of length >= 2."""
    r = seqs.agg(F.coalesce(F.sum(F.size(seq_col)), F.lit(0)).alias("n"),
                 F.count_if(F.size(seq_col) >= 2).alias("k")).first()
    if r["n"] < n_states * 3:
        raise TrainingDataError(f"too few posts ({r['n']}) for {n_states} states")
    if r["k"] < 1:
        raise TrainingDataError("no sequence has at least 2 posts")
    return int(r["n"]), int(r["k"])


def trainable(total_posts: str, n_sequences: str, n_states: int) -> Column:
    """The K5 rule on counts."""
    return (F.col(total_posts) >= 3 * n_states) & (F.col(n_sequences) >= 1)


def _init_model(n_states: int, n_symbols: int, seed: int) -> HMM:
    rng = np.random.RandomState(seed)
    start = rng.dirichlet(np.ones(n_states))
    trans = rng.dirichlet(np.ones(n_states), size=n_states)
    emit = rng.dirichlet(np.ones(n_symbols), size=n_states)
    return HMM(start.tolist(), trans.tolist(), emit.tolist())


def training_rows(seqs: DataFrame, n_states: int, seq_col: str = "seq", min_len: int = 2, key: str = "author") -> tuple[DataFrame, int]:
    """K5 checks, then the rows an E-step runs over, and the levels of their tree.

    Whole sequences are told apart by their phases and weighted by their number;
    longer ones are their chunks. The rows (author, chunk, seq, n_chunks, w) are
    written once, dealt by (author, chunk): boundaries are later joined to them
    where they lie, so no iteration moves a phase.
    """
    from . import longseq as LS
    from . import scan as SC
    if "n_chunks" not in seqs.columns:
        seqs = seqs.withColumns({"chunk": F.lit(0).cast("long"), "n_chunks": F.lit(1).cast("long")})
    seqs = seqs.select(F.col(key).cast("string").alias("author"), "chunk", F.col(seq_col).alias("seq"), "n_chunks")
    total = seqs.agg(F.coalesce(F.sum(F.size("seq")), F.lit(0)).alias("n"),
                     F.count_if((F.col("n_chunks") > 1) | (F.size("seq") >= 2)).alias("k")).first()
    if total["n"] < n_states * 3:
        raise TrainingDataError(f"too few posts ({total['n']}) for {n_states} states")
    if total["k"] < 1:
        raise TrainingDataError("no sequence has at least 2 posts")
    whole = seqs.where((F.col("n_chunks") == 1) & (F.size("seq") >= min_len)).groupBy("seq").agg(F.count(F.lit(1)).cast("double").alias("w")).select(
        F.lit(None).cast("string").alias("author"), F.xxhash64("seq").alias("chunk"), "seq", F.lit(1).cast("long").alias("n_chunks"), "w")
    rows = whole.unionByName(seqs.where(F.col("n_chunks") > 1).withColumn("w", F.lit(1.0)))
    rows = dealt(rows, "author", "chunk")
    return rows, SC.depth(LS.most_chunks(rows))


def expected_counts(rows: DataFrame, levels: int, m: HMM):
    """K6 E-step over training rows: expected starts, transitions and emissions, and the log-likelihood."""
    from . import longseq as LS
    from . import scan as SC
    params = rows.sparkSession.sparkContext.broadcast((np.array(m.start), np.array(m.trans), np.array(m.emit)))
    try:
        return SC.expected_counts(LS.with_boundaries(rows, "author", params, m.n_states, levels), params)
    finally:
        params.unpersist()


def maximised(start: np.ndarray, trans: np.ndarray, emit: np.ndarray) -> HMM:
    """K6 M-step: counts to shares; a state without counts keeps zeros."""
    def shares(x):
        total = x.sum(axis=-1, keepdims=True)
        return (x / np.where(total == 0, 1, total)).tolist()

    return HMM(shares(start), shares(trans), shares(emit))


def fit_hmm(seqs: DataFrame, n_states: int = D.N_STATES, max_iter: int = D.MAX_ITER,
            tol: float = D.TOL, seed: int = D.SEED, seq_col: str = "seq",
            n_symbols: int = N_PHASES, min_len: int = 2, key: str = "author", start_model: HMM | None = None) -> HMM:
    """K6: distributed Baum-Welch, from ``start_model`` or a seeded random one.

    ``seqs`` is either one row per author (``seq`` array) or the chunked form
    of :func:`seqintel.operators.longseq.chunk_sequences` (``chunk``,
    ``n_chunks`` columns); no author is ever gathered whole.
    """
    rows, levels = training_rows(seqs, n_states, seq_col, min_len, key)
    m = start_model or _init_model(n_states, n_symbols, seed)
    history: list[float] = []
    for _ in range(max_iter):
        start, trans, emit, ll = expected_counts(rows, levels, m)
        m = maximised(start, trans, emit)
        history.append(ll)
        if len(history) > 1 and history[-1] - history[-2] < tol:
            break
    m.history = history
    return m


# -- K6, one step in built-ins ---------------------------------------------------
def forward_backward(seq, m: HMM) -> Column:
    """Expected counts of one sequence as ``struct(start, trans, emit, ll)``, trans and
    emit flat by rows; NULL for an empty sequence.

    A scan forwards keeps the scaled forward vectors; a scan backwards carries
    the backward vector and adds each place's counts. For sequences of bounded
    length (the forward vectors of one are held in its row).
    """
    S, M = m.n_states, m.n_symbols
    st, A, B = _lit_vec(m.start), _lit_mat(m.trans), _lit_mat(m.emit)
    seq = F.col(seq) if isinstance(seq, str) else seq
    idx, total = F.sequence(F.lit(0), F.lit(S - 1)), lambda v: F.aggregate(v, F.lit(0.0), lambda a, y: a + y)

    def unit(v):
        return let(v, lambda x: let(total(x), lambda c: F.transform(x, lambda y: y / c)))

    def advance(v, before):  # before: struct(a, ll)
        return let(v, lambda x: let(total(x), lambda c: F.array_append(before, F.struct(
            F.transform(x, lambda y: y / c).alias("a"), F.log(c).alias("c")))))

    none = F.array().cast("array<struct<a:array<double>,c:double>>")
    first = F.element_at(seq, 1)
    ahead = F.aggregate(
        F.slice(seq, 2, F.greatest(F.size(seq) - 1, F.lit(0))), advance(F.transform(idx, lambda j: st[j] * B[j][first]), none),
        lambda acc, o: advance(F.transform(idx, lambda j: F.aggregate(
            idx, F.lit(0.0), lambda s, i: s + F.element_at(acc, -1)["a"][i] * A[i][j]) * B[j][o]), acc))

    def counted(fw):
        n = F.size(seq)

        def posterior(a, b):
            return unit(F.transform(idx, lambda i: a[i] * b[i]))

        def emitted(acc, g, o):  # flat S x M counts
            return F.transform(acc, lambda x, k: x + F.when(k % M == o, g[F.floor(k / M).cast("int")]).otherwise(0.0))

        ones = F.transform(idx, lambda i: F.lit(1.0 / S))
        zero = F.array_repeat(F.lit(0.0), S * M), F.array_repeat(F.lit(0.0), S * S)
        last = let(posterior(F.element_at(fw, -1)["a"], ones), lambda g: F.struct(
            ones.alias("b"), g.alias("g"), zero[1].alias("x"), emitted(zero[0], g, F.element_at(seq, -1)).alias("e")))

        def step(acc, t):  # t: place from 1, its successor has been counted
            a = F.element_at(fw, t)["a"]
            nxt = F.transform(idx, lambda j: B[j][F.element_at(seq, t + 1)] * acc["b"][j])
            return let(nxt, lambda nx: let(unit(F.transform(F.sequence(F.lit(0), F.lit(S * S - 1)), lambda k: a[F.floor(k / S).cast("int")]
                                                             * A[F.floor(k / S).cast("int")][k % S] * nx[k % S])), lambda joint: let(
                unit(F.transform(idx, lambda i: F.aggregate(idx, F.lit(0.0), lambda s, j: s + A[i][j] * nx[j]))), lambda b: let(
                    posterior(a, b), lambda g: F.struct(
                        b.alias("b"), g.alias("g"), F.zip_with(acc["x"], joint, lambda p, q: p + q).alias("x"),
                        emitted(acc["e"], g, F.element_at(seq, t)).alias("e"))))))

        back = F.aggregate(F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>")), last, step)
        return let(back, lambda r: F.struct(r["g"].alias("start"), r["x"].alias("trans"), r["e"].alias("emit"),
                                            F.aggregate(fw, F.lit(0.0), lambda s, x: s + x["c"]).alias("ll")))

    return F.when(F.size(seq) > 0, let(ahead, counted))


def em_step(seqs: DataFrame, m: HMM, seq_col: str = "seq", min_len: int = 2) -> DataFrame:
    """One EM step in built-ins: (kind, i, j, expected, p), p being the new model.

    Kinds ``start`` (i), ``trans`` (i, j), ``emit`` (i, phase j) and ``loglik``
    (of the model given, in ``expected``). Equal sequences are counted once.
    """
    S, M = m.n_states, m.n_symbols
    distinct = seqs.where(F.size(seq_col) >= min_len).groupBy(F.col(seq_col).alias("seq")).agg(F.count(F.lit(1)).alias("w"))
    r = distinct.withColumn("r", forward_backward("seq", m))

    def cells(kind, column, width):
        return F.transform(column, lambda x, k: F.struct(
            F.lit(kind).alias("kind"), F.floor(k / width).cast("int").alias("i"),
            F.when(F.lit(kind) != "start", (k % width).cast("int")).alias("j"), x.alias("v")))

    ll = F.array(F.struct(F.lit("loglik").alias("kind"), F.lit(0).alias("i"), F.lit(None).cast("int").alias("j"), F.col("r.ll").alias("v")))
    rows = r.select("w", F.explode(F.concat(cells("start", F.col("r.start"), 1), cells("trans", F.col("r.trans"), S),
                                            cells("emit", F.col("r.emit"), M), ll)).alias("c"))
    counts = rows.groupBy("c.kind", "c.i", "c.j").agg(F.sum(F.col("w") * F.col("c.v")).alias("expected"))
    whole = Window.partitionBy("kind", F.when(F.col("kind") != "start", F.col("i")))
    return counts.withColumn("p", F.when(F.col("kind") != "loglik", F.col("expected") / F.nullif(F.sum("expected").over(whole), F.lit(0.0))))
