"""HMM: E-step, forward, Viterbi and prediction against full path enumeration."""
import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from seqintel.operators import hmm as H


def brute(m, obs):
    S = m.n_states
    best, best_p, tot = None, -1.0, 0.0
    for path in itertools.product(range(S), repeat=len(obs)):
        p = m.start[path[0]] * m.emit[path[0]][obs[0]]
        for t in range(1, len(obs)):
            p *= m.trans[path[t - 1]][path[t]] * m.emit[path[t]][obs[t]]
        tot += p
        if p > best_p + 1e-300:
            best, best_p = path, p
    return list(best), math.log(best_p), math.log(tot)


def small_model():
    return H.HMM(start=[.5, .3, .2], trans=[[.6, .3, .1], [.2, .5, .3], [.25, .25, .5]],
                 emit=[[.5, .2, .1, .1, .05, .05], [.1, .4, .3, .1, .05, .05], [.05, .05, .1, .2, .3, .3]])


def test_forward_and_viterbi_match_enumeration(spark):
    m = small_model()
    seqs = [[0], [1, 2], [5, 5, 0, 1], [3, 2, 1, 0, 4, 5], [2, 2, 2, 2, 2, 2]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "id INT, seq ARRAY<INT>")
    rows = df.select("id", H.forward_loglik("seq", m).alias("ll"), H.viterbi("seq", m).alias("v")) \
        .orderBy("id").collect()
    for r, s in zip(rows, seqs):
        path, lp, ll = brute(m, s)
        assert abs(r["ll"] - ll) < 1e-9
        assert r["v"]["path"] == path
        assert abs(r["v"]["logp"] - lp) < 1e-9


def test_estep_matches_enumeration(monkeypatch):
    monkeypatch.setattr("seqintel.operators.scan.CELLS", 7)
    m = small_model()
    rng = np.random.RandomState(1)
    seqs = [rng.randint(0, 6, size=rng.randint(1, 6)).tolist() for _ in range(9)]
    w = rng.randint(1, 4, size=9).astype(float)
    pi, A, B = np.array(m.start), np.array(m.trans), np.array(m.emit)
    from seqintel.operators import scan
    g0, xi, em, ll = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6)), 0.0
    none = np.full((9, 3), np.nan)
    for rows, phases, n in scan.blocks(np.concatenate(seqs), np.array([len(x) for x in seqs])):
        a, b, c, own = scan.expected(phases, n, w[rows], none[rows], none[rows], pi, A, B)
        g0, xi, em, ll = g0 + a, xi + b, em + c, ll + (w[rows] * own).sum()
    G0, XI, EM, LL = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6)), 0.0
    for o, wt in zip(seqs, w):
        tot, a, b, c = 0.0, np.zeros(3), np.zeros((3, 3)), np.zeros((3, 6))
        for path in itertools.product(range(3), repeat=len(o)):
            p = pi[path[0]] * B[path[0], o[0]]
            for t in range(1, len(o)):
                p *= A[path[t - 1], path[t]] * B[path[t], o[t]]
            tot += p
            a[path[0]] += p
            for t in range(len(o) - 1):
                b[path[t], path[t + 1]] += p
            for t in range(len(o)):
                c[path[t], o[t]] += p
        G0 += wt * a / tot
        XI += wt * b / tot
        EM += wt * c / tot
        LL += wt * math.log(tot)
    assert np.allclose(g0, G0) and np.allclose(xi, XI) and np.allclose(em, EM) and abs(ll - LL) < 1e-9


def test_fit_is_monotone_and_stochastic(spark):
    rng = np.random.RandomState(3)
    seqs = [(f"a{i}", rng.randint(0, 6, size=rng.randint(2, 12)).tolist()) for i in range(40)]
    df = spark.createDataFrame(seqs, "author STRING, seq ARRAY<INT>")
    m = H.fit_hmm(df, n_states=3, max_iter=15)
    h = m.history
    assert all(h[i + 1] >= h[i] - 1e-7 for i in range(len(h) - 1))
    assert abs(sum(m.start) - 1) < 1e-9
    assert all(abs(sum(r) - 1) < 1e-9 for r in m.trans)
    assert all(abs(sum(r) - 1) < 1e-9 for r in m.emit)


def test_training_checks(spark):
    df = spark.createDataFrame([("a", [1, 2])], "author STRING, seq ARRAY<INT>")
    try:
        H.check_training_data(df, 4)
        raise AssertionError("expected TrainingDataError")
    except H.TrainingDataError:
        pass


def test_analysis_short_and_dominant(spark):
    m = H.FX_HMM
    df = spark.createDataFrame([("s", [3]), ("l", [0, 0, 5, 5, 5])], "author STRING, seq ARRAY<INT>")
    rows = {r["author"]: r for r in H.analyze_authors(df, m).collect()}
    assert rows["s"]["status"].startswith("Secuencia demasiado corta")
    assert rows["s"]["next_phase_id"] is None and rows["s"]["confidence"] == 0.0
    path, _, _ = brute(m, [0, 0, 5, 5, 5])
    counts = {s: path.count(s) for s in set(path)}
    top = max(counts.values())
    want = next(s for s in path if counts[s] == top)
    assert rows["l"]["dominant_state"] == want
    nxt = np.array(m.trans)[path[-1]] @ np.array(m.emit)
    nxt = nxt / nxt.sum()
    assert rows["l"]["next_phase_id"] == int(np.argmax(nxt))
    assert abs(rows["l"]["confidence"] - nxt.max()) < 1e-12


def _long_frame(spark, seqs):
    rows = [(a, t, f"{a}-{t:05d}", [f"T{p}"]) for a, s in seqs for t, p in enumerate(s)]
    return spark.createDataFrame(rows, "author STRING, ts INT, message_id STRING, techniques ARRAY<STRING>")


def test_chunked_equals_whole(spark):
    """Chunked E-step / Viterbi (small chunks) equal the whole-sequence forms."""
    from seqintel.operators import longseq as LS
    rng = np.random.RandomState(7)
    seqs = [(f"a{i}", rng.randint(0, 6, size=rng.randint(1, 30)).tolist()) for i in range(12)]
    whole = spark.createDataFrame(seqs, "author STRING, seq ARRAY<INT>")
    # chunk the same sequences through positions + chunk_sequences
    long = spark.createDataFrame([(a, t, p) for a, s in seqs for t, p in enumerate(s)],
                                 "author STRING, t INT, phase INT")
    pos = LS.positions(long, ["author"], ["t"], n_partitions=3)
    got_pos = {(r["author"], r["t"]): r["pos"] for r in pos.collect()}
    assert all(got_pos[(a, t)] == t + 1 for a, s in seqs for t in range(len(s)))
    chunks = LS.chunk_sequences(pos, "author", "pos", "phase", L=4)
    m1 = H.fit_hmm(whole, n_states=3, max_iter=6)
    m2 = H.fit_hmm(chunks, n_states=3, max_iter=6)
    assert np.allclose(m1.history, m2.history, atol=1e-8)
    assert np.allclose(m1.trans, m2.trans, atol=1e-8) and np.allclose(m1.emit, m2.emit, atol=1e-8)
    m = H.FX_HMM
    dec = {r["author"]: r for r in LS.decode_chunks(chunks, m).collect()}
    for a, s in seqs:
        path, lp, _ = brute(m, s) if len(s) <= 6 else (None, None, None)
        v = spark.createDataFrame([(s,)], "seq ARRAY<INT>").select(H.viterbi("seq", m).alias("v")).first()["v"]
        assert dec[a]["last_state"] == v["path"][-1]
        assert abs(dec[a]["logp"] - v["logp"]) < 1e-9
        counts = {x: v["path"].count(x) for x in set(v["path"])}
        top = max(counts.values())
        assert dec[a]["dominant_state"] == next(x for x in v["path"] if counts[x] == top)
        assert dec[a]["n_posts"] == len(s)


def test_chunked_loglik_and_report(spark):
    from seqintel.operators import longseq as LS
    rng = np.random.RandomState(11)
    seqs = [(f"b{i}", rng.randint(0, 6, size=rng.randint(1, 20)).tolist()) for i in range(10)]
    long = spark.createDataFrame([(a, t, p) for a, s in seqs for t, p in enumerate(s)],
                                 "author STRING, t INT, phase INT")
    chunks = LS.chunk_sequences(LS.positions(long, ["author"], ["t"], n_partitions=2), "author", "pos", "phase", L=3)
    m = H.FX_HMM
    ll = {r["author"]: r["loglik"] for r in LS.loglik_chunks(chunks, m).collect()}
    whole = spark.createDataFrame(seqs, "author STRING, seq ARRAY<INT>")
    ref = {r["author"]: r["ll"] for r in whole.select("author", H.forward_loglik("seq", m).alias("ll")).collect()}
    assert all(abs(ll[a] - ref[a]) < 1e-9 for a in ref)
    rep = {r["author"]: tuple(r) for r in H.author_report(LS.analyze_chunks(chunks, m, L=3)).collect()}
    want = {r["author"]: tuple(r) for r in H.author_report(H.analyze_authors(whole, m)).collect()}
    assert rep == want


def test_chunked_holdout_predictions(spark):
    from seqintel.operators import evaluate as EV
    from seqintel.operators import longseq as LS
    rng = np.random.RandomState(13)
    seqs = [(f"c{i}", rng.randint(0, 6, size=n).tolist()) for i, n in enumerate([1, 2, 3, 4, 5, 7, 9, 13])]
    long = spark.createDataFrame([(a, t, p) for a, s in seqs for t, p in enumerate(s)],
                                 "author STRING, t INT, phase INT")
    chunks = LS.chunk_sequences(LS.positions(long, ["author"], ["t"], n_partitions=2), "author", "pos", "phase", L=3)
    got = {r["author"]: tuple(r) for r in LS.predictions_chunks(chunks, H.FX_HMM, L=3).collect()}
    whole = spark.createDataFrame(seqs, "author STRING, seq ARRAY<INT>")
    ref = EV.predictions(whole, H.FX_HMM).select("author", "truth", "truth_name", "pred", "pred_name",
                                                   "confidence", "correct")
    want = {r["author"]: tuple(r) for r in ref.collect()}
    assert got == want and "c0" not in got


def test_chunked_on_event_data_small_chunks(spark):
    """Real event sequences cut into 16-phase chunks give the whole-array report."""
    from seqintel.operators import longseq as LS
    from seqintel.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    chunks = LS.phase_chunks(Q._tech(spark, sf), ts_col="ts", id_col="event_id", L=16)
    assert chunks.agg(F.max("n_chunks")).first()[0] > 1
    got = {r["author"]: tuple(r) for r in H.author_report(LS.analyze_chunks(chunks, H.FX_HMM, L=16)).collect()}
    want = {r["author"]: tuple(r) for r in H.author_report(H.analyze_authors(Q._seq(spark, sf), H.FX_HMM)).collect()}
    assert got == want
    ll = {r["author"]: r["loglik"] for r in LS.loglik_chunks(chunks, H.FX_HMM).collect()}
    ref = {r["author"]: r["ll"] for r in Q._seq(spark, sf).select(
        "author", H.forward_loglik("seq", H.FX_HMM).alias("ll")).collect()}
    assert all(abs(ll[a] - ref[a]) < 1e-7 for a in ref)


def _as_rows(m, start, trans, emit, ll):
    want = {("loglik", 0, None): ll} | {("start", i, None): x for i, x in enumerate(start)}
    for kind, table in (("trans", trans), ("emit", emit)):
        want |= {(kind, i, j): x for i, row in enumerate(table) for j, x in enumerate(row)}
    return want


def test_em_step_built_in_equals_trees_of_any_depth(spark, monkeypatch):
    """One EM step: built-in scans, whole rows in numpy, and chunks in trees of several levels."""
    from seqintel.operators import longseq as LS
    from seqintel.operators import scan
    rng = np.random.RandomState(5)
    seqs = [(f"a{i}", rng.randint(0, 6, size=n).tolist()) for i, n in enumerate([1, 2, 2, 3, 7, 8, 40, 41, 90])] + [("b", [1, 2]), ("c", [1, 2])]
    whole = spark.createDataFrame(seqs, "author STRING, seq ARRAY<INT>")
    long = spark.createDataFrame([(a, t, p) for a, s in seqs for t, p in enumerate(s)], "author STRING, t INT, phase INT")
    chunks = LS.chunk_sequences(LS.positions(long, ["author"], ["t"], n_partitions=3), "author", "pos", "phase", L=3)
    got = {(r["kind"], r["i"], r["j"]): (r["expected"], r["p"]) for r in H.em_step(whole, H.FX_HMM).collect()}
    for fan in (2, 3, 64):
        monkeypatch.setattr(scan, "FAN", fan)
        for rows in (whole, chunks):
            work, levels = H.training_rows(rows, 4)
            counts = H.expected_counts(work, levels, H.FX_HMM)
            assert levels == (0 if rows is whole else scan.depth(30))
            want = _as_rows(H.FX_HMM, *counts)
            assert got.keys() == want.keys() and all(abs(got[k][0] - v) < 1e-8 for k, v in want.items())
        one = H.fit_hmm(chunks, max_iter=1, start_model=H.FX_HMM)
        want = _as_rows(one, one.start, one.trans, one.emit, None)
        assert all(abs(got[k][1] - v) < 1e-9 for k, v in want.items() if k[0] != "loglik")
        paths = {}
        for r in sorted(LS.chunk_paths(chunks, H.FX_HMM).collect(), key=lambda r: (r["author"], r["chunk"])):
            paths.setdefault(r["author"], []).extend(r["path"])
        ref = {r["author"]: r["v"]["path"] for r in whole.select("author", H.viterbi("seq", H.FX_HMM).alias("v")).collect()}
        assert paths == ref


def test_training_iteration_moves_no_phases(spark):
    """The join of the boundaries finds the training rows where they lie."""
    from seqintel.operators import longseq as LS
    long = spark.createDataFrame([(f"a{i % 3}", i, i % 6) for i in range(200)], "author STRING, t INT, phase INT")
    chunks = LS.chunk_sequences(LS.positions(long, ["author"], ["t"], n_partitions=3), "author", "pos", "phase", L=3)
    rows, levels = H.training_rows(chunks, 4)
    params = LS._params(rows, H.FX_HMM)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = LS.with_boundaries(rows, "author", params, 4, levels)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scans = [k for k, line in enumerate(lines) if "Scan ExistingRDD" in line]
    assert len(scans) == 2 and "Join" in plan  # the rows themselves, and the matrices made of them
    assert "Sort" in lines[scans[0] - 1] and "MapInArrow" in "".join(lines[scans[1] - 4:scans[1]])
    assert not any("Exchange" in line for line in lines[:scans[0]])
