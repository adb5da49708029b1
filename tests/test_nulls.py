"""NULL keys and times, token places, impossible sequences and unreadable models."""
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seqintel.operators import enrich as EN
from seqintel.operators import hmm as H
from seqintel.operators import longseq as LS
from seqintel.operators import report as RP
from seqintel.operators import sequences as SEQ


def test_positions_keep_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), (None, 4), ("b", 5)], "k STRING, o INT")
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("long")).collect()
    got = LS.positions(df, ["k"], ["o"], n_partitions=3).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_streaks_keep_null_hosts(spark):
    outcomes = ["ok", "server_error", "http_error", "blocked"]
    df = spark.createDataFrame([((None, "a", "b")[i % 3], i, i, outcomes[i * 7 % 4]) for i in range(60)],
                               "host STRING, ts INT, event_id INT, outcome STRING")
    want = RP.failure_streaks(df, threshold=3, partition=["host"]).select("event_id", "streak", "pause").collect()
    got = RP.failure_streaks_scan(df, threshold=3, n_partitions=4).select("event_id", "streak", "pause").collect()
    assert len(got) == 60 and sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_sequences_treat_null_times_and_authors_alike(spark):
    posts = spark.createDataFrame(
        [("a", 1, 1, ["T1190"]), ("a", None, 2, ["T1059"]), ("a", 3, 3, ["T1486"]), (None, 1, 4, ["T1190"]), (None, 2, 5, None)],
        "author STRING, ts INT, message_id INT, techniques ARRAY<STRING>")
    whole = {r["author"]: r["seq"] for r in SEQ.phase_sequences(posts).collect()}
    chunks = {r["author"]: r["seq"] for r in LS.phase_chunks(posts).collect()}
    assert whole == chunks and set(whole) == {"a", "usuario_desconocido"} and len(whole["a"]) == 2
    rows = LS.author_sequence_chunks(posts, ["techniques"]).collect()
    assert {r["author"]: len(r["posts"]) for r in rows} == {"a": 2, "usuario_desconocido": 2}


@pytest.mark.parametrize("column", ["text", "body"])
def test_token_places(spark, column):
    df = spark.createDataFrame([(1, "party art and art"), (2, "é-art🙂 ART"), (3, None), (4, ""), (5, "art " * 1000)], f"id INT, {column} STRING")
    terms = spark.createDataFrame([("art", "T", 1.0)], "term STRING, type STRING, confidence DOUBLE")
    got = {}
    for r in EN.dictionary_entities(df, "id", column, terms).collect():
        got.setdefault(r["id"], []).append((r["start"], r["end"]))
    assert sorted(got[1]) == [(6, 9), (14, 17)] and sorted(got[2]) == [(2, 5), (7, 10)]
    assert sorted(got[5]) == [(4 * i, 4 * i + 3) for i in range(1000)] and set(got) == {1, 2, 5}


def test_impossible_sequence_is_minus_infinity(spark):
    m = H.HMM([1.0, 0.0], [[0.0, 1.0], [0.0, 1.0]], [[1.0, 0.0], [0.0, 1.0]])
    df = spark.createDataFrame([(1, [0, 1, 1]), (2, [0, 0]), (3, [1]), (4, [])], "id INT, seq ARRAY<INT>")
    got = {r["id"]: r["ll"] for r in df.select("id", H.forward_loglik("seq", m).alias("ll")).collect()}
    assert got[1] == 0.0 and got[2] == got[3] == -math.inf and got[4] is None


def test_unreadable_model_is_an_error(spark, tmp_path):
    assert H.load_model(spark, str(tmp_path / "none")) is None
    (tmp_path / "start").mkdir()
    (tmp_path / "start" / "part-0.parquet").write_bytes(b"broken")
    with pytest.raises(Exception):
        H.load_model(spark, str(tmp_path))


def test_runs_of_chunks_fold_like_whole_sequences(spark, monkeypatch):
    monkeypatch.setattr("seqintel.operators.scan.FAN", 3)
    m = H.HMM([0.6, 0.4], [[0.7, 0.3], [0.2, 0.8]], [[0.5, 0.3, 0.2], [0.1, 0.3, 0.6]])
    seqs = [[(7 * i * i + a) % 3 for i in range(n)] for a, n in enumerate((41, 9, 30, 1))]
    whole = spark.createDataFrame([(f"a{i}", s) for i, s in enumerate(seqs)], "author STRING, seq ARRAY<INT>")
    chunks = spark.createDataFrame([(f"a{i}", c, s[4 * c:4 * c + 4], (len(s) + 3) // 4) for i, s in enumerate(seqs) for c in range((len(s) + 3) // 4)],
                                   "author STRING, chunk LONG, seq ARRAY<INT>, n_chunks LONG")
    want = {r["author"]: (r["ll"], r["v"]["path"], r["v"]["logp"]) for r in
            whole.select("author", H.forward_loglik("seq", m).alias("ll"), H.viterbi("seq", m).alias("v")).collect()}
    ll = {r["author"]: r["loglik"] for r in LS.loglik_chunks(chunks, m).collect()}
    paths = {}
    for r in sorted(LS.chunk_paths(chunks, m).collect(), key=lambda r: r["chunk"]):
        paths.setdefault(r["author"], []).extend(r["path"])
    assert set(ll) == set(want) and all(abs(ll[a] - want[a][0]) < 1e-9 and paths[a] == list(want[a][1]) for a in want)
