"""Term index against brute force: short keys, piece borders, parts of the index, odd texts."""

import random

import pytest
from pyspark.sql import functions as F

from seqintel.operators import enrich as EN
from seqintel.operators import terms as TM

TEXTS = [None, "", " - ", "a", "xa", "Ab", "the c-a-b of abcab", "abcde" * 30, "éß\U0001F600x\U0001F600y", "bca\nacb", "the c-a-b of abcab"]


def brute(text, keys):
    squashed = "".join(c for c in (text or "").lower() if c not in " -_./\n")
    return sorted(k for k in keys if k in squashed)


@pytest.mark.parametrize("piece, part", [(1 << 15, 8 << 20), (7, 300)])
def test_index_equals_brute_force(spark, monkeypatch, piece, part):
    monkeypatch.setattr(TM, "PIECE", piece)
    monkeypatch.setattr(TM, "BLOCK_BYTES", part)
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("abc \U0001F600-") for _ in range(rng.randrange(60))) for _ in range(60)]
    keys = {"a", "ab", "\U0001F600x", "abc", "bcab", "abcab", "cabof", "abcdeabcde", "zz", "deabcdeab"} | {
        "".join(rng.choice("abc\U0001F600") for _ in range(rng.randrange(1, 9))) for _ in range(40)}
    table = spark.createDataFrame([(i, k, f"T{k}") for i, k in enumerate(sorted(keys))] + [(999, None, "T"), (1000, " - ", "T")],
                                  "idx INT, term STRING, technique STRING")
    df = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)], "doc_id INT, text STRING")
    out = EN.match_techniques(df, "text", table, "keys", emit_keys=True).select("text", "keys").collect()
    assert sorted((r["text"] or "", tuple(r["keys"])) for r in out) == sorted((t or "", tuple(brute(t, keys))) for t in texts)


def test_later_term_of_one_name_wins_and_values_unite(spark):
    table = spark.createDataFrame([(0, "Foo Bar", "T1"), (1, "foo-bar", "T2"), (1, "foo-bar", "T3"), (2, "foobar", "T4")],
                                  "idx INT, term STRING, technique STRING")
    df = spark.createDataFrame([("foo_bar",), ("fooba",)], "text STRING")
    got = {r["text"]: r["techniques"] for r in EN.match_techniques(df, "text", table).collect()}
    assert got == {"foo_bar": ["T2", "T3", "T4"], "fooba": []}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "idx INT, term STRING, technique STRING")
    df = spark.createDataFrame([("abc",)], "text STRING")
    assert EN.match_techniques(df, "text", none).first()["techniques"] == []
    assert EN.match_techniques(df.limit(0), "text").count() == 0


def test_no_python_node_and_texts_stay_where_only_techniques_are_asked(spark):
    df = spark.createDataFrame([(1, "abc")], "doc_id INT, text STRING")
    plan = EN.match_techniques(df, "text").select("doc_id", F.size("techniques"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "BatchEvalPython" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
