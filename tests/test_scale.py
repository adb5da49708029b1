"""Steps that must not be done twice, or move or hold more than they need."""

import re

import pyarrow as pa
from pyspark.sql import functions as F

from seqintel.functions import text as TX
from seqintel.operators import enrich as EN
from seqintel.operators import extract as EX
from seqintel.operators import ingest as ING
from seqintel.plans import queries as Q
from seqintel.sources import files as SRC
from seqintel.streaming import ingest as ST

from conftest import SF_SMALL


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_places_across_blocks_and_pieces(spark):
    word = re.compile(r"\w+")
    texts = {1: "🙂 é, " + "ab 🙂c--" * (TX.BLOCK + TX.PIECE + 3) + " ...", 2: "x" * 70_000, 3: " " * 70_000 + "ab", 4: "", 5: None, 6: "-"}
    df = spark.createDataFrame(list(texts.items()), "id INT, body STRING")
    want = {i: [(k, m.group(), m.start(), m.end()) for k, m in enumerate(word.finditer(t or ""))] for i, t in texts.items()}
    got = {i: [] for i in texts}
    for r in EN.token_entities(df, "id", "body", with_span=True).orderBy("id", "pos").collect():
        got[r["id"]].append((r["pos"], r["text"], r["start"], r["end"]))
    assert got == want
    bare = EN.token_entities(df, "id", "body").orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"], r["text"]) for r in bare] == [(i, k, t) for i in want for k, t, *_ in want[i]]
    terms = spark.createDataFrame([("ab", "T", 1.0)], "term STRING, type STRING, confidence DOUBLE")
    hits = EN.dictionary_entities(df, "id", "body", terms).orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"], r["text"], r["start"], r["end"]) for r in hits] == [(i, *w) for i in want for w in want[i] if w[1] == "ab"]


def test_a_small_dictionary_moves_no_token(spark, capsys, monkeypatch):
    df = spark.createDataFrame([(1, "an art of arts")], "id INT, body STRING")
    terms = spark.createDataFrame([("art", "T", 1.0), ("of", "T", 1.0)], "term STRING, type STRING, confidence DOUBLE")
    small = EN.dictionary_entities(df, "id", "body", terms)
    shown = plan(small, capsys)
    assert "BroadcastHashJoin" in shown and "BuildRight" in shown and "hashpartitioning" not in shown
    monkeypatch.setattr(EN, "FEW_TERMS", 1)
    large = EN.dictionary_entities(df, "id", "body", terms)
    assert "BroadcastExchange" not in plan(large, capsys) and sorted(large.collect()) == sorted(small.collect())


def test_tokens_without_places_count_none(spark, capsys):
    df = spark.createDataFrame([(1, "an art")], "id INT, body STRING")
    assert "aggregate(" not in plan(EN.token_entities(df, "id", "body"), capsys)


def test_bodies_are_cleaned_once(spark, capsys):
    long, short = "a long body " * 9, "-" * 80
    df = spark.createDataFrame([(1, long), (2, short), (3, None), (4, " x" * 30)], "id INT, body STRING")
    out = ING.clean_posts(df)
    assert plan(out, capsys).count("[a-f0-9]{16}") == 1
    assert {r["id"]: r["body_len"] for r in out.collect()} == {1: len(long) - 1, 4: 59}
    assert ING.clean_posts(df, min_body=0).count() == 4


def test_cleaning_keeps_the_rules_for_whitespace(spark):
    ws = "\t\n\x0b\f\r \x1c\x1f\x85\xa0     　"
    cases = {f"a{ws}b": "a b", f"a,{ws}.b": "a   b", "a--b_c": "a  b_c", f"{ws}a{ws}": "a", "a​b": "a b", "é́x": "é x", "🙂🙂a": "a",
             "USER_0123456789abcdef IPV4_0123": "[anonimizado] ipv4_0123"}
    df = spark.createDataFrame([(k,) for k in cases], "t STRING")
    assert {r["t"]: r["c"] for r in df.select("t", TX.clean_text("t").alias("c")).collect()} == cases


def test_posts_are_fingerprinted_once(spark, capsys):
    assert "sha1(" not in plan(Q.clean_unique_posts(spark, SF_SMALL), capsys)


def test_landed_files_follow_the_number_of_posts(spark, monkeypatch):
    monkeypatch.setattr(Q, "LANDED_ROWS", 8)
    path, schema, quarter = Q._landing(spark, SF_SMALL)
    landed = spark.read.schema(schema).parquet(path)
    files = len(landed.inputFiles())
    assert 12 <= files <= 25 and quarter == -(-files // 4)
    assert landed.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < 40
    assert sorted(r[0] for r in landed.select("doc_id").collect()) == sorted(
        r[0] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect())


def test_keyword_stream_dedups_without_the_texts(spark, capsys):
    landing, sink, ckpt = (SRC.scratch_dir(spark, n) for n in ("kw-land", "kw-sink", "kw-ckpt"))
    schema = "url STRING, fingerprint STRING, body STRING"
    spark.createDataFrame([("u", "f", "A leak"), ("u", "f", "a  LEAK"), ("u", "g", "x"), ("v", "f", None)], schema).write.parquet(landing)
    q = ST.keyword_counts_stream(ST.landing_stream(spark, landing, schema), sink, ckpt, ["leak"], "all")
    q.awaitTermination()
    capsys.readouterr()
    q.explain()
    shown = capsys.readouterr().out
    assert 0 <= shown.index("StreamingDeduplicate") < shown.index("Contains(")
    assert sorted(map(tuple, ST.read_keyword_counts(spark, sink).collect())) == [("all", "u", 2), ("all", "v", 1), ("leak", "u", 1)]


def test_batches_are_appended_from_stored_posts(spark, capsys, monkeypatch):
    shown, write = [], SRC.append_posts_json

    def seen(df, path, batch=None):
        shown.append(plan(df, capsys))
        write(df, path, batch=batch)
    monkeypatch.setattr(SRC, "append_posts_json", seen)
    out = Q.QUERIES["A2_A3_append_batch_once"](spark, SF_SMALL)
    assert len(shown) == 3 and not any("sha1(" in s for s in shown)
    assert out.count() == 2 * spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_pages_are_parsed_in_bounded_parts():
    html = [None, "x" * 600_000, "y" * 600_000, "", "é" * 3_000_000, "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(html))), pa.array(html)], names=["id", "html"])
    parts = list(EX._parts(batch))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1], [2, 3], [4], [5]]
    assert list(EX._parts(batch.slice(0, 0))) == []
