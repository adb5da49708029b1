"""Broken CSV records, the evaluation report, and the keyword stream over several batches."""

import json

import pytest
from pyspark.sql import functions as F

from seqintel.sources import files as SRC
from seqintel.streaming import ingest as ST


def test_broken_records_go_to_quarantine_whole(spark):
    path = SRC.scratch_dir(spark, "csv")
    fields = len(SRC.RAW_FIELDS)
    good = ",".join(["m1"] + ['"two\nlines, ""quoted"""'] + ["x"] * (fields - 2))
    lines = [",".join(SRC.RAW_FIELDS), good, "m2,short", ",".join(["m3"] * (fields + 1)), ",".join(["m4"] * fields), 'm5,"never closed']
    spark.createDataFrame([("\n".join(lines),)], "value STRING").coalesce(1).write.text(path)
    posts, bad = SRC.split_posts_csv(spark, path)
    assert sorted(r["message_id"] for r in posts.collect()) == ["m1", "m4"]
    assert posts.where("message_id = 'm1'").first()["fingerprint"] == 'two\nlines, "quoted"'
    assert sorted(r[0].strip()[:8] for r in bad.collect()) == ["m2,short", "m3,m3,m3", 'm5,"neve']


def test_empty_csv(spark):
    path = SRC.scratch_dir(spark, "csv-empty")
    spark.createDataFrame([], "value STRING").write.text(path)
    posts, bad = SRC.split_posts_csv(spark, path)
    assert posts.count() == 0 and bad.count() == 0 and posts.columns == SRC.RAW_FIELDS


def test_report_without_predictions_is_an_error(spark):
    none = spark.createDataFrame([], "author STRING, truth INT, pred INT, confidence DOUBLE, correct BOOLEAN")
    with pytest.raises(ValueError):
        SRC.write_evaluation(none, SRC.scratch_dir(spark, "evaluation-none"))


def test_keyword_stream_counts_a_record_once_per_page(spark):
    landing, sink, ckpt = (SRC.scratch_dir(spark, n) for n in ("kw-land", "kw-sink", "kw-ckpt"))
    schema = "url STRING, fingerprint STRING, body STRING"

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        stream = ST.landing_stream(spark, landing, spark.createDataFrame([], schema).schema, 1)
        ST.keyword_counts_stream(stream, sink, ckpt, ["Cat"], "_all").awaitTermination()

    land([("p", "a", "a CAT"), ("p", "a", "a CAT"), ("q", "a", "a CAT"), (None, "n", None)])
    land([("p", "a", "a CAT"), ("p", "b", "dog"), ("p", "c", "cats")])
    land([])
    got = {(r["keyword"], r["url"]): r["n"] for r in ST.read_keyword_counts(spark, sink).collect()}
    assert got == {("_all", "p"): 3, ("Cat", "p"): 2, ("_all", "q"): 1, ("Cat", "q"): 1, ("_all", None): 1}


def test_first_copy_is_kept_over_batches_and_restarts(spark):
    landing, sink, ckpt = (SRC.scratch_dir(spark, n) for n in ("dd-land", "dd-sink", "dd-ckpt"))
    schema = "ts INT, message_id STRING, fingerprint STRING, body STRING"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = ST.landing_stream(spark, landing, spark.createDataFrame([], schema).schema, 1)
        ST.exact_dedup_sink(stream, sink, ckpt).awaitTermination()

    land([(5, "e", "x", "late"), (7, "f", "y", "only"), (9, "g", None, "no key")])
    land([(2, "b", "x", "first"), (2, "c", "x", "same time"), (8, "h", None, "earlier, no key")])
    land([(3, "d", "x", "later again"), (3, "d", "x", "later again")])
    land([])
    got = {(r["fingerprint"], r["message_id"], r["body"]) for r in ST.read_dedup_sink(spark, sink).collect()}
    assert got == {("x", "b", "first"), ("y", "f", "only"), (None, "h", "earlier, no key")}
    assert ST.read_dedup_sink(spark, sink).columns == ["ts", "message_id", "fingerprint", "body"]


def test_a_named_batch_is_appended_once(spark):
    posts = spark.createDataFrame([("m1", "a, \"b\"\nc"), ("m2", None)], "message_id STRING, body STRING")
    js, cs = SRC.scratch_dir(spark, "once-json"), SRC.scratch_dir(spark, "once-csv")
    for batch in ("7", "7", "8", "7"):
        SRC.append_posts_json(posts, js, batch)
        SRC.append_posts_csv(posts, cs, batch)
    for back in (spark.read.schema(SRC.RAW_SCHEMA).json(js), SRC.read_posts_csv(spark, cs)):
        rows = sorted((r["message_id"], r["body"]) for r in back.select("message_id", "body").fillna("-").collect())
        assert rows == sorted([("m1", "a, \"b\"\nc"), ("m2", "-")] * 2)


def test_sequence_file_of_another_writer(spark):
    path = SRC.scratch_dir(spark, "seq-file")
    text = """{
  "metadata": {"total_autores": 4, "secuencias_validas": 2, "generado_en": "2024-05-01T10:00:00", "longitud_minima_secuencia": 3},
  "sequences": {
    "ana \\"x\\"": [
      {"id_mensaje": "1", "fecha_hora": "2024-01-02T03:04:05", "puntuacion_amenaza": 1.5,
       "entidades": [{"type": "Malware", "text": "abc", "confidence": 0.9, "start": 1}], "tecnicas_mitre": ["T1"]},
      {"id_mensaje": "2", "fecha_hora": "never", "puntuacion_amenaza": null, "entidades": null, "tecnicas_mitre": [], "mitre_techniques": ["T2"]},
      {"id_mensaje": "3"}],
    "none": []
  }
}"""
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(path)
    rows = {r["author"]: r for r in SRC.read_sequence_files(spark, path).collect()}
    assert set(rows) == {'ana "x"', "none"} and rows["none"]["posts"] == []
    assert rows["none"]["metadata"].asDict() == {"total_authors": 4, "valid_authors": 2, "min_len": 3}
    posts = rows['ana "x"']["posts"]
    assert [p["techniques"] for p in posts] == [["T1"], ["T2"], []] and [len(p["entities"]) for p in posts] == [1, 0, 0]
    assert posts[0]["ts"].isoformat() == "2024-01-02T03:04:05" and posts[1]["ts"] is None
    spark.createDataFrame([("[1, 2",)], "value STRING").write.mode("overwrite").text(path)
    with pytest.raises(Exception):
        SRC.read_sequence_files(spark, path).collect()


@pytest.mark.parametrize("files", [1, 3])
def test_sequence_files_are_whole_objects(spark, files):
    path = SRC.scratch_dir(spark, "seq-files")
    posts = "array<struct<ts:timestamp,message_id:string,threat_score:double,techniques:array<string>>>"
    seqs = spark.sql(f"""SELECT concat('a"', chr(10), id) AS author, cast(transform(sequence(1, 1 + id % 4), k -> struct(
        timestamp_seconds(k), concat('m', k), 0.5, array('T1'))) AS {posts}) AS posts FROM range(10)""")
    SRC.write_sequence_files(seqs, path, files=files)
    objects = [json.loads(r[0]) for r in spark.read.text(path, wholetext=True, recursiveFileLookup=True).collect()]
    assert len(objects) == files
    assert {a: len(p) for o in objects for a, p in o["sequences"].items()} == {f'a"\n{i}': 1 + i % 4 for i in range(10) if i % 4 >= 2}
    assert all(o["metadata"]["total_autores"] == 10 and o["metadata"]["secuencias_validas"] == 4 for o in objects)
    assert {r["author"]: len(r["posts"]) for r in SRC.read_sequence_files(spark, path).collect()} == {f'a"\n{i}': 1 + i % 4 for i in range(10) if i % 4 >= 2}
    SRC.write_sequence_files(seqs.limit(0), path, files=files)
    assert SRC.read_sequence_files(spark, path).count() == 0
