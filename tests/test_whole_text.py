"""Queries of text functions read a text to its end, the export holds all parts of a post."""
import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from seqintel.plans import fixtures as FX


def test_b19_reads_past_the_title(spark, tmp_path):
    rows = [(i, f"{'Some-Words ' * 9}{tail}", "en", "s") for i, tail in enumerate(("END_of.it", "end  OF / it", "other"), 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for name, query in E.queries().items():
        if name.startswith("B19_"):
            for r in query(spark, str(tmp_path)).collect():
                got.setdefault(r.message_id, []).append([v for k, v in r.asDict().items() if k != "message_id"])
    assert got["msg_1"] == got["msg_2"] != got["msg_3"]


def test_b16_exports_quotes_parents_and_bodies(spark, tmp_path, monkeypatch):
    rows = [(i, f"Write\tto a.b@example.org, NOW! {'Some words ' * 9}{i}", "en", "s") for i in range(1, 5)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(path)
    made = FX.fx_posts
    monkeypatch.setattr(FX, "fx_posts", lambda *of: made(*of).withColumns({
        "parent_id": F.expr("CASE WHEN doc_id > 2 THEN 'msg_' || (doc_id - 2) END"),
        "quoted": F.expr("CASE WHEN doc_id > 1 THEN substr(body, 1, 35) || (doc_id - 1) END")}))
    export = E.queries()["B16_export_projection"](spark, str(tmp_path))
    got = {r.message_id: r.asDict() for r in export.collect()}
    quote = "write to [anonimizado]  now  some"
    assert {k: (r["parent_id"], r["quoted_clean"]) for k, r in got.items()} == {
        "msg_1": ("", ""), "msg_2": ("", quote + "1"), "msg_3": ("msg_1", quote + "2"), "msg_4": ("msg_2", quote + "3")}
    assert all(r["body_clean"] == f"{quote} {'words some ' * 8}words {k[-1]}" and len(r["body_clean"]) == r["body_len"] for k, r in got.items())
    sql = E.oracle_sql()["B16_export_projection"]
    for name, value in (("parent_id", "CASE WHEN doc_id > 2 THEN 'msg_' || (doc_id - 2) END"),
                        ("quoted", "CASE WHEN doc_id > 1 THEN substr(text, 1, 35) || (doc_id - 1) END")):
        assert sql.count(f"CAST(NULL AS VARCHAR) AS {name}") == 1
        sql = sql.replace(f"CAST(NULL AS VARCHAR) AS {name}", f"{value} AS {name}")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = duck.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(export.columns) and {r[0]: dict(zip(names, r)) for r in found.fetchall()} == got
