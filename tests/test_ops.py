"""Operator semantics on small frames: dedup, phases, metrics, streaks, graph."""
from pyspark.sql import functions as F

from seqintel.operators import evaluate as EV
from seqintel.operators import graph as GR
from seqintel.operators import ingest as ING
from seqintel.operators import report as RP
from seqintel.operators import sequences as SEQ


def test_first_per_key_keeps_first(spark):
    df = spark.createDataFrame([("f1", 2, "b"), ("f1", 1, "z"), ("f2", 5, "a"), ("F1", 0, "q")],
                               "fp STRING, ts INT, id STRING")
    got = sorted(map(tuple, ING.first_per_key(df, ["fp"], ["ts", "id"]).collect()))
    assert got == [("F1", 0, "q"), ("f1", 1, "z"), ("f2", 5, "a")]


def test_phase_of(spark):
    cases = [([], 5), (["T1566"], 1), (["T1003.003"], 5), (["T1059.999"], 2), (["T9999"], 5),
             (["T1005", "T1046"], 0), (["T1566", "T1190"], 2)]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i INT, t ARRAY<STRING>")
    got = [r[0] for r in df.orderBy("i").select(SEQ.phase_of("t")).collect()]
    assert got == [w for _, w in cases]


def test_metrics_cases(spark):
    pred = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "truth INT, pred INT")
    per = {r["phase_id"]: r for r in EV.class_metrics(pred).collect()}
    assert per[0]["precision"] == 0.5 and per[0]["recall"] == 0.5
    assert per[1]["precision"] == 0.5 and per[1]["recall"] == 1.0
    assert per[2]["support"] == 1 and per[2]["f1"] == 0.0
    assert per[5]["support"] == 0 and per[5]["precision"] == 0.0
    g = EV.global_metrics(EV.class_metrics(pred)).first()
    assert g["accuracy"] == 0.5 and g["total"] == 4
    assert abs(g["recall_weighted"] - g["accuracy"]) < 1e-9   # weighted recall = accuracy


def test_split_is_disjoint_and_complete(spark):
    df = spark.createDataFrame([(f"a{i}", [1, 2]) for i in range(37)], "author STRING, seq ARRAY<INT>")
    train, test = EV.split_authors(df)
    a, b = {r[0] for r in train.select("author").collect()}, {r[0] for r in test.select("author").collect()}
    assert not (a & b) and len(a | b) == 37 and len(b) == 7
    one = spark.createDataFrame([("x", [1])], "author STRING, seq ARRAY<INT>")
    tr, te = EV.split_authors(one)
    assert tr.count() == 1 and te.count() == 0


def test_failure_streaks(spark):
    outs = ["server_error"] * 3 + ["blocked", "server_error", "ok"] + ["http_error"] * 20
    df = spark.createDataFrame([(i, o) for i, o in enumerate(outs)], "event_id INT, outcome STRING") \
        .withColumn("ts", F.col("event_id"))
    r = RP.failure_streaks(df, 10).orderBy("event_id").collect()
    assert [x["streak"] for x in r[:6]] == [1, 2, 3, 3, 4, 0]
    assert [x["event_id"] for x in r if x["pause"]] == [15, 25]


def test_reachable(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "c"), ("x", "y")], "src STRING, dst STRING")
    got = dict(map(tuple, GR.reachable(e, ["a"], 2).collect()))
    assert got == {"a": 0, "b": 1, "c": 1, "d": 2}


def test_reachable_leaves_the_edges_where_they_lie(spark):
    hub = [("a", f"p{i}") for i in range(200)] + [(f"p{i}", f"q{i % 7}") for i in range(200)] + [("q3", "end"), ("end", "a"), (None, "n")]
    e = spark.createDataFrame(hub * 2, "src STRING, dst STRING")
    got = dict(map(tuple, GR.reachable(e, ["a"], 6).collect()))
    assert got == {"a": 0, "end": 3} | {f"p{i}": 1 for i in range(200)} | {f"q{i}": 2 for i in range(7)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table = GR.adjacency(e)
        seeds = spark.createDataFrame([("a", 0)], "url STRING, depth INT")
        step = GR.frontier_step(seeds, table, seeds, ["slot"])
        plan = step._jdf.queryExecution().sparkPlan().toString()
        planned = step._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = [i for i, line in enumerate(planned.splitlines()) if "Scan ExistingRDD" in line and "slot" in line]
    assert scan and "dst" in plan
    above = planned.splitlines()[max(0, scan[0] - 3):scan[0]]
    assert not any("Exchange" in line for line in above), planned
    assert step.count() == 200


def test_histogram_all_equal(spark):
    df = spark.createDataFrame([(0.3,), (0.3,)], "confidence DOUBLE")
    h = dict(map(tuple, EV.confidence_histogram(df).collect()))
    assert h[11] == 2 and sum(h.values()) == 2


def test_failure_streaks_scan_equals_window(spark):
    import random
    rnd = random.Random(3)
    outs = ["ok", "server_error", "http_error", "blocked"]
    rows = [(i, h, rnd.choice(outs) if rnd.random() < 0.5 else "server_error") for i, h in
            enumerate(rnd.choice(["h1", "h2", "h3"]) for _ in range(400))]
    df = spark.createDataFrame(rows, "event_id INT, host STRING, outcome STRING").withColumn("ts", F.col("event_id"))
    a = {r["event_id"]: (r["streak"], r["pause"]) for r in RP.failure_streaks(df, 4, partition=("host",)).collect()}
    b = {r["event_id"]: (r["streak"], r["pause"]) for r in
         RP.failure_streaks_scan(df, 4, keys=("host",), n_partitions=7).collect()}
    assert a == b


def test_row_local_enrichment_equals_long_form(spark):
    """Row-local entities / dedup / matching / score equal the long-form
    (shuffle-based) chain on real documents."""
    from seqintel.operators import enrich as EN
    from seqintel.session import table
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", F.col("text").alias("body"))
    a = {r["doc_id"]: (r["n_entities"], r["n_techniques"], r["threat_score"], tuple(r["techniques"]))
         for r in EN.enrich_local(docs, id_col="doc_id").collect()}
    b = {r["doc_id"]: (r["n_entities"], r["n_techniques"], r["threat_score"], tuple(r["techniques"]))
         for r in EN.enrich_posts(docs, id_col="doc_id").collect()}
    assert a == b


def test_term_match_substring_and_whole_word(spark):
    from seqintel.operators import enrich as EN
    terms = {"Cobalt Strike": ["T1"], "cobaltstrike": ["T1"], "rat": ["T2"], "LockBit 3.0": ["T3"]}
    df = spark.createDataFrame([(1, "uses Cobalt-Strike beacons"), (2, "a separate note"),
                                (3, "LockBit 3.0 again"), (4, ""), (5, None)], "id INT, text STRING")
    sub = {r["id"]: r["techniques"] for r in EN.match_techniques(df, "text", terms).collect()}
    assert sub == {1: ["T1"], 2: ["T2"], 3: ["T3"], 4: [], 5: []}
    whole = {r["id"]: r["techniques"] for r in EN.match_techniques(df, "text", terms, whole_word=True).collect()}
    assert whole == {1: ["T1"], 2: [], 3: ["T3"], 4: [], 5: []}


def test_figures_are_observed_by_the_job_that_writes(spark):
    from seqintel.operators import ingest as ING
    from seqintel.sources.files import scratch_dir
    rows = [(1, "a", "x"), (2, "b", "x"), (0, "c", "x"), (5, "d", None), (4, "e", None), (None, "f", "y")]
    posts = spark.createDataFrame(rows, "ts INT, message_id STRING, fingerprint STRING")
    path, none = scratch_dir(spark, "firsts"), posts.limit(0)
    assert tuple(ING.write_first_per_key(posts, path).first()) == (6, 3, 3)
    assert {r[1] for r in spark.read.parquet(path).collect()} == {"c", "e", "f"}
    assert spark.read.parquet(path).columns == posts.columns
    assert tuple(ING.write_first_per_key(none, scratch_dir(spark, "firsts")).first()) == (0, 0, 0)
    prof = RP.write_profiled(posts.withColumn("a.b", F.lit(1)), path)
    assert {r["column"]: r["non_null"] for r in prof.collect()} == {"ts": 5, "message_id": 6, "fingerprint": 4, "a.b": 6}
    assert {r["column"]: r["non_null"] for r in RP.write_profiled(none, path).collect()} == {"ts": 0, "message_id": 0, "fingerprint": 0}
