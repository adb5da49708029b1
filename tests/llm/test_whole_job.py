"""Operators at inputs where a part of the job is easily left out."""
import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from seqintel.llm import line_crf, mixing, simhash
from test_llm_operators import brute_fingerprint, brute_groups, table


# quality classifier ------------------------------------------------------------
def test_short_words_count_past_any_place_of_a_line():
    head = ["other"] * 200
    plain = " ".join(head + ["abcd"] * 100)
    short = " ".join(head + ["ab"] * 50 + ["abcdef"] * 50)  # as many words and bytes
    j = line_crf.FIGURES.index("short words")
    a, b = (line_crf.figures(t)[0][0, j] for t in (plain, short))
    assert a == 0 and np.isclose(b, 50 / 300)
    width = len(line_crf.FIGURES)
    weight = np.zeros(3 * width)
    weight[j], weight[width + j], weight[2 * width + j] = 1, 2, 4  # line before, line, line after
    crf = line_crf.LineCrf(np.zeros(width), np.ones(width), weight, 0.0, np.zeros((2, 2)), 0.5)
    assert len(set(crf.scores([f"{x}\nother\n{y}" for x in (plain, short) for y in (plain, short)]))) == 4


# mixing --------------------------------------------------------------------------
def test_mixing_orders_few_rows_where_ranks_crowd(spark, monkeypatch):
    edges = []

    def spy(session, df, name, store=mixing.stored):
        out = store(session, df, name)
        if name == "mix-edges":
            edges.append(out)
        return out

    monkeypatch.setattr(mixing, "stored", spy)
    # a: p = 1/3000, b: p = 1 - 1/6003
    docs = table(spark, [(i, "w", "a" if i < 1000 else "b") for i in range(3001)])
    got = mixing.mix(spark, docs, buckets=16, crowd=20).collect()
    n = {r.source: r.n for r in edges[-1].collect()}
    assert n and max(n.values()) <= 20
    _, cuts = mixing.rates(spark, docs)
    target = {r.source: r.target for r in cuts.collect()}
    u = {r.doc_id: r.u for r in docs.select("doc_id", mixing.uniform(F.col("doc_id")).alias("u")).collect()}
    for s, ids in (("a", range(1000)), ("b", range(1000, 3001))):
        whole = int(target[s] / len(ids))
        rest, taken = target[s] - whole * len(ids), set()
        for k, i in enumerate(sorted(ids, key=u.get), 1):
            if k - 0.5 <= rest:
                taken.add(i)
        assert {r.doc_id for r in got if r.source == s and r.copies == whole + 1} == taken
        assert all(r.copies in (whole, whole + 1) for r in got if r.source == s)
    # b is wanted three times at most, so nothing of it is sampled and nothing ordered
    edges.clear()
    docs = table(spark, [(i, "w", "a" if i < 900 else "b") for i in range(1000)])
    got = mixing.mix(spark, docs).collect()
    assert {r.copies for r in got if r.source == "b"} == {3}
    assert all(r.source != "b" for e in edges for r in e.collect())


# SimHash -------------------------------------------------------------------------
def test_near_dedup_keeps_one_row_of_each_group(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(400)) for w in "abcd")
    rows = [(7, a, "s"), (9, a + " end", "s"), (3, b, "s"), (7, b + " end", "s"), (3, c, "s"),  # ids 3 and 7 in two groups each
            (None, b + " more", "s"), (None, d, "s"), (None, d + " end", "s"), (5, "x y z", "s"), (5, "x y z", "t")]
    groups = brute_groups([(k, brute_fingerprint(t)) for k, (_, t, _) in enumerate(rows)])
    want = {}
    for k, _, root in groups:
        i, t, _ = rows[k]
        key = (i is None, i or 0, hashlib.sha256(t.encode()).hexdigest())
        want[root] = min(want.get(root, (key, i, t)), (key, i, t), key=lambda x: x[0])
    assert len(want) == 5
    got = simhash.drop_near_copies(spark, table(spark, rows)).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for _, i, t in want.values())
