"""The pipeline against a brute-force version, and its stages at the edges."""
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from seqintel.llm import line_crf
from seqintel.llm.common import documents
from test_llm_operators import WORDS, brute_fingerprint, brute_groups, brute_ids, edges, empty, lowered  # noqa: F401

SF = "/root/testdata/sf0.001"


def brute_pipeline(spark):
    docs = [(r.doc_id, r.text or "", r.source) for r in documents(spark, SF).collect()]
    crf = line_crf.train(documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = [d for d, s in zip(docs, crf.scores([t for _, t, _ in docs])) if s >= line_crf.THRESHOLD]
    last = {}
    for d in sorted(docs):
        last[lowered(d[1])] = d
    docs = list(last.values())
    low = {c for _, _, c in brute_groups([(i, brute_fingerprint(t)) for i, t, _ in docs])}
    docs = [d for d in docs if d[0] in low]
    size = {i: len(WORDS.findall(t)) for i, t, _ in docs}
    source = Counter()
    for i, _, s in docs:
        source[s] += size[i]
    weight = {s: 1 + k % 3 for k, s in enumerate(sorted(source))}
    capped, total = set(), sum(source.values())
    while True:
        free = sum(weight[s] for s in source if s not in capped)
        share = (total - sum(3 * source[s] for s in capped)) / free
        more = {s for s in source if s not in capped and 3 * source[s] < share * weight[s]}
        if not more:
            break
        capped |= more
    return docs, size, source, {s: min(share * weight[s], 3 * source[s]) for s in source}


def test_pipeline_against_brute_force(spark):
    docs, size, source, goal = brute_pipeline(spark)
    text = {i: t for i, t, _ in docs}
    pieces = corpus_pipeline.run(spark, SF).collect()
    tokens = {i: len(brute_ids(t)) + 1 for i, t in text.items()}
    got, place = Counter(), defaultdict(Counter)
    for p in pieces:
        assert p.doc_tokens == tokens[p.doc_id] and p.start + p.length <= p.doc_tokens
        got[p.doc_id] += p.length
        place[p.doc_id].update(range(p.start, p.start + p.length))
    copies = {i: got[i] // tokens[i] for i in text}
    assert all(got[i] == copies[i] * tokens[i] and set(place[i].values()) <= {copies[i]} for i in text) and set(got) <= set(text)
    taken, largest = Counter(), Counter()
    for i, _, s in docs:
        rate = goal[s] / source[s] if source[s] else 0
        assert copies[i] in (int(rate), int(rate) + 1)
        taken[s] += copies[i] * size[i]
        largest[s] = max(largest[s], size[i])
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1 for s in source)


def test_stages_keep_the_columns_and_survive_edges(spark, edges, empty):  # noqa: F811
    for docs in (edges, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.collect()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= (docs is edges)


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
