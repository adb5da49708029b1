"""One very long text among many short ones: bounded memory, and the results of each alone."""
import re
import resource
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from seqintel.llm import line_crf, pii, suffix_dedup


def crf():
    rng = np.random.RandomState(2)
    width = len(line_crf.FIGURES)
    return line_crf.LineCrf(np.zeros(width), np.ones(width), rng.randn(3 * width) * 0.1, 0.2, rng.randn(2, 2), 0.6)


@pytest.mark.parametrize("n", [1, 5, 511, 512, 513, 1700])
def test_long_chain_marginals_equal_plain_ones(n):
    rng = np.random.RandomState(n)
    em, trans = rng.randn(n) * 2, rng.randn(2, 2)
    want = line_crf.marginals(em[None, :], np.array([n]), trans)[0][0]
    assert np.allclose(line_crf.long_marginals(em, trans), want, atol=1e-12)


def test_line_scores_do_not_depend_on_their_company(monkeypatch):
    texts = [f"Line {i} of some words.\n" * (i % 7 + 1) for i in range(300)] + ["a b c\nx y\n" * 20_000, "", "one line " * 50_000]
    model = crf()
    got = model.scores(texts)
    assert np.allclose(got, [model.scores([t])[0] for t in texts], atol=1e-12)
    monkeypatch.setattr(line_crf, "LONG", 10 ** 9)
    assert np.allclose(model.scores(texts[-3:]), got[-3:], atol=1e-10)


def test_seen_before_marks_all_but_the_first():
    rows, sizes = line_crf.figures("a b\n\nc\na b\nc\r\na b\n" + "".join(f"w{i}\n" for i in range(40_000)) + "w7")
    column = rows[:, line_crf.FIGURES.index("seen before")]
    assert column[:5].tolist() == [0, 0, 1, 0, 1] and column[-1] == 1 and column.sum() == 3 and len(sizes) == 40_006


def test_long_numbers_equal_the_plain_decoding(monkeypatch):
    """In double precision both ways: over tens of thousands of places single precision rounds off near ties."""
    model = pii.Model.fresh()
    model.p["trans"] = np.random.RandomState(1).randn(len(pii.TAGS), len(pii.TAGS))
    text = "".join(np.random.RandomState(4).choice(list("0123456789 -.@ab+"), 30_000))
    cls = pii.classes(text)
    starts = pii.starts_of(cls)
    chains = np.split(starts, np.nonzero(np.diff(starts) >= pii.WINDOW)[0] + 1)
    whole = {a: e for a, e in pii.stretches(model.emissions(pii.cut_windows(cls, starts)), starts)}
    for chain in chains:
        pieces = np.concatenate(list(pii.segments(model, cls, chain)))
        assert np.allclose(pieces, whole[chain[0]], atol=1e-5)
        plain = model.decode(pieces[None].astype(np.float64), np.array([len(pieces)]))[0]
        assert (pii.decode_long(model, cls, chain) == plain).all()
    short = [f"call +49 30 {i:07d} now" for i in range(50)]
    bases = [pii.base_spans(t) for t in (text, *short)]
    alone = [pii.added_spans(model, [t], [b])[0] for t, b in zip((text, *short), bases)]
    assert pii.added_spans(model, [text, *short], bases) == alone
    monkeypatch.setattr(pii, "LONG", 1000)
    tags = [pii.decode_long(model, cls, c) for c in chains]
    told = [(k, a, b) for c, t in zip(chains, tags) for k, a, b in pii.tagged_spans(t, int(c[0]))]
    want = [(k, a, b) for k, a, b in ((k, a, min(b, len(text))) for k, a, b in told) if a < b and pii.plausible(k, text[a:b])
            and not any(x < b and a < y for _, x, y in bases[0])]
    assert pii.added_spans(model, [text, *short], bases)[0] == want


def test_memory_stays_small():
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    model, finder = crf(), pii.Model.fresh()
    model.scores(["some words here\n" * 300_000] + ["one line"] * 511)
    texts = ["4711 0815 " * 100_000] + ["no 12"] * 255
    pii.added_spans(finder, texts, [[] for _ in texts])
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_500_000  # KB


def test_parse_holds_a_part_of_a_long_body(monkeypatch):
    body = np.random.default_rng(1).integers(97, 101, 3_000_000).astype(np.uint8).tobytes()
    tracemalloc.start()
    got = suffix_dedup.parse(body)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6, peak
    for part, text in ((1 << 30, body), (1, body[:900]), (7, body[:2000]), (301, body[:5000]), (100, b"a" * 3000), (64, b"abcdefghi" * 300)):
        monkeypatch.setattr(suffix_dedup, "PART", 1 << 16)
        whole = got if text is body else suffix_dedup.parse(text)
        monkeypatch.setattr(suffix_dedup, "PART", part)
        assert all(np.array_equal(x, y) for x, y in zip(suffix_dedup.parse(text), whole)), part


def test_rows_of_a_long_body_are_handed_on_in_parts():
    step = suffix_dedup._batches(lambda n: ((i, [i]) for i in range(n)), "i long, l array<int>")
    batch = pa.RecordBatch.from_arrays([pa.array([3, 0, 50_000])], names=["n"])
    got = list(step(iter([batch, batch.slice(1, 1), batch.slice(0, 1)])))
    assert max(b.num_rows for b in got) <= suffix_dedup.ROWS
    assert [i for b in got for i in b["i"].to_pylist()] == [*range(3), *range(50_000), *range(3)]


def test_bodies_go_to_python_in_small_batches(spark, capsys):
    before = {k: spark.conf.get(k) for k in suffix_dedup.TAKEN}

    def sizes(batches):
        return (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)

    with suffix_dedup._small_batches(spark):
        texts = spark.range(0, 10_000, 1, 1).selectExpr("repeat(chr(97 + id % 7), 5000) AS body")
        most = max(r.n for r in texts.mapInArrow(sizes, "n long").collect())
    assert most < 1.5 * suffix_dedup.TAKEN["spark.sql.execution.arrow.maxBytesPerBatch"], most
    docs = spark.createDataFrame([(1, "ab" * 400), (2, "x" + "ab" * 250 + "y"), (3, None)], "doc_id long, text string")
    out = suffix_dedup.remove_repeats(spark, docs)
    capsys.readouterr()
    out.explain()
    steps = re.findall(r"MapInArrow ([^\n]*)", capsys.readouterr().out)
    assert steps and not any("body" in x for x in steps), steps
    assert [(r.doc_id, r.n_removed, r.n_spans, r.kept) for r in out.orderBy("doc_id").collect()] == [(1, 800, 1, b""), (2, 500, 1, b"xy"), (3, 0, 0, None)]
    assert {k: spark.conf.get(k) for k in suffix_dedup.TAKEN} == before
