"""The three phases of the original flow composed from the operators.

1. pages -> raw posts (K2) -> first copy per fingerprint (D1) -> anonymised
   (B10) -> recent (B17) -> cleaned, filtered (B12-B15) -> export (B16)
2. clean posts -> enriched (K14, row-local) -> author sequences (D5, D6)
3. enriched posts -> chunked phase sequences (D8) -> fit (K6) -> author
   report (K10) and hold-out evaluation (K12-K15)

Each step is a lazy DataFrame; the only actions are the ones the model fit
and the exact split need (small results), and checkpoints cut lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import dictionaries as D
from ..operators import enrich as EN
from ..operators import evaluate as EV
from ..operators import extract as EX
from ..operators import hmm as H
from ..operators import ingest as ING
from ..operators import longseq as LS
from ..operators import sequences as SEQ


def collect_posts(pages: DataFrame, days_back: int = 0, as_of=None, ingest_ts=None) -> DataFrame:
    """Phase 1: pages -> clean, deduplicated, anonymised posts (export view)."""
    raw = EX.extract_posts(pages, ingest_ts=ingest_ts)
    uniq = ING.first_per_key(raw, ["fingerprint"], ["page_id", "idx"])
    anon = ING.anonymize_record(uniq)
    if days_back:
        anon = ING.recent(anon, days_back, as_of)
    return ING.clean_posts(anon)


def enrich_and_sequence(clean: DataFrame, terms: dict | None = None,
                        min_len: int = D.MIN_SEQUENCE) -> tuple[DataFrame, DataFrame]:
    """Phase 2: enriched posts and the valid author sequences."""
    enriched = EN.enrich_local(clean, terms, id_col="message_id")
    seqs = SEQ.valid_sequences(SEQ.author_sequences(enriched, ["threat_score", "techniques"]), min_len)
    return enriched, seqs


def model_and_report(enriched: DataFrame, n_states: int = D.N_STATES, evaluate: bool = False,
                     fit_on: str = "train") -> dict[str, object]:
    """Phase 3: chunked phase sequences -> fitted model -> author report
    (and the hold-out evaluation when asked)."""
    chunks = LS.phase_chunks(enriched)
    model = H.fit_hmm(chunks, n_states=n_states)
    out: dict[str, object] = {"model": model, "report": H.author_report(LS.analyze_chunks(chunks, model))}
    if evaluate:
        # the split and predictions run on whole-author arrays (reference shape)
        out["evaluation"] = EV.evaluate(SEQ.phase_sequences(enriched), fit_on=fit_on, n_states=n_states)
    return out
