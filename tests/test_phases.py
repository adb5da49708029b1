"""The three phases composed end to end on the small tables."""
from seqintel.plans import phases as P
from seqintel.plans import queries as Q
from seqintel.session import table

SF = "/root/testdata/sf0.001"


def test_phases_end_to_end(spark):
    clean = P.collect_posts(table(spark, SF, "pages"), ingest_ts="2025-01-01 00:00:00")
    assert clean.count() > 0 and "body_clean" in clean.columns
    enriched, seqs = P.enrich_and_sequence(clean)
    assert enriched.count() == clean.count()
    assert {"threat_score", "techniques", "n_entities"} <= set(enriched.columns)
    out = P.model_and_report(Q._tech(spark, SF), evaluate=True)
    rep = out["report"].collect()
    assert len(rep) == 15 and all(r["status"] == "OK" for r in rep)
    assert out["evaluation"]["metrics_global"].first()["total"] == 3
