"""Queries of the trained model fit it on the tables as they are."""
from seqintel.plans import queries as Q


def test_each_query_fits_its_model(monkeypatch):
    fits = []
    monkeypatch.setattr(Q, "_chunks", lambda spark, sf_dir: sf_dir)
    monkeypatch.setattr(Q.H, "fit_hmm", lambda chunks: fits.append(chunks) or len(fits))
    assert [Q._fitted(None, "same path"), Q._fitted(None, "same path")] == [1, 2]
