from types import SimpleNamespace

import numpy as np

from veritab.catalog import models as catalog
from veritab.operators import evaluate as EV
from veritab.operators import models as M


def test_permutation_of_all_features_equals_one_by_one(spark, sf):
    df = catalog._emb(spark, sf)
    model = M.logistic(C=1.0, n=catalog._n(df)).fit(df)
    fn = lambda frame: M.scored(model, M.vectorize(frame.drop("features"), "embedding"))
    got = {r.feature_index: r for r in M.permutation_importance(fn, df, "embedding", range(64), "vec_id", repeats=2).collect()}
    assert sorted(got) == list(range(64))
    recall = lambda x: EV.classification_metrics(x, "label", "prediction").first()["recall"]
    base = recall(fn(df))
    for j in (0, 63):
        drops = [base - recall(fn(M.permuted_element(df, "embedding", j, "vec_id", f"42-{r}"))) for r in range(2)]
        assert np.isclose(got[j].importance_mean, np.mean(drops)) and np.isclose(got[j].importance_std, np.std(drops))


def test_queries_ask_for_the_whole_job(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(catalog, "_emb", lambda *a: None)
    monkeypatch.setattr(catalog, "_n", lambda *a: 10)
    monkeypatch.setattr(catalog.M, "logistic", lambda **k: SimpleNamespace(fit=lambda df: SimpleNamespace(coefficients=[0.0] * 64, intercept=0.0)))
    monkeypatch.setattr(catalog, "rounded", lambda x: x)
    monkeypatch.setattr(M, "_search", lambda df, col, key, combos, *a: asked.setdefault(len(combos), combos))
    monkeypatch.setattr(catalog.PE, "importance", lambda df, col, key, w, b, indices, repeats, seed: (len(indices), repeats))
    monkeypatch.setattr(M, "learning_curve", lambda df, col, key, sizes, lam: len(sizes))
    monkeypatch.setattr(M, "validation_curve", lambda df, col, key, Cs, n: len(Cs))
    assert catalog.m09(None, None) == (64, 10)
    assert catalog.m17(None, None) == 10 and catalog.m18(None, None) == 20
    assert len(catalog.m19(None, None)) == 96
    assert len(catalog.m20(None, None)) == 50 and len({c["l1_ratio"] for c in asked[50]}) > 1
