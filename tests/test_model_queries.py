"""Invariants of the model behind the registered model queries."""

from pyspark.sql import functions as F

from shiplens.operators import features, model as ml
from shiplens.plans.catalog import MODEL_CATEGORICAL, model_table, trained_model
from tests.conftest import SF_SMALL


def test_model_results_agree_with_each_other(spark):
    model, res, _ = trained_model(spark, SF_SMALL)
    table = model_table(spark, SF_SMALL)
    test = table.where(F.col("split") == "test")
    scored = model.transform(test)

    cm = {(r["label"], r["prediction"]): r["n"] for r in ml.confusion_counts(scored).collect()}
    assert set(cm) <= {(0, 0), (0, 1), (1, 0), (1, 1)}
    n_test = test.count()
    assert sum(cm.values()) == n_test == res.n_test and res.n_train + n_test == table.count()

    auc, acc, n = ml.evaluate_with_count(scored)
    assert n == n_test and acc == (cm.get((0, 0), 0) + cm.get((1, 1), 0)) / n_test
    assert 0.5 < auc <= 1.0 and (auc, acc) == ml.evaluate(scored)

    # one slot per category (unseen kept, last dropped) plus four numerics
    slots = table.agg(*[F.countDistinct(c) for c in MODEL_CATEGORICAL]).first()
    assert model.stages[-1].numFeatures == sum(slots) + 4 and model.stages[-1].getNumTrees == 100


def test_score_predicts_the_likelier_class_and_keeps_rows(spark):
    model, _, _ = trained_model(spark, SF_SMALL)
    table = model_table(spark, SF_SMALL)
    rows = ml.score(model, table, keep=["order_id", features.LABEL]).collect()
    assert len(rows) == table.count()
    for r in rows:
        assert 0.0 <= r["prob_class_1"] <= 1.0
        if r["prob_class_1"] != 0.5:
            assert r["prediction"] == (1.0 if r["prob_class_1"] > 0.5 else 0.0)


def test_model_is_trained_again_in_a_new_application(spark, monkeypatch):
    from shiplens.plans import catalog

    trained = []
    monkeypatch.setattr(catalog.forest, "node_table", lambda *a: None)
    monkeypatch.setattr(catalog.published, "publish", lambda *a: None)
    monkeypatch.setattr(catalog, "_train_and_store", lambda *a: trained.append(a) or (None, None, "p"))
    monkeypatch.setattr(catalog, "_MODELS", {("another application", SF_SMALL): ("stale",)})
    assert catalog.trained_model(spark, SF_SMALL)[2] == "p" and catalog.trained_model(spark, SF_SMALL)[2] == "p"
    assert len(trained) == 1
