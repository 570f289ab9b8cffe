"""What trained operators get right on rows they were not trained on."""

import duckdb
import numpy as np
import pytest
from wardflow.llm import queries as registered
from wardflow.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def area_under_curve(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    for value in np.unique(scores):
        rank[scores == value] = rank[scores == value].mean()
    ones = truth.sum()
    return (rank[truth == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(truth) - ones))


def test_toxicity_of_held_out_documents(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{FOLDER}/labels.parquet' WHERE toxic IS NOT NULL").fetchall())
    rows = [r for r in registered.QUERIES["op1_toxicity"](spark, FOLDER).collect() if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in rows])
    scores, flagged = np.array([r.score for r in rows]), np.array([r.predicted for r in rows])
    assert len(rows) > 700 and truth.sum() > 80
    assert area_under_curve(scores, truth) > 0.94
    assert (flagged == truth).mean() > 0.96
    assert flagged[truth == 1].mean() > 0.85 and flagged[truth == 0].mean() < 0.03


def test_language_of_held_out_documents(spark):
    known = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{FOLDER}/documents.parquet' WHERE lang IS NOT NULL").fetchall())
    rows = [r for r in registered.QUERIES["op9_language_id"](spark, FOLDER).collect() if r.held_out and r.doc_id in known]
    sure = [r for r in rows if r.lang_pred != "und"]
    assert len(sure) > 1_000
    assert np.mean([r.lang_pred == known[r.doc_id] for r in sure]) > 0.97


@pytest.mark.parametrize("seed", [1, 2])
def test_label_model_recovers_voters(seed):
    """Rows drawn from a model with independent voters: class share and firing rates come back."""
    rng = np.random.default_rng(seed)
    truth = rng.random(20_000) < 0.15
    rates = np.where(truth[:, None], rng.uniform(0.3, 0.7, toxicity.VOTERS), 0.02)
    rates[:, -1] = np.where(truth, 0.05, 0.9)
    votes = rng.random(rates.shape) < rates
    labels = np.where(rng.random(20_000) < 0.05, truth, -1).astype(int)
    model = toxicity.fit_label_model(votes.astype(float), np.ones(20_000), labels)
    assert abs(model.prior - truth.mean()) < 0.02
    assert np.abs(model.fires[1] - votes[truth].mean(axis=0)).max() < 0.05
    assert ((model.posterior(votes.astype(float)) > 0.5) == truth).mean() > 0.98
    # A label is a voter: it moves a posterior, and does not replace it.
    p = toxicity.with_label(np.array([0.5, 0.999999, 1e-6]), np.array([1, 0, 1]))
    assert p[0] == pytest.approx(toxicity.LABEL_ACCURACY) and p[1] > 0.99 and p[2] < 0.01
