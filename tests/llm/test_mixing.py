import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesweft.llm import mixing
from tests.llm import cases

WORDS = {"clean": "alpha beta gamma delta", "low": "buy now click here", "toxic": "awful nasty vile gross"}


def rows(n=400, seed=2):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        domain = rng.choices(list(WORDS), [6, 3, 1])[0]
        words = [rng.choice(WORDS[domain].split() + ["the", "of", "and"]) for _ in range(rng.randint(10, 60))]
        docs.append((i, " ".join(words)))
        labels.append((i, int(domain != "low"), int(domain == "toxic")))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = rows()
    extra = [(900, None), (901, ""), (None, "alpha beta"), (5, docs[5][1])]
    marks = spark.createDataFrame([*labels, (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    return cases.documents(spark, docs + extra), marks


def test_expected_tokens_match_the_targets(tables):
    docs, marks = tables
    targets = {"clean": 0.4, "low": 0.3, "toxic": 0.3}
    found = mixing.mixing_rates(docs, mixing.label_domains(marks), targets).toPandas()
    assert len(found) == docs.count() and (found.rate >= 0).all()
    p, n = np.stack(found.posteriors), found.n_tokens.to_numpy(float)
    assert np.allclose(p.sum(axis=1), 1)
    shares = (p * (n * found.rate.to_numpy())[:, None]).sum(axis=0) / n.sum()
    assert np.allclose(shares, [0.4, 0.3, 0.3], atol=2e-3)
    truth = {i: d for i, d in mixing.label_domains(marks).collect()}
    known = found[found.doc_id.isin(list(truth)) & (found.n_tokens > 0)]
    assert (known.domain == known.doc_id.map(truth)).mean() > 0.95
    assert ((found.copies >= np.floor(found.rate)) & (found.copies <= np.ceil(found.rate))).all()


def posterior_table(spark, p, n):
    width = p.shape[1]
    schema = "__mix_tokens long, " + ", ".join(f"__mix_p{i} double" for i in range(width))
    return spark.createDataFrame([(int(t), *map(float, q)) for t, q in zip(n, p)], schema).repartition(3)


def test_rates_clip_at_zero_like_plain_projected_gradient(spark):
    """The nearest rates to 1 that meet the targets, found by many small steps."""
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.6, 0.6, 0.6], 300)
    n = rng.integers(1, 100, 300).astype(float)
    table = posterior_table(spark, p, n)
    rates = mixing.fit_rates(table, ["a", "b", "c"], {"a": 0.8, "b": 0.15, "c": 0.05})
    goal = n.sum() * np.array([0.8, 0.15, 0.05])
    y, step = np.zeros(3), 0.3 * np.linalg.inv((p * n[:, None]).T @ p)
    for _ in range(5000):
        y += step @ (p.T @ (n * np.maximum(0, 1 - p @ y)) - goal)
    r = np.maximum(0, 1 - p @ y)
    assert (r == 0).any() and np.abs(p.T @ (n * r) - goal).max() < 1e-6 * n.sum()
    found = np.array([x[0] for x in table.select(mixing._rate(rates.moved)).collect()])
    assert np.allclose(np.sort(found), np.sort(r), atol=5e-3)
    assert np.allclose(rates.reached, goal, atol=1e-4 * n.sum()) and np.allclose(rates.targets, goal)


@pytest.mark.parametrize("shares", [(0.05, 0.9, 0.05), (0.02, 0.02, 0.96), (0.98, 0.01, 0.01)])
def test_hard_targets_are_met(spark, shares):
    """One domain nearly alone: hundreds of small documents are left out, a few are repeated often."""
    rng = np.random.default_rng(9)
    p = np.concatenate([rng.dirichlet([9, 0.5, 0.3], 500), rng.dirichlet([0.2, 0.01, 4], 60), np.eye(3)])
    n = rng.integers(1, 200, len(p)).astype(float)
    rates = mixing.fit_rates(posterior_table(spark, p, n), ["a", "b", "c"], dict(zip("abc", shares)))
    r = np.maximum(0, 1 - p @ np.array(rates.moved))
    assert np.abs(p.T @ (n * r) - n.sum() * np.array(shares)).max() <= 2e-4 * n.sum()


def test_targets_out_of_reach_raise(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ITERATIONS", 5)
    p = np.array([[0.6, 0.4], [0.5, 0.5], [0.4, 0.6]] * 10)
    with pytest.raises(RuntimeError, match="no rates reach"):
        mixing.fit_rates(posterior_table(spark, p, np.full(30, 10.0)), ["a", "b"], {"a": 0.9, "b": 0.1})


def test_twenty_domains_and_the_bound(spark):
    rng = random.Random(3)
    names = [f"d{k:02d}" for k in range(20)]
    rows = [(i, " ".join(rng.choice([f"{names[i % 20]}w{j}" for j in range(6)]) for _ in range(30))) for i in range(400)]
    docs = cases.documents(spark, rows)
    labelled = spark.createDataFrame([(i, names[i % 20]) for i in range(400)], "id long, domain string")
    targets = {d: 1 + k for k, d in enumerate(names)}
    found = mixing.mixing_rates(docs, labelled, targets).toPandas()
    assert (found.domain == found.doc_id.map(lambda i: names[i % 20])).all()
    sums = (np.stack(found.posteriors) * (found.n_tokens * found.rate).to_numpy()[:, None]).sum(axis=0)
    assert np.allclose(sums / sums.sum(), np.arange(1, 21) / 210, atol=1e-3)
    many = spark.range(100).selectExpr("id", "concat('x', id) AS domain")
    with pytest.raises(ValueError, match="domains"):
        mixing.train(docs, many)


def test_anchor_keeps_clean_documents(tables):
    docs, marks = tables
    kept = mixing.mixed(docs, mixing.label_domains(marks), {"clean": 0.9, "low": 0.05, "toxic": 0.05}, anchor="clean")
    assert kept.columns == docs.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    truth = {i: d for i, d in mixing.label_domains(marks).collect()}
    clean, low = ([i for i, d in truth.items() if d == name] for name in ("clean", "low"))
    # Documents that are clean alone keep a rate of about 1.
    assert len(set(clean) & set(ids)) > 0.98 * len(clean)
    assert len(set(low) & set(ids)) < 0.5 * len(low)


def test_without_labels_and_empty_table(tables):
    docs, marks = tables
    none = mixing.label_domains(marks).limit(0)
    found = mixing.mixing_rates(docs, none, {"all": 1.0}).collect()
    assert {r.rate for r in found} == {1.0} and {r.domain for r in found} == {"all"}
    assert mixing.mixing_rates(docs.limit(0), mixing.label_domains(marks), {"clean": 1.0}).count() == 0
    assert mixing.mixed(docs.limit(0), none, {}).count() == 0


def test_no_python_on_executors(tables):
    docs, marks = tables
    frame = mixing.mixed(docs, mixing.label_domains(marks), {"clean": 0.9, "low": 0.1}).where(F.col("doc_id") >= 0)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
