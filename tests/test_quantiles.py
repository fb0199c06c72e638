"""Exact quantiles against numpy, on easy and adversarial distributions."""

import numpy as np
import pytest

from checks import views
from transferlens.operators import quantiles as quantile_passes
from transferlens.operators.quantiles import log_histogram, quantiles_from_histogram
from transferlens.plans import tokens

RNG = np.random.default_rng(5)
SAMPLES = {
    "single": np.array([42.0]),
    "pair": np.array([1.0, 10.0]),
    "equal": np.full(500, 7.0),
    "uniform": RNG.integers(0, 10**6, 3000).astype(float),
    "wide": np.floor(np.exp(RNG.uniform(0, 150, 3000))),
    "cluster": 1e18 + 128.0 * RNG.integers(0, 10**6, 3000),
    "cluster and outlier": np.append(1e18 + 128.0 * RNG.integers(0, 50, 2999), 1.002e18),
    "hot value": np.where(RNG.random(3000) < 0.4, 5.0, RNG.integers(0, 1000, 3000)).astype(float),
    "zeros": np.where(RNG.random(1000) < 0.7, 0.0, 3.0),
}
QUANTILES = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.9, "q4": 0.999, "q5": 1.0}


@pytest.mark.parametrize("most", [1, 100_000])
def test_per_group(spark, most):
    data = [(name, float(v)) for name, sample in SAMPLES.items() for v in sample]
    values = spark.createDataFrame(data, "k string, v double").repartition(6)
    found = quantiles_from_histogram(values, log_histogram(values, ["k"]), ["k"], QUANTILES, most).collect()
    assert len(found) == len(SAMPLES)
    for row in found:
        sample = SAMPLES[row.k]
        assert row.total == len(sample)
        for name, q in QUANTILES.items():
            assert row[name] == pytest.approx(np.quantile(sample, q), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("name", list(SAMPLES))
def test_pooled(spark, name):
    values = spark.createDataFrame([(float(v),) for v in SAMPLES[name]], "v double")
    row = quantiles_from_histogram(values, log_histogram(values, []), [], QUANTILES).first()
    for key, q in QUANTILES.items():
        assert row[key] == pytest.approx(np.quantile(SAMPLES[name], q), rel=1e-12, abs=1e-9)


def test_empty(spark):
    values = spark.createDataFrame([], "v double")
    row = quantiles_from_histogram(values, log_histogram(values, []), [], {"q": 0.5}).first()
    assert row.q is None


def test_approximate_method(rows, names):
    data = [("t", "a", "b", str(i), "2024-01-01 00:00:00") for i in range(2000)]
    m = names(("t", "Token", "TOK", 18))
    exact = tokens.transfer_size_distribution(rows(data), m).first()
    sketch = tokens.transfer_size_distribution(rows(data), m, method="approx").first()
    assert exact.transfers == sketch.transfers == 2000
    assert exact.median_transfer == 999.5
    assert sketch.median_transfer == pytest.approx(exact.median_transfer, abs=2)
    assert tokens.whale_transfers(rows(data), m).count() == 2
    assert tokens.whale_transfers(rows(data), m, method="approx").count() in (1, 2)
    assert tokens.transfer_size_distribution(rows(data), m, limit=None).first() == exact


def test_clumped_values_between_outliers(spark, monkeypatch):
    """100,000 neighbouring doubles between two outliers of one bin: the first narrowing leaves them all in one piece."""
    clump = 2.0**52 + np.arange(100_000)
    sample = np.concatenate([[2.0**52 - 2.0**40], clump, [2.0**52 + 2.0**43]])
    values = spark.createDataFrame([(float(v),) for v in sample], "v double").repartition(6)
    cells = []
    staged = quantile_passes.staged
    monkeypatch.setattr(quantile_passes, "staged", lambda df, name: cells.append(staged(df, name)) or cells[-1])
    row = quantiles_from_histogram(values, log_histogram(values, []), [], QUANTILES, 1000).first()
    for name, q in QUANTILES.items():
        assert row[name] == np.quantile(sample, q)
    assert len(cells) > 2
    assert cells[-1].filter("n > 1000 AND low < high").isEmpty()


def test_equal_values_are_one_row_of_any_count(spark):
    values = spark.range(50_000).selectExpr("if(id % 5 = 0, 3e20, 7.0) AS v")
    row = quantiles_from_histogram(values, log_histogram(values, []), [], QUANTILES, 10).first()
    assert (row.total, row.q0, row.q2, row.q3) == (50_000, 7.0, 7.0, 3e20)


def test_last_pass_reads_transfers_once(spark, sf_dir):
    """Tokens and cells are staged, so their written sizes let Spark broadcast them and nothing is read again."""
    t, m = views.transfers(spark, sf_dir), views.metadata(spark, sf_dir)
    plan = tokens.transfer_size_distribution(t, m, min_transfers=10)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert sum("FileScan" in line and "l_orderkey" in line for line in plan.splitlines()) <= 1
