"""Distribution aggregates against numpy."""

import numpy as np
import pytest

from fieldstat.operators import distribution as D


def test_histogram_counts(spark):
    x = np.random.default_rng(3).gamma(2.0, size=500)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r.bin: r.n for r in D.histogram(df, "v", 25).collect()}
    ref, _ = np.histogram(x, bins=25, range=(x.min(), x.max()))
    assert [got.get(i, 0) for i in range(25)] == list(ref)


def test_kde_close_to_direct_sum(spark):
    x = np.random.default_rng(4).normal(size=400)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    rows = D.kde(df, "v", grid=256, bw=0.3).orderBy("g").collect()
    g = np.array([r.x for r in rows])
    dens = np.array([r.density for r in rows])
    ref = np.exp(-((g[:, None] - x[None, :]) / 0.3) ** 2 / 2).sum(1) / (len(x) * 0.3 * np.sqrt(2 * np.pi))
    assert np.abs(dens - ref).max() < 5e-3
    assert np.trapezoid(dens, g) == pytest.approx(1.0, abs=1e-2)
