import numpy as np
from pyspark.sql import functions as F

from flowscope.operators import shedding
from flowscope.sources.logs import log_lines
from tests.conftest import SF_SMALL


def _hist(spark, d, by=None):
    if by is None:
        return spark.createDataFrame(list(d.items()), "bucket long, n long")
    return spark.createDataFrame([(by, k, v) for k, v in d.items()], "rate double, bucket long, n long")


def _w_numpy(u, v):
    """Reference: 1-D Wasserstein of weighted samples via sorted CDFs."""
    vals = np.array(sorted(set(u) | set(v)), dtype=float)
    cu = np.cumsum([u.get(x, 0) for x in vals]) / sum(u.values())
    cv = np.cumsum([v.get(x, 0) for x in vals]) / sum(v.values())
    return float(np.sum(np.abs(cu - cv)[:-1] * np.diff(vals)))


def test_wasserstein_hand_case(spark):
    d = shedding.wasserstein(_hist(spark, {0: 3, 1: 1, 5: 1}), _hist(spark, {0: 1, 2: 1})).collect()[0]
    assert abs(d.distance - 1.0) < 1e-12


def test_wasserstein_identity(spark):
    u = _hist(spark, {0: 5, 3: 2, 4: 7})
    assert shedding.wasserstein(u, u).collect()[0].distance == 0.0


def test_wasserstein_matches_numpy(spark):
    rng = np.random.default_rng(1)
    u = {int(k): int(c) for k, c in zip(rng.choice(30, 12, replace=False), rng.integers(1, 50, 12))}
    v = {int(k): int(c) for k, c in zip(rng.choice(30, 9, replace=False), rng.integers(1, 50, 9))}
    d = shedding.wasserstein(_hist(spark, u), _hist(spark, v)).collect()[0].distance
    assert abs(d - _w_numpy(u, v)) < 1e-12


def test_sweep_equals_per_rate_shed(spark):
    rows = shedding.shed_input(log_lines(spark, SF_SMALL)).cache()
    sweep = shedding.shed_sweep(rows, "event_id", last=98)
    for rate in (0.01, 0.3, 0.5, 0.98):
        direct = shedding.histogram(shedding.hash_shed(rows, "event_id", rate))
        one = sweep.where(F.col("rate") == rate).drop("rate")
        assert one.exceptAll(direct).count() == 0 and direct.exceptAll(one).count() == 0


def test_accuracy_matches_brute_force(spark):
    rows = shedding.shed_input(log_lines(spark, SF_SMALL)).cache()
    acc = {r.rate: r for r in shedding.shed_accuracy(rows, "event_id").collect()}
    pdf = rows.toPandas()
    full = pdf.groupby(pdf.bytes // 10000).size().to_dict()
    for rate in (0.05, 0.3, 0.9):
        kept = shedding.hash_shed(rows, "event_id", rate).toPandas()
        samp = kept.groupby(kept.bytes // 10000).size().to_dict()
        assert acc[rate].n_kept == len(kept)
        assert abs(acc[rate].distance - _w_numpy(full, samp)) < 1e-12
        assert abs(acc[rate].accuracy - (1 - acc[rate].distance)) < 1e-15


def test_hash_rate_close_to_nominal(spark):
    ids = spark.range(200000).withColumnRenamed("id", "event_id")
    for rate in (0.1, 0.5):
        frac = shedding.hash_shed(ids, "event_id", rate).count() / 200000
        assert abs(frac - rate) < 0.01


def test_bernoulli_rate(spark):
    ids = spark.range(100000)
    frac = shedding.bernoulli_shed(ids, 0.25, seed=3).count() / 100000
    assert abs(frac - 0.25) < 0.01
