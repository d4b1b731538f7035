"""Sums over all pairs without the pairs, against brute force."""

import numpy as np
import pytest

from arborlake.operators import clustering, ranges
from arborlake.plans import clusters


@pytest.mark.parametrize("block", [1, 4, 1000])
def test_spans(spark, block):
    rng = np.random.default_rng(3)
    rows = [(g, n, i, float(v), i * 10.0) for g, n in (("a", 1), ("a", 40), ("b", 40), ("c", 33)) for i, v in enumerate(rng.integers(0, 9, n) if g != "c" else range(n))]
    df = spark.createDataFrame(rows, "grp string, part long, at long, value double, upto double")
    got = {(x["grp"], x["part"], x["at"]): (x["low"], x["low_upto"], x["high"], x["high_upto"]) for x in ranges.spans(df, ["grp", "part"], block).collect()}
    assert len(got) == len(rows)
    for g, n, i, v, _ in rows:
        own = {j: w for h, m, j, w, _ in rows if (h, m) == (g, n)}
        low, high = max((j for j in own if j < i and own[j] >= v), default=None), min((j for j in own if j > i and own[j] > v), default=None)
        assert got[g, n, i] == (low, None if low is None else low * 10.0, high, None if high is None else high * 10.0)


def brute(v):
    v = np.sort(v)
    gap = np.diff(v)
    d = np.concatenate([v[i + 1 :] - v[i] for i in range(len(v) - 1)])
    c = np.concatenate([np.maximum.accumulate(gap[i:]) for i in range(len(gap))])
    first = np.minimum(np.append(gap, np.inf), np.insert(gap, 0, np.inf))
    return np.corrcoef(d, c)[0, 1], 1 - first.mean() / gap.max()


@pytest.mark.parametrize("n,digits", [(3, 2), (40, 0), (400, 6)])
def test_measures_on_a_line(spark, n, digits):
    v = np.round(np.random.default_rng(n).normal(1e4, 9, n), digits)
    got = clustering.measures_on_a_line(spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double")).first()
    assert tuple(got) == pytest.approx(brute(v), abs=1e-9)


def test_measures_on_a_line_of_few(spark):
    for v in ([], [1.0], [None], [2.0, 2.0, 2.0]):
        assert tuple(clustering.measures_on_a_line(spark.createDataFrame([(x,) for x in v], "v double")).first()) == (None, None)
    assert tuple(clustering.measures_on_a_line(spark.createDataFrame([(1.0,), (3.0,)], "v double")).first()) == (None, 0.0)


def test_tree_measures_of_many(spark, tmp_path):
    """Thousands of customers, of whose pairs no table is made."""
    v = np.round(np.random.default_rng(5).uniform(-999, 9999, 6000), 2)
    spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "c_custkey long, c_acctbal double").write.parquet(f"file://{tmp_path}/customer.parquet")
    assert tuple(clusters.QUERIES["tree_measures"](spark, f"file://{tmp_path}").first()) == pytest.approx(brute(v), abs=2e-8)
