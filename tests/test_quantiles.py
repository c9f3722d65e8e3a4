"""Distributed exact quantile selection against numpy (linear method)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.operators import quantiles as QS


@pytest.mark.parametrize("kind", ["uniform", "dups", "small"])
def test_select_matches_numpy(spark, kind):
    rng = np.random.default_rng(3)
    if kind == "uniform":
        vals = {"a": rng.normal(size=3000), "b": rng.exponential(size=1700)}
    elif kind == "dups":
        vals = {"a": np.repeat([1.0, 2.0, 2.0, 7.5], 700), "b": rng.integers(0, 5, 999).astype(float)}
    else:
        vals = {"a": np.array([4.0]), "b": np.array([1.0, 9.0])}
    rows = [(g, float(v)) for g, arr in vals.items() for v in arr] + [("a", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    qs = (0.25, 0.5, 0.75)
    # a tiny band, few buckets and a coarse sketch force several sketch passes
    got = {r["g"]: r for r in QS.exact_quantiles_select(df, "v", qs, ["g"], max_band=5, buckets=32, accuracy=100).collect()}
    for g, arr in vals.items():
        exp = np.quantile(arr, qs)
        assert [got[g]["q25"], got[g]["q50"], got[g]["q75"]] == pytest.approx(list(exp), rel=1e-12, abs=1e-12)
    glob = QS.exact_quantiles_select(df, "v", qs, (), max_band=5, buckets=32, accuracy=100).first()
    allv = np.concatenate(list(vals.values()))
    assert [glob["q25"], glob["q50"], glob["q75"]] == pytest.approx(list(np.quantile(allv, qs)), rel=1e-12, abs=1e-12)


def test_select_many_groups_uses_table_state(spark):
    """More groups than the in-memory state limit: the state is written and equi-joined."""
    rng = np.random.default_rng(9)
    n_groups = QS.SMALL_STATE + 44
    rows = [(int(g), float(v)) for g in range(n_groups) for v in rng.normal(size=int(rng.integers(1, 40)))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: (r["q25"], r["q75"]) for r in QS.exact_quantiles_select(df, "v", (0.25, 0.75), ["g"],
                                                                          max_band=8, buckets=4).collect()}
    by = {}
    for g, v in rows:
        by.setdefault(g, []).append(v)
    assert len(got) == n_groups
    for g, vals in by.items():
        assert list(got[g]) == pytest.approx(list(np.quantile(vals, [0.25, 0.75])), rel=1e-12, abs=1e-12)


def test_missed_brackets_are_settled_again(spark, monkeypatch):
    """Brackets that do not hold their ranks are found out and replaced by the whole range."""
    rng = np.random.default_rng(4)
    rows = [(g, float(v)) for g in ("a", None) for v in rng.normal(size=400)]
    df = spark.createDataFrame(rows, "g string, v double")
    right = QS._bracketed
    monkeypatch.setattr(QS, "_bracketed", lambda *a: right(*a).withColumn("U0", F.col("low")).withColumn("L0", F.col("low")))
    got = {r["g"]: r["q50"] for r in QS.exact_quantiles_select(df, "v", (0.5,), ["g"]).collect()}
    for g in ("a", None):
        assert got[g] == pytest.approx(float(np.quantile([v for h, v in rows if h == g], 0.5)), rel=1e-12)


def test_two_scans_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "g int, v double")
    assert QS.exact_quantiles_select(df, "v", (0.5,), ["g"]).count() == 0
    assert QS.exact_quantiles_select(df, "v", (0.5,)).count() == 0
