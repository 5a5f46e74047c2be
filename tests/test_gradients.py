"""The check of a fitted click model reads the features once."""

import re

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from feedmill.operators import training as T


def features(spark, rows):
    found = spark.createDataFrame(rows, "x array<double>, label int")
    return found.select(array_to_vector("x").alias("features"), "label")


ROWS = [([1.0, 0.5], 1), ([-1.0, 2.0], 0), ([0.5, -0.5], 1), ([0.0, 0.0], 0), ([1.0, 0.5], 1), ([3.0, 1.0], None)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[-1:], []])
def test_gradients_of_one_pass_are_those_of_several(spark, tmp_path, rows):
    features(spark, rows).write.parquet(str(tmp_path / "features"))
    df = spark.read.parquet(str(tmp_path / "features"))
    points = {"zero": ([0.0, 0.0], 0.0), "else": ([0.3, -2.0], 0.7)}
    totals = {"n": F.count(F.lit(1)), "k": F.sum("label")}
    found = T.mean_gradient(df, [1.5, -0.5], 0.25, others=points, totals=totals)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan parquet", plan)) == 1
    assert found.columns == ["dim", "gradient", "zero", "else", "n", "k"]
    got = sorted(found.collect())
    alone = sorted(T.mean_gradient(df, [1.5, -0.5], 0.25).collect())
    assert [(r["dim"], r["gradient"]) for r in got] == [tuple(r) for r in alone] and len(got) == 3
    for name, point in points.items():
        want = [r["gradient"] for r in sorted(T.mean_gradient(df, *point).collect())]
        assert all(r[name] == want for r in got)
    labels = [l for _, l in rows if l is not None]
    assert {(r["n"], r["k"]) for r in got} == {(len(rows), sum(labels) if labels else None)}


def test_the_optimality_query_reads_the_features_once_after_the_fit(spark, tmp_path, monkeypatch):
    from feedmill.plans import queries as Q

    features(spark, [(x * 4, l) for x, l in ROWS[:-1]]).write.parquet(str(tmp_path / "features"))
    train, fit, passes = spark.read.parquet(str(tmp_path / "features")), T.fit_click_model, []
    monkeypatch.setattr(Q, "_click_features", lambda spark, sf: (None, None, train))
    monkeypatch.setattr(T, "mean_gradient", lambda *a, f=T.mean_gradient, **b: passes.append(a[0]) or f(*a, **b))
    monkeypatch.setattr(T, "fit_click_model", lambda df: fit(df))
    found = Q.QUERIES["click_model_optimality"](spark, "unused")
    assert len(passes) == 1 and len(re.findall("FileScan parquet", found._jdf.queryExecution().executedPlan().toString())) == 1
    assert sorted(tuple(r) for r in found.collect()) == [(d, 0.0, 5, 3) for d in range(-1, 8)]
