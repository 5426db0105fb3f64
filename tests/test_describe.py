from __future__ import annotations

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from indexday.operators import describe as ds


@pytest.mark.parametrize(("values", "expected"), [([1, 2, 3, 10], 2.5), ([1, 2, 9], 2.0), ([5, None], 5.0), ([None], None)])
def test_median_interpolates(frame, values, expected):
    assert ds.median(frame([(v if v is None else float(v),) for v in values], "x double"), "x").first().median == expected


def test_imputation_uses_all_rows_it_is_given(frame):
    # Fan-out counts: the value 9 is there twice and moves the median.
    df = frame([(1, 1.0), (2, 3.0), (3, 9.0), (3, 9.0), (4, None)], "id int, cci double")
    assert rows(ds.impute_median(df, "cci"))[-1] == (4, 6.0)
    assert rows(ds.impute_median(frame([(1, None)], "id int, cci double"), "cci")) == [(1, None)]


def test_percentiles_of_a_continuous_column_are_exact(spark):
    """The fold to brackets leaves the result alone, skewed values and a hot group included."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 2)).alias("g"),
        F.exp(F.rand(7) * 9).alias("x"),
    )
    df = df.withColumn("x", F.when(F.rand(3) < 0.05, F.lit(17.0)).otherwise(F.col("x"))).cache()
    points, names = [0, 0.25, 0.5, 0.75, 1], ["a", "b", "c", "d", "e"]
    folded = ds.percentiles(df, ["g"], "x", points, names, large=100)
    for r in folded.collect():
        x = np.array([v.x for v in df.filter(F.col("g") == r.g).select("x").collect()])
        assert np.allclose([r[n] for n in names], np.quantile(x, points), rtol=1e-12)
    whole = ds.percentiles(df, [], "x", [0.5], ["m"], large=100).first().m
    assert whole == pytest.approx(np.median([v.x for v in df.select("x").collect()]), rel=1e-12)


def test_the_fold_bounds_distinct_values(spark):
    df = spark.range(200_000).select(F.rand(1).alias("x")).cache()
    left = ds._snap(df, [], "x", [0.5], 100).distinct().count()
    assert left < 2_000


def test_histogram_from_an_origin(frame):
    df = frame([(0.0,), (0.9,), (1.0,), (-0.1,), (None,)], "x double")
    assert rows(ds.histogram(df, "x", 1, 0)) == [(-1, -1.0, 1), (0, 0.0, 2), (1, 1.0, 1)]
    assert rows(ds.histogram(df, "x", 1, 0, closed="right")) == [(-1, -1.0, 2), (0, 0.0, 2)]


def test_histogram_from_the_smallest_value(frame):
    # The largest value lies on an edge and stays in the last bin.
    df = frame([(1,), (5,), (6,), (11,)], "n long")
    assert rows(ds.histogram(df, "n", 5)) == [(0, 1.0, 2), (1, 6.0, 2)]
    assert rows(ds.histogram(frame([(4,), (4,)], "n long"), "n", 5)) == [(0, 4.0, 2)]
    assert rows(ds.histogram(frame([(1,), (12,)], "n long"), "n", 5)) == [(0, 1.0, 1), (2, 11.0, 1)]


def test_box_stats(frame):
    df = frame([(float(v),) for v in (1, 2, 3, 4, 5, 100)] + [(None,)], "x double")
    r = ds.box_stats(df, "x").first()
    assert (r.n, r.min, r.q1, r.median, r.q3, r.max) == (6, 1.0, 2.25, 3.5, 4.75, 100.0)
    assert (r.whisker_low, r.whisker_high, r.n_outliers) == (1.0, 5.0, 1)
    one = ds.box_stats(frame([(3.0,)], "x double"), "x").first()
    assert (one.whisker_low, one.whisker_high, one.n_outliers) == (3.0, 3.0, 0)


def test_table_one(frame):
    df = frame(
        [("a", "F", 10.0), ("a", "F", 20.0), ("a", None, None), ("b", "M", 5.0)], "g string, sex string, age double"
    )
    out = ds.table_one(df, "g", ["sex"], ["age"], {"age": "Age *"})
    got = {(r.g, r.variable, r.level): r for r in out.collect()}
    assert (got["a", "sex", "F"].n, round(got["a", "sex", "F"].pct, 4)) == (2, 66.6667)
    assert got["a", "sex", None].n == 1
    age = got["a", "age", None]
    assert (age.n, age.mean, age.median, age.min, age.max, age.missing, age.label) == (2, 15.0, 15.0, 10.0, 20.0, 1, "Age *")
    assert round(age.sd, 4) == 7.0711
    # One row has no standard deviation.
    assert got["b", "age", None].sd is None
    assert got["b", "sex", "M"].label == "sex"


def test_category_counts(frame):
    assert rows(ds.category_counts(frame([("x",), ("x",), (None,)], "c string"), "c")) == [("x", 2), (None, 1)]
