import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vicinity.functions.vectors import (
    METRICS,
    dims,
    distance,
    distance_to,
    format_vector,
    norm,
    normalize,
    parse_vector,
    row_distances,
)


def one(spark, a, b, metric):
    df = spark.createDataFrame([(a, b)], "a array<float>, b array<float>")
    return df.select(distance(F.col("a"), F.col("b"), metric)).first()[0]


@pytest.mark.parametrize(
    "metric,expected",
    [("l2", math.sqrt(27)), ("cosine", 1 - 32 / math.sqrt(14 * 77)), ("ip", -32.0), ("l1", 9.0)],
)
def test_four_metrics_on_one_pair(spark, metric, expected):
    assert one(spark, [1.0, 2.0, 3.0], [4.0, 5.0, 6.0], metric) == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize(
    "a,b,expected",
    [([1, 2, 3], [1, 2, 3], 0.0), ([1, 0, 0], [0, 1, 0], 1.0), ([1, 2, 3], [-1, -2, -3], 2.0)],
)
def test_cosine_runs_from_zero_to_two(spark, a, b, expected):
    assert one(spark, [float(x) for x in a], [float(x) for x in b], "cosine") == pytest.approx(expected)


def test_null_and_zero_vectors_have_no_cosine_distance(spark):
    assert one(spark, None, [1.0], "cosine") is None
    assert one(spark, [0.0, 0.0], [1.0, 0.0], "cosine") is None


def test_unequal_sizes_raise(spark):
    with pytest.raises(Exception, match="different vector dimensions"):
        one(spark, [1.0], [1.0, 2.0], "l2")
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<float>")
    with pytest.raises(Exception, match="different vector dimensions"):
        df.select(distance_to(F.col("v"), [1.0, 2.0, 3.0])).collect()


def test_unknown_metric_is_refused(spark):
    with pytest.raises(ValueError):
        distance(F.lit(None), F.lit(None), "hamming")
    with pytest.raises(ValueError):
        distance_to(F.lit(None), [1.0], "hamming")


@pytest.mark.parametrize("metric", METRICS)
def test_arrow_kernel_agrees_with_the_column_form(spark, metric):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=17)]) for i in range(200)] + [(200, None), (201, [0.0] * 17)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    target = [float(np.float32(x)) for x in rng.normal(size=17)]
    both = df.select(
        distance(F.col("v"), F.array(*map(F.lit, target)), metric).alias("a"),
        distance_to(F.col("v"), target, metric).alias("b"),
    ).collect()
    assert both[200].a is None and both[200].b is None
    if metric == "cosine":  # a zero vector: NULL in the column form, NaN (sorts last) in the other
        zero = both.pop()
        assert zero.a is None and math.isnan(zero.b)
    for row in both:
        assert row.a == pytest.approx(row.b, abs=1e-9) if row.a is not None else row.b is None


def test_equal_rows_get_equal_distances_wherever_they_stand():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(999, 384))
    rows[[0, 500, 998]] = rows[17]
    got = row_distances(rows, rng.normal(size=384), "cosine")
    assert got[0] == got[17] == got[500] == got[998]


def test_literals_size_and_length(spark):
    df = spark.createDataFrame([("[1,2,-3.5]", [3.0, 4.0]), ("[]", None)], "t string, v array<float>")
    first, second = df.select(
        parse_vector(F.col("t")).alias("p"), format_vector(F.col("v")).alias("f"), dims(F.col("v")).alias("d"),
        norm(F.col("v")).alias("n"), normalize(F.col("v")).alias("u"),
    ).collect()
    assert first.p == [1.0, 2.0, -3.5] and first.f == "[3.0,4.0]" and first.d == 2 and first.n == 5.0
    assert first.u == pytest.approx([0.6, 0.8])
    assert second.p == [] and second.f is None and second.d is None


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],)], "v array<float>")
    assert df.select(normalize(F.col("v"))).first()[0] == [0.0, 0.0]
