"""Pairs of near points against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import graphs
from tests.conftest import executed_plan


def brute(points, radius):
    out = {}
    for a, xa, ya in points:
        for b, xb, yb in points:
            if a is not None and b is not None and a < b and None not in (xa, ya, xb, yb):
                d = math.dist((xa, ya), (xb, yb))
                if d <= radius:
                    out[a, b] = round(d, 9)
    return out


@pytest.mark.parametrize("crowd", [7, 2000])
def test_pairs_within_radius(spark, crowd):
    """A third of all points in one cell, equal points, cell edges, negative places, nulls, NaN and infinity."""
    rng = random.Random(5)
    points = [(k, rng.uniform(-1, 1), rng.uniform(-1, 1)) for k in range(300)]
    points += [(300 + k, 0.5 + rng.random() * 0.01, 0.5 + rng.random() * 0.01) for k in range(150)]
    points += [(500 + k, 0.1 * k, -0.1 * k) for k in range(-5, 6)] + [(600, 0.3, 0.3), (601, 0.3, 0.3)]
    odd = [(700, None, 0.3), (701, float("nan"), 0.3), (702, 0.3, float("inf")), (None, 0.3, 0.3)]
    df = spark.createDataFrame(points + odd, "id long, x double, y double")
    found = graphs.pairs_within(df, "id", "x", "y", 0.1, crowd)
    got = {(r["key_a"], r["key_b"]): round(r["distance"], 9) for r in found.collect()}
    assert got == brute(points, 0.1) and got[600, 601] == 0
    plan = executed_plan(found)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_crowded_cell_is_dealt_into_parts(spark):
    df = spark.range(3000).select(F.col("id"), (F.rand(1) * 0.01).alias("x"), F.when(F.col("id") % 3 == 0, F.rand(2) * 0.01).otherwise(
        F.rand(3) * 50).alias("y"))
    found = graphs.pairs_within(df, "id", "x", "y", 0.015, crowd=100)
    n = df.where("y < 0.01").count()
    assert found.count() >= n * (n - 1) // 2


def test_no_points(spark):
    assert graphs.pairs_within(spark.createDataFrame([], "id long, x double, y double"), "id", "x", "y", 1.0).count() == 0
