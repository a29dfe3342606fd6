"""Neighbour features of an edge list, and route scoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.joins import lookup_join
from tallyworks.operators.ordering import running_total
from tallyworks.session import materialize


def neighbour_stats(edges: DataFrame, features: DataFrame, value: str) -> DataFrame:
    """Distinct neighbours of each source node and their mean feature.

    ``edges`` has src and dst, ``features`` has dst and the value.
    """
    links = edges.select("src", "dst").distinct()
    met = lookup_join(links, features, ["dst"])
    return met.groupBy("src").agg(F.count(F.lit(1)).alias("neighbours"), F.avg(value).alias("mean_feature"))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def leg_lengths(stops: Column) -> Column:
    """Distances between consecutive stops (x, y) of a route held in one row."""
    steps = F.sequence(F.lit(0), F.size(stops) - 2)
    legs = F.transform(steps, lambda i: distance(stops[i]["x"], stops[i]["y"], stops[i + 1]["x"], stops[i + 1]["y"]))
    return F.when(F.size(stops) < 2, F.array().cast("array<double>")).otherwise(legs)


def leg_table(routes: DataFrame, key: str, stops: str) -> DataFrame:
    """One row per leg: only pairs of stops that a route joins."""
    return routes.select(key, F.posexplode(leg_lengths(F.col(stops))).alias("leg", "distance"))


def pairs_within(points: DataFrame, key: str, x: str, y: str, radius: float, crowd: int = 2000) -> DataFrame:
    """(key_a, key_b, distance) of all points at most ``radius`` apart, key_a < key_b.

    The plane is cut into cells as wide as the radius. Each point stays in its own cell and
    visits the eight around it, so only near points meet. The points that stay in a cell are
    dealt into parts of about ``crowd`` points, and visitors go to each part: a cell that holds a
    third of all points is many tasks' work. Points without a finite place or a key have no pairs.
    """
    place = lambda c: F.floor(F.col(c) / F.lit(radius)).cast("long")
    known = points.select(F.col(key).alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).where(
        F.col("k").isNotNull() & (F.abs("x") < F.lit(float("inf"))) & (F.abs("y") < F.lit(float("inf"))))
    placed = known.select("*", place("x").alias("cx"), place("y").alias("cy"))
    sizes = materialize(placed.groupBy("cx", "cy").agg(F.ceil(F.count(F.lit(1)) / crowd).cast("int").alias("parts")), "cells")
    stay = lookup_join(placed, sizes, ["cx", "cy"], "inner").select(
        "cx", "cy", F.pmod(F.xxhash64("k"), F.col("parts")).cast("int").alias("part"),
        F.col("k").alias("key_b"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    visits = placed.withColumn("s", F.explode(steps)).select(
        (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"), F.col("k").alias("key_a"),
        F.col("x").alias("xa"), F.col("y").alias("ya"))
    visits = lookup_join(visits, sizes, ["cx", "cy"], "inner").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    apart = distance(F.col("xa"), F.col("ya"), F.col("xb"), F.col("yb"))
    met = visits.join(stay, ["cx", "cy", "part"]).where(F.col("key_a") < F.col("key_b"))
    return met.withColumn("distance", apart).where(F.col("distance") <= F.lit(radius)).select("key_a", "key_b", "distance")


def route_length(stops: Column) -> Column:
    return F.aggregate(leg_lengths(stops), F.lit(0.0), lambda total, leg: total + leg)


def selection_shares(candidates: DataFrame, key: str, fitness: str) -> DataFrame:
    """Share of each candidate in the total fitness, and the running share."""
    total = candidates.agg(F.sum(fitness).alias("total")).first()["total"]
    shares = candidates.withColumn("probability", F.try_divide(F.col(fitness), F.lit(total)))
    return running_total(shares, [key], "probability", "running")


def best_per_island(candidates: DataFrame, island: str, key: str, length: str) -> DataFrame:
    """Shortest route of each sub-population; lowest key on ties."""
    best = F.min(F.struct(length, key))
    return candidates.groupBy(island).agg(best.alias("best")).select(
        island, F.col(f"best.{key}").alias(key), F.col(f"best.{length}").alias(length))
