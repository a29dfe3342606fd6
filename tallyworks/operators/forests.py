"""A regression forest's predictions, grown in tasks: no tree is ever held by the driver.

Spark's own forest keeps every node of every tree on the driver. Here the rows are dealt to a task per
tree, which grows the tree level by level and leads the rows to be predicted along, so that only predictions
leave it. A tree with more than ``TASK_ROWS`` rows is first cut by histograms that Spark sums, until each
part fits a task. The method is that of Spark's forest: at most ``maxBins`` bins per feature, a bootstrap sample
per tree, a third of the features for each node, splits of highest variance gain, means in the leaves. The draws are
others than Spark's; they follow from the seed and the stored row's number.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Training rows of one task.
TASK_ROWS = 2_000_000
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(16)])


def _draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's sample: Poisson with mean 1, from a mix of its number."""
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree + 1) * 0xD1B54A32D192ED03 + seed & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_POISSON, (x ^ (x >> np.uint64(31))) / 2.0 ** 64, "right")


def _best(node, cell_bin, w, s, q, total):
    """Nodes of one feature's cells (sorted by node and bin), their best gain and the last bin of the left side."""
    first = np.flatnonzero(np.diff(node, prepend=-1))
    size = np.diff(np.append(first, len(node)))
    left = []
    for x in (w, s, q):
        c = np.cumsum(x)
        left.append(c - np.repeat(c[first] - x[first], size))
    lw, ls, lq = left
    tw, ts, tq = (t[node] for t in total)
    rw, rs, rq = tw - lw, ts - ls, tq - lq
    with np.errstate(divide="ignore", invalid="ignore"):
        # weighted variances: what stays of the squares about the means
        gain = ((tq - ts * ts / tw) - (lq - ls * ls / lw) - (rq - rs * rs / rw)) / tw
    gain[np.append(first[1:], len(node)) - 1] = -1.0  # all rows on the left
    best = np.maximum.reduceat(gain, first)
    at = np.flatnonzero(gain == np.repeat(best, size))
    at = at[np.flatnonzero(np.diff(node[at], prepend=-1))]
    return node[first], best, cell_bin[at]


def _chosen(nodes: int, p: int, rng) -> np.ndarray:
    """Which features a node may use."""
    return rng.random((nodes, p)).argsort(axis=1).argsort(axis=1) < -(-p // 3)


def _splits(cells, total, chosen, least):
    """Feature (-1: none) and bin of each node's split. ``cells(f, nodes)`` gives a feature's sorted cells of these nodes."""
    nodes, p = chosen.shape
    feature, at, gain = np.full(nodes, -1), np.zeros(nodes, np.int64), np.full(nodes, least)
    for f in range(p):
        node, cell_bin, w, s, q = cells(f, chosen[:, f])
        if len(node):
            n, g, b = _best(node, cell_bin, w, s, q, total)
            better = g > gain[n]
            n = n[better]
            feature[n], at[n], gain[n] = f, b[better], g[better]
    return feature, at


def _grown(bins, y, w, test, depth, level, least, rng):
    """Predictions of the test rows' bins by a tree that is grown on (bins, y, w)."""
    out, node, tnode, live = np.zeros(len(test)), np.zeros(len(y), np.int64), np.zeros(len(test), np.int64), np.arange(len(test))
    nodes = 1
    while True:
        total = [np.bincount(node, x, nodes) for x in (w, w * y, w * y * y)]
        mean = total[1] / total[0]
        out[live] = mean[tnode]
        open_ = (total[2] / total[0] - mean * mean > least) if level < depth else np.zeros(nodes, bool)
        if not (open_.any() and len(live)):
            return out

        def cells(f, some):
            rows = (some & open_)[node]
            u, inverse = np.unique(node[rows] * 256 + bins[rows, f], return_inverse=True)
            v, r = w[rows], y[rows]
            return (u >> 8, u & 255, *[np.bincount(inverse, x, len(u)) for x in (v, v * r, v * r * r)])
        feature, at = _splits(cells, total, _chosen(nodes, bins.shape[1], rng), least * 1e-3)
        # a node without a split keeps its mean; the others' rows go on, numbered anew
        def onward(node, bins):
            f = feature[node]
            stay = f >= 0
            side = bins[np.arange(len(node)), np.maximum(f, 0)] > at[node]
            return stay, 2 * node + side
        keep, child = onward(node, bins)
        tkeep, tchild = onward(tnode, test)
        used = np.zeros(2 * nodes, bool)
        used[child[keep]] = True
        number = np.cumsum(used) - 1
        bins, y, w, node = bins[keep], y[keep], w[keep], number[child[keep]]
        test, live, tnode = test[tkeep], live[tkeep], number[tchild[tkeep]]
        nodes, level = int(used.sum()), level + 1
        if not nodes:
            return out


def thresholds(rows: DataFrame, p: int, bins: int) -> list[np.ndarray]:
    """Ends of each feature's bins: between all values if they are few, otherwise at evenly dealt ranks."""
    x = [F.col("x")[i] for i in range(p)]
    few = rows.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(x)]).first()
    out = []
    for i, c in enumerate(x):
        values = []
        if few[i] <= 2 * bins:
            values = sorted(r[0] for r in rows.select(c.alias("v")).distinct().limit(bins + 1).collect())
        if 0 < len(values) <= bins:
            out.append((np.array(values[1:]) + np.array(values[:-1])) / 2)
        else:
            ranks = [k / bins for k in range(1, bins)]
            out.append(np.unique(rows.agg(F.percentile_approx(c, ranks, F.lit(100_000))).first()[0]))
    return out


def _routed(bins, top):
    """The node of a tree's upper part that each row comes to."""
    node = np.zeros(len(bins), np.int64)
    while True:
        f = top["feature"][node]
        go = np.flatnonzero(f >= 0)
        if not len(go):
            return node
        n = node[go]
        node[go] = top["child"][n] + (bins[go, f[go]] > top["bin"][n])


def predicted(train: DataFrame, test: DataFrame, forest: RandomForestRegressor) -> DataFrame:
    """``test`` with the prediction of a forest of these settings that is grown on ``train``."""
    label, vector = forest.getLabelCol(), forest.getFeaturesCol()
    trees, depth, seed, most = forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed(), TASK_ROWS
    if forest.getMaxBins() > 256:
        raise ValueError("at most 256 bins")
    array = vector_to_array(F.col(vector)).alias("x")
    y = F.coalesce(F.col(label).cast("double"), F.raise_error(F.lit(f"null in {label}")).cast("double")).alias("y")
    known = materialize(train.select(F.monotonically_increasing_id().alias("id"), array, y), "forest-rows")
    asked = materialize(test.withColumn("__id", F.monotonically_increasing_id()), "forest-tests")
    row = known.agg(F.count(F.lit(1)), F.avg("y"), F.var_pop("y"), F.max(F.size("x"))).first()
    n, mean, variance, p = row
    if not n:
        raise ValueError("no rows to learn from")
    ends, least = thresholds(known, p, forest.getMaxBins()), 1e-12 * variance

    def binned(batch):
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, p)
        return np.stack([np.searchsorted(ends[i], x[:, i]) for i in range(p)], axis=1).astype(np.uint8)

    tops = [{"feature": np.array([-1]), "bin": np.array([0]), "child": np.array([0]), "level": np.array([0]),
             "rows": np.array([n])} for _ in range(trees)]
    rng = np.random.default_rng([seed, trees])
    while found := [(t, k) for t, top in enumerate(tops) for k in np.flatnonzero((top["feature"] == -1) & (top["rows"] > most) & (top["level"] < depth))]:
        wanted = {x: i for i, x in enumerate(found)}

        def summed(batches):
            table = np.zeros((3, len(wanted), p, 256))
            for batch in batches:
                bins, ids = binned(batch), batch.column(0).to_numpy()
                value = batch.column(2).to_numpy() - mean
                for t in {t for t, _ in wanted}:
                    w, node = _draws(ids, t, seed), _routed(bins, tops[t])
                    number = np.full(len(tops[t]["feature"]), -1)
                    for (tree, k), i in wanted.items():
                        if tree == t:
                            number[k] = i
                    at = number[node]
                    rows = (at >= 0) & (w > 0)
                    for f in range(p):
                        cell = at[rows] * 256 + bins[rows, f]
                        for i, v in enumerate((w[rows], w[rows] * value[rows], w[rows] * value[rows] ** 2)):
                            table[i, :, f] += np.bincount(cell, v, len(wanted) * 256).reshape(-1, 256)
            at = np.nonzero(table[0])
            yield pa.RecordBatch.from_arrays([*[pa.array(i.astype(np.int32)) for i in at], *[pa.array(x[at]) for x in table]],
                                             ["node", "f", "b", "w", "s", "q"])
        rows = known.mapInArrow(summed, "node int, f int, b int, w double, s double, q double").groupBy("node", "f", "b").agg(
            *[F.sum(c).alias(c) for c in "wsq"]).orderBy("node", "f", "b").toArrow()
        node, feature, cell_bin, *sums = (rows.column(c).to_numpy() for c in rows.column_names)
        total = [np.bincount(node[feature == 0], x[feature == 0], len(found)) for x in sums]

        def cells(f, some):
            at = (feature == f) & some[node]
            return node[at], cell_bin[at], *[x[at] for x in sums]
        split, at = _splits(cells, total, _chosen(len(found), p, rng), least * 1e-3)
        for (t, k), i in wanted.items():
            top = tops[t]
            if split[i] < 0:
                top["feature"][k] = -2  # nothing to gain
                continue
            mine = (node == i) & (feature == split[i])
            left = sums[0][mine & (cell_bin <= at[i])].sum()
            top["feature"][k], top["bin"][k], top["child"][k] = split[i], at[i], len(top["feature"])
            for name, more in (("feature", [-1, -1]), ("bin", [0, 0]), ("child", [0, 0]), ("level", [top["level"][k] + 1] * 2),
                               ("rows", [int(left), int(total[0][i] - left)])):
                top[name] = np.append(top[name], more)
    parts = [(t, int(k)) for t, top in enumerate(tops) for k in np.flatnonzero(top["feature"] < 0)]
    slots = [np.full(len(top["feature"]), -1) for top in tops]
    for i, (t, k) in enumerate(parts):
        slots[t][k] = i

    def dealt(batches):
        for batch in batches:
            bins, ids, value = binned(batch), batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False) - mean
            learn = batch.column(3).to_numpy(zero_copy_only=False)
            for t in range(trees):
                slot = slots[t][_routed(bins, tops[t])]
                w = np.where(learn, _draws(ids, t, seed), 1)
                for s in np.unique(slot):
                    for kind in (True, False):
                        rows = np.flatnonzero((slot == s) & (learn == kind) & (w > 0))
                        if len(rows):
                            held = [bins[rows], w[rows].astype(np.uint8), value[rows] if kind else ids[rows]]
                            yield pa.RecordBatch.from_arrays([pa.array([int(s)], pa.int32()), pa.array([kind]), *[pa.array([x.tobytes()], pa.binary()) for x in held]],
                                                             ["slot", "learn", "bins", "w", "v"])

    def grown(batches):
        held = {}
        for batch in batches:
            for r in batch.to_pylist():
                held.setdefault((r["slot"], r["learn"]), []).append((r["bins"], r["w"], r["v"]))
        for slot in sorted({s for s, _ in held}):
            def joined(kind, i, dtype):
                return np.frombuffer(b"".join(r[i] for r in held.get((slot, kind), [])), dtype)
            ids = joined(False, 2, np.int64)
            t, k = parts[slot]
            if not len(ids):
                continue
            values, w = joined(True, 2, np.float64), joined(True, 1, np.uint8).astype(np.float64)
            if not len(values):
                values, w, bins = np.zeros(1), np.ones(1), np.zeros((1, p), np.uint8)
            else:
                bins = joined(True, 0, np.uint8).reshape(-1, p)
            found = _grown(bins, values, w, joined(False, 0, np.uint8).reshape(-1, p), depth, int(tops[t]["level"][k]), least,
                           np.random.default_rng([seed, t, k]))
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found + mean)], ["__id", "prediction"])
    columns = ["id", "x", "y", "learn"]
    rows = known.select("id", "x", "y", F.lit(True).alias("learn")).union(
        asked.select(F.col("__id").alias("id"), array, F.lit(0.0).alias("y"), F.lit(False).alias("learn"))).select(*columns)
    packed = rows.mapInArrow(dealt, "slot int, learn boolean, bins binary, w binary, v binary").repartitionById(len(parts), F.col("slot"))
    means = packed.mapInArrow(grown, "__id long, prediction double").groupBy("__id").agg(F.avg("prediction").alias("prediction"))
    return asked.join(means, "__id").drop("__id")
