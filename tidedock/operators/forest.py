"""Isolation forest over station activity features.

Spark has no such estimator. Subsampling and scoring are distributed over the stations; a tree only
ever sees its own subsample (at most 256 rows), and the finished forest is at most 100 x 511 nodes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidedock.operators.ordered import exact_quantiles
from tidedock.staging import stage

# Size of the forest and of a subsample, smallest fleet that is scored.
TREES = 100
SUBSAMPLE = 256
MIN_STATIONS = 5
EULER_GAMMA = 0.5772156649015329

LEFT, RIGHT = 3, 4  # positions of the child links in a node row
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, depth int, size int"


def average_path_length(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def subsamples(points: DataFrame, key: str, n_points: int, trees: int, size: int, seed: int) -> DataFrame:
    """``(tree, key, features)``: for each tree the ``size`` points with the smallest hashes.

    A first cut by hash keeps about twice the wanted size, whatever the number of points, so the
    ranking window of a tree stays small. If the cut leaves a tree short it is only short by chance
    of a vanishing size.
    """
    rate = min(1.0, 2.0 * size / n_points)
    hashes = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.struct(
            t.alias("tree"),
            (F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))).alias("h"),
        ),
    )
    drawn = points.select(key, "features", F.explode(F.filter(hashes, lambda s: s["h"] < rate)).alias("s"))
    rank = F.row_number().over(W.partitionBy("tree").orderBy("h", key))
    return (
        drawn.select(key, "features", "s.tree", "s.h")
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= size)
        .select("tree", key, "features")
    )


def grow_tree(sample: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[list]:
    """Random splits until single or equal points or the depth limit; rows of ``NODE_SCHEMA`` less the tree."""
    nodes: list[list] = []
    pending = [(np.arange(len(sample)), 0, -1, False)]
    while pending:
        rows, depth, parent, is_left = pending.pop()
        node = len(nodes)
        if parent >= 0:
            nodes[parent][LEFT if is_left else RIGHT] = node
        part = sample[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= max_depth or len(rows) <= 1 or not len(varying):
            nodes.append([node, -1, 0.0, -1, -1, depth, len(rows)])
            continue
        feature = int(rng.choice(varying))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= threshold
        nodes.append([node, feature, threshold, -1, -1, depth, len(rows)])
        pending.append((rows[~goes_left], depth + 1, node, False))
        pending.append((rows[goes_left], depth + 1, node, True))
    return nodes


def fit_forest(points: DataFrame, key: str, n_points: int, trees: int, size: int, seed: int) -> DataFrame:
    """Node table of the forest, one tree per group."""
    max_depth = math.ceil(math.log2(max(min(size, n_points), 2)))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(key)
        rng = np.random.default_rng([seed, tree])
        nodes = grow_tree(np.vstack(pdf["features"].to_numpy()), rng, max_depth)
        return pd.DataFrame([(tree, *n) for n in nodes],
                            columns=["tree", "node", "feature", "threshold", "left", "right", "depth", "size"])

    drawn = subsamples(points, key, n_points, trees, size, seed)
    return drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def forest_row(nodes: DataFrame) -> DataFrame:
    """The forest as one row: an array of trees, each with its nodes as columns in order of their numbers.

    At most trees x (2 x subsample size - 1) nodes. ``length`` is the depth of a leaf and what points in it would still need.
    """
    n = F.col("size").cast("double")
    rest = F.when(n <= 1, 0.0).when(n == 2, 1.0).otherwise(2.0 * (F.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n)
    columns = ["feature", "threshold", "left", "right", "length"]
    node = F.struct("node", *columns[:4], (F.col("depth") + rest).alias("length"))
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    tree = F.struct("tree", *[F.col(f"nodes.{c}").alias(c) for c in columns])
    return trees.agg(F.array_sort(F.collect_list(tree)).alias("forest"))


def score_forest(points: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``points`` with ``raw_score`` in [-1, 0]; lower is more isolated. Trees are walked by expressions over the broadcast forest."""
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    scale = max(average_path_length(size), 1e-12)
    steps = F.sequence(F.lit(1), F.lit(max(depth, 1)))

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            feature = F.get(tree["feature"], at)
            goes_left = F.get(F.col("features"), F.greatest(feature, F.lit(0))) <= F.get(tree["threshold"], at)
            return F.when(feature < 0, at).when(goes_left, F.get(tree["left"], at)).otherwise(F.get(tree["right"], at))

        return F.aggregate(steps, F.lit(0), step)

    lengths = F.aggregate("forest", F.lit(0.0), lambda total, t: total + F.get(t["length"], leaf(t)))
    forest = F.broadcast(forest_row(nodes).withColumn("_one", F.lit(1)))
    scored = points.withColumn("_one", F.lit(1)).join(forest, "_one")
    raw = -F.pow(F.lit(2.0), -lengths / (F.size("forest") * scale))
    return scored.withColumn("raw_score", raw).drop("forest", "_one")


def isolation_forest(
    activity: DataFrame,
    contamination: float = 0.05,
    seed: int = 42,
    key: str = "station_id",
    columns: list[str] | None = None,
    trees: int = TREES,
    size: int = SUBSAMPLE,
) -> DataFrame:
    """``activity`` with ``anomaly_label`` (-1 or 1) and ``anomaly_score`` (lower is worse).

    The score is shifted so that the ``contamination`` quantile of all stations lies at zero. Fewer
    than five stations are all inliers with score 0.
    """
    from tidedock.operators.drift import numeric_columns

    columns = columns or [c for c in numeric_columns(activity) if c != key]
    features = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])
    points = stage(activity.withColumn("features", features), "activity")
    n_points = points.count()
    if n_points < MIN_STATIONS:
        return points.drop("features").withColumns(
            {"anomaly_label": F.lit(1), "anomaly_score": F.lit(0.0)}
        )
    nodes = stage(fit_forest(points, key, n_points, trees, size, seed), "forest")
    scored = stage(score_forest(points, nodes, min(size, n_points)).drop("features"), "isolation-scores")
    offset = exact_quantiles(scored, "raw_score", [contamination]).scalar()
    score = F.col("raw_score") - offset
    return (
        scored.withColumn("anomaly_score", score)
        .withColumn("anomaly_label", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))
        .drop("raw_score")
    )
