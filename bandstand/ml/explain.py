"""Exact path-dependent Shapley attributions of boosted trees (Lundberg et al. 2018).

A leaf's share depends only on which of the features on its path agree with the row, so every leaf gets a
small table from agreement pattern to attributions when the model is read. The leaves below a node two levels above the
last are added up to one table by the answers of its three splits and those above it; scoring a batch is then a
lookup per such node. Trees are bounded by rounds and depth, which bounds what is shipped to the tasks.
"""

from __future__ import annotations

from math import factorial

import numpy as np
from pyspark.sql import DataFrame, functions as F

from bandstand.ml.trees import BoostedTrees


def tree_tables(model: BoostedTrees, width: int) -> tuple[list[tuple], float]:
    """Per tree ``(features, thresholds, groups)`` of its splits and the expected margin of the whole model.

    A group is ``(nodes, table)``: bit ``i`` of a row of the table says that node ``nodes[i]`` sends a row left.
    """
    nodes = model.feature.shape[1]
    inner = nodes // 2
    depth = (nodes + 1).bit_length() - 2
    trees, base = [], 0.0
    for features, thresholds, values, covers in zip(model.feature, model.threshold, model.value, model.cover):
        tables: dict[int, np.ndarray] = {}
        paths: dict[int, list[int]] = {}
        stack = [(0, (), {})]
        while stack:
            at, conditions, reach = stack.pop()
            feature, value, count = int(features[at]), float(values[at]), covers[at]
            if feature < 0:
                base += value * float(np.prod(list(reach.values())) if reach else 1.0)
                if reach:
                    top = _group(at, depth)
                    if top not in tables:
                        paths[top] = _splits(top, inner)
                        tables[top] = np.zeros((1 << len(paths[top]), width))
                    place = {node: i for i, node in enumerate(paths[top])}
                    rows = np.arange(len(tables[top]))
                    used = list(reach)
                    agree = {f: np.ones(len(rows), dtype=bool) for f in used}
                    for node, is_left in conditions:
                        agree[int(features[node])] &= (rows >> place[node] & 1) == is_left
                    pattern = sum(agree[f].astype(int) << j for j, f in enumerate(used))
                    tables[top][:, used] += _pattern_table(value, list(reach.values()))[pattern]
                continue
            for child, is_left in ((2 * at + 1, 1), (2 * at + 2, 0)):
                share = covers[child] / count if count else 0.0
                stack.append((child, (*conditions, (at, is_left)), {**reach, feature: reach.get(feature, 1.0) * share}))
        trees.append((features[:inner], thresholds[:inner], [(paths[k], table) for k, table in tables.items()]))
    return trees, base


def _group(leaf: int, depth: int) -> int:
    """The node two levels above the last whose table holds the leaf: above it, or leftmost below it."""
    level = (leaf + 1).bit_length() - 1
    top = max(0, depth - 2)
    while level > top:
        leaf, level = (leaf - 1) // 2, level - 1
    while level < top:
        leaf, level = 2 * leaf + 1, level + 1
    return leaf


def _splits(top: int, inner: int) -> list[int]:
    """The nodes above ``top``, itself and its children, as far as they can split."""
    above = []
    at = top
    while at:
        at = (at - 1) // 2
        above.append(at)
    return [node for node in (*above[::-1], top, 2 * top + 1, 2 * top + 2) if node < inner]


def _pattern_table(value: float, reach: list[float]) -> np.ndarray:
    """Row per agreement pattern (bit j: feature j agrees), column per feature of the path.

    The products over all sets of ``size`` known features are the coefficients of a polynomial: each feature is a
    factor of its share (unknown) plus its agreement times the variable (known).
    """
    m = len(reach)
    agrees = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)
    share = np.array([factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)])
    table = np.zeros((1 << m, m))
    for j in range(m):
        sets = np.zeros((1 << m, m))
        sets[:, 0] = 1.0
        for i in range(m):
            if i != j:
                known = sets[:, :-1] * agrees[:, i, None]
                sets *= reach[i]
                sets[:, 1:] += known
        table[:, j] = value * (agrees[:, j] - reach[j]) * (sets @ share)
    return table


def attribute(df: DataFrame, model: BoostedTrees, features: list[str], name: str = "contributions") -> DataFrame:
    """Add the attribution of each feature to the model's margin; they and ``base`` add up to it."""
    return _attributed(df, [model], features, name)


def _attributed(df: DataFrame, models: list[BoostedTrees], features: list[str], name: str) -> DataFrame:
    """The mean attribution over the models, whose trees are looked up in one pass over the rows."""
    read = [tree_tables(model, len(features)) for model in models]
    base = sum(b for _, b in read) / len(models)
    shipped = df.sparkSession.sparkContext.broadcast([tree for trees, _ in read for tree in trees])
    share = 1 / len(models)

    @F.pandas_udf("array<double>")
    def shap(*columns):
        import pandas as pd

        x = [np.ascontiguousarray(c.to_numpy(dtype=float)) for c in columns]
        phi = np.zeros((len(x[0]), len(x)))
        for split, thresholds, groups in shipped.value:
            left = [(x[f] <= t).view(np.uint8) if f >= 0 else None for f, t in zip(split.tolist(), thresholds.tolist())]
            for nodes, table in groups:
                row = np.zeros(len(phi), dtype=np.intp)
                for i, node in enumerate(nodes):
                    if left[node] is not None:
                        row += left[node].astype(np.intp) << i
                phi += table.take(row, axis=0)
        return pd.Series(list(phi * share))

    return df.withColumns({name: shap(*[F.col(c).cast("double") for c in features]), "base_value": F.lit(base)})


def global_importance(df: DataFrame, features: list[str], contributions: str = "contributions") -> DataFrame:
    """Mean absolute attribution per feature, largest first. Pre-aggregated, a row per feature is shuffled."""
    names = F.array(*[F.lit(f) for f in features])
    return (
        df.select(F.posexplode(contributions).alias("at", "v"))
        .groupBy(F.element_at(names, F.col("at") + 1).alias("feature"))
        .agg(F.avg(F.abs("v")).alias("mean_abs_shap"))
        .orderBy(F.col("mean_abs_shap").desc(), "feature")
    )


def mean_attribution(df: DataFrame, models: list[BoostedTrees], features: list[str]) -> DataFrame:
    """Attributions averaged over the fold models."""
    return _attributed(df, models, features, "contributions")
