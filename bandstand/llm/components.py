"""Connected components of a graph given as pairs, by alternating stars.

Each round points every node's larger neighbours to its smallest one, then its smaller neighbours (and
itself) to the smallest of those, until nothing changes; the edges are then stars around the smallest node
of each component. All groups are reduced by ``min`` before they are shuffled, and the reduced side of each
join is a written table, so that adaptive execution can split the rows of a hub over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bandstand.runtime import Scratch

MOST_ROUNDS = 60
TASK_EDGES = 250_000
LEAST_TASKS = 12


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def _star(scratch: Scratch, pairs: DataFrame, tasks: int) -> tuple[DataFrame, DataFrame]:
    """``pairs`` of (u, v) and, joined on, the least of u and its v's as ``m``."""
    least = scratch.write(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks))
    return pairs.join(least, "u"), least


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``links`` (columns ``a, b``); the label is the smallest node reachable.

    Loops and repeated links do no harm; links with a null end are left out; without links the result is empty.
    """
    edges = scratch.write(
        links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    )
    state = _state(edges)
    # The edges never grow much: as many tasks as their number asks for read and write them.
    tasks = max(LEAST_TASKS, -(-state[0] // TASK_EDGES))
    for _ in range(MOST_ROUNDS):
        if state[0] == 0:
            break
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
        met, least = _star(scratch, both, tasks)
        large = scratch.write(met.where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct().coalesce(tasks))
        scratch.drop(least)
        met, least = _star(scratch, large.select(F.col("hi").alias("u"), F.col("lo").alias("v")), tasks)
        ends = F.array("u", "v")
        small = scratch.write(
            met.select(F.col("m").alias("lo"), F.explode(ends).alias("hi")).where("lo <> hi").distinct().coalesce(tasks)
        )
        scratch.drop(least, large, edges)
        edges, before, state = small, state, _state(small)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return scratch.write(edges.select(F.col("hi").alias("node"), F.col("lo").alias("label")).union(roots).coalesce(tasks))
