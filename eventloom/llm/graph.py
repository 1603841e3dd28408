"""Links inside groups without listing all pairs, and connected components."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import starts, stored, whole_groups

EDGE = "a binary, b binary"


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b) can reach.

    Alternates two steps until every node points at a root: each node hands its larger neighbours
    its smallest one, then its smaller neighbours.  A link never becomes two.
    Every round is written to the shared folder.
    """
    pointing = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), f"{label}-links")
    mine = Window.partitionBy("u")
    while not _settled(pointing):
        both = pointing.unionAll(pointing.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The hub of a large component has very many neighbours: their least combines before the exchange, and
        # the join back is one that adaptive execution splits.
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.repartition("u").dropDuplicates(["u", "v"]).withColumn("m", F.min("v").over(mine))
        pointing = stored(large.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")), f"{label}-links")
    roots = pointing.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pointing.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots).distinct()


def _settled(pointing: DataFrame) -> bool:
    """Whether every node points at one other node at most, and only at nodes that point nowhere."""
    ends = pointing.select(F.col("u").alias("n"), F.col("v").alias("out"), F.lit(0).alias("in"))
    ends = ends.unionAll(pointing.select("v", F.lit(None).cast("binary"), F.lit(1)))
    nodes = ends.groupBy("n").agg(F.min("out").alias("least"), F.max("out").alias("most"), F.max("in").alias("in"))
    return nodes.where("least <> most or (least is not null and in = 1)").isEmpty()


class Compared(Protocol):
    """The rows of one block, ready to be compared."""

    def similar(self, one: int, others: np.ndarray) -> np.ndarray:
        """Which of the other rows link with this one."""


def spanning(n: int, rows: Compared) -> list[tuple[int, int]]:
    """Links from the first row of what is connected to all others of it: each row is only compared with
    rows not yet reached."""
    left = np.arange(n)
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        first = int(left[0])
        queue, left = [first], left[1:]
        while queue and len(left):
            hit = rows.similar(queue.pop(), left)
            if hit.any():
                found = left[hit].tolist()
                out += [(first, x) for x in found]
                queue += found
                left = left[~hit]
    return out


def bridging(strays: np.ndarray, members: np.ndarray, labels: list, rows: Compared) -> list[tuple[int, int]]:
    """Links between differently labelled rows, one at most for two labels once joined."""
    number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
    mine = np.array([number[x] for x in labels], dtype=np.int64)  # joined labels get one number
    out = []
    for one in strays.tolist():
        others = members[mine[members] != mine[one]]
        if not len(others):
            continue
        for other in others[rows.similar(one, others)].tolist():
            if mine[other] != mine[one]:
                mine[mine == mine[other]] = mine[one]
                out.append((one, other))
    return out


def _edges(nodes: list[bytes], links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([nodes[i] for i, _ in links], pa.binary()), pa.array([nodes[j] for _, j in links], pa.binary())], names=["a", "b"]
    )


def linked(posts: DataFrame, payloads: DataFrame, compare: Callable[[list], Compared], label: str, block_rows: int, block_weight: int) -> DataFrame:
    """(node, component) over all pairs of nodes that share a group and that ``compare`` links.

    ``posts`` has (group, node), ``payloads`` (node, weight, payload).  Groups are cut into blocks of
    bounded rows and weight.  First rows meet within their block, and only links that connect
    something are kept.  Then, in groups of several blocks that are still in several components,
    all rows outside the group's largest component meet the blocks of all others.  So every pair is
    compared or already connected, and no block, however hot its group, exceeds its bound.
    """
    sized = posts.join(payloads.select("node", "weight"), "node").groupBy("group").agg(F.count("*").alias("rows"), F.sum("weight").alias("total"))
    cuts = F.greatest(F.ceil(F.col("rows") / block_rows), F.ceil(F.col("total") / block_weight)).cast("int")
    sized = stored(sized.where("rows > 1").select("group", "rows", cuts.alias("cuts")), f"{label}-sizes")
    placed = posts.join(sized, "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("cuts")))

    def within(batches):
        for table in whole_groups(batches, ["group", "block"]):
            nodes, loads = table.column("node").to_pylist(), table.column("payload")
            edges = starts(table, ["group", "block"])
            for i, j in zip(edges, [*edges[1:], table.num_rows], strict=True):
                if j - i > 1 and (links := spanning(j - i, compare(loads[i:j]))):
                    yield _edges(nodes[i:j], links)

    def across(batches):
        for table in whole_groups(batches, ["group", "i", "j"]):
            loads, side, marks = (table.column(c) for c in ("payload", "side", "component"))
            side, marks = np.array(side.to_pylist()), marks.to_pylist()
            edges = starts(table, ["group", "i", "j"])
            for i, j in zip(edges, [*edges[1:], table.num_rows], strict=True):
                strays, members = np.flatnonzero(side[i:j] == 0), np.flatnonzero(side[i:j] == 1)
                if len(strays) and len(members) and (links := bridging(strays, members, marks[i:j], compare(loads[i:j]))):
                    yield _edges(marks[i:j], links)  # components of the first phase are the nodes of the second

    loaded = placed.join(payloads.select("node", "payload"), "node").select("group", "block", "node", "payload")
    first = loaded.repartition("group", "block").sortWithinPartitions("group", "block", "node").mapInArrow(within, EDGE)
    known = stored(components(first, label), f"{label}-known")
    if sized.where("cuts > 1").isEmpty():
        return known

    several = placed.where("cuts > 1").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = stored(several.select("group", "node", "component", "cuts"), f"{label}-several")
    counted = several.groupBy("group", "component").agg(F.count("*").alias("n"), F.max("cuts").alias("cuts"))
    split = counted.groupBy("group").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("rows"), F.max("n").alias("top"), F.max("cuts").alias("blocks")
    )
    stray_cuts = F.ceil((F.col("rows") - F.col("top")) * F.col("blocks") / F.col("rows")).cast("int")
    split = stored(split.where("rows > top").select("group", "main", "blocks", F.greatest(stray_cuts, F.lit(1)).alias("stray_blocks")), f"{label}-split")
    if split.isEmpty():
        return known
    rows = several.join(split, "group")
    at = lambda n: F.pmod(F.xxhash64("node", F.lit(n)), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    strays = rows.where("component != main").select("group", at("stray_blocks").alias("i"), upto("blocks").alias("j"), F.lit(0).alias("side"), "node", "component")
    members = rows.select("group", upto("stray_blocks").alias("i"), at("blocks").alias("j"), F.lit(1).alias("side"), "node", "component")
    met = strays.unionAll(members).join(payloads.select("node", "payload"), "node")
    second = met.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side", "node").mapInArrow(across, EDGE)
    joined = stored(components(second, label).select(F.col("node").alias("part"), F.col("component").alias("whole")), f"{label}-joined")
    # A row that was alone in the first phase is a component of itself.
    alone = joined.join(known, joined["part"] == known["node"], "left_anti").select(F.col("part").alias("node"), F.col("whole").alias("component"))
    merged = known.join(joined, known["component"] == joined["part"], "left").select("node", F.coalesce("whole", "component").alias("component"))
    return stored(merged.unionAll(alone), f"{label}-known")
