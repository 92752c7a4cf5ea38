"""Sums over subtrees of a forest given as parent edges, by centroid decomposition.

A component is split at its centroid, the lowest node that holds at least half of its nodes. What lies below the centroid is summed up, and
that total is added to the nodes on the way from the centroid to the component's top, as it is new to each of them. The parts left, the one above
and those below the centroid, are components of half the size at most and are split in turn, so that a node gets at most a logarithm
of the forest's size of totals, however deep or bent the tree.

A forest of more than ``block`` nodes is first cut into components of less than that. Sizes of subtrees, which tell where the weight lies, come from doubling:
every node hands its count to an ancestor twice as far in each round. A node is a cut if its size passes a multiple of
``block`` that no child's passes; what hangs between cuts has less than ``block`` nodes, and there are at most some 2n/``block`` cuts. Components report their totals to the
cuts, the cuts are a smaller forest that is summed up in the same way, and their sums go into the components they hang from as weights.
Each component is then decomposed within one task, many small ones together.

Each node has one row, and a parent is a node or NULL. NULL weights count as 0. An empty forest has no sums; cycles raise.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage

BLOCK = 65_536


def _preorder(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each node in preorder, and the size of its subtree; a root has the parent -1."""
    n = len(parent)
    order = np.argsort(parent, kind="stable")
    begin = np.searchsorted(parent[order], np.arange(-1, n + 1)).tolist()
    order = order.tolist()
    place, size, seen = [0] * n, [1] * n, []
    waiting = order[begin[0]:begin[1]]
    while waiting:
        node = waiting.pop()
        place[node] = len(seen)
        seen.append(node)
        waiting.extend(order[begin[node + 1]:begin[node + 2]])
    if len(seen) < n:
        raise ValueError("the parent edges have a cycle")
    up = parent.tolist()
    for node in reversed(seen):
        if up[node] >= 0:
            size[up[node]] += size[node]
    return np.array(place, np.int64), np.array(size, np.int64)


def centroid_sums(parent: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sums over each node's subtree; ``weights`` has a row per node. All components are split at once, round by round."""
    n = len(parent)
    sums = np.zeros_like(weights)
    if not n:
        return sums
    place, whole = _preorder(parent)
    size = whole.copy()
    # A component is known by its top.
    roots = np.flatnonzero(parent < 0)
    roots = roots[np.argsort(place[roots])]
    top = roots[np.searchsorted(place[roots], place, "right") - 1]
    alive = np.arange(n)
    while len(alive):
        mine = top[alive]
        half = alive[2 * size[alive] >= size[mine]]
        # Those that hold half lie on one way down; the last of them is the centroid.
        centroid = np.full(n, -1)
        half = half[np.argsort(-size[half], kind="stable")]
        centroid[top[half]] = half
        at = centroid[mine]
        below = (place[at] <= place[alive]) & (place[alive] < place[at] + whole[at])
        under, under_at = alive[below], at[below]
        total = np.zeros_like(weights)
        np.add.at(total, under_at, weights[under])
        above = (place[alive] <= place[at]) & (place[at] < place[alive] + whole[alive])
        way, way_at = alive[above], at[above]
        sums[way] += total[way_at]
        removed = size[way_at]
        size[way] -= np.where(way == way_at, 0, removed)
        # Below a centroid each child is the top of a component.
        inside = under[under != under_at]
        children = inside[parent[inside] == centroid[top[inside]]]
        key = lambda nodes, of: of * n + place[nodes]
        children = children[np.argsort(key(children, top[children]))]
        fresh = children[np.searchsorted(key(children, top[children]), key(inside, top[inside]), "right") - 1] if len(children) else inside
        top[inside] = fresh
        alive = alive[alive != at]
    return sums


def _solve(forest: DataFrame, values: list[str], block: int) -> DataFrame:
    """``(node, values)`` summed up; ``forest`` has ``component``, ``node``, ``parent``, where a parent outside of the component counts as none."""
    schema = "node string, " + ", ".join(f"`{v}` long" for v in values)

    def sums_of(rows):
        rows = pd.concat(rows, ignore_index=True)
        ids = pd.Index(rows["node"])
        parent = ids.get_indexer(rows["parent"].where(rows["parent"].notna(), None))
        inside = parent >= 0
        component = rows["component"].to_numpy()
        inside[inside] = component[inside] == component[parent[inside]]
        found = centroid_sums(np.where(inside, parent, -1), rows[values].to_numpy(np.int64))
        return pd.concat([rows[["node"]], pd.DataFrame(found, columns=values)], axis=1)

    def run(frames):
        held, size = [], 0
        for frame in frames:
            component = frame["component"].to_numpy()
            # A batch may end inside a component: rows of the last one wait for the next batch.
            ends = np.flatnonzero(component[1:] != component[:-1]) + 1
            if held and len(frame) and held[-1]["component"].iloc[-1] != component[0]:
                ends = np.append(0, ends)
            start = 0
            for end in ends.tolist():
                if size + end - start >= block or (end == 0 and size >= block):
                    if end > start:
                        held.append(frame.iloc[start:end])
                    yield sums_of(held)
                    held, size, start = [], 0, end
            if start < len(frame):
                held.append(frame.iloc[start:])
                size += len(frame) - start
        if held:
            yield sums_of(held)

    return forest.repartition("component").sortWithinPartitions("component").mapInPandas(run, schema)


def subtree_sizes(forest: DataFrame) -> DataFrame:
    """``(node, parent, size)``: nodes in each subtree, in as many rounds as the logarithm of the depth."""
    state = forest.select("node", "parent", F.col("parent").alias("far"), F.lit(1).cast("long").alias("size"))
    rounds = 0
    while True:
        state = stage(state, "sizes")
        if state.filter(F.col("far").isNotNull()).isEmpty():
            return state.select("node", "parent", "size")
        if rounds > 62:
            raise ValueError("the parent edges have a cycle")
        rounds += 1
        going = state.filter(F.col("far").isNotNull())
        arrived = going.groupBy("far").agg(F.sum("size").alias("more")).withColumnRenamed("far", "node")
        jumps = going.select(F.col("node").alias("far"), F.col("far").alias("farther"))
        state = state.join(arrived, "node", "left").join(jumps, "far", "left").select(
            "node", "parent", F.col("farther").alias("far"), (F.col("size") + F.coalesce("more", F.lit(0))).alias("size"))


def _tops(forest: DataFrame) -> DataFrame:
    """``(node, parent, component)``: of nodes that are no cuts, the top of their component; a parent that is a cut has been made NULL."""
    state = forest.select("node", F.coalesce("parent", "node").alias("component"))
    while True:
        state = stage(state, "tops")
        jumps = state.select(F.col("node").alias("component"), F.col("component").alias("farther"))
        # A top's pointer is itself.
        joined = stage(state.join(jumps, "component").select("node", F.col("farther").alias("component"), (F.col("farther") != F.col("component")).alias("moved")), "tops")
        state = joined.select("node", "component")
        if joined.filter("moved").isEmpty():
            return state


def rollup(forest: DataFrame, values: list[str], block: int = BLOCK) -> DataFrame:
    """``(node, values)``: of ``forest(node, parent, values)`` the sums of whole subtrees."""
    weights = [F.coalesce(F.col(v).cast("long"), F.lit(0)).alias(v) for v in values]
    forest = stage(forest.select(F.col("node").cast("string"), F.col("parent").cast("string"), *weights), "forest")
    if forest.limit(block + 1).count() <= block:
        return _solve(forest.withColumn("component", F.lit("")), values, block)
    sized = subtree_sizes(forest)
    passed = F.floor(F.col("size") / block)
    of_children = sized.groupBy("parent").agg(F.max(passed).alias("child")).withColumnRenamed("parent", "node")
    cut = (passed >= 1) & (F.coalesce("child", F.lit(0)) < passed)
    marked = sized.join(of_children, "node", "left").select("node", cut.alias("cut"))
    marked = stage(forest.join(marked, "node"), "marked")
    cuts = marked.filter("cut").drop("cut")
    # A cut as parent ends a component.
    is_cut = cuts.select(F.col("node").alias("parent"), F.lit(True).alias("below_cut"))
    light = marked.filter(~F.col("cut")).drop("cut").join(is_cut, "parent", "left")
    tops = _tops(light.select("node", F.when(F.col("below_cut").isNull(), F.col("parent")).alias("parent")))
    light = stage(light.join(tops, "node"), "light")

    # Totals of components to the cut above them, and each cut's next cut above.
    hung = light.groupBy("component").agg(*[F.sum(v).alias(v) for v in values])
    above = light.filter(F.col("node") == F.col("component")).select("component", F.col("parent").alias("of"))
    totals = hung.join(above, "component").filter(F.col("of").isNotNull()).groupBy("of").agg(*[F.sum(v).alias(f"{v}_more") for v in values])
    to_top = light.select(F.col("node").alias("parent"), "component").join(above, "component").select("parent", F.lit(True).alias("in_component"), F.col("of").alias("next"))
    of_cuts = cuts.join(totals, F.col("node") == F.col("of"), "left").drop("of").join(to_top, "parent", "left")
    more = [(F.col(v) + F.coalesce(f"{v}_more", F.lit(0))).alias(v) for v in values]
    upper = of_cuts.select("node", F.when(F.col("in_component"), F.col("next")).otherwise(F.col("parent")).alias("parent"), *more)
    sums = stage(rollup(upper, values, block), "cuts")

    # The cuts' sums as weights of the nodes they hang from.
    from_cuts = cuts.select("node", "parent").join(sums, "node").filter(F.col("parent").isNotNull())
    from_cuts = from_cuts.groupBy("parent").agg(*[F.sum(v).alias(f"{v}_more") for v in values]).withColumnRenamed("parent", "node")
    return _solve(light.join(from_cuts, "node", "left").select("component", "node", "parent", *more), values, block).unionByName(sums)
