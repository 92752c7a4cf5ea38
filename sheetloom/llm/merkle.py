"""Merkle manifest of a table: a tree of hashes per group, one over the groups, and versions of it with changed leaves.

Every row is a leaf. Within a group leaves stand in the order of the key, and every two neighbouring nodes become one until one is
left, the group's root; the groups' roots, in the order of their names, become the root of the table in the same way.

Trees are built in aligned blocks of ``2 ** HEIGHT`` neighbours. A block is a persistent tree in one task: a changed leaf makes
a new version that shares every node with the first one, except its ancestors in the block, which are copied. The blocks' tops
are the leaves of the next tree up, which is built in the same way, so a task never holds more than a block. A version goes on from its
block's top through the siblings of the blocks above, which are few and joined to it: there versions are rows that Spark spreads, not nodes
in one task. A node without a neighbour is hashed alone and its missing sibling is an empty text, which changes no hash.

NULL values count as ``-`` and are told from any text; NULL groups are a group of their own and come first, as do NULL keys in
it. Rows with one key are ordered by their leaf; equal rows are leaves each. Whole texts are hashed where they are read and only hashes are
shuffled. A changed value that overflows is NULL. An empty table has no rows here. Only the named columns are read; others, whatever their names, play no part.
"""

import hashlib
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..staging import stage

HEIGHT = 10  # levels of a block
ROWS_A_TASK = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class PersistentTree:
    """Nodes are never changed: a version is a root, and a new one shares the nodes that it does not copy."""

    def __init__(self, leaves: list[str], height: int):
        self.height = height
        self.hashes, self.left, self.right = list(leaves), [-1] * len(leaves), [-1] * len(leaves)
        level = list(range(len(leaves)))
        for _ in range(height):
            level = [self._node(level[i], level[i + 1] if i + 1 < len(level) else -1) for i in range(0, len(level), 2)]
        (self.root,) = level

    def _add(self, hashed: str, left: int, right: int) -> int:
        self.hashes.append(hashed)
        self.left.append(left)
        self.right.append(right)
        return len(self.hashes) - 1

    def _node(self, left: int, right: int) -> int:
        return self._add(digest(self.hashes[left], self.hashes[right] if right >= 0 else ""), left, right)

    def way(self, root: int, at: int) -> list[int]:
        """The nodes from a version's root down to a leaf."""
        nodes = [root]
        for k in reversed(range(self.height)):
            nodes.append((self.right if at >> k & 1 else self.left)[nodes[-1]])
        return nodes

    def siblings(self, root: int, at: int) -> list[str]:
        """From the leaf up; an empty text where there is none."""
        found = []
        for k, node in enumerate(reversed(self.way(root, at)[:-1])):
            other = (self.left if at >> k & 1 else self.right)[node]
            found.append(self.hashes[other] if other >= 0 else "")
        return found

    def with_leaf(self, root: int, at: int, leaf: str) -> int:
        """The root of a version that has ``leaf`` at its place."""
        fresh = self._add(leaf, -1, -1)
        for k, node in enumerate(reversed(self.way(root, at)[:-1])):
            fresh = self._node(self.left[node], fresh) if at >> k & 1 else self._node(fresh, self.right[node])
        return fresh


def fold(leaf: str, at: int, siblings: list[str]) -> str:
    """The top that a leaf and the siblings on its way lead to."""
    for k, other in enumerate(siblings):
        leaf = digest(other, leaf) if at >> k & 1 else digest(leaf, other)
    return leaf


def folded(hashed: str, at: str, siblings: str) -> Column:
    """As ``fold``, on columns."""
    return F.expr(
        f"aggregate(transform({siblings}, (s, k) -> struct(s, shiftright({at}, k) & 1 as odd)), {hashed},"
        " (h, x) -> sha2(if(x.odd = 1, concat(x.s, h), concat(h, x.s)), 256))"
    )


def leaf_hash(fields: tuple[str, ...], changes: dict[str, Column] | None = None) -> Column:
    """A row's leaf: every value with its length in bytes before it."""
    def part(name):
        value = (changes or {}).get(name, F.col(f"`{name}`")).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def _blocks(nodes: DataFrame, tasks: int, height: int) -> DataFrame:
    """``nodes(tree, at, n, hash, changed, ...)`` with, inside its block, each node's siblings, the block's top, the top of the node's version, and
    how many nodes that version copied. ``n`` is the number of nodes of the tree at this level."""
    width = 1 << height
    keep = [f for f in nodes.schema.fields if f.name not in ("hash", "changed")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", hash string, siblings array<string>, top string, version string, copied long"

    def run(frames):
        def rows():
            for frame in frames:
                yield from frame.itertuples(index=False)

        for _, members in groupby(rows(), key=lambda r: (r.tree, r.at // width)):
            members = list(members)
            tree = PersistentTree([r.hash for r in members], min(height, (members[0].n - 1).bit_length()))
            top, out = tree.hashes[tree.root], []
            for place, r in enumerate(members):
                siblings, before = tree.siblings(tree.root, place), len(tree.hashes)
                version = fold(r.hash, place, siblings) if r.changed is None else tree.hashes[tree.with_leaf(tree.root, place, r.changed)]
                out.append((*[getattr(r, f.name) for f in keep], r.hash, siblings, top, version, len(tree.hashes) - before))
            yield pd.DataFrame(out, columns=[*[f.name for f in keep], "hash", "siblings", "top", "version", "copied"]).astype({f.name: "Int64" for f in keep if f.dataType.simpleString() == "bigint"})

    placed = nodes.repartition(tasks, "tree", F.floor(F.col("at") / width)).sortWithinPartitions("tree", "at")
    return placed.mapInPandas(run, schema)


def _ways(nodes: DataFrame, most: int, total: int, height: int) -> DataFrame:
    """``(tree, at, siblings, top)``: for each of the ``nodes(tree, at, n, hash)`` its siblings up to the top of its tree, and that top."""
    width = 1 << height
    found = _blocks(nodes.withColumn("changed", F.lit(None).cast("string")), max(1, total // ROWS_A_TASK), height)
    if most <= width:
        return found.select("tree", "at", "siblings", "top")
    found = stage(found, "merkle")
    above = _ways(_tops(found, width), -(-most // width), -(-total // width), height)
    return _joined(found, above, width).select("tree", "at", F.concat("siblings", "above").alias("siblings"), F.col("root").alias("top"))


def _tops(found: DataFrame, width: int) -> DataFrame:
    at, n = (F.floor(c).cast("long") for c in (F.col("at") / width, (F.col("n") + (width - 1)) / width))
    return found.filter(F.col("at") % width == 0).select("tree", at.alias("at"), n.alias("n"), F.col("top").alias("hash"))


def _joined(found: DataFrame, above: DataFrame, width: int) -> DataFrame:
    """Each row with the way of its block: ``block``, ``above``, ``root``. A block meets no more than its own rows."""
    ways = above.select("tree", F.col("at").alias("block"), F.col("siblings").alias("above"), F.col("top").alias("root"))
    return found.withColumn("block", F.floor(F.col("at") / width).cast("long")).join(ways, ["tree", "block"])


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    where: Column | None = None,
    changes: dict[str, Column] | None = None,
    height: int = HEIGHT,
) -> DataFrame:
    """``(key, group, leaf, subroot, root, proof, folded_root, copied)`` for every row.

    ``proof`` holds the siblings from the leaf up to the root. Rows ``where`` something holds make a version of the tree in which their columns have
    been changed; ``folded_root`` is that version's root, for other rows what their leaf and their siblings lead to, and ``copied`` the number of
    nodes that the version does not share inside its block.
    """
    width = 1 << height
    tampered = F.when(where, leaf_hash(fields, changes)) if where is not None else F.lit(None).cast("string")
    name = F.col(f"`{group}`").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("tree"), F.col(f"`{key}`").alias("key"),
        leaf_hash(fields).alias("hash"), tampered.alias("changed"), F.monotonically_increasing_id().alias("read"),
    )
    # Where rows were read only parts copies, which a range would else hold together.
    numbered = stage(number_rows(rows, ["tree", "key", "hash", "read"], "number").drop("read"), "leaves")
    trees = stage(numbered.groupBy("tree").agg(F.min("number").alias("first"), F.count("*").alias("n")), "trees")
    total, most, n_trees = trees.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    nodes = numbered.join(trees, "tree").select("tree", (F.col("number") - F.col("first")).alias("at"), "n", "key", "hash", "changed")
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // ROWS_A_TASK)
    found = stage(_blocks(nodes, tasks, height), "merkle")
    above = stage(_ways(_tops(found, width), max(1, -(-most // width)), max(1, -(-total // width)), height), "ways")

    # The tree over the groups, whose leaves are their roots.
    subroots = above.filter(F.col("at") == 0).select("tree", F.col("top").alias("hash"))
    ordered = number_rows(subroots, ["tree"], "at", F.lit(-1)).select(F.lit("").alias("tree"), "at", F.lit(n_trees).alias("n"), "hash", F.col("tree").alias("of"))
    ordered = stage(ordered, "subroots")
    last = _ways(ordered.drop("of"), n_trees, n_trees, height).join(ordered.select("at", "of"), "at")
    last = stage(last.select(F.col("of").alias("tree"), F.col("at").alias("place"), F.col("siblings").alias("last"), F.col("top").alias("total")), "subroots")

    whole = _joined(found, above, width).join(last, "tree")
    whole = whole.withColumn("to_group", folded("version", "block", "above")).withColumn("folded_root", folded("to_group", "place", "last"))
    return whole.select(
        F.col("key").alias(key),
        F.when(F.col("tree") != "-", F.substring("tree", 2, 1 << 30)).alias(group),
        F.col("hash").alias("leaf"),
        F.col("root").alias("subroot"),
        F.col("total").alias("root"),
        F.filter(F.concat("siblings", "above", "last"), lambda s: s != "").alias("proof"),
        "folded_root",
        "copied",
    )
