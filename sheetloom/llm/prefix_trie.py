"""The trie of conversation prefixes: which conversations begin alike, and what sharing the beginnings saves.

A node stands for a distinct sequence of first turns; its parent lacks the last of them. Turns are put in order by ranges that Spark
sorts, with rows of one conversation in as many tasks as they fill, and a turn's number comes from the sizes of the ranges before it. A prefix is
known by two 64-bit hashes, each the exclusive or of a hash per turn and its number, so that it too can be
put together from parts. Nodes are groups of equal prefixes, named by their smallest member, and their parents are found by the hash
without the last turn. Sums over subtrees come from ``rollup``, by centroid decomposition of these parent edges.

NULL roles and texts are empty. Within a conversation turns stand by number (NULL first), then role, then text; a turn that is there twice counts twice. Rows without a
conversation's id belong to none. A text counts its words, runs of anything but blanks. An empty table has no nodes. Only the four named columns are read.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .rollup import BLOCK, rollup

PERIOD, HEADS = 20, 4
WORD = r"[^\x20\x09-\x0D]+"
IDS_A_CHUNK = 4096
NONE = hashlib.sha256(b"").hexdigest()


def ordered_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(conv, number, part, x, y, words)`` for every turn, numbered through the whole table, and ``(conv, first, n)`` for every conversation."""
    named = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("read"),  # parts copies that a range would else hold together
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "read"]
    placed = stage(named.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.xxhash64(F.lit(1), "role", "text").alias("x"), F.xxhash64(F.lit(2), "role", "text").alias("y"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"),
    ), "turns")
    # One row per range.
    sizes = placed.groupBy("part").agg(F.count("*").alias("rows"), F.min("place").alias("start"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("start")).alias("offset"))
    turns = placed.join(F.broadcast(offsets), "part").select("conv", (F.col("place") + F.col("offset")).alias("number"), "part", "x", "y", "words")
    convs = turns.groupBy("conv").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    return turns, stage(convs, "convs")


def _turn_hashes() -> list[Column]:
    return [F.xxhash64(F.lit(k), "pos", "x", "y").alias(f"g{k}") for k in (1, 2)]


def grafted(turns: DataFrame, convs: DataFrame, donor: Column, heads: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first ``heads`` turns of a donor, then go on with their own turns after as many.

    Turns as ``(conv, pos, part, g1, g2, words)``, and ``(conv, length)`` for every conversation. ``heads`` is small; a shorter donor gives
    all its turns, an absent one none.
    """
    plan = convs.select("conv", "first", "n", donor.alias("donor"), heads.cast("long").alias("heads"))
    has = convs.select(F.col("conv").alias("donor"), F.col("n").alias("has"))
    plan = plan.join(has, "donor", "left").withColumn("given", F.least("heads", F.coalesce("has", F.lit(0))))
    plan = stage(plan.withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("heads"), F.lit(0))), "grafts")
    ranked = turns.join(plan, "conv").withColumn("rank", F.col("number") - F.col("first"))
    own = ranked.filter(F.col("rank") >= F.col("heads")).select("conv", (F.col("given") + F.col("rank") - F.col("heads")).alias("pos"), "part", "x", "y", "words")
    most = plan.agg(F.coalesce(F.max("heads"), F.lit(0))).scalar()
    front = ranked.filter(F.col("rank") < most).select(F.col("conv").alias("donor"), F.col("rank").alias("pos"), F.lit(-1).alias("part"), "x", "y", "words")
    front = front.join(plan.select("conv", "donor", "heads"), "donor").filter(F.col("pos") < F.col("heads"))
    whole = own.unionByName(front.select(own.columns)).select("conv", "pos", "part", *_turn_hashes(), "words")
    return whole, plan.select("conv", "length")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(conv, depth, k1, k2, p1, p2, words, is_end)``: every prefix of every conversation, from the empty one on, known by ``k1, k2``, its parent by ``p1, p2``."""
    turns = stage(turns, "grafted")
    within = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    # A conversation has as many parts as ranges that it reaches into.
    parts = turns.groupBy("conv", "part").agg(F.bit_xor("g1").alias("o1"), F.bit_xor("g2").alias("o2"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv", "part", *[F.coalesce(F.bit_xor(o).over(earlier), F.lit(0)).alias(o) for o in ("o1", "o2")])
    keyed = turns.withColumns({f"r{k}": F.bit_xor(f"g{k}").over(within) for k in (1, 2)}).join(parts, ["conv", "part"])
    k1, k2 = (F.col(f"r{k}").bitwiseXOR(F.col(f"o{k}")) for k in (1, 2))
    steps = keyed.select("conv", (F.col("pos") + 1).alias("depth"), k1.alias("k1"), k2.alias("k2"), k1.bitwiseXOR(F.col("g1")).alias("p1"), k2.bitwiseXOR(F.col("g2")).alias("p2"), "words")
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv", zero.alias("depth"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "words")])
    return steps.unionByName(roots).join(lengths, "conv").withColumn("is_end", F.col("depth") == F.col("length")).drop("length")


def digest_of_ids(members: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)``: of ``members(conv_id, depth, conv)`` the SHA-256 of each node's ids, ascending and joined by commas.

    Ids are sorted by ranges and joined in chunks, many tasks to a node; a node's chunks then pass, in order, through one running hash.
    """
    def chunks(frames):
        for frame in frames:
            conv_id, depth, ids = frame["conv_id"].to_numpy(), frame["depth"].to_numpy(), frame["conv"].to_numpy()
            same = (conv_id[1:] == conv_id[:-1]) & (depth[1:] == depth[:-1])
            starts = np.append(0, np.flatnonzero(~same) + 1) if len(ids) else np.empty(0, np.int64)
            cuts = [c for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(ids)]) for c in range(a, b, IDS_A_CHUNK)]
            spelled = list(map(str, ids.tolist()))
            joined = [",".join(spelled[a:b]) for a, b in zip(cuts, [*cuts[1:], len(ids)])]
            yield pd.DataFrame({"conv_id": conv_id[cuts], "depth": depth[cuts], "first": ids[cuts], "ids": joined})

    def hashes(frames):
        node, running = None, None
        for frame in frames:
            out = []
            for conv_id, depth, ids in zip(frame["conv_id"], frame["depth"], frame["ids"]):
                if (conv_id, depth) == node:
                    running.update(b",")
                else:
                    if node:
                        out.append((*node, running.hexdigest()))
                    node, running = (conv_id, depth), hashlib.sha256()
                running.update(ids.encode())
            yield pd.DataFrame(out, columns=["conv_id", "depth", "ends_sha256"])
        if node:
            yield pd.DataFrame([(*node, running.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])

    order = ["conv_id", "depth", "conv"]
    joined = members.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(chunks, "conv_id long, depth long, first long, ids string")
    by_node = joined.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return by_node.mapInPandas(hashes, "conv_id long, depth long, ends_sha256 string")


def trie(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    steps = stage(steps, "steps")
    nodes = steps.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    nodes = stage(nodes, "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    # Each node meets one parent; a parent of many is a hot key on the left, which adaptive execution splits.
    placed = nodes.join(above, ["depth", "p1", "p2"], "left")
    children = placed.filter(F.col("depth") > 0).groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    known = placed.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    named = lambda conv, depth: F.concat_ws(":", F.col(conv).cast("string"), depth.cast("string"))
    known = known.withColumn("node", named("conv_id", F.col("depth")))
    known = stage(known.withColumn("parent", F.when(F.col("depth") > 0, named("parent_conv_id", F.col("depth") - 1))), "known")
    leaf, saved = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("words")
    sums = rollup(known.select("node", "parent", leaf.alias("n_leaves"), saved.alias("saved_tokens")), ["n_leaves", "saved_tokens"], block)
    ends = steps.filter("is_end").join(nodes.select("depth", "k1", "k2", "conv_id"), ["depth", "k1", "k2"])
    digests = digest_of_ids(ends.select("conv_id", "depth", "conv"))
    return known.join(sums, "node").join(digests, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, period: int = PERIOD, heads: int = HEADS, block: int = BLOCK) -> DataFrame:
    """The trie of conversations that take up to ``heads - 1`` first turns, by the CRC-32 of their id, from the one whose id is the multiple of ``period`` below."""
    turns, convs = ordered_turns(conversations)
    donor = F.col("conv") - F.col("conv") % period
    turns, lengths = grafted(turns, convs, donor, F.crc32(F.col("conv").cast("string").cast("binary")) % heads)
    return trie(prefixes(turns, lengths), block)
