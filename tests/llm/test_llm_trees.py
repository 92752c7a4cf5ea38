"""Hash trees, subtree sums and the prefix trie against plain versions."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetloom.llm import merkle, prefix_trie
from sheetloom.llm.rollup import centroid_sums, rollup

# --- subtree sums


def plain_sums(parent, weights):
    sums = weights.copy()
    for v in range(len(parent)):
        p = parent[v]
        while p >= 0:
            sums[p] += weights[v]
            p = parent[p]
    return sums


def forest_of(back, shuffle):
    """Node i hangs back[i] nodes before it, 0 for a root, under shuffled names."""
    names = np.random.default_rng(shuffle).permutation(len(back))
    parent = np.full(len(back), -1)
    for i, b in enumerate(back):
        if b and i:
            parent[names[i]] = names[max(0, i - b)]
    return parent


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=60), st.integers(0, 9))
def test_centroid_sums(back, seed):
    parent = forest_of(back, seed)
    weights = np.random.default_rng(seed).integers(-5, 9, (len(back), 2))
    assert (centroid_sums(parent, weights) == plain_sums(parent, weights)).all()


@pytest.mark.parametrize("far, block", [(1, 40), (40, 30), (400, 23)])
def test_rollup_in_blocks(spark, far, block):
    rng = np.random.default_rng(far)
    parent = np.array([-1] + [max(0, i - int(rng.integers(1, far + 1))) if i % 97 else -1 for i in range(1, 400)])
    weights = rng.integers(0, 9, (400, 1))
    rows = [(f"n{i}", f"n{p}" if p >= 0 else None, int(w[0]) or None) for i, (p, w) in enumerate(zip(parent, weights))]
    got = rollup(spark.createDataFrame(rows, "node string, parent string, w long"), ["w"], block).collect()
    expected = plain_sums(parent, weights)
    assert len(got) == 400 and {r["node"]: r["w"] for r in got} == {f"n{i}": int(expected[i, 0]) for i in range(400)}


def test_rollup_star_empty_and_cycle(spark):
    star = [("top", None, 1)] + [(f"leaf{i}", "top", 1) for i in range(300)]
    schema = "node string, parent string, w long"
    got = {r["node"]: r["w"] for r in rollup(spark.createDataFrame(star, schema), ["w"], 50).collect()}
    assert got["top"] == 301 and got["leaf7"] == 1
    assert rollup(spark.createDataFrame([], schema), ["w"]).count() == 0
    with pytest.raises(Exception, match="cycle"):
        rollup(spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], schema), ["w"]).collect()


# --- the trie


def plain_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members = {}
    for c, said in built.items():
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        saved = sum((len(members[q]) - 1) * len([w for w in q[-1][1].replace("\t", " ").replace("\n", " ").split(" ") if w]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(cs) if built[c] == p)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), sum(q not in children for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("block, chunk", [(65536, 4096), (7, 2)])
def test_trie_against_plain(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(prefix_trie, "IDS_A_CHUNK", chunk)
    rng = np.random.default_rng(block)
    rows = [(int(c), int(t), "user" if t % 2 == 0 else "assistant", ["a b", "c\td e", "", "f"][int(rng.integers(0, 2 + c % 3))]) for c in range(0, 70) if c % 20 or c < 40 for t in range(int(rng.integers(1, 6)))]
    rows += [(3, None, None, None), (3, None, "user", "late"), (3, 9, "user", None), (3, 9, "user", None), (None, 1, "user", "nobody"), (45, 1, "x", "same"), (45, 1, "x", "same")]
    rows += [(c, t, "user", "long") for c in (90, 91) for t in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("clash")).repartition(5)
    got = prefix_trie.rebuilt_trie(df, block=block)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_trie(rows)


def test_trie_empty(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], SCHEMA)).count() == 0


# --- hash trees


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.data())
def test_versions_share_what_is_not_on_the_way(n, data):
    leaves = [h(str(i)) for i in range(n)]
    tree = merkle.PersistentTree(leaves, (n - 1).bit_length())
    assert tree.hashes[tree.root] == levels_of(leaves)[-1][0]
    root, now = tree.root, list(leaves)
    for _ in range(4):
        at, before = data.draw(st.integers(0, n - 1)), len(tree.hashes)
        now[at] = h("new", now[at])
        root = tree.with_leaf(root, at, now[at])
        assert len(tree.hashes) - before == tree.height + 1
        assert tree.hashes[root] == levels_of(now)[-1][0] == merkle.fold(now[at], at, tree.siblings(root, at))
    assert tree.hashes[tree.root] == levels_of(leaves)[-1][0]  # the first version is as it was


def plain_manifest(rows):
    def leaf(r):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    parts = {}
    for g in order:
        parts[g] = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: levels_of([leaf(r) for r in parts[g]]) for g in order}
    upper = levels_of([trees[g][-1][0] for g in order])
    root, out = upper[-1][0], []
    for k, g in enumerate(order):
        for i, r in enumerate(parts[g]):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node, proof = leaf((*r[:3], r[3] + 1, r[4]) if bad else r), ""
            for levels, at in ((trees[g], i), (upper, k)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    node, proof, at = h(other, node) if at % 2 else h(node, other), proof + other, at // 2
            out.append((r[0], leaf(r), trees[g][-1][0], root, h(proof), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 3, 10])
def test_manifest_against_plain(spark, height):
    rows = [(i, "web", ["en", "de", "fr"][min(i % 5, 2)], i * 7, f"text {i} é") for i in range(75)]
    rows += [(100, None, None, None, None), (101, "a", None, 5, ""), (102, "s", "zz", 1, "lone"), (103, "s", "", 1, "no name"), (None, "s", "de", 4, "no key"), (5, "x", "en", 35, "same key"), (5, "x", "en", 35, "same key")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({"tree": F.lit(1), "at": F.lit("clash"), "hash": F.lit(0.5)})
    bad = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(df.repartition(3), where=bad, changes={"n_chars": F.col("n_chars") + 1}, height=height)
    got = got.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows)
    assert any(not r[-1] for r in plain_manifest(rows))


def test_manifest_empty_and_single(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0
    (only,) = merkle.manifest(spark.createDataFrame([(1, "s", "en", 2, "ab")], schema)).collect()
    assert only["leaf"] == only["subroot"] == only["root"] == only["folded_root"] and only["proof"] == []
