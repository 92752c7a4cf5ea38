"""MinHash near-duplicates by an inverted join on signature coordinates.

Texts have A-Z lower-cased and are split at ASCII white space; a document's set holds the distinct shingles of
``words`` words (all its words as one shingle if it has fewer). Documents are linked when
``den * |A and B| >= num * |A or B|``, confirmed on full sets.

1. Documents with equal sets form a class; its smallest id stands for it from here on.
2. A representative gets ``POSTED`` min-hash coordinates for the join and ``CHECKED`` one-byte ones for counting.
3. It is posted under its coordinate-value pairs, rarest first. Two signatures with at least T equal coordinates
   share one of the first ``POSTED - T + 1`` in that order (prefix); values that nobody else has can't be shared,
   and a signature with fewer than T others is skipped.
4. In each posting list all members meet the most central one, whose values are shared most; pairs with enough equal coordinates are confirmed.
   Then, in lists that still hold several components, every member outside its component meets all
   members, block by block: blocks are of bounded size, and only links are emitted, after full sets have confirmed them,
   each from the first list that both are in. So a group of copies costs one comparison per copy and list, and no link is lost.

T lies 4.5 standard deviations below the matches expected at the threshold, so about one link in 10^5 at the very
threshold is missed, next to none above it.

Null texts and texts without words have an empty set and are linked with nothing. Null ids are linked with nothing and
kept. Rows repeated under one id are one document, which stays or goes. Ties do not arise, the smallest id stands for a group.
An empty table gives an empty result. Only the id and text columns are read.
"""

from math import floor, sqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .common import release
from .components import components

POSTED = 32
CHECKED = 256
BLOCK = 256
_random = np.random.default_rng(42)
_FACTORS = _random.integers(0, 1 << 32, CHECKED, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _random.integers(0, 1 << 32, CHECKED, dtype=np.uint32)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(hashes))
    mixed = hashes[:len(hashes) - width + 1].copy()
    for k in range(1, width):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[0] + hashes[k:len(hashes) - width + 1 + k]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX[1]
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of every coordinate's hash over a set that is not empty."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    best = np.full(CHECKED, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 1024):
        part = (low[start:start + 1024, None] ^ _OFFSETS) * _FACTORS
        np.minimum(best, (part ^ (part >> np.uint32(15))).min(axis=0), out=best)
    return best


def matches_needed(coordinates: int, num: int, den: int) -> int:
    j = num / den
    return max(1, floor(coordinates * j - 4.5 * sqrt(coordinates * j * (1 - j))))


def _signatures(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    def sign(frames):
        for frame in frames:
            out = []
            for doc, content in zip(frame["doc"], frame["content"]):
                found = shingle_set(content, words)
                if not len(found):
                    out.append((doc, 0, None, None, None))
                    continue
                values = signature(found)
                tags = (values.astype(np.uint64) + (np.arange(CHECKED, dtype=np.uint64) << np.uint64(32))) * _MIX[0]
                out.append((doc, len(found), xxhash.xxh3_128_digest(found.tobytes()), tags[:POSTED].view(np.int64), (tags >> np.uint64(56)).astype(np.uint8).tobytes()))
            yield pd.DataFrame(out, columns=["doc", "n", "print", "posted", "checked"]).astype({"doc": "Int64"})

    rows = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("content"))
    return rows.mapInPandas(sign, "doc long, n long, print binary, posted array<long>, checked binary")


def _postings(reps: DataFrame, needed: int) -> DataFrame:
    """``(doc, prefix, central)``: the prefix of each signature, rarest values first, and how widely it is shared."""
    tokens = reps.select("doc", F.explode("posted").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = tokens.join(shared, "token").groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("found"))
    central = F.aggregate("found", F.lit(0).cast("long"), lambda total, x: total + x["df"])
    return ranked.filter(F.size("found") >= needed).select("doc", F.slice("found", 1, F.size("found") - needed + 1)["token"].alias("prefix"), central.alias("central"))


def _equal(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left[:, None, :] == right[None, :, :]).sum(axis=2)


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are alike enough."""
    texts = texts.hint("shuffle_merge")  # the same plan at every size

    def confirm(frames):
        last, held = None, None
        for frame in frames:
            good = []
            for a, b, left, right in zip(frame["a"], frame["b"], frame["left"], frame["right"]):
                if b != last:
                    last, held = b, shingle_set(right, words)
                mine = shingle_set(left, words)
                common = len(np.intersect1d(mine, held, assume_unique=True))
                good.append(den * common >= num * (len(mine) + len(held) - common))
            yield frame.loc[good, ["a", "b"]]

    with_left = pairs.join(texts.select(F.col("doc").alias("a"), F.col("content").alias("left")), "a")
    with_both = with_left.join(texts.select(F.col("doc").alias("b"), F.col("content").alias("right")), "b")
    return with_both.select("a", "b", "left", "right").mapInPandas(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for every row of ``docs``."""
    posted_needed, checked_needed = matches_needed(POSTED, num, den), matches_needed(CHECKED, num, den)
    signed = stage(_signatures(docs, key, text, words), "signatures")
    linked = signed.filter("n > 0 and doc is not null")
    release(docs.sparkSession)
    classes = stage(linked.groupBy("print").agg(F.min("doc").alias("rep"), F.count("*").alias("members")).filter("members > 1"), "classes")
    copies = linked.select("doc", "print").join(classes, "print").filter("doc != rep").select("doc", "rep").distinct()
    reps = stage(linked.join(classes.select("print", "rep"), "print", "left").filter("rep is null or rep = doc").dropDuplicates(["doc"]).select("doc", "n", "posted", "checked"), "representatives")

    release(docs.sparkSession)
    prefixes = stage(_postings(reps, posted_needed), "prefixes")
    postings = prefixes.select("doc", F.explode("prefix").alias("token"), "central")
    middle = F.max_by("doc", F.struct("central", -F.col("doc")))
    lists = stage(postings.groupBy("token").agg(middle.alias("first"), F.count("*").alias("members")).filter("members > 1"), "lists")
    postings = stage(postings.drop("central").join(lists, "token"), "postings")
    release(docs.sparkSession)
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("content"))
    texts = stage(texts.join(postings.select("doc").distinct().hint("shuffle_hash"), "doc", "left_semi").dropDuplicates(["doc"]), "texts")

    release(docs.sparkSession)

    # Every member of a list meets its most central one.
    pairs = postings.filter("doc != first").select(F.col("doc").alias("a"), F.col("first").alias("b")).distinct()
    marks = reps.select("doc", "n", "checked")

    def enough(frames):
        for frame in frames:
            left = np.frombuffer(b"".join(frame["left"]), np.uint8).reshape(-1, CHECKED)
            right = np.frombuffer(b"".join(frame["right"]), np.uint8).reshape(-1, CHECKED)
            yield frame.loc[(left == right).sum(axis=1) >= checked_needed, ["a", "b"]]

    signed_pairs = (
        pairs.join(marks.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("checked").alias("left")), "a")
        .join(marks.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("checked").alias("right")), "b")
        .filter(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
        .select("a", "b", "left", "right")
    )
    pairs = stage(signed_pairs.mapInPandas(enough, "a long, b long"), "pairs")
    release(docs.sparkSession)
    stars = stage(_confirm(pairs, texts, words, num, den), "links")
    release(docs.sparkSession)
    found = components(stars)

    # In lists with several components, members outside the central one's component meet all.
    placed = postings.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    placed = placed.join(found.select(F.col("node").alias("first"), F.col("component").alias("main")), "first", "left").withColumn("main", F.coalesce("main", "first"))
    outside = placed.filter("component != main").groupBy("token").agg(F.count("*").alias("others"))
    mixed = placed.join(outside, "token").join(marks, "doc").join(prefixes.select("doc", "prefix"), "doc").join(texts.hint("shuffle_merge"), "doc")
    blocks, groups = F.ceil(F.col("members") / BLOCK).cast("int"), F.ceil(F.col("others") / BLOCK).cast("int")
    spot = F.xxhash64("doc")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    shown = ["token", "doc", "component", "main", "n", "checked", "prefix", "content"]
    asking = mixed.filter("component != main").select(*shown, F.lit(True).alias("asks"), F.pmod(spot, groups).cast("int").alias("g"), F.explode(every(blocks)).alias("k"))
    asked = mixed.select(*shown, F.lit(False).alias("asks"), F.pmod(spot, blocks).cast("int").alias("k"), F.explode(every(groups)).alias("g")).select(asking.columns)

    def meet(rows):
        """The links of one block, from rows of one token and block; sets are made for signatures that match."""
        ask, told = [r for r in rows if r[4]], [r for r in rows if not r[4]]
        if not ask or not told:
            return
        equal = _equal(np.frombuffer(b"".join(r[3] for r in ask), np.uint8).reshape(-1, CHECKED), np.frombuffer(b"".join(r[3] for r in told), np.uint8).reshape(-1, CHECKED))
        sets: dict[int, np.ndarray] = {}
        for i, j in zip(*np.nonzero(equal >= checked_needed)):
            x, y = ask[i], told[j]
            if x[1] == y[1] or (y[5] and x[0] <= y[0]):
                continue
            if den * min(x[2], y[2]) < num * max(x[2], y[2]) or min(set(x[6]) & set(y[6])) != x[7]:
                continue
            for row in (x, y):
                if row[0] not in sets:
                    sets[row[0]] = shingle_set(row[8], words)
            common = len(np.intersect1d(sets[x[0]], sets[y[0]], assume_unique=True))
            if den * common >= num * (x[2] + y[2] - common):
                yield max(x[0], y[0]), min(x[0], y[0])

    def meet_all(frames):
        spot, rows = None, []
        for frame in frames:
            out = []
            for t, k, g, doc, component, main, n, checked, asks, prefix, content in zip(*(frame[c] for c in ("token", "k", "g", "doc", "component", "main", "n", "checked", "asks", "prefix", "content"))):
                if (t, k, g) != spot:
                    out += meet(rows)
                    spot, rows = (t, k, g), []
                rows.append((doc, component, n, checked, asks, component != main, prefix, t, content))
            yield pd.DataFrame(out, columns=["a", "b"])
        yield pd.DataFrame(list(meet(rows)), columns=["a", "b"])

    met = asking.union(asked).repartition("token", "k", "g").sortWithinPartitions("token", "k", "g")
    more = stage(met.mapInPandas(meet_all, "a long, b long"), "links")
    release(docs.sparkSession)
    final = found if more.isEmpty() else components(stars.union(more))

    whole = signed.select("doc", "n").join(copies, "doc", "left").withColumn("rep", F.coalesce("rep", "doc"))
    whole = whole.join(final.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component_id", F.coalesce("component", "rep"))
    kept = F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True))
    return whole.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of every group, the one with the smallest id, with its columns as they are."""
    gone = near_duplicates(docs, key, text, words, num, den).filter("not kept").select(key).distinct()
    return docs.join(gone, key, "left_anti")
