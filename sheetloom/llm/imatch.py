"""I-Match fingerprints with randomised lexicon subsets.

A text's terms are its distinct lower-cased words whose inverse document frequency lies in a band: neither so frequent
that all documents have them nor so rare that one slip of the pen changes the set. Lexicon subsets are fixed once for all texts: the
whole band, and ``SUBSETS`` random ones with a half of its terms, as many with a quarter of those, and so on down to 2^-``RATES``. A fingerprint
has, for every subset that the text meets, a hash of the text's sorted terms in it. Large subsets tell short texts apart, small ones are
those that an edit of a long text can leave alone. The likeness of two fingerprints is the share of equal hashes among the
subsets of one size that meet either text, at the size where it is greatest, of the sizes at which half of the subsets meet either
(over all subsets if there is no such size).

Document frequencies cover all documents; terms are hashed into ``2^BITS`` buckets. The band is
relative to the number of documents, so it means the same at every size.

A text without terms in the band meets no subset; it has a hash of all its terms, or of itself if it has none, and is
like its equals only. Null is an empty text, with an empty fingerprint. Equal texts have equal fingerprints; equal
fingerprints, empty ones too, have likeness 1. An empty table gives an empty result; only id and text columns are read.
"""

import hashlib
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import count_buckets

BITS = 20
BAND = (0.0005, 0.05)  # shares of all documents: inverse document frequencies from log 20 to log 2000
SUBSETS = 16  # of each size
RATES = 20  # as many as the lexicon's buckets have bits: the smallest subsets hold a term or so
CHARS_PER_PART = 16_000_000
_WORD = re.compile(r"\w+")
_DIGITS = 6  # of a subset's hash
_UNMET = "-" * _DIGITS
_KEPT = 200_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALTS = np.random.default_rng(3).integers(1, 1 << 63, SUBSETS, dtype=np.uint64) | np.uint64(1)


class TermHashes(dict):
    """64-bit hashes of terms; those met lately are kept, up to ``_KEPT``."""

    def __missing__(self, term: str) -> int:
        if len(self) >= _KEPT:
            self.clear()
        self[term] = found = xxhash.xxh3_64_intdigest(term.encode("utf-8", "surrogatepass"))
        return found


def terms_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def hashes_of(terms: set[str], known: TermHashes | None = None) -> np.ndarray:
    """The terms' hashes, ascending: the order in which terms are sorted."""
    known = TermHashes() if known is None else known
    return np.sort(np.fromiter(map(known.__getitem__, terms), np.uint64, len(terms)))


def distinct_buckets(text: str, known: TermHashes | None = None) -> np.ndarray:
    return np.unique((hashes_of(terms_of(text), known) >> np.uint64(64 - BITS)).astype(np.int64))


def depths(hashes: np.ndarray) -> np.ndarray:
    """For each of ``SUBSETS`` series and each term, how many halvings of the lexicon the term is left in, up to ``RATES``."""
    mixed = (hashes ^ (hashes >> np.uint64(31))) * _SALTS[:, None]
    mixed ^= mixed >> np.uint64(32)
    mixed |= np.uint64(1 << RATES)
    return np.bitwise_count(~mixed & (mixed - np.uint64(1)))  # trailing zeros


def subset_hashes(hashes: np.ndarray) -> list[str]:
    """For each rate that any subset meets, the hashes of the terms in its subsets side by side, ``_UNMET`` for subsets without any.

    A subset's hash is the sum of its distinct terms' mixed hashes, so the subsets of a series, each inside the one before, are suffix sums
    over one pass through the sorted terms.
    """
    depth = depths(hashes).astype(np.int64)
    most = int(depth.max())
    place = (depth + np.arange(SUBSETS)[:, None] * (most + 1)).ravel()
    order = np.argsort(place, kind="stable")
    many = np.bincount(place, minlength=SUBSETS * (most + 1))
    filled = np.flatnonzero(many)
    sums = np.zeros(len(many), np.uint64)
    sums[filled] = np.add.reduceat(((hashes ^ (hashes >> np.uint64(32))) * _STEP)[order % len(hashes)], (np.cumsum(many) - many)[filled])
    # Rates down, subsets across: what lies at this depth or deeper, without the whole band at depth 0.
    sums, many = (np.cumsum(x.reshape(SUBSETS, -1)[:, :0:-1], axis=1)[:, ::-1].T for x in (sums, many))
    sums = (sums ^ (sums >> np.uint64(29))) * _STEP >> np.uint64(64 - 4 * _DIGITS)
    shown = sums.astype(">u4").reshape(-1, 1).view(np.uint8)[:, 4 - _DIGITS // 2:].tobytes().hex()
    digits = np.where(many > 0, np.frombuffer(shown.encode(), f"S{_DIGITS}").reshape(many.shape), _UNMET.encode())
    return [row.tobytes().decode() for row in digits]


def fingerprint(text: str, in_band: np.ndarray, known: TermHashes | None = None) -> str:
    """``band:hash`` of all terms in the band, then ``subset_hashes``, blanks between."""
    if not text:
        return ""
    terms = terms_of(text)
    hashes = hashes_of(terms, known)
    chosen = hashes[in_band[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]] if len(terms) else hashes
    if not len(chosen):
        return f"all:{hashlib.sha256(' '.join(sorted(terms)).encode('utf-8', 'surrogatepass') if terms else text.encode('utf-8', 'surrogatepass')).hexdigest()[:32]}"
    return " ".join([f"band:{xxhash.xxh3_128_hexdigest(chosen.tobytes())}", *subset_hashes(chosen)])


def likeness(left: str, right: str) -> float:
    if left == right:
        return 1.0
    a, b = (s.partition(" ")[2].replace(" ", "") for s in (left, right))
    size = max(len(a), len(b))
    if not size:
        return 0.0
    a, b = (np.frombuffer(s.ljust(size, "-").encode(), f"S{_DIGITS}").reshape(-1, SUBSETS) for s in (a, b))
    nothing = _UNMET.encode()
    met = ((a != nothing) | (b != nothing)).sum(axis=1)
    equal = ((a == b) & (a != nothing)).sum(axis=1)
    enough = 2 * met >= SUBSETS
    return float((equal[enough] / met[enough]).max() if enough.any() else equal.sum() / met.sum())


def lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> tuple[np.ndarray, int]:
    """Which buckets lie in the band, and the number of characters in all documents."""
    size = 1 << BITS
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"))

    known = TermHashes()

    def statistics(content):
        found = distinct_buckets(content, known)
        return np.append(found, [size, size + 1]), np.append(np.ones(len(found), np.int64), [1, len(content)])

    totals = count_buckets(rows, "content", statistics, size + 2)
    n = max(int(totals[size]), 1)
    return (totals[:size] >= max(band[0] * n, 1)) & (totals[:size] <= max(band[1] * n, 2)), int(totals[size + 1])


def with_next(docs: DataFrame, key: str, text: str, chars: int) -> DataFrame:
    """Rows ``(part, guest, doc, content)``: parts are ranges of ids, and each also has the first row of the
    next part, the last one that of the first, as a guest. Sorted, a row is followed by its next one."""
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"))
    spark = docs.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-chars // CHARS_PER_PART))
    at = sorted(set(docs.select(F.col(key).cast("long").alias("doc")).approxQuantile("doc", [k / parts for k in range(1, parts)], 0.1 / parts)))
    bounds = np.array(at, np.float64)

    @F.pandas_udf("long")
    def part_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.fillna(-np.inf).to_numpy(np.float64), "right"))

    placed = rows.withColumn("part", part_of("doc"))
    firsts = [(r["part"], r["first"]) for r in placed.groupBy("part").agg(F.min_by("doc", F.coalesce("doc", F.lit(-(1 << 63)))).alias("first")).sort("part").collect()]
    if not firsts:
        return placed.select("part", F.lit(0).alias("guest"), "doc", "content")
    guests = spark.createDataFrame([(first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)], "first long, target long")
    # One row for each part, hence small beside what a part holds.
    joined = placed.join(F.broadcast(guests), F.col("doc").eqNullSafe(F.col("first")), "left")
    here = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    both = F.when(F.col("target").isNull(), F.array(here)).otherwise(F.array(here, F.struct(F.col("target").alias("part"), F.lit(1).alias("guest"))))
    dealt = joined.select(F.explode(both).alias("to"), "doc", "content").select("to.part", "to.guest", "doc", "content")
    return dealt.repartition("part").sortWithinPartitions("part", "guest", "doc", "content")


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is the beginning of the next document."""
    in_band, chars = lexicon(docs, text, band)

    def pair(frames):
        known = TermHashes()
        here, doc, content, own, last = None, None, None, None, True

        def row(following, its_print):
            n = len(content)
            edited = content[:n - n // 4] + following[:n // 4]
            changed = fingerprint(edited, in_band, known)
            return doc, n, hashlib.sha256(edited.encode("utf-8")).hexdigest(), own, changed, likeness(own, changed), likeness(own, its_print)

        for frame in frames:
            out = []
            for part, guest, next_doc, following in zip(frame["part"], frame["guest"], frame["doc"], frame["content"]):
                if guest and (last or part != here):
                    continue
                its_print = fingerprint(following, in_band, known)
                if part == here and not last:
                    out.append(row(following, its_print))
                here, doc, content, own, last = part, None if pd.isna(next_doc) else int(next_doc), following, its_print, bool(guest)
            yield pd.DataFrame(out, columns=["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).astype({"doc": "Int64"})

    schema = "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, key, text, chars).mapInPandas(pair, schema).withColumnRenamed("doc", key)
