"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters, digits and ``_``; in scripts without blanks between words every character is one. The rolling (Karp-Rabin) hashes of all runs of ``min_match`` words of a
document are joined to those of the benchmark items; hits are compared word by word and grown into maximal
matches. Tiling then takes the longest match whose words are still unmarked on both sides, marks
it, and goes on, cutting matches that overlap marked words, until none of ``min_match`` words is
left. So moved sentences and paragraphs count as well as a passage in one piece. An item is in a
document if tiles cover at least ``coverage`` of its words.

An item with fewer than ``min_match`` words is looked for as a whole, by the hash of all its words. Items with fewer than
``min_words``, which any text may hold by chance, are in no document.

The benchmark goes to the tasks in blocks of bounded size (``block_chars``), one pass over the documents for
each, however large it grows. Null and empty texts contain nothing. Items with equal texts are all reported, repeated document rows too; an empty table on
either side gives an empty result. Equally long matches are taken from the left of the item, then of
the document. Only key and text columns are read.
"""

import heapq
import re
from collections import defaultdict
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_MATCH = 5
COVERAGE = 0.5
MIN_WORDS = 3
BLOCK_CHARS = 8_000_000
# Thai and Lao, Burmese, Khmer, kana, and Chinese characters stand without blanks.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W{_UNSPACED}]+|(?=\w)[{_UNSPACED}]")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` ids, modulo 2^64."""
    out = np.zeros(max(len(ids) - width + 1, 0), np.uint64)
    for k in range(width):
        out = out * _BASE + ids[k:k + len(out)].astype(np.uint64)
    return out


def tile(hits: list[tuple[int, int]], width: int, item_words: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(item position, document position, length)`` from positions where ``width`` words are equal."""
    diagonals = defaultdict(list)
    for p, q in hits:
        diagonals[q - p].append(p)
    heap = []
    for shift, starts in diagonals.items():
        starts.sort()
        first = last = starts[0]
        for p in [*starts[1:], None]:
            if p is not None and p <= last + 1:
                last = p
                continue
            heap.append((first - last - width, first, first + shift))
            first = last = p
    heapq.heapify(heap)
    marked_item, marked_doc, tiles = np.zeros(item_words, bool), set(), []
    while heap:
        size, p, q = heapq.heappop(heap)
        size = -size
        free = [not marked_item[p + k] and q + k not in marked_doc for k in range(size)]
        if all(free):
            marked_item[p:p + size] = True
            marked_doc.update(range(q, q + size))
            tiles.append((p, q, size))
            continue
        start = None
        for k in range(size + 1):
            if k < size and free[k]:
                start = k if start is None else start
            elif start is not None:
                if k - start >= width:
                    heapq.heappush(heap, (start - k, p + start, q + start))
                start = None
    return tiles


class ItemBlock:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple], width: int, min_words: int = MIN_WORDS):
        self.words: dict[str, int] = {}
        self.items = []
        seeds: dict[int, dict] = {}
        for key, text in items:
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words_of(text)], np.int64)
            if len(ids) < max(min_words, 1):
                continue
            mine = min(width, len(ids))
            for p, h in enumerate(rolling(ids, mine).tolist()):
                seeds.setdefault(mine, defaultdict(list))[h].append((len(self.items), p))
            self.items.append((key, ids))
        self.seeds = {w: (np.array(sorted(found), np.uint64), dict(found)) for w, found in sorted(seeds.items())}

    def hits(self, ids: np.ndarray, width: int) -> dict[int, list[tuple[int, int]]]:
        """Positions in each item and in the text where ``width`` words are equal."""
        hits = defaultdict(list)
        if len(ids) < width:
            return hits
        at = np.flatnonzero(np.convolve(ids > 0, np.ones(width, np.int64), "valid") == width)
        if not len(at):
            return hits
        sought, seeds = self.seeds[width]
        hashes = rolling(ids, width)[at]
        same = sought[np.minimum(np.searchsorted(sought, hashes), len(sought) - 1)] == hashes
        for q, h in zip(at[same].tolist(), hashes[same].tolist()):
            run = ids[q:q + width]
            for item, p in seeds[h]:
                if np.array_equal(self.items[item][1][p:p + width], run):
                    hits[item].append((p, q))
        return hits

    def leaks(self, text: str | None, coverage: float):
        """``(item key, item words, tiles)`` of the items that are in the text."""
        found = words_of(text) if self.items else []
        ids = np.fromiter((self.words.get(w, 0) for w in found), np.int64, len(found))
        for width in self.seeds:
            for item, pairs in self.hits(ids, width).items():
                key, own = self.items[item]
                if len({p for p, _ in pairs}) + width * len(pairs) < coverage * len(own):
                    continue
                tiles = tile(pairs, width, len(own))
                if sum(t[2] for t in tiles) >= coverage * len(own):
                    yield key, len(own), tiles


def item_blocks(benchmark: DataFrame, key: str, text: str, width: int, min_words: int, block_chars: int) -> list[ItemBlock]:
    """All items, dealt into blocks by a hash of their keys."""
    chars = benchmark.agg(F.coalesce(F.sum(F.length(text) + 8), F.lit(0))).first()[0]
    count = max(1, -(-chars // block_chars))
    dealt = benchmark.select(key, text).withColumn("__block", F.pmod(F.xxhash64(key), F.lit(count)))
    return [ItemBlock(sorted((tuple(r) for r in dealt.filter(F.col("__block") == k).select(key, text).collect()), key=str), width, min_words) for k in range(count)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(key, item_key, item_words, tiled_words, tiles, coverage, spans)`` for each item in each document; spans are ``(item position, document position, words)``."""
    kinds = dict(docs.dtypes)[key], dict(benchmark.dtypes)[item_key]
    schema = f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, item_words int, tiled_words int, tiles int, coverage double, spans array<struct<item_word:int,doc_word:int,words:int>>"

    def search(block: ItemBlock):
        def run(frames):
            for frame in frames:
                out = []
                for doc, content in zip(frame["doc"], frame["content"]):
                    for item, size, tiles in block.leaks(content, coverage):
                        tiled = sum(t[2] for t in tiles)
                        out.append((doc, item, size, tiled, len(tiles), tiled / size, [{"item_word": p, "doc_word": q, "words": n} for p, q, n in tiles]))
                yield pd.DataFrame(out, columns=[key, item_key, "item_words", "tiled_words", "tiles", "coverage", "spans"])
        return run

    rows = docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("content"))
    return reduce(DataFrame.union, [rows.mapInPandas(search(b), schema) for b in item_blocks(benchmark, item_key, item_text, min_match, min_words, block_chars)])


def _is_clean(block: ItemBlock, text: str, coverage: float) -> Column:
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: next(block.leaks(t, coverage), None) is None)

    return clean(F.coalesce(F.col(text).cast("string"), F.lit("")))


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, min_words: int = MIN_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents without any benchmark item, with their columns as they are."""
    for block in item_blocks(benchmark, item_key, item_text, min_match, min_words, block_chars):
        docs = docs.filter(_is_clean(block, text, coverage))
    return docs
