"""Lexical retrieval packing: related documents share training windows.

Documents are tokenized and end with an id of their own. Whole windows of a long document stand alone; what
remains of each document is packed. Every document is posted to a shard of bounded size in each of ``TREES`` orders, which sort by the
terms with the least of random lots, rare terms first; there its best neighbour by BM25 is found. Documents that are joined by best
neighbours form groups, and groups in the first order fill the shards that are packed; a group larger than a shard is cut in that
order too. Each shard holds a BM25 inverted index over its remainders: the
largest unused one seeds a window, its neighbours by BM25 fill the window while they fit whole, and the best one that
doesn't fit is cut to fill it exactly, its rest staying available. Only the last window of a shard is padded.

Document frequencies (of hashed terms), the number of documents and their mean length, all over the whole table, give
the BM25 weights; terms in over a quarter of all documents or in one alone carry none. Token ids come from ``tokenizers`` or, where that gives the same ids,
from ``tiktoken`` with the same vocabulary, word by word with a table of bounded size.

A null or empty text is its end id alone. Repeated rows are packed one by one. Ties in score go to the longer
remainder, then to the order of ids. An empty table gives no sequences. Only the id and text columns are read.
"""

import base64
import re
import sys
import types
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .common import count_buckets, release
from .components import components

WINDOW = 2048
END_ID = 1
TERM_BITS = 18
TREES = 3
COORDINATES = 3
SHARD_CHARS = 4_000_000
BOUNDS_PER_SHARD, BOUNDS_ROWS = 64, 1 << 18  # rows of a sample that says where the shards of an order end; all rows go to them
SHARDS_PER_TASK = 2  # a task takes some time to begin, whatever it does; shards are gone through one after the other
COMMON = 0.25
K1, B = 1.2, 0.75
_CACHED = 400_000
_KNOWN, _KNOWN_BYTES = 1_000_000, 1 << 25  # pieces that a worker's table holds, and their bytes
_SLOT_BITS, _PROBES = 21, 8  # slots by which the table finds a piece
_CHUNK = 1 << 16  # characters whose words are looked up at once: what is made of them stays in a core's cache
_ALONE = 1 << 22  # a longer text is tokenized by itself
_CELLS = 1 << 17  # scores, or pairs of a seed and a posting, that are held at once
_FREQUENT = 20  # terms in more than this part of a shard's documents count as in many
_SQUARE, _PAIRS = 1 << 21, 1 << 17  # scores that are made of all documents at once, and pairs of postings that go to them together
_ROWS = 256  # documents that are tokenized, or scored against all of a shard, at once
_DENSE = 1 << 22  # weights of terms in many documents that are held at once
_BATCH = 64  # neighbours that are ranked at a time
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_IN_WORD = bytes(c >= 128 or c == 95 or chr(c).isalnum() for c in range(256))
_BLANK = re.compile(r" (?=\S)")
_SPACE = np.array([c < 128 and chr(c).isspace() for c in range(256)])
_ASCII_LETTER = bytes(c < 128 and chr(c).isalpha() for c in range(256))
_ASCII_OTHER = bytes(c < 128 and not chr(c).isalpha() for c in range(256))
_MAYBE_SPACE = np.array([0xC285, 0xC2A0, 0xE19A, 0xE280, 0xE281, 0xE380])  # how all other white space begins in UTF-8


def _worker_wide(name: str, make):
    """An object that stays in a Python worker from task to task."""
    held = sys.modules.setdefault("_packing_caches", types.ModuleType("_packing_caches")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


class Tokens:
    """Ids of a text as 16-bit numbers, as ``tokenizers`` gives them.

    The vocabulary splits a text at every blank that is followed by something else than white
    space, so such pieces can be encoded alone, and each distinct one only once.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.json_path = json_path
        self.full = None
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encode, encode_word = encoding.encode_ordinary, encoding._encode_single_piece
        lines = tiktoken.Encoding("lines", pat_str=r"\n|[^\n]+", mergeable_ranks=ranks, special_tokens={})
        self.lines, self.line_end = lines.encode_ordinary, ranks[b"\n"]

        class Cache(dict):
            def __missing__(self, piece):
                if not piece or piece[0].isspace():
                    raise KeyError(piece)  # after this blank no piece begins
                # A blank and letters are one piece of the vocabulary's pattern and need no splitting.
                ids = encode_word(b" " + piece.encode()) if piece.isalpha() else encode(" " + piece)
                self[piece] = found = array("H", ids).tobytes()
                return found

        self.first = lambda piece: np.array(encode(piece), np.uint16).tobytes()
        self.whole = lambda piece: encode_word(piece) if piece[:1] == b" " and (piece[1:].isalpha() or piece[1:].decode().isalpha()) else encode(piece.decode())
        self.cache = Cache()
        self.forget()

    def forget(self) -> None:
        """Empty the table of pieces: of each one its hash, and where its bytes and ids begin, all on end.

        Arrays grow by doubling, so a new piece costs the same however many there are. ``slot`` finds a piece by the upper bits of
        its hash, or in one of the next ``_PROBES`` slots.
        """
        self.many, self.slot = 0, np.full((1 << _SLOT_BITS) + _PROBES, -1, np.int32)
        self.hash_at = np.zeros(1, np.uint64)
        self.bytes, self.ids = np.empty(0, np.uint8), np.empty(0, np.uint16)
        self.bytes_at, self.ids_at = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The places of hashes, -1 of unknown ones."""
        slots = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        places = self.slot[slots]
        other = np.flatnonzero((places >= 0) & (self.hash_at[places] != hashes))
        for k in range(1, _PROBES + 1):
            if not len(other):
                break
            places[other] = -1 if k == _PROBES else self.slot[slots[other] + k]
            other = other[(places[other] >= 0) & (self.hash_at[places[other]] != hashes[other])]
        return places

    def learn(self, hashes: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Add new pieces, with distinct hashes; their places."""
        # A piece of a blank and letters is not split any more, so such ones are encoded together, a line each; after all others.
        words = [piece.decode() for piece in pieces]
        alone = np.array([not (word[1:] if word[:1] == " " else word).isalpha() for word in words], bool)
        order = np.argsort(~alone, kind="stable")
        hashes, pieces = hashes[order], [pieces[k] for k in order.tolist()]
        ids = [self.whole(piece) for piece in pieces[:alone.sum()]]
        together = np.array(self.lines("\n".join([words[k] for k in order[len(ids):].tolist()])), np.uint16)
        stops = np.append(np.flatnonzero(together == self.line_end), len(together))[:len(order) - len(ids)]
        many = np.append(np.array([len(x) for x in ids], np.int64), np.diff(stops, prepend=-1) - 1)
        ids = np.append(np.fromiter((i for x in ids for i in x), np.uint16), together[together != self.line_end])
        places = np.arange(self.many, self.many + len(many), dtype=np.int32)
        ends = self.bytes_at[self.many] + np.cumsum([len(x) for x in pieces]), self.ids_at[self.many] + np.cumsum(many)
        self.hash_at = _put(self.hash_at, self.many, hashes)
        self.bytes = _put(self.bytes, int(self.bytes_at[self.many]), np.frombuffer(b"".join(pieces), np.uint8))
        self.ids = _put(self.ids, int(self.ids_at[self.many]), ids)
        self.bytes_at, self.ids_at = _put(self.bytes_at, self.many + 1, ends[0]), _put(self.ids_at, self.many + 1, ends[1])
        self.many += len(many)
        slots, left = (hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64), np.arange(len(many))
        for k in range(_PROBES):  # one without a free slot is learned again when it comes again
            free = left[self.slot[slots[left] + k] < 0]
            self.slot[slots[free] + k] = places[free]
            left = left[self.slot[slots[left] + k] != places[left]]
        placed = np.empty(len(many), np.int32)
        placed[order] = places
        return placed

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As ``encode``, with the pieces of many texts looked up at once."""
        out, waiting, chars = [b""] * len(texts), [], 0
        for k, text in enumerate(texts):
            if "<|" in text or len(text) > _ALONE:
                out[k] = self.encode(text)
                continue
            waiting.append(k)
            chars += len(text)
            if chars > _CHUNK:
                for j, ids in zip(waiting, self._encode_chunk([texts[j] for j in waiting])):
                    out[j] = ids
                waiting, chars = [], 0
        for j, ids in zip(waiting, self._encode_chunk([texts[j] for j in waiting])):
            out[j] = ids
        return out

    def _encode_chunk(self, texts: list[str]) -> list[bytes]:
        raw = [t.encode() for t in texts]
        joined = b"".join(raw)
        if not joined:
            return [b""] * len(texts)
        data = np.frombuffer(joined, np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
        # Pieces begin with their text, after a letter where none follows (no piece of the vocabulary's pattern goes on there),
        # and at a blank with something else than white space after it in the same text.
        blanks = np.flatnonzero(data == 32)
        after, second = (data[np.minimum(blanks + k, len(data) - 1)] for k in (1, 2))
        last = np.zeros(len(data) + 1, bool)
        last[bounds[1:] - 1] = True
        begins = np.zeros(len(data) + 1, bool)
        begins[blanks[~(last[blanks] | _SPACE[after] | np.isin(after.astype(np.int64) << 8 | second, _MAYBE_SPACE))]] = True
        begins[1:-1] |= np.frombuffer(joined.translate(_ASCII_LETTER), bool)[:-1] & np.frombuffer(joined.translate(_ASCII_OTHER), bool)[1:]
        begins[bounds] = True
        starts = np.flatnonzero(begins[:-1])
        sizes = np.diff(starts, append=len(data))
        hashed = _hashes(data, starts, starts + sizes) + sizes.astype(np.uint64)
        for again in (False, True):
            places = self.find(hashed)
            unknown = np.flatnonzero(places < 0)
            new, first, which = np.unique(hashed[unknown], return_index=True, return_inverse=True)
            if again or self.many + len(new) <= _KNOWN and self.bytes_at[self.many] <= _KNOWN_BYTES:
                break
            self.forget()
        if len(new):
            places[unknown] = self.learn(new, [joined[starts[k]:starts[k] + sizes[k]] for k in unknown[first]])[which]
        # Two pieces with one hash would show here; then every text is encoded by itself.
        held = self.bytes_at[places]
        if not (np.array_equal(self.bytes_at[places + 1] - held, sizes) and np.array_equal(self.bytes[np.repeat(held - starts, sizes) + np.arange(len(data))], data)):
            return [self.encode(t) for t in texts]
        many = self.ids_at[places + 1] - self.ids_at[places]
        ends = np.concatenate(([0], np.cumsum(many)))
        ids = self.ids[np.repeat(self.ids_at[places] - ends[:-1], many) + np.arange(ends[-1])]
        cuts = ends[np.searchsorted(starts, bounds)]
        return [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    def encode(self, text: str) -> bytes:
        if "<|" in text:  # may hold a special token, which the vocabulary of ranks does not know
            if self.full is None:
                from tokenizers import Tokenizer

                self.full = Tokenizer.from_file(self.json_path)
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint16).tobytes()
        if len(self.cache) > _CACHED:
            self.cache.clear()
        pieces = text.split(" ")
        try:
            return self.first(pieces[0]) + b"".join(map(self.cache.__getitem__, pieces[1:]))
        except KeyError:
            pieces = _BLANK.split(text)
            return self.first(pieces[0]) + b"".join(map(self.cache.__getitem__, pieces[1:]))


def _put(held: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``held`` with ``more`` from ``at`` on, in an array of twice the size if it has no room."""
    if at + len(more) > len(held):
        held = np.concatenate((held[:at], more, np.zeros(at + len(more), held.dtype)))
    else:
        held[at:at + len(more)] = more
    return held


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the hash's base, modulo 2^64, and their inverses."""
    held = _worker_wide("powers", dict)
    if held.get("n", 0) < n:
        n = max(2 * n, 1 << 15)
        ones = np.ones(1, np.uint64)
        held["powers"] = tuple(np.cumprod(np.concatenate((ones, np.full(n, x, np.uint64)))) for x in (_BASE, _INVERSE))
        held["n"] = n
    return held["powers"]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each stretch of bytes, a polynomial in them found for all at once from running sums."""
    powers, inverses = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers[:len(data)], out=sums[1:])
    hashed = (sums[ends] - sums[starts]) * inverses[starts]
    return (hashed ^ (hashed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-cased UTF-8 begin, and their buckets."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = np.frombuffer(data.tobytes().translate(_IN_WORD), bool)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(edges):
        return edges, edges
    return edges[::2], (_hashes(data, edges[::2], edges[1::2]) >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def term_hashes(text: str | None) -> np.ndarray:
    """Buckets of a text's words, in order and with repeats.

    A word is a lower-cased run of ASCII letters, digits, ``_`` and characters beyond ASCII. Its hash is
    a polynomial in its bytes, found for all words at once from running sums.
    """
    return _words(np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8))[1]


def words_of(texts: Iterable[str]) -> Iterator[tuple[str, np.ndarray]]:
    """Each text and its ``term_hashes``, found for many texts at once."""
    def of(waiting):
        raw = [t.lower().encode("utf-8", "surrogatepass") for t in waiting]
        starts, found = _words(np.frombuffer(b"\n".join(raw), np.uint8))
        cuts = np.searchsorted(starts, np.cumsum([0] + [len(x) + 1 for x in raw])).tolist()
        return zip(waiting, (found[a:b] for a, b in zip(cuts[:-1], cuts[1:])))

    waiting, chars = [], 0
    for text in texts:
        waiting.append(text)
        chars += len(text)
        if chars > _CHUNK:
            yield from of(waiting)
            waiting, chars = [], 0
    if waiting:
        yield from of(waiting)


def _chunk_bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    starts, found = _words(np.frombuffer(b"\n".join(raw), np.uint8))
    owner = np.searchsorted(np.cumsum([len(x) + 1 for x in raw]), starts, "right")
    held, times = np.unique(owner << TERM_BITS | found, return_counts=True)
    cuts = np.searchsorted(held, np.arange(len(raw) + 1) << TERM_BITS)
    held &= (1 << TERM_BITS) - 1
    return [(held[a:b], times[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def bags(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct ``term_hashes`` of each text, in order, and how often they are there."""
    out, waiting, chars = [], [], 0
    for text in texts:
        waiting.append(text)
        chars += len(text)
        if chars > _CHUNK:
            out += _chunk_bags(waiting)
            waiting, chars = [], 0
    return out + _chunk_bags(waiting) if waiting else out


def flat_all(terms: list[np.ndarray], times: list[np.ndarray]) -> tuple[list[bytes], list[bytes]]:
    """Distinct terms of each text, in order, as the numbers of each of their upper parts and their lower 16 bits; times as their lower bytes, then the upper ones."""
    if not terms:
        return [], []
    parts, cuts = 1 << TERM_BITS - 16, np.cumsum([0] + [len(t) for t in terms])
    term, time = np.concatenate(terms), np.concatenate(times).astype("<u2")
    upper = np.bincount(np.repeat(np.arange(len(terms)) * parts, np.diff(cuts)) + (term >> 16), minlength=parts * len(terms)).astype("<u4").tobytes()
    lower, low, high = term.astype("<u2").tobytes(), time.astype(np.uint8).tobytes(), (time >> 8).astype(np.uint8).tobytes()
    cuts, size = cuts.tolist(), 4 * parts
    spans = list(enumerate(zip(cuts[:-1], cuts[1:])))
    return [upper[k * size:(k + 1) * size] + lower[2 * a:2 * b] for k, (a, b) in spans], [low[a:b] + high[a:b] for _, (a, b) in spans]


def unflat_all(terms: list[bytes], times: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    parts = 1 << TERM_BITS - 16
    sizes = [len(t) // 2 for t in times]
    upper = np.repeat(np.tile(np.arange(parts) << 16, len(terms)), np.frombuffer(b"".join([t[:4 * parts] for t in terms]), "<u4"))
    term = upper | np.frombuffer(b"".join([t[4 * parts:] for t in terms]), "<u2")
    low, high = (np.frombuffer(b"".join(x), np.uint8) for x in zip(*((t[:k], t[k:]) for t, k in zip(times, sizes))))
    time, cuts = low | high.astype(np.uint16) << 8, np.cumsum([0] + sizes).tolist()
    spans = list(zip(cuts[:-1], cuts[1:]))
    return [term[a:b] for a, b in spans], [time[a:b] for a, b in spans]


def flat(terms: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    held = flat_all([terms], [times])
    return held[0][0], held[1][0]


def unflat(terms: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = unflat_all([terms], [times])
    return held[0][0], held[1][0]


def lots_of(idf: np.ndarray, tree: int) -> np.ndarray:
    """A lot for each term in a tree; the rarer a term, the better its chance of the least one. Terms that carry nothing have none."""
    hashed = (np.arange(1, len(idf) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0xD1B54A32D192ED03 * (tree + 1) % (1 << 64))
    hashed = (hashed ^ (hashed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    even = ((hashed >> np.uint64(11)).astype(float) + 1) / (1 << 53)
    return np.where(idf > 0, -np.log(even) / np.maximum(idf, 1e-9) ** 2, np.inf)


def coordinates(terms: list[np.ndarray], lots: np.ndarray) -> list[int]:
    """The ``COORDINATES`` terms of each text with the least lots, as one number: documents in its order stand beside those they share most of them with."""
    sizes = np.array([len(t) for t in terms], np.int64)
    keys, some = np.zeros(len(terms), np.int64), np.flatnonzero(sizes)
    if not len(some):
        return keys.tolist()
    found, sizes = np.concatenate(terms), sizes[some]
    mine, starts, owner = lots[found], np.cumsum(sizes) - sizes, np.repeat(np.arange(len(some)), sizes)
    for _ in range(COORDINATES):
        least = np.minimum.reduceat(mine, starts)
        at = np.flatnonzero(mine == np.repeat(least, sizes))
        at = at[np.diff(owner[at], prepend=-1) > 0]  # the first of equal ones
        keys[some] = keys[some] << TERM_BITS | np.where(np.isinf(least), 0, found[at])
        mine[at] = np.inf
    return keys.tolist()


class Postings:
    """An inverted index, each posting with its BM25 weight."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, sizes: np.ndarray | None = None, mean: float | None = None):
        self.n = len(terms)
        owner = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
        term = np.concatenate(terms) if terms else np.empty(0, np.int64)
        tf = np.concatenate(counts).astype(float) if counts else np.empty(0)
        size = sizes if sizes is not None else np.bincount(owner, tf, len(terms))
        mean = max(mean if mean is not None else size.mean() if len(size) else 0, 1e-9)
        weight = idf[term] * tf * (K1 + 1) / (tf + np.repeat(K1 * (1 - B + B * size / mean), [len(t) for t in terms]))
        # By term, in order of owners as they are: term and position as one number, as numpy sorts numbers faster than it finds their order.
        both = term.astype(np.int64) << 32 | np.arange(len(term))
        both.sort()
        order = both & 0xFFFFFFFF
        self.owner, self.term, self.weight = owner[order], both >> 32, weight[order]
        self.heads = np.flatnonzero(np.diff(self.term, prepend=-1))  # where each distinct term begins
        self.df = np.diff(self.heads, append=len(self.term))

    def frequent(self, cells: int) -> np.ndarray:
        """The distinct terms in many documents, as many as have room in so many cells."""
        return np.argsort(-self.df, kind="stable")[:min(max(1, cells // max(self.n, 1)), int((_FREQUENT * self.df > self.n).sum()))]

    def scores(self, wanted: np.ndarray) -> np.ndarray:
        """Of all documents for these distinct terms."""
        lo, hi = np.searchsorted(self.term, wanted, "left"), np.searchsorted(self.term, wanted, "right")
        many = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
        return np.bincount(self.owner[at], self.weight[at], self.n)


def square_scores(index: Postings, which: np.ndarray) -> np.ndarray:
    """Scores of all documents for all, by these of the distinct terms: those in equally many documents form a table, whose rows are paired with themselves."""
    n, filled = index.n, 0
    score, cells, weights = np.zeros(n * n), np.empty(_PAIRS, np.int64), np.empty(_PAIRS)
    which = which[index.df[which] > 1]  # a term of one document meets no other
    which = which[np.argsort(index.df[which], kind="stable")]
    df = index.df[which]
    lo = 0
    for hi in np.append(np.flatnonzero(np.diff(df)) + 1, len(df)).tolist():
        while lo < hi:
            many = int(df[lo])
            if filled + many * many > _PAIRS:
                np.add.at(score, cells[:filled], weights[:filled])
                filled = 0
            to = min(hi, lo + (_PAIRS - filled) // (many * many))
            at = index.heads[which[lo:to]] + np.arange(many)[:, None]
            part, shape = slice(filled, filled + many * at.size), (many, many, to - lo)
            if to - lo < many:  # the longest side last, as it is gone along in one go
                at, shape = at.T, (to - lo, many, many)
            owner, weight = index.owner[at], index.weight[at]
            a, b = (owner[:, None], owner[None]) if to - lo >= many else (owner[:, :, None], owner[:, None])
            np.add(a * n, b, out=cells[part].reshape(shape))
            weights[part].reshape(shape)[:] = weight[None] if to - lo >= many else weight[:, None]
            filled, lo = part.stop, to
    np.add.at(score, cells[:filled], weights[:filled])
    return score.reshape(n, n)


def best_neighbours(index: Postings, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each document the one with the best score for its terms and another node, and that score, 0 if there is none.

    Terms in many documents are scored as a matrix of bounded size, all others by their pairs of postings: of all documents at once
    where there are few, else of some after the others.
    """
    n, heads, df = index.n, index.heads, index.df
    frequent = index.frequent(_DENSE)
    column = np.full(len(df), -1)
    column[frequent] = np.arange(len(frequent))
    group = np.repeat(np.arange(len(df)), df)
    dense = np.flatnonzero(column[group] >= 0)
    weights = np.zeros((n, len(frequent)), np.float32)
    weights[index.owner[dense], column[group[dense]]] = index.weight[dense]
    asked = (weights > 0).astype(np.float32)
    best, top = np.zeros(n, np.int64), np.zeros(n)

    def settle(lo, hi, score):
        score += asked[lo:hi] @ weights.T
        score[nodes[lo:hi, None] == nodes] = 0
        best[lo:hi] = score.argmax(axis=1)
        top[lo:hi] = score[np.arange(hi - lo), best[lo:hi]]

    if n * n <= _SQUARE and index.df[column < 0].max(initial=0) ** 2 <= _PAIRS:
        score = square_scores(index, np.flatnonzero(column < 0))
        for lo in range(0, n, _ROWS):
            settle(lo, min(n, lo + _ROWS), score[lo:lo + _ROWS])
        return best, top
    rest = np.flatnonzero((column[group] < 0) & (df[group] > 1))
    rest = rest[np.argsort(index.owner[rest], kind="stable")]
    seeds, many, heads = index.owner[rest], df[group[rest]], heads[group[rest]]
    first = np.searchsorted(seeds, np.arange(n + 1))
    pairs = np.concatenate(([0], np.cumsum(many)))[first]
    lo = 0
    while lo < n:
        hi = max(lo + 1, min(n, lo + _CELLS // n, int(np.searchsorted(pairs, pairs[lo] + _CELLS, "right")) - 1))
        part = slice(first[lo], first[hi])
        ends = np.cumsum(many[part])
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(heads[part] - ends + many[part], many[part]) + np.arange(total)
        cell = np.repeat((seeds[part] - lo) * n, many[part]) + index.owner[at]
        score = np.bincount(cell, index.weight[at], (hi - lo) * n).reshape(hi - lo, n).astype(float, copy=False)  # without pairs: whole numbers
        settle(lo, hi, score)
        lo = hi
    return best, top


def parts(frames: Iterable[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Frames of so many rows at most: what is made of a frame's texts is held at once."""
    for frame in frames:
        for start in range(0, len(frame), rows):
            yield frame[start:start + rows]


def _by_owner(owner: np.ndarray, what: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each owner's distinct ``what`` begin, and they, in order."""
    both = np.sort(owner << 32 | what)
    both = both[np.append(True, both[1:] != both[:-1])[:len(both)]]
    return np.searchsorted(both, np.arange(n + 1) << 32), both & 0xFFFFFFFF


def pack_shard(lengths: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, window: int = WINDOW, sizes: np.ndarray | None = None, mean: float | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(document, start, length)``; documents by position. ``sizes`` are their numbers of words and ``mean``
    that of all documents; else those of the terms given."""
    windows = [[(d, k * window, window)] for d, n in enumerate(lengths) for k in range(n // window)]
    start, left = (lengths // window) * window, lengths % window
    index = Postings(terms, counts, idf, sizes, mean)
    # Terms in many documents have a row of weights each, all others a stretch of postings; both are listed for each document, by term.
    # What no other document holds is left out.
    frequent = np.sort(index.frequent(_DENSE // 2))
    column = np.full(len(index.df), -1)
    column[frequent] = np.arange(len(frequent))
    group = np.repeat(np.arange(len(index.df)), index.df)
    rows, posting = np.zeros((len(frequent), index.n)), column[group]
    dense, sparse = np.flatnonzero(posting >= 0), np.flatnonzero((posting < 0) & (index.df[group] > 1))
    np.add.at(rows, (posting[dense], index.owner[dense]), index.weight[dense])
    kept = np.flatnonzero((column < 0) & (index.df > 1))
    rank = np.zeros(len(index.df), np.int64)
    rank[kept] = np.arange(len(kept))
    own_rows, row = _by_owner(index.owner[dense], posting[dense], index.n)
    own, stretch = _by_owner(index.owner[sparse], rank[group[sparse]], index.n)
    owner, weight, posted, columns = index.owner[sparse], index.weight[sparse], len(left), np.arange(index.n)
    heads = np.concatenate(([0], np.cumsum(index.df[kept])))
    seeds = np.lexsort((np.arange(len(left)), -left))
    ahead = 0
    while True:
        waits = left > 0
        if 5 * waits.sum() < 4 * posted:  # what is used up leaves the postings
            stays = waits[owner]
            heads = np.concatenate(([0], np.cumsum(stays)))[heads]
            owner, weight, posted = owner[stays], weight[stays], waits.sum()
            rows, columns = rows[:, waits[columns]], columns[waits[columns]]
        while ahead < len(seeds) and left[seeds[ahead]] == 0:
            ahead += 1
        if ahead == len(seeds):
            return windows
        seed = seeds[ahead]
        content, space = [(int(seed), int(start[seed]), int(left[seed]))], window - int(left[seed])
        left[seed] = 0
        near = np.empty(0, np.int64)
        if space and len(terms[seed]):
            asked = stretch[own[seed]:own[seed + 1]]
            lo = heads[asked]
            many = heads[asked + 1] - lo
            ends = np.cumsum(many)
            at = np.repeat(lo - ends + many, many) + np.arange(many.sum())
            score = np.bincount(owner[at], weight[at], len(left)).astype(float, copy=False)  # without pairs: whole numbers
            score[columns] += rows[row[own_rows[seed]:own_rows[seed + 1]]].sum(axis=0)
            near = np.flatnonzero((score > 0) & (left > 0))
        ranked = near
        # Neighbours from the best on, a batch at a time: whole ones while they fit, or one of the batch to be cut.
        while space and len(near):
            best_first = np.lexsort((near, -left[near], -score[near])) if len(near) <= _BATCH else None
            if best_first is None:
                top = np.argpartition(-score[near], _BATCH - 1)[:_BATCH]
                batch = near[top]
                near = np.delete(near, top)
                batch = batch[np.lexsort((batch, -left[batch], -score[batch]))]
            else:
                batch, near = near[best_first], near[:0]
            for best, size in zip(batch.tolist(), left[batch].tolist()):
                if size <= space:
                    content.append((best, int(start[best]), size))
                    space -= size
                    left[best] = 0
                    if not space:
                        break
            ranked = batch[left[batch] > 0]
            if len(ranked):
                break
        while space:  # cut the best neighbour, or else what comes next
            waiting = ranked[left[ranked] > 0]
            if len(waiting):
                best = waiting[0]
            else:
                while ahead < len(seeds) and left[seeds[ahead]] == 0:
                    ahead += 1
                if ahead == len(seeds):
                    break
                best = seeds[ahead]
            took = min(space, int(left[best]))
            content.append((int(best), int(start[best]), took))
            start[best] += took
            left[best] -= took
            space -= took
        windows.append(content)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, tokenizer: str = "byte_bpe_50k", shard_chars: int = SHARD_CHARS, with_ids: bool = True) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` for every piece, and its ``ids`` unless they are not wanted."""
    import public_tokenizers

    paths = public_tokenizers.path(f"{tokenizer}.json"), public_tokenizers.path(f"{tokenizer}.tiktoken"), public_tokenizers.PATTERN
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("content"))
    rows = rows.withColumn("row", F.xxhash64("doc", "content"))
    terms_size = 1 << TERM_BITS

    def statistics(texts):
        for content, found in words_of(texts):
            yield np.append(found, [terms_size, terms_size + 1, terms_size + 2]), np.append(np.ones(len(found), np.int64), [len(content) + 1, 1, len(found)])

    totals = count_buckets(rows, "content", statistics, terms_size + 3, streamed=True)
    df, n, chars = totals[:terms_size], max(int(totals[-2]), 1), int(totals[-3])
    mean = int(totals[-1]) / n
    idf = np.where((df > 1) & ((df <= COMMON * n) | (n < 8)), np.log(1 + (n - df + 0.5) / (df + 0.5)), 0).astype(np.float32)
    shards = max(1, -(-4 * chars // (3 * shard_chars))) if chars > shard_chars else 1  # aims at three quarters, as ranges are uneven

    def described(frame):
        """``(terms, times, words)`` of each row, terms that carry nothing left out."""
        for found, times in bags(list(frame["content"])):
            useful = idf[found] > 0
            yield found[useful], np.minimum(times[useful], 65535).astype(np.uint16), int(times.sum())

    def nodes_of(frame, keys):
        """Nodes are in the order of the first tree, of which these are the keys, and equal for equal rows."""
        for doc, content, key in zip(frame["doc"], frame["content"], keys):
            yield key >> TERM_BITS * (COORDINATES - 2) << 27 | zlib.crc32(content.encode("utf-8", "surrogatepass"), zlib.crc32(str(doc).encode())) >> 5

    def spots(frames):
        """The places of rows in all orders, as numbers side by side: key, node."""
        lots = [lots_of(idf, t) for t in range(TREES)]
        for frame in parts(frames, 4 * _ROWS):
            terms = [mine for mine, _, _ in described(frame)]
            keys = [coordinates(terms, lot) for lot in lots]
            found = [spot for mine, *spot in zip(terms, *keys, nodes_of(frame, keys[0])) if len(mine)]
            yield pd.DataFrame({"spots": [np.array(found, "<i8").tobytes()]})

    def ends_of_shards():
        """``(key, node)`` at which the next shard of an order begins, for each order. They come from a sample, as Spark's own ranges do, but
        of rows that are not made into postings."""
        share = min(BOUNDS_PER_SHARD * shards, BOUNDS_ROWS) / n
        some = rows.select("doc", "content")
        held = (some.sample(share, seed=7) if share < 1 else some).mapInPandas(spots, "spots binary").collect()
        found = np.concatenate([np.frombuffer(r["spots"], "<i8").reshape(-1, TREES + 1) for r in held] or [np.empty((0, TREES + 1), np.int64)])
        ends = []
        for t in range(TREES):
            order = np.lexsort((found[:, TREES], found[:, t]))
            at = order[len(order) * np.arange(1, shards) // shards] if len(order) else order
            ends.append(list(zip(found[at, t].tolist(), found[at, TREES].tolist())))
        return ends

    def post(frames):
        lots = [lots_of(idf, t) for t in range(TREES)]
        for frame in parts(frames, 4 * _ROWS):
            out, (terms, times, words) = [], map(list, zip(*described(frame)))
            keys = [coordinates(terms, lot) for lot in lots]
            for row, content, node, mine, held_terms, held_times, many, *key in zip(frame["row"], frame["content"], nodes_of(frame, keys[0]), terms, *flat_all(terms, times), words, *keys):
                if len(mine):
                    out += [(t * shards + bisect_right(ends[t], (key[t], node)), key[t], node, row, len(content), held_terms, held_times, many) for t in range(TREES)]
            yield pd.DataFrame(out, columns=["part", "key", "node", "row", "chars", "terms", "times", "words"])

    def name(frames):
        lots = lots_of(idf, 0)
        for frame in parts(frames, 4 * _ROWS):
            keys = coordinates([mine for mine, _, _ in described(frame)], lots)
            yield frame[["row", "doc", "content"]].assign(node=list(nodes_of(frame, keys)))

    def best_of(part, held):
        nodes = np.array([r[0] for r in held], np.int64)
        terms, times = unflat_all([r[3] for r in held], [r[4] for r in held])
        best, score = best_neighbours(Postings(terms, times, idf, np.array([r[5] for r in held]), mean), nodes)
        found = pd.DataFrame({"node": nodes, "best": nodes[best], "score": score, "row": np.array([r[1] for r in held], np.int64)})
        return found if part < shards else found[score > 0].assign(row=None)

    def search(frames):
        part, filled, held = None, 0, []
        for frame in frames:
            for p, node, row, size, terms, times, words in zip(frame["part"], frame["node"], frame["row"], frame["chars"], frame["terms"], frame["times"], frame["words"]):
                if held and (p != part or filled + size > most):
                    yield best_of(part, held)
                    filled, held = 0, []
                part, filled = p, filled + size
                held.append((node, row, size, terms, times, words))
        if held:
            yield best_of(part, held)

    most = 3 * shard_chars // 2

    def groups():
        """``(row, node, place, within, part)``: documents and their best neighbours, of all trees, share the place of the first of them. A range of
        places ends inside a group, by ``within``, only if the group has about half of a shard's documents or more. Rows without terms are not there."""
        posted = rows.mapInPandas(post, "part long, key long, node long, row long, chars long, terms binary, times binary, words long")
        parted = posted.repartition(-(-TREES * shards // SHARDS_PER_TASK), "part").sortWithinPartitions("part", "key", "node")
        found = stage(parted.mapInPandas(search, "node long, best long, score double, row long"), "neighbours")
        release(docs.sparkSession)
        nearest = found.filter("score > 0").groupBy("node").agg(F.max_by("best", F.struct("score", "best")).alias("best"))
        linked = components(nearest.select(F.col("node").alias("a"), F.col("best").alias("b"))).select("node", F.col("component").alias("place"))
        whole = linked.union(linked.select(F.col("place").alias("node"), "place").distinct())
        large = whole.groupBy("place").agg((F.count("*") * F.lit(2 * chars / n) > shard_chars).alias("large"))
        grouped = whole.join(large, "place").select("node", "place", F.when(F.col("large"), F.col("node")).otherwise(0).alias("within"))
        known = found.filter("row is not null").groupBy("row").agg(F.min("node").alias("node"))
        placed = known.join(grouped, "node", "left").select("row", "node", F.coalesce("place", "node").alias("place"), F.coalesce("within", "node").alias("within"))
        return stage(placed.repartitionByRange(shards, "place", "within").withColumn("part", F.spark_partition_id()), "places")

    def pieces(shard, held):
        ids = [np.append(np.frombuffer(r[1], np.uint16), np.uint16(end_id)) for r in held]
        windows = pack_shard(np.array([len(x) for x in ids], np.int64), [r[2] for r in held], [r[3] for r in held], idf, window, np.array([r[4] for r in held]), mean)
        out = []
        for k, content in enumerate(windows):
            offset = 0
            for d, start, length in content:
                piece = ids[d][start:start + length].astype("<u4").tobytes()
                out.append((held[d][0], start, length, zlib.crc32(piece), len(ids[d]), (shard << 24) + k, offset, piece if with_ids else None))
                offset += length
        return pd.DataFrame(out, columns=["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]).astype({"doc": "Int64"})

    def pack_all(frames):
        tokens = _worker_wide("|".join(paths), lambda: Tokens(*paths))
        shard = TaskContext.get().partitionId() << 20
        held, group, place, filled, size, part = [], [], None, 0, 0, None
        for frame in parts(frames, _ROWS):
            texts = list(frame["content"])
            for p, *row in zip(frame["part"], frame["place"], frame["doc"], tokens.encode_all(texts), *zip(*described(frame)), (len(t) + 1 for t in texts)):
                if p != part and held + group:
                    yield pieces(shard, held + group)
                    shard, held, group, place, filled, size = shard + 1, [], [], None, 0, 0
                part = p
                if row[0] != place or filled + size + row[6] > most:
                    # A group that doesn't fit begins a shard; one larger than a shard is cut in the order of its content.
                    if row[0] == place and held:
                        yield pieces(shard, held)
                        shard, held, filled = shard + 1, [], 0
                    if row[0] != place or size + row[6] > most:
                        held, group, filled, size = held + group, [], filled + size, 0
                    if held and filled + row[6] > most:
                        yield pieces(shard, held)
                        shard, held, filled = shard + 1, [], 0
                    place = row[0]
                group.append((None if pd.isna(row[1]) else row[1], *row[2:6]))
                size += row[6]
        if held or group:
            yield pieces(shard, held + group)

    # Texts are tokenized where they are packed: shuffled twice, they are smaller than their ids and terms.
    # Ranges are made of their places alone; rows without terms are dealt to them by their hash.
    if shards > 1:
        ends = ends_of_shards()
        places = rows.join(groups(), "row", "left").withColumn("part", F.coalesce("part", F.pmod("row", F.lit(shards)).cast("int")))
    else:
        places = rows.mapInPandas(name, "row long, doc long, content string, node long").withColumns({"place": F.lit(0).cast("long"), "part": F.lit(0)})
    node = F.coalesce("node", F.pmod("row", F.lit(1 << 27)))
    placed = places.select("part", "doc", "content", node.alias("node"), F.coalesce("place", node).alias("place"))
    by_shard = placed.repartition(-(-shards // SHARDS_PER_TASK), "part").sortWithinPartitions("part", "place", "node", "doc")
    packed = by_shard.mapInPandas(pack_all, "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
    return packed.withColumnRenamed("doc", key)
