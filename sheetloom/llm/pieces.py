"""SentencePiece encoding and decoding: BPE merges by vectorised rounds.

A text becomes what the model's rules make of it: a blank in front, every blank as ``▁``. It is taken apart into
words, a run of ``▁`` with what follows, as no piece has ``▁`` behind another character (a model where one has
is refused). Each distinct word of a chunk of texts is encoded once: the characters of all these words are one
flat array of symbols, and words are cut once more between two characters that stand side by side in no piece. A round
finds the best pair of each such segment, joins all its places from the left at once, and drops what the joins
consumed; segments where nothing can be joined leave the arrays. Characters without a piece become bytes.

Joining all places at once is exact as long as no join makes a pair that is better than the one being joined. A segment where that
happens, and one whose best pair has the score of other pieces too (as runs of ``▁`` have), is encoded
by a queue, pair by pair: best score first, then the leftmost.

A null text is empty; an empty text is its end id alone and decodes to the empty text. Texts are whole, of any length: a chunk holds
``CHUNK`` characters or one longer text. Rows keep their order and repeats; only the text column is read, and other
columns stay, unless they have the name of the result, which is then replaced. An empty table gives an empty one.
"""

import codecs
import heapq
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
CHUNK = 1_000_000  # characters encoded together
_CACHED, _CACHED_CHARS = 300_000, 48  # words kept from chunk to chunk, none longer than this
_NONE = np.iinfo(np.int32).max
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _one_each(error):
    return "�", error.start + 1


codecs.register_error("one_each", _one_each)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class Pieces:
    """The vocabulary of a model, its pair table, and the words met so far.

    Symbols are piece ids; a character without a piece is its code point above them.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        self.end = model.eos_id()
        names = [model.id_to_piece(i) for i in range(self.size)]
        normal = {names[i]: i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}
        if any(SPACE in name.lstrip(SPACE) for name in normal):
            raise ValueError(f"{path}: a piece has a blank behind another character")
        byte = [i for i in range(self.size) if model.is_byte(i)]
        if len(byte) != 256:
            raise ValueError(f"{path}: no piece for each byte")
        self.bytes = np.array(sorted(byte, key=lambda i: int(names[i][3:5], 16)), np.int32)
        # What each id decodes to; control ids to nothing.
        self.spelled = [name.replace(SPACE, " ").encode() for name in names]
        for i in range(self.size):
            if model.is_control(i):
                self.spelled[i] = b""
            elif model.is_unknown(i):
                self.spelled[i] = " ⁇ ".encode()
        for value, i in enumerate(self.bytes):
            self.spelled[i] = bytes([value])
        self.silent = {i for i in range(self.size) if model.is_control(i)}
        self.blank_first = {i for name, i in normal.items() if name.startswith(SPACE)}

        _, ranks = np.unique([-model.get_score(i) for i in range(self.size)], return_inverse=True)
        symbol = lambda part: normal.get(part, self.size + ord(part) if len(part) == 1 else None)
        pairs, beside = {}, set()
        for name, i in normal.items():
            beside.update(zip(name, name[1:]))
            for cut in range(1, len(name)):
                left, right = symbol(name[:cut]), symbol(name[cut:])
                if left is not None and right is not None:
                    pairs[left << 22 | right] = (ranks[i], i)
        self.tied = np.bincount(ranks[list(normal.values())], minlength=ranks.max() + 1) > 1
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int32)
        self.joined = np.array([pairs[k][1] for k in self.keys.tolist()], np.int32)
        self.pair = pairs
        self.beside = np.array(sorted(ord(a) << 21 | ord(b) for a, b in beside), np.int64)
        singles = sorted((ord(name), i) for name, i in normal.items() if len(name) == 1)
        self.chars, self.char_ids = np.array(singles, np.int64).T
        self.cache: dict[str, bytes] = {}

    def _symbols(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        return np.where(self.chars[at] == codes, self.char_ids[at], self.size + codes)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and joined piece of each pair; pairs without a piece have the rank ``_NONE``."""
        keys = left << 22 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], _NONE), self.joined[at]

    def queue(self, symbols: list[int]) -> list[int]:
        """One segment pair by pair: best score first, then the leftmost."""
        n = len(symbols)
        symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = []

        def offer(i):
            if i >= 0 and after[i] < n:
                key = symbols[i] << 22 | symbols[after[i]]
                if key in self.pair:
                    rank, joined = self.pair[key]
                    heapq.heappush(waiting, (rank, i, key, joined))

        for i in range(n - 1):
            offer(i)
        while waiting:
            _, i, key, joined = heapq.heappop(waiting)
            if symbols[i] is None or after[i] >= n or symbols[i] << 22 | symbols[after[i]] != key:
                continue  # one of the two has gone into another join
            gone = after[i]
            symbols[i], symbols[gone] = joined, None
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def rounds(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left when no pair of a segment can be joined, and the place of each; ``first`` marks where segments begin."""
        done_symbols, done_places, by_queue = [], [], []
        original, symbols, segment = symbols, symbols.copy(), np.cumsum(first) - 1
        bounds = np.append(np.flatnonzero(first), len(symbols))
        place = np.arange(len(symbols))
        rank = np.full(len(symbols), _NONE, np.int32)
        joined = np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(~first[1:])
        rank[inner], joined[inner] = self._pairs(symbols[inner], symbols[inner + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            over, tied = best == _NONE, np.zeros(len(starts), bool)
            tied[~over] = self.tied[best[~over]]
            if over.any() or tied.any():
                ended = np.repeat(over, sizes)
                done_symbols.append(symbols[ended])
                done_places.append(place[ended])
                by_queue.extend(segment[starts[tied]].tolist())
                stay = ~(ended | np.repeat(tied, sizes))
                symbols, place, rank, joined, segment = (x[stay] for x in (symbols, place, rank, joined, segment))
                kept = ~(over | tied)
                best, sizes = best[kept], sizes[kept]
                if not len(symbols):
                    break
            of_symbol = np.repeat(best, sizes)
            chosen = rank == of_symbol
            # Of places that overlap, every second one from the left.
            at = np.flatnonzero(chosen)
            run = np.append(True, np.diff(at) != 1)
            at = at[(np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
            symbols[at] = joined[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            symbols, place, rank, joined, segment, of_symbol = (x[stay] for x in (symbols, place, rank, joined, segment, of_symbol))
            fresh = moved[at]
            fresh = np.unique(np.concatenate((fresh, fresh[fresh > 0] - 1)))
            rank[fresh] = _NONE
            inner = fresh[fresh + 1 < len(symbols)]
            inner = inner[segment[inner] == segment[inner + 1]]
            rank[inner], joined[inner] = self._pairs(symbols[inner], symbols[inner + 1])
            better = inner[rank[inner] < of_symbol[inner]]
            if len(better):
                spoiled = np.unique(segment[better])
                by_queue.extend(spoiled.tolist())
                stay = ~np.isin(segment, spoiled)
                symbols, place, rank, joined, segment = (x[stay] for x in (symbols, place, rank, joined, segment))
        for s in by_queue:
            ids = self.queue(original[bounds[s]:bounds[s + 1]].tolist())
            done_symbols.append(np.array(ids, np.int64))
            done_places.append(bounds[s] + np.arange(len(ids)))
        if not done_symbols:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        symbols, place = np.concatenate(done_symbols), np.concatenate(done_places)
        order = np.argsort(place, kind="stable")
        return symbols[order], place[order]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as 32-bit numbers."""
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        codes = _codes("".join(words))
        first = np.ones(len(codes), bool)
        keys = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)
        first[1:] = self.beside[at] != keys
        first[ends[:-1]] = True
        symbols, place = self.rounds(self._symbols(codes), first)
        unknown = np.flatnonzero(symbols >= self.size)
        if len(unknown):
            spelled = [self.bytes[np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), np.uint8)] for c in (symbols[unknown] - self.size).tolist()]
            times = np.ones(len(symbols), np.int64)
            times[unknown] = [len(s) for s in spelled]
            symbols, place = np.repeat(symbols, times), np.repeat(place, times)
            symbols[symbols >= self.size] = np.concatenate(spelled)
        cuts = np.searchsorted(place, ends)
        ids = symbols.astype(np.int32)
        return [ids[a:b].tobytes() for a, b in zip(np.append(0, cuts[:-1]).tolist(), cuts.tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, its end id included."""
        words = [_WORD.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.cache) > _CACHED:
            self.cache.clear()
        known = self.cache
        unseen = list({w for found in words for w in found if w not in known})
        fresh = dict(zip(unseen, self.encode_words(unseen))) if unseen else {}
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= _CACHED_CHARS)
        long = {w: ids for w, ids in fresh.items() if len(w) > _CACHED_CHARS}
        end = np.int32(self.end).tobytes()
        look = (lambda w: known[w] if w in known else long[w]) if long else known.__getitem__
        return [np.frombuffer(b"".join(map(look, found)) + end, np.int32) for found in words]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the blank put in front goes, a byte that is no UTF-8 becomes U+FFFD; control ids are nothing, but end a run of bytes."""
        ids = ids.tolist()
        parts, part = [], []
        for i in ids if self.silent.intersection(ids[:-1]) else ():
            if i in self.silent:
                parts.append(part)
                part = []
            else:
                part.append(i)
        parts.append(part if parts else ids)
        text = "".join(b"".join(map(self.spelled.__getitem__, part)).decode("utf-8", "one_each") for part in parts)
        first = next((i for i in ids if i not in self.silent), None)
        return text[1:] if first in self.blank_first else text


def _pieces(path: str) -> Pieces:
    """The vocabulary, kept in a Python worker from task to task."""
    held = sys.modules.setdefault("_piece_models", types.ModuleType("_piece_models")).__dict__
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def model_path(model: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(model)


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", model: str | None = None) -> DataFrame:
    """The table with the ids of every text; ``model`` is a path that executors can read."""
    path = model or model_path()
    rest = [c for c in docs.columns if c not in (text, ids)]
    schema = StructType([f for f in docs.schema.fields if f.name in rest] + [StructField(ids, ArrayType(IntegerType()))])

    def run(frames):
        pieces = _pieces(path)
        for frame in frames:
            for chunk in _cut(frame, "__text"):
                found = pieces.encode([t or "" for t in chunk["__text"]])
                yield chunk.drop(columns="__text").assign(**{ids: found})

    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").cast("string").alias("__text")).mapInPandas(run, schema)


def _cut(frame: pd.DataFrame, text: str) -> Iterator[pd.DataFrame]:
    """Rows in order, in pieces of about ``CHUNK`` characters."""
    sizes = np.array([len(t) if t else 0 for t in frame[text]], np.int64)
    parts = np.cumsum(sizes) // CHUNK
    for _, piece in frame.groupby(parts, sort=True):
        yield piece


def decode(ids: Column, model: str | None = None) -> Column:
    """The text of a column of ids; NULL for NULL."""
    path = model or model_path()

    @F.pandas_udf("string")
    def run(found: pd.Series) -> pd.Series:
        pieces = _pieces(path)
        return pd.Series([None if x is None else pieces.decode(np.asarray(x)) for x in found], dtype=object)

    return run(ids)
