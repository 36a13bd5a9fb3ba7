"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A text is cut into pieces by the tokenizer's pattern.  The distinct pieces of a
block of rows form a small corpus of words, laid out one after the other as
byte symbols; an inverted index from rank to the positions where that pair
stands replays the merges, lowest rank first, over all words at once.  A merge
touches only its two neighbours: their new pairs enter the index.  A pair that
turns up with a lower rank than the one being replayed goes first, as it does
in the usual encoder.  Pieces already replayed are kept for the next blocks of
the task, up to ``KEPT`` of them, then forgotten.

The vocabulary is a rank file (base64 token, rank), read on the driver and
broadcast: its size is fixed.

Defined results: null and empty texts have no tokens; ids outside the
vocabulary can't be decoded and raise; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from verdant.llm.common import small_batches

KEPT = 250_000
BLOCK_BYTES, BLOCK_WORDS = 24 << 20, 120_000   # a block of rows ends at either
MANY = 48      # from so many places on, a merge is done in numpy


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def pair_ranks(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, rank): all pairs of tokens that join to a token, sorted by left << 32 | right."""
    keys, joined = [], []
    get = ranks.get
    for token, r in ranks.items():
        for i in range(1, len(token)):
            left = get(token[:i])
            if left is not None:
                right = get(token[i:])
                if right is not None:
                    keys.append(left << 32 | right)
                    joined.append(r)
    key = np.array(keys, np.int64)
    order = np.argsort(key)
    return key[order], np.array(joined, np.int64)[order]


class Replay:
    """Encodes sets of distinct words."""

    def __init__(self, ranks: dict[bytes, int], pairs: tuple[np.ndarray, np.ndarray] | None = None):
        self.ranks = ranks
        self.keys, self.joined = pairs or pair_ranks(ranks)
        self.pairs = dict(zip(self.keys.tolist(), self.joined.tolist()))
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = self._lookup(self.byte[:, None] << 32 | self.byte[None, :])

    def _lookup(self, key: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for those that make no token."""
        if not len(self.keys):
            return np.full(key.shape, -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at], -1)

    def encode(self, words: Iterable[str]) -> dict[str, list[int]]:
        """The ids of each distinct word."""
        out, rest, raw = {}, [], []
        for w in words:
            data = w.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            if whole is None:
                rest.append(w)
                raw.append(data)
            else:
                out[w] = [whole]
        out.update(zip(rest, self._replay(raw)))
        return out

    def _replay(self, raw: list[bytes]) -> list[list[int]]:
        sizes = np.array([len(x) for x in raw], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return [[] for _ in raw]
        # by position: its symbol (-1 once merged into its left neighbour), the next and
        # the previous symbol's position (-1: none), the rank of the pair that begins there
        n = len(data)
        tok, nxt, prv = self.byte[data], np.arange(1, n + 1), np.arange(-1, n - 1)
        nxt[ends[sizes > 0] - 1] = -1
        prv[(ends - sizes)[sizes > 0]] = -1
        at = np.full(n, -1)
        at[:-1] = self.byte_pairs[data[:-1], data[1:]]
        at[nxt < 0] = -1
        index: dict[int, list] = {}  # rank -> positions, single ones and arrays
        heap: list[int] = []

        def file(rank: np.ndarray, places: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            rank, places = rank[order], places[order]
            cuts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]]) if len(rank) else []
            for r, i, j in zip(rank[cuts].tolist() if len(rank) else (), cuts, [*cuts[1:], len(rank)]):
                spots = index.get(r)
                if spots is None:
                    spots = index[r] = []
                    heapq.heappush(heap, r)
                if j - i < MANY:
                    spots.extend(places[i:j].tolist())
                else:
                    spots.append(places[i:j])

        begun = np.flatnonzero(at >= 0)
        file(at[begun], begun)
        state = (tok, nxt, prv, at)
        views = tuple(memoryview(x) for x in state)
        while heap:
            rank = heapq.heappop(heap)
            spots = index.pop(rank, None)
            if spots is None:
                continue
            arrays = [x for x in spots if type(x) is not int]
            if arrays or len(spots) >= MANY:
                singles = np.array([x for x in spots if type(x) is int], np.int64)
                places = np.unique(np.concatenate([*arrays, singles]))
                if self._merge_all(rank, places, state, file):
                    continue
                spots = places.tolist()
            elif len(spots) > 1:
                spots.sort()
            self._merge_each(rank, spots, views, index, heap)
        alive = tok >= 0
        ids = tok[alive].tolist()
        upto = np.r_[0, np.cumsum(alive)][np.r_[0, ends]].tolist()
        return [ids[a:b] for a, b in zip(upto, upto[1:])]

    def _merge_all(self, rank: int, places: np.ndarray, state: tuple, file) -> bool:
        """Merge one rank at all its places at once; False, with nothing done, if the order
        of the merges may matter: places that touch, or a new pair of no higher rank."""
        tok, nxt, prv, at = state
        i = places[at[places] == rank]  # not where an earlier merge took one of the two
        j = nxt[i]
        follows, leads = nxt[j], prv[i]
        right, left = follows >= 0, leads >= 0
        if (at[j] == rank).any() or (at[follows[right]] == rank).any():
            return False
        new, other = np.full(len(i), -1), np.full(len(i), -1)
        new[right] = self._lookup(rank << 32 | tok[follows[right]])
        other[left] = self._lookup(tok[leads[left]] << 32 | rank)
        if ((new >= 0) & (new <= rank)).any() or ((other >= 0) & (other <= rank)).any():
            return False
        tok[i], tok[j], at[j] = rank, -1, -1
        nxt[i] = follows
        prv[follows[right]] = i[right]
        at[i] = new
        at[leads[left]] = other[left]
        up, down = new >= 0, other >= 0
        file(np.concatenate([new[up], other[down]]), np.concatenate([i[up], leads[down]]))
        return True

    def _merge_each(self, rank: int, places: list[int], views: tuple, index: dict, heap: list[int]) -> None:
        """Merge one rank place by place; stops for a new pair of lower rank and files the rest again."""
        tok, nxt, prv, at = views
        known, find, push, high = self.pairs.get, index.get, heapq.heappush, rank << 32
        for k, i in enumerate(places):
            if at[i] != rank:
                continue
            j = nxt[i]
            tok[i], tok[j], at[j] = rank, -1, -1
            follows = nxt[i] = nxt[j]
            new = other = -1
            if follows >= 0:
                prv[follows] = i
                new = known(high | tok[follows], -1)
                if new >= 0:
                    spots = find(new)
                    if spots is None:
                        index[new] = [i]
                        push(heap, new)
                    else:
                        spots.append(i)
            at[i] = new
            leads = prv[i]
            if leads >= 0:
                at[leads] = other = known(tok[leads] << 32 | rank, -1)
                if other >= 0:
                    spots = find(other)
                    if spots is None:
                        index[other] = [leads]
                        push(heap, other)
                    else:
                        spots.append(leads)
            if (0 <= new <= rank or 0 <= other <= rank) and k + 1 < len(places):
                index.setdefault(rank, []).extend(places[k + 1:])
                push(heap, rank)
                return


def _kept(df: DataFrame, out: str, keep: list[str] | None) -> list[str]:
    return [c for c in (df.columns if keep is None else keep) if c != out]


def _with(b: pa.RecordBatch, kept: list[str], out: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[b[c] for c in kept], values], [*kept, out])


def _schema(df: DataFrame, kept: list[str], out: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in kept], T.StructField(out, kind)])


def vocabulary(spark: SparkSession, path: str):
    """The rank file's content and its pairs as a broadcast variable."""
    ranks = read_ranks(path)
    return spark.sparkContext.broadcast((ranks, pair_ranks(ranks)))


class Pieces:
    """The pieces met so far in a task and, once replayed, their ids one after the other."""

    def __init__(self, replay: Replay):
        self.replay, self.place, self.waiting = replay, {}, []
        self.ids, self.starts, self.sizes = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def placed(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The numbers of each text's pieces; new pieces wait for the next replay."""
        place = self.place
        fresh = set().union(*texts).difference(place)
        place.update(zip(fresh, range(len(place), len(place) + len(fresh))))
        self.waiting.extend(fresh)
        return [np.fromiter(map(place.__getitem__, t), np.int64, len(t)) for t in texts]

    def settle(self) -> None:
        """Replay the merges over the pieces that wait."""
        if self.waiting:
            ids = self.replay.encode(self.waiting)
            lists = [ids[w] for w in self.waiting]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(lists), np.int32, sizes.sum())])
            self.waiting = []

    def encoded(self, which: np.ndarray) -> np.ndarray:
        """The ids of a text, given as the numbers of its pieces."""
        return _gathered(self.ids, self.starts, self.sizes, which)


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``values`` one after the other."""
    n = sizes[which]
    ends = np.cumsum(n)
    shift = np.repeat(starts[which] - (ends - n), n)
    return values[shift + np.arange(len(shift))]


def encode(df: DataFrame, ranks, pattern: str, text_col: str = "text", out: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """Every row of ``df``, its columns (or ``keep`` of them) and the ids of its text in column
    ``out``, which replaces one of that name; ``ranks`` comes from ``vocabulary``."""
    small_batches(df.sparkSession)
    kept = _kept(df, out, keep)
    df = df.select(*dict.fromkeys([*kept, text_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut, replay = regex.compile(pattern).findall, Replay(*ranks.value)

        def settled(block: list[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
            pieces.settle()
            for b, texts in block:
                flat = [pieces.encoded(t) for t in texts]
                offsets = np.r_[0, np.cumsum([len(x) for x in flat])].astype(np.int32)
                values = np.concatenate(flat) if flat else np.empty(0, np.int32)
                yield _with(b, kept, out, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))

        pieces, block, size = Pieces(replay), [], 0
        for b in batches:
            texts = pieces.placed([cut(t) if t else [] for t in b[text_col].to_pylist()])
            block.append((b.select(kept), texts))
            size += b.nbytes
            if size >= BLOCK_BYTES or len(pieces.waiting) >= BLOCK_WORDS:
                yield from settled(block)
                block, size = [], 0
                if len(pieces.place) > KEPT:
                    pieces = Pieces(replay)
        yield from settled(block)

    return df.mapInArrow(run, _schema(df, kept, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ranks, ids_col: str = "ids", out: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """Every row of ``df``, its columns (or ``keep`` of them) and the bytes of its ids in column ``out``."""
    small_batches(df.sparkSession)
    kept = _kept(df, out, keep)
    df = df.select(*dict.fromkeys([*kept, ids_col]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks.value[0]
        sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, r in vocabulary.items():
            sizes[r] = len(token)
        starts, order = np.cumsum(sizes) - sizes, sorted(vocabulary, key=vocabulary.get)
        table = np.frombuffer(b"".join(order), np.uint8)
        for b in batches:
            col = b[ids_col]
            flat, at = np.asarray(col.values), np.asarray(col.offsets)
            if len(flat) and (flat.min() < 0 or flat.max() >= len(sizes) or not sizes[flat].all()):
                raise ValueError("an id that the vocabulary doesn't have")
            # a null list has equal offsets, so it decodes to nothing
            done = [_gathered(table, starts, sizes, flat[i:j]).tobytes() for i, j in zip(at, at[1:])]
            yield _with(b, kept, out, pa.array(done, pa.binary()))

    return df.mapInArrow(run, _schema(df, kept, out, T.BinaryType()))
