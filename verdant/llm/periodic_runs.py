"""Periodic runs of words, found with string synchronising sets.

A run is a maximal stretch of consecutive words that has a smallest period q
and at least 2q words.  Texts of a block are laid end to end as numbers, equal
within a text and never across texts, and all of them are worked on at once.

* Names: ``names[k][i]`` numbers the 2^k words from i on (by ranking pairs of
  names of half the length, so equal numbers are equal words, not equal
  hashes).  A stretch found only once in its text has no name and drops out.
* Synchronising set of scale t = 2^k: of the stretches of t words that begin in
  [i, i + t], without those of a period up to t / 3, the one whose hashed name is
  least must begin at i or at i + t; then i is in the set.  Whether it is depends
  on the 2t words from i on alone, so positions with equal contexts agree.
* Proposals: two positions of the set with the same context of 2t words, q apart
  for 3t - 1 <= q < 6t - 1.  A run of that period has t positions whose contexts
  recur q further on, and one of them is in the set, unless that part of the
  run has a period p up to t / 3.
* Highly periodic regions: runs of such a p are known from the smaller scales.  A
  run of period q that they hide has its first q words in one region and
  the next q in a second one of the same period that begins where the first ends,
  or before; shifts that bring their phases together propose q.
* Small periods, up to ``SMALL``, are found by comparing each word with the q-th
  after it.

Each proposal (i, i + q) is extended to both sides by the names, longest first,
which gives the run's borders; equal borders keep the smallest period.  So the
runs are exact; hashing decides where it is looked, not what is found.

Memory: 12 bytes and less for each word and scale in use, in blocks of
``BLOCK_WORDS`` words; a longer text is a block of its own.

Defined results: null and empty texts and texts without words have no runs and
the empty text; repeated rows are read each; null ids keep their words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import small_batches

SMALL = 4
LEAST_WORDS = 12
BLOCK_WORDS = 400_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(1)


NO_HASH = np.uint64((1 << 64) - 1)


class Block:
    """Texts end to end: word numbers, each text's own; ``end[i]`` ends the text of word i."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.r_[0, np.cumsum(sizes)]
        self.n = int(self.starts[-1])
        self.text = np.repeat(np.arange(len(texts)), sizes)
        flat = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)
        self.names: list[np.ndarray] = []
        self.recurring: int | None = None
        # the number of a word in its text; words alone in their text have none
        self._append(self.text * (flat.max(initial=0) + 1) + flat)

    def _append(self, keys: np.ndarray) -> None:
        self.names.append(self._named(keys))
        if self.recurring is None and not (self.names[-1] >= 0).any():
            self.recurring = len(self.names) - 1

    @staticmethod
    def _named(keys: np.ndarray) -> np.ndarray:
        """Numbers for keys (-1: none) that are there twice or more; -1 for all others."""
        out = np.full(len(keys), -1, np.int32)
        at = np.flatnonzero(keys >= 0)
        if len(at):
            order = at[np.argsort(keys[at], kind="stable")]
            k = keys[order]
            first = np.r_[True, k[1:] != k[:-1]]
            size = np.diff(np.r_[np.flatnonzero(first), len(k)])
            rank = np.cumsum(first) - 1
            out[order] = np.where(size[rank] > 1, rank, -1)
        return out

    def name(self, k: int) -> np.ndarray:
        """Names of the stretches of 2^k words (of none, once no stretch recurs)."""
        while len(self.names) <= k:
            half, step = self.names[-1], 1 << (len(self.names) - 1)
            keys = np.full(self.n, -1, np.int64)
            if step < self.n:
                a, b = half[:-step], half[step:]
                keys[:-step] = np.where((a >= 0) & (b >= 0), a.astype(np.int64) * self.n + b, -1)
            self._append(keys)
        return self.names[k]

    def levels(self) -> int:
        """How many lengths 2^k recur at all."""
        while self.recurring is None:
            self.name(len(self.names))
        return self.recurring

    def common(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words agree from a and b on (``back``: that end before a and b)."""
        a, b, n = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for k in range(self.levels() - 1, -1, -1):
            name, step = self.name(k), 1 << k
            while True:  # more than once only at the longest named length
                x, y = (a - step, b - step) if back else (a, b)
                ok = (x >= 0) & (x < self.n) & (y >= 0) & (y < self.n)
                u, v = name[np.where(ok, x, 0)], name[np.where(ok, y, 0)]
                ok &= (u == v) & (u >= 0)
                if not ok.any():
                    break
                move = np.where(ok, -step if back else step, 0)
                a, b, n = a + move, b + move, n + np.where(ok, step, 0)
                if k < self.levels() - 1:
                    break
        return n


class Found:
    """Runs so far: start, end, period; one a pair of borders, the smallest period."""

    def __init__(self):
        self.start = self.end = self.period = np.empty(0, np.int64)

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        s, e, q = (np.concatenate(x) for x in ((self.start, start), (self.end, end), (self.period, period)))
        keep = e - s >= 2 * q
        s, e, q = s[keep], e[keep], q[keep]
        order = np.lexsort((q, e, s))
        s, e, q = s[order], e[order], q[order]
        first = np.r_[True, (s[1:] != s[:-1]) | (e[1:] != e[:-1])][:len(s)]
        self.start, self.end, self.period = s[first], e[first], q[first]


def _small_periods(block: Block, found: Found) -> None:
    word = block.name(0)
    for q in range(1, SMALL + 1):
        if q >= block.n:
            break
        same = (word[:-q] == word[q:]) & (word[:-q] >= 0)
        edge = np.diff(np.r_[False, same, False].astype(np.int8))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        found.add(a, b + q, np.full(len(a), q))


def _extended(block: Block, found: Found, i: np.ndarray, q: np.ndarray) -> None:
    """Add the runs that proposals (i, i + q) lie in."""
    if len(i):
        pairs = np.unique(np.stack([q, i], axis=1), axis=0)
        q, i = pairs[:, 0], pairs[:, 1]
        found.add(i - block.common(i, i + q, back=True), i + q + block.common(i, i + q), q)


def _spans(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each of n positions lies in any [start, end)."""
    depth = np.zeros(n + 1, np.int64)
    ok = end > start
    np.add.at(depth, start[ok], 1)
    np.add.at(depth, end[ok], -1)
    return np.cumsum(depth)[:n] > 0


def synchronising_set(block: Block, k: int, found: Found) -> np.ndarray:
    """The positions of scale 2^k whose context of 2^(k+1) words recurs in their text."""
    t, n = 1 << k, block.n
    name, context = block.name(k), block.name(k + 1)
    known = found.period <= t // 3
    dull = _spans(n, found.start[known], found.end[known] - t + 1)
    hashed = np.where((name < 0) | dull, NO_HASH, _mix(name))
    least = hashed  # over t + 1 starts, by doubling
    for j in range(k):
        step = 1 << j
        least = np.minimum(least, np.r_[least[step:], np.full(min(step, n), NO_HASH)][:n])
    far = np.r_[hashed[t:], np.full(min(t, n), NO_HASH)][:n]
    least = np.minimum(least, far)
    return np.flatnonzero((context >= 0) & (least != NO_HASH) & ((least == hashed) | (least == far)))


def _anchored(block: Block, k: int, found: Found) -> tuple[np.ndarray, np.ndarray]:
    """Proposals from equal contexts, 3t - 1 <= q <= 6t - 2."""
    t = 1 << k
    at = synchronising_set(block, k, found)
    at = at[np.lexsort((at, block.name(k + 1)[at]))]
    names = block.name(k + 1)[at]
    is_, qs, step = [], [], 1
    while step < len(at):  # equal contexts are more than t / 3 apart, so this ends soon
        apart = at[step:] - at[:-step]
        near = (names[step:] == names[:-step]) & (apart <= 6 * t - 2)
        if not near.any():
            break
        take = near & (apart >= 3 * t - 1)
        is_.append(at[:-step][take])
        qs.append(apart[take])
        step += 1
    return np.concatenate([*is_, np.empty(0, np.int64)]), np.concatenate([*qs, np.empty(0, np.int64)])


def _between_regions(block: Block, k: int, found: Found) -> tuple[np.ndarray, np.ndarray]:
    """Proposals from two highly periodic regions, the second beginning no later than the first ends."""
    t = 1 << k
    big = (found.period <= t // 3) & (found.end - found.start >= 3 * t - 1)
    a, b, p = found.start[big], found.end[big], found.period[big]
    order = np.lexsort((a, p))
    a, b, p = a[order], b[order], p[order]
    is_, qs = [], []
    for j in np.flatnonzero((p[1:] == p[:-1]) & (a[1:] <= b[:-1])):
        (a1, b1), (a2, b2), per = (a[j], b[j]), (a[j + 1], b[j + 1]), p[j]
        # the phase in the second region in which it reads as the last period of the first
        shift = a2 + np.arange(per)
        same = shift[block.common(np.full(per, b1 - per), shift) >= per]
        for y in same:
            q = (y - (b1 - per)) % per
            q = q + per * np.arange(max(0, -(-(3 * t - 1 - q) // per)), (6 * t - 2 - q) // per + 1)
            i = np.maximum(a1, a2 - q)
            ok = (np.minimum(b1, b2 - q) - i >= q) & (q > 0)
            is_.append(i[ok])
            qs.append(q[ok])
    return np.concatenate([*is_, np.empty(0, np.int64)]), np.concatenate([*qs, np.empty(0, np.int64)])


def runs_of(texts: list[np.ndarray], least_words: int = LEAST_WORDS) -> list[np.ndarray]:
    """For each text (word numbers) its runs as rows (start, length, period), by start and period."""
    block, found = Block(texts), Found()
    _small_periods(block, found)
    k = 1
    while k < block.levels():  # a run of period q has contexts of 2t < q words that recur
        for propose in (_anchored, _between_regions):
            _extended(block, found, *propose(block, k, found))
        k += 1
    keep = found.end - found.start >= least_words
    start, end, period = found.start[keep], found.end[keep], found.period[keep]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    cuts = np.searchsorted(start, block.starts)
    return [np.stack([start[x:y] - s, end[x:y] - start[x:y], period[x:y]], axis=1)
            for x, y, s in zip(cuts, cuts[1:], block.starts)]


def without_repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """The word numbers that are in no run after its first period."""
    return np.flatnonzero(~_spans(n, runs[:, 0] + runs[:, 2], runs[:, 0] + runs[:, 1]))


Reading = Callable[[object, int], "np.ndarray | None"]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reading: Reading | None = None,
              least_words: int = LEAST_WORDS) -> DataFrame:
    """Per row of ``docs``: its id, n_words, runs (array of start, length, period, by start and
    period) and collapsed, the text's words without the repeats, joined by one blank.

    ``reading(id, n)`` may give the order in which the n words of a text are read."""
    small_batches(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def solved(ids: list, held: list[list[bytes]], orders: list) -> Iterator[pa.RecordBatch]:
        numbers: dict[bytes, int] = {}
        coded = []
        for ws, order in zip(held, orders):
            own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws))
            coded.append(own if order is None else own[order])
        found = runs_of(coded, least_words)
        kept = []
        for ws, order, runs in zip(held, orders, found):
            left = without_repeats(len(ws), runs) if len(runs) else None
            if order is not None:
                left = order if left is None else order[left]
            kept.append(b" ".join(ws if left is None else [ws[i] for i in left]).decode("utf-8", "replace"))
        flat = np.concatenate([*found, np.empty((0, 3), np.int64)])
        offsets = np.r_[0, np.cumsum([len(r) for r in found])].astype(np.int32)
        parts = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array([len(ws) for ws in held], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets), parts).cast(spans), pa.array(kept, pa.string())],
            ["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, held, orders, size = [], [], [], 0
            for i, text in zip(b["id"], b["text"].to_pylist()):
                # bytes part words by ASCII blanks alone, which is what the words are
                ws = text.encode("utf-8", "replace").split() if text else []
                if held and size + len(ws) > BLOCK_WORDS:
                    yield from solved(ids, held, orders)
                    ids, held, orders, size = [], [], [], 0
                ids.append(i)
                held.append(ws)
                orders.append(reading(i.as_py(), len(ws)) if reading and ws else None)
                size += len(ws)
            if held:
                yield from solved(ids, held, orders)

    return rows.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def longest(runs):
    """The run of greatest length (ties: smallest start, then period); null without runs."""
    best = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                            r["period"].alias("period"))))
    return F.when(best.isNotNull(), F.struct(best["start"].alias("start"), (-best["less"]).alias("length"),
                                             best["period"].alias("period")))
