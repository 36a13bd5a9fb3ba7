"""Spelling variants: words one edit apart, found with FM-indexes of the vocabulary.

The vocabulary is counted over all texts.  Two words are near if one inserted,
deleted or replaced code point makes one the other.  Of a near pair, the edit
lies in one half of the longer word and the other half is found unchanged, so
the search scheme is: match a half exactly, then extend across the other one,
allowing one error.

* Index: the suffixes of all words of a shard, each closed by a delimiter, in
  order (equal suffixes by word).  A stretch of ranks, the *interval*, holds
  the places of a string; a step to the left maps it by the ranks of the
  preceding letters, two binary searches in the sorted (letter, rank) pairs.
* Both directions: an index of the words searches from right to left (second
  half exactly, error in the first), an index of the reversed words from left to
  right (first half exactly, error in the second).  No search turns around
  within a word, so an interval lives in one of the two at a time.
* Error steps: a replaced letter branches to every letter that precedes the
  interval; wide intervals by letter, narrow ones place by place.  A missing
  letter skips one of the longer word's.  Insertion is the same pair seen
  from its other word, so each pair is found once from each side.

Shards: words are dealt by (length searched, half, hash of the half that must match),
about ``SHARD`` words each, so a word is indexed and searched four times
whatever the vocabulary's size.  A shard with more than ``SPLIT`` words (many words
with one half) is dealt over blocks of its words by blocks of its searches.
Intervals are walked at most ``PLACES`` places at once.

Defined results: null texts have no words; a null document id reads as the empty
text in the hash; repeated rows count each; a word without near words has no
form and is its own root; ties of counts go to the word first in code points.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import ascii_lower, stored

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 5
LEAST_COUNT = 3
DROP_EVERY = 97     # one in so many occurrences loses a letter
OUTWEIGHS = 2       # a form is so many times as frequent as its variant
SHARD = 50_000
SPLIT = 100_000
PLACES = 1 << 21
SEARCHES = 1 << 15


# -- the vocabulary ---------------------------------------------------------------

def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = DROP_EVERY,
               least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): letter runs in lower case (A-Z only), one letter dropped from every
    ``drop_every``-th by hash of document and run, with their count over all texts."""
    # shorter runs can't grow, so only long ones are cut out
    runs = F.regexp_extract_all(docs[text_col].cast("string"), F.lit(f"[{LETTERS}]{{{least_letters},}}"), F.lit(0))
    rows = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("r"))
    rows = rows.select("id", ascii_lower(F.col("r")).alias("r"))
    rows = rows.select("r", F.crc32(F.concat_ws(":", "id", "r")).alias("h"))
    at = F.pmod(F.col("h"), F.length("r")).cast("int")
    less = F.concat(F.substring("r", 1, at), F.substr("r", at + 2))
    word = F.when(F.pmod(F.col("h"), F.lit(drop_every)) == 0, less).otherwise(F.col("r"))
    counted = rows.select(word.alias("word")).filter(F.length("word") >= least_letters).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


# -- the index ----------------------------------------------------------------------

class Index:
    """FM-index of n words of one length (a matrix of letter codes above 0)."""

    def __init__(self, words: np.ndarray):
        n, size = words.shape
        self.n, self.size = n, n * (size + 1)
        # text order: word 0 with its delimiter (0), word 1, ...
        text = np.concatenate([words, np.zeros((n, 1), words.dtype)], axis=1).ravel().astype(np.int64)
        rank = text.copy()
        step = 1
        while step <= size:  # by doubling; nothing is read past the delimiter, after which all are equal
            ahead = np.zeros(self.size, np.int64)
            ahead[:-step] = rank[step:]
            left = size - np.tile(np.arange(size + 1), n)  # letters before the delimiter
            ahead[left < step] = 0
            _, rank = np.unique(rank * (self.size + 256) + ahead, return_inverse=True)
            rank = np.where(text == 0, 0, rank + 1)
            step *= 2
        order = np.argsort(rank, kind="stable")  # equal suffixes by word
        before = np.r_[0, text[:-1]]             # a word's first letter stands after a delimiter
        self.before = before[order].astype(np.uint8)
        self.word = (order // (size + 1)).astype(np.int32)
        # sorted (letter, rank) pairs: the place of a pair among them is where a left step leads
        self.pairs = np.sort(self.before.astype(np.int64) * (self.size + 1) + np.arange(self.size))
        self.letters = np.unique(self.before[self.before > 0]).astype(np.int64)
        leads = np.argsort(self.before, kind="stable")
        self.leads = np.empty(self.size, np.int64)  # the left step of each single place
        self.leads[leads] = np.arange(self.size)

    def left(self, lo: np.ndarray, hi: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = letter.astype(np.int64) * (self.size + 1)
        return np.searchsorted(self.pairs, base + lo), np.searchsorted(self.pairs, base + hi)


def _pieces(cost: np.ndarray, most: int) -> list[np.ndarray]:
    """Positions in runs whose cost stays near ``most``."""
    if not len(cost):
        return []
    part = (np.cumsum(cost) - cost) // most
    cuts = np.flatnonzero(np.diff(part)) + 1
    return np.split(np.arange(len(cost)), cuts)


def _walk(index: Index, asked: np.ndarray, q: np.ndarray, at: np.ndarray, pos: int) -> tuple[np.ndarray, np.ndarray]:
    """Single places whose preceding letters are all the ``pos`` first of their search."""
    for p in range(pos - 1, -1, -1):
        ok = index.before[at] == asked[q, p]
        q, at = q[ok], index.leads[at[ok]]
    return q, index.word[at]


def _exact(index: Index, asked: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, pos: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """(search, word) of intervals whose preceding letters are the ``pos`` first of their search."""
    qs, found = [], []
    while True:
        narrow = hi - lo <= 4
        if pos == 0:
            narrow[:] = True
        for piece in _pieces((hi - lo)[narrow], PLACES):
            a, b, s = lo[narrow][piece], hi[narrow][piece], q[narrow][piece]
            places, owner = _places(a, b)
            x, w = _walk(index, asked, s[owner], places, pos)
            qs.append(x)
            found.append(w)
        q, lo, hi = q[~narrow], lo[~narrow], hi[~narrow]
        if not len(q):
            break
        pos -= 1
        lo, hi = index.left(lo, hi, asked[q, pos])
        some = hi > lo
        q, lo, hi = q[some], lo[some], hi[some]
    none = np.empty(0, np.int64)
    return np.concatenate([*qs, none]).astype(np.int64), np.concatenate([*found, none]).astype(np.int64)


def _places(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ranks of the intervals, and whose they are."""
    n = hi - lo
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[owner], owner


def _replaced(index: Index, asked: np.ndarray, q, lo, hi, pos: int) -> list:
    """Another letter than the search's at ``pos``, then the rest exactly."""
    out = []
    wide = hi - lo > 2 * len(index.letters)
    for piece in _pieces((hi - lo)[~wide], PLACES):
        places, owner = _places(lo[~wide][piece], hi[~wide][piece])
        s = q[~wide][piece][owner]
        other = (index.before[places] != asked[s, pos]) & (index.before[places] > 0)
        out.append(_walk(index, asked, s[other], index.leads[places[other]], pos))
    for piece in _pieces(np.full(wide.sum(), len(index.letters)), PLACES):
        s = np.repeat(q[wide][piece], len(index.letters))
        c = np.tile(index.letters, len(piece))
        a, b = index.left(np.repeat(lo[wide][piece], len(index.letters)), np.repeat(hi[wide][piece], len(index.letters)), c)
        some = (b > a) & (c != asked[s, pos])
        out.append(_exact(index, asked, s[some], a[some], b[some], pos))
    return out


def one_error(index: Index, asked: np.ndarray, cut: int, missing: bool, next_to: int = 1
              ) -> tuple[np.ndarray, np.ndarray]:
    """(search, word): the letters from ``cut`` on match exactly, and exactly one of the
    letters before it is another one (``missing``: is not there) in the word.

    Of equal letters in a row only one is left out: the one whose neighbour ``next_to``
    places on (1; -1 if the words are reversed) is another."""
    found, size = [], asked.shape[1]
    for a in range(0, len(asked), SEARCHES):
        q = np.arange(a, min(a + SEARCHES, len(asked)))
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), index.n, np.int64)
        for pos in range(size - 1, -1, -1):
            if pos < cut:
                if missing:
                    inside = 0 <= pos + next_to < size
                    one = asked[q, pos] != asked[q, pos + next_to] if inside else np.ones(len(q), bool)
                    found.append(_exact(index, asked, q[one], lo[one], hi[one], pos))
                else:
                    found += _replaced(index, asked, q, lo, hi, pos)
            lo, hi = index.left(lo, hi, asked[q, pos])
            some = hi > lo
            q, lo, hi = q[some], lo[some], hi[some]
    none = np.empty(0, np.int64)
    return (np.concatenate([*(x for x, _ in found), none]).astype(np.int64),
            np.concatenate([*(w for _, w in found), none]).astype(np.int64))


# -- the search over all words ---------------------------------------------------------

def _matrix(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _best(own: np.ndarray, other: np.ndarray, n: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each word of ``own`` how many others it met, and the most frequent of them
    (``of`` orders them by code points)."""
    order = np.lexsort((of[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)])
    return own[first], np.diff(np.r_[first, len(own)]), other[first]


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, met, best_n, best) by shard: how many near words of ``word`` (word, n) a
    shard holds, and the most frequent of them.  A pair is in one shard only."""
    total = vocab.count()
    buckets = max(1, math.ceil(total / SHARD))
    size = F.length("word")
    sides = []
    for role, longer in (("index", F.lit(0)), ("index", F.lit(1)), ("search", F.lit(0)), ("search", F.lit(1))):
        asked = size + longer if role == "index" else size     # length of the searching word
        head = F.floor(asked / 2).cast("int")
        for side, half in (("left", F.substr("word", F.lit(1), head)),
                           ("right", F.substr("word", size - (asked - head) + 1, asked - head))):
            sides.append(F.struct(
                F.lit(side).alias("side"), asked.alias("asked"), longer.alias("missing"), F.lit(role).alias("role"),
                F.pmod(F.xxhash64(half), F.lit(buckets)).alias("bucket")))
    rows = vocab.select("word", "n", F.explode(F.array(*sides)).alias("s")).select("word", "n", "s.*")
    rows = rows.filter((F.col("role") == "index") | (F.col("missing") == 0) | (size > LEAST_LETTERS))
    shard = ["side", "asked", "missing", "bucket"]
    # at most 8 * total / SPLIT shards are so large
    large = (rows.groupBy(*shard).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > SPLIT)
             .select(*shard, F.ceil(F.col("rows") / SPLIT).cast("int").alias("parts")))
    rows = rows.join(F.broadcast(large), shard, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("word", F.lit(1)), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    index = F.col("role") == "index"
    rows = (rows.withColumn("i", F.explode(F.when(index, F.array(own)).otherwise(every)))
            .withColumn("j", F.explode(F.when(index, every).otherwise(F.array(own)))))

    def search(group: pa.Table) -> pa.Table:
        is_index = np.asarray(group["role"].to_pylist()) == "index"
        words, n = group["word"].to_numpy(zero_copy_only=False), group["n"].to_numpy()
        out = {"word": [], "met": [], "best_n": [], "best": []}
        if is_index.any() and not is_index.all():
            missing, side = bool(group["missing"][0].as_py()), group["side"][0].as_py()
            mine, theirs = np.flatnonzero(is_index), np.flatnonzero(~is_index)
            indexed, asked = _matrix(list(words[mine])), _matrix(list(words[theirs]))
            length = asked.shape[1]
            cut = length // 2
            if side == "left":  # the first half matches: the same search on reversed words
                indexed, asked, cut = indexed[:, ::-1], asked[:, ::-1], length - cut
            a, b = one_error(Index(indexed), asked, cut, missing, -1 if side == "left" else 1)
            a, b = theirs[a], mine[b]
            of = np.empty(len(words), np.int64)
            of[np.argsort(words, kind="stable")] = np.arange(len(words))
            for own, other in [(a, b), (b, a)] if missing else [(a, b)]:
                w, met, best = _best(own, other, n, of)
                out["word"].append(words[w])
                out["met"].append(met)
                out["best_n"].append(n[best])
                out["best"].append(words[best])
        return pa.table({"word": pa.array(np.concatenate([*out["word"], np.empty(0, object)]), pa.string()),
                         "met": pa.array(np.concatenate([*out["met"], np.empty(0, np.int64)]), pa.int64()),
                         "best_n": pa.array(np.concatenate([*out["best_n"], np.empty(0, np.int64)]), pa.int64()),
                         "best": pa.array(np.concatenate([*out["best"], np.empty(0, object)]), pa.string())})

    return rows.groupBy(*shard, "i", "j").applyInArrow(search, "word string, met long, best_n long, best string")


# -- forms and roots -----------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last of their chain.  A form is more
    frequent than its word, so chains end; each round doubles what a word has followed."""
    state = stored(forms.select("word", F.col("form").alias("root")), "spell-roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(state.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spell-roots")
        state = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return state


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_every: int = DROP_EVERY) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    vocab = stored(vocabulary(docs, id_col, text_col, drop_every), "spell-words")
    near = (near_words(vocab).groupBy("word").agg(
        F.sum("met").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")))
    out = vocab.join(near, "word", "left")
    outweighs = -F.col("b.less") >= OUTWEIGHS * F.col("n")
    out = stored(out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                            F.when(outweighs, F.col("b.best")).alias("form"),
                            F.when(outweighs, -F.col("b.less")).alias("form_n")), "spell-forms")
    ends = roots(out.filter("form is not null"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                 "n", "n_near", "form_n")
