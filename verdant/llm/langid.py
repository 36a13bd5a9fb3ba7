"""Language identification with a string kernel.

Blended-spectrum presence kernel: a text is the set G of its character n-grams
of length 1 to 3 (lower case, white space runs as one blank; an n-gram is known
by its hash in 2^18 bins), and k(x, y) = |Gx n Gy| / sqrt(|Gx| |Gy|).  Nystroem
features over landmark texts, K(., L) K(L, L)^-1/2, feed one ridge regression
per language against the rest (targets +1 and -1).

Scoring is a batched product of the texts' presence rows with the landmark
side: since ((P L^T) K^-1/2) W = P (L^T (K^-1/2 W)), the right factor (bins x
languages) is multiplied out once when the model is fitted.

The fit uses a bounded sample: at most ``PER_LANGUAGE`` texts of each language,
the first by a hash of their id, ``LANDMARKS`` of them as landmarks (``MAX_LANDMARKS``
over all languages).  Features and their products are made in the tasks.

Defined results: null texts and texts without a letter are ``und`` with score 0,
as is every text when nothing could be learned; rows with a null language teach
nothing, as do rows with a null id; repeated rows are predicted each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.llm.common import forget, small_batches, stored

BINS = 1 << 18
PER_LANGUAGE = 300
LANDMARKS = 64
MAX_LANDMARKS = 1024
BLOCK = 1 << 14     # bins whose presence is unpacked at a time
PARTS = 16          # tasks that the sample's texts are dealt over
SALTS = 64
RIDGE = 1e-2
CHUNK = 1 << 20
UNKNOWN = "und"


def ngram_bins(text: str, flags: np.ndarray) -> np.ndarray:
    """The bins of a text's n-grams, sorted; ``flags`` is scratch (all False)."""
    text = " ".join(text.lower().split())
    for at in range(0, max(1, len(text)), CHUNK):  # whole texts, a piece at a time
        c = np.frombuffer(text[at:at + CHUNK + 2].encode("utf-32-le", "surrogatepass"), np.uint32)
        one = c * np.uint32(2654435761)
        flags[one >> np.uint32(14)] = True
        if len(c) > 1:
            two = (one[:-1] ^ (c[1:] * np.uint32(2246822519))) * np.uint32(3266489917)
            flags[two >> np.uint32(14)] = True
        if len(c) > 2:
            three = (two[:-1] ^ (c[2:] * np.uint32(668265263))) * np.uint32(374761393)
            flags[three >> np.uint32(14)] = True
    bins = np.flatnonzero(flags)
    flags[bins] = False
    return bins


@dataclass
class Model:
    languages: list[str]
    bins: np.ndarray    # bins that any landmark has, sorted
    weights: np.ndarray  # len(bins) x languages

    def scores(self, texts: list[str]) -> np.ndarray:
        flags, out = np.zeros(BINS, bool), np.zeros((len(texts), len(self.languages)))
        at = np.full(BINS, -1, np.int64)
        at[self.bins] = np.arange(len(self.bins))
        for a in range(0, len(texts), 64):
            block = [ngram_bins(t, flags) for t in texts[a:a + 64]]
            presence = np.zeros((len(block), len(self.bins)), np.float32)
            for i, bins in enumerate(block):
                known = at[bins]
                presence[i, known[known >= 0]] = 1 / np.sqrt(max(1, len(bins)))
            out[a:a + 64] = presence @ self.weights
        return out


class Landmarks:
    """Landmark texts by the packed bits of their bins (``BINS`` / 8 bytes each, however long the text)."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.norm = 1 / np.sqrt(np.maximum(1, np.bitwise_count(bits).sum(axis=1))).astype(np.float32)
        same = np.zeros((len(bits), len(bits)))
        for at in range(0, BINS, BLOCK):
            land = self.block(at)
            same += land @ land.T
        value, vector = np.linalg.eigh(same)
        keep = value > 1e-6 * value.max()
        self.half = vector[:, keep] / np.sqrt(value[keep])      # K(L, L)^-1/2

    def block(self, at: int) -> np.ndarray:
        """Presence rows of the bins from ``at`` on, a block of them."""
        return np.unpackbits(self.bits[:, at // 8:(at + BLOCK) // 8], axis=1) * self.norm[:, None]

    def features(self, texts: list[np.ndarray]) -> np.ndarray:
        """Nystroem features K(., L) K(L, L)^-1/2 of texts given by their sorted bins."""
        kernel = np.zeros((len(texts), len(self.bits)))
        for at in range(0, BINS, BLOCK):
            rows = np.zeros((len(texts), BLOCK), np.float32)
            for r, bins in enumerate(texts):
                lo, hi = np.searchsorted(bins, (at, at + BLOCK))
                rows[r, bins[lo:hi] - at] = 1 / np.sqrt(max(1, len(bins)))
            kernel += rows @ self.block(at).T
        return kernel @ self.half

    def sums(self, texts: list[np.ndarray], languages: list[str], names: list[str], weight: dict[str, float]) -> np.ndarray:
        """What the regression needs of these texts: features x (features, then languages), weighted."""
        out = np.zeros((self.half.shape[1], self.half.shape[1] + len(names)))
        for a in range(0, len(texts), 64):
            f = self.features(texts[a:a + 64])
            part = np.array(languages[a:a + 64])
            target = np.where(part[:, None] == np.array(names)[None, :], 1.0, -1.0)
            out += (f * np.array([weight[x] for x in part])[:, None]).T @ np.hstack([f, target])
        return out

    def solve(self, sums: np.ndarray, names: list[str], ridge: float) -> Model:
        """Ridge regression from the sums of all texts, multiplied out to a weight by bin and language."""
        n = self.half.shape[1]
        side = self.half @ np.linalg.solve(sums[:, :n] + ridge * np.eye(n), sums[:, n:])
        known, weights = [], []
        for at in range(0, BINS, BLOCK):
            land = self.block(at)
            seen = np.flatnonzero(land.any(axis=0))
            known.append(seen + at)
            weights.append((land[:, seen].T @ side).astype(np.float32))
        return Model(names, np.concatenate(known), np.vstack(weights))


def packed(bins: np.ndarray) -> np.ndarray:
    flags = np.zeros(BINS, bool)
    flags[bins] = True
    return np.packbits(flags)


def marked(languages: list[str], landmarks: int = LANDMARKS) -> np.ndarray:
    """Which of the texts are landmarks: the first of each language, ``MAX_LANDMARKS`` in all
    (but one of each language at least)."""
    per = min(landmarks, max(1, MAX_LANDMARKS // max(1, len(set(languages)))))
    seen: Counter = Counter()
    out = np.zeros(len(languages), bool)
    for i, name in enumerate(languages):
        out[i] = seen[name] < per
        seen[name] += 1
    return out


NOTHING = (np.empty(0, np.int64), np.zeros((0, 0), np.float32))


def train(bins: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on texts given by their bins, in one process."""
    if not bins:
        return Model([], *NOTHING)
    names, counts = sorted(set(languages)), Counter(languages)
    land = Landmarks(np.stack([packed(bins[i]) for i in np.flatnonzero(marked(languages, landmarks))]))
    return land.solve(land.sums(bins, languages, names, {x: 1 / n for x, n in counts.items()}), names, ridge)


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Learn from the rows where ``learn`` holds and the language isn't null.

    The tasks turn the sampled texts into features and add up their products; the driver
    holds the sample's ids, the landmarks' bits and the sums, none of which grow with the
    texts.  Of rows that share id and language the smallest text is learned from."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = (docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    # the first of each language among the first of its parts, so no task ranks them all
    rank = Window.partitionBy("lang").orderBy("order", "id")
    part = Window.partitionBy("lang", F.pmod("order", F.lit(SALTS))).orderBy("order", "id")
    ids = (rows.filter(F.col("id").isNotNull()).select("id", "lang", F.xxhash64("id").alias("order"))
           .withColumn("n", F.row_number().over(part)).filter(F.col("n") <= per_language)
           .withColumn("n", F.row_number().over(rank)).filter(F.col("n") <= per_language)
           .select("id", F.col("lang").alias("learned"), "order").distinct())
    chosen = sorted(ids.collect(), key=lambda r: (r.learned, r.order, str(r.id)))  # at most per_language a language
    if not chosen:
        return Model([], *NOTHING)
    languages = [r.learned for r in chosen]
    names, counts = sorted(set(languages)), Counter(languages)
    weight = {x: 1 / n for x, n in counts.items()}
    marks = marked(languages, landmarks)
    sample = spark.createDataFrame([(*r, i if m else None) for i, (r, m) in enumerate(zip(chosen, marks))],
                                   T.StructType([*ids.schema.fields, T.StructField("mark", T.LongType())]))
    texts = (rows.join(F.broadcast(sample), (rows["id"] == sample["id"]) & (rows["lang"] == sample["learned"]))
             .groupBy(sample["id"], "learned", "mark").agg(F.min("text").alias("text")))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(BINS, bool)
        for b in batches:
            found = [packed(ngram_bins(t, flags)).tobytes() for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["learned"], b["mark"], pa.array(found, pa.binary())], ["learned", "mark", "bits"])

    kept = stored(texts.repartition(PARTS, F.xxhash64("id")).mapInArrow(bins, "learned string, mark long, bits binary"),
                  "langid-sample")
    first = kept.filter(F.col("mark").isNotNull()).orderBy("mark").select("bits").collect()  # MAX_LANDMARKS or a language each
    land = Landmarks(np.stack([np.frombuffer(r.bits, np.uint8) for r in first]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                got = [np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8))) for x in b["bits"].to_pylist()]
                mine = land.sums(got, b["learned"].to_pylist(), names, weight)
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    shape = (land.half.shape[1], land.half.shape[1] + len(names))
    total = np.zeros(shape)
    for r in kept.select("learned", "bits").mapInArrow(sums, "sums binary").toLocalIterator():
        total += np.frombuffer(r.sums).reshape(shape)
    forget(kept)
    return land.solve(total, names, ridge)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            letters = np.array(b["letters"].to_pylist(), bool) & bool(model.languages)
            texts = [t for t, ok in zip(b["text"].to_pylist(), letters) if ok]
            names, sure = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            if texts:
                margins = model.scores(texts)
                best = margins.argmax(axis=1)
                names[letters] = np.array(model.languages, object)[best]
                sure[letters] = np.clip((margins.max(axis=1) + 1) / 2, 0, 1)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(names, pa.string()), pa.array(sure)],
                                             ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
