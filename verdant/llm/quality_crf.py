"""Quality classifier: a linear-chain conditional random field over lines.

Every non-blank line is good or bad.  A line's observations are its own surface
features and those of the lines before and after it; two-state transitions tie
neighbouring labels.  Forward-backward gives each line's marginal of being
good; their mean, weighted by line length, is the document's evidence, and a
logistic map fitted on the training documents turns it into the score.

Training uses a bounded sample of labelled documents (``MAX_DOCS``, the first by
a hash of their id): each line carries its document's label.  Fit, calibration
and scoring use whole texts.

Defined results: a null or empty text is one line without characters and gets
the score the model gives to that; repeated rows are scored each; with no
labels, or labels of one kind only, every score is that kind's share (0.5 if
there are none).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.llm.common import small_batches

MAX_DOCS = 4000
STEPS = 150
PIECE = 1 << 16

OWN = ("log_chars", "upper", "symbols", "digits", "unique_words", "repeats", "lone_symbols", "word_length",
       "ends_sentence", "short", "seen_before", "no_letters", "spaces", "lines",
       "many_repeats", "few_unique", "many_symbols", "mostly_upper")
WORD = re.compile(r"\w")


def _table() -> bytes:
    """Class of each code point, packed: 0 lower or other letter, 1 upper, 2 digit, 3 space, 4 symbol, 5 plain mark."""
    out = bytearray(0x110000)
    for i in range(0x110000):
        c = chr(i)
        out[i] = (1 if c.isupper() else 0 if c.isalpha() else 2 if c.isdigit() else 3 if c.isspace()
                  else 5 if c in PLAIN else 4)
    return zlib.compress(bytes(out))


# ASCII marks, and the same marks in full width as CJK texts have them
PLAIN = frozenset(".,;:'\"-()?" "\u3001\u3002\u300c\u300d\u300e\u300f\uff08\uff09\uff0c\uff0d\uff0e\uff1a\uff1b\uff1f")
CLASSES = _table()  # a few KB, so it travels with the functions


def _classes() -> np.ndarray:
    return np.frombuffer(zlib.decompress(CLASSES), np.uint8)


def _line_counts(line: str, classes: np.ndarray) -> np.ndarray:
    total = np.zeros(6, np.int64)
    for at in range(0, len(line), PIECE):
        c = np.frombuffer(line[at:at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
        total += np.bincount(classes[c], minlength=6)
    return total


def features(text: str, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, line lengths) of a text; never empty."""
    lines = [x for x in text.split("\n") if x.strip()] or [""]
    counts = np.array([_line_counts(x, classes) for x in lines], np.float64)
    size = np.array([len(x) for x in lines], np.float64)
    seen: Counter = Counter()
    rows = np.zeros((len(lines), len(OWN)))
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        rows[i, 4] = len(set(words)) / n if n else 1
        rows[i, 5] = sum(map(eq, words, words[1:])) / n if n else 0
        rows[i, 6] = sum(1 for w in words if len(w) == 1 and not w.isalnum()) / n if n else 0
        rows[i, 7] = min(3, (len(line) - n + 1) / n / 8) if n else 0
        rows[i, 8] = bool(line) and line.rstrip()[-1:] in ".?!:\"'"
        rows[i, 9] = n < 4
        rows[i, 10] = seen[line] > 0
        seen[line] += 1
    chars = np.maximum(1, size)
    letters = np.maximum(1, counts[:, 0] + counts[:, 1])
    rows[:, 0] = np.log1p(size) / 6
    rows[:, 1] = counts[:, 1] / letters
    rows[:, 2] = np.minimum(1, 5 * counts[:, 4] / chars)
    rows[:, 3] = counts[:, 2] / chars
    rows[:, 11] = (counts[:, 0] + counts[:, 1]) == 0
    rows[:, 12] = counts[:, 3] / chars
    rows[:, 13] = min(1.0, np.log1p(len(lines)) / 6)
    rows[:, 14] = rows[:, 5] > 0.2
    rows[:, 15] = rows[:, 4] < 0.4
    rows[:, 16] = counts[:, 4] / chars > 0.05
    rows[:, 17] = rows[:, 1] > 0.5
    return rows, size


def with_neighbours(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bias, own, previous and next line's features; ``first`` marks a document's first line."""
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    before[first] = 0
    after[:-1][first[1:]] = 0
    none_after = np.r_[first[1:], True]
    return np.hstack([np.ones((len(rows), 1)), rows, before, after, first[:, None], none_after[:, None]])


@dataclass
class Model:
    weights: np.ndarray      # of the unary log-odds of good
    transition: np.ndarray   # 2 x 2 log potentials
    slope: float
    offset: float

    def marginals(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return forward_backward(x @ self.weights, self.transition, lengths)[0]

    def scores(self, texts: list[str]) -> np.ndarray:
        classes = _classes()
        got = [features(t, classes) for t in texts]
        lengths = np.array([len(s) for _, s in got])
        first = np.zeros(lengths.sum(), bool)
        start = np.r_[0, np.cumsum(lengths)[:-1]]
        first[start] = True
        good = self.marginals(with_neighbours(np.vstack([r for r, _ in got]), first), lengths)
        return self.calibrated(evidence(good, np.concatenate([s for _, s in got]), start))

    def calibrated(self, share: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * _logit(share) + self.offset)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def evidence(good: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Mean marginal of each document, weighted by line length."""
    weight = np.maximum(size, 1)
    return np.add.reduceat(good * weight, start) / np.add.reduceat(weight, start)


def forward_backward(unary: np.ndarray, transition: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good by line, and the expected number of each transition.

    Chains run side by side, longest first, so a step touches only those still going.
    """
    order = np.argsort(-lengths, kind="stable")
    start = np.r_[0, np.cumsum(lengths)[:-1]][order]
    sizes = lengths[order]
    local = np.stack([np.zeros_like(unary), np.clip(unary, -40, 40)], axis=1)
    local = np.exp(local - local.max(axis=1, keepdims=True))
    trans = np.exp(transition)
    alpha, beta = np.empty_like(local), np.ones_like(local)
    longest = int(sizes[0]) if len(sizes) else 0
    going = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(longest + 1)]  # chains with more than t lines
    for t in range(longest):
        at = start[:going[t]] + t if t else start
        a = local[at] if t == 0 else (alpha[at - 1] @ trans) * local[at]
        alpha[at] = a / a.sum(axis=1, keepdims=True)
    expected = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = start[:going[t + 1]] + t
        nxt = local[at + 1] * beta[at + 1]
        b = nxt @ trans.T
        pair = alpha[at][:, :, None] * trans[None] * nxt[:, None, :]
        expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        beta[at] = b / b.sum(axis=1, keepdims=True)
    post = alpha * beta
    return post[:, 1] / post.sum(axis=1), expected


def train(docs: list[tuple[np.ndarray, np.ndarray, int]], steps: int = STEPS) -> Model:
    """Fit on (features, line lengths, label) of each document, by gradient ascent (Adam) on the log-likelihood."""
    labels = np.array([y for _, _, y in docs], float)
    width = 3 * len(OWN) + 3
    if len(set(labels)) < 2:
        share = labels.mean() if len(labels) else 0.5
        return Model(np.zeros(width), np.zeros((2, 2)), 0.0, float(_logit(np.array(share))))
    lengths = np.array([len(s) for _, s, _ in docs])
    start = np.r_[0, np.cumsum(lengths)[:-1]]
    first = np.zeros(lengths.sum(), bool)
    first[start] = True
    x = with_neighbours(np.vstack([r for r, _, _ in docs]), first)
    y = np.repeat(labels, lengths)
    # a document's lines count by length, documents alike
    seen = np.zeros((2, 2))
    for v, n in zip(labels.astype(int), lengths):
        seen[v, v] += n - 1
    theta = np.zeros(width + 4)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    scale = len(y)
    for i in range(1, steps + 1):
        good, expected = forward_backward(x @ theta[:width], theta[width:].reshape(2, 2), lengths)
        grad = np.r_[x.T @ (y - good), (seen - expected).ravel()] / scale - 1e-4 * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad * grad
        theta += 0.1 * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.999 ** i)) + 1e-8)
    model = Model(theta[:width], theta[width:].reshape(2, 2), 1.0, 0.0)
    good = model.marginals(x, lengths)
    z = _logit(evidence(good, np.concatenate([s for _, s, _ in docs]), start))
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps of the logistic map, slightly regularised
        p = _sigmoid(a * z + b)
        w = p * (1 - p) + 1e-6
        g = np.array([((labels - p) * z).sum() - 1e-2 * a, (labels - p).sum()])
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        a, b = np.array([a, b]) + np.clip(np.linalg.solve(h, g), -2, 2)
    return Model(model.weights, model.transition, float(max(a, 1e-3)), float(b))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_docs: int = MAX_DOCS) -> Model:
    """Learn from the labelled rows where ``learn`` (a column of ``labels``) holds."""
    small_batches(docs.sparkSession)
    known = (labels.filter(learn & F.col(label_col).isin(0, 1))
             .select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .orderBy(F.xxhash64("id"), "id", "label").limit(max_docs))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(known), rows["doc"] == known["id"])  # at most max_docs rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for b in batches:
            got = [features(t or "", classes) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(b["id"].to_pylist(), pa.int64()), b["label"],
                 pa.array([r.ravel() for r, _ in got], pa.list_(pa.float64())),
                 pa.array([s for _, s in got], pa.list_(pa.float64()))], ["id", "label", "rows", "size"])

    got = rows.withColumn("id", F.xxhash64("id")).select("id", "label", "text").mapInArrow(
        run, "id long, label int, rows array<double>, size array<double>").toArrow()
    got = got.take(pa.compute.sort_indices(got, [("id", "ascending"), ("label", "ascending")]))
    return train([(np.asarray(r.values).reshape(-1, len(OWN)), np.asarray(s.values), y) for r, s, y in
                  zip(got["rows"], got["size"], got["label"].to_pylist())])


def with_score(df: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """Every row of ``df`` and its score in column ``out`` (which replaces one of that name)."""
    small_batches(df.sparkSession)
    kept = [c for c in df.columns if c != out]
    rows = df.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                scores = model.scores([t or "" for t in b[text_col].to_pylist()])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores)], [*b.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())]))
