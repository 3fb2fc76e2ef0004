"""Quality classifier: supervised subword embeddings, trained by stochastic gradient descent.

A document is a bag of words, word pairs and character n-grams (``GRAMS`` code points, a
word's ends included), hashed into ``2^BITS`` rows.  Of a word pair only its pattern
counts (does the word repeat the one before, or the one before that).  Its vector is the average of the learned rows of
all its occurrences plus one end token; a softmax over the two classes gives the score.

Training reads at most ``SAMPLE`` labelled documents (those of the smallest hashed ids),
shuffled per epoch by a fixed seed, in one task: the bag of a document is at most one
count per row, so that task's input is bounded by ``SAMPLE * 2^BITS`` counts.  As the
score is linear in the average, the model shrinks to one number per row (1 MB), which is
broadcast, and scoring a document of any length is one pass over its characters.

Only labels of documents outside the held-out fifth (crc32 of the id as text, modulo 5,
is 0) are learned from.  Inputs of a score are the characters of the text and nothing
else.  Null and empty texts hold only the end token.  Repeated labels of an id count once,
the smaller one; null labels and null ids teach nothing.  Without labels every score is
0.5.  A null id counts as the empty text in the fold, hence held out.  Empty tables give
empty results; input columns named like output columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import map_text, set_aside
from .tokens import range_hash

BITS = 18
GRAMS = (3, 4)
DIM = 8
EPOCHS = 6
RATE = 0.5
SAMPLE = 4000
FOLDS = 5
THRESHOLD = 0.3
END = 0  # row of the end token


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % FOLDS == 0


# ---- features ------------------------------------------------------------------------------------------------------

def _rows(h: np.ndarray, salt: int) -> np.ndarray:
    """Hash of 32 bits to a row; row 0 is the end token's."""
    h = (h ^ np.uint32(salt)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    h = h * np.uint32(0x85EBCA77)
    return np.maximum(h >> np.uint32(32 - BITS), 1)


def features(texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For every kind of feature: (rows in text order, first entry of every text, n + 1 of them)."""
    texts = [t or "" for t in texts]
    flat = np.frombuffer("".join([x for t in texts for x in (" ", t)] + [" "]).encode("utf-32-le"), np.uint32)
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    space = (flat == 32) | ((flat >= 9) & (flat <= 13))
    spaces = np.concatenate([[0], np.cumsum(space)])
    out = []
    edge = np.diff(space.astype(np.int8))
    start, end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    word = (range_hash(flat, start, end, 0) >> np.uint64(32)).astype(np.uint32)
    first = np.searchsorted(start, begin)
    out.append((_rows(word, 1), first))
    pattern = np.zeros(len(word), np.uint32)
    pattern[1:] += word[1:] == word[:-1]
    pattern[2:] += np.uint32(2) * (word[2:] == word[:-2])
    pattern[first[:-1][first[:-1] < len(word)]] = 0  # the first word of a text repeats nothing
    out.append((_rows(pattern, 2), first))
    h, chars = np.where(space, np.uint32(32), flat), np.where(space, np.uint32(32), flat)
    for n in range(2, max(GRAMS) + 1):
        h = h[:len(h) - 1] * np.uint32(0x01000193) + chars[n - 1:]
        if n in GRAMS:
            # no white space inside; the first and the last place may be a word's ends
            count = len(chars) - n + 1
            at = np.flatnonzero(spaces[n - 1:n - 1 + count] == spaces[1:1 + count])
            out.append((_rows(h[at], n), np.searchsorted(at, begin)))
    return out, len(texts)


def bags(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, counts) of every text, end token included."""
    kinds, n = features(texts)
    out = []
    for d in range(n):
        rows = np.concatenate([[END]] + [r[f[d]:f[d + 1]] for r, f in kinds])
        out.append(np.unique(rows, return_counts=True))
    return out


# ---- training ------------------------------------------------------------------------------------------------------

def train(examples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE) -> np.ndarray:
    """Weight of every row: its part of the difference between the two classes' logits."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim))
    output = np.zeros((dim, 2))
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            rows, counts, label = examples[i]
            share = counts / counts.sum()
            step = rate * (1 - done / steps)
            done += 1
            known = vectors[rows]
            hidden = share @ known
            logits = hidden @ output
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = output @ p
            output -= step * np.outer(hidden, p)
            # rows are averaged, their gradient is scaled by the number of rows to keep long documents teaching
            vectors[rows] = known - step * np.minimum(share * len(rows), 4.0)[:, None] * back
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text_col: str = "text",
        label_col: str = "quality") -> np.ndarray:
    """Learns from at most ``sample`` labelled documents outside the held-out fold."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.min(label_col).cast("int").alias("label")).orderBy(
        F.xxhash64("__id"), "__id").limit(sample)
    chosen = materialize(chosen, "quality-sample")
    rows = docs.select(F.col("doc_id").alias("__id"), F.col(text_col).alias("text")).join(chosen, "__id").select(
        F.xxhash64("__id").alias("place"), F.xxhash64("text").alias("tie"), "label", "text")
    fields = [T.StructField("rows", T.BinaryType()), T.StructField("counts", T.BinaryType())]

    def make():
        def run(texts):
            found = bags(texts)
            return [pa.array([r.astype(np.int32).tobytes() for r, _ in found], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary())]
        return run

    bagged = map_text(rows, "text", fields, make, keep=["place", "tie", "label"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = []
        for batch in batches:
            for row, count, label in zip(*(batch.column(c).to_pylist() for c in ("rows", "counts", "label"))):
                examples.append((np.frombuffer(row, np.int32), np.frombuffer(count, np.int32), label))
        if examples:
            yield pa.RecordBatch.from_arrays([pa.array([train(examples).tobytes()], pa.binary())], names=["weights"])

    model = bagged.orderBy("place", "tie", "label").limit(sample).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(bytes(model[0].weights), np.float32) if model else np.zeros(1 << BITS, np.float32)


# ---- scoring -------------------------------------------------------------------------------------------------------

def scores(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    kinds, n = features(texts)
    total, count = np.full(n, float(weights[END])), np.ones(n)
    for rows, first in kinds:
        upto = np.concatenate([[0.0], np.cumsum(weights[rows], dtype=np.float64)])
        total += upto[first[1:]] - upto[first[:-1]]
        count += np.diff(first)
    return 1 / (1 + np.exp(-np.clip(total / count, -500, 500)))


def score_quality(df: DataFrame, weights: np.ndarray, text_col: str = "text", keep=None) -> DataFrame:
    """``df`` with ``score``: the probability of label 1."""
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def make():
        def run(texts):
            return [pa.array(scores(texts, shared.value))]
        return run
    return map_text(df, text_col, [T.StructField("score", T.DoubleType())], make, keep=keep)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns for every document."""
    found = score_quality(docs.select("doc_id", "text"), fit(docs, labels), keep=["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score below ``threshold``."""
    plain, restore = set_aside(docs, ("score",))
    return restore(score_quality(plain, fit(docs, labels)).where(F.col("score") >= threshold))
