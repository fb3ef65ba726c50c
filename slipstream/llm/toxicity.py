"""Toxicity from confirmed toxic texts and unlabelled ones.

A linear model over hashed word presence is trained in numpy on the non-negative risk of
positive-unlabelled learning: with the share ``prior`` of toxic texts, the risk of the negative
class is the risk of unlabelled texts as negatives less ``prior`` times that of the toxic ones,
and a batch on which it falls below zero is followed backwards instead.

Training rows are a documented, bounded sample: at most ``max_positive`` confirmed toxic texts and
``max_unlabelled`` others, the first ones in the order of a hash of id and text. Their words are
hashed on the executors; the driver gets numbers only. The weights (``2 ** BITS`` floats) go to the tasks
with the function. Scoring sees whole texts and no other column.

Null and empty texts have no words and get the model's bias; an empty table gives no rows, and rows
without an id are scored but not learned from. Scores do not depend on the order of
rows; rows with equal texts get equal scores. Labels that are null or belong to no text are not
used; without any confirmed toxic text all scores are 0. Columns of the input pass through; those
called ``score`` or ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipstream.llm.common import importable, text_key, words_of

BITS = 18
# Texts whose words are worked through at once.
PIECE = 4_096


def features(text: str | None) -> np.ndarray:
    """Distinct word numbers of a text: words lower-cased, without marks at their ends."""
    if not text:
        return np.empty(0, np.int64)
    words = {w.strip(b".,;:!?\"'()[]") for w in words_of(text.lower())}
    words.discard(b"")
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return np.unique(found >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    """Weights per word number and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, words: np.ndarray) -> float:
        z = self.bias + float(self.weights[words].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


@dataclass
class Sample:
    """Word numbers of the sampled texts, one after the other, the ``toxic`` confirmed ones first."""

    flat: np.ndarray
    ends: np.ndarray
    toxic: int

    @classmethod
    def of(cls, positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> "Sample":
        rows = [*positive, *unlabelled]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return cls(np.concatenate(rows).astype(np.int32), np.cumsum(sizes), len(positive))

    def pieces(self) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Texts, their words, and each word's text within the piece: a few texts at a time."""
        for at in range(0, len(self.ends), PIECE):
            texts = slice(at, min(at + PIECE, len(self.ends)))
            starts = np.r_[self.ends[at - 1] if at else 0, self.ends[texts]]
            yield texts, slice(starts[0], starts[-1]), np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def risk_slopes(z: np.ndarray, toxic: int, prior: float) -> np.ndarray:
    """Slopes of the non-negative risk by the scores, of the ``toxic`` first texts and of all others.

    With l(z) = log(1 + exp(z)), the loss of a text as a negative, the negative risk is the mean l of
    the unlabelled less ``prior`` times that of the toxic ones. If it is not below zero, the slope is
    that of the whole risk, l of negatives plus l(-z) of positives; else that of its opposite.
    """
    p, loss = 1 / (1 + np.exp(-np.clip(z, -30, 30))), np.logaddexp(0, z)
    others = len(z) - toxic
    if loss[toxic:].mean() >= prior * loss[:toxic].mean():
        # Slopes of l(z) and l(-z) are p and p - 1; on toxic texts prior * (p - 1 - p) is left.
        return np.r_[np.full(toxic, -prior / toxic), p[toxic:] / others]
    return np.r_[prior * p[:toxic] / toxic, -p[toxic:] / others]


def fit(
    sample: Sample, prior: float, least: int = 3, steps: int = 300, rate: float = 0.05, decay: float = 1e-3,
) -> Model:
    """Minimise the non-negative risk with Adam over full batches of the sample.

    A word counts if at least ``least`` toxic texts have it; its value is the log ratio of its shares
    among toxic and unlabelled texts, so that telling words move first. Because the risk is kept
    above zero, few texts get past 0.5; the bias moves halfway to where the share of toxic unlabelled
    texts is the prior.
    """
    size, many, n = 1 << BITS, len(sample.ends), sample.toxic
    cut = int(sample.ends[n - 1])
    toxic = np.bincount(sample.flat[:cut], minlength=size)
    other = np.bincount(sample.flat[cut:], minlength=size)
    scale = np.log((toxic + 1) / (n + 2)) - np.log((other + 1) / (many - n + 2))
    scale[toxic < least] = 0
    # Words that count nothing go, and so does their place in memory.
    counted = scale[sample.flat] != 0
    left = np.r_[0, np.cumsum(counted, dtype=np.int64)]
    sample = Sample(sample.flat[counted], left[sample.ends], n)
    del counted, left, toxic, other

    def scores(weights: np.ndarray, bias: float) -> np.ndarray:
        z = np.empty(many)
        for texts, words, row in sample.pieces():
            z[texts] = np.bincount(row, weights[sample.flat[words]], texts.stop - texts.start) + bias
        return z

    w = np.zeros(size + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        slope = risk_slopes(scores(w[:-1] * scale, w[-1]), n, prior)
        grad = np.zeros(size + 1)
        for texts, words, row in sample.pieces():
            grad[:-1] += np.bincount(sample.flat[words], slope[texts][row], size)
        grad[:-1] = grad[:-1] * scale + decay * w[:-1]
        grad[-1] = slope.sum()
        mean += 0.1 * (grad - mean)
        square += 0.001 * (grad ** 2 - square)
        w -= rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    z = scores(w[:-1] * scale, w[-1])[n:]
    return Model((w[:-1] * scale).astype(np.float32), float(w[-1] - np.quantile(z, 1 - prior) / 2))


def held_out(column: str = "doc_id"):
    """Rows that no model learns from: a fifth by the checksum of the id as text."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, max_positive: int = 4_000, max_unlabelled: int = 12_000,
) -> Model:
    """Fit on rows that are not held out.

    The class prior is the share of toxic ones among all labels that may be used. Unlabelled rows
    are texts whatever their label, which is not looked at.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    may = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", text_key().alias("key"), "text")
    order = [F.xxhash64(F.lit(1), "doc_id", "key"), "doc_id", "key"]
    # Ids and text keys first, texts only for the chosen ones; both samples are bounded by the
    # parameters, also where rows share an id or are repeated.
    named = may.select("doc_id", "key")
    toxic = named.join(known.where("toxic = 1").select("doc_id"), "doc_id").orderBy(*order).limit(max_positive)
    others = named.orderBy(*order).limit(max_unlabelled)
    chosen = toxic.withColumn("kind", F.lit(1)).union(others.withColumn("kind", F.lit(0))).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [features(t).astype(np.int32) for t in batch["text"]]
            yield pd.DataFrame({"kind": batch["kind"], "words": [w.tobytes() for w in words]})

    importable(docs.sparkSession)
    rows = may.join(F.broadcast(chosen), ["doc_id", "key"]).dropDuplicates(
        ["kind", "doc_id", "key"]
    ).orderBy("kind", "doc_id", "key").select("kind", "text").mapInPandas(run, "kind int, words binary").toArrow()
    kinds, words = rows.column("kind").to_pylist(), rows.column("words").to_pylist()
    sample = [[np.frombuffer(w, np.int32) for k, w in zip(kinds, words) if k == kind] for kind in (1, 0)]
    del rows, words
    if not sample[0] or not sample[1] or not 0 < prior < 1:
        return Model(np.zeros(1 << BITS, np.float32), 30.0 if sample[0] and prior >= 1 else -30.0)
    return fit(Sample.of(*sample), prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias
    fields = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(weights.value, bias)
        for batch in batches:
            scores = [model.score(features(t.as_py())) for t in batch.column("text")]
            kept = [f.name for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(scores, pa.float64())], [*kept, "score"]
            )

    importable(docs.sparkSession)
    scored = docs.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
