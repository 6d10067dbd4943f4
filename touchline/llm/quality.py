"""Quality classifier: regularised quadratic discriminant analysis.

Document statistics are transformed to be roughly normal (logarithms of counts, logits of
shares). Each class has a mean and a covariance that is shrunk towards the pooled
covariance and towards a multiple of the identity. A score is the logistic of the difference
of the two log densities (squared Mahalanobis distances through Cholesky factors that are
computed once, and log determinants) plus the log prior odds. Class moments are summed
over all labelled training rows; only those sums reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.tables import free_names, mapped, slices, stored, whole

NAMES = ("log_bytes", "log_words", "word_bytes", "distinct_words", "distinct_trigrams", "upper",
         "digit", "stop", "symbol", "exclaim", "bar", "space", "non_ascii", "log_lines",
         "repeated_lines", "short_words", "entropy", "top_word")

_CLASSES = ((5, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (6, b"0123456789"), (7, b".,;:'\"-()"),
            (8, b"#$%&*@^~<>{}[]\\/=+_`"), (9, b"!?"), (10, b"|"), (11, b" \t\n\r\x0b\x0c"))
_CLASS_OF = np.zeros(256, np.uint8)
for _k, _chars in _CLASSES:
    _CLASS_OF[list(_chars)] = _k
_CLASS_OF[128:] = 12


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text (an empty text has values as well)."""
    n = len(text)
    words, lines = text.split(), text.split(b"\n")
    n_words = len(words)
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = np.bincount(_CLASS_OF, by_byte, 13) / max(n, 1)
    p = by_byte[by_byte > 0] / max(n, 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    trigrams = max(n_words - 2, 0)
    distinct = len(set(zip(words, words[1:], words[2:])))
    full = [x for x in lines if x.strip()]

    def logit(x: float) -> float:
        return float(np.log((x + 2e-3) / (1 - x + 2e-3)))

    return [np.log1p(n), np.log1p(n_words), np.log1p(n / max(n_words, 1)),
            logit(len(counts) / max(n_words, 1)), logit(distinct / max(trigrams, 1)),
            *(logit(share[k]) for k in range(5, 13)), np.log1p(len(full)),
            logit(1 - len(set(full)) / max(len(full), 1)),
            logit(sum(len(w) <= 3 for w in words) / max(n_words, 1)),
            float(-(p * np.log(p)).sum()), logit(max(counts.values(), default=0) / max(n_words, 1))]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the array ``x`` of statistics, a row per document."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = np.array([statistics(t) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * len(NAMES), pa.int32()), pa.array(x.ravel()))],
                ["doc_id", "x"])

    return mapped(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              whole(text_col).cast("binary")),
                  rows, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and constants of the two classes."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        log_density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1)
                       for m, f, c in zip(self.means, self.factors, self.constants)]
        return 1 / (1 + np.exp(-np.clip(log_density[1] - log_density[0], -500, 500)))


def fit(labelled: DataFrame, shrink: float = 0.2, ridge: float = 0.02) -> Discriminant | None:
    """Fit on rows (x, quality 0/1); None unless both classes have at least two rows.

    ``shrink`` is the weight of the pooled covariance, ``ridge`` that of the identity times the
    pooled mean variance.
    """
    d = len(NAMES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            y = batch.column(1).to_numpy()
            for k in (0, 1):
                z = x[y == k]
                total[k] += np.concatenate([[len(z)], z.sum(axis=0), (z.T @ z).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], total.shape[1]), pa.int32()),
             pa.array(np.tile(np.arange(total.shape[1]), 2), pa.int32()), pa.array(total.ravel())],
            ["k", "at", "value"])

    sums = np.zeros((2, 1 + d + d * d))
    parts = mapped(labelled.select("x", F.col("quality").cast("int")), moments,
                   "k int, at int, value double")
    for r in parts.groupBy("k", "at").agg(F.sum("value").alias("value")).collect():
        sums[r["k"], r["at"]] = r["value"]
    n = sums[:, 0]
    if n.min() < 2:
        return None
    means = sums[:, 1:d + 1] / n[:, None]
    cov = sums[:, d + 1:].reshape(2, d, d) / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (n[:, None, None] * cov).sum(axis=0) / n.sum()
    scale = max(np.trace(pooled) / d, 1e-6)
    factors, constants = [], []
    for k in (0, 1):
        c = (1 - shrink - ridge) * cov[k] + shrink * pooled + ridge * scale * np.eye(d)
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        constants.append(np.log(n[k] / n.sum()) - np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(factors), np.array(constants))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 if score >= threshold).

    Learns from rows that are not held out and whose ``labels.quality`` is 0 or 1 (a document
    whose labels contradict each other is not learned from). Null texts are scored as empty
    ones; without labels of both classes every score is 0.5; rows with a null doc_id are scored
    but never learned from; an empty table gives no rows.
    """
    rows = stored(with_statistics(docs, id_col, text_col), "statistics")
    marks = (labels.select("doc_id", "quality").where("quality in (0, 1)").groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .where("quality = other").drop("other"))
    model = fit(rows.where(~held_out(F.col("doc_id"))).join(marks, "doc_id").select("x", "quality"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(NAMES))
            s = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    return mapped(rows, scored, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, with all their columns. Rows that
    share a doc_id stay if one of them is good."""
    own, = free_names(docs, "good_id")
    good = (score_documents(docs, labels, threshold, id_col, text_col).where("predicted = 1")
            .select(F.col("doc_id").alias(own)).distinct())
    return docs.join(good, docs[id_col].eqNullSafe(F.col(own)), "left_semi")
