"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics (logarithms, roots, logits). Each
class has a Gaussian whose covariance is shrunk towards the pooled one and towards a
sphere of the same trace. A document's score is the logistic of the difference of the
log densities: Mahalanobis terms by triangular solves with the classes' Cholesky
factors, which are computed once and cached with their log determinants.

Class counts, sums and sums of outer products are added up in Spark, one row a task, so
nothing but these moments reaches the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

FEATURES = (
    "log_chars", "log_words", "mean_word", "spread_word", "letters", "digits", "upper", "signs", "marks",
    "distinct_words", "top_word", "distinct_pairs", "same_as_before", "capital_words", "sign_runs", "bare_signs",
    "distinct_lines", "words_a_line", "byte_entropy", "long_words",
)
# Shrinkage: weight of the pooled covariance, and of the sphere.
TO_POOLED, TO_SPHERE = 0.8, 0.02
#: Labelled rows that are read for fitting at most (in expectation; by a hash of the id).
FIT_ROWS = 200_000

_CLASS = np.full(256, 4, np.int64)          # other bytes: signs
_CLASS[[*range(65, 91)]] = 0                # A-Z
_CLASS[[*range(97, 123), *range(128, 256)]] = 1  # a-z and bytes of letters beyond ASCII
_CLASS[[*range(48, 58)]] = 2                # digits
_CLASS[[9, 10, 11, 12, 13, 32]] = 3         # white space
_IS_SIGN, _IS_SPACE = _CLASS == 4, _CLASS == 3
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in ".,;:'\"!?()-"]] = True


def _logit(p: float, n: float) -> float:
    """Logit of a share of ``n`` things, kept finite by half a thing on each side."""
    return float(np.log((p * n + 0.5) / ((1 - p) * n + 0.5)))


def statistics(text: str | None) -> np.ndarray:
    """The feature vector of a whole text; null counts as empty."""
    raw = (text or "").encode()
    data = np.frombuffer(raw, np.uint8)
    bytes_ = np.bincount(data, minlength=256)
    kinds = np.bincount(_CLASS, weights=bytes_, minlength=5)
    chars = max(1.0, kinds.sum())
    words = raw.split()
    n = len(words)
    m = max(n, 1)
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words, words[1:]))
    capital = sum(map(bytes.isupper, words))
    sign, space = _IS_SIGN[data], _IS_SPACE[data]
    runs = np.count_nonzero(sign[1:] & sign[:-1])           # signs right behind a sign
    open_, shut = np.r_[True, space], np.r_[space, True]
    bare = np.count_nonzero(sign & open_[:-1] & shut[1:]) if len(raw) else 0
    share = bytes_[bytes_ > 0] / chars
    return np.array([
        np.log1p(len(raw)), np.log1p(n), np.log(lengths.mean() + 1), np.log(lengths.std() + 1),
        _logit((kinds[0] + kinds[1]) / chars, chars), np.sqrt(kinds[2] / chars), np.sqrt(kinds[0] / chars),
        np.sqrt(kinds[4] / chars), np.sqrt(bytes_[_MARKS].sum() / chars),
        _logit(len(counts) / m, m), np.sqrt(max(counts.values(), default=0) / m), np.sqrt(1 - min(pairs, m) / m),
        np.sqrt(same / m), np.sqrt(capital / m), np.sqrt(runs / m), np.sqrt(bare / m),
        np.sqrt(1 - len(set(lines)) / max(len(lines), 1)), np.log1p(n / max(len(lines), 1)),
        float(-(share * np.log2(share)).sum()) if len(raw) else 0.0,
        np.sqrt((lengths > 20).sum() / m),
    ])


@dataclass
class Discriminant:
    """Class 0 and 1: prior, mean and covariance of standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    priors: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    @cached_property
    def factors(self) -> list[tuple[np.ndarray, float]]:
        """For each class the inverse Cholesky factor and half the log determinant."""
        out = []
        for c in self.covariances:
            low = np.linalg.cholesky(c)
            out.append((np.linalg.inv(low), float(np.log(np.diag(low)).sum())))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        z = np.clip((x - self.centre) / self.scale, -12, 12)
        logs = []
        for k, (inverse, half_logdet) in enumerate(self.factors):
            d = (z - self.means[k]) @ inverse.T
            logs.append(np.log(self.priors[k]) - half_logdet - 0.5 * (d * d).sum(axis=1))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def moments_to_model(count: np.ndarray, total: np.ndarray, outer: np.ndarray, to_pooled: float = TO_POOLED,
                     to_sphere: float = TO_SPHERE) -> Discriminant:
    """A model from class counts (2), sums (2, d) and sums of outer products (2, d, d). A
    class of no rows gets the pooled moments and a prior of half a row."""
    d = total.shape[1]
    n = max(count.sum(), 1.0)
    centre = total.sum(0) / n
    pooled = outer.sum(0) / n - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
    scale[scale < 1e-5] = 1.0
    means, raw = np.zeros((2, d)), []
    for k in range(2):
        m = total[k] / count[k] if count[k] else centre
        c = outer[k] / count[k] - np.outer(m, m) if count[k] else pooled
        means[k] = (m - centre) / scale
        raw.append(c / np.outer(scale, scale))
    within = (raw[0] * count[0] + raw[1] * count[1]) / n if count.sum() else np.eye(d)
    shrunk = []
    for k in range(2):
        c = (1 - to_pooled) * raw[k] + to_pooled * within
        trace = max(np.trace(c) / d, 1e-6)
        shrunk.append((1 - to_sphere) * c + to_sphere * trace * np.eye(d) + 1e-6 * np.eye(d))
    priors = (count + 0.5) / (count.sum() + 1.0)
    return Discriminant(centre, scale, priors, means, np.stack(shrunk))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the feature vector of every row."""

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "x": [statistics(t) for t in pdf["text"]]})

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInPandas(describe, "doc_id long, x array<double>")


def fit(described: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id",
        learn: Column | None = None, fit_rows: int = FIT_ROWS, **shrinkage) -> Discriminant:
    """Fit on ``described(doc_id, x)`` rows that ``labels`` marks 0 or 1 (other labels and
    null ids are left out) and ``learn`` (a condition on ``doc_id``) allows. Of more than
    ``fit_rows`` such rows, a share by hash of the id is used."""
    return _fitted(described, _marked(labels, label_col, id_col, learn, fit_rows), **shrinkage)


def _fitted(described: DataFrame, marked: DataFrame, **shrinkage) -> Discriminant:
    d = len(FEATURES)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count, total, outer = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for pdf in batches:
            if len(pdf):
                x, y = np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()
                for k in range(2):
                    part = x[y == k]
                    count[k] += len(part)
                    total[k] += part.sum(0)
                    outer[k] += part.T @ part
        yield pd.DataFrame({"i": np.arange(2 + 2 * d + 2 * d * d), "v": np.concatenate([count, total.ravel(), outer.ravel()])})

    sums = (described.join(marked, "doc_id").select("x", "y").mapInPandas(moments, "i int, v double")
            .groupBy("i").agg(F.sum("v").alias("v")).collect())  # a fixed number of sums
    v = np.zeros(2 + 2 * d + 2 * d * d)
    for r in sums:
        v[r["i"]] = r["v"]
    return moments_to_model(v[:2], v[2:2 + 2 * d].reshape(2, d), v[2 + 2 * d:].reshape(2, d, d), **shrinkage)


def _marked(labels: DataFrame, label_col: str, id_col: str, learn: Column | None, fit_rows: int) -> DataFrame:
    """(doc_id, y) of the labelled rows to learn from. Of more than ``fit_rows``, a share by hash of the id."""
    marked = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y")).filter("y in (0, 1)")
    marked = marked if learn is None else marked.filter(learn)
    n = marked.count()
    if n > fit_rows:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * fit_rows / n)))
    return marked


def accepted(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             learn: Column | None = None, threshold: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns (of any names and
    types). Each row goes by its own text: null and repeated ids carry no decision to other
    rows. Null and empty texts are scored as texts of no words; an empty table gives no row.

    The statistics of labelled texts are made first, for the fit; then every row is scored
    and filtered where it lies, so no text moves. The ids to learn from are at most
    ``fit_rows`` (in expectation), which bounds what is sent to the tasks for it."""
    marked = materialise(_marked(labels, label_col, id_col, learn, fit_rows))
    ids = F.broadcast(marked.select("doc_id").distinct())
    known = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).join(ids, "doc_id", "left_semi")
    model = _fitted(materialise(with_statistics(known)), marked)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t) for t in batch.column(at).to_pylist()]
            if x:
                yield batch.filter(pa.array(model.score(np.stack(x)) >= threshold))

    # By place: a name may hold any character.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", learn: Column | None = None, threshold: float = 0.5,
                    fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (probability of label 1), predicted.

    Null and empty texts are scored as texts of no words; texts of any length are read whole.
    Without any label the score is the prior, one half. Repeated rows and null ids are scored
    like any other; an empty table gives no row; only the text enters a score; other
    columns, of any name, are ignored."""
    described = materialise(with_statistics(docs, id_col, text_col))
    model = fit(described, labels, label_col=label_col, learn=learn, fit_rows=fit_rows)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = model.score(np.stack(pdf["x"].to_numpy())) if len(pdf) else np.zeros(0)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": s})

    return (described.mapInPandas(score, "doc_id long, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
