"""Toxicity by maximum-scoring segments over token log-odds.

1. *Tokens.* A word's tokens are itself and its beginnings of a few letters, so inflected
   forms share their stem.
2. *Weights.* Counts of labelled toxic and other documents give each token a log-odds
   ratio with a Dirichlet prior (its share of all documents of the corpus); the lower
   confidence bound, if above zero, is its weight. Tokens that pass are weighed again by
   the distinct documents they occur in, told apart by MinHashes of their word pairs: copies
   and near copies of a document count once, a passage repeated in different documents
   counts in each. A word has its best token's weight;
   every word without one costs ``GAP``.
3. *Segments.* A linear scan finds every maximal-scoring segment of a text.
4. *Calibration.* For random words the best score follows an extreme-value law,
   E = K * words * exp(-lambda * score). lambda solves sum(p * exp(lambda * weight)) = 1
   over the word shares of documents not marked toxic; K is fitted to their best
   segments. A segment's evidence is -ln(E), if above 0; a document's the sum over its
   segments.
5. *Score.* A logistic curve over the evidence, fitted to counts of labelled documents
   by evidence.

Tokens are learnt from a bounded sample of labelled rows, which bounds the model that
travels to the tasks; corpus counts and segments cover every word of every text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.llm.minhash_bayes import SEED, Shingler, hash_functions, signature

#: Labelled rows read for learning words at most (in expectation; by a hash of the id).
FIT_ROWS = 24_000
BEGINNINGS = range(4, 9)  # lengths of beginnings that are tokens
MIN_TOXIC = 4        # distinct toxic documents a token must occur in to be learnt
SKETCHES = 5         # MinHashes whose distinct values are counted, on average
PRIOR = 10.0         # pseudo-documents of the corpus' shares
FLOOR = 0.5          # pseudo-count of any token in either class
BOUND = 2.33         # standard errors below the log-odds
GAP = 0.15           # what a word without weight costs
SIGNIFICANT = 0.05   # E-value below which a passage is reported
BIN, BINS = 0.5, 256 # evidence histogram for the logistic curve
REMEMBERED = 300_000 # words a task remembers; bounds memory, changes no result

_PIECE = re.compile(r"\w+")


def tokens_of(word: str) -> list[str]:
    """Tokens of one white-space delimited word: its runs of letters and digits, lowered,
    and their beginnings (marked by ``~``)."""
    out = []
    for piece in _PIECE.findall(word.lower()):
        out.append(piece)
        out += [piece[:k] + "~" for k in BEGINNINGS if len(piece) > k]
    return out


class Remember(dict):
    """``f`` of each word, computed once; forgets all when it holds too many."""

    def __init__(self, f):
        super().__init__()
        self.f = f

    def __missing__(self, word):
        if len(self) > REMEMBERED:
            self.clear()
        value = self[word] = self.f(word)
        return value


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of positive score, in order, in
    linear time (each segment is appended once and merged at most once)."""
    stack: list[list[float]] = []  # start, end, sum before, sum with it, link to the last one of lower sum before
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            new[4] = j
            if j < 0 or stack[j][3] >= new[3]:
                stack.append(new)
                break
            new[0], new[2] = stack[j][0], stack[j][2]
            del stack[j:]
    return [(int(a), int(b), r - l) for a, b, l, r, _ in stack]


def sparse_segments(at: np.ndarray, weight: np.ndarray, gap: float) -> list[tuple[int, int, float]]:
    """``segments`` of a text in which the words at ``at`` have ``weight`` and all others
    cost ``gap``; only the weighted words are visited."""
    if not len(at):
        return []
    costs = -gap * np.diff(np.concatenate([[at[0]], at])).astype(float)
    costs[1:] += gap  # words strictly between two weighted ones
    mixed = np.stack([costs, weight], 1).ravel()
    out = []
    for a, b, s in segments(mixed):
        out.append((int(at[a // 2]), int(at[(b - 1) // 2]) + 1, s))
    return out


@dataclass
class Weights:
    """Token weights above zero; ``of(word)`` is the best of a word's tokens, or None."""

    tokens: dict[str, float]
    gap: float = GAP

    def of(self, word: str) -> float | None:
        found = [self.tokens[t] for t in tokens_of(word) if t in self.tokens]
        return max(found) if found else None

    def scan(self, text: str | None, known: Remember) -> tuple[int, list[float], list[tuple[int, int, float]]]:
        """(words, weights met, maximal segments) of a whole text."""
        words = (text or "").split()
        weights = [known[w] for w in words]
        at = [i for i, w in enumerate(weights) if w is not None]
        met = [weights[i] for i in at]
        return len(words), met, sparse_segments(np.array(at), np.array(met), self.gap)


def solve_lambda(shares: np.ndarray, weights: np.ndarray, gap: float) -> float:
    """The positive root of sum(share * exp(l * weight)) + rest * exp(-l * gap) = 1 (bisection);
    1 if the mean weight isn't negative or no weight is positive."""
    rest = max(0.0, 1.0 - shares.sum())

    def over(v: float) -> float:
        return float((shares * np.exp(np.minimum(v * weights, 700))).sum() + rest * np.exp(-v * gap) - 1.0)

    if not len(weights) or not shares.sum() or (shares * weights).sum() - rest * gap >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while over(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if over(mid) < 0 else (low, mid)
    return max(low, 1e-3)


def logistic(low: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset fitted to (not toxic, toxic) counts at evidence
    ``low`` by Newton steps, with a weak prior on both."""
    n, y = counts.sum(1), counts[:, 1]
    x = np.stack([low, np.ones_like(low)], 1)
    rate = (y.sum() + 0.5) / (n.sum() + 1.0)
    theta = np.array([0.1, np.log(rate / (1 - rate))])
    ridge = np.array([0.05, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -50, 50)))
        grad = x.T @ (y - n * p) - ridge * theta
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 0.0), float(theta[1])


def log_odds_bound(n1: np.ndarray, n0: np.ndarray, size1: float, size0: float, share: np.ndarray,
                   prior: float = PRIOR, bound: float = BOUND) -> np.ndarray:
    """Lower confidence bound of the log-odds ratio under a Dirichlet prior."""
    alpha = FLOOR + prior * share
    odds1 = (n1 + alpha) / np.maximum(size1 + prior - n1 - prior * share, FLOOR)
    odds0 = (n0 + alpha) / np.maximum(size0 + prior - n0 - prior * share, FLOOR)
    return np.log(odds1 / odds0) - bound * np.sqrt(1 / (n1 + alpha) + 1 / (n0 + alpha))


def learn_weights(rows: DataFrame, marked: DataFrame, *, fit_rows: int = FIT_ROWS, min_toxic: int = MIN_TOXIC,
                  gap: float = GAP) -> Weights:
    """Token weights from ``rows(doc_id, text)`` and ``marked(doc_id, y)``."""
    n = marked.count()
    sample = marked if n <= fit_rows else marked.filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * fit_rows / n)))
    # At most about ``fit_rows`` pairs of numbers: sent to the tasks, so no text is moved.
    texts = rows.join(F.broadcast(sample), "doc_id").select("text", "y")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, docs, size = Remember(tokens_of), [Counter(), Counter()], [0, 0]
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["y"]):
                size[y] += 1
                docs[y].update({t for w in set((text or "").split()) for t in known[w]})
        for y in (0, 1):
            yield pd.DataFrame({"token": ["", *docs[y]], "y": y, "docs": [size[y], *docs[y].values()]})

    counted = materialise(texts.mapInPandas(count, "token string, y int, docs long").groupBy("token").agg(
        *[F.sum(F.when(F.col("y") == k, F.col("docs")).otherwise(0)).alias(f"d{k}") for k in (0, 1)]))
    size = counted.filter("token = ''").first()
    if size is None or not size["d1"] or not size["d0"]:
        return Weights({}, gap)
    # Tokens commoner among toxic documents: at most those that min_toxic of the sample's toxic documents
    # (FIT_ROWS rows in all) share, so a document of any length adds its own words only where others have them.
    likely = counted.filter((F.col("token") != "") & (F.col("d1") >= min_toxic)
                            & (F.col("d1") * size["d0"] > F.col("d0") * (2 * size["d1"]))).toPandas().sort_values("token")
    d1, d0 = likely["d1"].to_numpy(float), likely["d0"].to_numpy(float)
    likely = likely[log_odds_bound(d1, d0, size["d1"], size["d0"], np.zeros(len(likely))) > 0]
    names = likely["token"].tolist()
    place = {t: i for i, t in enumerate(names)}

    def places_of(word: str) -> tuple[int, ...]:
        return tuple(place[t] for t in tokens_of(word) if t in place)

    def corpus(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, got, docs = Remember(places_of), np.zeros(len(names), np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                docs += 1
                for i in {i for w in set((text or "").split()) for i in known[w]}:
                    got[i] += 1
        yield pd.DataFrame({"i": np.arange(-1, len(names)), "n": np.concatenate([[docs], got])})

    def sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, shingler, (a, b) = Remember(places_of), Shingler(2), hash_functions(SEED, SKETCHES)
        for pdf in batches:
            out = set()
            for text, y in zip(pdf["text"], pdf["y"]):
                met = {i for w in set((text or "").split()) for i in known[w]}
                if met:
                    codes = signature(shingler(text), a, b).tolist()
                    out.update((i, y, j, code) for i in met for j, code in enumerate(codes))
            yield pd.DataFrame(sorted(out), columns=["i", "y", "j", "code"])

    share, docs = np.zeros(len(names)), 1
    for r in rows.select("text").mapInPandas(corpus, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        if r["i"] < 0:
            docs = max(r["n"], 1)
        else:
            share[r["i"]] = r["n"]
    share = share / docs
    met = np.zeros((len(names), 2))
    for r in (texts.mapInPandas(sketches, "i int, y int, j int, code long").distinct()
              .groupBy("i", "y").agg(F.count("*").alias("n")).collect()):
        met[r["i"], r["y"]] = r["n"] / SKETCHES
    # Fewer sketches than documents: copies.
    d1, d0 = likely["d1"].to_numpy(float), likely["d0"].to_numpy(float)
    n1, n0 = np.minimum(met[:, 1], d1), np.minimum(met[:, 0], d0)
    delta = log_odds_bound(n1, n0, size["d1"], size["d0"], share)
    return Weights({t: float(w) for t, w, n in zip(names, delta, n1) if w > 0 and n >= min_toxic}, gap)


def scan_documents(rows: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, n_words, met, best, passages) of every whole text: the weights met, the
    best segment's score and every maximal segment (first word, end, score)."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Remember(weights.of)
        for pdf in batches:
            got = [weights.scan(t, known) for t in pdf["text"]]
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].astype("Int64"), "n_words": [n for n, _, _ in got], "met": [m for _, m, _ in got],
                "best": [max((s for _, _, s in p), default=0.0) for _, _, p in got],
                "segments": [[{"first": a, "end": b, "score": s} for a, b, s in p] for _, _, p in got]})

    return rows.mapInPandas(scan, "doc_id long, n_words long, met array<double>, best double, "
                                  "segments array<struct<first:int,end:int,score:double>>")


def calibrate(scanned: DataFrame, marked: DataFrame, gap: float) -> tuple[float, float]:
    """(lambda, ln K) from the documents marked 0: word shares by weight, best segments."""
    clean = scanned.join(marked.filter("y = 0"), "doc_id").filter("n_words > 0")
    n, words = clean.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    if not n:
        return 1.0, 0.0
    seen = clean.select(F.explode("met").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()  # one row a weight
    lam = solve_lambda(np.array([r["n"] / words for r in seen]), np.array([r["w"] for r in seen]), gap)
    # Best scores follow exp(-K * words * exp(-lambda * best)): the mean of the exponent is 1.
    mass = clean.agg(F.sum(F.col("n_words") * F.exp(F.col("best") * -lam))).first()[0]
    return lam, float(np.log(n / mass))


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", learn: Column | None = None, threshold: float = 0.3,
                    fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (probability of label 1), predicted,
    evidence, passages (every significant one: words from ``first`` to before ``end``,
    its score and E-value).

    Null and empty texts have no evidence and get the score of a text without toxic words.
    Without labels of both classes no word has a weight and every score is the same.
    Repeated rows and null ids are scored like any other, texts of any length whole; an empty table gives no row;
    only the text enters a score; other columns are ignored."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col(f"`{label_col}`").cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
    marked = materialise(marked if learn is None else marked.filter(learn))
    weights = learn_weights(rows, marked, fit_rows=fit_rows)
    scanned = materialise(scan_documents(rows, weights))
    lam, log_k = calibrate(scanned, marked, weights.gap)
    log_e = lambda s: F.lit(log_k) + F.log(F.col("n_words")) - F.lit(lam) * s["score"]
    found = (scanned.withColumn("evidence", F.aggregate(
        "segments", F.lit(0.0), lambda a, s: a + F.greatest(-log_e(s), F.lit(0.0))))
        .withColumn("passages", F.filter(F.transform("segments", lambda s: F.struct(
            s["first"].alias("first"), s["end"].alias("end"), s["score"].alias("score"),
            F.exp(F.least(log_e(s), F.lit(700.0))).alias("e_value"))), lambda p: p["e_value"] < SIGNIFICANT)))
    bins = sorted(found.join(marked, "doc_id").groupBy(F.least(F.floor(F.col("evidence") / BIN), F.lit(BINS)).alias("b"))
                  .agg(F.sum(1 - F.col("y")).alias("n0"), F.sum("y").alias("n1"),
                       F.avg(F.least("evidence", F.lit(BIN * BINS))).alias("x")).collect(), key=lambda r: r["b"])
    slope, offset = logistic(np.array([r["x"] for r in bins]), np.array([[r["n0"], r["n1"]] for r in bins], float)) if bins else (0.0, 0.0)
    return (found.withColumn("score", 1 / (1 + F.exp(-(F.least("evidence", F.lit(BIN * BINS)) * slope + offset))))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "score", "predicted", "evidence", "passages"))
