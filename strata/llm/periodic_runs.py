"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words of smallest period q (words q apart are identical) that is at
least ``least_words`` and ``least_periods`` periods long and that no neighbour extends.

* Periods below ``SHORT`` are found by direct scans: the words are compared with
  themselves at each such lag.
* Scale S = ``SHORT``, 2 ``SHORT``, ... covers the periods S <= q < 2S. Grams of S/4 words
  are ranked exactly (the ranks of grams of half the length, in pairs), the least ranked
  gram of every S/4 successive ones (by a hash of its rank, the first of equal ones) is a
  minimizer. Of minimizers of one rank that follow each other within S/8 words (they lie
  in a stretch of a shorter period) only the first counts. What is a minimizer so depends
  on fewer than S words around it; hence in a stretch of three periods there is one whose
  equal lies a period further. Pairs of equal minimizers S to 2S apart (16 for each at
  most, as equal ones stand over S/8 apart) seed an extension to both sides at their
  distance, which verifies the run word by word.

The work of a text of n words grows as n log n (scales) plus the words extended over, its
memory as n. Rows are independent: nothing is shuffled, no text is cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 24
LEAST_PERIODS = 3
SHORT = 16                                 # lags scanned directly; the first scale; a power of two
_MIXER = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _equal_stretches(same: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches of True in ``same`` of at least ``least``."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    return list(zip(begins[long].tolist(), ends[long].tolist()))


def _extended(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch [start, end) around ``at`` whose words equal those ``lag`` further."""
    last, end, step = len(codes) - lag, at, 64
    while end < last:
        to = min(last, end + step)
        differ = np.flatnonzero(codes[end:to] != codes[end + lag:to + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = to, 2 * step
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(codes[low:start] != codes[low + lag:start + lag])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start, step = low, 2 * step
    return start, end


def _paired_ranks(ranks: np.ndarray, half: int) -> np.ndarray:
    """Ranks of the grams of twice the length: equal if and only if both halves are."""
    if len(ranks) <= half:
        return ranks[:0]
    pair = ranks[:-half] * np.int64(int(ranks.max()) + 1) + ranks[half:]
    return np.unique(pair, return_inverse=True)[1].reshape(-1).astype(np.int64)


def _minimizers(ranks: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hashed ranks of all full windows of ``window`` (a power of two)."""
    hashed = ranks.astype(np.uint64) * _MIXER
    hashed ^= hashed >> np.uint64(29)
    least = ((hashed * _MIXER) & _HIGH) | np.arange(len(ranks), dtype=np.uint64)
    width = 1
    while width < window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.unique((least & ~_HIGH).astype(np.int64))


def _seeds(ranks: np.ndarray, scale: int) -> list[tuple[int, int]]:
    """(period, place) of pairs of equal minimizers ``scale`` to 2 ``scale`` apart."""
    quarter = scale // 4
    if len(ranks) < quarter:
        return []
    places = _minimizers(ranks, quarter)
    of = ranks[places]
    order = np.lexsort((places, of))
    places, of = places[order], of[order]
    head = np.ones(len(places), bool)
    head[1:] = (of[1:] != of[:-1]) | (places[1:] - places[:-1] > quarter // 2)
    places, of = places[head], of[head]
    seeds: set[tuple[int, int]] = set()
    for step in range(1, len(places)):
        apart = np.where(of[step:] == of[:-step], places[step:] - places[:-step], 2 * scale)
        near = apart < 2 * scale
        if not near.any():
            break
        wanted = np.flatnonzero(near & (apart >= scale))
        seeds.update(zip(apart[wanted].tolist(), places[wanted].tolist()))
    return sorted(seeds)


def runs_of(codes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``codes`` (equal numbers: equal words), in
    order of start, then period. ``least_periods`` is 3 or more."""
    if least_periods < 3:
        raise ValueError("runs of less than three periods are not covered by the seeds")
    n = len(codes)
    longest = n // least_periods
    found: dict[tuple[int, int], int] = {}  # smaller periods come first and stay
    if n < least_words:
        return []

    def note(start: int, end: int, period: int) -> None:
        if end - start >= max(least_words, least_periods * period):
            found.setdefault((start, end), period)

    for lag in range(1, min(SHORT - 1, longest) + 1):
        least = max(least_words, least_periods * lag) - lag
        same = codes[lag:] == codes[:-lag]
        if np.count_nonzero(same) >= least:
            for start, end in _equal_stretches(same, least):
                note(start, end + lag, lag)
    ranks, gram = np.unique(codes, return_inverse=True)[1].reshape(-1).astype(np.int64), 1
    scale = SHORT
    while scale <= longest:
        while gram < scale // 4:
            ranks, gram = _paired_ranks(ranks, gram), 2 * gram
        done: tuple[int, int] = (0, -1)  # the last period and the end of its last stretch
        for period, at in _seeds(ranks, scale):
            if period > longest or (period == done[0] and at < done[1]):
                continue
            start, end = _extended(codes, at, period)
            done = (period, end)
            note(start, end + period, period)
        scale *= 2
    return sorted((start, end - start, period) for (start, end), period in found.items())


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when each run keeps its first period only."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of most periods, exactly; of equal ones the first, then of the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def find_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
              least_periods: int = LEAST_PERIODS,
              rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (array of start, length, period, in
    that order), best (the run of most periods; null if none), collapsed (the words left, one
    space between, when each run keeps its first period).

    Words are the runs of ``[^\\x20\\x09-\\x0D]`` of the whole text, numbered from 0. Null,
    empty and wordless texts have no words and no runs; texts of any length are read whole,
    their memory is that of their words; repeated rows are independent, null ids are kept;
    an empty table gives no row; other columns, of any name, are ignored. ``rewrite``
    (id, words) may replace a text's words before they are searched."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                words = (text or "").encode().split()  # bytes: ASCII white space only
                if rewrite is not None:
                    words = rewrite(None if pd.isna(doc_id) else int(doc_id), words)
                number: dict[bytes, int] = {}
                codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
                runs = runs_of(codes, least_words, least_periods)
                if runs:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs))]
                best = strongest(runs)
                named = [dict(zip(("start", "length", "period"), r)) for r in runs]
                out.append((doc_id, len(codes), named, best and dict(zip(("start", "length", "period"), best)), b" ".join(words).decode()))
            made = pd.DataFrame(out, columns=["doc_id", "n_words", "runs", "best", "collapsed"])
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    run = "struct<start:bigint,length:bigint,period:bigint>"
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInPandas(search, f"doc_id long, n_words long, runs array<{run}>, best {run}, collapsed string")
