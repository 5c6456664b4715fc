"""Spelling variants: words one edit apart, by dense prefix and suffix tiling.

An edit of a word lies in one of ``PARTS`` equal parts of it. Two words of a single edit,
the longer one of m code points, so agree in all that stands before the part and after it:
they meet under the key (m, part, what is before, what is after). Words of m and of m - 1
code points take part in m. A key's words are cut into tiles of about ``TILE``; tiles meet
tiles of their key, and there the words, padded to a matrix of code points, are compared:
where common prefix and common suffix together reach the longer length minus one, one code
point was inserted, deleted or replaced. A pair counts under the key of the part where the
two first differ, so once. What leaves a task is a count and the best near word of each
word, not pairs.

The roots follow the forms in doubling steps; a form has at least ``RATIO`` times its
word's number, so chains are short.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 5
LEAST_COUNT = 3
RATIO = 2                # how many times as frequent a form is
PARTS = 3
TILE = 256               # words of a tile
AT_ONCE = 100_000        # pairs compared at a time; bounds memory
HELD = 200_000           # distinct words a task counts before it hands them on; bounds memory
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, rewrite: Callable[[int | None], Callable[[str], str]] | None = None) -> DataFrame:
    """(word, n): the distinct words of all whole texts, A-Z lowered, with their number. Null
    and empty texts have no words; texts of any length are read whole; null ids and repeated
    rows count like all others; other columns, of any name, are ignored. ``rewrite(id)`` may
    give a function that replaces each lowered run of a document."""
    run = re.compile(RUN)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        lowered: dict[str, str] = {}
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                change = rewrite(None if pd.isna(doc_id) else int(doc_id)) if rewrite is not None else str
                for w, n in Counter(run.findall(text or "")).items():
                    low = lowered.get(w)
                    if low is None:
                        low = lowered[w] = w.translate(_LOWER)
                    low = change(low)
                    held[low] = held.get(low, 0) + n
            if len(lowered) >= HELD:
                lowered.clear()
            if len(held) >= HELD:
                yield pd.DataFrame(held.items(), columns=["word", "n"])
                held = {}
        if held:
            yield pd.DataFrame(held.items(), columns=["word", "n"])

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = source.mapInPandas(count, "word string, n long").filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def part_bounds(length: int, part: int, parts: int = PARTS) -> tuple[int, int]:
    return part * length // parts, (part + 1) * length // parts


def keys_of(word: str, parts: int = PARTS) -> list[str]:
    """Keys of a word as one of the longer length, then as one shorter by a code point."""
    out = []
    for m in (len(word), len(word) + 1):
        for part in range(parts):
            low, high = part_bounds(m, part, parts)
            out.append(f"{m}:{part}:{word[:low]}:{word[len(word) - (m - high):]}")
    return out


def _matrix(words: list[str]) -> np.ndarray:
    """Code points of the words, padded with 0 to the longest."""
    codes = np.array(words, dtype=np.str_)
    codes = codes.view(np.uint32).reshape(len(words), -1)
    return codes.astype(np.uint8) if codes.max(initial=0) < 256 else codes


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of ``x`` and ``y``; padding counts as equal."""
    differ = x != y
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def single_edits(left: np.ndarray, right: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of words at ``left`` and ``right``: whether a single edit apart, and the
    place, in the longer one, where they first differ."""
    forward, backward = _matrix(words), _matrix([w[::-1] for w in words])
    size = np.fromiter(map(len, words), np.int64, len(words))
    near, place = np.zeros(len(left), bool), np.zeros(len(left), np.int64)
    for k in range(0, len(left), AT_ONCE):
        a, b = left[k:k + AT_ONCE], right[k:k + AT_ONCE]
        longer, shorter = np.maximum(size[a], size[b]), np.minimum(size[a], size[b])
        prefix = np.minimum(_common(forward[a], forward[b]), shorter)
        suffix = np.minimum(_common(backward[a], backward[b]), shorter)
        near[k:k + AT_ONCE] = (longer - shorter <= 1) & (prefix + suffix >= longer - 1) & ~((prefix == longer) & (longer == shorter))
        place[k:k + AT_ONCE] = prefix
    return near, place


def near_words(counts: DataFrame, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """(word, n_near, best) of the words of ``counts(word, n)`` that have near words; ``best``
    (n, word) is the most frequent one (ties: the first in code-point order)."""
    m, part = F.col("m"), F.col("part")
    low, high = F.floor(part * m / parts).cast("int"), F.floor((part + 1) * m / parts).cast("int")
    keyed = (counts.withColumn("size", F.length("word"))
             .withColumn("m", F.explode(F.array(F.col("size"), F.col("size") + 1)))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    # The words of a key have their lengths, so no mark is needed between the two pieces.
    key = F.xxhash64(m, part, F.substring(F.col("word"), F.lit(1), low), F.substring(F.col("word"), F.col("size") - m + high + 1, m))
    keyed = keyed.select(key.alias("key"), "m", "part", "word", "n", (F.col("size") == m).cast("int").alias("full"))
    sizes = (keyed.groupBy("key").agg(F.count("*").alias("words"), F.max("full").alias("any"))
             .filter("words > 1 and any = 1").select("key", F.ceil(F.col("words") / tile).cast("int").alias("tiles")))
    placed = keyed.join(sizes, "key").withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    tiled = materialise(placed.groupBy("key", "tile", "tiles", "m", "part")
                        .agg(F.collect_list(F.struct("word", "n")).alias("w"))
                        .select("key", "tile", "tiles", "m", "part", F.col("w.word").alias("words"), F.col("w.n").alias("ns")))
    single = tiled.select("m", "part", "words", "ns", F.lit(None).cast("array<string>").alias("words2"), F.lit(None).cast("array<long>").alias("ns2"))
    # Tiles of a key that has several: each meets those after it.
    many = tiled.filter("tiles > 1")
    after = many.select("key", F.col("tile").alias("tile2"), F.col("words").alias("words2"), F.col("ns").alias("ns2"))
    crossed = many.join(after, "key").filter("tile2 > tile").select("m", "part", "words", "ns", "words2", "ns2")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words, ns, left, right, bounds, total = [], [], [], [], [], 0
            found: dict[str, list] = {}
            for m, part, w, c, w2, c2 in zip(*[pdf[x] for x in ("m", "part", "words", "ns", "words2", "ns2")]):
                base, a = len(words), len(w)
                words += list(w)
                ns += list(c)
                if w2 is None:
                    i, j = np.triu_indices(a, 1)
                else:
                    words += list(w2)
                    ns += list(c2)
                    i, j = (x.reshape(-1) for x in np.indices((a, len(w2))))
                    j = j + a
                left.append(i + base)
                right.append(j + base)
                bounds.append((m, *part_bounds(m, part, parts), len(i)))
                total += len(i)
                if total >= AT_ONCE:
                    _collect(found, words, ns, left, right, bounds)
                    words, ns, left, right, bounds, total = [], [], [], [], [], 0
            if total:
                _collect(found, words, ns, left, right, bounds)
            yield pd.DataFrame([(w, n, -b[0], b[1]) for w, (n, b) in found.items()], columns=["word", "n_near", "near_n", "near"])

    got = single.unionByName(crossed).mapInPandas(compare, "word string, n_near long, near_n long, near string")
    # Of structs the least: the largest number (negated), then the first word.
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    return got.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.struct((-F.col("b.n")).alias("n"), F.col("b.word").alias("word")).alias("best"))


def _collect(found: dict[str, list], words: list[str], ns: list[int], left: list, right: list, bounds: list) -> None:
    """Add to ``found`` (word: number of near words, best (-n, word)) the near pairs that count here."""
    a, b = np.concatenate(left), np.concatenate(right)
    m, low, high = (np.repeat([x[k] for x in bounds], [x[3] for x in bounds]) for k in range(3))
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.flatnonzero(np.maximum(size[a], size[b]) == m)  # two shorter ones have a key of their own
    a, b, low, high = a[at], b[at], low[at], high[at]
    near, place = single_edits(a, b, words)
    for i, j in zip(*(x[near & (place >= low) & (place < high)].tolist() for x in (a, b))):
        for x, y in ((i, j), (j, i)):
            entry, other = found.setdefault(words[x], [0, (1, "")]), (-ns[y], words[y])
            entry[0] += 1
            entry[1] = min(entry[1], other)


def spelling_groups(counts: DataFrame, *, ratio: int = RATIO, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of ``counts(word, n)`` (distinct words).

    A word's form is its near word of largest n (ties: the smallest in code-point order), if
    that n is at least ``ratio`` times its own; its root is the last word on following the
    forms, itself if it has none. Words without near words are kept; an empty table gives
    no row."""
    words = materialise(counts.select("word", "n"))
    enough = F.col("best.n") >= ratio * F.col("n")
    formed = materialise(words.join(near_words(words, parts, tile), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"), F.when(enough, F.col("best.n")).alias("form_n")))
    up = formed.filter("form is not null").select("word", F.col("form").alias("to"))
    while True:  # where each word's way leads after 1, 2, 4, ... steps
        further = up.select(F.col("word").alias("to"), F.col("to").alias("next"))
        up = materialise(up.join(further, "to", "left").select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")))
        if up.filter("moved").isEmpty():
            break
        up = up.drop("moved")
    return formed.join(up.select("word", "to"), "word", "left").select(
        "word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")
