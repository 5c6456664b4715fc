"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``window`` consecutive words. Every document's windows are dealt into blocks by
content: successive windows of the same minimizer (the least hashed gram of a window) are
one block, so equal windows always lie in blocks of the same minimizer, wherever their
documents differ around them. The blocks of all documents are the reference.

1. Outline: each text is cut into its blocks; a block travels as its minimizer, a 128-bit
   fingerprint of its words and its place, about one for every 18 words, without text.
2. Index: of the blocks whose minimizer several documents hold, each distinct one is a
   reference block with the smallest id that holds it (combined before the shuffle, so a
   passage that very many documents share is one row).
3. Parse: a document is factored against every indexed block of its minimizers. A block
   that a smaller id holds is a factor as a whole; neighbouring factors join, so a long
   copy is one factor.
4. At the boundaries of factors stand blocks that only this document holds, of minimizers
   that other documents have as well: part of them may be a copy. Their windows are looked
   up one by one among the windows of all such reference blocks (combined by fingerprint
   before the shuffle), and those that a smaller id holds extend the factors.

Nothing compares documents in pairs: a group of n equal blocks or windows costs n rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise

WINDOW = 50              # words that make a passage
GRAM = 16                # words of a minimizer
REMEMBERED = 500_000     # word hashes a task keeps; bounds memory, changes no result
HELD = 200_000           # windows a task looks up at a time; bounds memory
LARGEST = (1 << 63) - 1  # stands for a null id: after all others
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd: they have inverses
_HIGH = np.uint64(0xFFFFFFFF00000000)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of a text's words, the runs of ``[^\\x20\\x09-\\x0D]``, unchanged."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        codes = list(map(known.get, words))
        if None in codes:
            for i, c in enumerate(codes):
                if c is None:
                    codes[i] = known[words[i]] = digest(words[i])
        return np.array(codes, np.uint64)


class Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as the longest text needs."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - 1, b)))) for b in (self.base, self.inverse))
        return self.up, self.down


class Fingerprints:
    """Polynomial fingerprints of any stretches of one text, from prefix sums modulo 2^64."""

    def __init__(self, powers: Powers, hashes: np.ndarray):
        up, self.down = powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(_mix(hashes ^ powers.base) * up[:len(hashes)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` successive values."""
    step, out = 1, values
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def blocks_of(hashes: np.ndarray, powers: list[Powers], window: int = WINDOW, gram: int = GRAM):
    """(first window, number of windows, minimizer, fingerprint, fingerprint) of the blocks of a text of
    ``window`` words or more, in order."""
    prints = [Fingerprints(p, hashes) for p in powers]
    at = np.arange(len(hashes) - gram + 1)
    grams = prints[0](at, at + gram)
    place = (_least((grams & _HIGH) | at.astype(np.uint64), window - gram + 1) & ~_HIGH).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    size = np.diff(first, append=len(place))
    ends = first + size + window - 1
    return first, size, grams[place[first]], prints[0](first, ends), prints[1](first, ends)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == np.uint64 else x


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (start, end) in order, those that touch or overlap joined."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                      gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, factors (array of start, length:
    the duplicate spans, in words, none touching another), kept (the words left, one space
    between).

    A word is removed if a window covers it whose words also start somewhere in a document
    of a smaller id. Windows are judged on the whole input. Null, empty and wordless texts and texts
    of fewer than ``window`` words lose nothing; texts of any length are read whole, their
    memory is that of their words. A null id is larger than any other; rows of the same id,
    repeated or not, are not smaller than each other, so both stay. An empty table gives no row;
    other columns, of any name, are ignored."""
    fingerprints = [Powers(b) for b in _BASES]

    def outline(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = WordHashes()
        for pdf in batches:
            out = []
            for doc, key, text in zip(pdf["id"], pdf["key"], pdf["text"]):
                words = (text or "").encode().split()  # bytes: ASCII white space only
                if len(words) >= window:
                    out.append((doc, key, *map(_signed, blocks_of(hashed(words), fingerprints, window, gram))))
            yield pd.DataFrame(out, columns=["id", "key", "first", "size", "mini", "h", "g"])

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = WordHashes()
        for pdf in batches:
            out, held = [], 0
            for uid, doc, text, first, size in zip(*[pdf[c] for c in ("uid", "id", "text", "first", "size")]):
                hashes = hashed((text or "").encode().split())
                at = np.unique(np.concatenate([np.arange(f, f + n) for f, n in zip(first, size)]))
                h, g = (Fingerprints(p, hashes)(at, at + window) for p in fingerprints)
                out.append((uid, doc, at.astype(np.int32), _signed(h), _signed(g)))
                held += len(at)
                if held >= HELD:
                    yield pd.DataFrame(out, columns=["uid", "id", "at", "h", "g"])
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=["uid", "id", "at", "h", "g"])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, text, starts, stops in zip(*[pdf[c] for c in ("doc_id", "text", "start", "end")]):
                words = (text or "").encode().split()
                factors = merged(list(zip(starts.tolist(), stops.tolist()))) if starts is not None else []
                kept, at = [], 0
                for start, end in factors:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                out.append((doc_id, len(words), len(words) - len(kept), [{"start": s, "length": e - s} for s, e in factors],
                            b" ".join(kept).decode()))
            made = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "factors", "kept"])
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
                       F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("key"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(LARGEST)))

    # 1. Outline. Rows of the same id and text have the same outcome: one outline stands for them.
    outlines = rows.select("id", "key", "text").mapInPandas(
        outline, "id long, key binary, first array<int>, size array<int>, mini array<long>, h array<long>, g array<long>")
    outlined = materialise(outlines.withColumn("uid", F.monotonically_increasing_id()))
    blocks = outlined.select("uid", "id", F.explode(F.arrays_zip("first", "size", "mini", "h", "g")).alias("b")).select("uid", "id", "b.*")

    # 2. Index of the blocks whose minimizer documents of different ids hold.
    held = blocks.groupBy("mini").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high").select("mini")
    shared = materialise(blocks.join(materialise(held), "mini", "left_semi"))
    index = materialise(shared.groupBy("mini", "h", "g").agg(F.min("id").alias("holder")))
    several = materialise(index.groupBy("mini").agg(F.count("*").alias("n")).filter("n > 1").select("mini"))

    # 3. Factors: blocks that a smaller id holds.
    found = shared.join(index, ["mini", "h", "g"]).select("uid", "id", "first", "size", "mini", "holder")
    whole = found.filter("holder < id").select("uid", F.col("first").alias("start"), (F.col("first") + F.col("size") + (window - 1)).alias("end"))

    # 4. Boundaries: windows of the blocks that no smaller id holds, where their minimizer has other blocks.
    parts = (found.filter("holder = id").join(several, "mini", "left_semi")
             .groupBy("uid").agg(F.collect_list(F.struct("first", "size")).alias("parts")))  # at most a text's blocks
    named = outlined.select("uid", "id", "key")
    # Rows of one id and text have the same blocks: those of one of them.
    wanted = named.join(parts, "uid").groupBy("id", "key").agg(F.max_by(F.struct("uid", "parts"), "uid").alias("w"))
    looked = materialise(wanted.join(rows.select("id", "key", "text"), ["id", "key"])
                         .select("w.uid", "id", "text", "w.parts.first", "w.parts.size")
                         .mapInPandas(windows, "uid long, id long, at array<int>, h array<long>, g array<long>"))
    windowed = looked.select("uid", "id", F.explode(F.arrays_zip("at", "h", "g")).alias("w")).select("uid", "id", "w.*")
    first = materialise(windowed.groupBy("h", "g").agg(F.min("id").alias("holder"), F.max("id").alias("high"))
                        .filter("holder < high").select("h", "g", "holder"))
    single = (windowed.join(first, ["h", "g"]).filter("holder < id")
              .select("uid", F.col("at").alias("start"), (F.col("at") + window).alias("end")))

    spans = (whole.unionByName(single).groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # a text's own
             .join(named, "uid").groupBy("id", "key").agg(F.max_by("spans", "uid").alias("spans")))
    return (rows.join(spans, ["id", "key"], "left").select("doc_id", "text", "spans.start", "spans.end")
            .mapInPandas(parse, "doc_id long, n_words long, n_removed long, factors array<struct<start:bigint,length:bigint>>, kept string"))
