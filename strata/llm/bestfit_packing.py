"""Best-fit packing in bulk-synchronous rounds.

Documents are tokenised inside tasks; what travels is one row a piece (id, length,
checksum). A round then

1. range-sorts the unplaced pieces and the open gaps together by size,
2. sweeps each range: a gap takes the largest piece below it that is still free (a stack
   of the sizes passed), which gives the piece its successor among the gaps; pieces and
   gaps left over in a range are matched across ranges by their rank, from one count a
   range,
3. subtracts what was placed and repeats with the rest.

A gap that could hold several pieces of the largest size left takes part as that many
equal gaps, so small pieces do not need a round each. Sequences open at the start (as
many as the tokens need, or as there are pieces over half a sequence) and later only
when what is left needs them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialise
from strata.llm.tokens import WordEncoder

CAPACITY = 4096
END_ID = 1
ROWS_PER_RANGE = 100_000
LEAST_PARTS = 16      # partitions of a state at least


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut
    into pieces of ``capacity``. Null text counts as empty: a piece of the end id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder(tokenizer_path)
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = encoder.encode(text or "") + end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k:k + 4 * capacity]
                    rows.append((doc_id, k // (4 * capacity), k // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return ids.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One range, sorted by size (pieces before gaps of the same size). Rows out: a piece
    with the gap it got (``bin``), a piece or gap left over with its rank among the range's
    leftovers, and how many of either are left (kind 3: pieces in ``id``, gaps in ``size``)."""
    pieces: list[tuple] = []  # free pieces passed, the largest on top
    placed: list[tuple] = []
    gaps: list[tuple] = []    # gaps below which no piece was free
    range_id = 0
    for pdf in batches:
        if len(pdf):
            range_id = int(pdf["_range"].iloc[0])
        for size, is_gap, ident in zip(pdf["size"].tolist(), pdf["is_gap"].tolist(), pdf["id"].tolist()):
            if not is_gap:
                pieces.append((ident, size))
            elif pieces:
                item, length = pieces.pop()
                placed.append((range_id, 2, item, length, ident, 0))
            else:
                gaps.append((ident, size))
    left = [(range_id, 0, i, n, None, k) for k, (i, n) in enumerate(pieces)]
    left += [(range_id, 1, i, n, None, k) for k, (i, n) in enumerate(gaps)]
    told = [(range_id, 3, len(pieces), len(gaps), None, 0)] if left else []
    out = pd.DataFrame(placed + left + told, columns=["range", "kind", "id", "size", "bin", "rank"])
    out["bin"] = out["bin"].astype("Int64")
    yield out


def _across(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Match leftovers between ranges: (piece range, first rank, gap range, first rank, n, number).

    ``counts`` holds (range, pieces left, gaps left) in order of size. The gaps of a range
    take the largest pieces of the ranges below, as the sweep does within a range."""
    stack: list[list[int]] = []  # [range, pieces still free]
    out, number = [], 0
    for rng, n_pieces, n_gaps in counts:
        done = 0
        while done < n_gaps and stack:
            below, free = stack[-1]
            n = min(free, n_gaps - done)
            out.append((below, free - n, rng, done, n, number))
            number, done = number + n, done + n
            stack[-1][1] -= n
            if not stack[-1][1]:
                stack.pop()
        if n_pieces:
            stack.append([rng, n_pieces])
    return out


def _round(state: DataFrame, rows: int, largest: int) -> DataFrame:
    """One round over ``state(kind, id, size, bin)``: pieces (kind 0) and gaps (kind 1, ``id`` is
    the sequence). Returns the next state, with what was placed in this round as kind 2."""
    pieces = state.filter("kind = 0").select("size", F.lit(0).alias("is_gap"), "id", F.lit(0).alias("_share"))
    gaps = state.filter("kind = 1").select(F.col("id").alias("bin"), F.col("size").alias("gap"))
    shares = gaps.withColumn("_n", F.greatest(F.lit(1), F.floor(F.col("gap") / largest)).cast("int"))
    as_gaps = shares.select(F.floor(F.col("gap") / F.col("_n")).cast("long").alias("size"), F.lit(1).alias("is_gap"),
                            F.col("bin").alias("id"), F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_share"))
    order = ["size", "is_gap", "id", "_share"]
    # Unions and shuffles add up partitions; rows are few bytes, so as many as their number needs are kept.
    parts = max(LEAST_PARTS, -(-rows // ROWS_PER_RANGE))
    swept = materialise(
        pieces.unionByName(as_gaps).repartitionByRange(max(1, -(-rows // ROWS_PER_RANGE)), *order).sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id()).select("size", "is_gap", "id", "_range")
        .mapInPandas(_sweep, "range int, kind int, id long, size long, bin long, rank long")).coalesce(parts)
    pairs = _across(sorted((r["range"], r["id"], r["size"]) for r in swept.filter("kind = 3").collect()))  # one row a range
    placed = swept.filter("kind = 2").select("kind", "id", "size", "bin")
    left = swept.filter("kind = 0").select("kind", "id", "size", "bin")
    if pairs:
        # At most two intervals a range.
        spans = F.broadcast(swept.sparkSession.createDataFrame(
            [(0, p, a, a + n, m - a) for p, a, _, _, n, m in pairs] + [(1, g, b, b + n, m - b) for _, _, g, b, n, m in pairs],
            "kind int, range int, lo long, hi long, shift long"))
        numbered = swept.filter("kind < 2").alias("l").join(
            spans.alias("s"), (F.col("l.kind") == F.col("s.kind")) & (F.col("l.range") == F.col("s.range"))
            & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")), "left").select(
            F.col("l.kind").alias("kind"), "id", "size", (F.col("rank") + F.col("shift")).alias("number"))
        is_piece = F.col("kind") == 0
        met = (numbered.filter("number is not null").groupBy("number")  # a piece and a gap each
               .agg(F.max(F.when(is_piece, F.col("id"))).alias("id"), F.max(F.when(is_piece, F.col("size"))).alias("size"),
                    F.max(F.when(~is_piece, F.col("id"))).alias("bin")))
        placed = placed.unionByName(met.select(F.lit(2).alias("kind"), "id", "size", "bin"))
        left = numbered.filter("kind = 0 and number is null").select("kind", "id", "size", F.lit(None).cast("long").alias("bin"))
    rooms = (gaps.unionByName(placed.select("bin", (-F.col("size")).alias("gap"))).groupBy("bin").agg(F.sum("gap").alias("size"))
             .filter("size > 0").select(F.lit(1).alias("kind"), F.col("bin").alias("id"), "size", F.lit(None).cast("long").alias("bin")))
    return materialise(placed.unionByName(left).unionByName(rooms).coalesce(parts))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (any columns, of any names but these,
    among them ``length`` from 1 to ``capacity``). Places in a sequence are gapless from 0."""
    spark = pieces.sparkSession
    columns = pieces.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    pieces = materialise(pieces.select(whole.alias("row"), F.col("length").cast("long").alias("length"), F.monotonically_increasing_id().alias("place")))
    state = pieces.filter(F.col("length") < capacity).select(F.lit(0).alias("kind"), F.col("place").alias("id"), F.col("length").alias("size"),
                                                             F.lit(None).cast("long").alias("bin"))
    placed: list[DataFrame] = []
    opened = 0
    while True:
        now = state.agg(*[F.coalesce(F.expr(x), F.lit(0)).alias(k) for k, x in {
            "n": "count_if(kind = 0)", "tokens": "sum(size) filter (where kind = 0)", "largest": "max(size) filter (where kind = 0)",
            "large": f"count_if(kind = 0 and size > {capacity // 2})", "gaps": "count_if(kind = 1)",
            "room": "sum(size) filter (where kind = 1)", "done": "count_if(kind = 2)"}.items()]).first()
        if not now["n"]:
            break
        stuck = opened and not now["done"]  # a round that placed nothing: no piece left fits any gap
        if not opened:
            new = max(now["large"], -(-now["tokens"] // capacity))
        else:
            new = -(-(now["tokens"] if stuck else max(0, now["tokens"] - now["room"])) // capacity)
        if new:
            state = state.unionByName(spark.range(opened + 1, opened + new + 1).select(
                F.lit(1).alias("kind"), (-F.col("id")).alias("id"), F.lit(capacity).cast("long").alias("size"), F.lit(None).cast("long").alias("bin")))
            opened += new
        state = _round(state, now["n"] + now["gaps"] + new, now["largest"])
        placed.append(state.filter("kind = 2").select("id", "size", "bin", F.lit(len(placed)).alias("round")))
    # Full pieces are sequences of their own; their numbers are not below 0, the others' are.
    at = pieces.filter(F.col("length") >= capacity).select(F.col("place").alias("id"), F.col("place").alias("sequence_id"),
                                                           F.lit(0).cast("long").alias("offset"))
    if placed:
        rows = placed[0]
        for more in placed[1:]:
            rows = rows.unionByName(more)
        before = Window.partitionBy("bin").orderBy("round", F.col("size").desc(), "id").rowsBetween(Window.unboundedPreceding, -1)
        at = at.unionByName(rows.select("id", F.col("bin").alias("sequence_id"),
                                        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset")))
    return pieces.join(at, pieces["place"] == at["id"]).select(*[F.col(f"row.`{c}`").alias(c) for c in columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are pieces of one id; only documents of more than ``capacity``
    ids are cut, a text of any length whole; pieces of equal length go by their place; repeated
    rows are packed once each, null ids kept; an empty table gives no row; other columns,
    of any name, are ignored."""
    return pack_pieces(tokenised_pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col,
                                        capacity=capacity, end_id=end_id), capacity)
