"""MinHash near-deduplication with sequential Bayesian verification.

1. A document's set: the distinct n-word shingles of its whole text, as 64-bit hashes.
   Documents of equal sets become one node (their links are certain).
2. Nodes that agree in a band of their MinHash signature are candidates. First every
   node is compared with one other: the most central node (the one of the largest buckets
   over all bands: an original rather than one of its copies) of the buckets that the two
   share most of. After the components of those links are known, a last pass compares,
   in every bucket, the members outside its largest component with all members of other
   components, in blocks of signatures inside a task. Pairs already joined are never made,
   so a large group of near copies costs its size, not its square, and no pair that shares
   a bucket is left out across components. Members that stay below the threshold are never
   joined: a bucket of n of them (much shared boilerplate) still costs n * n comparisons of
   signatures, inside tasks.
3. A candidate's signatures are compared batch by batch. After each batch the posterior
   of the similarity, Beta(1 + matches, 1 + misses), bounds the chance that the pair
   reaches the threshold; below ``miss`` the pair is pruned. What bands are made of, is
   compared here, and travels, is the lowest byte of each hash: two sets agree in it at
   least as often as in the hash, so the bound holds and no band is missed for it.
4. Survivors are verified exactly, on their full sets, made anew from the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import connected_components, materialise

BANDS, ROWS = 40, 6          # a pair of similarity 0.8 misses all bands once in 190,000 at most
SIGNATURE = 256              # hashes; those beyond the bands serve verification only
BATCH = 32                   # hashes compared at a time (a byte of each)
MISS = 1e-6                  # posterior chance below which a pair is pruned
SEED = 20240506
BLOCK = 256                  # signatures of a bucket compared at once
SENT = 200_000               # rows of 32 bytes that are sent to all tasks at most; more are joined by a shuffle
VERIFIED = 64                # nodes of a block whose full sets are compared at once
HELD = 100_000               # pairs a task holds before it hands them on
NO_ID = (1 << 63) - 1         # stands for a null id in joins
REMEMBERED = 500_000         # word hashes a task keeps; bounds memory, changes no result


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text.

    Words are the runs of ``[^\\x20\\x09-\\x0D]``, A-Z lowered. A text of fewer words than
    ``n`` has its whole word sequence as its one shingle; one without words has none."""

    def __init__(self, n: int):
        self.n = n
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, digest = self.known, xxhash.xxh3_64_intdigest
        codes = list(map(known.get, words))
        if None in codes:
            for i, c in enumerate(codes):
                if c is None:
                    codes[i] = known[words[i]] = digest(words[i])
        h = np.array(codes, np.uint64)
        n = min(self.n, len(h))
        out = h[: len(h) - n + 1] ^ np.uint64(n)
        for k in range(1, n):
            out = _mix(out) + h[k: len(h) - n + 1 + k]
        return np.unique(_mix(out))


def _node(raw: bytes) -> bytes:
    """Name of a set: a 128-bit digest of its sorted hashes."""
    return hashlib.blake2b(raw, digest_size=16).digest()


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and shift)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One minimum for each hash function ``(a * x + b)``, upper 32 bits, as uint32."""
    out = np.empty(len(a), np.uint32)
    step = max(1, 65_536 // max(1, len(shingles)))
    for k in range(0, len(a), step):
        values = shingles[None, :] * a[k:k + step, None] + b[k:k + step, None]
        out[k:k + step] = (values.min(axis=1) >> np.uint64(32)).astype(np.uint32)
    return out


def band_keys(bands: int, rows: int) -> Column:
    """The keys of a ``signature``'s bands: a band's number (two bytes), then its ``rows`` bytes."""
    return F.array(*[F.concat(F.lit(i.to_bytes(2, "big")), F.substring("signature", i * rows + 1, rows)) for i in range(bands)])


def _met_before(key: bytes, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the paired signatures ``x`` and ``y`` share a band before that of ``key``."""
    band, rows = int.from_bytes(key[:2], "big"), len(key) - 2
    same = x[:, :band * rows] == y[:, :band * rows]
    return same.reshape(len(x), band, rows).all(axis=2).any(axis=1)


def hash_functions(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, n, dtype=np.uint64))


def least_matches(threshold: float, miss: float, size: int = SIGNATURE, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes compared, matches below which the pair is pruned) for each batch.

    With a uniform prior, P(similarity >= t | m of n match) is the chance of at most m
    successes in n + 1 trials of probability t."""
    out = []
    for n in range(batch, size + 1, batch):
        below, m = 0.0, 0
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
        out.append((n, m))
    return out


def _verified(pairs: DataFrame, sets: DataFrame, threshold_percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold: 100 * shared >= percent * union."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = []
            for x, y in zip(pdf["x"], pdf["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= threshold_percent * (len(x) + len(y) - shared))
            yield pdf.loc[keep, ["a", "b"]]

    right = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    both = right.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInPandas(check, "a binary, b binary")


def _sequential(x: np.ndarray, y: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Rows of the paired signatures ``x`` and ``y`` that no batch prunes."""
    alive, matches, done = np.arange(len(x)), np.zeros(len(x), int), 0
    for n, least in limits:
        matches = matches + (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def _signatures(raw) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1)


def _likely(pairs: DataFrame, signatures: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """Pairs that the sequential Bayesian test doesn't prune."""

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.iloc[_sequential(_signatures(pdf["x"]), _signatures(pdf["y"]), limits)][["a", "b"]]

    right = pairs.join(signatures.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b")
    both = right.join(signatures.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInPandas(test, "a binary, b binary")


PAIRS = "main binary, inside boolean, i int, j int, a array<binary>, b array<binary>"


def _likely_across(members: DataFrame, signatures: DataFrame, limits: list[tuple[int, int]]) -> DataFrame:
    """Unpruned pairs between members of different components of a bucket, each made in
    the bucket of the first band that the two share, as ``PAIRS``.

    ``members(key, n, main, node, root)``: the rows of buckets of several components, n of
    them in the bucket. Members are gathered in blocks of about ``BLOCK``; a block of those
    outside the main component meets every block of its bucket, and their signatures are
    compared there. What the test leaves comes out as lists, by main component (``inside``:
    one of the two is in it) and by blocks of about ``VERIFIED`` of its nodes and of those
    around it."""
    around = (members.select("main", "node", F.col("root") != F.col("main")).toDF("main", "node", "outer").distinct()
              .groupBy("main").agg(F.count_if("outer").alias("outer"), F.count_if(~F.col("outer")).alias("inner")))
    blocks_of = [F.greatest(F.lit(1), F.ceil(F.col(c) / VERIFIED)).cast("int").alias(c) for c in ("outer", "inner")]
    members = members.join(materialise(around.select("main", *blocks_of)), "main")
    signed = members.join(signatures, "node")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block")

    def blocks(part: DataFrame, prefix: str, *more: str) -> DataFrame:
        gathered = part.groupBy("key", block).agg(F.collect_list(F.struct("node", "root", "signature")).alias("m"),
                                                  *[F.first(c).alias(c) for c in more])  # one main a bucket
        return gathered.select("key", *more, *[F.col(f"m.{c}").alias(prefix + c) for c in ("node", "root", "signature")])

    pairs = blocks(signed.filter("root <> main"), "x", "main", "outer", "inner").join(blocks(signed, "y"), "key")

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple, set] = {}
        held = 0

        def out() -> pd.DataFrame:
            rows = [(*k, [x for x, _ in v], [y for _, y in v]) for k, v in ((k, sorted(v)) for k, v in found.items())]
            return pd.DataFrame(rows, columns=["main", "inside", "i", "j", "a", "b"])

        for pdf in batches:
            for key, main, outer, inner, xn, xr, xs, yn, yr, ys in zip(*[pdf[c] for c in columns]):
                x, y, (n, least) = _signatures(xs), _signatures(ys), limits[0]
                same = {r: i for i, r in enumerate(set(xr) | set(yr))}
                other = np.array([same[r] for r in xr])[:, None] != np.array([same[r] for r in yr])
                i, j = np.nonzero(((x[:, None, :n] == y[None, :, :n]).sum(axis=2) >= least) & other)
                for k in range(0, len(i), 65_536):
                    p, q = i[k:k + 65_536], j[k:k + 65_536]
                    here = ~_met_before(key, x[p], y[q])
                    p, q = p[here], q[here]
                    at = _sequential(x[p], y[q], limits)
                    for u, v in zip(p[at].tolist(), q[at].tolist()):
                        one, two, inside = xn[u], yn[v], yr[v] == main
                        if not inside and two < one:
                            one, two = two, one
                        place = (main, inside, _part(one, outer), _part(two, inner if inside else outer))
                        group = found.setdefault(place, set())
                        held -= len(group)
                        group.add((one, two))
                        held += len(group)
                if held >= HELD:
                    yield out()
                    found.clear()
                    held = 0
        yield out()

    columns = ["key", "main", "outer", "inner", *[p + c for p in "xy" for c in ("node", "root", "signature")]]
    return pairs.select(*columns).mapInPandas(test, PAIRS)


def _part(node: bytes, parts: int) -> int:
    return int.from_bytes(node[:8], "little") % parts


def _verified_lists(likely: DataFrame, sets_of, threshold_percent: int) -> DataFrame:
    """Links (a, b) among the pairs of ``likely`` (``PAIRS``) whose full sets reach the threshold: of a node
    with a component, one link.

    The pairs of two blocks are one row; the sets of its nodes come once, however many
    pairs they are in."""
    lists = (likely.groupBy("main", "inside", "i", "j").agg(F.flatten(F.collect_list("a")).alias("a"), F.flatten(F.collect_list("b")).alias("b"))
             .withColumn("rid", F.monotonically_increasing_id()))
    lists = materialise(lists.select("rid", "inside", "a", "b"))
    nodes = lists.select("rid", F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    held = (nodes.join(sets_of(nodes.select("node").distinct()), "node")
            .groupBy("rid").agg(F.collect_list(F.struct("node", "shingles")).alias("s")))  # two blocks' nodes

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for inside, a, b, names, sets in zip(*[pdf[c] for c in ("inside", "a", "b", "node", "shingles")]):
                of = {n: np.frombuffer(x, np.uint64) for n, x in zip(names, sets)}
                done = set()
                for one, two in zip(a, b):
                    if inside and one in done:  # linked with that component already
                        continue
                    x, y = of[one], of[two]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= threshold_percent * (len(x) + len(y) - shared):
                        out.append((one, two))
                        done.add(one)
            yield pd.DataFrame(out, columns=["a", "b"])

    return (lists.join(held, "rid").select("inside", "a", "b", "s.node", "s.shingles").mapInPandas(check, "a binary, b binary"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    threshold_percent: int = 80, bands: int = BANDS, rows: int = ROWS, hashes: int = SIGNATURE,
                    miss: float = MISS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links of similarity (shared
    shingles over all shingles of both) of ``threshold_percent`` or more; ``kept`` marks
    the document of that id. Null, empty and wordless texts have no shingles and link
    with nothing, not even each other. Texts of any length are read whole. Repeated rows are
    equal sets and so linked. A null id counts as larger than any other (a group of null ids
    only has a null component). An empty table gives no row; other columns, of any name, are
    ignored.
    """
    rooted = _rooted(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, threshold_percent=threshold_percent,
                     bands=bands, rows=rows, hashes=hashes, miss=miss, seed=seed)
    lowest = rooted.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("_low"))
    return (rooted.join(lowest, "root", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("_low")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _rooted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
            threshold_percent: int = 80, bands: int = BANDS, rows: int = ROWS, hashes: int = SIGNATURE,
            miss: float = MISS, seed: int = SEED, hashed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, node, root) of every row; with ``hashed`` also the text's hash,
    ``sha``. Rows of one group have one root; those of no words have none."""
    if bands * rows > hashes:
        raise ValueError(f"{bands} bands of {rows} need more than {hashes} hashes")
    a, b = hash_functions(seed, hashes)
    more = ["sha"] if hashed else []

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(shingle_words)
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                s = shingler(text)
                if len(s):
                    minima = signature(s, a, b)
                    out.append((doc_id, len(s), _node(s.tobytes()), minima.astype(np.uint8).tobytes()))
                else:
                    out.append((doc_id, 0, None, None))
            made = pd.DataFrame(out, columns=["doc_id", "n_shingles", "node", "signature"])
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made.assign(**{c: pdf[c].to_numpy() for c in ["said", *more]})

    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("said"))
    described = materialise(source.select("*", *[_text_hash("text").alias(c) for c in more]).mapInPandas(describe, ", ".join(
        ["doc_id long, n_shingles long, node binary, signature binary, said long", *(f"{c} string" for c in more)])))
    members = described.select("doc_id", "n_shingles", "node", "said", *more)

    # Equal sets have equal signatures: one row a node, and of it one a band. A bucket's rows are only counted.
    signatures = materialise(described.filter("node is not null").groupBy("node").agg(F.first("signature").alias("signature")))
    banded = signatures.select("node", F.explode(band_keys(bands, rows)).alias("key"))
    banded = materialise(banded.withColumn("n", F.count("*").over(Window.partitionBy("key"))).filter("n > 1"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # unions would add theirs up

    limits = least_matches(threshold_percent / 100, miss, hashes)

    def closest(offers: DataFrame) -> DataFrame:
        """Of the partners offered to a node (a row for each bucket), the one of most buckets, then of
        the largest ``weight``."""
        often = offers.groupBy("node", "partner").agg(F.count("*").alias("times"), F.max("weight").alias("weight"))
        best = often.groupBy("node").agg(F.max(F.struct("times", "weight", "partner")).alias("m"))
        return best.select(F.col("node").alias("a"), F.col("m.partner").alias("b"))

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(node, shingles): the full sets of the nodes ``wanted``."""
        def shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shingler = Shingler(shingle_words)
            for pdf in batches:
                made = pd.DataFrame({"node": pdf["node"], "shingles": [shingler(t).tobytes() for t in pdf["text"]]})
                yield made[[_node(x) == n for x, n in zip(made["shingles"], made["node"])]]

        # One row stands for a node, by its id and text, as many rows may share either; only the texts
        # of surviving nodes are read again.
        first = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("i"), F.col("said").alias("t"))).alias("m")
        chosen = wanted.join(members.filter("node is not null").groupBy("node").agg(first), "node").select("node", F.col("m.i").alias("i"), F.col("m.t").alias("t"))
        keyed = source.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("i"), F.col("said").alias("t"), "text")
        chosen = materialise(chosen)
        if chosen.count() <= SENT:  # a bounded number: the texts are met where they lie
            chosen = F.broadcast(chosen)
        return keyed.join(chosen, ["i", "t"]).select("node", "text").mapInPandas(shingled, "node binary, shingles binary").dropDuplicates(["node"])

    def linked(pairs: DataFrame) -> DataFrame:
        likely = materialise(pairs)
        wanted = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        return _verified(likely, sets_of(wanted), threshold_percent)

    # Each node with the most central node (that of the largest buckets) it shares most buckets with.
    central = banded.groupBy("node").agg(F.sum("n").alias("reach"))
    leads = banded.join(central, "node").groupBy("key").agg(F.max(F.struct("reach", "node")).alias("m"))
    offers = (banded.join(leads.select("key", F.col("m.node").alias("partner"), F.col("m.reach").alias("weight")), "key")
              .filter("node <> partner"))
    links = materialise(linked(_likely(closest(offers), signatures, limits)))

    def mixed_buckets(roots: DataFrame) -> DataFrame:
        """Rows of the buckets of several roots (nodes without one are their own), with the largest (``main``)."""
        grouped = banded.join(roots, "node", "left").select("key", "n", "node", F.coalesce("root", "node").alias("root"))
        per_root = grouped.groupBy("key", "root").agg(F.count("*").alias("c"))
        largest = (per_root.groupBy("key").agg(F.count("*").alias("roots"), F.max(F.struct("c", "root")).alias("m"))
                   .filter("roots > 1").select("key", F.col("m.root").alias("main")))
        return materialise(grouped.join(largest, "key"))

    # In each bucket of several components: those outside the largest against all others.
    likely = materialise(_likely_across(mixed_buckets(connected_components(links)), signatures, limits))
    across = _verified_lists(likely, sets_of, threshold_percent)
    roots = connected_components(links.unionByName(across).coalesce(parts))

    out = members.filter("node is not null").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Rows without a node have no partner: they take no part in the join.
    return out.unionByName(members.filter("node is null").withColumn("root", F.col("node")), allowMissingColumns=True)


def _text_hash(text_col: str):
    return F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of ``docs``, with all its columns (of any names): that of the
    smallest id (null ids last), then of the smallest text hash; of equal rows one. Rows
    whose text has no words are in no group and all stay. An empty table gives no row."""
    rooted = _rooted(docs, id_col=id_col, text_col=text_col, hashed=True, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("sha").alias("s")))
    grouped = rooted.filter("root is not null")
    chosen = grouped.groupBy("root").agg(first.alias("m")).select(F.coalesce("m.d", F.lit(NO_ID)).alias("i"), F.col("m.s").alias("s"), F.col("m.z").alias("z"))
    copies = grouped.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("i"), F.col("sha").alias("s"), F.col("doc_id").isNull().alias("z")).agg(F.count("*").alias("n"))
    kept = materialise(chosen.join(copies, ["i", "s", "z"]))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("i"),
                       _text_hash(text_col).alias("s"), F.col(f"`{id_col}`").cast("long").isNull().alias("z"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    stay = rows.filter("worded").join(kept.filter("n = 1"), ["i", "s", "z"], "left_semi").unionByName(rows.filter("not worded"))
    if not kept.filter("n > 1").isEmpty():  # of rows of the same id and text one stays
        repeated = rows.filter("worded").join(kept.filter("n > 1"), ["i", "s", "z"], "left_semi")
        stay = stay.unionByName(repeated.dropDuplicates(["i", "s", "z"]))
    return stay.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
