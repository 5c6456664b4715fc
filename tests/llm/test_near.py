"""MinHash and cross-polytope near-duplicates against brute force."""

import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import crosspolytope, minhash_bayes
from strata.llm.common import connected_components
from strata.session import checkpoint_dir, local_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        up[find(a)] = find(b)
    return [find(i) for i in range(n)]


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_near(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    links = []
    for i, x in enumerate(sets):
        for j in range(i):
            y, m = sets[j], len(x & sets[j])
            if x and y and 100 * m >= percent * (len(x) + len(y) - m):
                links.append((i, j))
    root = roots(len(rows), links)
    low = {}
    for (d, _), r in zip(rows, root):
        low[r] = min(low.get(r, d), d)
    return {d: (len(s), low[r], d == low[r]) for (d, _), s, r in zip(rows, sets, root)}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(documents, words):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash_bayes.near_duplicates(documents, shingle_words=words).collect()}
    assert got == brute_near(rows, words, 80)


def test_large_group_of_near_copies_with_strangers(spark, make_docs):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(120):  # a chain of edits: neighbours are alike, the ends are not
        at = rng.integers(0, 300)
        base = base[:at] + [f"e{d}"] + base[at + 1:]
        rows.append((d, " ".join(base)))
    rows += [(1000 + k, " ".join(f"w{i}" if rng.random() < 0.8 else f"q{k}_{i}" for i in range(300))) for k in range(30)]
    docs = make_docs(*rows)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_bayes.near_duplicates(docs, shingle_words=2).collect()}
    assert got == brute_near(rows, 2, 80)


def test_near_duplicates_of_odd_tables(make_docs):
    assert minhash_bayes.near_duplicates(make_docs().limit(0)).collect() == []
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "ONE two"), (7, "É x"), (8, "é x"), (9, "a b " * 40_000), (10, "a b " * 39_000)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_bayes.near_duplicates(make_docs(*rows), shingle_words=2).collect()}
    assert got == brute_near(rows, 2, 80)
    twice = minhash_bayes.near_duplicates(make_docs((1, "a b c"), (1, "a b c"), (None, "a b c"), (1, "other text here")), shingle_words=2).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in twice) == [(-1, 1), (1, 1), (1, 1), (1, 1)]


def test_pruning_bounds_keep_what_reaches_the_threshold():
    rng = np.random.default_rng(0)
    limits = minhash_bayes.least_matches(0.8, 1e-6)
    hits = np.cumsum(rng.random((20_000, 256)) < 0.8, axis=1)
    alive = np.all([hits[:, n - 1] >= m for n, m in limits], axis=0)
    assert alive.mean() > 0.9999
    low = np.cumsum(rng.random((2_000, 256)) < 0.5, axis=1)
    assert np.all([low[:, n - 1] >= m for n, m in limits], axis=0).mean() < 0.001
    assert [n for n, _ in limits] == list(range(32, 257, 32))


def test_signatures_estimate_similarity():
    a, b = minhash_bayes.hash_functions(1, 256)
    shingler = minhash_bayes.Shingler(2)
    x = shingler(" ".join(f"w{i}" for i in range(400)))
    y = shingler(" ".join(f"w{i}" for i in range(100, 500)))
    same = (minhash_bayes.signature(x, a, b) == minhash_bayes.signature(y, a, b)).mean()
    assert abs(same - 299 / 499) < 0.12


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:03}", f"c{i + 1:03}") for i in range(150)] + [("hub", f"s{i:03}") for i in range(200)] + [("x", "x")]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert all(got[f"c{i:03}"] == "c000" for i in range(151)) and all(got[f"s{i:03}"] == "hub" for i in range(200))
    assert connected_components(spark.createDataFrame([], "a string, b string")).collect() == []


def brute_vectors(rows, threshold=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.abs(v).max() > 0]
    links = []
    for p, i in enumerate(ok):
        for j in ok[:p]:
            x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((i, j))
    root = roots(len(rows), links)
    low, n = {}, [0] * len(rows)
    for a, b in links:
        n[a], n[b] = n[a] + 1, n[b] + 1
    for (d, _), r in zip(rows, root):
        low[r] = min(low.get(r, d), d)
    return {d: (n[i], low[root[i]], d == low[root[i]]) for i, (d, _) in enumerate(rows)}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash"))


def digest(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def test_vectors_equal_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert digest(crosspolytope.components(df)) == brute_vectors([(r.vec_id, list(r.embedding)) for r in df.collect()])


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    y = 0.902 * x + np.sqrt(1 - 0.902 ** 2) * z
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    got, want = digest(crosspolytope.components(vectors(spark, rows))), brute_vectors(rows)
    assert sum(got[k] == want[k] for k in want) >= 0.995 * len(want)
    assert all(got[k][0] <= want[k][0] for k in want)


def test_vectors_of_odd_tables(spark):
    assert crosspolytope.components(vectors(spark, []).limit(0)).collect() == []
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]),
            (7, [1.0, 2.0, 3.0]), (8, [2.0, 4.0, 6.0]), (9, [1.0, 2.0, 3.0]), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (12, [1e30, 2e30, 3e30]), (13, [5.0])]
    assert digest(crosspolytope.components(vectors(spark, rows))) == brute_vectors(rows)


@pytest.mark.parametrize("kind,sizes", [
    ("float", {}),
    ("double", {"PASS_BYTES": 1, "PASS_SHARE": 24.0}),               # several tables in a pass
    ("float", {"PASS_BYTES": 1, "GROUP": 1, "DENSE": 1, "TILE": 5}),  # shares of a table, buckets by all axes, matrices
])
def test_vectors_in_passes_of_any_size_equal_brute_force(spark, monkeypatch, kind, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(crosspolytope, name, value)
    rng = np.random.default_rng(6)
    found = []
    for size, spread in ((16, 0.02), (16, 0.2), (5, 0.1)):  # near all of each other; chains about the threshold; another length
        centre = rng.normal(size=size)
        found += [(centre / np.linalg.norm(centre) + rng.normal(size=size) * spread / np.sqrt(size) * 2).tolist() for _ in range(40)]
    found += rng.normal(size=(60, 16)).tolist() + [found[3], [2 * c for c in found[3]], found[90]]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in enumerate(found)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    want = brute_vectors(rows)
    assert digest(crosspolytope.components(df)) == want
    assert max(n for n, _, _ in want.values()) >= 40 and sum(kept for _, _, kept in want.values()) >= 60


def test_disk_of_near_vectors_follows_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(crosspolytope, "PASS_BYTES", 1, raising=False)  # as for a large table
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def written():
        at = [(Path(local_path(checkpoint_dir(spark))), "part-*"), *((Path(d), "shuffle_*.data") for d in local)]
        return sum(p.stat().st_size for folder, names in at for p in folder.rglob(names))

    n, rng = 2000, np.random.default_rng(9)
    before = written()
    crosspolytope.near_vectors(vectors(spark, list(enumerate(rng.normal(size=(n, 64)).tolist()))))
    assert written() - before < n * 4 * 64 * 4  # four times the vectors: files of earlier passes are gone


@pytest.mark.parametrize("block,verified", [(256, 64), (2, 2), (5, 1)])
def test_blocks_of_any_size_give_the_components_of_brute_force(spark, make_docs, monkeypatch, block, verified):
    monkeypatch.setattr(minhash_bayes, "BLOCK", block)
    monkeypatch.setattr(minhash_bayes, "VERIFIED", verified)
    rng = np.random.default_rng(8)
    rows = []
    for g in range(4):  # texts on both sides of the threshold of each other, many apart from the largest group
        base = [f"g{g}w{i}" for i in range(80)]
        for _ in range(22):
            words = list(base)
            for i in rng.choice(80, rng.integers(0, 9), replace=False):
                words[i] = f"x{rng.integers(1 << 30)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + k, rows[k * 7][1]) for k in range(5)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_bayes.near_duplicates(make_docs(*rows), shingle_words=2).collect()}
    want = brute_near(rows, 2, 80)
    assert got == want and 8 < len({c for _, c, _ in want.values()}) < 80


def test_bands_travel_inside_the_signatures(spark, make_docs):
    folder = Path(local_path(checkpoint_dir(spark)))

    def written():
        return sum(p.stat().st_size for p in folder.rglob("part-*"))

    rng = np.random.default_rng(9)
    docs = make_docs(*[(d, " ".join(f"w{i}" for i in rng.integers(0, 1 << 40, 30))) for d in range(1500)])
    before = written()
    got = minhash_bayes.near_duplicates(docs, shingle_words=2).collect()
    assert len(got) == 1500 and all(r.kept for r in got)
    assert written() - before < 1500 * 3.5 * minhash_bayes.SIGNATURE  # a signature, twice, and what names a row


def test_bands_of_signatures(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 2, (300, 16), dtype=np.uint8)
    y = rng.integers(0, 2, (300, 16), dtype=np.uint8)
    rows = spark.createDataFrame([(v.tobytes(),) for v in np.concatenate([x, y])], "signature binary").select(minhash_bayes.band_keys(5, 3))
    keys = [r[0] for r in rows.collect()]
    for band in range(5):
        at = [i for i in range(300) if keys[i][band] == keys[300 + i][band]]
        assert at == np.flatnonzero((x[:, band * 3:band * 3 + 3] == y[:, band * 3:band * 3 + 3]).all(axis=1)).tolist() != []
        want = [any(keys[i][k] == keys[300 + i][k] for k in range(band)) for i in at]
        assert minhash_bayes._met_before(bytes(keys[at[0]][band]), x[at], y[at]).tolist() == want
    assert len({bytes(k) for r in keys for k in r}) == 5 * 8
    with pytest.raises(ValueError):
        minhash_bayes.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), bands=50)
