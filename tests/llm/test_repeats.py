"""Periodic runs, relative Lempel-Ziv parsing and spelling tiles against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import periodic_runs, relative_lz, spelling_tiles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall(text or "")


# ---------------------------------------------------------------- periodic runs


def brute_runs(words, least=24, periods=3):
    """Every maximal stretch of every period, kept where no smaller period explains it."""
    n, found = len(words), {}
    for p in range(1, n // periods + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, periods * p):
                found.setdefault((i, j + p), p)
            i = j
    return sorted((s, e - s, p) for (s, e), p in found.items())


def patterned(rng, n):
    """Words with periods around the scales' ends, blocks with runs inside and chance repeats."""
    letters, out = rng.choice([1, 2, 3, 40]), []
    while len(out) < n:
        p = rng.choice([1, 2, 5, 8, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100, 127, 128, 150])
        style = rng.random()
        if style < 0.3:
            block = [rng.randrange(letters)] * (p - 1) + [-1]
        elif style < 0.6:
            small = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
            block = (small * p)[:p]
            block[rng.randrange(p)] = -2
        else:
            block = [rng.randrange(letters) for _ in range(p)]
        out += (block * 6)[:int(p * rng.uniform(0.5, 5))] + [rng.randrange(letters) for _ in range(rng.randrange(20))]
    return out[:n]


def test_runs_equal_brute_force():
    rng = random.Random(11)
    total = 0
    for _ in range(400):
        words = patterned(rng, rng.choice([0, 20, 24, 70, 200, 700]))
        want = brute_runs(words)
        total += len(want)
        assert periodic_runs.runs_of(np.array(words, np.int64)) == want
    assert total > 500


@pytest.mark.parametrize("least,periods", [(1, 3), (6, 4), (40, 5)])
def test_runs_of_other_bounds(least, periods):
    rng = random.Random(least)
    for _ in range(60):
        words = patterned(rng, 300)
        assert periodic_runs.runs_of(np.array(words, np.int64), least, periods) == brute_runs(words, least, periods)
    with pytest.raises(ValueError):
        periodic_runs.runs_of(np.zeros(9, np.int64), 1, 2)


def test_run_of_a_very_long_text_takes_little_longer_than_its_words():
    block = list(range(40_000))
    assert periodic_runs.runs_of(np.array(block * 3 + [-1], np.int64)) == [(0, 120_000, 40_000)]
    assert periodic_runs.runs_of(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]


def test_find_runs_of_documents(spark, make_docs):
    rng = random.Random(3)
    texts = [" ".join(f"w{w}" for w in patterned(rng, n)) for n in (30, 200, 500, 900)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(7, None), (8, ""), (9, " \n\t "), (None, texts[1]), (1, texts[1]), (10, "A a " * 12), (11, " x " * 40), (12, "\na\x0b" * 23)]
    got = [r.asDict(recursive=True) for r in periodic_runs.find_runs(make_docs(*rows)).collect()]
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _ in rows)
    by_text = {}
    for d, t in rows:
        words = words_of(t)
        runs = brute_runs(words)
        dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        by_text.setdefault(d, []).append((len(words), runs, best, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    for r in got:
        shape = (r["n_words"], [tuple(x.values()) for x in r["runs"]], r["best"] and tuple(r["best"].values()), r["collapsed"])
        assert shape in by_text[r["doc_id"]]
    assert periodic_runs.find_runs(make_docs(*rows).limit(0)).count() == 0


# ---------------------------------------------------------------- relative Lempel-Ziv


def brute_kept(rows, window):
    """Words each row keeps, windows judged on all rows; null ids are largest."""
    key = lambda d: float("inf") if d is None else d
    first = {}
    for d, t in rows:
        w = words_of(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            first[k] = min(first.get(k, float("inf")), key(d))
    out = []
    for d, t in rows:
        w = words_of(t)
        drop = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < key(d) for j in range(i, i + window)}
        out.append((d, len(w), len(drop), " ".join(x for i, x in enumerate(w) if i not in drop)))
    return sorted(out, key=str)


def kept_by(spark, docs, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in relative_lz.repeated_passages(docs, **options).collect()), key=str)


def passages(rng):
    """Texts that share passages with other words around them, cut at both ends, repeated inside, and copies."""
    shared = [[f"s{k}-{i}" for i in range(160)] for k in range(4)] + [["x"] * 120, [f"r{i % 7}" for i in range(150)]]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += [f"d{d}-{rng.randrange(10 ** 6)}" for _ in range(rng.choice([0, 3, 20, 70]))]
            p = rng.choice(shared)
            a = rng.choice([0, 0, rng.randrange(100)])
            words += p[a:a + rng.choice([10, 48, 49, 50, 51, 52, 80, 160])]
        rows.append((d, " ".join(words)))
    return rows


@pytest.mark.parametrize("window,gram", [(50, 16), (20, 6), (5, 5)])
def test_repeated_passages_equal_brute_force(spark, make_docs, window, gram):
    rng = random.Random(window)
    rows = passages(rng)
    rows += [(70, rows[3][1]), (71, rows[3][1]), (5, rows[3][1]), (5, rows[3][1]), (None, rows[8][1]), (None, rows[8][1]), (72, None), (73, ""),
             (74, " \n "), (-3, rows[20][1].upper()), (-4, rows[20][1].replace(" ", "\n\t")), (75, " ".join(rows[1][1].split()))]
    rng.shuffle(rows)
    got = kept_by(spark, make_docs(*rows), window=window, gram=gram)
    assert got == brute_kept(rows, window)
    assert kept_by(spark, make_docs(*rows).limit(0)) == []


def test_provided_documents_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert kept_by(spark, documents) == brute_kept(rows, 50)


def test_factors_are_the_removed_spans(spark, make_docs):
    a, b = [f"a{i}" for i in range(120)], [f"b{i}" for i in range(60)]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(["x", *a[:50], "y", *b, *a[40:100]])), (4, " ".join(a[:49]))]
    got = {r.doc_id: [tuple(f) for f in r.factors] for r in relative_lz.repeated_passages(make_docs(*rows)).collect()}
    assert got == {1: [], 2: [], 3: [(1, 50), (52, 120)], 4: []}


def test_a_passage_of_very_many_documents_makes_no_pairs(spark, make_docs):
    shared = " ".join(f"p{i}" for i in range(90))
    rows = [(d, f"head{d} {shared} tail{d} " + " ".join(f"o{d}-{i}" for i in range(d % 5))) for d in range(1500)]
    got = {r.doc_id: r.n_removed for r in relative_lz.repeated_passages(make_docs(*rows)).collect()}
    assert got == {d: 90 * (d > 0) for d in range(1500)}


# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    s = next((i for i, (x, y) in enumerate(zip(a[::-1], b[::-1])) if x != y), min(len(a), len(b)))
    return p + min(s, min(len(a), len(b)) - p) >= max(len(a), len(b)) - 1


def brute_groups(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def variants(rng, letters, bases, edits):
    words = set()
    for _ in range(bases):
        base = "".join(rng.choice(letters) for _ in range(rng.randrange(5, 14)))
        words.add(base)
        for _ in range(edits):
            at, kind = rng.randrange(len(base)), rng.randrange(3)
            words.add(base[:at] + ("" if kind == 0 else rng.choice(letters)) + base[at + (kind != 2):])
    return {w: rng.choice([3, 4, 6, 9, 20, 100, 1000]) for w in words if len(w) >= 5}


@pytest.mark.parametrize("letters,tile", [("ab", 256), ("ab", 3), ("abcdeéÿ", 256), ("abcdefghijkl", 8)])
def test_spelling_groups_equal_brute_force(spark, letters, tile):
    rng = random.Random(len(letters) + tile)
    counts = variants(rng, letters, 25, 12)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling_tiles.spelling_groups(df, tile=tile).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute_groups(counts)
    assert any(r[4] > 1 for r in got)


def test_words_beyond_latin_and_of_every_length(spark):
    counts = {"": 3, "a": 9, "aa": 4, "b": 3, "ж" * 30: 8, "ж" * 29: 3, "ж" * 29 + "𐍈": 4, "𐍈жжжжж": 6, "жжжжж": 100, "жжжж": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted(tuple(r) for r in spelling_tiles.spelling_groups(df).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert got == brute_groups(counts)
    assert spelling_tiles.spelling_groups(df.limit(0)).count() == 0


def test_word_counts(spark, make_docs):
    rows = [(1, "Hello, hello HELLO wörld-wide École × x"), (1, "Hello, hello HELLO"), (None, "hello ÉCOLE école"), (2, None), (3, ""), (4, "école " * 3000)]
    got = {r.word: r.n for r in spelling_tiles.word_counts(make_docs(*rows), least_length=4, least_count=1).collect()}
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    want = Counter(w for _, t in rows for w in re.findall("[A-Za-zÀ-ÿ]+", lower(t or "")) if len(w) >= 4)
    assert got == dict(want) and got["École"] == 2 and got["école"] == 3001
    few = spelling_tiles.word_counts(make_docs(*rows), least_length=5, least_count=7).collect()
    assert {(r.word, r.n) for r in few} == {(w, n) for w, n in want.items() if len(w) >= 5 and n >= 7}
    assert spelling_tiles.word_counts(make_docs(*rows).select(F.col("doc_id"), F.col("text")).limit(0)).count() == 0
