"""Quality and toxicity: held-out accuracy, parts against brute force, odd rows."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import quality_qda, toxic_segments
from strata.llm.common import crc_mod

BIG = "/root/testdata/sf0.01"


def load(spark):
    return spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")


def test_quality_on_held_out_labels(spark):
    docs, labels = load(spark)
    learn = crc_mod(F.col("doc_id"), 3) != 1
    got = quality_qda.score_documents(docs, labels, learn=learn)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").filter(~learn).collect()
    assert len(held) > 80 and np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)


def test_discriminant_equals_plain_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4)) + k for k in range(2)]
    model = quality_qda.moments_to_model(np.array([300.0, 300.0]), np.stack([v.sum(0) for v in x]), np.stack([v.T @ v for v in x]))
    z = (np.concatenate(x) - model.centre) / model.scale
    logs = []
    for k in range(2):
        c = model.covariances[k]
        d = z - model.means[k]
        logs.append(np.log(model.priors[k]) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ij,ij->i", d @ np.linalg.inv(c), d))
    assert np.allclose(model.score(np.concatenate(x)), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-9)


def test_quality_of_odd_tables(spark, make_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    docs = make_docs((1, "fine words here."), (2, "$$$ !!! ###"), (3, None), (4, ""), (None, "x"), (5, "long " * 100_000), (5, "long " * 100_000))
    got = quality_qda.score_documents(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert quality_qda.score_documents(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality_qda.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert all(np.isfinite(quality_qda.statistics(t)).all() for t in (None, "", " ", "a", "\x00", "日本", "1 2 3"))


def test_toxicity_on_held_out_labels(spark):
    docs, labels = load(spark)
    learn = crc_mod(F.col("doc_id"), 4) != 2
    got = toxic_segments.score_documents(docs, labels, learn=learn)
    assert got.count() == docs.count()
    held = got.join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").filter(~learn).collect()
    words = {"idiot", "clown", "loser", "scum", "moron", "trash", "worthless", "pathetic", "stupid", "disgusting"}
    plain = [r for r in held if r.toxic == 0]
    marked = [r for r in held if r.toxic == 1 and words & set(r.text.lower().split())]
    assert len(marked) >= 8 and np.mean([r.predicted for r in marked]) >= 0.85
    assert np.mean([r.predicted for r in plain]) <= 0.05
    for r in marked:  # passages hold the words
        said = [w for p in r.passages for w in r.text.split()[p.first:p.end]]
        assert not r.predicted or words & {w.lower().strip(".,") for w in said}


def test_a_repeated_toxic_passage_counts_in_each_document(spark, make_docs):
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    vocabulary = ["".join(rng.choice(letters, 6)) for _ in range(3000)]
    said = lambda: list(rng.choice(vocabulary, 120))
    passage = "grawlix mumpsimus snollygoster fopdoodle zounderkite rakefire".split()
    rows, labels = [], []
    for d in range(400):
        words = said()
        at = int(rng.integers(0, 120))
        rows.append((d, " ".join(words[:at] + passage * (d < 100) + words[at:])))
        labels.append((d, int(d < 100)))
    copied = ["qq" + w for w in said()]  # words of no other document
    for d in range(400, 450):  # near copies of one toxic document
        words = [*copied]
        words[int(rng.integers(0, 120))] = f"edit{d}"
        rows.append((d, " ".join(words)))
        labels.append((d, 1))
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = make_docs(*rows)
    learnt = toxic_segments.learn_weights(docs.select("doc_id", "text"), labels.withColumnRenamed("toxic", "y"))
    assert all(learnt.of(w) for w in passage) and not any(learnt.of(w) for w in copied)
    got = {r.doc_id: r.predicted for r in toxic_segments.score_documents(docs, labels, learn=F.col("doc_id") % 2 == 0).collect()}
    assert all(got[d] == 1 for d in range(1, 100, 2))  # 50 learnt from, 50 held out
    assert np.mean([got[d] for d in range(101, 400, 2)]) <= 0.05


def brute_segments(scores):
    """All maximal segments by their definition: recursion on the best segment."""
    out = []

    def split(lo, hi):
        best = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 0 and (best is None or total > best[2] or (total == best[2] and b + 1 - a < best[1] - best[0])):
                    best = (a, b + 1, total)
        if best:
            split(lo, best[0])
            out.append(best)
            split(best[1], hi)

    split(0, len(scores))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-8, 8).map(lambda v: v + v / 1000.0), max_size=14))
def test_segments_equal_brute_force(scores):
    got = toxic_segments.segments(np.array(scores))
    want = brute_segments(scores)
    assert np.isclose(sum(s for _, _, s in got), sum(s for _, _, s in want))
    assert np.isclose(max([s for _, _, s in got], default=0), max([s for _, _, s in want], default=0))
    assert all(np.isclose(sum(scores[a:b]), s) and s > 0 for a, b, s in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(1, 30)), max_size=30))
def test_sparse_scan_equals_the_full_one(weights):
    full = toxic_segments.segments(np.array([-0.5 if w is None else float(w) for w in weights]))
    at = [i for i, w in enumerate(weights) if w is not None]
    sparse = toxic_segments.sparse_segments(np.array(at), np.array([float(weights[i]) for i in at]), 0.5)
    assert [(a, b) for a, b, _ in sparse] == [(a, b) for a, b, _ in full]
    assert np.allclose([s for *_, s in sparse], [s for *_, s in full])


def test_lambda_solves_its_equation():
    shares, weights = np.array([0.01, 0.002]), np.array([2.0, 5.0])
    lam = toxic_segments.solve_lambda(shares, weights, 0.15)
    assert abs((shares * np.exp(lam * weights)).sum() + 0.988 * np.exp(-lam * 0.15) - 1) < 1e-6
    assert toxic_segments.solve_lambda(np.array([]), np.array([]), 0.15) == 1.0


def test_toxicity_of_odd_tables(spark, make_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    docs = make_docs((1, "bad word"), (2, "good word"), (3, None), (4, ""), (None, "x"), (5, "long " * 100_000), (5, "long " * 100_000))
    got = toxic_segments.score_documents(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    assert toxic_segments.score_documents(docs.limit(0), labels).collect() == []
    assert len({r.score for r in toxic_segments.score_documents(docs, labels.limit(0)).collect()}) == 1
