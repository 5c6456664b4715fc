"""Sharding and mixing against their laws, and against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import lowdisc_mix, stratified_shards

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shards(docs, n=40, **options):
    return stratified_shards.assign_shards(docs, n, **options).collect()


def test_shards_are_even_gapless_and_stratified(documents):
    rows = shards(documents, 7, per_bucket=20)
    text = {r.doc_id: r.text or "" for r in documents.collect()}
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
        data = text[r.doc_id].encode()
        assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data) and r.law == "rows" and r.grown_shard is None
    counts = [len(v) for v in by_shard.values()]
    assert len(rows) == len(text) and len(counts) == 7 and max(counts) - min(counts) <= 1
    assert all(sorted(r.slot for r in v) == list(range(len(v))) for v in by_shard.values())
    share = Counter(r.source for r in documents.collect())
    for v in by_shard.values():
        for source, n in Counter(r.source for r in v).items():
            assert abs(n - share[source] / 7) < 2


def test_shards_agree_between_runs_and_bucketings(documents):
    key = lambda rows: sorted((r.doc_id, r.shard, r.slot) for r in rows)
    once = key(shards(documents))
    assert once == key(shards(documents.repartition(9)))
    assert [x[:2] for x in once] == [x[:2] for x in key(shards(documents, per_bucket=3))]


def test_shards_follow_a_brute_force_order(documents):
    rows = shards(documents, 5)
    placed = sorted(rows, key=lambda r: (r.shard, r.slot))
    # within a source, the order over all shards is its seeded order: fractional ranks grow by 1/n
    seen = defaultdict(list)
    for i, r in enumerate(placed):
        seen[r.source].append(i / len(placed))
    for source, at in seen.items():
        for k, x in enumerate(at):
            assert abs(x - (k + 0.5) / len(at)) <= 1.0 / len(at) + 8 / len(placed)


def test_shards_of_odd_tables(make_docs):
    assert shards(make_docs().limit(0)) == []
    rows = shards(make_docs((1, None, None), (None, "x", None), (3, "", "a"), (3, "", "a"), (4, "y " * 50_000, "b")), 3)
    assert sorted(r.size for r in rows) == [16, 16, 16, 17, 100_016]
    assert Counter(r.shard for r in rows) == {0: 2, 1: 2, 2: 1}


def brute_targets(sizes, epochs=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, closed = sum(sizes.values()), {}
    while True:
        left = total - sum(closed.values())
        open_ = [s for s in names if s not in closed]
        if not open_:
            return closed
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if epochs * sizes[s] <= level * weight[s]]
        if not over:
            return {**closed, **{s: level * weight[s] for s in open_}}
        closed |= {s: epochs * sizes[s] for s in over}


@pytest.mark.parametrize("block", [1024, 7])
def test_mix_meets_its_targets(documents, block):
    rows = lowdisc_mix.mix_sources(documents, block_words=block, per_bucket=30).taken().collect()
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in documents.collect()}
    source = {r.doc_id: r.source for r in documents.collect()}
    sizes = Counter()
    for d, n in size.items():
        sizes[source[d]] += n
    want = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert abs(r.target - want[source[r.doc_id]]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 3 * r.size
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.04 * t + 2 * block


def test_schedule_is_low_discrepancy_and_blocks_are_joined_by_rank(documents):
    mix = lowdisc_mix.mix_sources(documents, block_words=50)
    slots = sorted(mix.schedule.collect(), key=lambda r: r.slot)
    blocks = {r.key: r.blocks for r in mix.sources.collect()}
    share = Counter(r.key for r in slots)
    seen = Counter()
    for i, r in enumerate(slots):
        assert r.rank == seen[r.key] and r.block == r.rank % blocks[r.key]
        seen[r.key] += 1
        if i % 37 == 0:
            assert all(abs(seen[k] - (i + 1) * share[k] / len(slots)) < 6 for k in share)
    takes = Counter((r.key, r.block) for r in slots)
    for r in mix.spans.collect():
        assert takes[(r.key, r.block)] == r.takes and r.finish > r.begin


def test_mixed_documents_are_the_spans(documents):
    taken = {r.doc_id: r.taken for r in lowdisc_mix.mix_sources(documents).taken().collect()}
    got, text = Counter(), {r.doc_id: r.text for r in documents.collect()}
    rows = lowdisc_mix.mixed_documents(documents)
    assert rows.columns == documents.columns
    for r in rows.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
        assert text[r.doc_id].startswith(r.text)
    assert got == Counter({d: n for d, n in taken.items() if n})


def test_mix_of_odd_tables(make_docs):
    assert lowdisc_mix.mix_sources(make_docs().limit(0)).taken().collect() == []
    assert lowdisc_mix.mixed_documents(make_docs((1, None), (2, ""), (3, " \n"))).collect() == []
    docs = make_docs((1, None, None), (2, "a b", None), (3, "c", "x"), (3, "c", "x"), (None, "d " * 30_000, "y"), (5, "", "z"))
    rows = lowdisc_mix.mix_sources(docs).taken().collect()
    assert len(rows) == 6 and all(r.taken <= 3 * r.size for r in rows)
    # the small sources stop at three times their size, the rest goes to the large one
    assert {r.source: round(r.target) for r in rows} == {None: 6, "x": 6, "y": 29_992, "z": 0}
