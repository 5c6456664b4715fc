"""Exact deduplication and chat formatting against plain Python."""

import hashlib
import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import chat_roundtrip, chunk_dedup

SPACE = re.compile(r"[\x20\x09-\x0D]")
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def brute_dedup(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[SPACE.sub("", t or "")].append((d, t or ""))
    out = []
    for k, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0]))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(k.encode()).hexdigest()) for d, _ in members]
    return sorted(out)


def digest(df):
    return sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_dedup_equals_brute_force(documents):
    want = brute_dedup([(r.doc_id, r.text) for r in documents.collect()])
    assert digest(chunk_dedup.decide(documents)) == want
    assert digest(chunk_dedup.decide(documents, least=16, most=64)) == want


def test_clashing_identifiers_are_verified(documents):
    # identifiers that many chunks share: the verified numbers must tell them apart
    want = brute_dedup([(r.doc_id, r.text) for r in documents.collect()])
    by_length = lambda c: F.length(F.col(c) if isinstance(c, str) else c).cast("long")
    assert digest(chunk_dedup.decide(documents, identify=by_length)) == want


def test_dedup_of_odd_tables(make_docs):
    assert chunk_dedup.decide(make_docs().limit(0)).collect() == []
    long = "ab cd " * 60_000
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, long), (5, long + "\n"), (6, "a b"), (7, "ab"), (8, "日本語 " * 3000),
            (9, "日本語" * 3000), (10, "é"), (11, "é")]
    assert digest(chunk_dedup.decide(make_docs(*rows))) == brute_dedup(rows)
    twice = chunk_dedup.decide(make_docs((1, "x"), (1, "x"), (None, "x"))).collect()
    assert sorted(r.kept for r in twice) == [False, False, True] and {r.keep_id for r in twice} == {1}


def test_deduplicate_keeps_one_whole_row_a_group(documents, make_docs):
    want = {d for d, _, _, kept, _ in brute_dedup([(r.doc_id, r.text) for r in documents.collect()]) if kept}
    rows = chunk_dedup.deduplicate(documents)
    assert rows.columns == documents.columns and sorted(r.doc_id for r in rows.collect()) == sorted(want)
    same = make_docs((1, "x y"), (1, "x y"), (1, "other"), (2, "xy"))
    assert sorted(r.text for r in chunk_dedup.deduplicate(same).collect()) == ["other", "x y"]


def chat(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    return {r.conv_id: r for r in chat_roundtrip.read_back(chat_roundtrip.format_conversations(df)).collect()}


def check_chat(got, rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        g = got[c]
        assert g.n_turns == len(turns) and g.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert g.loss_chars == len(loss) and g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


piece = st.sampled_from(["<s>", "</s>", "<\\s>", "<\\\\/s>", "[user] ", " [/user]", "[INST]", "a", " ", "\n", "é", "😀", "<", "\\", "/s>", "$1"])
turn = st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 4)), st.sampled_from(["user", "assistant", "system", None, "x]", "a\n"]),
                 st.one_of(st.none(), st.lists(piece, max_size=8).map("".join)))


@SETTINGS
@given(rows=st.lists(turn, min_size=1, max_size=20))
def test_round_trip_of_any_text(spark, rows):
    check_chat(chat(spark, rows), rows)


def test_control_strings_are_escaped_and_marked_spans_hold_the_loss(spark):
    rows = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"), (5, 1, "assistant", "plain")]
    check_chat(chat(spark, rows), rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r.conv_id: r for r in chat_roundtrip.format_conversations(df).collect()}
    assert out[-1].formatted.count("</s>") == 2 and out[-1].escaped_turns == 2 and out[5].escaped_turns == 0
    assert out[5].formatted == "<s>[assistant] plain [/assistant]</s>"
    assert [out[5].formatted[s.start:s.end] for s in out[5].loss_spans] == ["plain"]


def test_chat_of_odd_tables(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (1, 1, "user", "z" * 200_000), (1, 1, "user", "z" * 200_000)]
    check_chat(chat(spark, rows), rows)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_roundtrip.format_conversations(empty).collect() == []


def test_running_starts(spark):
    for n in (0, 1, 2, 511, 512, 513, 1024, 1025, 3000):
        sizes = [(7 * i) % 50 for i in range(n)]
        df = spark.createDataFrame([(sizes,)], "s array<bigint>").select(chat_roundtrip.running_starts(F.col("s")).alias("at"))
        assert df.first().at == [sum(sizes[:i]) for i in range(n)]


def test_spans_that_are_no_turns_are_cut_out_of_the_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "abc"), (1, 1, "assistant", "defg"), (1, 2, "assistant", "h<s>")], "conv_id long, turn long, role string, text string")
    out = chat_roundtrip.format_conversations(df)
    moved = out.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["end"].alias("end"))))
    assert chat_roundtrip.read_back(out).first().loss_chars == 8
    assert chat_roundtrip.read_back(moved).first().loss_chars == 6
    assert chat_roundtrip.read_back(out.withColumn("loss_spans", F.slice("loss_spans", 1, 1))).first().loss_chars == 4


def test_time_grows_with_the_turns(spark):
    import time

    def took(n):
        rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.concat(F.lit("turn </s> number "), F.col("id").cast("string")).alias("text"))
        start = time.time()
        got = chat_roundtrip.read_back(chat_roundtrip.format_conversations(rows)).first()
        assert got.n_turns == n
        return time.time() - start

    took(1000)
    small = took(20_000)
    assert took(40_000) <= 2.5 * small + 1.5
