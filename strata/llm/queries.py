"""One registered query per operator, and the corpus pipeline.

Each query applies its operator, with production parameters, to the whole of its table
and derives the digest columns from the operator's output. ``ORACLE`` holds DuckDB SQL
for those that SQL can express."""

from __future__ import annotations

import os
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (bestfit_packing, chat_roundtrip, chunk_dedup, crosspolytope, html_consensus, lowdisc_mix,
                        minhash_bayes, periodic_runs, quality_qda, relative_lz, spelling_tiles, stratified_shards,
                        toxic_segments)
from strata.llm.common import crc_mod, table

TOKENIZER = "word_bpe_49k.json"
LEAST_SIZED_BATCH = "1000"  # rows a Python batch holds at most, and bytes: bounds the memory of batches of texts
BATCH_BYTES = str(32 << 20)


def tokenizer_path() -> str:
    """The packing tokenizer's file: ``$STRATA_TOKENIZER``, else the public folder's."""
    given = os.environ.get("STRATA_TOKENIZER")
    if given:
        return given
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def prepare(spark: SparkSession) -> None:
    """Session settings of these queries: small Python batches, this package for the tasks."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", LEAST_SIZED_BATCH)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def _held_out(part: int, of: int):
    return (crc_mod(F.col("doc_id"), of) == part).alias("held_out")


def op1_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_qda.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                         learn=crc_mod(F.col("doc_id"), 3) != 1)
    return scored.select("doc_id", _held_out(1, 3), "score", "predicted")


def op2_crosspolytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.components(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_html_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_consensus.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit_packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_chat_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat_roundtrip.read_back(chat_roundtrip.format_conversations(rows.unionByName(more)))


def op6_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_bayes.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, threshold_percent=80)


def op7_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.decide(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_lowdisc_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lowdisc_mix.mix_sources(table(spark, sf_dir, "documents")).taken().select(
        "doc_id", "size", "source_size", "target", "taken")


def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxic_segments.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                            learn=crc_mod(F.col("doc_id"), 4) != 2)
    return scored.select("doc_id", _held_out(2, 4), "score", "predicted", F.size("passages").alias("n_passages"))


def op10_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards.assign_shards(table(spark, sf_dir, "documents"), 40).drop("source")


def op11_relative_lz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative_lz.repeated_passages(table(spark, sf_dir, "documents"), window=50).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _misspelt(doc_id: int | None):
    """Runs of a document as the query reads them: of some, a code point is left out."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(run: str) -> str:
        h = zlib.crc32(run.encode(), start)
        at = h % len(run)
        return run[:at] + run[at + 1:] if h % 97 == 0 else run

    return change


def op12_spelling_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling_tiles.word_counts(table(spark, sf_dir, "documents"), least_length=5, least_count=3, rewrite=_misspelt)
    return spelling_tiles.spelling_groups(counts, ratio=2)


def _with_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of a document as the query reads them: those of some repeat from a place on."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op13_multiscale_minimizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(table(spark, sf_dir, "documents"), least_words=24, least_periods=3, rewrite=_with_period)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _prepared(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {q.__name__: _prepared(q) for q in (
    op1_quality_qda, op2_crosspolytope, op3_html_consensus, op4_bestfit_packing, op5_chat_roundtrip, op6_minhash_bayes,
    op7_chunk_recipes, op8_lowdisc_mix, op9_toxic_segments, op10_stratified_shards, op11_relative_lz,
    op12_spelling_tiles, op13_multiscale_minimizers, pipeline)}

_SPACE = r"[\x20\x09-\x0D]"
# The table of crc32 (its polynomial, bits reversed, is the fixed value 3988292384).
_CRC_TABLE = """
crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b] || list_transform(range(8), lambda k: 0::BIGINT),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS b))
)"""


def _crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of a SQL text that isn't empty, with the table at hand."""
    codes = f"list_transform(string_split(rtrim(regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g')), ' '), lambda x: ('0x' || x)::BIGINT)"
    return (f"xor(4294967295, list_reduce([4294967295::BIGINT] || {codes}, "
            "lambda c, x: xor(c // 256, t[(xor(c, x) % 256) + 1])))")


ORACLE = {
    "op2_crosspolytope": """
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS e FROM embeddings
), ok AS (
  SELECT vec_id, e FROM v
  WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q
    ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e) AND list_cosine_similarity(p.e, q.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
       c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id""",
    "op5_chat_roundtrip": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), shown AS (
  SELECT *, regexp_matches(text, '<\\*/?s>') AS hit,
         regexp_replace(text, '<(\\*)(/?s>)', '<\\\1\2', 'g') AS escaped,
         CASE WHEN regexp_full_match(role, '[a-z0-9_-]+') THEN length(role) ELSE 1 + length(hex(encode(role))) END AS r
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(escaped) + 2 * r + 14)::BIGINT AS formatted_chars,
       count(*) FILTER (hit) AS escaped_turns
FROM shown GROUP BY conv_id""",
    "op6_minhash_bayes": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+'), lambda x: x <> '') AS words FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) = 1 THEN words
         ELSE list_distinct([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) END AS s FROM w
), one AS (SELECT min(doc_id) AS node, s, hash(list_sort(s)) AS h FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), h, s
), merged AS (SELECT min(node) AS node, any_value(s) AS s, h FROM one GROUP BY h
), grams AS (SELECT node, len(s) AS n, unnest(s) AS g FROM merged
), rare AS (
  SELECT node, n, g, row_number() OVER (PARTITION BY node ORDER BY f, g) AS k
  FROM grams JOIN (SELECT g, count(*) AS f FROM grams GROUP BY g) USING (g)
), lead AS (SELECT node, n, g FROM rare WHERE k <= n - (80 * n + 99) // 100 + 1
), cand AS (
  SELECT DISTINCT p.node AS a, q.node AS b FROM lead p JOIN lead q
    ON p.g = q.g AND p.node < q.node AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
), links AS (
  SELECT a, b FROM (
    SELECT c.a, c.b, len(x.s) AS m, len(y.s) AS n, len(list_intersect(x.s, y.s)) AS i
    FROM cand c JOIN merged x ON x.node = c.a JOIN merged y ON y.node = c.b)
  WHERE 100 * i >= 80 * (m + n - i)
), reach AS (
  SELECT node AS a, node AS b FROM merged
  UNION
  SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON r.b = l.a
), comp AS (SELECT a, min(b) AS root FROM reach GROUP BY a)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.root, d.doc_id) AS kept
FROM sets d LEFT JOIN merged m ON m.h = hash(list_sort(d.s)) AND len(d.s) > 0 LEFT JOIN comp c ON c.a = m.node""",
    "op7_chunk_recipes": rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') AS k FROM documents
), ranked AS (
  SELECT doc_id, k, first_value(doc_id) OVER (PARTITION BY k ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY k) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM ranked""",
    "op11_relative_lz": rf"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i + 1:i + 50], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(0, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)
), seen AS (SELECT h, min(doc_id) AS holder FROM windows GROUP BY h HAVING min(doc_id) < max(doc_id)
), covered AS (
  SELECT doc_id, list(DISTINCT i) AS places FROM (
    SELECT doc_id, unnest(range(i, i + 50)) AS i FROM windows JOIN seen USING (h) WHERE holder < doc_id)
  GROUP BY doc_id
), placed AS (
  SELECT doc_id, generate_subscripts(words, 1) - 1 AS i, unnest(words) AS word FROM w
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM placed p ANTI JOIN (SELECT doc_id, unnest(places) AS i FROM covered) c USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op12_spelling_tiles": f"""
WITH RECURSIVE {_CRC_TABLE.strip()}, runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY doc_id, run
), hashed AS (SELECT run, c, {_crc32("doc_id::VARCHAR || ':' || run")} AS h FROM runs, crc_table
), words AS (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), gaps AS (
  SELECT DISTINCT word, n, i, left(word, i - 1) AS before, substr(word, i + 1) AS after
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b USING (i, before, after) WHERE a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.before || g.after = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.before || g.after = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top FROM pairs GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
         CASE WHEN b.top >= 2 * w.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.top) END AS form,
         CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), way AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT way.word, f.form FROM way JOIN formed f ON f.word = way.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN way USING (word) JOIN formed last ON last.word = way.at WHERE last.form IS NULL""",
    "op13_multiscale_minimizers": rf"""
WITH {_CRC_TABLE.strip()}, w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') AS words FROM documents
), h AS (SELECT doc_id, words, len(words) AS n, {_crc32("doc_id::VARCHAR")} AS h FROM w, crc_table
), planted AS (
  SELECT doc_id, n, words, h % 10 = 0 AND n > 0 AS planted, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS k FROM h
), p AS (SELECT *, 1 + (n - a) // k AS p FROM planted
), placed AS (
  SELECT doc_id, n, i, CASE WHEN planted AND i >= a THEN words[a + (i - a) % p + 1] ELSE words[i + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM p)
), equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM placed x JOIN placed y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n
), islands AS (
  SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g, i FROM equal
), stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, g HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), best AS (
  SELECT doc_id, count(*) AS n_runs,
         sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS runs_sha256
  FROM runs GROUP BY doc_id
), top AS (
  SELECT DISTINCT ON (doc_id) doc_id, start, length, period FROM runs r
  WHERE NOT EXISTS (SELECT 1 FROM runs s WHERE s.doc_id = r.doc_id AND s.length * r.period > r.length * s.period)
  ORDER BY doc_id, start, period
), dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM placed ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
       sha256(coalesce(text, '')) AS collapsed_sha256
FROM w LEFT JOIN best USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN kept USING (doc_id)""",
}
