"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from rollcall.llm import langid, toxicity
from rollcall.llm.chosen_path import similarity_classes
from rollcall.llm.common import is_held_out, table
from rollcall.llm.curriculum import mix
from rollcall.llm.decontaminate import mark_leaks
from rollcall.llm.hard_negatives import mine, scaled
from rollcall.llm.licenses import scan_licenses
from rollcall.llm.line_dedup import dedup_lines
from rollcall.llm.maxscore import dense_terms, top_k
from rollcall.llm.packing import added_tokens, pack_documents
from rollcall.llm.periodic import collapse_runs
from rollcall.llm.registry import ORACLES, QUERIES, query
from rollcall.llm.token_files import read_blocks, scan_blocks, write_token_files
from rollcall.llm.warc import derive, responses
from rollcall.session import scratch_dir

__all__ = ["ORACLES", "QUERIES"]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


TOP_SQL = """
WITH v AS (
    SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           coalesce(list_sum([z[1] * z[2] FOR z IN list_zip(q.e, c.e)]), 0)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS "rank" FROM s
)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 5
"""


@query("op1_maxscore_top_k", TOP_SQL)
def op1(spark, sf_dir):
    """The five best vectors for every fiftieth one."""
    vectors = dense_terms(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


@query("op2_line_dedup")
def op2(spark, sf_dir):
    """Every document's lines, and which of them stand elsewhere in near the same words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", F.size("removed").alias("n_removed"), "removed", F.length("text").alias("n_chars_left")
    )


@query("op3_warc_derivatives")
def op3(spark, sf_dir):
    """Metadata and conversion records of a response for every page, without their bytes."""
    return derive(responses(table(spark, sf_dir, "pages"))).withColumn("record_crc32", F.crc32("record")).drop("record")


@query("op4_toxic_segments")
def op4(spark, sf_dir):
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op5_language_id")
def op5(spark, sf_dir):
    """Every document's language."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs.select("doc_id", "text"), langid.fit(docs)).select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query("op6_ngram_jaccard_join")
def op6(spark, sf_dir):
    """Every document's class of similar documents and its number of links."""
    return similarity_classes(table(spark, sf_dir, "documents"))


@query("op7_license_scan")
def op7(spark, sf_dir):
    """Licence findings in every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op8_benchmark_leaks")
def op8(spark, sf_dir):
    """The benchmark items that stand in documents, one row for each pair."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_leaks(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query("op9_best_fit_packing")
def op9(spark, sf_dir):
    """Every document's pieces with their sequence and place."""
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, added=added)


@query("op10_token_counts")
def op10(spark, sf_dir):
    """Documents written as flat token files, then counted from the files alone."""
    path = scratch_dir(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, RANKS, public_tokenizers.PATTERN)
    return scan_blocks(read_blocks(spark, path)).select(
        F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("file_no"), "doc_no", "start", "n_tokens", "closed"
    )


# Weights over training time of the first, second and third source and so on; they come to 5, 2 and 1.
SCHEDULES = (((0, 7), (1, 3)), ((0, 2), (1, 2)), ((0, 0), (1, 2)))

MIX_SQL = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           left(md5(coalesce(doc_id::VARCHAR, '')), 13) AS k
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
    FROM docs GROUP BY source
), sources AS (
    SELECT *, CASE number % 3 WHEN 0 THEN 7.0 WHEN 1 THEN 2.0 ELSE 0.0 END::DOUBLE AS w0,
           CASE number % 3 WHEN 0 THEN -4.0 WHEN 1 THEN 0.0 ELSE 2.0 END::DOUBLE AS slope,
           CASE number % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
    FROM totals
), levels AS (
    -- If this source and those before it are full: what is left, per weight of the others.
    SELECT 2.0::DOUBLE * source_size / weight AS ratio,
           (1.5::DOUBLE * sum(source_size) OVER () - sum(2.0::DOUBLE * source_size) OVER full_ones)
           / nullif(sum(weight) OVER () - sum(weight) OVER full_ones, 0) AS level,
           lead(2.0::DOUBLE * source_size / weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, number) AS next_ratio
    FROM sources
    WINDOW full_ones AS (ORDER BY 2.0::DOUBLE * source_size / weight, number)
), level AS (
    SELECT min(level) AS level FROM (
        SELECT level, ratio FROM levels WHERE level >= ratio AND level < next_ratio
        UNION ALL
        SELECT 1.5::DOUBLE * sum(source_size) / sum(weight), 0 FROM sources
        HAVING 1.5::DOUBLE * sum(source_size) / sum(weight) < min(2.0::DOUBLE * source_size / weight)
    )
), targets AS (
    SELECT *, least(2.0::DOUBLE * source_size, (SELECT level FROM level) * weight) AS target FROM sources
), begun AS (
    SELECT d.*, t.source_size, t.target, t.w0, t.slope, t.weight, floor(t.target + 1e-6)::BIGINT AS wanted,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id::VARCHAR, d.size
                             ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS begin
    FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), read AS (
    SELECT *, greatest(0, least(size, wanted - begin))::BIGINT AS once,
           greatest(0, least(size, wanted - begin - source_size))::BIGINT AS again,
           begin::DOUBLE / wanted * weight AS area
    FROM begun
)
SELECT doc_id, size, source_size, target, once + again AS taken,
       CASE WHEN once > 0 THEN round(
           CASE WHEN area > 0 THEN 2 * area / (w0 + sqrt(greatest(w0 * w0 + 2 * slope * area, 0))) ELSE 0.0 END, 6
       ) END AS first_position
FROM read
"""


@query("op12_curriculum_mix", MIX_SQL)
def op12(spark, sf_dir):
    """What a mix of all sources takes of every document, and when."""
    mixed = mix(table(spark, sf_dir, "documents"), SCHEDULES, share=1.5, most=2.0, keep=("doc_id",))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("first_position", 6).alias("first_position"))


NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), u AS (
    SELECT DISTINCT ON (vec_id) * FROM v ORDER BY vec_id, label, e
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
           coalesce(list_sum([z[1] * z[2] FOR z IN list_zip(a.e, b.e)]), 0)::BIGINT AS score
    FROM u a JOIN u b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT * FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS "rank"
    FROM p JOIN s USING (anchor_id)
    WHERE NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, "rank", negative_id, positive_score, negative_score FROM n WHERE "rank" <= 5
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(spark, sf_dir):
    """Hard negatives for every hundredth vector; every seventh one has another label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), scaled(F.col("embedding")).alias("vector"))
    return mine(vectors, F.col("vec_id") % 100 == 0)


def with_runs(docs):
    """(doc_id, text): every tenth document, by its id's hash, repeats a stretch of its words to its end."""
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def repeated(w):
        a = g % F.size(w)
        p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + (i - a) % p).cast("int")))), " ")

    # Bound to a name by the lambda, so that a text is split once.
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark, sf_dir):
    """Periodic runs of words in every document, the greatest one, and hashes of all runs and of the text without them."""
    found = collapse_runs(with_runs(table(spark, sf_dir, "documents")))
    greatest = F.reduce(
        "runs", F.get("runs", F.lit(0)), lambda best, x: F.when(x["length"] > best["length"], x).otherwise(best)
    )
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    named = found.withColumn("best", greatest)
    return named.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
