"""Registered queries of the corpus operators: each runs one over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm import (
    decontaminate,
    extract,
    flatfiles,
    middle,
    mixing,
    packing,
    pseudonyms,
    secrets,
    simhash,
    topk,
    toxicity,
    warc,
    whitening,
)
from starmill.llm.common import read

QUERY_EVERY = 100


def op1_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(read(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where(F.col("vec_id") % QUERY_EVERY == 0), vectors)


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(read(spark, sf_dir, "documents"))


def op3_secret_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op4_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.digest(packing.pieces(read(spark, sf_dir, "documents"))))


def op5_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op6_recurrent_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(read(spark, sf_dir, "pages"))


def op7_ratio_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op8_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatfiles.count_tokens(read(spark, sf_dir, "documents"))


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(read(spark, sf_dir, "pages")))
    return records.withColumn("text", warc.text_of_record(F.col("record"), F.col("content_length"))).drop("record")


def op10_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_block_tree_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.digest(middle.transform(read(spark, sf_dir, "documents")))


def op12_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op13_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pivot_topk,
        op2_feistel_pseudonyms,
        op3_secret_structures,
        op4_cutting_stock_packing,
        op5_simhash_bytes,
        op6_recurrent_blocks,
        op7_ratio_classifier,
        op8_separator_scan,
        op9_warc_derivatives,
        op10_latent_decontamination,
        op11_block_tree_middle,
        op12_systematic_mix,
        op13_block_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op1_pivot_topk": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_block_tree_middle": """
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ), drawn AS (
            SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n,
                CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
            FROM texts
        ), cut AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                     WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), made AS (
            SELECT *, CASE form WHEN 'plain' THEN text
                WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
                ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END AS output
            FROM cut
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(output) AS output_sha256, sha256(text) AS restored_sha256
        FROM made
    """,
    "op12_systematic_mix": """
        WITH sized AS (
            SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
        ), sources AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place
            FROM sized GROUP BY source
        ), weighed AS (
            SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS most FROM sources
        ), filled AS (
            SELECT *, row_number() OVER by_ratio AS k,
                (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
            FROM weighed
            WINDOW by_ratio AS (ORDER BY most / weight, place),
                before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), found AS (
            SELECT arg_min(level, k) AS level FROM filled WHERE level * weight <= most
        ), aims AS (
            SELECT w.source, w.source_size, least(CAST(w.most AS DOUBLE), f.level * w.weight) AS target,
                CAST('0x' || substr(sha256('1:' || coalesce(w.source, '')), 1, 8) AS BIGINT) % 1073741824 AS first
            FROM weighed w, found f
        ), each AS (
            SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size * 1073741824 + 0.5) AS BIGINT) ELSE 0 END AS expected FROM aims
        ), summed AS (
            SELECT d.doc_id, d.source, d.size, e.source_size, e.target, e.expected,
                e.first + CAST(e.expected AS HUGEINT) * (row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS FIRST) - 1) AS before
            FROM sized d JOIN each e ON d.source IS NOT DISTINCT FROM e.source
        ), crossed AS (
            SELECT *, CAST((before + expected) // 1073741824 - before // 1073741824 AS BIGINT) AS copies FROM summed
        )
        SELECT doc_id, source, size, source_size, target, copies, CAST(copies * size AS BIGINT) AS taken FROM crossed
    """,
}
