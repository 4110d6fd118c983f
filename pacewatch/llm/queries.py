"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewatch.llm import (
    bpe,
    exact_dedup,
    hard_negatives,
    langid,
    license_scan,
    line_dedup,
    lm_score,
    merkle,
    mixing,
    quality,
    simhash_dedup,
    topk,
    toxicity,
)
from pacewatch.llm.common import fold, table


def tokenizer_spec(name: str = "word_bpe_49k.json") -> str:
    """Content of a tokenizer file on the driver."""
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and model log-probabilities of every document."""
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_spec())


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, how many are later copies, and the digest of what stays."""
    docs = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return docs.select("doc_id", "n_lines", "n_deleted", digest.alias("text_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate blocks of every document and the licences that their wording confirms."""
    found = license_scan.licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_blocks", F.array_join("licenses", ",").alias("licenses"), "matches")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document; the largest doc_id stays."""
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def _judged(scored: DataFrame, folds: int, held_out: int, cut: float) -> DataFrame:
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return _judged(quality.scored(docs, model), quality.FOLDS, quality.HELD_OUT, 0.5)


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every query vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _judged(toxicity.scored(docs, model), toxicity.FOLDS, toxicity.HELD_OUT, 0.7)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near duplicates of every document."""
    groups = simhash_dedup.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every anchor and positive the ten best rows of other labels within the window of scores."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and folded proof of every document."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.languages(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_topk_search": op8_topk_search,
    "op9_toxicity": op9_toxicity,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_language_id": op13_language_id,
}

ORACLES = {
    "op8_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(a.w, b.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v AS a, v AS b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM p)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op6_exact_dedup": """
        WITH t AS (
            SELECT doc_id,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY body)
    """,
    "op11_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_sum(list_transform(list_zip(a.w, b.w), lambda z: z[1] * z[2])) AS BIGINT) AS score
            FROM v AS a, v AS b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                   row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth
            FROM s WHERE same),
        n AS (
            SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, p.nth ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
            WHERE p.nth <= 5 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
    "op12_merkle_manifest": """
        WITH RECURSIVE
        d AS (
            SELECT doc_id, coalesce('=' || source, '') AS tree,
                   concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
                   coalesce(strlen(text) || ':' || text, '-') AS body,
                   coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered,
                   xor(4294967295, list_reduce(
                       list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
                       lambda acc, c: list_reduce(range(8), lambda x, b: xor(x >> 1, 3988292384 * (x & 1)), xor(acc, c)),
                       4294967295::BIGINT)) AS crc
            FROM documents),
        a AS (
            SELECT doc_id, tree, sha256(head || body) AS leaf, sha256(head || CASE WHEN crc % 5 = 0 THEN lowered ELSE body END) AS held,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS i,
                   count(*) OVER (PARTITION BY tree) AS n
            FROM d),
        up AS (
            SELECT 0 AS level, tree, i, n, leaf AS hash FROM a
            UNION ALL
            SELECT level + 1, tree, i // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY i))
            FROM up WHERE n > 1 GROUP BY level, tree, i // 16, n),
        s AS (
            SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
        over_s AS (
            SELECT 0 AS level, '' AS tree, i, n, hash FROM s
            UNION ALL
            SELECT level + 1, tree, i // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY i))
            FROM over_s WHERE n > 1 GROUP BY level, tree, i // 16, n),
        nodes AS (SELECT 'leaf' AS kind, * FROM up UNION ALL SELECT 'source', * FROM over_s),
        sides AS (
            SELECT c.kind, c.level, c.tree, c.i,
                   coalesce(string_agg(o.hash, '' ORDER BY o.i) FILTER (o.i < c.i), '') || '|'
                   || coalesce(string_agg(o.hash, '' ORDER BY o.i) FILTER (o.i > c.i), '') AS side
            FROM nodes AS c JOIN nodes AS o ON o.kind = c.kind AND o.level = c.level AND o.tree = c.tree AND o.i // 16 = c.i // 16
            WHERE c.n > 1 GROUP BY ALL),
        over_path AS (
            SELECT s.tree, s.hash AS subroot, coalesce(list(x.side ORDER BY x.level) FILTER (x.side IS NOT NULL), []) AS path
            FROM s LEFT JOIN sides AS x ON x.kind = 'source' AND x.i = s.i // (16 ** x.level)::BIGINT GROUP BY ALL),
        leaf_path AS (
            SELECT a.tree, a.i, coalesce(list(x.side ORDER BY x.level) FILTER (x.side IS NOT NULL), []) AS path
            FROM a LEFT JOIN sides AS x ON x.kind = 'leaf' AND x.tree = a.tree AND x.i = a.i // (16 ** x.level)::BIGINT GROUP BY ALL),
        p AS (
            SELECT a.doc_id, a.leaf, a.held, o.subroot, list_concat(l.path, o.path) AS path
            FROM a JOIN leaf_path AS l ON l.tree = a.tree AND l.i = a.i JOIN over_path AS o ON o.tree = a.tree),
        f AS (
            SELECT doc_id, leaf, subroot, (SELECT hash FROM over_s WHERE n = 1) AS root,
                   sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
                   list_reduce(path, lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)), held) AS folded_root
            FROM p)
        SELECT *, folded_root = root AS verified FROM f
    """,
}
