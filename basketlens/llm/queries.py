"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import (conversation_repair, cover_tree, cutting_stock, minhash, mixing, packing, secrets_scan, token_counts, token_files, topk,
                            toxicity, url_filter, whitening)
from basketlens.llm.common import table

#: Public tokenizer files; a machine that has them elsewhere looks its own path up.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


#: Sequences of operator 9: document count and attention cost take part in the choice of bins.
PACKING = packing.Capacity(weights=(1.0, 0.3, 0.5))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), BYTE_BPE)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), columns=["doc_id", "source"])


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, PACKING)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.audit(table(spark, sf_dir, "conversations"))


def op12_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _secret_sql() -> str:
    """Spans of each kind from the matches and the text between them."""
    def spans(rank: int, rule: secrets_scan.Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        return f"""
  (SELECT list_filter(list_transform(range(len(h)), lambda i: {{
      's': CAST(list_sum(list_transform(g[1:i + 1], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i], lambda x: length(x))), 0) AS BIGINT),
      'r': {rank}, 'n': length(h[i + 1]), 'z': length(z[i + 1])}}), lambda m: m.z >= {rule.shortest})
   FROM (SELECT regexp_extract_all(t, {pattern}) AS h, string_split_regex(t, {pattern}) AS g, regexp_extract_all(t, {pattern}, {rule.group}) AS z))"""

    kinds = ", ".join(f"'{r.kind}'" for r in secrets_scan.RULES)
    joined = "coalesce(array_to_string(list_transform({0}, lambda m: [{1}][m.r + 1] || ':' || m.s || ':' || (m.s + m.n)), ','), '')"
    base = f"list_filter(spans, lambda m: m.r < {len(secrets_scan.BASE_RULES)})"
    counts = ", ".join(f"CAST(len(list_filter(spans, lambda m: m.r = {i})) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(secrets_scan.BASE_RULES))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id, list_sort(list_concat({", ".join(spans(i, r) for i, r in enumerate(secrets_scan.RULES))})) AS spans FROM d)
SELECT doc_id, {counts}, sha256({joined.format(base, kinds)}) AS base_sha256, {joined.format("spans", kinds)} AS spans FROM found"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_token_counts": op2_token_counts,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_secret_scans": op5_secret_scans,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_token_files": op7_token_files,
    "op8_mix_sources": op8_mix_sources,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_cutting_stock_packing": op12_cutting_stock_packing,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": """
WITH parts AS (
  SELECT page_id,
         CASE WHEN instr(url, '://') > 0 THEN translate(regexp_extract(rest, '^[^/?#]*'),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN instr(url, '://') > 0 THEN regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) ELSE '' END AS path
  FROM (SELECT page_id, url, substr(url, instr(url, '://') + 3) AS rest FROM pages)),
rules(action, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fitting AS (
  SELECT page_id, host, path, action, rhost || rpath AS rule,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS place
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON p.page_id = f.page_id AND f.place = 1
""",
    "op3_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
""",
    "op5_secret_scans": _secret_sql(),
    "op8_mix_sources": """
WITH RECURSIVE sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS chars FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN chars > 0 THEN sqrt(chars) / (SELECT sum(sqrt(chars) ORDER BY source) FROM sizes) * (SELECT sum(chars) FROM sizes) / chars ELSE 1.0 END AS rate FROM sizes),
each AS (SELECT source, CAST(greatest(1, ceil(rate / 256.0)) AS INTEGER) AS draws, rate / greatest(1, ceil(rate / 256.0)) AS mean FROM rates),
cdf(source, mean, k, p, c) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM each
  UNION ALL SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < ceil(mean + 12 * sqrt(mean)) + 40),
tables AS (SELECT e.source, e.draws, (SELECT list(c) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM e.source) AS cdf FROM each e),
keyed AS (SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'text' || md5(coalesce(text, ''))) AS key FROM documents),
counted AS (
  SELECT d.doc_id, d.source, d.key, list_sum(list_transform(range(t.draws), lambda j: len(list_filter(t.cdf,
         lambda c: c <= CAST(('0x' || substr(md5('17:' || d.key || ':' || j), 1, 13)) AS BIGINT) / 4503599627370496.0)))) AS copies
  FROM keyed d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copied AS (SELECT doc_id, source, key, unnest(range(CAST(copies AS BIGINT))) AS copy FROM counted)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, md5('17:order:' || key || ':' || copy) AS shuffle_key FROM copied
""",
}
