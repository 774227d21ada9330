"""The registered queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, covertree, langid, merkle, packing, pii, quality, sentencepieces, simhash, toxicity, urlrules, warc, whitening
from .common import table, text_remainder


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", (text_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, grammar)
    return scored.select("doc_id", (text_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "reading")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))

    def spelt(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(spelt("base"), 256).alias("base_sha256"), spelt("spans").alias("spans"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(table(spark, sf_dir, "pages"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    # A null id is never drawn.
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, lowered).otherwise(F.col("text"))
    found = merkle.verified(
        merkle.manifest(
            table(spark, sf_dir, "documents"), columns, "doc_id", "source", changed=[F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), tampered]
        )
    )
    spelt = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return found.select("doc_id", *spelt, F.lower(F.hex("proof")).alias("proof_sha256"), F.lower(F.hex("folded_root")).alias("folded_root"), "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_quality, op3_language, op4_neighbours, op5_sentencepiece, op6_toxicity, op7_pii, op8_embedding_dedup, op9_simhash, op10_url_rules,
        op11_warc, op12_whitening, op13_merkle
    )
}

ORACLE: dict[str, str] = {
    "op10_url_rules": r"""
WITH rest AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'),
  ('block', 'com', '/de/')),
fit AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT parts.page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|\.)(spam-farm|free-bets|casino-win|cheap-pills|ads-track|adult-x)\.') THEN 'block'
         ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fit ON parts.page_id = fit.page_id
""",
    "op11_warc": """
WITH digests AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS leader FROM pages)
SELECT page_id, payload_bytes,
       list_reduce(list_transform(range(32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (k // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - k % 4 * 5)::INT) & 31) + 1)::BIGINT, 1)),
         lambda a, b: a || b) AS payload_digest,
       CASE WHEN page_id < leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < leader THEN leader END AS refers_to
FROM digests
""",
    "op13_merkle": r"""
WITH RECURSIVE crc(doc_id, crc) AS (
  SELECT doc_id, 4294967295 - list_reduce(
    list_transform(range(8 * length(doc_id::VARCHAR)), lambda k: CASE WHEN k % 8 = 0 THEN ascii(substr(doc_id::VARCHAR, (k // 8 + 1)::BIGINT, 1))::BIGINT ELSE 0 END),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1)), 4294967295)
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
coded AS (
  SELECT documents.doc_id, source, text,
    concat_ws('', CASE WHEN documents.doc_id IS NULL THEN '-' ELSE strlen(documents.doc_id::VARCHAR) || ':' || documents.doc_id END,
      CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END, CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
      CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END) AS start,
    coalesce(crc % 5 = 0, false) AS drawn
  FROM documents LEFT JOIN crc ON documents.doc_id = crc.doc_id),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
  FROM (
    SELECT doc_id, source, sha256(start || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
      sha256(start || CASE WHEN text IS NULL THEN '-' WHEN drawn
        THEN strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        ELSE strlen(text) || ':' || text END) AS used FROM coded)),
low(source, lvl, idx, h, n) AS (
  SELECT source, 0, idx, leaf, n FROM leaves
  UNION ALL
  SELECT source, lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM low WHERE n > 1 GROUP BY source, lvl, idx // 16, n),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
high(lvl, idx, h, n) AS (
  SELECT 100, idx, subroot, n FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM high WHERE n > 1 GROUP BY lvl, idx // 16, n),
steps AS (
  SELECT a.source, 0 AS tree, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM low a JOIN low b ON a.source IS NOT DISTINCT FROM b.source AND a.lvl = b.lvl AND a.idx // 16 = b.idx // 16 WHERE a.n > 1
  GROUP BY a.source, a.lvl, a.idx
  UNION ALL
  SELECT NULL, 1, a.lvl, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), ''),
    coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '')
  FROM high a JOIN high b ON a.lvl = b.lvl AND a.idx // 16 = b.idx // 16 WHERE a.n > 1 GROUP BY a.lvl, a.idx),
paths AS (
  SELECT d.source, d.idx, string_agg(l || r, '' ORDER BY lvl) AS proof, list({'l': l, 'r': r} ORDER BY lvl) AS path
  FROM (
    SELECT d.source, d.idx, s.lvl, s.l, s.r FROM leaves d JOIN steps s ON tree = 0 AND d.source IS NOT DISTINCT FROM s.source
      AND s.idx = d.idx // (16 ** s.lvl)::BIGINT
    UNION ALL
    SELECT d.source, d.idx, s.lvl, s.l, s.r FROM leaves d JOIN subroots ON d.source IS NOT DISTINCT FROM subroots.source
      JOIN steps s ON tree = 1 AND s.idx = subroots.idx // (16 ** (s.lvl - 100))::BIGINT) d
  GROUP BY d.source, d.idx),
done AS (
  SELECT doc_id, leaf, subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_transform(coalesce(path, []), lambda s: {'l': s.l, 'r': s.r}), lambda a, s: {'l': '', 'r': sha256(s.l || a.r || s.r)}, {'l': '', 'r': used}).r AS folded_root
  FROM leaves JOIN subroots ON leaves.source IS NOT DISTINCT FROM subroots.source
    LEFT JOIN paths ON leaves.source IS NOT DISTINCT FROM paths.source AND leaves.idx = paths.idx)
SELECT *, folded_root = root AS verified FROM done
""",
}
