"""The registered queries of this subpackage, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe, convrepair, decontam, licenses, linededup, linkgraph, ngramjoin, packing, quality,
               secrets, spelling, tokenfiles, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

END_ID = 2


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file (its place is a parameter of the operators)."""
    import public_tokenizers
    return public_tokenizers.path(name)


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, read(spark, sf_dir, "labels")))


@_query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.build_index(read(spark, sf_dir, "documents"))
    return decontam.contamination(index, read(spark, sf_dir, "benchmark"))


@_query
def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.resolve(warc.captures(read(spark, sf_dir, "pages")))
    return out.withColumn("headers", warc.header_lines(out["headers"]))


@_query
def op4_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judge(read(spark, sf_dir, "pages"), rounds=linkgraph.ROUNDS)


@_query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.train(docs))


@_query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_files(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), END_ID,
                                      special=True)
    return tokenfiles.read_files(manifest)


@_query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(read(spark, sf_dir, "documents"))


@_query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@_query
def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


@_query
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(read(spark, sf_dir, "documents"))


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convrepair.report(convrepair.damage(read(spark, sf_dir, "conversations")))


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read(spark, sf_dir, "documents"))


@_query
def op13_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("byte_bpe_50k.json")
    return packing.digests(packing.pack(packing.encoded(read(spark, sf_dir, "documents"), path), packing.vocabulary_size(path)))


# ---------------------------------------------------------------------- SQL

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_ALNUM = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BLANK = _words(r"[^\x20\x09-\x0D]+")

ORACLE_SQL["op2_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_ALNUM} AS w FROM documents),
b AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
    FROM b WHERE len(w) > 0)),
dg AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (
    SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
    FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT DISTINCT rid, item_id, dg.n, i FROM dg JOIN bw ON dg.n = bw.n AND dg.g = bw.g),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM m) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN it USING (rid)"""

ORACLE_SQL["op3_warc_revisits"] = warc.ORACLE_SQL
ORACLE_SQL["op4_link_graph"] = linkgraph.oracle_sql()

ORACLE_SQL["op10_ngram_join"] = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_BLANK} AS w FROM documents),
g AS (
  SELECT DISTINCT rid, doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT rid, doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
o AS (SELECT x.rid AS a, y.rid AS b, count(*) AS o FROM g x JOIN g y ON x.s = y.s AND x.rid <> y.rid
      WHERE x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.rid = a JOIN n q ON q.rid = b WHERE 100 * o >= 90 * (p.n + q.n - o)),
reach AS (SELECT rid AS a, rid AS b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT a, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = b GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN n ON n.rid = d.rid LEFT JOIN c ON c.a = d.rid LEFT JOIN k ON k.a = d.rid"""
