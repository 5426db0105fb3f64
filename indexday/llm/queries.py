"""The operators of this package on the given tables, one query each."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import functions as F

from indexday.llm import bpe, huffman, nndescent
from indexday.llm.book import query
from indexday.llm.common import table
from indexday.llm.hilbert import shard
from indexday.llm.langid import identify_with_folds
from indexday.llm.mixture import mix
from indexday.llm.ngram_join import near_duplicates
from indexday.llm.runs import periodic_runs
from indexday.llm.templates import extract
from indexday.llm.topk import top_k
from indexday.llm.urlrules import judge
from indexday.llm.warc import capture_log, resolve
from indexday.llm.whitening import whiten


@query(
    "op2_top_k",
    sql="""
    WITH v AS (
        SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
        WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    ), pairs AS (
        SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
    )
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
    ) WHERE rank <= 10""",
)
def op2_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_with_folds(docs).select("doc_id", "held_out", "lang_pred", "score")


@query("op3_huffman_ids")
def op3_huffman_ids(spark, sf_dir):
    encode = huffman.tokenizer(public_tokenizers.path("word_bpe_49k.json"), words=bpe.BARE_WORDS, parts=huffman.lower_parts)
    files = huffman.write_ids(table(spark, sf_dir, "documents"), encode, end_id=2)
    return files.read().select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op7_byte_bpe")
def op7_byte_bpe(spark, sf_dir):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(docs, ranks, public_tokenizers.PATTERN, with_bytes=True))


SHARDS = 24


@query("op4_hilbert_shards")
def op4_hilbert_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    body = F.coalesce("text", F.lit(""))
    ties = [F.crc32(body), F.col("doc_id")]
    placed = shard(docs, ["lang", "source", "n_chars"], ties, SHARDS)
    return placed.select(
        "doc_id",
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_source_mixture")
def op5_source_mixture(spark, sf_dir):
    mixture = mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixture.taken().select("doc_id", "size", "source_size", "target", "taken")


@query("op1_main_text")
def op1_main_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))


@query("op10_ngram_jaccard")
def op10_ngram_jaccard(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_embedding_duplicates")
def op8_embedding_duplicates(spark, sf_dir):
    return nndescent.near_duplicates(table(spark, sf_dir, "embeddings")).links


@query(
    "op6_revisits",
    sql=r"""
    WITH parts AS (
        SELECT page_id, html, md5(html) AS sum,
               regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?@]*@)?', '') AS rest
        FROM pages
    ), named AS (
        SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
               regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
               array_to_string(list_sort([p FOR p IN string_split(regexp_extract(rest, '\?(.*)$', 1), '&')
                   IF p <> '' AND NOT regexp_full_match(p, '(utm_[^&=]*|ref|fbclid|gclid)(=[^&]*)?')]), '&') AS query
        FROM parts
    ), keyed AS (
        SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical_url
        FROM named
    ), matched AS (
        SELECT r.page_id, r.canonical_url, max(f.page_id) AS source
        FROM keyed r LEFT JOIN keyed f ON f.canonical_url = r.canonical_url AND f.page_id < r.page_id + 1000
        GROUP BY r.page_id, r.canonical_url
    ), checked AS (
        SELECT m.page_id, m.canonical_url, m.source, f.html, f.sum,
               CASE WHEN m.source IS NULL THEN 'no_response'
                    WHEN m.page_id % 5 = 0 THEN 'changed'
                    WHEN m.page_id % 5 = 2 THEN CASE WHEN m.source = m.page_id THEN 'resolved' ELSE 'changed' END
                    WHEN f.sum = r.sum THEN 'resolved' ELSE 'changed' END AS outcome
        FROM matched m JOIN keyed r ON r.page_id = m.page_id LEFT JOIN keyed f ON f.page_id = m.source
    )
    SELECT page_id * 2 + 1 AS record_id, canonical_url, page_id + 1000 AS captured_at, source * 2 AS refers_to, outcome,
           CASE WHEN outcome = 'resolved' THEN sum END AS body_md5,
           CASE WHEN outcome = 'resolved' THEN strlen(html)::VARCHAR END AS content_length,
           CASE WHEN outcome = 'resolved' THEN 'max-age=120' END AS cache_control,
           CASE WHEN outcome = 'resolved' THEN 'later than day ' || page_id END AS date,
           CASE WHEN outcome = 'resolved' THEN CASE WHEN page_id % 5 = 1 THEN 'W/' ELSE '' END || '"' || sum || '"' END AS etag
    FROM checked""",
)
def op6_revisits(spark, sf_dir):
    found = resolve(capture_log(table(spark, sf_dir, "pages")))
    return found.select(
        "record_id", "canonical_url", "captured_at", "refers_to", "outcome",
        F.md5(F.col("body").cast("binary")).alias("body_md5"),
        F.col("headers")["content-length"].alias("content_length"),
        F.col("headers")["cache-control"].alias("cache_control"),
        F.col("headers")["date"].alias("date"),
        F.col("headers")["etag"].alias("etag"),
    )


def repeated_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document; every tenth, by a hash of its id, repeats a part of itself to its end.

    A null id changes nothing.
    """
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@query("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs(table(spark, sf_dir, "documents"), edit=repeated_words)
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


# The rules of the query.
URL_RULES = """
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
           ('com', '/fr/', 'allow'), ('com', '/de/', 'block')"""


@query(
    "op12_url_rules",
    sql=rf"""
    WITH rules(rule_host, rule_path, judged) AS ({URL_RULES}), parts AS (
        SELECT page_id, row_number() OVER () AS n,
               coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages
    ), fits AS (
        SELECT *, row_number() OVER (PARTITION BY n ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
        FROM parts LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    )
    SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(judged, 'allow') AS verdict
    FROM fits WHERE place = 1""",
)
def op12_url_rules(spark, sf_dir):
    rules = spark.sql(f"SELECT col1 AS host, col2 AS path, col3 AS verdict FROM ({URL_RULES})")
    return judge(table(spark, sf_dir, "pages"), rules)


@query("op13_whitening")
def op13_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
