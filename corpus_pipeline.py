"""The corpus pipeline: stages over the documents table, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexday.llm import bpe
from indexday.llm.common import free_name, prepared, table
from indexday.llm.langid import UNKNOWN, identify_with_folds, least_scores
from indexday.llm.mixture import mix
from indexday.llm.ngram_join import keyed, representatives
from indexday.operators.sizing import broadcast_if_small

# A text is unlike a language below half the score that 99 % of the language's learning documents reach; with fewer trigrams
# than these nothing but the sign of the score is taken to tell.
SCORE_QUANTILE = 0.01
SCORE_PART = 0.5
TELLING_GRAMS = 32


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, as they are.

    Documents without letters go (null and empty texts among them), those of a score of 0 or below, and those of ``TELLING_GRAMS``
    trigrams or more that score lower than the least score learned for the language (see ``least_scores``), as texts in
    another script or of random letters do. Every row is judged by its own text: repeated rows and ids stay or
    go together, null ids are no case of their own. A language without learning documents of that size has no least score.
    """
    names = [free_name(docs, c) for c in ("lang_pred", "score", "n_grams")]
    # columns with the names of answers are kept aside under free ones
    aside = {c: free for c, free in zip(("lang_pred", "score", "n_grams"), names, strict=True) if c != free and c in docs.columns}
    found = identify_with_folds(docs.withColumnsRenamed(aside), sized=True)
    named = prepared(spark).put("named", found)
    least = broadcast_if_small(least_scores(named, TELLING_GRAMS, SCORE_QUANTILE, SCORE_PART))
    like = (F.col("n_grams") < TELLING_GRAMS) | (F.col("score") >= F.coalesce("least", F.lit(0.0)))
    kept = named.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).join(least, "lang_pred", "left").filter(like)
    return kept.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the row of least doc_id, then set key; of repeated rows one.

    Decisions are made per row, by doc_id and the set of its shingles: a text without copies stays whoever else has its
    doc_id. Only ids that go, or that several rows have, are looked for in the documents; the texts of the others are not
    moved. Documents without words (null and empty texts) or without doc_id are in no class and stay; rows of one doc_id
    without words are one, the least.
    """
    store = prepared(spark)
    found = store.put("found", representatives(docs))
    per_id = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_and("kept").alias("kept"))
    per_id = store.put("per_id", per_id.filter("n > 1 OR NOT kept"))
    moved = broadcast_if_small(per_id.select("doc_id"))
    once = docs.join(moved, "doc_id", "left_anti")
    several = broadcast_if_small(per_id.filter("n > 1").select("doc_id"))
    key = free_name(docs, "set_key")
    repeated = keyed(docs.join(several, "doc_id", "left_semi").select(*docs.columns), key)
    chosen = found.filter("kept AND doc_id IS NOT NULL").select("doc_id", F.col("key").alias(key)).distinct()
    same = (F.col("l.doc_id") == F.col("r.doc_id")) & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    kept = repeated.alias("l").join(chosen.alias("r"), same, "left_semi")
    # the least text of a doc_id and set, with the other columns of its row
    row = F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    first = kept.groupBy("doc_id", key).agg(F.min(row).alias("row"))
    first = first.select(*[F.col("doc_id") if c == "doc_id" else F.col("row")[c].alias(c) for c in docs.columns])
    return once.select(*docs.columns).unionByName(first)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a row for each document and epoch, with the words taken.

    Documents taken whole keep their text and n_chars, those taken in part have their words between single spaces and the n_chars
    of these. Null texts and texts without words have nothing to take and give no row; a null source is a source. Repeated rows are
    documents each. An empty table gives no rows.
    """
    taken = mix(docs).documents()
    return taken.withColumn("n_chars", F.when(F.col("whole"), F.col("n_chars")).otherwise(F.char_length("text"))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row, whole texts.

    Null and empty texts have no ids; repeated rows and ids give a row each, a null doc_id stays null.
    """
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("language", language), ("distinct", distinct), ("mixture", mixture), ("token_ids", token_ids)]

# Language profiles, similarity search and token ids are beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written below the folder in ``spark.checkpoint.dir`` and reread by the next."""
    store = prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = store.put(f"pipeline_{i}_{name}", stage(spark, docs, sf_dir))
    return docs
