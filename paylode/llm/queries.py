"""The registered queries: each operator over its whole table, with the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylode.llm import bpe, conversations, minhash, mixing, quality, repeats, spelling, sql, suffix_tree, toxicity, units, urls, vectors, warc
from paylode.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_minmax_near_duplicates", sql.NEAR_DUPLICATES)
def op1(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query("op2_cube_mixing")
def op2(spark, sf_dir):
    return mixing.draws(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Learnt from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out())
    return toxicity.train(table(spark, sf_dir, "documents"), labels)


@query("op3_multiple_instance_toxicity")
def op3(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


@query("op4_line_hashing", sql.UNITS)
def op4(spark, sf_dir):
    spans = F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return units.repeated_units(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_units", "n_removed", "removed_chars", F.array_join(spans, ",").alias("removed_spans"))


@query("op5_warc_index", sql.WARC)
def op5(spark, sf_dir):
    index, folder = warc.write(table(spark, sf_dir, "pages"))
    return warc.read(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op6_byte_level_bpe")
def op6(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_sorted_projections", sql.VECTORS)
def op7(spark, sf_dir):
    return vectors.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_isolation_forest")
def op8(spark, sf_dir):
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


@query("op9_suffix_array_repeats", sql.REPEATS)
def op9(spark, sf_dir):
    spans = F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string")))
    return repeats.repeated_spans(table(spark, sf_dir, "documents")).withColumn("spans", F.array_join(spans, ","))


#: The contract's rules, and the sites whose pages make up the list of URLs.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
SPAM_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


@query("op10_bloom_url_filter", sql.URLS)
def op10(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    spam = pages.select("url", urls.host().alias("host"), urls.path().alias("path")).where(
        F.col("host").rlike(rf"(^|[.])({'|'.join(SPAM_SITES)})[.]example[.]"))
    listed = spam.select(urls.canonical(F.col("host"), F.col("path")).alias("url")).distinct()
    return urls.judge(pages, rules, listed)


@query("op11_bloom_neighbourhoods", sql.SPELLING)
def op11(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"), damage=spelling.DAMAGE)


@query("op12_checkpointed_repair", sql.CONVERSATIONS)
def op12(spark, sf_dir):
    return conversations.audited(table(spark, sf_dir, "conversations"))


@query("op13_suffix_tree_scores")
def op13(spark, sf_dir):
    return suffix_tree.scored(table(spark, sf_dir, "documents"))
