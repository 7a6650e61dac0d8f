"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (
    decontaminate, html_extract, jaccard_join, merkle_manifest, packing, quality_classifier, quality_rules, secret_scan, simhash_dedup,
    spelling_variants, token_counts, toxicity, url_filter,
)
from .common import read, stored

TOKEN_LIMIT = 4096
TOKENIZER = "piece_bpe_32k.model"

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_counts(spark, sf_dir):
    counted = token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op2_packing(spark, sf_dir):
    counted = token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.pack(stored(counted.select("doc_id", "n_tokens"), "lengths"))


@query
def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents"))


@query
def op4_quality_classifier(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    judged = quality_classifier.classify(docs, labels, keep=["doc_id", "lang"])
    return judged.select("doc_id", "lang", F.col("_perplexity").alias("perplexity"), F.col("_threshold").alias("threshold"), F.col("_kept").alias("kept"))


@query
def op5_secret_scan(spark, sf_dir):
    return secret_scan.secret_scan(read(spark, sf_dir, "documents"))


def captures(spark, sf_dir):
    """Every page, fetched on a day of 2024 that follows from its number."""
    day = F.expr("date_add(DATE'2024-01-01', CAST(page_id * 37 % 366 AS INT))")
    return read(spark, sf_dir, "pages").select("page_id", "url", day.alias("fetched_at"))


def list_entries(spark, sf_dir):
    """Dated entries about the hosts, domains and folders of the pages, derived from their names.

    Names whose hash begins with certain digits are listed on a day that the next digits
    give, most are delisted some weeks later, and some of those are listed again.
    """
    url = F.col("url")
    host = url_filter.host_of(url)
    folder = F.regexp_extract(url_filter.path_of(url), r"^/([^/]+)/", 1)
    names = read(spark, sf_dir, "pages").select(F.explode(F.array(
        F.struct(F.lit("hosts").alias("list_name"), F.lit("host").alias("kind"), host.alias("value")),
        F.struct(F.lit("domains").alias("list_name"), F.lit("domain").alias("kind"), F.regexp_extract(host, r"^[^.]+\.(.+\..+)$", 1).alias("value")),
        F.struct(F.lit("folders").alias("list_name"), F.lit("path").alias("kind"), F.when(folder != "", F.concat(host, F.lit("/"), folder, F.lit("/"))).alias("value")),
    )).alias("n")).select("n.*").where("value <> ''").distinct()
    digit = lambda i: F.instr(F.lit("0123456789abcdef"), F.substring(F.md5("value"), i, 1)) - 1
    first = (digit(2) * 16 + digit(3)).cast("int")
    events = F.array(
        F.struct(F.lit(0).alias("wave"), F.lit("add").alias("action"), first.alias("day")),
        F.struct(F.lit(1).alias("wave"), F.lit("remove").alias("action"), (first + 20 + digit(4)).alias("day")),
        F.struct(F.lit(2).alias("wave"), F.lit("add").alias("action"), (first + 60 + digit(5)).alias("day")),
    )
    listed = names.where(digit(1) < 5).select("list_name", "kind", "value", digit(6).alias("_waves"), F.explode(events).alias("e"))
    return listed.where("e.wave = 0 OR (e.wave = 1 AND _waves < 12) OR (e.wave = 2 AND _waves < 6)").select(
        "list_name", "kind", "value", "e.action", F.date_add(F.lit("2024-01-01").cast("date"), F.col("e.day")).alias("at")
    )


@query
def op6_url_filter(spark, sf_dir):
    return url_filter.filter_urls(captures(spark, sf_dir), list_entries(spark, sf_dir))


@query
def op7_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op8_toxicity(spark, sf_dir):
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op9_html_extract(spark, sf_dir):
    return html_extract.extract_text(read(spark, sf_dir, "pages"))


@query
def op10_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(read(spark, sf_dir, "documents")).drop("clean_text")


@query
def op11_simhash_dedup(spark, sf_dir):
    return simhash_dedup.simhash_dedup(read(spark, sf_dir, "documents"))


@query
def op12_spelling_variants(spark, sf_dir):
    return spelling_variants.spelling_variants(read(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark, sf_dir):
    return merkle_manifest.manifest(read(spark, sf_dir, "documents"))
