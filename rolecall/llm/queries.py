"""One query for each operator, with production parameters, over its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.llm import (
    decontaminate, language_id, lexical_search, license_scan, ngram_join, packing, quality_rules, secret_scan, sharding,
    substring_dedup, token_store, url_rules, vector_codes,
)
from rolecall.storage import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op6_rendezvous_shards(spark, sf_dir):
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    sharded = sharding.with_shards(rows, "doc_id", {n: 1.0 for n in range(8)}, grown_weight=1.0)
    return sharding.with_slots(sharded.withColumn("law", F.lit("key"))).withColumn("slot", F.col("slot").cast("bigint"))


@query
def op7_quality_rules(spark, sf_dir):
    return quality_rules.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_chars"
    )


@query
def op2_ngram_jaccard(spark, sf_dir):
    return ngram_join.ngram_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query
def op8_secret_scan(spark, sf_dir):
    base = [r.kind for r in secret_scan.BASE]
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    scanned = documents(spark, sf_dir).select("doc_id", secret_scan.secret_spans(spark, F.col("text")).alias("found"))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    counts = [number(kind).alias(f"n_{kind}") for kind in base]
    of_base = F.filter("found", lambda s: s["kind"].isin(*base))
    return scanned.select("doc_id", *counts, F.sha2(told(of_base), 256).alias("base_sha256"), told(F.col("found")).alias("spans"))


@query
def op3_benchmark_leaks(spark, sf_dir):
    docs = documents(spark, sf_dir)
    hits = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = docs.select("doc_id", F.explode(hits).alias("hit"))
    return found.select("doc_id", "hit.item_id", F.round("hit.score", 6).alias("score"), "hit.question", "hit.answer", "hit.first_word", "hit.last_word")


#: Its place is a parameter of the operators; every executor has the library's files.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@query
def op5_packing(spark, sf_dir):
    pieces = packing.token_pieces(documents(spark, sf_dir), TOKENIZER)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack_pieces(digests)


@query
def op9_token_store(spark, sf_dir):
    path = shared_dir(spark, "tokens")
    token_store.write_tokens(documents(spark, sf_dir), path, TOKENIZER)
    return token_store.read_tokens(spark, path)


PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query
def op4_language_id(spark, sf_dir):
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"))
    model = language_id.train(docs.where("not held_out"), PIECES)
    guess = docs.select("doc_id", "held_out", language_id.predict(docs, model).alias("guess"))
    return guess.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.round("guess.score", 6).alias("score"))


@query
def op10_license_scan(spark, sf_dir):
    found = license_scan.license_scan(documents(spark, sf_dir))
    listed = {c: F.array_join(c, ",") for c in ("base_labels", "labels")}
    return found.withColumns(listed | {"score": F.round("score", 6)})


#: Passages, not phrases: every later occurrence that stands in a run of so many characters.
PASSAGE = 80


@query
def op1_substring_dedup(spark, sf_dir):
    found = substring_dedup.repeated_units(documents(spark, sf_dir), least_chars=PASSAGE)
    return found.withColumnRenamed("kept_id", "kept_doc_id")


@query
def op11_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_ranked_search(spark, sf_dir):
    return lexical_search.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op13_url_rules(spark, sf_dir):
    return url_rules.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
