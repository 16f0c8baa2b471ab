"""From raw documents to packed training sequences, stage by stage.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. All but the last return the columns of documents. ``run`` writes every
stage's result as Parquet to the shared folder and reads it back for the next one, so
a lost executor costs one stage at most. ``tests/llm/test_pipeline.py`` compares ``run``
with a brute-force version.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolecall.llm import decontaminate, ngram_join, packing, quality_rules, secret_scan
from rolecall.llm.queries import TOKENIZER
from rolecall.storage import drop_dir, shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines leave the texts; documents that the rules reject leave the table."""
    kept = quality_rules.quality_rules(docs, clean="_clean").where("kept")
    return kept.withColumn("text", F.col("_clean")).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: 0.8 of the five-word shingles."""
    return ngram_join.one_of_each(docs, width=5, percent=80).select(*COLUMNS)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item leave the table."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return docs.where(F.size(decontaminate.benchmark_hits(docs, benchmark)) == 0).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark; every document stays."""
    return secret_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents with their place in sequences of 4096 ids."""
    pieces = packing.token_pieces(docs, TOKENIZER)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack_pieces(digests)


STAGES = [
    ("quality_rules", clean_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_test_items),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_documents),
]

#: Shingle sets, tokens and packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. A stage's table goes once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        built = function(spark, docs, sf_dir)
        built.write.parquet(path)
        if before is not None:
            drop_dir(spark, before)
        docs, before = spark.read.schema(built.schema).parquet(path), path
    return docs
