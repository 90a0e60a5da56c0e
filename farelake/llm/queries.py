"""One query per operator, over whole tables, and the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import (
    bitslices, decontamination, jaccard, licenses, linededup, packing, quality, sharding, spelling, tokencounts, toxicity, tries, warc,
)
from farelake.llm.common import stage, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def vocabulary() -> str:
    """Path of the vocabulary of the token queries; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


@query("op1_license_scan", licenses.scan_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op2_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokencounts.lengths(table(spark, sf_dir, "documents"), vocabulary())
    # Written, since the sums use it twice and would encode every text twice.
    return tokencounts.suffix_sums(stage(tokencounts.histogram(counted), "token-histogram"))


@query("op3_ngram_jaccard")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def leaked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_line_dedup")
def deduplicated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.col("text").cast("binary")
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.octet_length(kept).cast("bigint").alias("kept_bytes"), F.crc32(kept).alias("kept_crc32")
    )


@query("op6_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query("op7_sharding")
def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assessed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_top_k")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return bitslices.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


@query("op10_warc")
def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = warc.write_archives(table(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_archives(report, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "offset"
    )


@query("op11_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assessed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_spelling_variants", spelling.variants_sql())
def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op13_prefix_trie", tries.trie_sql())
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))
