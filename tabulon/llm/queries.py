"""The operators of this subpackage as named queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.centroids import lloyd, with_inertia
from tabulon.llm.decontamination import find_leaks
from tabulon.llm.hard_negatives import mine_negatives
from tabulon.llm.language import fit_language_model, held_out
from tabulon.llm.line_windows import drop_repeated_windows
from tabulon.llm.packing import pack_documents
from tabulon.llm.personal_data import sanitise, span_list
from tabulon.llm.pieces import encode_pieces
from tabulon.llm.sharding import shard_contiguous, text_size
from tabulon.llm.shingle_join import similar_groups
from tabulon.llm.substrings import drop_repeated_sequences
from tabulon.llm.tables import documents
from tabulon.llm.url_graph import Rule, filter_urls
from tabulon.llm.vectors import near_vectors

SHARDS = 40
RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_sequences(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select(
        "doc_id",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        text_size("text").alias("bytes"),
    )
    return shard_contiguous(rows, F.col("bytes"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(docs, items, ["doc_id"]).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = fit_language_model(docs, ~held_out("doc_id"))
    return model.predict(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(span_list("base"), 256).alias("base_sha256"), span_list("spans").alias("spans"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict", "trust", "distrust")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_repeated_windows(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(documents(spark, sf_dir), piece_model_path(), ["doc_id"])
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, centroids = lloyd(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_inertia(placed, centroids).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sharding": op3_sharding,
    "op4_decontamination": op4_decontamination,
    "op5_language_id": op5_language_id,
    "op6_pii": op6_pii,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_url_filter": op8_url_filter,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_hard_negatives": op13_hard_negatives,
}
