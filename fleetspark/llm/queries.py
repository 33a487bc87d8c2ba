"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.oracle import ORACLE  # noqa: F401


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and chance of the best grade of every document; grades are toxic 0, poor 1, good 2."""
    from fleetspark.llm.ordinal import grade_documents, train

    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grades = labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).otherwise(1).alias("grade"))
    graded = grade_documents(docs, train(docs, grades, 3))
    return graded.withColumn("kept", F.col("expected_grade") >= 1.2)


def op2_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs and passages of all documents, with the document that has each first."""
    from fleetspark.llm.paragraphs import PARAGRAPH, repeated_paragraphs

    return repeated_paragraphs(_documents(spark, sf_dir), paragraph=PARAGRAPH).withColumnRenamed("first_id", "first_doc_id")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base formats counted and hashed, all spans listed."""
    from fleetspark.llm.secret_scan import BASE_KINDS, secret_scan, span_text

    found = secret_scan(_documents(spark, sf_dir))
    kinds = F.transform("base", lambda x: x["o"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, o))).cast("long").alias(f"n_{k}") for o, k in enumerate(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix of the sources at weights 3, 1, 2 takes."""
    from fleetspark.llm.mixing import mix_sources

    return mix_sources(_documents(spark, sf_dir)).drop("copies")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and the weakly supervised verdict for every document."""
    from fleetspark.llm.quality_rules import quality_rules

    return quality_rules(_documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that 100-byte strings starting earlier cover, removed."""
    from fleetspark.llm.suffix_dedup import cut_repeats

    cut = cut_repeats(_documents(spark, sf_dir))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vector whose id is divisible by 20."""
    from fleetspark.llm.neighbours import nearest_neighbours

    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from fleetspark.llm.simhash import simhash_groups

    return simhash_groups(_documents(spark, sf_dir)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as wavelet shards and read back."""
    import public_tokenizers

    from fleetspark.llm.common import work_path
    from fleetspark.llm.wavelet import read_shards, write_shards

    path = work_path(spark, "wavelet")
    write_shards(_documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_shards(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    import public_tokenizers

    from fleetspark.llm.packing import pack

    pieces = pack(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and sums of distances of every vector after ten rounds from eight hashed starts."""
    from fleetspark.llm.centroids import cluster_vectors

    found = cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    centroid = F.sha2(F.array_join("centroid", ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid.alias("centroid_sha256"))


def op12_phrase_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark passages, and the items found; items with near matches are counted too."""
    from fleetspark.llm.phrases import contaminated_documents

    found = contaminated_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    ids = lambda c: F.array_distinct(F.array_compact(F.transform(c, lambda m: m["item_id"])))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    found = found.select("doc_id", "n_words", hit.alias("n_hit"), F.array_sort(ids("phrases")).alias("items"), F.size(ids("near")).cast("bigint").alias("n_near_items"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), items.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near_items")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product code and error of every vector, errors by label, and the codebooks' hash."""
    import hashlib

    from fleetspark.llm.vector_codes import code_text, compress_vectors

    coded, books = compress_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.select("vec_id", code_text(F.col("codes")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


QUERIES = {
    "op1_ordinal_quality": op1_ordinal_quality,
    "op2_paragraph_dedup": op2_paragraph_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_mix_sources": op4_mix_sources,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_collision_neighbours": op6_collision_neighbours,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_wavelet_tokens": op8_wavelet_tokens,
    "op9_quality_rules": op9_quality_rules,
    "op10_packing": op10_packing,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_phrase_decontamination": op12_phrase_decontamination,
    "op13_vector_codes": op13_vector_codes,
}

