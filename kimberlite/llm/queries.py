"""Registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kimberlite.catalog.registry import table
from kimberlite.llm import language, language_model, sql, toxicity
from kimberlite.llm.centroids import centroid_clusters
from kimberlite.llm.chunk_dedup import drop_repeated_chunks
from kimberlite.llm.credentials import credentials
from kimberlite.llm.decontaminate import contamination
from kimberlite.llm.hard_negatives import hard_negatives
from kimberlite.llm.mixing import mix
from kimberlite.llm.near_dups import near_duplicates
from kimberlite.llm.shipping import ship
from kimberlite.llm.token_files import read_tokens, write_tokens
from kimberlite.llm.unit_dedup import drop_repeated_units
from kimberlite.llm.vector_dups import near_vectors

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @functools.wraps(run)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return run(spark, sf_dir)

        QUERIES[name] = shipped
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


@query("op7_near_duplicates", sql.NEAR_DUPLICATES)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op1_benchmark_contamination", sql.CONTAMINATION)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), span_words=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query("op2_source_mix")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op5_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out(5, 0)
    model = language.fit(docs.filter(~held_out))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op6_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = write_tokens(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return read_tokens(listing)


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out(3, 1)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", predicted, "passages")


def _held_out(folds: int, which: int) -> Column:
    """Whether the document's fold is the one held out; one without an id always is."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    return F.coalesce(fold == which, F.lit(True))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_near_vectors", sql.NEAR_VECTORS)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least_cosine=0.9)


@query("op9_repeated_units")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup_result(drop_repeated_units(table(spark, sf_dir, "documents"), kind="sentence"))


@query("op10_repeated_chunks")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup_result(drop_repeated_chunks(table(spark, sf_dir, "documents")))


def _dedup_result(found: DataFrame) -> DataFrame:
    n_removed = F.size("removed").cast("bigint")
    n_bytes = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["begin"])
    return found.select(
        "doc_id", "text", "n_parts", n_removed.alias("n_removed"), n_bytes.alias("bytes_removed"), "removed"
    )


@query("op8_language_model")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out(7, 2)
    model = language_model.fit(docs.filter(~held_out))
    return language_model.score(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "perplexity",
    )


@query("op11_centroid_clusters", sql.CLUSTERS)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroid_clusters(table(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, scale=256)
    components = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(components, 256).alias("centroid_sha256")
    )


@query("op12_hard_negatives", sql.HARD_NEGATIVES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=5, least_percent=80, scale=256)


@query("op13_credentials", sql.CREDENTIALS)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = credentials(table(spark, sf_dir, "documents"), reach=200)

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(joined(F.filter("spans", lambda s: ~s["weak"])), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
