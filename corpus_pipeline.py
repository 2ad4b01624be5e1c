"""Stages from documents to token files; each works on all that the one before kept.

All stages but the last return the columns of documents, whatever these are
besides ``doc_id``, ``text``, ``lang`` and ``source``. Rows without an id are
documents of their own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kimberlite.catalog.registry import table
from kimberlite.llm import language
from kimberlite.llm.decontaminate import contamination
from kimberlite.llm.mixing import mix
from kimberlite.llm.near_dups import near_duplicates
from kimberlite.llm.queries import tokenizer_path
from kimberlite.llm.row_keys import once, rows_with
from kimberlite.llm.shipping import ship
from kimberlite.llm.token_files import read_tokens, write_tokens
from kimberlite.sources.scratch import scratch_root

_KEY = ("doc_id", "text")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: with letters, and a language at least as likely as all others."""
    ship(spark)
    found = language.predict(docs, language.fit(docs))
    rejected = found.filter((F.col("lang_pred") == language.UNKNOWN) | (F.col("score") < 0.5))
    return rows_with(docs, rejected, *_KEY, "left_anti")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    ship(spark)
    found = near_duplicates(docs).filter("doc_id is not null")
    dropped = found.filter("not kept")
    # Texts that share an id and are near duplicates: the smallest hash stays.
    heads = found.filter("kept").groupBy("doc_id").agg(F.min("text_hash").alias("__least"), F.max("text_hash").alias("__most"))
    several = heads.filter("__least < __most")
    others = found.filter("kept").join(several, "doc_id").filter("text_hash > __least").select(*dropped.columns)
    kept = rows_with(docs, dropped.unionByName(others), *_KEY, "left_anti")
    return once(kept, found, *_KEY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words, or a whole shorter item, of the benchmark."""
    ship(spark)
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return rows_with(docs, found.filter(F.size("spans") > 0), *_KEY, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows equal in id, source and text count as one."""
    ship(spark)
    mixed = mix(docs)
    key = ["doc_id", "source", "text_hash"]
    taken = mixed.groupBy(*key).agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows"))
    taken = taken.filter("__copies > 0").withColumnsRenamed({k: f"__{k}" for k in key})
    same = (
        docs["doc_id"].eqNullSafe(taken["__doc_id"])
        & docs["source"].eqNullSafe(taken["__source"])
        & (F.xxhash64(docs["text"]) == taken["__text_hash"])
    )
    joined = docs.join(taken, same)
    marks = ["__doc_id", "__source", "__text_hash"]
    chosen = joined.filter("__rows = 1").unionByName(joined.filter("__rows > 1").dropDuplicates(marks))
    copies = F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")
    return chosen.select(*[docs[c] for c in docs.columns], copies).drop("__copy")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, copies included, and what they hold for each."""
    ship(spark)
    return read_tokens(write_tokens(docs, tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

#: Models, signatures and tokenizers are not expressed in SQL; tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, make in STAGES:
        path = f"{scratch_root(spark)}/kimberlite/pipeline-{name}-{uuid.uuid4().hex}"
        make(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
