import math
import os
from collections import Counter

import duckdb
import pytest

from kimberlite.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS FROM '{SF_DIR}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, con, name):
    found = QUERIES[name](spark, SF_DIR)
    names = sorted(found.columns)
    result = con.execute(ORACLES[name])
    order = [[d[0] for d in result.description].index(n) for n in names]
    assert Counter(map(tuple, found.select(*names).collect())) == Counter(
        tuple(r[i] for i in order) for r in result.fetchall()
    )


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op2_source_mix", {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}),
        ("op3_toxicity", {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}),
        ("op5_language", {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}),
        ("op6_token_files", {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}),
        (
            "op8_language_model",
            {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint", "train_tokens": "bigint",
             "base_score": "double", "score": "double"},
        ),
        ("op9_repeated_units", {"doc_id": "bigint", "text": "string", "n_removed": "bigint"}),
        ("op10_repeated_chunks", {"doc_id": "bigint", "text": "string", "n_removed": "bigint"}),
    ],
)
def test_other_queries_return_every_document(spark, name, columns):
    found = QUERIES[name](spark, SF_DIR)
    assert columns.items() <= dict(found.dtypes).items()
    ids = [r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()]
    rows = found.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op5_language"](spark, SF_DIR).filter("held_out").join(docs, "doc_id")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()
