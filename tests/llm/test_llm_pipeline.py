from collections import Counter

import pytest
from llm_samples import documents, frame

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(oracle_sql()) <= names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_dedup", "decontaminate", "mix_sources", "token_output"
    ]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Odd documents through all stages, each written and read again."""
    docs, out = frame(spark, documents()), []
    for name, make in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        made = make(spark, docs, SF_DIR)
        made.write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_keep_columns_and_decide(spark, steps):
    rows = documents()
    columns = frame(spark, rows).columns
    assert all(s.columns == columns for s in steps[:-1])
    first = [tuple(r) for r in steps[0].collect()]
    letters = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter(r[:2] for r in first) <= Counter(r[:2] for r in letters)
    assert len(first) >= len(letters) - 3
    second = [tuple(r) for r in steps[1].collect()]
    named = [r for r in second if r[0] is not None]
    assert len(named) == len({(r[0], r[1]) for r in named}) < len(first)
    assert set(second) <= set(first)
    third = [tuple(r) for r in steps[2].collect()]
    assert set(third) <= set(second)
    mixed = Counter(tuple(r) for r in steps[3].collect())
    assert set(mixed) <= set(third) and max(mixed.values()) <= 3
    assert Counter(r["doc_id"] for r in steps[4].collect()) == Counter(r[0] for r in mixed.elements())


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_empty_tables(spark, stage):
    assert corpus_pipeline.STAGES[stage][1](spark, frame(spark, []), SF_DIR).count() == 0


def test_run_on_the_smallest_tables(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {"doc_id", "start", "n_tokens", "ids_crc32"} == set(found[0].asDict()) and len(found) > 100
    ordered = sorted(found, key=lambda r: r["start"])
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))
