import random
from collections import Counter

import pytest
from llm_samples import documents, frame

from kimberlite.llm import language

PARTS = {
    "en": ["the", "tion", "er", "ing", "st", "ou", "wh", "and"],
    "de": ["sch", "ung", "ein", "keit", "ü", "ß", "der", "ach"],
    "fr": ["eau", "é", "que", "ment", "les", "oi", "ç", "tre"],
}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, x, 60), x, None, None, None, None, None) for i, x in enumerate(list(PARTS) * 40)]
    return language.fit(frame(spark, rows + [(999, None, "xx", *[None] * 5), (998, "text", *[None] * 6)]))


def test_new_texts_of_known_and_unseen_words(spark, model):
    assert model.languages == ["de", "en", "fr"]
    rng = random.Random(77)
    rows = [(i, text(rng, x, 12).upper() + "!", x, None, None, None, None, None) for i, x in enumerate(list(PARTS) * 30)]
    rows += [(500, "schungkeitungeinschach", "de", *[None] * 5)]  # one unseen word
    found = {r["doc_id"]: r for r in language.predict(frame(spark, rows), model).collect()}
    right = sum(found[r[0]]["lang_pred"] == r[2] for r in rows)
    assert right >= len(rows) - 1 and found[500]["lang_pred"] == "de"
    assert all(1 / 3 <= r["score"] <= 1 for r in found.values())


def test_odd_texts(spark, model):
    rows = documents()
    found = language.predict(frame(spark, rows), model).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    plain = {r[0] for r in rows if r[0] is not None and r[1] in (None, "", "   \n\t ", "!!! ???")}
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in found if r["doc_id"] in plain)
    unknown = language.predict(frame(spark, [(1, "你好 世界", *[None] * 6)]), model).first()
    assert unknown["score"] == pytest.approx(1 / 3)


def test_empty_tables(spark, model):
    assert language.predict(frame(spark, []), model).count() == 0
    none = language.fit(frame(spark, []))
    assert language.predict(frame(spark, documents()), none).filter("lang_pred <> 'und'").count() == 0


def test_the_sample_and_the_model_are_bounded(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, x, 60), x, None, None, None, None, None) for i, x in enumerate(list(PARTS) * 100)]
    small = language.fit(frame(spark, rows), most_documents=60, most_words=30, most_grams=60)
    assert all(len(small.hashes[k]) <= (30 if k == 0 else 60) for k in small.hashes)
    assert small.languages == ["de", "en", "fr"]


def test_a_language_of_few_texts_or_many_copies_is_learned(spark):
    """Half of all rows are copies of one text, another language has a single text."""
    rng = random.Random(4)
    texts = [text(rng, "en", 20) for _ in range(3000)]
    for seed in range(3):
        copied, alone = text(random.Random(seed), "de", 20), text(random.Random(seed), "fr", 20)
        rows = [(x, "en") for x in texts] + [(copied, "de")] * 3000 + [(alone, "fr")]
        fitted = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(4), most_documents=60)
        assert fitted.languages == ["de", "en", "fr"]
        # Each text once: 20 of the sample are English, one is the copied text.
        again = language.fit(spark.createDataFrame([(copied, "de"), (alone, "fr")], "text string, lang string"))
        found = spark.createDataFrame([(0, copied), (1, alone), (2, texts[0])], "doc_id bigint, text string")
        assert [r["lang_pred"] for r in language.predict(found, fitted).orderBy("doc_id").collect()] == ["de", "fr", "en"]
        words = [len(again.hashes[0]), len(set(copied.split()) | set(alone.split()))]
        assert words[0] == words[1]
