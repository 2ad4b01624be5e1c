"""Small tables with everything that is odd, and plain versions of what operators compute."""

import random
import re

BLANK_SEPARATED = re.compile(rb"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, kept int, size string"


def words(text, pattern=BLANK_SEPARATED):
    return pattern.findall((text or "").encode().translate(_LOWER))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, n):
    out = text.split(" ")
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def documents(seed=3, n=60):
    """Rows ``(doc_id, text, lang, source, n_chars)`` and three columns whose names clash."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 200)) for _ in range(n)]
    texts = list(base)
    for i in range(0, n, 4):  # near and exact copies
        texts += [edited(rng, base[i], k) for k in (0, 1, 2, 4, 8, 16)]
    texts += ["", None, "   \n\t ", "one", "one", "One\ttwo three", "été naïve 你好", "!!! ???"]
    texts.append(prose(rng, 20_000, 50_000))  # very long
    rows = [
        (i * 7 % 1009, t, ["en", "de", None][i % 3], ["a", "b", None, "é", ""][i % 5], 1, "id", 0, "s")
        for i, t in enumerate(texts)
    ]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1], *rows[1][2:])]  # repeated rows, a repeated id
    rows += [(None, base[5], "en", "a", 1, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows


def frame(spark, rows, schema=SCHEMA, parts=5):
    return spark.createDataFrame(rows, schema).repartition(parts)
