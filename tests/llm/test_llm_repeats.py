import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pytest
from llm_samples import BLANK_SEPARATED, documents, frame, prose, words

from kimberlite.llm import words as llm_words
from kimberlite.llm.chunk_dedup import drop_repeated_chunks
from kimberlite.llm.chunk_dedup import lines_of as lines_of_texts
from kimberlite.llm.unit_dedup import drop_repeated_units
from kimberlite.llm.unit_dedup import units as units_of
from kimberlite.llm.words import placed


def lines_of(rng):
    """Documents of lines and sentences, some of them shared, some within one document."""
    shared = [prose(rng, rng.randrange(3, 12)) + "." for _ in range(15)]
    block = "\n".join(prose(rng, 9) for _ in range(12))
    rows = []
    for i in range(50):
        lines = [prose(rng, rng.randrange(1, 15)) for _ in range(6)] + rng.choices(shared, k=3)
        rng.shuffle(lines)
        text = rng.choice(["\n", " ", "\n\n"]).join(lines)
        if i % 5 == 0:
            text = text[: len(text) // 2] + "\n" + block + "\n" + text[len(text) // 2 :]
        rows.append((i * 17 % 997, text.upper() if i % 7 == 0 else text, None, None, None, None, None, None))
    return rows


def units(text, kind):
    raw, out, last = (text or "").encode(), [], None
    for m in BLANK_SEPARATED.finditer(raw):
        ends = raw.count(b"\n", last.end(), m.start()) if last else 0
        if last is None or ends > (kind == "paragraph") or (kind == "sentence" and last.group()[-1:] in b".!?"):
            out.append([])
        out[-1].append(m)
        last = m
    return [(u[0].start(), u[-1].end(), b" ".join(words(" ".join(x.group().decode() for x in u)))) for u in out]


@pytest.mark.parametrize("kind", ["line", "sentence", "paragraph"])
def test_units_against_a_plain_version(spark, kind):
    rows = lines_of(random.Random(6)) + [r for r in documents() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())  # ids once; repeated ones below
    first, want = {}, {}
    for r in sorted(rows):
        found = units(r[1], kind)
        gone = []
        for begin, end, key in found:
            if len(key.split()) >= 5 and first.setdefault(key, (r[0], begin)) != (r[0], begin):
                gone.append((begin, end, first[key][0]))
        want[r[0]] = (len(found), gone)
    got = drop_repeated_units(frame(spark, rows), kind=kind).collect()
    assert {r["doc_id"]: (r["n_parts"], [tuple(x) for x in r["removed"]]) for r in got} == want
    assert any(gone for _, gone in want.values())
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        raw, kept, at = (texts[r["doc_id"]] or "").encode(), b"", 0
        for x in r["removed"]:
            kept, at = kept + raw[at : x["begin"]], x["end"]
        assert (r["text"] or "").encode().split() == (kept + b" " + raw[at:]).split()
        assert (r["text"] is None) == (texts[r["doc_id"]] is None)


@pytest.mark.parametrize("kind", ["line", "sentence", "paragraph"])
def test_units_with_other_blanks_or_capitals_are_repeats(spark, kind):
    unit = "this unit of words repeats here."
    texts = [unit, unit.replace(" ", "  "), "\t" + unit.replace(" ", "\t"), unit.replace(" ", " \r") + "\r", unit.upper()]
    if kind == "paragraph":
        texts += [unit.replace(" of ", "\n    of "), unit.replace(" of ", "\r\nof ")]
    rows = [(i, t, *[None] * 6) for i, t in enumerate([*texts, unit.replace("units", "others") + "s", "other " + unit])]
    got = {r["doc_id"]: [x["kept_in"] for x in r["removed"]] for r in drop_repeated_units(frame(spark, rows), kind=kind).collect()}
    assert got == {i: [0] if 0 < i < len(texts) else [] for i in range(len(rows))}


def test_the_second_hash_is_independent_of_the_first(monkeypatch):
    found = units_of([b"a b", b"A  b", b"b a", b"ab", b"a b c", b"c"], "line", 1)
    assert found.hash_2[0] == found.hash_2[1] and len(set(found.hash_2.tolist())) == 5
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 5_000).astype(np.uint64)
    first = np.arange(0, 4_000, 7)
    whole = placed(values, first, first + 900)
    monkeypatch.setattr(llm_words, "_STEP", 1_000)
    assert (placed(values, first, first + 900) == whole).all()


@pytest.mark.parametrize("drop", [drop_repeated_units, drop_repeated_chunks])
def test_repeated_rows_null_ids_and_empty_tables(spark, drop):
    text = "\n".join(f"this is line {i} of the text" for i in range(40))
    rows = [(5, text), (5, text), (3, None), (None, text), (9, text), (9, "other"), (1, "")]
    found = drop(frame(spark, [(*r, *[None] * 6) for r in rows])).collect()
    assert Counter((r["doc_id"], r["text"] == text, bool(r["removed"])) for r in found) == Counter(
        {(5, True, False): 2, (3, False, False): 1, (None, False, True): 1, (9, False, True): 1, (9, False, False): 1, (1, False, False): 1}
    )
    assert drop(frame(spark, [])).count() == 0


def test_chunks_are_found_behind_inserted_lines_and_compared_by_bytes(spark):
    rng = random.Random(11)
    block = [prose(rng, 8, 10**6) for _ in range(60)]
    texts = ["\n".join(block), "\n".join(["new line", "another"] + block), "\n".join(block[:30] + ["inserted"] + block[30:])]
    texts += ["\n".join(block).upper(), "\n".join(block).replace("\n", "\n\n"), prose(rng, 50)]
    rows = [(i, t, None, None, None, None, None, None) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in drop_repeated_chunks(frame(spark, rows)).collect()}
    assert not found[0]["removed"] and not found[5]["removed"]
    # Other bytes are other chunks: capitals, and empty lines in between.
    assert not found[3]["removed"] and not found[4]["removed"]
    for i in (1, 2):
        raw = texts[i].encode()
        taken = sum(x["end"] - x["begin"] for x in found[i]["removed"])
        assert taken > 0.6 * len(raw)
        for x in found[i]["removed"]:
            piece = raw[x["begin"] : x["end"]]
            assert piece in texts[x["kept_in"]].encode() and b"\n" in piece


def test_every_shared_run_of_lines_is_found(spark):
    rng = random.Random(12)

    def lines(n):
        return [prose(rng, 8, 10**6) for _ in range(n)]

    rows, planted = [], {}
    for i in range(60):
        shared = lines(2 + i % 3)
        for j in (0, 1):
            before, after = lines(rng.randrange(4)), lines(rng.randrange(4))
            rows.append((2 * i + j, "\n".join(before + shared + after), *[None] * 6))
        planted[2 * i + 1] = "\n".join(shared)
    rows += [(200 + i, "a single line of text", *[None] * 6) for i in range(3)]
    rows += [(300, "\n".join(["again"] * 5), *[None] * 6), (301, "other\nagain\nanother", *[None] * 6)]
    texts = {r[0]: r[1] for r in rows}
    found = {r["doc_id"]: r for r in drop_repeated_chunks(frame(spark, rows), mean_lines=1).collect()}
    for i, text in texts.items():
        gone = [(text.encode()[x["begin"] : x["end"]].decode(), x["kept_in"]) for x in found[i]["removed"]]
        want = [(planted[i], i - 1)] if i in planted else [(text, 200)] if 200 < i < 203 else []
        assert gone == ([("again\nagain", 300), ("again", 300)] if i == 300 else want)
    assert found[300]["text"].split() == ["again"] * 2 and found[300]["n_parts"] == 5


def plain_chunks(text, least, mean):
    """First and last line of each chunk, by the hash that the operator draws boundaries with."""
    made = lines_of_texts([text])
    n = len(made.start)
    rolling = llm_words.mix(llm_words.grams(made.hash, 2) ^ np.uint64(0x9FB21C651E98DF25)).tolist()
    at = [i for i in range(n) if i == 0 or mean == 1 or (i + 1 < n and rolling[i] % mean == 0)]
    out = []
    for i in at:
        end = [*at, n][min(bisect_left(at, i + least), len(at))]
        if end - i >= least or i == 0:
            out.append((i, end))
    return out


def plain_removed(texts, least, mean):
    """Lines that go from each text: what is alike around a chunk that stands earlier, up to the next chunks."""
    kept = [[x for x in re.split(r"\r\n|\r|\n", t) if x] for t in texts]
    made = [plain_chunks(t.encode(), least, mean) for t in texts]

    def reach(d, a, b):
        starts = [i for i, _ in made[d]]
        before, behind = bisect_left(starts, a), bisect_right(starts, b)
        ends = dict(made[d])
        high = ends[starts[behind]] + 1 if behind < len(starts) else len(kept[d])
        return starts[before - 1] if before else 0, min(high, len(kept[d]))

    first, gone = {}, [set() for _ in texts]
    for d in range(len(texts)):
        for a, b in made[d]:
            e, x = first.setdefault(tuple(kept[d][a:b]), (d, a))
            if (e, x) == (d, a):
                continue
            if e == d:
                gone[d] |= set(range(max(a, x + b - a), b))
                continue
            (low, high), (e_low, e_high) = reach(d, a, b), reach(e, x, x + b - a)
            while a > low and x > e_low and kept[d][a - 1] == kept[e][x - 1]:
                a, x = a - 1, x - 1
            while b < high and x + b - a < e_high and kept[d][b] == kept[e][x + b - a]:
                b += 1
            gone[d] |= set(range(a, b))
    return gone


@pytest.mark.parametrize(("least", "mean"), [(2, 1), (2, 2), (2, 4), (3, 3), (1, 2)])
def test_chunks_against_a_plain_version(spark, least, mean):
    rng = random.Random(21 + mean)
    pool = [[f"line {k} {i} " + prose(rng, 5) for i in range(rng.randrange(1, 25))] for k in range(20)]
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            run = rng.choice(pool)
            a = rng.randrange(len(run))
            lines += run[a : a + rng.randrange(1, 20)] if rng.random() < 0.6 else [prose(rng, 6, 10**6) for _ in range(3)]
        texts.append(rng.choice(["\n", "\n", "\r\n"]).join(lines))
    texts += ["one", "one", "\n".join(["again"] * 7), "\n".join(f"long {i}" for i in range(2500))]
    texts.append("new\n" + "\n".join(f"long {i}" for i in range(100, 2300)))
    rows = [(i, t, *[None] * 6) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r for r in drop_repeated_chunks(frame(spark, rows), least_lines=least, mean_lines=mean).collect()}
    want = plain_removed(texts, least, mean)
    for i, text in enumerate(texts):
        made = lines_of_texts([text.encode()])
        begin = (made.start - 1).tolist()
        got = {k for x in found[i]["removed"] for k, b in enumerate(begin) if x["begin"] <= b < x["end"]}
        assert got == want[i], i
    assert sum(map(len, want)) > 1000


def test_repeated_runs_with_other_line_ends_are_found(spark):
    run = [f"line {i} of a run that repeats" for i in range(6)]
    texts = ["\n".join(run), "\r\n".join(["before", *run, "behind"]), "\r".join(run), "\n\n".join(run)]
    found = {r["doc_id"]: r for r in drop_repeated_chunks(frame(spark, [(i, t, *[None] * 6) for i, t in enumerate(texts)])).collect()}
    assert [found[i]["text"].split() for i in range(3)] == [texts[0].split(), ["before", "behind"], []]
    assert found[3]["text"] == texts[3]


def test_lines_of_a_script_without_blanks_are_units(spark):
    long, short = "这是一个没有空格的句子它在许多文件中重复出现所以应该被删除", "你好世界"
    rows = [(i, f"{t}\nthis line number {i} is like no other", *[None] * 6) for i, t in enumerate([long, long, short, short])]
    found = {r["doc_id"]: len(r["removed"]) for r in drop_repeated_units(frame(spark, rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 0, 3: 0}
