"""Removing units of text that an earlier document, or the same one earlier, already has.

Units are lines, lines cut at sentence ends, or paragraphs. They are normalised
(A-Z lowered, blanks between words alike), and digests of them are grouped over
the whole table: the earliest ranked occurrence stays, all others are removed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from kimberlite.llm.repeats import Parts, cut, later_ones, occurrences, ranked
from kimberlite.llm.staged import result
from kimberlite.llm.words import BLANK_SEPARATED, FOLDED, placed, stretches, words_of
from kimberlite.sources.scratch import stage

_SENTENCE_END = np.isin(np.arange(256), [ord(c) for c in ".!?"])


def units(texts: list[bytes], kind: str, least_words: int, least_unspaced: int = 20) -> Parts:
    words = words_of(texts, BLANK_SEPARATED)
    if not len(words.start):
        return Parts.none()
    lines = np.cumsum(words.data == ord("\n"))[words.start]
    breaks = np.diff(lines) > (1 if kind == "paragraph" else 0)
    if kind == "sentence":
        breaks |= _SENTENCE_END[words.data[words.end[:-1] - 1]]
    breaks |= np.diff(words.doc) > 0
    first = np.flatnonzero(np.r_[True, breaks])
    beyond = np.r_[first[1:], len(words.start)]
    doc = words.doc[first]
    beyond_ascii = np.r_[0, np.cumsum(words.data >= 0xC0)]  # first bytes of such characters
    unspaced = beyond_ascii[words.end[beyond - 1]] - beyond_ascii[words.start[first]]
    return Parts(
        doc,
        words.start[first] - words.base[doc],
        words.end[beyond - 1] - words.base[doc],
        stretches(words.hash, first, beyond),
        placed(placed(words.data, words.start, words.end, FOLDED), first, beyond),
        (beyond - first >= least_words) | (unspaced >= least_unspaced),
    )


def drop_repeated_units(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    kind: str = "line",
    least_words: int = 5,
    least_unspaced: int = 20,
) -> DataFrame:
    """``(id, text, n_parts, removed)`` for every row of ``docs``.

    ``kind`` is "line", "sentence" (lines, cut after words that end in . ! or ?)
    or "paragraph" (cut at empty lines). ``text`` is what is left; ``removed``
    lists the units taken out, with their UTF-8 byte range in the original and
    the id of the document that keeps the unit. Units of fewer than
    ``least_words`` words stay, as they repeat by chance, unless they have
    ``least_unspaced`` characters beyond ASCII, as a line of a script has that is
    written without blanks.

    Null texts stay null; empty ones have no units. Of documents with equal
    units, the smallest id keeps them, a null id last; rows equal in id and text
    are one document and get the same result, rows that share an id only are
    ranked by the hash of their text. Texts of any length are worked on whole.
    Other columns are not read. An empty table gives an empty result.
    """
    if kind not in ("line", "sentence", "paragraph"):
        raise ValueError(f"unknown kind of unit: {kind}")

    def split(texts: list[bytes]) -> Parts:
        return units(texts, kind, least_words, least_unspaced)

    def make() -> DataFrame:
        texts = ranked(docs, id_column, text_column)
        found = stage(occurrences(texts, split), "units")
        return cut(texts, later_ones(found), split).withColumnRenamed("id", id_column)

    return result(docs.sparkSession, make)
