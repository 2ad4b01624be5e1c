import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_samples import documents, frame
from tokenizers import Tokenizer

from kimberlite.llm.token_files import BATCH_SEQUENCES, SequenceFile, SequenceWriter, read_tokens, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "It's, isn't; we'll 's 'S a'b 12.5% C3PO x² ½ ǅ ß ẞ İstanbul",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <|end",
    "é ́x a,́ Ａ ， b c …!? —x— 'tis",
    "end.​﻿ \x00\x01 ퟿ 👩‍👩 ΑΣ ΑΣ. σς",
]


@pytest.fixture(scope="module")
def rows():
    return documents() + [(20_000 + i, t, None, None, None, None, None, None) for i, t in enumerate(ODD)]


def want(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for row in rows:
        ids = tokenizer.encode(row[1] or "", add_special_tokens=False).ids + [1]
        out.append((row[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out, key=str)


@pytest.mark.parametrize("by_pieces", [True, False])
def test_files_hold_what_the_tokenizer_gives(spark, spread, rows, by_pieces):
    listing = write_tokens(frame(spark, rows), PATH, sequence_length=64, by_pieces=by_pieces)
    found = read_tokens(listing).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found), key=str) == want(rows)
    ordered = sorted(found, key=lambda r: r["start"])
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert ids == sorted(ids)
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
    assert listing.select("file").distinct().count() > 1


def test_random_access_to_sequences_is_a_view(tmp_path):
    path = str(tmp_path / "x.arrows")
    writer = SequenceWriter(path, 32, 1 << 16)
    ids = np.arange(32 * BATCH_SEQUENCES * 3 + 45) % 60_000
    for piece in np.array_split(ids, 17):
        writer.add(piece)
    writer.close()
    file = SequenceFile(path)
    assert len(file) == 3 * BATCH_SEQUENCES + 2 and file.ids[0].dtype == np.uint16
    for i in (0, 1, BATCH_SEQUENCES, len(file) - 1):
        got, mask = file.sequence(i)
        held = ids[i * 32 : i * 32 + 32]
        assert got[: len(held)].tolist() == held.tolist()
        assert mask.to_pylist() == [True] * len(held) + [False] * (32 - len(held))
        assert not got.flags.owndata
    assert file.stretch(2000, 3000).tolist() == ids[2000:5000].tolist()
    assert os.path.getsize(path) < 2.4 * len(ids)


def test_an_empty_table(spark):
    assert read_tokens(write_tokens(frame(spark, []), PATH)).count() == 0
