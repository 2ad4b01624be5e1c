"""Token ids in Arrow stream files of equal-length sequences.

Documents are range-partitioned and sorted by id. Each task joins the ids of its
documents, each followed by an end id, cuts them into sequences of one length
and writes record batches of two fixed-size lists: the ids, and a mask that is
false on the padding of the file's last sequence. Nothing is compressed, so a
memory-mapped file gives any sequence as a view. A listing says for each
document its file, its place there and its place in the whole; only files it
names count, so a task that ran twice leaves at most a file nobody reads.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kimberlite.llm.rows import runs
from kimberlite.llm.shared_files import read_from, write_to
from kimberlite.llm.words import BLANK_SEPARATED, blocks, words_of
from kimberlite.sources.scratch import scratch_root, stage

#: Distinct pieces of text whose ids a worker keeps; about 20 bytes each.
CACHED_PIECES = 2_000_000
#: Pieces that the tokenizer gets at once.
_ENCODED = 2_000
#: Sequences per record batch.
BATCH_SEQUENCES = 64

# 1: ASCII letters and digits; 2: ASCII punctuation except ' < > |, which take part in
# contractions and special tokens.
_KINDS = np.zeros(256, np.uint8)
_KINDS[[b for b in range(33, 127) if chr(b) not in "'<>|"]] = 2
_KINDS[[b for b in range(128) if chr(b).isalnum()]] = 1
_encoders: dict[tuple, Encoder] = {}


class Encoder:
    """Ids of texts by a tokenizers file, remembered for each distinct piece of text.

    ``by_pieces`` is for tokenizers that drop blanks, lower-case A-Z and never
    join ASCII letters or digits with ASCII punctuation: there, the ids of a text
    are those of its pieces in turn. Others encode each text as it is, as do
    texts with a special token in them.
    """

    def __init__(self, path: str, by_pieces: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_pieces = by_pieces
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content.lower().encode() for t in added]
        self.kind = _id_kind(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.empty(0, np.uint64)
        self.begin = np.empty(0, np.uint32)
        self.count = np.empty(0, np.uint32)
        self.ids = np.empty(1 << 16, self.kind)
        self.used = 0

    @classmethod
    def of(cls, path: str, by_pieces: bool) -> Encoder:
        """One per worker process."""
        if (path, by_pieces) not in _encoders:
            _encoders[path, by_pieces] = cls(path, by_pieces)
        return _encoders[path, by_pieces]

    def _encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), _ENCODED):
            strings = [t.decode("utf-8", "replace") for t in texts[at : at + _ENCODED]]
            for found in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False):
                yield np.array(found.ids, self.kind)

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, each with its end id, and how many each has."""
        whole = [i for i, t in enumerate(texts) if not self.by_pieces or self._has_special(t)]
        apart = dict(zip(whole, self._encode([texts[i] for i in whole])))
        words = words_of([b"" if i in apart else t for i, t in enumerate(texts)], BLANK_SEPARATED, _KINDS)
        at = self._find(words)
        begin, count = self.begin[at].astype(np.int64), self.count[at].astype(np.int64)
        n = np.bincount(words.doc, weights=count, minlength=len(texts)).astype(np.int64)
        for i, ids in apart.items():
            n[i] = len(ids)
        n += 1
        ends = np.cumsum(n)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        # A piece's ids go after those of the pieces before it in its text.
        before = np.cumsum(count) - count
        text_first = np.r_[before, count.sum()][words.first[:-1]] if len(count) else np.zeros(len(texts), np.int64)
        target = (ends - n)[words.doc] + before - text_first[words.doc]
        step = np.arange(int(count.sum())) - np.repeat(before, count)
        out[np.repeat(target, count) + step] = self.ids[np.repeat(begin, count) + step]
        for i, ids in apart.items():
            out[ends[i] - n[i] : ends[i] - 1] = ids
        out[ends - 1] = end_id
        return out, n

    def _has_special(self, text: bytes) -> bool:
        return any(s in low for low in [text.lower()] for s in self.special)

    def _find(self, words) -> np.ndarray:
        """Place of each piece among the remembered ones, after adding new ones."""
        kinds, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHED_PIECES:
            self._forget()
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, kinds), len(self.hashes) - 1)
            new = self.hashes[at] != kinds
        else:
            new = np.ones(len(kinds), bool)
        if new.any():
            pieces = [words.data[words.start[i] : words.end[i]].tobytes() for i in first[new]]
            ids = list(self._encode(pieces))
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            total = int(count.sum())
            if self.used + total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty(len(self.ids) // 2 + total, self.kind)])
            self.ids[self.used : self.used + total] = np.concatenate(ids)
            place = np.searchsorted(self.hashes, kinds[new])
            self.begin = np.insert(self.begin, place, (self.used + np.cumsum(count) - count).astype(np.uint32))
            self.count = np.insert(self.count, place, count.astype(np.uint32))
            self.hashes = np.insert(self.hashes, place, kinds[new])
            self.used += total
        return np.searchsorted(self.hashes, kinds)[which]


def write_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 1,
    sequence_length: int = 2048,
    by_pieces: bool = True,
    folder: str | None = None,
) -> DataFrame:
    """Write token files and return their listing, one row for each row of ``docs``.

    Columns: the id, ``part`` and ``file``, ``first`` (the document's place among
    the file's ids), ``n_tokens`` with the end id, and ``start``, the number of
    ids of all documents before it. Documents are in ascending order of id, null
    first, those that share an id in an order of their texts' hashes. Null and
    empty texts have the end id only; texts of any length are written whole, over
    several sequences where needed. Other columns are not read. An empty table
    writes no file. Ids are 16 or 32 bit, whichever holds the vocabulary.

    ``tokenizer_path`` must exist on every machine. Files go to ``folder``, or to
    a new one beside the staged tables.
    """
    target = folder or f"{scratch_root(docs.sparkSession)}/kimberlite/tokens-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_path, by_pieces)
        part = TaskContext.get().partitionId()
        writer = None
        for batch in batches:
            for begun, some in blocks(batch.column("text")):
                if writer is None:
                    writer = SequenceWriter(
                        f"{target}/part-{part:06d}-{uuid.uuid4().hex}.arrows",
                        sequence_length,
                        encoder.tokenizer.get_vocab_size(with_added_tokens=True),
                    )
                ids, n = encoder.encode(some, end_id)
                first = writer.written + np.cumsum(n) - n
                writer.add(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(begun, len(some)),
                        pa.array(np.full(len(some), part, np.int32)),
                        pa.array([writer.path] * len(some), pa.string()),
                        pa.array(first, pa.int64()),
                        pa.array(n, pa.int64()),
                    ],
                    names=["id", "part", "file", "first", "n_tokens"],
                )
        if writer is not None:
            writer.close()

    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)
    listing = stage(
        ordered.mapInArrow(write, "id bigint, part int, file string, first bigint, n_tokens bigint"), "listing"
    )
    # One number per partition.
    sizes = dict(listing.groupBy("part").agg(F.sum("n_tokens")).collect())
    before = accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0)
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    start = F.element_at(offsets, F.col("part") + 1) + F.col("first")
    return listing.withColumn("start", start).withColumnRenamed("id", id_column)


def _id_kind(vocabulary: int) -> type:
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


class SequenceWriter:
    """Cuts ids into sequences and writes them as record batches."""

    def __init__(self, path: str, length: int, vocabulary: int):
        self.path, self.length, self.written = path, length, 0
        self.kind = _id_kind(vocabulary)
        self.schema = pa.schema(
            [
                ("input_ids", pa.list_(pa.from_numpy_dtype(self.kind), length)),
                ("mask", pa.list_(pa.bool_(), length)),
            ]
        )
        self.file = write_to(path)
        self.out = pa.ipc.new_stream(self.file, self.schema)
        self.rest = np.empty(0, self.kind)

    def add(self, ids: np.ndarray) -> None:
        self.written += len(ids)
        ids = np.concatenate([self.rest, ids.astype(self.kind)])
        size = self.length * BATCH_SEQUENCES
        for at in range(0, len(ids) - size + 1, size):
            self._write(ids[at : at + size])
        self.rest = ids[len(ids) // size * size :]

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, self.kind)
        padded[: len(ids)] = ids
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(values), self.length)
            for values in (padded, np.arange(len(padded)) < len(ids))
        ]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if len(self.rest):
            self._write(self.rest)
        self.out.close()
        self.file.close()


class SequenceFile:
    """Random access to a token file; arrays are views of the mapped file."""

    def __init__(self, path: str):
        self.batches = list(pa.ipc.open_stream(read_from(path)))
        self.length = self.batches[0].schema.field("input_ids").type.list_size if self.batches else 0
        self.ids = [b.column("input_ids").flatten().to_numpy() for b in self.batches]

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of the sequence numbered ``i``."""
        batch, row = divmod(i, BATCH_SEQUENCES)
        mask = self.batches[batch].column("mask").flatten()
        return self.ids[batch][row * self.length : (row + 1) * self.length], mask.slice(row * self.length, self.length)

    def stretch(self, first: int, n: int) -> np.ndarray:
        """``n`` ids from the one numbered ``first``; a view if one batch holds them."""
        size = self.length * BATCH_SEQUENCES
        parts = []
        while n > 0:
            batch, at = divmod(first, size)
            got = self.ids[batch][at : at + n]
            parts.append(got)
            first, n = first + len(got), n - len(got)
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_tokens(listing: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)`` for each row of a listing, from the files it names.

    The checksum is over the ids as little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for run in runs(batches, ["file"]):
            if run.column("file")[0].as_py() != name:
                name = run.column("file")[0].as_py()
                file = SequenceFile(name)
            sums = [
                zlib.crc32(file.stretch(first, n).astype("<u4"))
                for first, n in zip(run.column("first").to_pylist(), run.column("n_tokens").to_pylist())
            ]
            yield from (
                run.select(["id", "start", "n_tokens"])
                .append_column("ids_crc32", pa.array(sums, pa.int64()))
                .to_batches()
            )

    rows = listing.select(F.col(id_column).alias("id"), "file", "first", "n_tokens", "start")
    dealt = rows.repartition("file").sortWithinPartitions("file", "first")
    return dealt.mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed(
        "id", id_column
    )
