"""Secrets in texts, and the parts that only together make a credential.

One scan of each text finds spans that are reported as they are (assignments to
a password or token, access keys, long hexadecimal runs) and weak parts: names
of accounts, mixed runs that may be keys, and endpoints. A weak part is reported
only if its complement lies in one scope with it: an account's name needs a
secret, a mixed run an identifier, an endpoint both. The scope of a part are the
code points around it, up to the next blank lines.

Scopes of one role are first joined to disjoint intervals, so that however many
parts a text has, each candidate meets few of them; candidates and intervals are
joined by the buckets of the text that they touch. Only texts with an identifier
and a secret take part in that, each distinct text once.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kimberlite.llm.staged import result
from kimberlite.sources.scratch import stage

#: Kinds in the order of reports; the first three need no complement.
KINDS = ("assign", "access", "hex", "account", "key", "endpoint")
_BASE = 3
_IDENTIFIERS, _SECRETS = ("access", "account"), ("assign", "hex", "key")

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
_ASSIGN = re.compile(rf"(password|passwd|secret|token|api_?key){_VALUE}([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ACCOUNT = re.compile(rf"(access_?key_?id|client_?id|account|username|user|login){_VALUE}([A-Za-z0-9@._+-]{{3,}})", re.I | re.A)
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_ENDPOINT = re.compile(
    r"(https?|ftp|s3|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20\"'<>\x7F]+", re.A
)
_MIXED = tuple(map(re.compile, ("[0-9]", "[a-z]", "[A-Z]")))
_BLANK_LINE = re.compile(r"\n[\x20\t\r]*\n")

#: Code points of a bucket of the interval join.
BUCKET = 1024

_SPANS = "array<struct<kind:int,start:int,end:int>>"
_PARTS = "array<struct<kind:int,start:int,end:int,begin:int,until:int>>"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in code points, by start, then kind."""
    found = [(0, *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in _ACCESS.finditer(text)]
    found += [(2, *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def parts_of(text: str, base: list[tuple[int, int, int]], reach: int) -> list[tuple[int, int, int, int, int]]:
    """``(kind, start, end, begin, until)``: all spans and their scopes; none if no part has a complement.

    Weak parts that overlap a base span are none.
    """
    begins = [s for _, s, _ in base]
    longest: list[int] = []  # where the base spans up to each one end
    for _, _, end in base:
        longest.append(max(end, longest[-1]) if longest else end)

    def free(start: int, end: int) -> bool:
        before = bisect_left(begins, end)
        return not before or longest[before - 1] <= start

    weak = [(3, *m.span()) for m in _ACCOUNT.finditer(text) if free(*m.span())]
    if not weak and all(KINDS[kind] != "access" for kind, _, _ in base):
        return []
    weak += [
        (4, *m.span()) for m in _RUN.finditer(text) if free(*m.span()) and all(p.search(m.group()) for p in _MIXED)
    ]
    if not any(KINDS[kind] in _SECRETS for kind, _, _ in base + weak):
        return []
    weak += [(5, *m.span()) for m in _ENDPOINT.finditer(text) if free(*m.span())]
    blank = [m.span() for m in _BLANK_LINE.finditer(text)]
    ends, starts = [e for _, e in blank], [s for s, _ in blank]
    out = []
    for kind, start, end in base + weak:
        i, j = bisect_right(ends, start), bisect_left(starts, end)
        begin = max(start - reach, ends[i - 1] if i else 0, 0)
        until = min(end + reach, starts[j] if j < len(starts) else len(text))
        out.append((kind, start, end, begin, until))
    return out


def credentials(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", reach: int = 200
) -> DataFrame:
    """``(id, spans)`` for each row: ``array<struct<kind, start, end, weak>>``, by start, then kind.

    Offsets count code points; the end is exclusive. Spans of one kind are
    matches from left to right that don't overlap: assignments whose value has 8
    characters or more, access keys of 16 or more, runs of 32 or more hexadecimal
    digits, all reported; accounts, mixed runs of 20 characters or more and
    endpoints, reported if they overlap the scope of a complement, ``reach`` code
    points to both sides and no blank line between. Letters of names count in
    either case, A-Z only.

    Texts are scanned whole, one at a time. Null and empty texts have no spans.
    Rows that repeat, or repeat an id, or have none, are rows of their own; equal
    texts have equal spans. Other columns are not read. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession

    def make() -> DataFrame:
        keyed = docs.select(
            F.col(id_column).alias("id"),
            F.xxhash64(text_column).alias("key_1"),
            F.xxhash64(F.lit(1), text_column).alias("key_2"),
            F.col(text_column).alias("text"),
        )
        id_kind = keyed.schema["id"].dataType.simpleString()
        scanned = stage(
            keyed.mapInArrow(
                lambda batches: _scan(batches, reach),
                f"id {id_kind}, key_1 bigint, key_2 bigint, base {_SPANS}, parts {_PARTS}",
            ),
            "scanned",
        )
        open_, plain = scanned.filter(F.size("parts") > 0), scanned.filter(F.size("parts") == 0)
        linked = _linked(open_.select("key_1", "key_2", F.inline("parts")).distinct())
        more = open_.join(linked, ["key_1", "key_2"], "left").select("id", "base", "linked")
        spans = more.unionByName(plain.select("id", "base", F.lit(None).cast(_SPANS).alias("linked")))
        every = F.concat("base", F.coalesce("linked", F.array().cast(_SPANS)))
        by_start = F.array_sort(F.transform(every, lambda s: F.struct(s["start"], s["kind"], s["end"])))
        names = F.array(*map(F.lit, KINDS))
        named = F.transform(
            by_start,
            lambda s: F.struct(
                F.get(names, s["kind"]).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                (s["kind"] >= _BASE).alias("weak"),
            ),
        )
        return spans.select(F.col("id").alias(id_column), named.alias("spans"))

    return result(spark, make)


def _scan(batches: Iterator[pa.RecordBatch], reach: int) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end")]))
    part = pa.list_(pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "begin", "until")]))
    for batch in batches:
        base, parts = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            found = base_spans(text)
            base.append(found)
            parts.append(parts_of(text, found, reach))
        keys = [batch.column(c) for c in ("id", "key_1", "key_2")]
        yield pa.RecordBatch.from_arrays(
            [*keys, pa.array(base, span), pa.array(parts, part)], names=["id", "key_1", "key_2", "base", "parts"]
        )


def _linked(parts: DataFrame) -> DataFrame:
    """``(key_1, key_2, linked)``: weak parts whose complements' scopes they overlap."""
    text = ["key_1", "key_2"]

    def among(kinds: tuple[str, ...]):
        return F.col("kind").isin([KINDS.index(k) for k in kinds])

    role = F.when(among(_IDENTIFIERS), "identifier").when(among(_SECRETS), "secret")
    roles = parts.withColumn("role", role).filter("role is not null")
    in_order = Window.partitionBy(*text, "role").orderBy("begin", "until", "kind", "start")
    covered = F.max("until").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(covered >= F.col("begin"), 0).otherwise(1)
    island = F.sum("apart").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    scopes = (
        roles.withColumn("apart", apart)
        .withColumn("island", island)
        .groupBy(*text, "role", "island")
        .agg(F.min("begin").alias("begin"), F.max("until").alias("until"))
    )
    weak = parts.filter(F.col("kind") >= _BASE).select(*text, "kind", "start", "end")

    def touched(low: str, high: str):
        first, last = F.floor(F.col(low) / BUCKET), F.floor((F.col(high) - 1) / BUCKET)
        return F.explode(F.sequence(first, last)).alias("bucket")

    met = weak.select("*", touched("start", "end")).join(
        scopes.select(*text, "role", "begin", "until", touched("begin", "until")), [*text, "bucket"]
    )
    met = met.filter((F.col("start") < F.col("until")) & (F.col("end") > F.col("begin")))
    found = met.groupBy(*text, "kind", "start", "end").agg(
        F.max(F.col("role") == "identifier").alias("identifier"), F.max(F.col("role") == "secret").alias("secret")
    )
    complete = (
        F.when(among(("account",)), F.col("secret"))
        .when(among(("key",)), F.col("identifier"))
        .otherwise(F.col("identifier") & F.col("secret"))
    )
    return found.filter(complete).groupBy(*text).agg(F.collect_list(F.struct("kind", "start", "end")).alias("linked"))
