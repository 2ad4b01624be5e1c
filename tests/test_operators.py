import datetime
import random
from collections import Counter
from decimal import Decimal

import pytest
from conftest import physical_plan
from pyspark.sql import functions as F

from kimberlite.functions.exact import to_decimal
from kimberlite.operators import validity
from kimberlite.operators.allocate import allocate, number_lines
from kimberlite.operators.dimension import Dimension, build_dimension
from kimberlite.operators.hot import left_join_many
from kimberlite.operators.keys import lookup_key, surrogate_key
from kimberlite.operators.numbering import number_rows
from kimberlite.operators.ordering import ascending
from kimberlite.operators.pick import any_by, first_by, latest_by
from kimberlite.operators.validity import meetings, valid_at, with_nodes


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ------------------------------------------------------------------- pick


def test_latest_by_takes_newest_then_smallest(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01", "old"), (1, "2021-01-01", "new"), (2, None, "b"), (2, None, "a"),
         (3, None, "none"), (3, "2019-01-01", "dated"), (None, "2019-01-01", "null key")],
        "k int, at string, v string",
    )
    found = {(r.k, r.v) for r in latest_by(df, ["k"], "at").collect()}
    assert found == {(1, "new"), (2, "a"), (3, "dated"), (None, "null key")}


def test_any_and_first_by(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, None), (2, 9)], "k int, v int")
    assert rows_of(any_by(df, ["k"])) == [(1, 2), (2, 9)]
    assert rows_of(first_by(df, ["k"], ascending("v"))) == [(1, 2), (2, 9)]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    plan = physical_plan(latest_by(df, ["k"], "id"))
    assert plan.count("WindowGroupLimit") == 2


# -------------------------------------------------------------- numbering


def numbered_input(spark, n=5000):
    rng = random.Random(5)
    data = [(rng.choice([None, *range(50)]), i) for i in range(n)]
    return data, spark.createDataFrame(data, "k int, i int").repartition(6)


def by_key_then_id(row):
    return (row[0] is None, row[0] or 0, row[1])


def test_surrogate_key_is_dense_and_ordered(spread):
    data, df = numbered_input(spread)
    keyed = surrogate_key(df, ascending("k", "i"), "key")
    assert dict(keyed.dtypes)["key"] == "bigint"
    wanted = [(*r, n + 1) for n, r in enumerate(sorted(data, key=by_key_then_id))]
    assert rows_of(keyed) == sorted(wanted, key=repr)
    assert "SinglePartition" not in physical_plan(keyed)


def test_numbers_restart_within_groups_that_span_partitions(spread):
    data, df = numbered_input(spread)
    df = df.withColumn("g", F.when(F.col("i") % 3 == 0, 0).otherwise(F.col("k")))
    numbered = number_rows(df, ascending("i"), "n", within=["g"])
    groups = {}
    for k, i in data:
        groups.setdefault(0 if i % 3 == 0 else k, []).append(i)
    wanted = {(g, i): n + 1 for g, ids in groups.items() for n, i in enumerate(sorted(ids))}
    assert {(r.g, r.i): r.n for r in numbered.collect()} == wanted


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "k int")
    assert number_rows(empty, ascending("k"), "n").collect() == []


# ------------------------------------------------------------- hot groups


def test_left_join_many_is_the_left_join(spark):
    one = spark.createDataFrame([(i, f"o{i}") for i in range(20)] + [(None, "null")], "k int, o string")
    many = spark.createDataFrame(
        [(3 if i < 400 else i % 15, i) for i in range(1000)] + [(None, -1)], "k int, m int"
    )
    wanted = rows_of(one.join(many, "k", "left"))
    assert rows_of(left_join_many(one, many, "k")) == wanted


def test_left_join_many_broadcasts_neither_side(spark):
    one = spark.range(20).select(F.col("id").alias("k"), F.col("id").alias("o"))
    many = spark.range(100).select((F.col("id") % 15).alias("k"), F.col("id").alias("m"))
    plan = physical_plan(left_join_many(one, many, "k"))
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan


# ------------------------------------------------------------------- keys


def test_lookup_key_misses_and_nulls(spark):
    dim = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "key bigint, code string, c2 string")
    df = spark.createDataFrame([("a", "x"), ("b", None), ("z", "x"), (None, "x")], "f string, g string")
    assert rows_of(lookup_key(df, dim, {"f": "code"}, "key")) == sorted(
        [("a", "x", 1), ("b", None, 2), ("z", "x", -1), (None, "x", -1)], key=repr
    )
    two = lookup_key(df, dim, {"f": "code", "g": "c2"}, "key", alias="k", default=None)
    assert rows_of(two) == sorted(
        [("a", "x", 1), ("b", None, None), ("z", "x", None), (None, "x", None)], key=repr
    )


def test_dimension_has_unknown_member_and_no_single_task(spread):
    spec = Dimension(
        key="k", columns=["code", "size"], order=["code"], digest=[("code", "")],
        unknown={"code": "UNKNOWN"}, unknown_hash=b"NA",
    )
    body = spread.range(300).select(F.concat(F.lit("c"), "id").alias("code"), F.col("id").alias("size"))
    dim = build_dimension(body, spec)
    keys = sorted(r.k for r in dim.collect())
    assert keys == [-1, *range(1, 301)]
    unknown = dim.filter("k = -1").first()
    assert (unknown.code, unknown["size"], bytes(unknown._hash)) == ("UNKNOWN", None, b"NA")
    assert dim.filter("_hash IS NULL").count() == 0
    assert "SinglePartition" not in physical_plan(dim)
    assert dict(dim.dtypes)["_hash"] == "binary"


# --------------------------------------------------------------- validity


def history(spark):
    d = datetime.datetime
    return spark.createDataFrame(
        [(1, d(2011, 1, 1), d(2011, 12, 31), 10.0), (1, d(2012, 1, 1), None, 11.0),
         (2, d(2011, 6, 1), d(2011, 6, 30), 20.0), (2, d(2011, 6, 15), d(2011, 7, 15), 21.0),
         (3, d(2012, 1, 1), d(2011, 1, 1), 30.0), (None, d(2011, 1, 1), None, 99.0)],
        "p int, s timestamp_ntz, e timestamp_ntz, cost double",
    )


def test_valid_at_bounds_and_overlaps(spark):
    day = datetime.date
    rows = spark.createDataFrame(
        [(1, 1, day(2011, 1, 1)), (2, 1, day(2011, 12, 31)), (3, 1, day(2010, 12, 31)),
         (4, 1, day(2099, 1, 1)), (5, 2, day(2011, 6, 20)), (6, 3, day(2011, 6, 1)),
         (7, 9, day(2011, 6, 1)), (8, None, day(2011, 6, 1)), (9, 1, None)],
        "id int, p int, d date",
    )
    wanted = sorted(
        [(1, 10.0), (2, 10.0), (3, None), (4, 11.0), (5, 20.0), (5, 21.0), (6, None), (7, None),
         (8, None), (9, None)], key=repr,
    )
    args = dict(key="p", at="d", start="s", end="e", columns=["cost"])
    assert rows_of(valid_at(rows, history(spark), **args).select("id", "cost")) == wanted


def test_valid_at_long_history_against_brute_force(spark):
    rng = random.Random(11)
    start = datetime.datetime(2011, 1, 1)
    entries, at = [], start
    for i in range(400):
        end = at + datetime.timedelta(hours=rng.randint(1, 90))
        entries.append((rng.choice([1, 1, 2]), at, None if i == 399 else end, float(i)))
        at = end + datetime.timedelta(hours=rng.randint(0, 30))
    rows = [(i, rng.choice([1, 1, 2]), start + datetime.timedelta(hours=rng.randint(-99, 30000)))
            for i in range(300)]
    wanted = []
    for i, p, t in rows:
        hits = [c for q, s, e, c in entries if q == p and s <= t and (e is None or t <= e)]
        wanted += [(i, c) for c in hits] or [(i, None)]
    left = spark.createDataFrame(rows, "id int, p int, t timestamp_ntz")
    right = spark.createDataFrame(entries, "p int, s timestamp_ntz, e timestamp_ntz, cost double")
    found = valid_at(left, right, key="p", at="t", start="s", end="e", columns=["cost"])
    assert rows_of(found.select("id", "cost")) == sorted(wanted, key=repr)


# ------------------------------------------------------------- allocation


def orders(spark):
    """Order 1 has three lines, 2 one, 3 none, 4 sums to zero, 5 has a line without weight."""
    return spark.createDataFrame(
        [(1, 1, 1.0, 10.0), (1, 2, 1.0, 10.0), (1, 3, 1.0, 10.0), (2, 1, 7.0, 3.3333),
         (3, None, None, 5.5), (4, 1, 2.0, 8.0), (4, 2, -2.0, 8.0), (5, 1, None, 6.0),
         (5, 2, 3.0, 6.0), (None, 1, 1.0, 4.0), (None, 2, 3.0, 4.0)],
        "o int, l int, w double, total double",
    ).withColumn("total", to_decimal(F.col("total"), 18, 8))


def test_allocation_edge_cases(spread):
    done = allocate(orders(spread), "o", ascending("l"), "w", {"part": "total"})
    found = {(r.o, r.line_number): r.part for r in done.collect()}
    assert found == {
        (1, 1): Decimal("3.3333"), (1, 2): Decimal("3.3333"), (1, 3): Decimal("3.3334"),
        (2, 1): Decimal("3.3333"), (3, 1): Decimal("5.5000"),
        (4, 1): Decimal("0.0000"), (4, 2): Decimal("8.0000"),
        (5, 1): None, (5, 2): Decimal("6.0000"),
        (None, 1): Decimal("1.0000"), (None, 2): Decimal("3.0000"),
    }


def test_a_large_order_spans_partitions_and_adds_up(spread):
    rng = random.Random(2)
    lines = [(1 if i % 3 == 0 else i // 4, i, round(rng.uniform(1, 500), 2)) for i in range(3000)]
    df = spread.createDataFrame(lines, "o int, l int, w double").repartition(5)
    df = df.withColumn("total", to_decimal(F.col("o") * 3.7 + 100, 18, 8))
    done = allocate(df, "o", ascending("l"), "w", {"a": "total"})
    groups = {}
    for o, i, _ in lines:
        groups.setdefault(o, []).append(i)
    wanted = {(o, i): (n + 1, len(ids)) for o, ids in groups.items() for n, i in enumerate(sorted(ids))}
    assert {(r.o, r.l): (r.line_number, r.line_count) for r in done.collect()} == wanted
    sums = done.groupBy("o").agg(F.sum("a").alias("s"), F.first("total").alias("t")).collect()
    assert all(abs(r.s - r.t) < Decimal("0.0001") for r in sums)
    numbered = number_lines(df, "o", ascending("l"), "w")
    assert rows_of(numbered.select("o", "l", "line_number")) == sorted(
        ((o, i, n) for (o, i), (n, _) in wanted.items()), key=repr
    )


def test_no_task_holds_a_whole_large_order(spread):
    df = spread.range(8000).select(
        F.lit(1).alias("o"), F.col("id").alias("l"), F.lit(1.0).alias("w"),
        F.lit(Decimal("5.00000000")).cast("decimal(18,8)").alias("t"),
    )
    done = allocate(df, "o", ascending("l"), "w", {"a": "t"})
    by_task = done.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) > 1 and max(r["count"] for r in by_task) < 8000
    assert "SinglePartition" not in physical_plan(done)


def test_nodes_make_up_each_interval_once(spark):
    rng = random.Random(5)
    pairs = [(a, a + rng.choice([0, 1, 2, 3, 7, 8, 100, 10**6])) for a in (rng.randint(-300, 300) for _ in range(400))]
    pairs += [(0, 2**40), (-(2**40) + 1, 2**40 - 1)]
    found = {}
    for r in with_nodes(spark.createDataFrame(set(pairs), "a bigint, b bigint"), "a", "b").collect():
        found.setdefault((r.a, r.b), []).append((r._level, r._node))
    assert set(found) == set(pairs)
    for (a, b), nodes in found.items():
        spans = sorted((node << 2 * level, (node + 1 << 2 * level) - 1) for level, node in nodes)
        assert spans[0][0] == a and spans[-1][1] == b
        assert all(x[1] + 1 == y[0] for x, y in zip(spans, spans[1:]))
        assert max(Counter(level for level, _ in nodes).values()) <= 6


def test_only_entries_that_hold_a_time_meet_it(spark):
    """Thousands of open entries for one key: a point doesn't meet those that have not started."""
    rng = random.Random(4)
    start = datetime.datetime(2000, 1, 1)
    entries = [(1, start + datetime.timedelta(seconds=rng.randint(0, 10**8)), None, i) for i in range(3000)]
    entries += [
        (rng.choice([1, 2]), s, s + datetime.timedelta(seconds=rng.randint(0, 10**7)), i)
        for i, s in enumerate([e[1] for e in entries[:500]], 3000)
    ]
    rows = [(i, rng.choice([1, 2, 3]), start + datetime.timedelta(seconds=rng.randint(-(10**6), 10**6))) for i in range(60)]
    left = spark.createDataFrame(rows, "id int, p int, t timestamp_ntz")
    right = spark.createDataFrame(entries, "p int, s timestamp_ntz, e timestamp_ntz, entry int")
    args = dict(key="p", at="t", start="s", end="e", columns=["entry"])
    wanted = [(i, c) for i, p, t in rows for q, s, e, c in entries if q == p and s <= t and (e is None or t <= e)]
    # As many rows before the last filter as results.
    assert meetings(left, right, **args).count() == len({(p, t, c) for i, p, t in rows for j, c in wanted if i == j})
    found = valid_at(left, right, **args).filter("entry is not null").select("id", "entry")
    assert rows_of(found) == sorted(wanted, key=repr)
    assert len(wanted) < 0.1 * sum(len([e for e in entries if e[0] == p]) for _, p, _ in rows)


def test_valid_at_by_dates_and_by_fractions_of_a_second(spark):
    day = datetime.date
    dates = spark.createDataFrame([(1, day(2011, 1, 1), day(2011, 3, 1), 7), (1, day(1960, 1, 1), None, 8)], "p int, s date, e date, c int")
    at = spark.createDataFrame([(1, day(2011, 3, 1)), (1, day(1959, 12, 31)), (1, day(1960, 1, 1))], "p int, d date")
    found = valid_at(at, dates, key="p", at="d", start="s", end="e", columns=["c"])
    assert rows_of(found) == sorted(
        [(1, day(2011, 3, 1), 7), (1, day(2011, 3, 1), 8), (1, day(1959, 12, 31), None), (1, day(1960, 1, 1), 8)], key=repr
    )
    time = datetime.datetime
    fine = spark.createDataFrame([(1, time(2011, 1, 1, 0, 0, 0, 500), time(2011, 1, 1, 0, 0, 1, 500), 1)], "p int, s timestamp_ntz, e timestamp_ntz, c int")
    points = [time(2011, 1, 1, 0, 0, 0, 499), time(2011, 1, 1, 0, 0, 0, 500), time(2011, 1, 1, 0, 0, 1, 500), time(2011, 1, 1, 0, 0, 1, 501)]
    at = spark.createDataFrame([(1, p) for p in points], "p int, t timestamp_ntz")
    found = {r.t: r.c for r in valid_at(at, fine, key="p", at="t", start="s", end="e", columns=["c"]).collect()}
    assert [found[p] for p in points] == [None, 1, 1, None]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("fine", [0, 250_000])
def test_valid_at_by_parts_of_a_second_against_brute_force(spark, kind, fine):
    """Points at whole seconds or not, entries at quarters of a second, before and after 1970."""
    rng = random.Random(fine)
    start = datetime.datetime(1969, 12, 31, 23, 59, 50)
    quarter = datetime.timedelta(microseconds=250_000)
    entries = [(rng.choice([1, 2]), start + rng.randint(0, 80) * quarter, i) for i in range(120)]
    entries = [(p, s, rng.choice([None, s + rng.randint(0, 30) * quarter]), i) for p, s, i in entries]
    unit = quarter if fine else 4 * quarter
    rows = [(i, rng.choice([1, 2, 3]), start + rng.randint(-5, 25) * unit) for i in range(60)] + [(60, 1, None), (61, None, start)]
    wanted = []
    for i, p, t in rows:
        hits = [c for q, s, e, c in entries if t is not None and q == p and s <= t and (e is None or t <= e)]
        wanted += [(i, c) for c in hits] or [(i, None)]
    left = spark.createDataFrame(rows, "id int, p int, t timestamp_ntz").withColumn("t", F.col("t").cast(kind))
    right = spark.createDataFrame(entries, "p int, s timestamp_ntz, e timestamp_ntz, entry int")
    right = right.withColumns({c: F.col(c).cast(kind) for c in "se"})
    args = dict(key="p", at="t", start="s", end="e", columns=["entry"])
    found = valid_at(left, right, **args)
    assert found.columns == ["id", "p", "t", "entry"]
    assert rows_of(found.select("id", "entry")) == sorted(wanted, key=repr)
    if not fine:  # nodes decide, and nothing is met in vain
        assert meetings(left, right, **args).count() == len({(*rows[i][1:], c) for i, c in wanted if c is not None})


def test_times_are_not_carried_where_nodes_decide(spark):
    """What the node join shuffles has no starts and ends if points are at whole seconds."""
    hour = F.make_dt_interval(hours=F.col("id").cast("int"))
    time = (F.lit("2011-01-01 00:30:00").cast("timestamp_ntz") + hour).alias("t")
    left = spark.range(40).select(F.lit(1).alias("p"), time)
    right = left.select("p", F.col("t").alias("s"), (F.col("t") + F.make_dt_interval(hours=F.lit(9))).alias("e"), F.lit(7).alias("entry"))
    met = meetings(left, right, key="p", at="t", start="s", end="e", columns=["entry"])
    assert met.filter("_h_start is not null or _h_end is not null").count() == 0
    assert met.count() == sum(min(10, 40 - i) for i in range(40))


def test_exploded_entries_are_not_broadcast(spark):
    """Spark plans with the size of the entries, not of the rows that explode makes of them."""
    day = F.date_add(F.lit("2011-01-01").cast("date"), F.col("id").cast("int"))
    left = spark.range(50).select(F.lit(1).alias("p"), day.alias("t"))
    right = spark.range(50).select(F.lit(1).alias("p"), day.alias("s"), F.lit(None).cast("date").alias("e"), F.col("id").alias("entry"))
    met = meetings(left, right, key="p", at="t", start="s", end="e", columns=["entry"])
    plan = physical_plan(met)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert met.count() == 50 * 51 // 2


def few_and_many(spark):
    """Key 1 has 40 entries, key 2 three, key 3 none and key 4 one but many times; rows repeat times."""
    rng = random.Random(8)
    start = datetime.datetime(2011, 1, 1)
    hours = lambda n: datetime.timedelta(hours=n)
    entries = [(p, start + hours(rng.randint(0, 500)), i) for i, p in enumerate([1] * 40 + [2] * 3 + [4])]
    entries = [(p, s, rng.choice([None, s + hours(rng.randint(0, 90))]), i) for p, s, i in entries]
    rows = [(p, start + hours(rng.randint(-20, 520))) for p in [1, 2, 3] * 30 + [4] * 200]
    rows = [(i, p, t) for i, (p, t) in enumerate(rows + rows[:50] + [(None, start), (1, None)])]
    wanted = []
    for i, p, t in rows:
        hits = [c for q, s, e, c in entries if t is not None and q == p and s <= t and (e is None or t <= e)]
        wanted += [(i, c) for c in hits] or [(i, None)]
    left = spark.createDataFrame(rows, "id int, p int, t timestamp_ntz")
    right = spark.createDataFrame(entries, "p int, s timestamp_ntz, e timestamp_ntz, entry int")
    return left, right, sorted(wanted, key=repr)


@pytest.mark.parametrize("most, cut", [((32, 100), [1, 4]), ((32, 10**5), [1]), ((1000, 10**5), [])])
def test_only_entries_of_large_keys_are_copied_to_nodes(spark, monkeypatch, most, cut):
    left, right, wanted = few_and_many(spark)
    keys = set()

    def noted(df, *bounds):
        keys.update(r[0] for r in df.select("_h_key").distinct().collect())
        return with_nodes(df, *bounds)

    monkeypatch.setattr(validity, "with_nodes", noted)
    monkeypatch.setattr(validity, "FEW_ENTRIES", most[0], raising=False)
    monkeypatch.setattr(validity, "FEW_POINTS", most[1], raising=False)
    found = valid_at(left, right, key="p", at="t", start="s", end="e", columns=["entry"])
    assert rows_of(found.select("id", "entry")) == wanted
    assert sorted(keys) == cut
