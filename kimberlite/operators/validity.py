"""Joining rows to the history entries that are valid at a point in time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kimberlite.sources.scratch import stage, stage_alone

#: Seconds of the units that times of a key are counted in.
UNITS = (86400, 3600, 60)
#: A key with no more entries and different times than these is joined by itself, without nodes.
FEW_ENTRIES, FEW_POINTS = 32, 100_000
_ENTRY = ["_h_start", "_h_end"]


def valid_at(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    columns: Sequence[str],
    history_key: str | None = None,
) -> DataFrame:
    """Left join ``rows`` to every history entry whose closed interval holds ``at``.

    ``end`` NULL means open. The different points in time of a key meet entries
    (``meetings``); what they find is staged, so that nothing shuffled for it lies
    beside the last join. Rows then take what their key and time has found: a time
    without an entry has found one row of NULLs, so this is an inner join, which
    goes through what was found and holds only the rows of one key and time. Its
    rows come entry by entry, repeated for the rows of that time. The plan is the
    same for short, long, overlapping and open entries.
    """
    spark = rows.sparkSession
    micros = _clock(rows, history, at, start, end)
    points = _staged_points(rows, key, at, micros)

    def holding() -> DataFrame:
        met = _meetings(points, history, key, micros, start, end, columns, history_key)
        # Times within the first or last second of an entry.
        begun = F.col("_h_start").isNull() | (F.col("_at") >= F.col("_h_start"))
        holds = begun & (F.col("_h_end").isNull() | (F.col("_at") <= F.col("_h_end")))
        return met.filter(holds).select("_key", "_at", *columns)

    found = stage_alone(spark, holding, "found")
    none = {c: F.lit(None).cast(found.schema[c].dataType) for c in columns}
    asked, met = points.withColumnRenamed("_micros", "_at"), found.select("_key", "_at").distinct()
    alone = asked.join(met.hint("merge"), ["_key", "_at"], "left_anti").withColumns(none)
    timed = rows.withColumn("_micros", micros(F.col(at)))
    same = (F.col(key) == F.col("_key")) & (F.col("_micros") == F.col("_at"))
    taken = found.unionByName(alone).hint("merge").join(timed, same).select(*rows.columns, *columns)
    timeless = timed.filter(F.col(key).isNull() | F.col("_micros").isNull())
    return taken.unionByName(timeless.select(*rows.columns, *[none[c].alias(c) for c in columns]))


def meetings(
    rows: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    start: str,
    end: str,
    columns: Sequence[str],
    history_key: str | None = None,
) -> DataFrame:
    """``(_key, _at, _h_start, _h_end, *columns)``: each key and time with each entry that holds its second.

    The times of a key with few entries meet them by the key alone: each is compared
    with a few entries, and nothing is copied. The other keys go by nodes, which are
    several rows for each time and entry but never compare what doesn't meet. Times
    of a key beyond a task's share go by nodes too, which spread them.

    For nodes, times are counted from the first point in the largest of days, hours, minutes
    and seconds that gives whole numbers for all points. An entry is cut to the
    times between the first and the last point, so that an open one ends there
    too, and then into nodes of 1, 4, 16, ... such units, at most three of each
    length at each end, which together are exactly its times. A point lies in one
    node of each length, and meets an entry in one node if the entry holds it and
    in none if not. Keys meet only in that one join, by key and node.

    Times are returned as microseconds. The join shuffles several rows for each
    point and entry, so they are short: if all points are at whole seconds, nodes
    alone decide, and ``_h_start`` and ``_h_end`` are NULL. Else a point may also
    meet an entry that starts in the second after it.
    """
    micros = _clock(rows, history, at, start, end)
    return _meetings(_staged_points(rows, key, at, micros), history, key, micros, start, end, columns, history_key)


def _meetings(
    points: DataFrame,
    history: DataFrame,
    key: str,
    micros: Callable[[Column], Column],
    start: str,
    end: str,
    columns: Sequence[str],
    history_key: str | None,
) -> DataFrame:
    entries = history.select(
        F.col(history_key or key).alias("_h_key"),
        F.col(start).alias("_h_start"),
        F.col(end).alias("_h_end"),
        *columns,
    ).filter("_h_key is not null and _h_start is not null and (_h_end is null or _h_start <= _h_end)")
    entries = entries.withColumns({"_begin": micros(F.col("_h_start")), "_stop": micros(F.col("_h_end"))})
    entries = entries.drop("_h_start", "_h_end")
    large = _large_keys(points, entries)
    met = [_met_by_key(_parted(points, "_key", large, "left_anti"), _parted(entries, "_h_key", large, "left_anti"))]
    met += [_met_by_node(_parted(points, "_key", large, "left_semi"), _parted(entries, "_h_key", large, "left_semi"), columns)]
    return met[0].select("_key", "_at", *_ENTRY, *columns).unionByName(met[1])


def _large_keys(points: DataFrame, entries: DataFrame) -> DataFrame:
    """Keys with many entries or many different times, counted."""
    counted = entries.groupBy(F.col("_h_key").alias("_large")).count().filter(F.col("count") > FEW_ENTRIES)
    times = points.groupBy(F.col("_key").alias("_large")).count().filter(F.col("count") > FEW_POINTS)
    return counted.select("_large").unionByName(times.select("_large"))


def _parted(df: DataFrame, key: str, large: DataFrame, how: str) -> DataFrame:
    return df.join(large.hint("merge"), F.col(key) == F.col("_large"), how)


def _met_by_key(points: DataFrame, entries: DataFrame) -> DataFrame:
    """Points of a key with its entries that hold them: a few for each point are compared, none is copied."""
    holds = (F.col("_micros") >= F.col("_begin")) & (F.col("_stop").isNull() | (F.col("_micros") <= F.col("_stop")))
    met = points.join(entries.hint("merge"), (F.col("_key") == F.col("_h_key")) & holds)
    return met.withColumnsRenamed({"_micros": "_at"}).withColumns({c: F.lit(None).cast("bigint") for c in _ENTRY})


def _met_by_node(points: DataFrame, entries: DataFrame, columns: Sequence[str]) -> DataFrame:
    bounds = _bounds(points)
    entries = (
        entries.withColumn("_b", bounds)
        .withColumns({c: F.when(~F.col("_b.even"), F.col(m)) for c, m in zip(_ENTRY, ("_begin", "_stop"))})
        # Whole seconds at or after the start and up to the end.
        .withColumn("_begin", F.expr("-" + _SECOND.format("(-_begin)")))
        .withColumn("_stop", F.expr(_SECOND.format("_stop")))
        # Few uses of _b: a plan may hold its query once for each. A NULL end is passed over by least.
        .withColumn("_from", F.expr("greatest(0, -floor((_b.low - _begin) / _b.unit))"))
        .withColumn("_to", F.expr("least(_b.units - 1, floor((_stop - _b.first) / _b.unit))"))
        .filter("_from <= _to")
    )
    lying = with_nodes(entries, "_from", "_to")
    lying = lying.select("_h_key", F.expr(_PLACE.format("_node")).alias("_h_node"), *_ENTRY, *columns)
    placed = (
        points.withColumn("_b", bounds)
        .withColumn("_number", F.expr(_NUMBER))
        .withColumn("_level", F.expr("explode(sequence(0, _b.top))"))
        .select("_key", F.col("_micros").alias("_at"), F.expr(_PLACE.format("shiftright(_number, 2 * _level)")).alias("_node"))
    )
    same = [F.col(c) == F.col(f"_h{c}") for c in ("_key", "_node")]
    # Estimates of sizes leave out the rows that explode adds: entries are never broadcast by them.
    return placed.join(lying.hint("merge"), same).select("_key", "_at", *_ENTRY, *columns)


def _staged_points(rows: DataFrame, key: str, at: str, micros: Callable[[Column], Column]) -> DataFrame:
    """The different keys and times that are asked for; read several times, and short."""
    points = rows.select(F.col(key).alias("_key"), micros(F.col(at)).alias("_micros"))
    return stage(points.filter("_key is not null and _micros is not null").distinct(), "points")


def _bounds(points: DataFrame) -> Column:
    """First second of the points, unit, number of units, highest level, and whether all are at whole seconds.

    ``low`` is the second that rounded-up starts count from: a second later if
    points lie between whole seconds, as a start may be before one in its second.
    """
    points = points.withColumn("_time", F.expr(_SECOND.format("_micros")))
    whole = [F.max(F.pmod("_time", F.lit(u))) == F.min(F.pmod("_time", F.lit(u))) for u in UNITS]
    unit = F.coalesce(*[F.when(w, F.lit(u)) for w, u in zip(whole, UNITS)], F.lit(1)).cast("bigint")
    even = F.min(F.expr("_micros % 1000000 = 0"))
    first, last = F.min("_time").alias("first"), F.max("_time").alias("last")
    found = points.agg(first, last, unit.alias("unit"), even.alias("even"))
    found = found.withColumn("units", F.expr("(last - first) div unit + 1"))
    # Nodes longer than all units have no entry.
    found = found.withColumn("top", F.expr("cast((length(bin(units)) - 1) div 2 as int)"))
    low = (F.col("first") + (~F.col("even")).cast("int")).alias("low")
    return found.select(F.struct("first", low, "unit", "units", "top", "even")).scalar()


#: The whole second of microseconds, never falling as they grow.
_SECOND = "(({0} - pmod({0}, 1000000)) div 1000000)"
#: Units from the first point.
_NUMBER = f"({_SECOND.format('_micros')} - _b.first) div _b.unit"
#: Level and node in one number: there are fewer than 32 levels.
_PLACE = "32 * {} + _level"

def with_nodes(df: DataFrame, first: str, last: str) -> DataFrame:
    """A row for each of the nodes ``(_level, _node)`` that make up the units from ``first`` to ``last``.

    Nodes of ``4**level`` units are numbered from the left. What is left to cover
    at a level runs from node ``lo`` to before ``hi``; of these, the level takes
    those that are no part of a node of the next level inside: up to three from
    the left and up to three from the right.
    """
    lo, hi = f"(-shiftright(-{first}, 2 * _level))", f"shiftright({last} + 1, 2 * _level)"
    lo_above, hi_above = f"(-shiftright(-{first}, 2 * _level + 2))", f"shiftright({last} + 1, 2 * _level + 2)"
    places = F.expr(f"explode(sequence(0, 6 * cast(ceil(log2({last} - {first} + 1) / 2) as int) + 5))")
    placed = df.withColumn("_place", places).withColumn("_level", F.expr("_place div 6").cast("int"))
    node = f"if(_place % 6 < 3, {lo}, 4 * {hi_above} - 3) + _place % 6"
    own = f"if(_place % 6 < 3, _node < least(4 * {lo_above}, {hi}), {lo_above} <= {hi_above} and _node < {hi})"
    return placed.withColumn("_node", F.expr(node)).filter(own)


def _clock(rows: DataFrame, history: DataFrame, at: str, start: str, end: str) -> Callable[[Column], Column]:
    kinds = [dict(rows.dtypes)[at], *(dict(history.dtypes)[c] for c in (start, end))]
    return _instant if "timestamp" in kinds else _wall_clock


def _wall_clock(time: Column) -> Column:
    """Microseconds of a date or a time without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, time.cast("timestamp_ntz"))


def _instant(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))
