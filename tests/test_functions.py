import datetime
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kimberlite.functions import clean
from kimberlite.functions.digest import row_hash
from kimberlite.functions.exact import double_text, to_decimal
from kimberlite.operators.dimension import date_dimension
from kimberlite.plans.silver import size_band


def apply(spark, cleaner, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(cleaner("x")).collect()]


def duck(expression, values, kind="VARCHAR"):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (i INTEGER, x {kind})")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"SELECT {expression} FROM t ORDER BY i").fetchall()]


def test_whole_rounds_like_the_sql_side(spark):
    values = ["14.0", "14", "4.5", "-4.5", "2.4", " 7 ", None]
    assert apply(spark, clean.whole, values) == duck("CAST(x AS INTEGER)", values)


def test_whole_fails_on_other_text(spark):
    with pytest.raises(Exception):
        apply(spark, clean.whole, ["12 apples"])


def test_text_strips_every_space_separator(spark):
    values = [" a ", "  b　", "\tc\t", "AB ", "", "  ", None, "ñandú "]
    assert apply(spark, clean.text, values) == duck("trim(x)", values)
    assert apply(spark, clean.upper_text, values) == duck("upper(trim(x))", values)
    assert apply(spark, clean.blank_to_null, values) == duck("nullif(trim(x), '')", values)


def test_flags(spark):
    values = ["True", "False", "1", "0", "yes", "t", None]
    assert apply(spark, clean.flag, values) == duck("CAST(x AS BOOLEAN)", values)


def test_days_and_instants(spark):
    values = ["2014-02-08 10:17:21.587", "2008-04-30", None]
    assert apply(spark, clean.instant, values) == duck("CAST(x AS TIMESTAMP)", values)
    assert apply(spark, clean.day, values) == duck("CAST(x AS DATE)", values)


def test_digits_both_ways(spark):
    values = ["1 (11) 500 555-0132", "612-555-0100", "abc", "", "555", "(5", None]
    everything = duck("regexp_replace(x, '[^0-9]', '', 'g')", values)
    first_only = duck("regexp_replace(x, '[^0-9]', '')", values)
    assert apply(spark, clean.digits, values) == everything
    assert apply(spark, clean.digits_after_first_strip, values) == first_only


def doubles():
    rng = random.Random(7)
    values = [0.0, -0.0, 1e-4, 9.99e-5, 1e16, 9.99e15, 1e7, 9999999.0, 0.00099, -1e-7, float("inf")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-10, 15) for _ in range(3000)]
    values += [1.801947368421053e16, 1.7976931348623157e308, 2.2250738585072014e-308, 1e22, 1e23]
    values += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(2000)]
    values += [float("-inf"), float("nan")]
    return values + [None]


def test_double_text_matches(spark):
    values = doubles()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    found = [r[0] for r in df.orderBy("i").select(double_text(F.col("x"))).collect()]
    table = pa.table({"i": range(len(values)), "x": pa.array(values, pa.float64())})
    con = duckdb.connect()
    con.register("t", table)
    assert found == [r[0] for r in con.execute("SELECT CAST(x AS VARCHAR) FROM t ORDER BY i").fetchall()]


@pytest.mark.parametrize("precision, scale", [(18, 4), (18, 8)])
def test_to_decimal_matches_on_ties(spark, precision, scale):
    rng = random.Random(3)
    values = [rng.randint(-(10**7), 10**7) / 10**5 + 0.00005 for _ in range(5000)]
    values += [v for v in doubles() if v is None or 1e-9 < abs(v) < 1e9]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    found = df.orderBy("i").select(to_decimal(F.col("x"), precision, scale).alias("d"))
    assert dict(found.dtypes)["d"] == f"decimal({precision},{scale})"
    table = pa.table({"i": range(len(values)), "x": pa.array(values, pa.float64())})
    con = duckdb.connect()
    con.register("t", table)
    wanted = con.execute(f"SELECT CAST(x AS DECIMAL({precision}, {scale})) FROM t ORDER BY i").fetchall()
    assert [r[0] for r in found.collect()] == [r[0] for r in wanted]


def test_row_hash_covers_types_and_nulls(spark):
    df = spark.sql(
        """SELECT 1 AS a, 'x' AS b, true AS c, DATE '2011-05-31' AS d, 2.5D AS e,
                  CAST(1 AS DECIMAL(18, 8)) AS f
           UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL"""
    )
    fields = [("a", "0"), ("b", ""), ("c", "false"), ("d", "1900-01-01"), ("e", "0.0"), ("f", "")]
    found = {r[0] for r in df.select(F.lower(F.hex(row_hash(df, fields)))).collect()}
    wanted = duckdb.connect().execute(
        """SELECT sha256('1||x||true||2011-05-31||2.5||1.00000000'),
                  sha256('0||||false||1900-01-01||0.0||')"""
    )
    assert found == set(wanted.fetchall()[0])


def test_size_bands(spark):
    sizes = ["38", "40", "42", "46", "48", "52", "54", "58", "60", "62", "S", "XL", "70", None]
    bands = apply(spark, lambda c: size_band(F.col(c)), sizes)
    assert bands == [
        "38-40 Cm", "38-40 Cm", "42-46 Cm", "42-46 Cm", "48-52 Cm", "48-52 Cm", "54-58 Cm",
        "54-58 Cm", "60-62 Cm", "60-62 Cm", "S", "XL", None, "NA",
    ]


def test_calendar_has_every_day_and_matches(spark):
    days = date_dimension(spark, "2005-01-01", "2014-12-31").orderBy("date_key")
    assert days.count() == 3652
    wanted = duckdb.connect().execute(
        """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER), CAST(d AS DATE), dayofweek(d) + 1,
                  upper(strftime(d, '%A')), day(d), dayofyear(d), week(d), upper(strftime(d, '%B')),
                  month(d), quarter(d), year(d), (month(d) + 5) // 6, quarter(d), year(d),
                  (month(d) + 5) // 6
           FROM generate_series(DATE '2005-01-01', DATE '2014-12-31', INTERVAL 1 DAY) AS t(d)"""
    )
    assert [tuple(r) for r in days.collect()] == wanted.fetchall()
    types = dict(days.dtypes)
    assert types["date_key"] == "int" and types["calendar_semester"] == "int"
    assert types["calendar_year"] == "bigint" and types["date_alternate_key"] == "date"
    assert days.first()["date_alternate_key"] == datetime.date(2005, 1, 1)
