"""Plans that stay small for the driver."""

from conftest import SF_DIR, physical_plan

from kimberlite.catalog.models import DerivedTables
from kimberlite.operators import allocate as allocation
from kimberlite.operators import numbering
from kimberlite.operators.keys import lookup_key
from kimberlite.plans import gold
from kimberlite.sources.scratch import stage


def test_lookups_of_large_dimensions_are_not_broadcast(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "x")], "id int, code string")
    dim = spark.createDataFrame([("a", 7), ("b", 8)], "name string, key bigint")
    out = lookup_key(rows, dim, {"code": "name"}, "key", many=True)
    assert "Broadcast" not in physical_plan(out)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 7), (2, None, -1), (3, "x", -1)]


def test_sides_that_joins_read_twice_are_staged(spark, monkeypatch):
    """No plan of the fact or of its dimensions holds a table once for each time that it is read."""
    plans = {}

    def kept(df, name="stage"):
        plans.setdefault(name, []).append(physical_plan(df))
        return stage(df, name)

    for module in (gold, numbering, allocation):
        monkeypatch.setattr(module, "stage", kept)
    fact = DerivedTables(spark, SF_DIR).gold("fact_internet_sales")
    assert {"persons", "customers", "wanted"} <= set(plans)
    scans = {name: max(p.count("FileScan") for p in of) for name, of in plans.items()}
    assert scans["numbered"] <= 8 and scans["lines"] <= 16, scans
    assert "Broadcast" not in plans["customers"][0]
    assert fact.count() > 0
