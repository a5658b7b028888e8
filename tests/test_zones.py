"""Tables by day and tables whose schema changes."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql.types import StructType

from tidegate.sources.registry import EvolvingTable, Plan, SchemaMismatch
from tidegate.sources.zones import DailyTable

SCHEMA = StructType().add("id", "long").add("ingested_at", "timestamp_ntz")


def rows(spark, *items):
    return spark.createDataFrame([(i, None if d is None else datetime(2024, 1, d, 5)) for i, d in items], SCHEMA)


@pytest.fixture
def zone(spark, tmp_path):
    table = DailyTable(str(tmp_path / "z"), "ingested_at")
    table.replace_days(rows(spark, (1, 1), (2, 2), (3, 2), (4, 3), (5, None)))
    return table


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_only_the_days_of_a_reload_change(spark, zone):
    zone.replace_days(rows(spark, (20, 2), (9, 9)))
    assert ids(zone.read(spark, SCHEMA)) == [1, 4, 5, 9, 20]
    zone.replace_days(rows(spark, (6, None)))
    assert ids(zone.read(spark, SCHEMA)) == [1, 4, 6, 9, 20]
    zone.replace_days(rows(spark))
    assert ids(zone.read(spark, SCHEMA)) == [1, 4, 6, 9, 20]
    assert zone.days(spark) == [date(2024, 1, d) for d in (1, 2, 3, 9)]
    assert zone.read(spark, SCHEMA).columns == SCHEMA.names


def test_readers_open_the_days_they_need(spark, zone, plan_of):
    some = zone.read(spark, SCHEMA, date(2024, 1, 2), date(2024, 1, 2))
    assert ids(some) == [2, 3]
    plan = plan_of(some)
    pushed = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "ingest_date" in pushed and ">=" in pushed and "<=" in pushed
    assert ids(zone.newest(spark, SCHEMA)) == [4]


def test_old_days_go(spark, zone):
    assert zone.drop_before(spark, keep_days=2) == [date(2024, 1, 1)]
    assert ids(zone.read(spark, SCHEMA)) == [2, 3, 4, 5]


def test_before_the_first_load(spark, tmp_path):
    none = DailyTable(str(tmp_path / "none"), "ingested_at")
    assert none.days(spark) == [] and none.drop_before(spark, 1) == []
    assert none.read(spark, SCHEMA).count() == none.newest(spark, SCHEMA).count() == 0


V1 = StructType().add("id", "integer").add("mail", "string").add("amount", "string")
V2 = StructType().add("id", "integer").add("email", "string").add("amount", "decimal(10,2)").add("country", "string")


def test_generations_read_as_the_newest(spark, tmp_path):
    table = EvolvingTable(str(tmp_path / "t"))
    with pytest.raises(SchemaMismatch):
        table.read(spark)
    assert table.evolve(spark, V1) == table.evolve(spark, V1) == 1
    assert table.read(spark).count() == 0
    table.append(spark.createDataFrame([(1, "a@x", "1.50"), (2, "b@x", "much")], V1))
    plan = Plan(renamed={"mail": "email"}, added={"country": "concat('of ', id)"})
    assert table.evolve(spark, V2, plan) == 2
    table.append(spark.createDataFrame([("EC", 3, D("7"), "c@x")], "country string, id int, amount decimal(10,2), email string"))
    got = table.read(spark)
    assert got.schema == V2
    assert sorted(map(tuple, got.collect())) == [
        (1, "a@x", D("1.50"), "of 1"), (2, "b@x", None, "of 2"), (3, "c@x", D("7.00"), "EC"),
    ]
    third = StructType.fromDDL("id long, email string")
    table.evolve(spark, third, Plan(dropped=["amount", "country"]))
    assert sorted(map(tuple, table.read(spark).collect())) == [(1, "a@x"), (2, "b@x"), (3, "c@x")]
    assert [v for v, _, _ in table.generations(spark)] == [1, 2, 3]


def test_plans_and_rows_that_do_not_fit_are_refused(spark, tmp_path):
    table = EvolvingTable(str(tmp_path / "t"))
    table.evolve(spark, V1)
    for plan in (None, Plan(renamed={"post": "email"}, added={"country": "1"}), Plan(renamed={"mail": "email"})):
        with pytest.raises(SchemaMismatch):
            table.evolve(spark, V2, plan)
    with pytest.raises(SchemaMismatch):
        table.append(spark.createDataFrame([(1,)], "id int"))
    assert [v for v, _, _ in table.generations(spark)] == [1]


def test_a_strict_plan_stops_at_what_cannot_be_cast(spark, tmp_path):
    table = EvolvingTable(str(tmp_path / "t"))
    table.evolve(spark, V1)
    table.append(spark.createDataFrame([(2, "b@x", "much")], V1))
    table.evolve(spark, V2, Plan(renamed={"mail": "email"}, added={"country": "NULL"}, strict=True))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.read(spark).collect()
