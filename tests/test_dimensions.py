from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, customer, location, product, raw_table, rows
from starmill.operators import dimensions as dims
from starmill.operators.keys import allocate_keys
from starmill.schemas import CURATED



def customers(spark, *data):
    return dims.clean_customers(raw_table(spark, "customers", list(data)), F.lit(AS_OF))


def test_customer_text_is_cleaned(spark):
    out = customers(spark, customer(1, first_name=None, email="  A@X.Org ", phone="(555) 01-01", is_active=None)).first()
    assert (out.full_name, out.email, out.phone, out.is_active) == ("Lee1", "a@x.org", "5550101", True)
    assert out.zip_code == "02101"


def test_latest_customer_wins_and_a_missing_date_is_the_run_date(spark):
    out = customers(spark, customer(1, city="Old", created_date="2020-01-01"), customer(1, city="New"),
                    customer(2, city="Dated", created_date="2024-06-01"), customer(2, city="Undated", created_date=None))
    assert rows(out, "customer_id", "city", "created_date") == [
        ("CUST1", "New", date(2023, 1, 15)), ("CUST2", "Undated", AS_OF)]


def test_customers_without_id_are_dropped(spark):
    assert rows(customers(spark, customer(1, customer_id=None), customer(2, customer_id=None), customer(3)),
                "customer_id") == [("CUST3",)]


def test_dedupe_is_idempotent_and_independent_of_order(spark):
    data = [customer(1, city=c) for c in ("A", "C", "B")]
    first = rows(customers(spark, *data))
    assert first == rows(customers(spark, *reversed(data)))
    again = customers(spark, *data)
    assert rows(dims.keep_latest(again, "customer_id", ["created_date"])) == first


def test_dedupe_limits_groups_before_the_shuffle(spark):
    plan = customers(spark, customer(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("price, cost, margin", [
    ("10.00", "4.00", Decimal("60.00")), ("0.00", "4.00", Decimal("0.00")), ("10.00", None, None),
    ("10.00", "12.50", Decimal("-25.00")), ("3.00", "1.00", Decimal("66.67")), ("1.00", "500.00", None),
])
def test_margin(spark, price, cost, margin):
    out = dims.clean_products(raw_table(spark, "products", [product(1, unit_price=price, cost=cost)])).first()
    assert out.margin == margin


def test_products_need_a_price_of_at_least_zero(spark):
    out = dims.clean_products(raw_table(spark, "products", [
        product(1, unit_price=None), product(2, unit_price="-1.00"), product(3, unit_price="abc"),
        product(4, unit_price="0.00"), product(5, product_id=None)]))
    assert rows(out, "product_id") == [("PROD4",)]


def test_bad_latest_product_version_removes_the_product(spark):
    raw = raw_table(spark, "products", [product(1, product_name="a"), product(1, product_name="b", unit_price="-1.00")])
    assert dims.clean_products(raw).count() == 0


def test_file_time_breaks_ties_between_product_versions(spark):
    older = raw_table(spark, "products", [product(1, product_name="z")]).withColumn(dims.VERSION, F.lit(datetime(2024, 1, 1)))
    newer = raw_table(spark, "products", [product(1, product_name="a")]).withColumn(dims.VERSION, F.lit(datetime(2024, 2, 1)))
    assert rows(dims.clean_products(older.union(newer)), "product_name") == [("a",)]


def test_product_and_location_text(spark):
    p = dims.clean_products(raw_table(spark, "products", [product(1, product_name=" x ", category=" tools", subcategory="small ")])).first()
    assert (p.product_name, p.category, p.subcategory) == ("x", "TOOLS", "SMALL")
    loc = dims.clean_locations(raw_table(spark, "locations", [
        location(1, store_name=" s ", city=" c", state="ny ", region=" east", country="usa"), location(2, location_id=None)]))
    assert rows(loc, "store_name", "city", "state", "region", "country") == [("s", "c", "NY", "EAST", "USA")]


def test_default_calendar(spark):
    out = dims.build_date_dimension(spark)
    assert out.schema.names == CURATED["date_dim"].names
    summary = out.agg(F.count(F.lit(1)), F.count_if("is_weekend"), F.min("fiscal_year"), F.max("fiscal_year"),
                      F.count_distinct("date_key")).first()
    assert tuple(summary) == (4018, 1148, 2020, 2031, 4018)


@pytest.mark.parametrize("day, expected", [
    ("2024-02-29", (20240229, 1, "February", 5, "Thursday", 9, False, 2024)),
    ("2023-01-01", (20230101, 1, "January", 1, "Sunday", 52, True, 2023)),
    ("2024-12-31", (20241231, 4, "December", 3, "Tuesday", 1, False, 2025)),
    ("2024-06-30", (20240630, 2, "June", 1, "Sunday", 26, True, 2024)),
    ("2024-07-01", (20240701, 3, "July", 2, "Monday", 27, False, 2025)),
])
def test_calendar_edges(spark, day, expected):
    d = date.fromisoformat(day)
    out = dims.build_date_dimension(spark, d, d).select(
        "date_key", "quarter", "month_name", "day_of_week", "day_name", "week_of_year", "is_weekend", "fiscal_year").first()
    assert tuple(out) == expected


def test_a_long_calendar_is_built(spark):
    assert dims.build_date_dimension(spark, date(1600, 1, 1), date(2400, 1, 1)).count() == 292_195


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_keys_are_dense_unique_and_repeatable(spark):
    many = ids(spark, *[f"C{i % 700}" for i in range(2000)], None)
    first = allocate_keys(many, "id", "key").cache()
    assert first.count() == 700
    assert first.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first() == (1, 700, 700)
    assert rows(first) == rows(allocate_keys(many.repartition(5), "id", "key"))


def test_known_ids_keep_their_keys(spark):
    known = spark.createDataFrame([("a", 7), ("b", 3)], "id string, key long")
    new = allocate_keys(ids(spark, "b", "x", "a", "y", "x"), "id", "key", known)
    assert sorted(r.id for r in new.collect()) == ["x", "y"]
    assert sorted(r.key for r in new.collect()) == [8, 9]
