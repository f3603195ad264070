from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import AS_OF, customer, location, product, raw_table, rows, sale
from starmill.operators import dimensions as dims
from starmill.operators.fact import accepted, build_sales_fact, rejected, resolve_sales
from starmill.operators.keys import allocate_keys
from starmill.schemas import CURATED



@pytest.fixture(scope="module")
def star(spark):
    def keyed(cleaned, table):
        fields = CURATED[table].names
        return dims.with_keys(cleaned, allocate_keys(cleaned, fields[1], fields[0]), table, F.current_timestamp())

    return {
        "customer": keyed(dims.clean_customers(raw_table(spark, "customers", [customer(1), customer(2)]), F.lit(AS_OF)), "customer_dim"),
        "product": keyed(dims.clean_products(raw_table(spark, "products", [product(1), product(2)])), "product_dim"),
        "location": keyed(dims.clean_locations(raw_table(spark, "locations", [location(1)])), "location_dim"),
    }


@pytest.fixture(scope="module")
def calendar(spark):
    return dims.build_date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31))


DIRTY = [
    sale(1), sale(2, customer_id="CUST9"), sale(3, product_id=None), sale(4, location_id="LOC9", customer_id="x"),
    sale(5, sale_date="soon"), sale(6, sale_date="2019-01-01"), sale(7, discount_amount=None, tax_amount=None),
    sale(8, quantity="0"), sale(9, quantity="-1"), sale(10, quantity="lots"), sale(11, sale_date=None),
]


def resolve(spark, star, calendar, data, **options):
    return resolve_sales(raw_table(spark, "sales", data), star, calendar, F.current_timestamp(), **options)


def test_amounts(spark, star, calendar):
    out = build_sales_fact(raw_table(spark, "sales", [sale(1), sale(7, discount_amount=None, tax_amount=None)]),
                           *star.values(), calendar)
    assert rows(out, "sale_id", "gross_amount", "discount_amount", "tax_amount", "net_amount", "date_key", "month_key") == [
        ("SALE1", Decimal("20.00"), Decimal("1.00"), Decimal("0.50"), Decimal("19.50"), 20240105, 202401),
        ("SALE7", Decimal("20.00"), Decimal("0.00"), Decimal("0.00"), Decimal("20.00"), 20240105, 202401)]
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CURATED["sales_fact"]]


def test_rejects_name_the_missing_keys(spark, star, calendar):
    out = rejected(resolve(spark, star, calendar, DIRTY))
    assert dict(rows(out, "sale_id", "reject_reason")) == {
        "SALE2": "customer_key", "SALE3": "product_key", "SALE4": "customer_key,location_key", "SALE5": "date_key",
        "SALE6": "date_key", "SALE10": "quantity,gross_amount,net_amount", "SALE11": "date_key"}
    assert dict(rows(out, "sale_id", "sale_date"))["SALE5"] == "soon"


def test_lines_without_amounts_are_rejected(spark, star, calendar):
    data = [*DIRTY, sale(12, quantity="2.0"), sale(13, quantity="2.5"), sale(14, quantity="99999999", unit_price="99999.00"),
            sale(15, unit_price="cheap"), sale(16, quantity=None)]
    resolved = resolve(spark, star, calendar, data)
    assert {r[0] for r in rows(accepted(resolved), "sale_id")} == {"SALE1", "SALE7", "SALE8", "SALE9", "SALE12"}
    assert dict(rows(accepted(resolved), "sale_id", "quantity"))["SALE12"] == 2
    reasons = dict(rows(rejected(resolved), "sale_id", "reject_reason"))
    assert (reasons["SALE13"], reasons["SALE14"], reasons["SALE15"]) == (
        "quantity,gross_amount,net_amount", "gross_amount,net_amount", "unit_price,gross_amount,net_amount")


def test_dates_outside_the_calendar_may_be_let_through(spark, star, calendar):
    out = rejected(resolve(spark, star, calendar, DIRTY, reject_out_of_calendar=False))
    reasons = dict(rows(out, "sale_id", "reject_reason"))
    assert "SALE6" not in reasons and reasons["SALE5"] == "date_key"


def test_no_line_is_lost_and_keys_are_unique(spark, star, calendar):
    out = resolve(spark, star, calendar, DIRTY * 20, first_key=1000)
    assert accepted(out).count() + rejected(out).count() == len(DIRTY) * 20
    assert out.select("sale_key").distinct().count() == len(DIRTY) * 20
    assert out.agg(F.min("sale_key")).first()[0] == 1000


def test_salted_lookups_give_the_same_fact(spark, star, calendar):
    columns = ["sale_id", "customer_key", "product_key", "location_key", "date_key", "net_amount", "reject_reason"]
    small = resolve(spark, star, calendar, DIRTY * 30)
    large = resolve(spark, star, calendar, DIRTY * 30, broadcast_rows=0)
    assert rows(small, *columns) == rows(large, *columns)
