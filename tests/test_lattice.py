"""Stored group-bys: their answers are the fact's, whatever they were built from and whatever failed before."""

from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import AS_OF, customer, location, product, raw_table, rows, sale, write_raw
from starmill.operators.sinks import write_table
from starmill.plans import lattice
from starmill.plans.aggregates import sales_enriched
from starmill.plans.lattice import Lattice, Request, Shape, cut_range, open_lattice, sync_lattice
from starmill.plans.pipeline import load_fact, run_pipeline
from starmill.plans.warehouse import SALES_FOLDER, open_star

SHAPES = [Shape("day", ("date_key", "category", "region"), sets=True), Shape("month", ("month_key", "category", "region"), sets=True),
          Shape("region", ("region",), sets=True), Shape("store", ("date_key", "location_key"))]
ALL = tuple(lattice.MEASURES)
REQUESTS = [
    Request(ALL), Request(ALL, ("region",)), Request(ALL, ("category", "month"), {"region": ["EAST", "WEST"]}),
    Request(ALL, ("region",), start=date(2024, 1, 20), end=date(2024, 4, 3)), Request(ALL, (), {"category": ["NONE"]}),
    Request(ALL, ("region",), {"category": ["NONE"]}),
    Request(ALL, ("category",), start=date(2024, 2, 1)), Request(ALL, ("date_value",), end=date(2024, 2, 10)),
    Request(("total_sales", "units_sold"), ("store_name", "fiscal_year")), Request(("total_sales",), ("year", "month_name", "state")),
    Request(("unique_customers",), ("brand",)), Request(("total_transactions",), ("customer_id",)),
    Request(("unique_customers", "total_sales"), ("region",), start=date(2024, 3, 9), end=date(2024, 3, 20)),
]


def sales(n, first=0):
    day = date(2024, 1, 1)
    return [sale(i, customer_id=f"CUST{i * 7 % 9 + 1}", product_id=f"PROD{i % 4 + 1}", location_id=f"LOC{i % 3 + 1}",
                 sale_date=str(day + timedelta(days=i * 5 % 130)), quantity=str(i % 3 + 1)) for i in range(first, first + n)]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lattice"))
    write_raw(spark, f"{root}/raw", [customer(n) for n in range(1, 10)],
              [product(n, category=("TOOLS", "TOYS")[n % 2]) for n in range(1, 5)],
              [location(n, region=("EAST", "WEST", None)[n - 1]) for n in range(1, 4)], sales(80))
    result = run_pipeline(spark, f"{root}/raw", f"{root}/star", as_of=AS_OF, calendar_start=date(2023, 1, 1), calendar_end=date(2025, 12, 31))
    sync_lattice(result.star, f"{root}/star", SHAPES)
    return root, result, open_lattice(result.star, f"{root}/star", SHAPES)


def from_fact(star, request):
    """The answer by plain aggregation of the enriched fact."""
    star_rows = sales_enriched(star)
    for c, chosen in request.where.items():
        star_rows = star_rows.where(F.col(c).isin(chosen))
    if request.start:
        star_rows = star_rows.where(F.col("date_value") >= F.lit(request.start))
    if request.end:
        star_rows = star_rows.where(F.col("date_value") <= F.lit(request.end))
    net, gross, off = F.sum("net_amount"), F.sum("gross_amount"), F.sum("discount_amount")
    measures = {
        "total_sales": net, "total_transactions": F.count(F.lit(1)), "units_sold": F.sum("quantity"), "gross_sales": gross,
        "total_discount": off, "avg_transaction_value": net.cast("double") / F.count("net_amount"),
        "discount_rate": F.when(F.coalesce(gross, F.lit(0)) == 0, 0.0).otherwise(off.cast("double") / gross.cast("double")),
        "unique_customers": F.count_distinct("customer_key")}
    return star_rows.groupBy(*request.by).agg(*[measures[m].alias(m) for m in request.measures])


def agree(star, found, request):
    assert rows(found.answer(request)) == rows(from_fact(star, request))


@pytest.mark.parametrize("request_", REQUESTS, ids=str)
def test_answers_are_those_of_the_fact(built, request_):
    _, result, found = built
    agree(result.star, found, request_)
    agree(result.star, Lattice(result.star, []), request_)


@pytest.mark.parametrize("number, names", [
    (0, ["region"]), (1, ["region"]), (2, ["month"]), (3, ["month", "day", "day"]), (6, ["month"]), (7, ["day"]),
    (8, ["store"]), (9, ["mv_monthly_sales"]), (10, ["sales_fact"]), (11, ["mv_customer_summary"]), (12, ["day"])])
def test_the_smallest_summary_answers(built, number, names):
    _, _, found = built
    parts = [p.source.name for p in found.parts(REQUESTS[number])]
    assert parts == names or (number == 6 and parts[0] == "month")
    if "sales_fact" not in names:
        assert not any(SALES_FOLDER in f for f in found.answer(REQUESTS[number]).inputFiles())


def test_ends_of_a_range_open_their_months_only(built):
    _, _, found = built
    parts = found.parts(REQUESTS[3])
    assert [(p.column, p.between) for p in parts] == [
        ("month_key", (202402, 202403)), ("date_key", (20240120, 20240131)), ("date_key", (20240401, 20240403))]
    plan = found._rows(parts[1], REQUESTS[3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan and "month_key#" in plan


@settings(max_examples=300, deadline=None)
@given(st.dates(date(2019, 11, 1), date(2021, 3, 31)), st.integers(0, 500))
def test_cut_ranges_cover_each_day_once(start, length):
    end = start + timedelta(days=length)
    months, spans = cut_range(start, end)
    days = [start + timedelta(days=i) for i in range(length + 1)]
    for day in [*days, start - timedelta(days=1), end + timedelta(days=1)]:
        key = day.year * 10000 + day.month * 100 + day.day
        hits = sum(a <= key <= b for a, b in spans) + bool(months and months[0] <= key // 100 <= months[1])
        assert hits == (day in days)
    assert len(spans) <= 2


def test_appends_that_die_are_made_up_for(spark, built, tmp_path, monkeypatch):
    _, result, _ = built
    target, at = str(tmp_path / "star"), F.current_timestamp()
    for table, df in result.star.tables().items():
        if table != "sales_fact":
            write_table(df, f"{target}/{table}")
    monkeypatch.setattr(lattice, "MOST_LOADS", 2)

    def append(first, n):
        load = load_fact(spark, raw_table(spark, "sales", sales(n, first)), target, at, result.star.rows, append=True)
        return load, open_star(spark, target, result.star.rows)

    load, star = append(0, 30)
    sync_lattice(star, target, SHAPES, load)
    append(30, 20)  # dies before the group-bys
    load, star = append(30, 20)
    stale = open_lattice(star, target, SHAPES, load)
    assert stale.sources == []
    agree(star, stale, REQUESTS[1])
    real, done = lattice._write, []

    def dying(state, path, shape, through):
        if len(done) == 2:
            raise OSError("lost")
        done.append(shape.name)
        real(state, path, shape, through)

    monkeypatch.setattr(lattice, "_write", dying)
    with pytest.raises(OSError):
        sync_lattice(star, target, SHAPES, load)
    half = open_lattice(star, target, SHAPES, load)
    assert [s.name for s in half.sources] == ["day", "month"]
    agree(star, half, REQUESTS[3])
    monkeypatch.setattr(lattice, "_write", real)
    for first in (50, 60, 70):
        sync_lattice(star, target, SHAPES, load)
        sync_lattice(star, target, SHAPES, load)  # finds nothing to do
        whole = open_lattice(star, target, SHAPES, load)
        for request in (REQUESTS[2], REQUESTS[3], REQUESTS[8]):
            agree(star, whole, request)
        load, star = append(first, 10)
    assert max(len(lattice._loads(spark, f"{target}/lattice/{s.name}")) for s in SHAPES) <= 2


def test_an_empty_fact(spark, built, tmp_path):
    _, result, _ = built
    target = str(tmp_path / "star")
    for table, df in result.star.tables().items():
        if table != "sales_fact":
            write_table(df, f"{target}/{table}")
    load = load_fact(spark, raw_table(spark, "sales", []), target, F.current_timestamp(), result.star.rows)
    star = open_star(spark, target, result.star.rows)
    sync_lattice(star, target, SHAPES, load)
    found = open_lattice(star, target, SHAPES, load)
    for request in (REQUESTS[0], REQUESTS[3], REQUESTS[8]):
        agree(star, found, request)


def test_large_sets_become_bitmaps(built, monkeypatch):
    root, result, _ = built
    monkeypatch.setattr(lattice, "POSITIONS", 2)
    star = result.star
    shapes = [Shape(f"{s.name}_bits", s.grain, s.sets) for s in SHAPES]
    sync_lattice(star, f"{root}/star", shapes)
    found = open_lattice(star, f"{root}/star", shapes)
    stored = next(s for s in found.sources if s.name == "region_bits").table
    assert stored.where("bitmap IS NOT NULL").count() and not stored.where("size(positions) > 2").count()
    only = Lattice(star, [s for s in found.sources if s.name.endswith("_bits")])
    for request in REQUESTS[:4]:
        agree(star, only, request)
